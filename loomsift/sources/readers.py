"""Readers of bibliographic files, and the bridge from their rows to the document record."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.functions.text import canonical_id, collapsed, default_tier, normalized_title, source_of_id, uid

ARTICLES = "total_records int, articles array<struct<article_number:string,title:string,abstract:string,publication_year:string,html_url:string,pdf_url:string,authors:struct<authors:array<struct<full_name:string>>>>>"
PAPERS = "papers array<struct<source:string,source_id:string,authority_tier:int,title:string,authors:array<string>,published_date:string,url:string,abstract:string>>"
FEED = "id string, title string, summary string, published string, author array<struct<name:string>>"
MANIFEST = "items array<struct<source:string,id:string,rank:int,found_by_query:string>>"


class LayoutError(ValueError):
    """A file lacks what every file of its kind has."""


def record(rows: DataFrame) -> DataFrame:
    """Add what follows from the other fields: uid, tier, normalised title, empty lists and the first status."""
    cols = rows.columns
    rows = rows if "authority_tier" in cols else rows.withColumn("authority_tier", default_tier(F.col("source")))
    return rows.select(
        uid(F.col("source"), F.col("source_id")).alias("uid"), "source", "source_id", "authority_tier", F.array().cast("array<string>").alias("alternate_uids"),
        "title", normalized_title("title").alias("title_normalized"), "abstract", "authors", "published_date", "url", F.lit(None).cast("string").alias("full_text"), F.lit("fetched").alias("status"),
    )


def checked(ok: Column, value: Column, kind: str, message: str) -> Column:
    """The value; if it isn't ok, an error. For filters and generators, which no choice of columns drops."""
    return F.when(F.coalesce(ok, F.lit(False)), value).otherwise(F.raise_error(F.lit(message)).cast(kind))


def articles(spark: SparkSession, path: str) -> DataFrame:
    """JSON search responses. A file without articles, or an article without a title, is a layout error; ids that are
    not eight digits are skipped."""
    files = spark.read.schema(ARTICLES).option("multiLine", True).json(path)
    every = checked(F.col("articles").isNotNull(), F.col("articles"), files.schema["articles"].dataType.simpleString(), "no articles")
    a = files.select(F.explode(every).alias("a")).select("a.*")
    title = F.trim(F.coalesce("title", F.lit("")))
    # the title is looked at first
    a = a.where(checked(title != "", F.col("article_number").rlike(r"^\d{8}$"), "boolean", "an article has no title"))
    return record(
        a.select(
            F.lit("ieee").alias("source"), F.col("article_number").alias("source_id"), title.alias("title"), F.nullif(F.trim("abstract"), F.lit("")).alias("abstract"),
            F.coalesce(F.transform("authors.authors", lambda x: x["full_name"]), F.array().cast("array<string>")).alias("authors"),
            F.expr("make_timestamp(try_cast(publication_year as int), 1, 1, 0, 0, 0)").alias("published_date"), F.coalesce("html_url", "pdf_url").alias("url"),
        )
    )


def atom(spark: SparkSession, path: str) -> DataFrame:
    """Atom feeds; an entry without a valid id or title, or a file that is no feed, is a layout error.

    A feed may be empty, if it is whole.
    """
    files = spark.read.text(path, wholetext=True)
    is_feed = F.col("value").rlike(r"<(\w+:)?feed[\s>/]") & F.col("value").rlike(r"(?s)</(\w+:)?feed>|<entry[\s>].*</entry>")
    entries = checked(is_feed, F.regexp_extract_all("value", F.lit(r"(?s)(<entry[\s>].*?</entry>)")), "array<string>", "a file is no feed")
    e = files.select(F.explode(entries).alias("e")).select(F.from_xml("e", FEED).alias("e")).select("e.*")
    title, sid = collapsed(F.coalesce("title", F.lit(""))), canonical_id(F.col("id"))
    return record(
        e.where(checked(sid.isNotNull() & (title != ""), F.lit(True), "boolean", "an entry has no valid id or title")).select(
            F.lit("arxiv").alias("source"), sid.alias("source_id"), title.alias("title"), F.nullif(collapsed(F.col("summary")), F.lit("")).alias("abstract"),
            F.transform("author", lambda x: x["name"]).alias("authors"), F.to_timestamp("published").alias("published_date"), F.trim("id").alias("url"),
        )
    )


def seed(spark: SparkSession, path: str) -> DataFrame:
    """JSON files of ready papers."""
    p = spark.read.schema(PAPERS).option("multiLine", True).json(path).select(F.explode("papers").alias("p")).select("p.*")
    return record(p.withColumn("published_date", F.to_timestamp("published_date")))


def manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Accepted ids by source, in order of rank, and rejected ones: ids are checked again on reading."""
    items = spark.read.schema(MANIFEST).option("multiLine", True).json(path).select(F.explode("items").alias("i")).select("i.*")
    valid = F.coalesce(source_of_id(F.col("id")) == F.col("source"), F.lit(False))
    ids = items.where(valid).withColumn("id", canonical_id(F.col("id"))).groupBy("source").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"]).alias("ids"))
    return ids, items.where(~valid).select(F.col("id").alias("raw_id"), F.lit("not an id of its source").alias("reason"))


def config(path: str, needs: tuple[str, ...] = ()) -> dict[str, Any]:
    """A small JSON file for the driver (profile, criteria, protocol or rubric)."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    if missing := [k for k in needs if k not in found]:
        raise LayoutError(f"{path} lacks {', '.join(missing)}")
    return found
