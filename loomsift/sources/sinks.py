"""Sinks: audit lines, rejects, manifests, page payloads and idempotent publishing."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions.guards import findings

TEXT_LIMIT, SNIPPET, QUESTIONS, LABELS = 2000, 300, 2, 3


def audit(df: DataFrame, key: str, text: str, path: str, as_of: Column) -> None:
    """Append a JSON line a finding: time, rule and short hash; the match is not written."""
    findings(df, key, text).select(as_of.alias("ts"), "rule_id", "match_sha256_12").write.mode("append").json(path)


def quarantine(rows: DataFrame, path: str, as_of: Column) -> None:
    """Raw payloads of records that failed, by day, under a file-safe name."""
    rows.select(F.replace("uid", F.lit(":"), F.lit("_")).alias("name"), "raw", F.to_date(as_of).alias("day")).write.mode("append").partitionBy("day").json(path)


def manifest(ids: DataFrame, path: str) -> None:
    """The plan of ids as JSON lines; an empty plan is an error."""
    if not ids.take(1):
        raise ValueError("the plan has no ids")
    ids.write.mode("overwrite").json(path)


def page_payload() -> Column:
    """A JSON page of a document in three parts: reference, sections and questions."""
    section = [F.when(F.col(f"sections.{r}").isNotNull(), F.concat(F.lit(f"{r.title()}: "), F.substring(f"sections.{r}.content", 1, SNIPPET), F.when(F.length(f"sections.{r}.content") > SNIPPET, "…").otherwise(""))) for r in ("context", "method", "findings", "implications")]
    questions = F.transform(F.slice(F.coalesce("critique_questions", F.array().cast("array<struct<question:string,labels:array<string>>>")), 1, QUESTIONS), lambda q: F.struct(F.substring(q["question"], 1, TEXT_LIMIT).alias("question"), F.slice(q["labels"], 1, LABELS).alias("labels")))
    reference = F.struct(F.substring("title", 1, TEXT_LIMIT).alias("title"), F.array_join("authors", ", ").alias("authors"), "url", F.col("rubric.total").alias("score"), F.substring("abstract", 1, TEXT_LIMIT).alias("abstract"))
    return F.to_json(F.struct(reference.alias("reference"), F.array_compact(F.array(*section)).alias("sections"), questions.alias("questions")))


def published(docs: DataFrame, send: Callable[[str, str], str] | None) -> DataFrame:
    """uid, status, page_id and event: pages that exist stay; without ``send`` a dry run approves locally.

    send(uid, payload) returns a page id; give it idempotent, for a task may run twice. Store the result before use.
    """
    have = docs.where(F.col("page_id").isNotNull()).select("uid", "status", "page_id", F.lit(None).cast("string").alias("event_type"))
    todo = docs.where(F.col("page_id").isNull()).select("uid", page_payload().alias("payload"))
    if send is None:
        new = todo.select("uid", F.lit("approved_local").alias("status"), F.lit(None).cast("string").alias("page_id"), F.lit("APPROVED").alias("event_type"))
        return have.unionByName(new)

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"uid": b["uid"], "status": "approved", "page_id": [send(u, p) for u, p in zip(b["uid"], b["payload"], strict=True)], "event_type": "APPROVED"})

    return have.unionByName(todo.mapInPandas(sent, "uid string, status string, page_id string, event_type string"))


def notify(title: str, message: str, sinks: tuple[Callable[[str, str], None], ...] = ()) -> None:
    """Tell every sink; if none takes it, standard error. Never raises."""
    sent = False
    for sink in sinks:
        try:
            sink(title, message)
            sent = True
        except Exception as e:  # noqa: BLE001  a sink must not stop the caller
            print(f"[alert] sink failed: {e}", file=sys.stderr)
    if not sent:
        print(f"[alert] {title}: {message}", file=sys.stderr)
