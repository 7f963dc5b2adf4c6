"""A declarative rubric compiled to Column expressions: each rule gives a sub-score of 0..100 and a reason."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions.text import word_count
from loomsift.schema import PASS_SCORE

Rule = Callable[[dict[str, Any], Column], tuple[Column, Column]]

# The default rubric.
DEFAULT: dict[str, Any] = {
    "version": "1.0",
    "pass_threshold": PASS_SCORE,
    "criteria": [
        {"key": "source_authority", "weight": 30, "rule": "tier_lookup", "params": {"1": 100, "2": 70}},
        {"key": "recency", "weight": 20, "rule": "linear_decay_years", "params": {"full_score_within": 2, "zero_at": 10}},
        {"key": "artifact_availability", "weight": 25, "rule": "keyword_flags", "params": {"code": ["github.com", "gitlab.com", "bitbucket.org"], "dataset": ["zenodo", "huggingface.co/datasets", "figshare", "dryad"]}},
        {"key": "abstract_completeness", "weight": 15, "rule": "length_range", "params": {"min_words": 80, "ideal_words": 200}},
        {"key": "metadata_integrity", "weight": 10, "rule": "required_fields", "params": {"fields": ["title", "authors", "published_date"]}},
    ],
}


def tier_lookup(params: dict[str, Any], as_of: Column) -> tuple[Column, Column]:
    table = F.create_map(*[F.lit(x) for k, v in params.items() for x in (k, float(v))])
    tier = F.col("authority_tier").cast("string")
    return F.coalesce(F.try_element_at(table, tier), F.lit(0.0)), F.concat(F.lit("tier "), F.coalesce(tier, F.lit("unknown")))


def linear_decay_years(params: dict[str, Any], as_of: Column) -> tuple[Column, Column]:
    """Age counts whole elapsed days of 24 hours."""
    full, zero = float(params["full_score_within"]), float(params["zero_at"])
    age = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp("published_date")) / 86400) / 365.25
    score = F.when(age.isNull() | (age >= zero), 0.0).when(age <= full, 100.0).otherwise(100.0 * (zero - age) / (zero - full))
    return F.when(age <= full, 100.0).otherwise(score), F.coalesce(F.format_string("%.1f years old", age), F.lit("no publication date"))


def keyword_flags(params: dict[str, Any], as_of: Column) -> tuple[Column, Column]:
    hay = F.lower(F.concat_ws(" ", *[F.when(F.col(c) != "", F.col(c)) for c in ("abstract", "full_text", "url")]))
    if not params:
        return F.lit(0.0), F.lit("no keyword groups")
    hit = {}
    for name, keys in params.items():
        hit[name] = F.lit(False)
        for k in keys:
            hit[name] = hit[name] | F.contains(hay, F.lit(k.lower()))
    score = sum((h.cast("int") for h in hit.values()), F.lit(0)) * 100.0 / len(hit)
    return score, F.concat(F.lit("found: "), F.coalesce(F.nullif(F.concat_ws(", ", *[F.when(h, F.lit(n)) for n, h in hit.items()]), F.lit("")), F.lit("none")))


def length_range(params: dict[str, Any], as_of: Column) -> tuple[Column, Column]:
    low, ideal = int(params["min_words"]), int(params["ideal_words"])
    n = word_count(F.col("abstract"))
    score = F.when(n == 0, 0.0).when(n < low, 50.0 * n / low).when(n >= ideal, 100.0).otherwise(50.0 + 50.0 * (n - low) / max(1, ideal - low))
    return score, F.format_string("%d words", n)


def required_fields(params: dict[str, Any], as_of: Column) -> tuple[Column, Column]:
    def present(c: str) -> Column:
        return F.coalesce(F.size(F.col(c)) > 0, F.lit(False)) if c in ("authors", "alternate_uids") else F.coalesce(F.col(c).cast("string") != "", F.lit(False))

    fields = params["fields"]
    score = sum((present(c).cast("int") for c in fields), F.lit(0)) * 100.0 / len(fields)
    missing = F.array_compact(F.array(*[F.when(~present(c), F.lit(c)) for c in sorted(fields)]))
    return score, F.concat(F.lit("missing: "), F.when(F.size(missing) > 0, F.array_join(missing, ", ")).otherwise(F.lit("none")))


RULES: dict[str, Rule] = {f.__name__: f for f in (tier_lookup, linear_decay_years, keyword_flags, length_range, required_fields)}


def checked(rubric: dict[str, Any]) -> dict[str, Any]:
    """The rubric, if it has criteria of known rules and positive weights."""
    if not rubric.get("criteria"):
        raise ValueError("a rubric needs criteria")
    for c in rubric["criteria"]:
        if c["rule"] not in RULES or float(c["weight"]) <= 0:
            raise ValueError(f"criterion {c.get('key')}: unknown rule or weight not above 0")
    return rubric


def scored(docs: DataFrame, as_of: Column, rubric: dict[str, Any] = DEFAULT, name: str = "rubric") -> DataFrame:
    """Add a struct of total (two decimals), passed and the breakdown by criterion."""
    parts, sums, weights = [], F.lit(0.0), 0.0
    for c in rubric["criteria"]:
        sub, reason = RULES[c["rule"]](c["params"], as_of)
        weight = float(c["weight"])
        parts.append(F.struct(F.lit(c["key"]).alias("key"), F.lit(weight).alias("weight"), sub.cast("double").alias("sub_score"), reason.alias("reason")))
        sums, weights = sums + weight * sub, weights + weight
    total = F.bround(sums / weights, 2) if weights else F.lit(0.0)
    return docs.withColumn(name, F.struct(total.alias("total"), (total >= float(rubric["pass_threshold"])).alias("passed"), F.array(*parts).alias("breakdown")))
