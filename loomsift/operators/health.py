"""Health snapshots and the review flow report: aggregates over the curation tables, one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.operators.screening import agreement, escalated, grounding
from loomsift.operators.tables import abstract_only, degraded, hours, last, permanent_failures, since
from loomsift.schema import BREAKER_FAILURES


def status_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("status").agg(F.count("*").alias("n"))


def failures_by_error(dlq: DataFrame) -> DataFrame:
    return dlq.groupBy("error_type").agg(F.count("*").alias("n"), F.sum(F.col("retry_eligible").cast("long")).alias("eligible"))


def sources_down(dlq: DataFrame, as_of: Column, failures: int = BREAKER_FAILURES) -> DataFrame:
    """Sources with a retryable batch failure, or so many retryable document failures, in the last day."""
    recent = since(dlq, as_of, 24).where("retry_eligible").withColumn("source", F.substring_index("uid", ":", 1)).withColumn("batch", F.ilike("uid", F.lit("%:batch")))
    whole = recent.where("batch").select("source")
    many = recent.where(~F.col("batch")).groupBy("source").count().where(F.col("count") >= failures).select("source")
    return whole.union(many).distinct()


def approved_today(events: DataFrame, as_of: Column) -> DataFrame:
    return events.where((F.col("event_type") == "APPROVED") & (F.col("created_at") >= F.date_trunc("day", as_of))).agg(F.count("*").alias("n"))


def hours_since_last_run(runs: DataFrame, as_of: Column) -> DataFrame:
    return runs.agg(((F.unix_timestamp(as_of) - F.unix_timestamp(F.max_by("started_at", "id"))) / 3600).alias("hours"))


def snapshot(docs: DataFrame, dlq: DataFrame, events: DataFrame, runs: DataFrame, screening: DataFrame, extraction: DataFrame, as_of: Column) -> DataFrame:
    """One row of all health figures; each part is a one-row aggregate."""
    errors = failures_by_error(dlq)
    day = as_of - hours(24)
    parts = [
        errors.agg(F.map_from_entries(F.collect_list(F.struct("error_type", "n"))).alias("dlq_by_error"), F.coalesce(F.sum("n"), F.lit(0)).alias("dlq_total"), F.coalesce(F.sum("eligible"), F.lit(0)).alias("dlq_retry_eligible")),
        dlq.agg(F.count_if(F.col("created_at") > day).alias("dlq_last_24h")),
        permanent_failures(dlq).agg(F.count("*").alias("dlq_permanent")),
        sources_down(dlq, as_of).agg(F.array_sort(F.collect_list("source")).alias("sources_down")),
        degraded(docs).agg(F.count("*").alias("degraded_count")),
        status_counts(docs).agg(F.map_from_entries(F.collect_list(F.struct("status", "n"))).alias("status_counts")),
        hours_since_last_run(runs, as_of).withColumnRenamed("hours", "hours_since_last_run"),
        runs.agg(F.max_by("report_json", "id").alias("last_report")),
        escalated(docs, events).agg(F.count("*").alias("screen_escalated_count")),
        agreement(screening).toDF("screen_kappa_recent", "screen_kappa_docs_count"),
        events.agg((F.count_if((F.col("event_type") == "SCREEN_SINGLE_MODEL") & (F.col("created_at") > day)) > 0).alias("single_model_mode_recent")),
        grounding(since(extraction, as_of, 24)).toDF("grounding_avg_24h", "extraction_docs_count_24h"),
        approved_today(events, as_of).withColumnRenamed("n", "approved_today"),
    ]
    row = parts[0]
    for p in parts[1:]:
        row = row.crossJoin(p)  # one row by one row
    return row


def counter(runs: DataFrame, name: str) -> Column:
    """The sum of a counter over the runs' JSON reports; what is no number counts as nothing."""
    return F.coalesce(F.sum(F.expr(f"try_cast(get_json_object(report_json, '$.{name}') as bigint)")), F.lit(0)).alias(name)


def flow_report(docs: DataFrame, events: DataFrame, runs: DataFrame, screening: DataFrame) -> DataFrame:
    """One row: how many records were identified, dropped, screened, excluded and included."""
    kind = F.col("event_type")
    runs_row = runs.agg(*[counter(runs, c) for c in ("fetched", "duplicates", "rubric_rejected")])
    ev = events.agg(
        F.count_if(kind == "FETCHED").alias("ev_fetched"),
        F.count_if(kind.isin("DUPLICATE_ID", "DUPLICATE_FUZZY")).alias("ev_duplicates"),
        F.count_if((kind == "REJECTED") & F.ilike("detail", F.lit("%rubric%"))).alias("ev_rejected"),
    )
    held = docs.agg(F.count("*").alias("held"))
    unscreened_rejects = docs.where("status = 'rejected'").join(screening.select("uid"), "uid", "left_anti").agg(F.count("*").alias("unscreened_rejects"))
    seen = screening.agg(F.countDistinct("uid").alias("screened"), F.countDistinct(F.when(F.col("verdict") == "exclude", F.col("uid"))).alias("excluded"))
    ends = docs.agg(F.count_if(F.col("status").isin("approved", "approved_local")).alias("included"))
    partial = abstract_only(docs).agg(F.count("*").alias("abstract_only"))
    row = runs_row.crossJoin(ev).crossJoin(held).crossJoin(unscreened_rejects).crossJoin(seen).crossJoin(ends).crossJoin(partial)
    return row.select(
        F.greatest("fetched", "ev_fetched", "held").alias("identified"), F.greatest("duplicates", "ev_duplicates").alias("duplicates"),
        F.greatest("rubric_rejected", "ev_rejected", "unscreened_rejects").alias("rubric_rejected"), "screened", "excluded",
        (F.col("screened") - F.col("excluded")).alias("eligible"), F.lit(0).cast("long").alias("full_text_excluded"), "abstract_only", "included",
    )


def exclusion_reasons(screening: DataFrame) -> DataFrame:
    return screening.where("verdict = 'exclude'").groupBy(F.coalesce("criterion_id", F.lit("Unknown")).alias("criterion_id")).agg(F.countDistinct("uid").alias("n"))


def flow_markdown(report: DataFrame, reasons: DataFrame) -> str:
    """The report as Markdown with a flow chart; the driver sees one row and the few reasons."""
    r = report.first().asDict()
    lines = ["# Review flow", "", "| step | records |", "|---|---|", *(f"| {k.replace('_', ' ')} | {v} |" for k, v in r.items()), "", "```mermaid", "flowchart TD"]
    lines += [f"  A[identified: {r['identified']}] --> B[screened: {r['screened']}]", f"  B --> C[eligible: {r['eligible']}]", f"  B --> D[excluded: {r['excluded']}]", f"  C --> E[included: {r['included']}]", "```", ""]
    lines += [f"- {x.criterion_id}: {x.n}" for x in reasons.orderBy("criterion_id").collect()]
    return "\n".join(lines)


def batch_report(outcomes: DataFrame) -> DataFrame:
    """One row of counters from rows of (action): what a batch did with its records."""
    actions = ("new", "duplicate_id", "duplicate_fuzzy", "supersedes", "rubric_rejected", "queued", "dlq", "purged")
    n = {a: F.count_if(F.col("action") == a) for a in actions}
    return outcomes.agg(
        F.count_if(F.col("action").isin("new", "duplicate_id", "duplicate_fuzzy", "supersedes", "cut")).alias("fetched"), n["new"].alias("new"),
        (n["duplicate_id"] + n["duplicate_fuzzy"]).alias("duplicates"), n["supersedes"].alias("superseded"), n["rubric_rejected"].alias("rubric_rejected"), n["queued"].alias("queued"), n["dlq"].alias("dlq"), n["purged"].alias("purged"),
    )


def last_run(runs: DataFrame) -> DataFrame:
    return last(runs, "id")
