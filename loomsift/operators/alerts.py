"""Alert rules over a health snapshot, and the alerts' state machine as one full outer join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.operators.tables import hours
from loomsift.schema import NO_BATCH_HOURS, REALERT_HOURS, SPIKE_ENTRIES, SPIKE_RATIO

KAPPA_LOW, GROUNDING_LOW, ENOUGH_DOCS = 0.6, 0.8, 5


def desired(snapshot: DataFrame, model_up: bool | None = None) -> DataFrame:
    """key and detail of each alert that a snapshot asks for. model_up None: not probed, no rule about it."""
    ratio = F.expr("try_divide(try_cast(get_json_object(last_report, '$.dlq') as double), nullif(try_cast(get_json_object(last_report, '$.fetched') as double), 0))")
    rules = {
        "DLQ_SPIKE": ((F.col("dlq_retry_eligible") >= SPIKE_ENTRIES) | F.coalesce(ratio > SPIKE_RATIO, F.lit(False)), F.format_string("%d failures wait for a retry", "dlq_retry_eligible")),
        "OLLAMA_DEGRADED": (F.lit(model_up is False) & (F.col("degraded_count") > 0), F.format_string("%d queued records were not analysed", "degraded_count")),
        "NO_BATCH_36H": (F.col("hours_since_last_run") > NO_BATCH_HOURS, F.format_string("no batch for %.0f hours", "hours_since_last_run")),
        "DLQ_PERMANENT": (F.col("dlq_permanent") > 0, F.format_string("%d failures reached the last attempt", "dlq_permanent")),
        "SCREEN_DISAGREEMENT": ((F.col("screen_kappa_recent") < KAPPA_LOW) & (F.col("screen_kappa_docs_count") >= ENOUGH_DOCS), F.format_string("kappa %.2f on %d records", "screen_kappa_recent", "screen_kappa_docs_count")),
        "EXTRACT_UNGROUNDED": ((F.col("grounding_avg_24h") < GROUNDING_LOW) & (F.col("extraction_docs_count_24h") >= ENOUGH_DOCS), F.format_string("grounding %.2f on %d records", "grounding_avg_24h", "extraction_docs_count_24h")),
    }
    fixed = F.array(*[F.when(F.coalesce(on, F.lit(False)), F.struct(F.lit(k).alias("key"), detail.alias("detail"))) for k, (on, detail) in rules.items()])
    down = F.transform("sources_down", lambda s: F.struct(F.concat(F.lit("SOURCE_DOWN:"), s).alias("key"), F.concat(s, F.lit(" failed in the last day")).alias("detail")))
    return snapshot.select(F.explode(F.concat(down, F.array_compact(fixed))).alias("a")).select("a.key", "a.detail")


def evaluated(alerts: DataFrame, wanted: DataFrame, as_of: Column) -> DataFrame:
    """All alerts after a cycle, with the transition to notify (OPEN, REALERT, RESOLVED) or null.

    New or resolved and wanted: opens, first seen now. Open and wanted: silent, but again after REALERT_HOURS.
    Open and not wanted: resolved, once.
    """
    new = wanted.select("key", F.col("detail").alias("__detail"), F.lit(True).alias("__wanted"))
    x = alerts.join(new, "key", "full_outer").withColumn("__wanted", F.coalesce("__wanted", F.lit(False)))
    is_open = F.coalesce(F.col("state") == "OPEN", F.lit(False))
    stale = F.col("last_notified").isNull() | (F.col("last_notified") <= as_of - hours(REALERT_HOURS))
    step = F.when(F.col("__wanted") & ~is_open, "OPEN").when(F.col("__wanted") & stale, "REALERT").when(~F.col("__wanted") & is_open, "RESOLVED")
    return x.select(
        "key", F.when(step == "OPEN", "OPEN").when(step == "RESOLVED", "RESOLVED").otherwise(F.col("state")).alias("state"),
        F.when(step.isin("OPEN", "REALERT"), F.col("__detail")).otherwise(F.col("detail")).alias("detail"),
        F.when(step == "OPEN", as_of).otherwise(F.col("first_seen")).alias("first_seen"),
        F.when(step.isNotNull(), as_of).otherwise(F.col("last_notified")).alias("last_notified"), step.alias("transition"),
    )


def open_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where("state = 'OPEN'").orderBy("first_seen", "key")
