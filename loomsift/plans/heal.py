"""A heal cycle: what to retry, what failed again, which sources to run again, what to enrich, clean-up and alerts.

Calls to sources and models are injected. Every step leaves rows: failures, log rows, payloads to quarantine.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.operators.alerts import desired, evaluated
from loomsift.operators.tables import bumped, degraded, last, retained, retryable, still_failing
from loomsift.plans.ingest import ERROR, Batch
from loomsift.scratch import checkpointed

WINDOW, ENRICH_LIMIT = (1, 5), 10


class Healed(NamedTuple):
    """dlq: the entries left. events: the log left. enriched: rows with new metadata. failed: new failures of this cycle.
    new_events: log rows of this cycle. quarantined: uid and raw. batch: the batch that was run again, if one was."""

    dlq: DataFrame
    events: DataFrame
    enriched: DataFrame
    failed: DataFrame
    new_events: DataFrame
    quarantined: DataFrame
    batch: Batch | None


def recovered(dlq: DataFrame, reachable: DataFrame) -> DataFrame:
    """Retryable entries of whole sources that can be reached again."""
    rows = dlq.where(F.col("retry_eligible") & F.ilike("uid", F.lit("%:batch")))
    return rows.withColumn("source", F.substring_index("uid", ":", 1)).join(reachable, "source", "left_semi").select(*dlq.columns)


def enrichment(docs: DataFrame, enrich: Callable[[DataFrame], DataFrame], as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The best ENRICH_LIMIT degraded rows through ``enrich``, which may add an error (``ERROR``): rows to write back
    (enriched, or demoted to dlq), failures, log rows, and payloads to quarantine.

    The first transient error ends the round: that row and those after it stay as they are.
    """
    some = checkpointed(degraded(docs).limit(ENRICH_LIMIT))
    done = enrich(some)
    if "error" not in done.columns:
        done = done.withColumn("error", F.lit(None).cast(ERROR))
    done = checkpointed(done)
    order = F.struct((-F.col("rubric_score")).alias("s"), "uid")
    stop = done.where("error.transient").agg(F.min(order).alias("stop"))
    done = done.crossJoin(F.broadcast(stop)).where(F.col("stop").isNull() | (order < F.col("stop"))).drop("stop")  # one row
    good, bad = done.where("error is null"), done.where("error is not null")
    back = good.drop("error").withColumn("status", F.lit("queued")).unionByName(bad.drop("error").withColumn("status", F.lit("dlq")))
    failed = bad.select("uid", F.col("error.type").alias("error_type"), F.col("error.detail").alias("error_detail"), F.lit(False).alias("retry_eligible"), F.lit(1).alias("attempts"), as_of.alias("created_at"))
    return back, failed, good.select("uid", F.lit("ENRICHED").alias("event_type"), F.lit("").alias("detail")), bad.select("uid", F.to_json(F.struct(*docs.columns)).alias("raw"))


def cycle(
    docs: DataFrame, dlq: DataFrame, events: DataFrame, reachable: DataFrame, retry: Callable[[DataFrame], DataFrame], enrich: Callable[[DataFrame], DataFrame] | None, as_of: Column, hour: int,
    runs: DataFrame | None = None, rerun: Callable[[str], Batch] | None = None,
) -> Healed:
    """retry takes failures and returns those (id) that failed again. rerun runs the batch of the last query once more,
    if a source that was down can be reached; its entries go, the batch makes new ones if it fails again. Enrichment is
    for the night window only."""
    batch, down = None, recovered(dlq, reachable)
    if rerun is not None and runs is not None and down.take(1):
        query = last(runs, "id").first()
        if query is not None and query["query"]:
            dlq = dlq.join(down.select("id"), "id", "left_anti")
            batch = rerun(query["query"])
    todo = retryable(dlq, reachable)
    again = still_failing(todo, retry(todo))
    left = bumped(dlq.join(todo.join(again.select("id"), "id", "left_anti").select("id"), "id", "left_anti"), again)
    kept_events, kept_dlq = retained(events, left, as_of)
    night = WINDOW[0] <= hour <= WINDOW[1]
    done, failed, logged, raw = enrichment(docs if enrich is not None and night else docs.limit(0), enrich if enrich is not None and night else lambda x: x, as_of)
    if batch is not None:
        failed, logged, raw = failed.unionByName(batch.dlq), logged.unionByName(batch.events), raw.unionByName(batch.quarantined)
    return Healed(kept_dlq, kept_events, done, failed, logged, raw, batch)


def alerted(alerts: DataFrame, snapshot: DataFrame, as_of: Column, model_up: bool | None = None) -> DataFrame:
    """The cycle's last step: alerts after it, with the transitions to tell."""
    return evaluated(alerts, desired(snapshot, model_up), as_of)
