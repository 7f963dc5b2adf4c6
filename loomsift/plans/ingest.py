"""The batch: purge, validate, resolve duplicates, score and gate, parse what passed, queue, and report.

What fails is kept: a failed source or record becomes a row of the DLQ, a record's payload goes to quarantine if it is
broken for good, and a source that fails ``BREAKER_FAILURES`` times in a row is cut there.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions.rubric import DEFAULT, scored
from loomsift.operators.cascade import resolved
from loomsift.operators.dedup import merged
from loomsift.operators.health import batch_report
from loomsift.operators.tables import broken_circuits, invalid, purged
from loomsift.schema import BREAKER_FAILURES
from loomsift.scratch import checkpointed, free_name

ERROR = "struct<type:string,detail:string,transient:boolean>"
OUTAGE = "source string, error_type string, error_detail string, transient boolean"


class Batch(NamedTuple):
    """What a batch leaves: all staged rows, log rows, rejects, a report of one row, failures, and payloads to keep."""

    staged: DataFrame
    events: DataFrame
    rejects: DataFrame
    report: DataFrame
    dlq: DataFrame
    quarantined: DataFrame


def _parsed(passed: DataFrame, parse: Callable[[DataFrame], DataFrame], known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The rows as parse gives them; and the same with a mark of what each was made of. Rows that are ``known``, unchanged,
    aren't parsed again: a model is asked once a row, however many rounds there are."""
    mark = free_name("mark", [*passed.columns, *(known.columns[:-1] if known is not None else [])])
    rows = passed.withColumn(mark, F.xxhash64(*sorted(passed.columns)))
    fresh = rows if known is None else rows.join(known.select("seq", F.col(known.columns[-1]).alias(mark)), ["seq", mark], "left_anti")
    made = checkpointed(parse(fresh.drop(mark)).join(fresh.select("seq", mark), "seq"))
    if known is not None:
        before = known.withColumnRenamed(known.columns[-1], mark)
        made = made.unionByName(before.join(rows.select("seq", mark), ["seq", mark], "left_semi"), allowMissingColumns=True)
    made = made.select(*[c for c in made.columns if c != mark], mark)
    return made.drop(mark), made


def _decided(good: DataFrame, kept: DataFrame, as_of: Column, rubric: dict[str, Any], parse: Callable[[DataFrame], DataFrame] | None, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Decisions on all rows; the accepted rows, merged and judged, with an error (null if there is none); and what was parsed."""
    decisions = checkpointed(resolved(good, kept))  # used several times; survives lost executors
    rows = good.withColumn("staged", F.lit(False)).unionByName(kept.withColumn("staged", F.lit(True)), allowMissingColumns=True)
    won = good.join(decisions.where(F.col("action").isin("new", "supersedes")).select("seq", "took"), "seq").select(*good.columns, "took")
    judged = scored(merged(won, rows).drop("took"), as_of, rubric).withColumn("rubric_score", F.col("rubric.total"))
    judged = judged.withColumn("status", F.when(F.col("rubric.passed"), "queued").otherwise("rejected"))
    passed, failed = judged.where("status = 'queued'"), judged.where("status = 'rejected'")
    if parse is not None:
        passed, known = _parsed(passed, parse, known)
    if "error" not in passed.columns:
        passed = passed.withColumn("error", F.lit(None).cast(ERROR))
    passed = passed.withColumn("status", F.when(F.col("error").isNull(), F.col("status")).otherwise("dlq"))
    return decisions, checkpointed(passed.unionByName(failed, allowMissingColumns=True)), known


def run(
    fetched: DataFrame, staged: DataFrame, as_of: Column, rubric: dict[str, Any] = DEFAULT, parse: Callable[[DataFrame], DataFrame] | None = None, outages: DataFrame | None = None,
) -> Batch:
    """fetched and staged: document rows with seq, unique in each (fetched ones follow the order of fetching).

    Order matters only inside groups of like titles, which the cascade resolves. A winner takes over what it
    lacks from the row it replaces, before it is scored; that row goes even if the winner fails the gate. parse sees
    passed rows only, and may add an error (``ERROR``). outages (``OUTAGE``): sources that gave nothing.
    Counts are of what was done in the batch, so a row that was queued and then replaced counts as queued.
    """
    spark = fetched.sparkSession
    bad = invalid(fetched.withColumn("critique_questions", F.lit(None).cast("array<struct<question:string,labels:array<string>>>")))
    good = every = fetched.join(bad.select("seq"), "seq", "left_anti").select(*fetched.columns)
    kept, gone = purged(staged, as_of)
    known = None
    while True:
        decisions, judged, known = _decided(good, kept, as_of, rubric, parse, known)
        errors = judged.where("error is not null").select("seq", F.when(F.col("error.transient"), "transient").otherwise("permanent").alias("kind"))
        if not errors.take(1):
            broken = good.select("source").where(F.lit(False))
            break
        # what follows a break was never processed, so the others are decided without it
        before = checkpointed(broken_circuits(good.select("source", "seq").join(errors, "seq", "left").fillna("ok", ["kind"]), BREAKER_FAILURES))
        left = good.join(before.select("seq"), "seq", "left_semi")
        broken = before.where("breaks").select("source")
        if not good.join(before.select("seq"), "seq", "left_anti").take(1):
            break
        good = checkpointed(left)

    lost = decisions.where("size(took) > 0").select(F.col("took")[0].alias("row")).select("row.staged", "row.seq")
    fresh = judged.drop("error").join(lost.where("not staged").select("seq"), "seq", "left_anti")
    rest = kept.join(lost.where("staged").select("seq"), "seq", "left_anti")

    dropped = decisions.where("action = 'duplicate_fuzzy'").select("uid", F.lit("DEDUP_DROPPED").alias("event_type"), F.col("matched_uid").alias("detail"))
    replaced = decisions.where("action = 'supersedes'").select("uid", F.lit("DEDUP_MERGED").alias("event_type"), F.col("matched_uid").alias("detail"))
    rejected = judged.where("status = 'rejected'").select("uid", F.lit("RUBRIC_REJECTED").alias("event_type"), F.col("rubric_score").cast("string").alias("detail"))
    events = gone.unionByName(dropped).unionByName(replaced).unionByName(rejected)

    failed = judged.where("status = 'dlq'").select("uid", F.col("error.type").alias("error_type"), F.col("error.detail").alias("error_detail"), F.col("error.transient").alias("retry_eligible"))
    invalid_rows = bad.select("uid", F.lit("ValidationError").alias("error_type"), F.array_join("broken", ", ").alias("error_detail"), F.lit(False).alias("retry_eligible"))
    if outages is None:
        outages = spark.createDataFrame([], OUTAGE)
    down = outages.select(F.concat("source", F.lit(":batch")).alias("uid"), "error_type", "error_detail", F.col("transient").alias("retry_eligible"))
    dlq = failed.unionByName(invalid_rows).unionByName(down).withColumn("attempts", F.lit(1)).withColumn("created_at", as_of)
    payload = lambda df: df.select("uid", F.to_json(F.struct(*[c for c in fetched.columns if c in df.columns])).alias("raw"))
    quarantined = payload(bad).unionByName(payload(judged.where("status = 'dlq' and not error.transient")))

    def actions(df: DataFrame, action: Column | str) -> DataFrame:
        return df.select((F.lit(action) if isinstance(action, str) else action).alias("action"))

    outcomes = actions(decisions, F.col("action")).unionByName(actions(judged, F.when(F.col("status") == "rejected", "rubric_rejected").otherwise(F.col("status")))).unionByName(actions(bad, "dlq"))
    outcomes = outcomes.unionByName(actions(down, "dlq")).unionByName(actions(gone, "purged")).unionByName(actions(every.join(good.select("seq"), "seq", "left_anti"), "cut"))
    skipped = outages.select("source").unionByName(broken).agg(F.sort_array(F.collect_set("source")).alias("skipped_sources"))
    return Batch(rest.unionByName(fresh, allowMissingColumns=True), events, bad, batch_report(outcomes).crossJoin(F.broadcast(skipped)), dlq, quarantined)


def retried(todo: DataFrame, fetch: Callable[[DataFrame], DataFrame], staged: DataFrame, as_of: Column, **batch: Any) -> tuple[Batch, DataFrame]:
    """Fetch failed documents again and run the batch on them; with the DLQ entries (id) that are done with.

    fetch takes entries (id, uid) and returns document rows with entry_id, of those it could fetch. The staged row of a
    failed document gives way to the new try.
    """
    found = checkpointed(fetch(todo))
    free = staged.join(todo.select("uid"), "uid", "left_semi").where("status = 'dlq'").select("seq")
    made = run(found.drop("entry_id"), staged.join(free, "seq", "left_anti"), as_of, **batch)
    again = found.join(made.dlq.select("uid"), "uid", "left_semi").select("entry_id")
    done = found.select(F.col("entry_id").alias("id")).distinct().join(again.withColumnRenamed("entry_id", "id"), "id", "left_anti")
    return made, done
