"""Keyed state, logs and filters of the curation tables. Every function takes its reference time as ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomsift.schema import FINAL_STATES, KEEP_DAYS, MAX_ATTEMPTS, QUEUE_LIMIT, SOURCE_ID, TTL_HOURS
from loomsift.scratch import checkpointed, free_name


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def since(df: DataFrame, as_of: Column, n: int, at: str = "created_at") -> DataFrame:
    """Rows of the last n hours."""
    return df.where(F.col(at) > as_of - hours(n))


def latest(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row of each key with the largest seq; ties keep one row. Sums before the shuffle, so hot keys are cheap."""
    rest = [c for c in df.columns if c not in (*keys, seq)]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("__row"), F.max(seq).alias(seq)).select(*keys, "__row.*", seq).select(*df.columns)


def last(df: DataFrame, seq: str) -> DataFrame:
    return df.orderBy(F.desc(seq)).limit(1)


def upserted(old: DataFrame, new: DataFrame, key: str = "uid", keep: tuple[str, ...] = ("source", "fetched_at"), touch: bool = True, seq: str | None = None) -> DataFrame:
    """New rows replace old ones of their key, but for the columns in ``keep``; without touch the time of use too.

    Several new rows of a key act in order of ``seq``: the first gives what is kept of a key that is new, the last the
    rest. Without seq, keys of new rows are taken to be unique.
    """
    if seq is not None:
        first = [F.min_by(F.struct(*keep), seq).alias("__first")] if keep else []
        rest = [c for c in old.columns if c not in (key, *keep)]
        new = new.groupBy(key).agg(*first, F.max_by(F.struct(*rest), seq).alias("__last")).select(key, *(["__first.*"] if keep else []), "__last.*")
    held = (*keep, *(() if touch else ("last_interaction_at",)))
    was = old.select(key, *[F.col(c).alias(f"__{c}") for c in held], F.lit(True).alias("__known"))
    merged = new.join(was, key, "left").select(*[F.when(F.col("__known"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in held else F.col(c) for c in old.columns])
    return old.join(new.select(key), key, "left_anti").select(*old.columns).unionByName(merged)


def appended(log: DataFrame, rows: DataFrame, as_of: Column, seq: str = "id") -> DataFrame:
    """Log rows with the next numbers (ordered by all columns) and a creation time.

    The numbering is a running count over partitions' totals: rows aren't gathered in one task.
    """
    begin = log.agg(F.coalesce(F.max(seq), F.lit(0)).alias("m")).first()["m"]
    cols = [c for c in log.columns if c not in (seq, "created_at")]
    part, at, shift = (free_name(c, log.columns) for c in ("part", "at", "shift"))
    # a count is given, so that adaptive execution leaves the partitions of both uses alone
    n = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*cols).repartitionByRange(n, *[F.col(c) for c in cols]).sortWithinPartitions(*cols).withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id())
    first = dealt.groupBy(part).agg(F.min(at).alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a partition
    numbered = dealt.join(F.broadcast(first.select(part, (before - F.col("first") + 1 + begin).alias(shift))), part).withColumn(seq, (F.col(at) + F.col(shift)).cast("bigint"))
    return log.unionByName(numbered.withColumn("created_at", as_of).select(*log.columns))


def expired(docs: DataFrame, as_of: Column, ttl: int = TTL_HOURS) -> DataFrame:
    """Rows not used for ttl hours, unless they reached a final state."""
    return docs.where((F.col("last_interaction_at") < as_of - hours(ttl)) & ~F.col("status").isin(*FINAL_STATES))


def purged(docs: DataFrame, as_of: Column, ttl: int = TTL_HOURS) -> tuple[DataFrame, DataFrame]:
    """What remains, and PURGED log rows."""
    gone = expired(docs, as_of, ttl)
    return docs.join(gone.select("uid"), "uid", "left_anti"), gone.select("uid", F.lit("PURGED").alias("event_type"), F.lit("").alias("detail"))


def retained(events: DataFrame, dlq: DataFrame, as_of: Column, days: int = KEEP_DAYS) -> tuple[DataFrame, DataFrame]:
    """Events and failures without the old ones; failures that may be retried stay."""
    limit = as_of - hours(24 * days)
    return events.where(F.col("created_at") >= limit), dlq.where((F.col("created_at") >= limit) | F.col("retry_eligible"))


def queue(docs: DataFrame, limit: int = QUEUE_LIMIT) -> DataFrame:
    """The best queued rows: by score, then the earliest fetched, then uid."""
    return docs.where("status = 'queued'").orderBy(F.desc("rubric_score"), "fetched_at", "uid").limit(limit)


def degraded(docs: DataFrame) -> DataFrame:
    """Queued rows whose metadata were not analysed, best first."""
    return docs.where(F.col("tech_meta").isNull() & (F.col("status") == "queued")).orderBy(F.desc("rubric_score"), "uid")


def title_index(docs: DataFrame, seq: str) -> DataFrame:
    """title_normalized and the uid of its last row, of rows that are not expired."""
    return docs.where("status <> 'expired'").groupBy("title_normalized").agg(F.max_by("uid", seq).alias("uid"))


def tier_index(docs: DataFrame, payload: str | None = None) -> DataFrame:
    """uid and authority_tier; from a JSON payload, if its column is named."""
    tier = F.col("authority_tier") if payload is None else F.get_json_object(payload, "$.authority_tier").cast("int")
    return docs.select("uid", tier.alias("authority_tier"))


def held(docs: DataFrame, uids: DataFrame) -> DataFrame:
    """uid and whether a document of that uid is held, for each asked uid."""
    return uids.select("uid").distinct().join(docs.select("uid", F.lit(True).alias("held")).distinct(), "uid", "left").fillna(False, ["held"])


def looked_up(docs: DataFrame, uid: str) -> DataFrame:
    """The document of a uid, if there is one; the filter reaches the scan."""
    return docs.where(F.col("uid") == uid).limit(1)


def history(rows: DataFrame, uid: str, verified_only: bool = False) -> DataFrame:
    """A document's verdicts or facts in order of time; of facts, the verified ones if asked for."""
    mine = rows.where(F.col("uid") == uid)
    return (mine.where("verified = 1") if verified_only else mine).orderBy("created_at", "id")


def abstract_only(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("status").isin("approved", "approved_local", "queued") & (F.trim(F.coalesce("full_text", F.lit(""))) == ""))


def invalid(docs: DataFrame) -> DataFrame:
    """Rows that break a rule of the record, with the names of the rules."""
    id_ok = F.lit(False)
    for source, pattern in SOURCE_ID.items():
        id_ok = id_ok | ((F.col("source") == source) & F.col("source_id").rlike(pattern))
    rules = {
        "source_id": ~F.coalesce(id_ok, F.lit(False)),
        "uid": F.coalesce(F.col("uid") != F.concat_ws(":", "source", "source_id"), F.lit(True)) & ~F.coalesce(F.col("uid") == F.col("source_id"), F.lit(False)),
        "authority_tier": F.coalesce(F.col("authority_tier") < 1, F.lit(True)),
        "critique_questions": F.coalesce(F.size("critique_questions") != 2, F.lit(False)),
    }
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return docs.withColumn("broken", broken).where(F.size("broken") > 0)


def listed_failures(dlq: DataFrame, retry_only: bool = False) -> DataFrame:
    return (dlq.where("retry_eligible") if retry_only else dlq).orderBy("created_at", "id")


def permanent_failures(dlq: DataFrame) -> DataFrame:
    return dlq.where(~F.col("retry_eligible") & (F.col("attempts") >= MAX_ATTEMPTS))


def retryable(dlq: DataFrame, reachable: DataFrame | None = None) -> DataFrame:
    """Document failures that may be retried; of reachable sources only, if a table of source is given."""
    rows = dlq.where(F.col("retry_eligible") & ~F.ilike("uid", F.lit("%:batch")))
    return rows if reachable is None else rows.withColumn("source", F.substring_index("uid", ":", 1)).join(reachable, "source", "left_semi").drop("source")


def bumped(dlq: DataFrame, failed: DataFrame) -> DataFrame:
    """One more attempt for entries (by id) that failed again; at the limit they may not be retried."""
    again = free_name("again", dlq.columns)
    mark = failed.select("id", F.lit(True).alias(again))
    n = F.col("attempts") + F.when(F.col(again), 1).otherwise(0)
    return dlq.join(mark, "id", "left").withColumn("attempts", n.cast("int")).withColumn("retry_eligible", F.col("retry_eligible") & ~(F.coalesce(again, F.lit(False)) & (F.col("attempts") >= MAX_ATTEMPTS))).select(*dlq.columns)


def still_failing(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.join(after.select("id"), "id", "left_semi")


def aged_out(payloads: DataFrame, as_of: Column, days: int = KEEP_DAYS) -> DataFrame:
    """Quarantined payloads (by day) young enough to stay."""
    return payloads.where(F.col("day") >= F.to_date(as_of - hours(24 * days)))


def ranked_ids(found: DataFrame, per_source: int) -> DataFrame:
    """A plan of ids: the first query (query_no, then pos) that finds an id owns it; the first per_source ids of each source.

    found: source, query_no, query, pos, id.
    """
    owner = found.groupBy("source", "id").agg(F.min(F.struct("query_no", "pos", "query")).alias("by"))
    rank = F.row_number().over(Window.partitionBy("source").orderBy("by.query_no", "by.pos", "id"))
    return owner.withColumn("rank", rank).where(F.col("rank") <= per_source).select("source", "id", "rank", F.col("by.query").alias("found_by_query"))


def pieces_of(outcomes: DataFrame) -> tuple[DataFrame, str]:
    """The rows, dealt out by ranges of (source, seq), and the name of the added column with their range's number.

    Stored, so that ranges stay as they are. A source of many rows is many pieces, in order.
    """
    piece = free_name("piece", outcomes.columns)
    return checkpointed(outcomes.repartitionByRange("source", "seq").withColumn(piece, F.spark_partition_id())), piece


def broken_circuits(outcomes: DataFrame, limit: int) -> DataFrame:
    """What is left of each source's ordered outcomes (source, seq, kind) when it is cut after ``limit`` failures in a row.

    kind: ok, transient or permanent; only ok resets the count. The row that breaks the circuit is kept and marked. seq is
    unique in a source; extra columns are kept, but for one named breaks.

    A scan in segments: each piece of a source folds to what it does to a run that comes in (the places of its first
    ``limit`` failures before any ok, the first break after one, and the run that goes out); the pieces of a source, at most
    one a partition, are chained; the piece that holds the break is cut there, and those behind it go.
    """
    rows, piece = pieces_of(outcomes)
    few = rows.select("source", "seq", "kind", F.col(piece).alias("piece"))
    w = Window.partitionBy("source", "piece").orderBy("seq")
    few = few.withColumn("oks", F.sum((F.col("kind") == "ok").cast("int")).over(w))
    failed = F.col("kind") == "transient"
    few = few.withColumn("fails", F.sum(failed.cast("int")).over(Window.partitionBy("source", "piece", "oks").orderBy("seq")))
    folds = few.groupBy("source", "piece").agg(
        F.array_sort(F.collect_list(F.when((F.col("oks") == 0) & failed & (F.col("fails") <= limit), F.col("seq")))).alias("first"),
        F.min(F.when((F.col("oks") > 0) & failed & (F.col("fails") == limit), F.col("seq"))).alias("inner"),
        F.max("oks").alias("oks"), F.max_by("fails", "seq").alias("last"),
    )
    seq = outcomes.schema["seq"].dataType
    chained = folds.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("piece", "first", "inner", "oks", "last"))).alias("folds"))

    def step(x: Column, f: Column) -> Column:
        stop = F.coalesce(x["stop"], F.get(f["first"], F.lit(limit - 1) - x["run"]), f["inner"])
        run = F.when(f["oks"] == 0, x["run"] + f["last"]).otherwise(f["last"])
        return F.struct(F.least(run, F.lit(limit - 1).cast("long")).cast("int").alias("run"), stop.alias("stop"))  # at the limit it has stopped

    begin = F.struct(F.lit(0).alias("run"), F.lit(None).cast(seq).alias("stop"))
    stops = chained.select("source", F.explode("folds.piece").alias(piece), F.aggregate("folds", begin, step)["stop"].alias("breaks"))
    kept = rows.drop("breaks").join(stops, ["source", piece]).where(F.col("breaks").isNull() | (F.col("seq") <= F.col("breaks")))
    return kept.withColumn("breaks", F.coalesce(F.col("seq") == F.col("breaks"), F.lit(False))).select(*[c for c in outcomes.columns if c != "breaks"], "breaks")
