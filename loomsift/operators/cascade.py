"""The order-dependent cascade of entity resolution in rounds, so that no component or title is one task's work.

What a document meets is told by the spans for which rows are held: from the place where a row was admitted to the place
where another superseded it. Given all spans, each document is decided by its uid and its title's like titles. The spans in
turn follow from the decisions. Rounds start from the staged rows' spans and decide anew until no span changes. By then the
first document is decided rightly, hence the second, and so on: there is one such state, that of the cascade run in order.

Titles are dealt into blocks of bounded size, like ones together as far as they fit. Within a block a round walks the
documents in order, so that what follows from each other there takes one round; titles of other blocks and uids are held as
the round before left them. So blocks decide how many rounds it takes, not what comes out.

Few documents of a title can change the state. Between two changes among a title and its like, only the first of the title's
documents of each tier can: a later one of a tier no better sees what that one saw, and did nothing. Of a title with many
documents a round walks those alone, so one with a third of all rows costs as many rows as it has tiers and changes; the
others are met with what the documents of their stretch between changes met.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.operators.dedup import similar
from loomsift.schema import TITLE_RATIO
from loomsift.scratch import checkpointed

#: Documents that a title has at most to be walked whole, and rows of a block, about.
FEW, BLOCK = 4096, 20_000
WALKED = "uid string, title string, tier int, seq long, stretch int, score double, m_uid string, m_tier int, m_batch int, m_seq long, m_apart boolean"
#: What a line of a block is: a document, a row held from the start, one of another block, or the end that another block puts to one.
ROW, WITHIN, APART, ENDED = range(4)


def _held_at(at: Column, span_at: Column, span_end: Column) -> Column:
    """Whether a row's span holds the place: admitted before it, and superseded there at the earliest."""
    return (span_at < at) & (span_end.isNull() | (span_end >= at))


def _free(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows whose uid isn't held where they come."""
    held = spans.select(F.col("uid").alias("h_uid"), F.col("at").alias("h_at"), F.col("end").alias("h_end"))
    return rows.join(held, (F.col("uid") == F.col("h_uid")) & _held_at(F.col("at"), F.col("h_at"), F.col("h_end")), "left_anti")


def _stretched(rows: DataFrame, spans: DataFrame, near: DataFrame) -> DataFrame:
    """The rows with the number of changes among their title and its like that come before them."""
    points = spans.select(F.col("title").alias("other"), F.explode(F.array("at", "end")).alias("point")).where("point.batch = 1")
    breaks = points.join(near.select("title", "other"), "other").groupBy("title").agg(F.array_sort(F.collect_set("point")).alias("points"))
    stretch = F.coalesce(F.size(F.filter("points", lambda p: p < F.col("at"))), F.lit(0))
    return rows.join(breaks, "title", "left").withColumn("stretch", stretch).drop("points")


def _changing(rows: DataFrame, spans: DataFrame, near: DataFrame) -> DataFrame:
    """The rows that may change the state: the first of each title, stretch between changes and tier. Titles that are like
    none, not even themselves, stand apart by uid."""
    free = _stretched(_free(rows, spans), spans, near)
    key = F.when(F.col("title") == "", F.col("uid")).otherwise(F.lit(""))
    return free.groupBy("title", key.alias("own"), "stretch", "tier").agg(F.min_by("uid", "at").alias("uid"), F.min("at").alias("at")).select("uid", "title", "tier", "at", "stretch")


def _blocks(rows: DataFrame, held: DataFrame, near: DataFrame) -> tuple[DataFrame, int]:
    """title, block, and many (more documents than are walked whole), of titles that are like some; and the number of blocks.

    Four steps of the least label among like titles bring most of what hangs together under one label; the titles of a label
    with more rows than a block's are dealt by hash.
    """
    edges = near.select("title", "other").unionByName(near.select(F.col("other").alias("title"), F.col("title").alias("other")))
    edges = edges.unionByName(near.select(F.col("other").alias("title"), "other")).distinct()
    label = edges.select("title", F.xxhash64("title").alias("label")).distinct()
    for _ in range(4):
        label = edges.join(label.withColumnRenamed("title", "other"), "other").groupBy("title").agg(F.min("label").alias("label"))
    counts = rows.select("title", F.lit(1).alias("n"), F.lit(0).alias("h")).unionByName(held.select("title", F.lit(0).alias("n"), F.lit(1).alias("h"))).groupBy("title").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    sized = checkpointed(label.join(counts, "title", "left").select("title", "label", (F.col("n") > FEW).alias("many"), (F.least("n", F.lit(FEW)) + F.col("h")).alias("size")).na.fill(False, ["many"]).na.fill(0, ["size"]))
    n = max(1, -(-(sized.agg(F.sum("size")).first()[0] or 0) // BLOCK))
    parts = sized.groupBy("label").agg(F.greatest(F.lit(1), F.ceil(F.sum("size") / BLOCK)).alias("parts"))
    part = F.pmod(F.xxhash64("title", F.lit(1)), F.col("parts"))
    return checkpointed(sized.join(parts, "label").select("title", F.pmod(F.xxhash64("label", part), F.lit(n)).cast("int").alias("block"), "many")), n


def _walk(rows: pa.Table, near: pa.Table) -> pa.Table:
    """Rows of a block in order, each against what is held: the held title that is most like its own (of equals the one held
    longest) and that title's last row."""
    like: dict[str, list[tuple[float, str]]] = {}
    for t, o, s in zip(*(near.column(c).to_pylist() for c in ("title", "other", "score")), strict=True):
        like.setdefault(t, []).append((-s, o))
    for x in like.values():
        x.sort()
    kinds, uid, title, tier, batch, seq, end_batch, end_seq, stretch = (rows.column(c).to_pylist() for c in ("kind", "uid", "title", "tier", "batch", "seq", "end_batch", "end_seq", "stretch"))
    place = list(zip(batch, seq, strict=True))
    # at one place a row is met before spans begin or end there
    steps = [(x, 0 if kind == ROW else 1, k) for k, (x, kind) in enumerate(zip(place, kinds, strict=True)) if kind != ENDED]
    steps += [(x, 2, k) for k, x in enumerate(zip(end_batch, end_seq, strict=True)) if x[0] is not None]
    live: dict[str, list[int]] = {}
    met: list[tuple[int, int | None, float | None]] = []
    for _, step, k in sorted(steps):
        mine = live.setdefault(title[k], [])
        if step == 1:
            mine.append(k)
        elif step == 2:
            mine[:] = [j for j in mine if place[j] != place[k]]
        else:
            best = m = None
            for score, other in like.get(title[k], ()):
                if best is not None and score > best[0]:
                    break
                held = live.get(other)
                if held and (best is None or place[held[0]] < best[1]):
                    best, m = (score, place[held[0]]), held[-1]
            met.append((k, m, -best[0] if best else None))
            if m is None or tier[k] < tier[m]:
                if m is not None:
                    live[title[m]].pop()
                mine.append(k)
    of = lambda x, i: None if i is None else x[i]
    out = [(uid[k], title[k], tier[k], seq[k], stretch[k], score, of(uid, m), of(tier, m), of(batch, m), of(seq, m), m is not None and kinds[m] == APART) for k, m, score in met]
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(MET), MET.types, strict=True)], schema=MET)


MET = pa.schema([(x.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]]) for x in WALKED.split(", ")])


def _walked(rows: DataFrame, within: DataFrame, apart: DataFrame, ended: DataFrame, near: DataFrame) -> DataFrame:
    """Rows (block, uid, title, tier, at, stretch) with score, m_uid, m_tier and m_at of what they meet, null where there is
    none, and m_apart, whether it is another block's. The others are spans under the block that is to know of them; near: pairs
    under the block of their title."""
    int_, long_ = F.lit(None).cast("int"), F.lit(None).cast("long")
    flat = lambda x, kind, *more: x.select("block", F.lit(kind).alias("kind"), "uid", "title", "tier", "at.batch", "at.seq", *more)
    end = (F.col("end.batch").alias("end_batch"), F.col("end.seq").alias("end_seq"), int_.alias("stretch"))
    every = flat(rows, ROW, int_.alias("end_batch"), long_.alias("end_seq"), "stretch")
    for x, kind in ((within, WITHIN), (apart, APART), (ended, ENDED)):
        every = every.unionByName(flat(x, kind, *end))
    met = every.groupBy("block").cogroup(near.groupBy("block")).applyInArrow(_walk, WALKED)
    at = F.struct(F.lit(1).alias("batch"), "seq")
    m_at = F.when(F.col("m_seq").isNotNull(), F.struct(F.col("m_batch").alias("batch"), F.col("m_seq").alias("seq")))
    return met.select("uid", "title", "tier", at.alias("at"), "stretch", "score", "m_uid", "m_tier", m_at.alias("m_at"), "m_apart")


def resolved(batch: DataFrame, staged: DataFrame, threshold: float = TITLE_RATIO, rounds: int = 200) -> DataFrame:
    """Each document of the batch in order of seq against the survivors of those before it: uid, seq, action, matched_uid,
    score, and took (the rows that it replaces, staged or not, nearest first).

    batch and staged: uid, title_normalized, authority_tier, seq (staged ones come first). Same uid: duplicate_id. Else
    the most similar title, of equals the one held longest, stands for its last row: supersedes if the document's tier
    is better (lower), else duplicate_fuzzy. Else new. A superseded row leaves the index.

    Places in the batch are distinct, and so are uids of staged rows; a null tier is the worst; empty and null titles are like
    none; an empty batch gives no rows. Raises if spans still change in the last round.
    """
    tier = F.coalesce(F.col("authority_tier"), F.lit(2**31 - 1))
    title = F.coalesce("title_normalized", F.lit(""))

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        return df.select("uid", title.alias("title"), tier.alias("tier"), F.struct(F.lit(kind).alias("batch"), F.col("seq").cast("long").alias("seq")).alias("at"))

    rows, old = checkpointed(shaped(batch, 1)), shaped(staged, 0)
    x = rows.select(F.col("title").alias("id"), "title").distinct()
    y = x.unionByName(old.select(F.col("title").alias("id"), "title")).distinct()
    near = checkpointed(similar(x, y, threshold).select(F.col("left_id").alias("title"), F.col("right_id").alias("other"), "score"))
    touched = old.join(near.select(F.col("other").alias("title")).distinct(), "title", "left_semi").unionByName(old.join(rows.select("uid"), "uid", "left_semi").select(*old.columns)).distinct()
    place = old.schema["at"].dataType
    start = checkpointed(touched.select("uid", "title", "tier", "at", F.lit(None).cast(place).alias("end")))
    blocks, n = _blocks(rows, start, near)
    spread = F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")  # of titles that are like none
    rows = checkpointed(rows.join(blocks, "title", "left").select("uid", "title", "tier", "at", F.coalesce("block", spread).alias("block"), F.coalesce("many", F.lit(False)).alias("many")))
    pairs = checkpointed(near.join(blocks.drop("many"), "title"))
    # what blocks see of other blocks' titles
    across = checkpointed(pairs.join(blocks.select(F.col("title").alias("other"), F.col("block").alias("others")), "other").where("block <> others").select("block", F.col("other").alias("title")).distinct())
    few, many = rows.where("not many"), rows.where("many").drop("block", "many")
    some = not many.isEmpty()
    within = start.join(blocks.drop("many"), "title")
    spans, count, ended = start, start.count(), within.where(F.lit(False))
    for _ in range(rounds):
        todo = _free(few, spans).withColumn("stretch", F.lit(None).cast("int")).drop("many")
        if some:
            todo = todo.unionByName(_changing(many, spans, near).join(blocks.drop("many"), "title"))
        met = checkpointed(_walked(todo, within, spans.join(across, "title"), ended, pairs))
        admitted = met.where(F.col("m_at").isNull() | (F.col("tier") < F.col("m_tier")))
        ends = met.where(F.col("tier") < F.col("m_tier")).groupBy(F.col("m_at").alias("at")).agg(F.min("at").alias("end"))
        now = checkpointed(start.drop("end").unionByName(admitted.select("uid", "title", "tier", "at")).join(ends, "at", "left").select(*start.columns))
        before, count = count, now.count()
        if count == before and now.exceptAll(spans).isEmpty():
            others = _stretched(_free(many, now), now, near) if some else None
            return _decided(rows, met, others)
        spans = now
        ended = spans.join(met.where("m_apart and tier < m_tier").groupBy(F.col("m_at").alias("at")).agg(F.min("at").alias("by")), "at").join(blocks.drop("many"), "title")
        ended = ended.withColumn("end", F.col("by"))
    raise RuntimeError(f"the cascade isn't settled after {rounds} rounds")


def _decided(rows: DataFrame, met: DataFrame, others: DataFrame | None) -> DataFrame:
    """All rows, given what the last round met: others are the rows of titles with many, which meet what their stretch does."""
    free = met.where("stretch is null").drop("stretch", "m_apart")
    if others is not None:
        stretches = met.where("stretch is not null").dropDuplicates(["title", "stretch"]).select("title", "stretch", "score", "m_uid", "m_tier", "m_at")
        free = free.unionByName(others.join(stretches, ["title", "stretch"], "left").drop("stretch"))
    free = checkpointed(free)
    better = F.col("tier") < F.col("m_tier")
    action = F.when(F.col("m_at").isNull(), "new").when(better, "supersedes").otherwise("duplicate_fuzzy")
    took = _chains(free.where(better).select("at", "m_at"))
    none = F.array().cast("array<struct<staged:boolean,seq:bigint>>")
    decided = free.join(took, "at", "left").select("uid", F.col("at.seq").alias("seq"), action.alias("action"), F.col("m_uid").alias("matched_uid"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("took", none).alias("took"))
    same = rows.join(free.select("at"), "at", "left_anti")
    return decided.unionByName(same.select("uid", F.col("at.seq").alias("seq"), F.lit("duplicate_id").alias("action"), F.col("uid").alias("matched_uid"), F.lit(100.0).alias("score"), none.alias("took")))


def _chains(steps: DataFrame) -> DataFrame:
    """at and took: all rows before it, nearest first. Tiers fall along a chain, so that one has as many rows as tiers."""
    steps = checkpointed(steps)
    found, last, depth = None, steps.select("at", F.col("m_at").alias("row")), 0
    while True:
        last = checkpointed(last)
        if last.isEmpty() and found is not None:
            break
        part = last.withColumn("depth", F.lit(depth))
        found = part if found is None else found.unionByName(part)
        last, depth = last.join(steps.select(F.col("at").alias("row"), F.col("m_at").alias("next")), "row").select("at", F.col("next").alias("row")), depth + 1
    row = F.struct((F.col("row.batch") == 0).alias("staged"), F.col("row.seq").alias("seq"))
    return found.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("depth", row.alias("row")))).alias("all")).select("at", F.transform("all", lambda r: r["row"]).alias("took"))
