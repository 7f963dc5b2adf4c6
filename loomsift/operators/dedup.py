"""Entity resolution: exact id, similar title, source authority.

Title similarity is the normalised Indel similarity, 100 * 2 * LCS / (len a + len b). Candidate pairs come from a
blocked join that loses no pair: two titles of ratio t or more differ in at most d = floor((1 - t) * (a + b))
characters, so of any k disjoint pieces of the one at least k - d stand unchanged in the other, at most d places away.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.schema import TITLE_RATIO, UNKNOWN_TIER

#: Ids that a row of :func:`pairs` has of a title, about.
PACK = 256


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of whole rows."""
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if not n else 200.0 * lcs(a, b) / n


def lcs_of_all(a: list[str], b: list[str]) -> np.ndarray:
    """The LCS lengths of many pairs, the first of each of at most 63 characters: the bits of :func:`lcs`, a pair a lane."""
    n = np.array([len(x) for x in a], np.uint64)
    left = np.array(a, dtype="U64").view(np.uint32).reshape(-1, 64)
    right = np.array(b, dtype=f"U{max(1, *map(len, b))}").view(np.uint32).reshape(len(b), -1)
    full = (np.uint64(1) << n) - np.uint64(1)
    row = full.copy()
    for c in right.T:  # strings are filled with zeros
        hit = row & full & np.packbits(left == c[:, None], axis=1, bitorder="little").view("<u8").ravel()
        row = ((row + hit) | (row - hit)) & full
    return n.astype(np.int64) - np.bitwise_count(row).astype(np.int64)


def indel_ratio(a: Column | str, b: Column | str) -> Column:
    """Of two columns of strings; null if one is."""

    def of(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.full(len(x), np.nan)
        pairs = [(k, v, w) if len(v) <= len(w) else (k, w, v) for k, (v, w) in enumerate(zip(x, y, strict=True)) if v is not None and w is not None]
        # long titles, and those with the character that fills numpy's strings, one by one
        lanes = [p for p in pairs if 0 < len(p[1]) < 64 and len(p[2]) < 256 and "\0" not in p[1] + p[2]]
        if lanes:
            at, v, w = (list(c) for c in zip(*lanes, strict=True))
            out[at] = 200.0 * lcs_of_all(v, w) / np.array([len(p) + len(q) for p, q in zip(v, w, strict=True)])
        done = {p[0] for p in lanes}
        for k, v, w in pairs:
            if k not in done:
                out[k] = ratio(v, w)
        return pd.Series(out).astype(object).where(~np.isnan(out), None)

    return F.pandas_udf(of, "double")(a, b)


def _edits(n: Column, threshold: float) -> Column:
    """Most insertions and deletions between a title of length n and one of ratio threshold or more."""
    # b <= a * t / (2 - t) inverted: a + b <= 2 a / t
    t = threshold / 100
    return F.floor((1 - t) * 2 * n / t + 1e-9).cast("int")


def _step(n: Column, threshold: float) -> Column:
    """The length of the pieces of a title of length n: edits + 1 of them fit in it; 0 if none does."""
    return F.floor(n / (_edits(n, threshold) + 1)).cast("int")


def _sketch(c: Column, q: int) -> Column:
    """64 bits, one set for each hashed run of q characters: an edit changes at most 2 * q - 1 of them."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - q + 1, F.lit(1))), lambda i: F.pmod(F.xxhash64(F.substring(c, i, F.lit(q))), F.lit(64)).cast("int"))
    bits = F.aggregate(runs, F.lit(0).cast("long"), lambda bits, k: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    return F.coalesce(bits, F.lit(0).cast("long"))  # never null, or Spark tells nulls apart below distinct, for each copy of a title


def _titles(df: DataFrame, name: str) -> DataFrame:
    """Distinct titles under a name, and their sketches."""
    x = df.select(F.col("title").alias(name)).where(F.col(name) != "").distinct()
    return x.withColumn(f"{name}1", _sketch(F.col(name), 1)).withColumn(f"{name}2", _sketch(F.col(name), 2))


def similar(left: DataFrame, right: DataFrame, threshold: float = TITLE_RATIO) -> DataFrame:
    """Pairs (left_id, right_id, score) of equal or similar titles. Both sides: id, title; the threshold is over 200 / 3.

    Distinct titles only are compared, so many copies of one title cost one. The left title is cut into pieces of one
    length, ``_step``; of its k pieces the k - edits - 1 that most right titles hold are left out, which loses no pair.
    The right title offers its runs of such lengths: rows in proportion to its length. Titles that meet in a piece are
    held against bounds on lengths, places and shared runs of characters before they become rows; those left are scored.
    """
    if threshold <= 200 / 3:
        raise ValueError("below two thirds, similar titles may have no piece in common")
    scored = matched(left, offered(right, threshold), threshold)
    return left.select(F.col("id").alias("left_id"), F.col("title").alias("x")).join(scored, "x").join(right.select(F.col("id").alias("right_id"), F.col("title").alias("y")), "y").select("left_id", "right_id", "score")


def pairs(rows: DataFrame, threshold: float = TITLE_RATIO, digits: int = 6) -> DataFrame:
    """Every two rows of equal or similar titles once: left_id < right_id, and score, rounded. rows: id, title.

    The pairs grow with the square of a title's copies, but only where they come out: the ids of a title are packs of some
    ``PACK``, what is joined and shuffled is two packs to a row, and the rows are dealt evenly to tasks before packs become pairs.
    """
    if threshold <= 200 / 3:
        raise ValueError("below two thirds, similar titles may have no piece in common")
    rows = rows.where(F.col("title") != "").select("id", "title")
    same = rows.select(F.col("title").alias("x"), F.col("title").alias("y"), F.lit(100.0).alias("score")).distinct()
    scored = matched(rows, offered(rows, threshold), threshold, once=True).unionByName(same)
    counts = rows.groupBy("title").agg(F.count("*").alias("n"))
    packs = rows.join(counts, "title").groupBy("title", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / PACK)).alias("pack")).agg(F.collect_list("id").alias("ids"))
    left, right = (packs.select(F.col("title").alias(t), F.col("pack").alias(f"{t}_pack"), F.col("ids").alias(f"{t}_ids")) for t in "xy")
    both = scored.join(left, "x").join(right, "y").where("x <> y or x_pack <= y_pack")
    both = both.select("x_ids", "y_ids", F.round("score", digits).alias("score"), ((F.col("x") == F.col("y")) & (F.col("x_pack") == F.col("y_pack"))).alias("one"))
    both = both.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    each = both.select("score", "one", "y_ids", F.explode("x_ids").alias("a")).select("score", "one", "a", F.explode("y_ids").alias("b"))
    # one pack has both orders of its pairs; of others each pair comes once, in any order
    return each.where("if(one, a < b, a <> b)").select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"), "score")


def _range(m: Column, threshold: float) -> tuple[Column, Column]:
    """The lengths that titles like one of length m may have."""
    t = threshold / 100
    return F.ceil(m * t / (2 - t) - 1e-9).cast("int"), F.floor(m * (2 - t) / t + 1e-9).cast("int")


def offered(right: DataFrame, threshold: float = TITLE_RATIO) -> DataFrame:
    """The runs of characters (y, y1, y2, size, at, run) by which distinct titles can be found: what an index keeps."""
    others, m = _titles(right, "y"), F.length("y")
    low, high = _range(m, threshold)
    steps = F.array_distinct(F.transform(F.sequence(F.greatest(F.lit(1), low), high), lambda k: _step(k, threshold)))
    # not explode, for which Spark tells rows without any apart likewise
    runs = others.withColumn("size", F.explode_outer(steps)).where("size <= length(y)").withColumn("at", F.explode_outer(F.sequence(F.lit(0), m - F.col("size"))))
    return runs.withColumn("run", F.expr("substring(y, at + 1, size)"))


def matched(left: DataFrame, runs: DataFrame, threshold: float = TITLE_RATIO, once: bool = False) -> DataFrame:
    """Distinct pairs of a left title and one that is offered: x, y and score; once: only those with x < y."""
    t = threshold / 100
    names, n, m, s = _titles(left, "x"), F.length("x"), F.length("y"), F.col("s")
    low, high = _range(m, threshold)
    held = runs.groupBy(F.col("run").alias("piece")).agg(F.count("*").alias("held"))
    cut = names.withColumn("s", _step(n, threshold)).withColumn("d", _edits(n, threshold)).withColumn("k", F.floor(n / s).cast("int"))
    cut = cut.withColumn("place", F.explode_outer(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda p: p * s))).withColumn("piece", F.expr("substring(x, place + 1, s)"))
    # pieces that no right title holds are the rarest of all: they come first among the edits + 1
    met = cut.join(held, "piece").groupBy("x", "x1", "x2", "s", "d", "k").agg(F.sort_array(F.collect_list(F.struct("held", "place", "piece"))).alias("pieces"))
    wanted = F.greatest(F.lit(0), F.col("d") + 1 - F.col("k") + F.size("pieces"))
    rare = met.withColumn("p", F.explode(F.slice("pieces", F.lit(1), wanted))).select("x", "x1", "x2", "d", "p.place", "p.piece")
    edits = F.floor((1 - t) * (n + m) + 1e-9)
    near = (
        (F.col("piece") == F.col("run")) & (F.abs(F.col("place") - F.col("at")) <= F.col("d")) & n.between(low, high)
        & (F.bit_count(F.col("x1").bitwiseXOR(F.col("y1"))) <= edits) & (F.bit_count(F.col("x2").bitwiseXOR(F.col("y2"))) <= 3 * edits)
    )
    if once:
        near = near & (F.col("x") < F.col("y"))
    found = rare.join(runs, near).select("x", "y").distinct()
    return found.withColumn("score", indel_ratio("x", "y")).where(F.col("score") >= threshold)


def decided(candidates: DataFrame, existing: DataFrame, threshold: float = TITLE_RATIO) -> DataFrame:
    """What becomes of each candidate against fixed staged rows: action, matched_uid and score.

    candidates: uid, title_normalized, authority_tier. existing: the same with seq and status.
    Same uid: duplicate_id. Else the most similar title (earliest seq among equals): supersedes if the candidate's
    tier is better (lower), else duplicate_fuzzy. Else new.
    """
    exact = candidates.join(existing.select("uid"), "uid", "left_semi").select("uid", F.lit("duplicate_id").alias("action"), F.col("uid").alias("matched_uid"), F.lit(100.0).alias("score"))
    rest = candidates.join(existing.select("uid"), "uid", "left_anti")
    live = existing.where("status <> 'expired'")
    index = live.groupBy(F.col("title_normalized").alias("title")).agg(F.max_by("uid", "seq").alias("id"), F.min("seq").alias("seq"))
    hits = similar(rest.select(F.col("uid").alias("id"), F.col("title_normalized").alias("title")), index.select("id", "title"), threshold)
    best = hits.join(index.select(F.col("id").alias("right_id"), "seq"), "right_id").groupBy(F.col("left_id").alias("uid")).agg(F.max(F.struct("score", (-F.col("seq")).alias("s"), "right_id")).alias("b"))
    best = best.select("uid", F.col("b.right_id").alias("matched_uid"), F.col("b.score").alias("score"))
    tiers = existing.select(F.col("uid").alias("matched_uid"), F.col("authority_tier").alias("__tier"))
    found = rest.select("uid", "authority_tier").join(best, "uid").join(tiers, "matched_uid", "left")
    better = F.col("authority_tier") < F.coalesce("__tier", F.lit(UNKNOWN_TIER))
    fuzzy = found.select("uid", F.when(better, "supersedes").otherwise("duplicate_fuzzy").alias("action"), "matched_uid", "score")
    new = rest.join(best.select("uid"), "uid", "left_anti").select("uid", F.lit("new").alias("action"), F.lit(None).cast("string").alias("matched_uid"), F.lit(0.0).alias("score"))
    return exact.unionByName(fuzzy).unionByName(new)


def merged(winners: DataFrame, rows: DataFrame) -> DataFrame:
    """Winners (with took) take over what they lack, and the uids, from the rows they replaced, which did so before.

    rows: staged, seq, uid, alternate_uids, abstract, authors, full_text. Winners without any are unchanged.
    """
    fields = ("uid", "alternate_uids", "abstract", "authors", "full_text")
    none = F.array().cast("array<string>")
    chain = winners.select(F.col("seq").alias("winner"), F.posexplode("took").alias("pos", "row")).select("winner", "pos", "row.staged", "row.seq")
    lost = chain.join(rows.select("staged", "seq", *fields), ["staged", "seq"]).groupBy("winner").agg(F.sort_array(F.collect_list(F.struct("pos", *fields)), asc=False).alias("__lost"))
    blank = {"abstract": lambda c: F.coalesce(c == "", F.lit(True)), "authors": lambda c: F.coalesce(F.size(c) == 0, F.lit(True)), "full_text": lambda c: F.coalesce(c == "", F.lit(True))}

    def over(get: Callable[[str], Column], loser: Column) -> dict[str, Column]:
        mine = F.coalesce(get("alternate_uids"), none)
        out = {"alternate_uids": F.when(F.array_contains(mine, loser["uid"]), mine).otherwise(F.concat(mine, F.coalesce(loser["alternate_uids"], none), F.array(loser["uid"])))}
        return out | {c: F.when(empty(get(c)), F.coalesce(loser[c], get(c))).otherwise(get(c)) for c, empty in blank.items()}

    def step(loser: Column, winner: Column) -> Column:
        new = over(lambda c: winner[c], loser)
        return F.struct(winner["pos"].alias("pos"), *[new.get(c, winner[c]).alias(c) for c in fields])

    x = winners.join(lost, F.col("seq") == F.col("winner"), "left").drop("winner")
    x = x.withColumn("__last", F.aggregate(F.slice("__lost", F.lit(2), F.greatest(F.size("__lost"), F.lit(0))), F.get("__lost", F.lit(0)), step))
    new = over(F.col, F.col("__last"))
    return x.select(*[F.when(F.col("__lost").isNull(), F.col(c)).otherwise(new[c]).alias(c) if c in new else F.col(c) for c in winners.columns])
