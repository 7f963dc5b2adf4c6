"""Substring dedup with prefix-partitioned suffix trees.

A suffix is the text from one word on. Of the tree of all documents' suffixes only the inner nodes at a depth of
``WINDOW`` words or more matter: a node of two documents is a repeat, and a suffix that lies in such a node with a smaller
doc_id loses its first ``WINDOW`` words. (What its deeper nodes share beyond is lost by the suffixes that follow.)

1. Documents with equal words are one class, handled by its least doc_id: the others lose all words.
2. Most suffixes hang alone above that depth. They are left out before anything is dealt: each window's least hashed
   ``SEED``-word run is its seed, equal windows have equal seeds, and a window whose seed is in one document only is
   in no node of two. What is left are runs of words that may repeat.
3. Variable-length prefixes part these suffixes into groups of at most ``GROUP``: prefixes (1, 2, 4, 8 words) held by
   more are replaced by longer ones. A full window held by more is one node: its least doc_id is a sum of partial results.
4. Each group's suffixes are sorted (Spark's external sort, so a group is never held in memory): by the hash of the first
   WINDOW words, then by ``AHEAD`` further words one by one. Neighbours' common prefixes give the subtree's inner nodes
   of depth WINDOW to WINDOW + AHEAD, with their leaves, least doc_id, and whether the words before differ (a maximal
   repeat). A longer repeat is a row of nodes of the greatest depth, each one word further on.

Prefixes are counted in 2**``SLOTS`` slots of their hash, so that what tasks are told of them has a fixed size: a bit a slot
and level. Words are compared by hashes: whole documents by SHA-256 and windows by 128 bits, which decide what is removed;
the words after a window by 16, which only shape the nodes that :func:`maximal_repeats` reports.

Defined results: a null, empty or short text has no window and loses nothing; a very long text is cut into its runs; rows
with a null doc_id neither lose words nor take them from others; repeated rows of a doc_id don't take words from each
other (the id isn't smaller); an empty table gives no rows; extra columns are ignored by :func:`digest` and kept by
:func:`remove`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common
from loomsift.llm.secrets import with_text

WINDOW, SEED, GROUP, PREFIXES, AHEAD = 13, 5, 200_000, (1, 2, 4, 8), 7
SEED_2 = 0x9E3779B9  # of the second hash
#: A seed's rows are dealt to SALTS tasks if it has more than 1 / SHARES of all rows, and HEAVY: so many can be.
SHARES, HEAVY, SALTS, SLOTS = 10_000, 20_000, 64, 26
#: Runs that a Python task works on at once.
RUNS = 10_000
EMPTY = hashlib.sha256(b"").hexdigest()


def key_of(ws: list[bytes]) -> int:
    """A signed 64-bit hash of a word sequence. It tells rows of one doc_id apart, no more."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(ws))).astype(np.int64))


def seed_places(h: np.ndarray, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The seed hash of each place, and for each window the place of its seed (leftmost of equals)."""
    seeds = common.window_hashes(h, seed)
    n = len(h) - window + 1
    if n <= 0:
        return seeds, np.empty(0, np.int64)
    at = np.zeros(n, np.int64)
    least = seeds[:n].copy()
    for j in range(1, window - seed + 1):
        x = seeds[j : j + n]
        less = x < least
        at[less] = j
        np.minimum(least, x, out=least)
    return seeds, at + np.arange(n)


def _rows(columns: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    like = pa.schema(columns)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), like, strict=True)] if rows else [pa.array([], f.type) for f in like], schema=like)


def light(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_words and SHA-256 of the joined words, a row for each document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string())]
        for b in common.sliced(batches):
            out = []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ws = common.words(t)
                out.append((i, key_of(ws), len(ws), hashlib.sha256(b" ".join(ws)).hexdigest()))
            yield _rows(cols, out)

    return docs.mapInArrow(of, "doc_id long, key long, n_words long, sha string")


def seeds(docs: DataFrame, first: DataFrame) -> DataFrame:
    """doc_id, key, and the seeds and their places of each class's first document (``first``: doc_id and key)."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [("doc_id", pa.int64()), ("key", pa.int64()), ("seeds", pa.binary()), ("places", pa.binary())]
        for b in common.sliced(batches):
            out = []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ws = common.words(t)
                if len(ws) >= WINDOW and i is not None:
                    found_, at = seed_places(common.hashes(ws))
                    at = np.unique(at)
                    out.append((i, key_of(ws), found_[at].astype("<u8").tobytes(), at.astype("<i4").tobytes()))
            yield _rows(cols, out)

    made = docs.mapInArrow(gathered, "doc_id long, key long, seeds binary, places binary")
    return made.join(first, ["key", "doc_id"], "left_semi").select("doc_id", "key", "seeds", "places")


def seed_rows(packed: DataFrame) -> DataFrame:
    """seed, doc_id, key, pos: a row a seed."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            n = [len(x) // 4 for x in b.column("places").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(b"".join(b.column("seeds").to_pylist()), "<i8")),
                    pa.array(np.repeat(b.column("doc_id").to_numpy(), n)),
                    pa.array(np.repeat(b.column("key").to_numpy(), n)),
                    pa.array(np.frombuffer(b"".join(b.column("places").to_pylist()), "<i4")),
                ],
                names=["seed", "doc_id", "key", "pos"],
            )

    return packed.mapInArrow(flat, "seed long, doc_id long, key long, pos int")


def repeated_seeds(packed: DataFrame) -> DataFrame:
    """doc_id, key and places of the seeds that two documents hold. A heavy seed's rows are dealt to SALTS tasks."""
    rows = seed_rows(packed)
    twice = common.stored(rows.groupBy("seed").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("seed", "n"), "substring-seeds")
    total = twice.agg(F.sum("n")).first()[0] or 0
    heavy = F.broadcast(twice.where(F.col("n") > max(HEAVY, total // SHARES)).select("seed", F.lit(True).alias("heavy")))  # fewer than SHARES
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(heavy, "seed", "left").withColumn("salt", salt).drop("heavy")
    right = twice.select("seed").join(heavy, "seed", "left").select("seed", F.explode(salts).alias("salt"))
    return left.join(right, ["seed", "salt"]).groupBy("doc_id", "key").agg(F.collect_list("pos").alias("places"))


def repeated_runs(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Runs of words made of windows whose seed is in hits: doc_id, key, start, number of windows, and words."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("words", pa.binary())]
        for b in common.sliced(batches):
            out = []
            for i, key, t, places in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "text", "places")), strict=True):
                ws = common.words(t)
                if key_of(ws) != key:  # another row with this doc_id
                    continue
                _, at = seed_places(common.hashes(ws))
                begin = np.flatnonzero(np.isin(at, np.array(places)))
                for run in np.split(begin, np.flatnonzero(np.diff(begin) > 1) + 1):
                    if len(run):
                        out.append((i, key, int(run[0]), len(run), b" ".join(ws[run[0] : run[-1] + WINDOW])))
            yield _rows(cols, out)

    return docs.join(hits, "doc_id").mapInArrow(of, "doc_id long, key long, start int, n int, words binary")


class Runs:
    """The words of a batch of runs as one array of hashes, and where in it each run's suffixes begin."""

    def __init__(self, texts: list[bytes]) -> None:
        each = [x.split() for x in texts]
        flat = [w for ws in each for w in ws]
        self.h = common.hashes(flat)
        #: a second hash of each word, for the other 64 bits of a window
        self.h2 = np.fromiter((xxhash.xxh3_64_intdigest(w, SEED_2) for w in flat), np.uint64, len(flat))
        n = np.array([len(ws) for ws in each], np.int64)
        self.n = np.maximum(0, n - WINDOW + 1)
        first = np.cumsum(self.n) - self.n
        #: place of each suffix in its run, and in h
        self.inside = np.arange(int(self.n.sum())) - np.repeat(first, self.n)
        self.at = self.inside + np.repeat(np.cumsum(n) - n, self.n)

    def codes(self) -> np.ndarray:
        """16 bits, not 0, of each of the AHEAD words after each suffix's window, and of the word before; 0 outside its run."""
        code = word_codes(self.h)
        left = np.repeat(self.n, self.n) - 1 - self.inside  # windows of the run after this one
        out = np.zeros((len(self.at), AHEAD + 1), ">u2")
        for j in range(AHEAD):
            some = left > j
            out[some, j] = code[self.at[some] + WINDOW + j]
        some = self.inside > 0
        out[some, AHEAD] = code[self.at[some] - 1]
        return out

    def prefix(self, k: int) -> np.ndarray:
        """A hash of the first k words of each suffix."""
        return common.window_hashes(self.h, k)[self.at]

    def check(self) -> np.ndarray:
        """The other 64 bits of each suffix's window."""
        return common.window_hashes(self.h2, WINDOW)[self.at]


def word_codes(h: np.ndarray) -> np.ndarray:
    return np.maximum(h >> np.uint64(48), np.uint64(1)).astype(">u2")


class Heavy:
    """Slots of prefix hashes that hold more suffixes than a group, a bit each: at most 2**SLOTS bits a level."""

    def __init__(self, slots: np.ndarray) -> None:
        self.some = bool(len(slots))
        marks = np.zeros(1 << SLOTS if self.some else 0, bool)
        marks[slots] = True
        self.bits = np.packbits(marks, bitorder="little")

    def of(self, prefix: np.ndarray) -> np.ndarray:
        if not self.some:
            return np.zeros(len(prefix), bool)
        at = slots(prefix)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def slots(prefix: np.ndarray) -> np.ndarray:
    return (prefix >> np.uint64(64 - SLOTS)).astype(np.int64)


def prefixes(runs: DataFrame, group: int = GROUP) -> list[Heavy]:
    """For each prefix length, and last for the whole window, the slots held by too many suffixes for one group."""
    heavy: list[Heavy] = []
    lengths = (*PREFIXES, WINDOW)
    for n, k in enumerate(lengths):
        if heavy and not heavy[-1].some:
            heavy.append(heavy[-1])
            continue
        above, shorter = (heavy[-1], lengths[n - 1]) if heavy else (None, 0)

        def of(batches: Iterator[pa.RecordBatch], k: int = k, above: Heavy | None = above, shorter: int = shorter) -> Iterator[pa.RecordBatch]:
            for b in common.sliced(batches, RUNS):
                x = Runs(b.column("words").to_pylist())
                mine = x.prefix(k)
                if above is not None:
                    mine = mine[above.of(x.prefix(shorter))]
                u, m = np.unique(slots(mine), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(m, pa.int64())], names=["slot", "n"])

        counts = runs.select("words").mapInArrow(of, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") > group)
        heavy.append(Heavy(counts.select("slot").toArrow().column("slot").to_numpy()))
    return heavy


def suffixes(runs: DataFrame, heavy: list[Heavy], hot: bool) -> DataFrame:
    """One row a suffix: doc_id, key, pos and two hashes of the window, of the slots held by more than a group (hot) or of
    the others; these with a label (of their group's prefix), and the second hash followed by 16-bit codes of the AHEAD
    words after the window and of the word before it (0: none, or beyond what may repeat)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches, RUNS):
            x = Runs(b.column("words").to_pylist())
            whole = x.prefix(WINDOW)
            mine = heavy[-1].of(whole) == hot
            doc, key = (np.repeat(b.column(c).to_numpy(), x.n)[mine] for c in ("doc_id", "key"))
            pos = (np.repeat(b.column("start").to_numpy(), x.n) + x.inside)[mine].astype(np.int32)
            cols = {"doc_id": pa.array(doc), "key": pa.array(key), "pos": pa.array(pos), "window": pa.array(whole[mine].view(np.int64))}
            if hot:
                cols["check"] = pa.array(x.check()[mine].view(np.int64))
            else:
                label, open_ = slots(whole), np.ones(len(whole), bool)
                for k, many in zip(PREFIXES, heavy, strict=False):
                    p = x.prefix(k)
                    done = open_ & ~many.of(p)
                    label[done] = slots(p[done])
                    open_ &= ~done
                cols["label"] = pa.array(label[mine].astype(np.int32))
                codes = np.hstack([x.check()[mine].astype(">u8").view(">u2").reshape(-1, 4), x.codes()[mine]])
                cols["codes"] = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * codes.shape[1]), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes).tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return runs.mapInArrow(of, "doc_id long, key long, pos int, window long, " + ("check long" if hot else "label int, codes binary"))


class Subtree:
    """The inner nodes of depth WINDOW and more over sorted suffixes, read from neighbours' common prefixes."""

    def __init__(self, window: np.ndarray, codes: np.ndarray, doc: np.ndarray) -> None:
        self.doc, self.left = doc, codes[:, 4 + AHEAD]
        check, ahead = codes[:, :4], codes[:, 4 : 4 + AHEAD]
        alike = (ahead[1:] == ahead[:-1]) & (ahead[1:] != 0)
        #: words that each suffix has in common with the one before it
        self.common = np.zeros(len(window), np.int64)
        same = (window[1:] == window[:-1]) & (check[1:] == check[:-1]).all(axis=1)
        self.common[1:] = np.where(same, WINDOW + np.cumprod(alike, axis=1).sum(axis=1), 0)

    def level(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each stretch of suffixes with so many first words in common begins, and each suffix's stretch."""
        new = self.common < depth
        return np.flatnonzero(new), np.cumsum(new) - 1

    def repeated(self) -> np.ndarray:
        """Marks the suffixes whose node of depth WINDOW holds a smaller doc_id. Deeper nodes are parts of these."""
        begin, stretch = self.level(WINDOW)
        return self.doc > np.minimum.reduceat(self.doc, begin)[stretch]

    def maximal(self) -> Iterator[tuple[int, int, int, int]]:
        """(depth, first suffix, suffixes, least doc_id) of the nodes that branch and whose words before differ."""
        for d in range(WINDOW, WINDOW + AHEAD + 1):
            begin, _ = self.level(d)
            n = np.diff(np.append(begin, len(self.doc)))
            inside = self.common.copy()
            inside[begin] = WINDOW + AHEAD + 1
            branches = np.minimum.reduceat(inside, begin) == d
            low, high = np.minimum.reduceat(self.left, begin), np.maximum.reduceat(self.left, begin)
            least = np.minimum.reduceat(self.doc, begin)
            for k in np.flatnonzero((n > 1) & branches & ((low == 0) | (low != high))).tolist():
                yield d, int(begin[k]), int(n[k]), int(least[k])


def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Subtree, pa.Table]]:
    """Sorted suffixes in parts that end with a window; a window's suffixes, at most a group, are never parted."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        window = b.column("window").to_numpy()
        cut = int(np.flatnonzero(window != window[-1])[-1]) + 1 if (window != window[-1]).any() else 0
        if not cut and held and held[-1].column("window")[-1].as_py() != window[0]:
            yield subtree(held)
            held = []
        if cut:
            yield subtree([*held, b.slice(0, cut)])
            held = []
        held.append(b.slice(cut))
    if held:
        yield subtree(held)


def subtree(rows: list[pa.RecordBatch]) -> tuple[Subtree, pa.Table]:
    t = pa.Table.from_batches(rows)
    codes = np.frombuffer(b"".join(t.column("codes").to_pylist()), ">u2").reshape(-1, 4 + AHEAD + 1)
    return Subtree(t.column("window").to_numpy(), codes, t.column("doc_id").to_numpy()), t


def grouped(runs: DataFrame, heavy: list[Heavy]) -> DataFrame:
    """The suffixes of windows that aren't hot, each group in one task and in order."""
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return suffixes(runs, heavy, False).repartition(n, "label").sortWithinPartitions("label", "window", "codes").drop("label")


def repeats(runs: DataFrame, heavy: list[Heavy]) -> DataFrame:
    """key, doc_id and pos of suffixes with a node that has a smaller doc_id too: WINDOW words are to go from there."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, t in subtrees(batches):
            yield from t.select(["key", "doc_id", "pos"]).filter(pa.array(tree.repeated())).combine_chunks().to_batches()

    cold = grouped(runs, heavy).mapInArrow(of, "key long, doc_id long, pos int")
    if not heavy[-1].some:
        return cold
    hot = suffixes(runs, heavy, True)
    node = hot.groupBy("window", "check").agg(F.min("doc_id").alias("least")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = hot.withColumn("salt", F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS)).cast("int"))
    return cold.unionByName(salted.join(node, ["window", "check", "salt"]).where(F.col("doc_id") > F.col("least")).select("key", "doc_id", "pos"))


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Light rows, each class's first doc_id by its words' SHA-256, and the runs that may repeat."""
    docs = docs.select("doc_id", "text")
    rows = common.stored(light(docs), "substring-light")
    first = rows.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW)).groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.first("key").alias("key"))
    packed = common.stored(seeds(docs, first.select("key", "doc_id")), "substring-places")
    hits = common.stored(repeated_seeds(packed), "substring-hits")
    return rows, first, common.stored(repeated_runs(docs, hits), "substring-runs")


def found(docs: DataFrame, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Light rows with their class's first doc_id; the windows to remove (their places), by doc_id and key."""
    rows, first, runs = candidates(docs)
    cuts = repeats(runs, prefixes(runs, group)).groupBy("doc_id", "key").agg(F.collect_list("pos").alias("cuts"))
    return rows.join(first.select("sha", F.col("doc_id").alias("first")), "sha", "left"), common.stored(cuts, "substring-cuts")


def maximal_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """A row for each maximal repeat of WINDOW words or more, among the first documents of all classes: words (of the
    greatest depth: at least so many), occurrences, least_doc_id, and one place: doc_id and pos."""
    _, _, runs = candidates(docs)
    heavy = prefixes(runs, group)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [(c, pa.int64()) for c in ("words", "occurrences", "least_doc_id", "doc_id", "pos")]
        for tree, t in subtrees(batches):
            pos = t.column("pos").to_numpy()
            yield _rows(cols, [(d, n, least, int(tree.doc[k]), int(pos[k])) for d, k, n, least in tree.maximal()])

    made = grouped(runs, heavy).mapInArrow(of, "words long, occurrences long, least_doc_id long, doc_id long, pos long")
    if heavy[-1].some:
        one = F.min(F.struct("doc_id", "pos"))
        hot = suffixes(runs, heavy, True).groupBy("window", "check").agg(F.count("*").alias("occurrences"), one.alias("at"))
        made = made.unionByName(hot.select(F.lit(WINDOW).cast("long").alias("words"), "occurrences", F.col("at.doc_id").alias("least_doc_id"), F.col("at.doc_id").alias("doc_id"), F.col("at.pos").cast("long").alias("pos")))
    return made


def removed(n: int, cuts: list) -> np.ndarray:
    """Mask of n words: those of the windows that begin at ``cuts``."""
    return common.covered(n, np.array(cuts, np.int64), WINDOW)


def digest(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, joined by one space."""
    rows, cuts = found(docs, group)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [("doc_id", pa.int64()), ("key", pa.int64()), ("n_kept", pa.int64()), ("kept_sha", pa.string())]
        for b in common.sliced(batches):
            out = []
            for i, key, t, c in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "text", "cuts")), strict=True):
                ws = common.words(t)
                if key_of(ws) == key:
                    kept = [w for w, gone in zip(ws, removed(len(ws), c).tolist(), strict=True) if not gone]
                    out.append((i, key, len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield _rows(cols, out)

    cut = docs.select("doc_id", "text").join(cuts, "doc_id").mapInArrow(of, "doc_id long, key long, n_kept long, kept_sha string").distinct()
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(cut, ["doc_id", "key"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_words") - F.coalesce("n_kept", "n_words")).alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )


def cut_text(text: str, gone: list[bool]) -> str:
    """The text without the words marked gone, each with the white space before it."""
    out, at = [], 0
    for m, g in zip(common.WORD.finditer(text), gone, strict=True):
        if not g:
            out.append(text[at : m.end()])
        at = m.end()
    new = "".join(out)
    return new.lstrip("\x20\x09\x0a\x0b\x0c\x0d") if gone and gone[0] else new


def remove(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """The documents with repeated words cut from text, and n_chars, if present, to match."""
    rows, cuts = found(docs, group)
    copies = rows.where(F.col("doc_id") > F.col("first")).select("doc_id", "key", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts")).distinct()
    found_by_id = common.free("cuts", docs.columns)
    by_id = copies.unionByName(cuts).groupBy("doc_id").agg(F.collect_list(F.struct("key", "cuts")).alias(found_by_id))
    names = docs.columns

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            new = []
            for t, found_ in zip(b.column(names.index("text")).to_pylist(), b.column(len(names)).to_pylist(), strict=True):
                if found_ and t:
                    ws = common.words(t)
                    key = key_of(ws)
                    for c in found_:
                        if c["key"] == key:
                            t = cut_text(t, [True] * len(ws) if c["cuts"] is None else removed(len(ws), c["cuts"]).tolist())
                            break
                new.append(t)
            yield with_text(pa.RecordBatch.from_arrays(b.columns[: len(names)], names=names), names, new)

    return docs.join(by_id, "doc_id", "left").select(*docs.columns, found_by_id).mapInArrow(of, docs.schema)
