"""LM scoring by context-tree weighting over bytes.

A text is its ASCII-lower-cased words joined by one space, and a line feed as its end. Each byte is eight binary
decisions; each decision (node of the byte's binary tree, 1..255) has a context tree over the ``DEPTH`` bytes before
it. A context's estimate is Krichevsky-Trofimov's, (n1 + 1/2) / (n0 + n1 + 1), and its weighted probability is
Pw = Pe / 2 + prod(Pw of its longer contexts) / 2. Given the training counts, the probability of a bit is the mix of
the estimates at depths 0..DEPTH on its context's path: a depth gets the share Pe / (2 Pw) of what the shallower ones
left. Code length per byte is -score * log2(10) / bytes.

Jobs: (1) counts of (DEPTH + 1)-byte runs and of words over all documents, and over the training ones, summed before
the shuffle; (2) the tree from its leaves up to contexts of ``DEALT`` bytes, in partitions by those bytes, so that a part
holds at most the runs of one such context; shorter contexts are sums over the longer ones' nodes, and those of one byte
(at most 256 * 255 rows) meet at the driver; (3) back from the top: what the shorter contexts give is joined to the nodes
of DEALT bytes, and these go to their partitions with the runs: a log probability for each run; (4) scores: the frequent
runs and words, at most ``HOT`` of each, are sent to all tasks; the others are joined by key. No count is capped, and runs
found only in held-out texts are evaluated too, at count 0.
Held out: crc32 of the doc_id's decimal text mod 7 is 2. Base: add-one unigram words.

Defined results: a null, empty or blank text is its end alone (one token); a very long text is counted and scored in
stretches, whole; a null doc_id counts as the empty text's crc32 (training); repeated rows count and score each for itself;
an empty table gives no rows; without any training text all estimates are 1/2 a bit; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common

DEPTH, DEALT, HOT, CHUNK, SOME, ROOM = 5, 3, 1 << 19, 40_000, 1_500_000, 1_000_000
END = b"\n"
WORD_KIND, RUN_KIND = 0, 1
MASK = [np.uint64((1 << (8 * d + 8)) - 1) for d in range(DEPTH + 1)]


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def tokens(text: str | None) -> list[bytes]:
    return [*common.ascii_lower(text).split(), END]


def runs(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The run of DEPTH + 1 bytes that ends at each byte of some texts, as numbers, and the bytes of each text."""
    raw = [b" ".join(t[:-1]) + END for t in texts]
    pad = END * DEPTH
    x = np.frombuffer(b"".join(pad + r for r in raw), np.uint8).astype(np.uint64)
    code = np.zeros(max(0, len(x) - DEPTH), np.uint64)
    for d in range(DEPTH + 1):
        code = (code << np.uint64(8)) | x[d : d + len(code)]
    n = np.array([len(r) for r in raw], np.int64)
    # drop the runs that end in the padding between texts
    keep = np.ones(len(code), bool)
    ends = np.cumsum(n + DEPTH)[:-1] - DEPTH
    for d in range(DEPTH):
        keep[ends + d] = False
    return code[keep], n


def _some(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The texts' tokens, some at a time: (first index, tokens)."""
    first, held, size = 0, [], 0
    for k, t in enumerate(texts):
        held.append(tokens(t))
        size += len(t or "")
        if size > SOME:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


class Sums:
    """Counts by key of one kind, summed inside a task; at most some ``ROOM`` keys are held."""

    def __init__(self, kind: int) -> None:
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, key: np.ndarray, train: np.ndarray) -> pa.RecordBatch | None:
        """Take keys and whether each is of a training text; what is full is given back."""
        for mine in (True, False):
            u, n = np.unique(key[train == mine], return_counts=True)
            self.parts.append((u, n * mine, n))
            self.size += len(u)
        if self.size < 2 * ROOM:
            return None
        self.parts = [self._joined()]
        self.size = len(self.parts[0][0])
        return self.take() if self.size > ROOM else None

    def _joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, train, every = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        return (key[first], *(np.add.reduceat(c[order], first) if len(key) else c for c in (train, every)))

    def take(self) -> pa.RecordBatch:
        key, train, every = self._joined()
        self.parts, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), self.kind, np.int8)), pa.array(key.view(np.int64)), pa.array(train), pa.array(every)], names=["kind", "key", "n_train", "n_all"])


def counts(docs: DataFrame) -> DataFrame:
    """kind, key, n_train and n_all of every word and run."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: Sums(k) for k in (WORD_KIND, RUN_KIND)}
        for b in common.sliced(batches):
            train = np.array([not held_out(i) for i in b.column("doc_id").to_pylist()], bool)
            for first, some in _some(b.column("text").to_pylist()):
                mine = train[first : first + len(some)]
                code, n = runs(some)
                flat = [w for t in some for w in t]
                for kind, key, each in ((WORD_KIND, common.hashes(flat), np.array([len(t) for t in some])), (RUN_KIND, code, n)):
                    if (full := sums[kind].add(key, np.repeat(mine, each))) is not None:
                        yield full
        for s in sums.values():
            if s.parts:
                yield s.take()

    rows = docs.mapInArrow(of, "kind byte, key long, n_train long, n_all long")
    return rows.groupBy("kind", "key").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log(gamma(x)) for x > 0: Stirling's series at x + 8."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of Krichevsky-Trofimov's probability of a block with these counts."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1) - math.log(math.pi)


class Level:
    """The nodes of one depth: key (context << 8 | decision), counts, log Pe and log Pw."""

    def __init__(self, key: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None) -> None:
        self.key, self.n0, self.n1 = key, n0, n1
        self.pe = log_kt(n0, n1)
        self.pw = self.pe if below is None else np.logaddexp(self.pe, below) - math.log(2)

    def share(self) -> np.ndarray:
        return np.exp(self.pe - self.pw - math.log(2))

    def one(self) -> np.ndarray:
        return (self.n1 + 0.5) / (self.n0 + self.n1 + 1)


def above(low: Level, d: int) -> tuple[Level, np.ndarray]:
    """The level of depth d over that of depth d + 1, and each lower node's place in it."""
    key, at = np.unique(low.key & MASK[d], return_inverse=True)
    total = [np.bincount(at, x, len(key)) for x in (low.n0, low.n1, low.pw)]
    return Level(key, *total), at


def lowest(code: np.ndarray, n: np.ndarray) -> tuple[Level, np.ndarray, np.ndarray]:
    """The deepest level of these runs; the node and the bit of each run's eight decisions."""
    k = np.arange(8, dtype=np.uint64)
    byte = code & np.uint64(255)
    decision = (np.uint64(1) << k) | (byte[:, None] >> (np.uint64(8) - k))
    bit = ((byte[:, None] >> (np.uint64(7) - k)) & np.uint64(1)).astype(bool)
    key, at = np.unique((code[:, None] & ~np.uint64(255)) | decision, return_inverse=True)
    at = at.reshape(bit.shape)
    each = np.repeat(n.astype(float), 8)
    n1 = np.bincount(at.ravel(), each * bit.ravel(), len(key))
    return Level(key, np.bincount(at.ravel(), each, len(key)) - n1, n1, None), at, bit


def context(key: str, n: int) -> Column:
    """The last n bytes before the last one (a decision or a byte) of a key."""
    return F.expr(f"shiftright({key}, 8) & {(1 << (8 * n)) - 1}")


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by part, in stretches of whole parts, of some CHUNK rows."""
    done: list[pa.RecordBatch] = []
    open_: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        part = b.column("part").to_numpy()
        if open_ and open_[-1].column("part")[0].as_py() != part[0]:
            done, open_ = done + open_, []
        other = np.flatnonzero(part != part[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            done, open_ = [*done, *open_, b.slice(0, cut)], []
        open_.append(b.slice(cut))
        if sum(x.num_rows for x in done) > CHUNK:
            yield pa.Table.from_batches(done)
            done = []
    if done or open_:
        yield pa.Table.from_batches(done + open_)


NODES = "key long, n0 double, n1 double, pw double"


def node_rows(level: Level, keep: np.uint64) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array((level.key & keep).view(np.int64)), pa.array(level.n0), pa.array(level.n1), pa.array(level.pw)], names=["key", "n0", "n1", "pw"])


def level_of(b: pa.RecordBatch | pa.Table) -> Level:
    """A level from the sums over its longer contexts."""
    key, n0, n1, below = (b.column(c).to_numpy() for c in ("key", "n0", "n1", "pw"))
    return Level(key.view(np.uint64), n0, n1, below)


def summed(nodes: DataFrame, d: int) -> DataFrame:
    """Sums of nodes by their contexts of d bytes."""
    return nodes.withColumn("key", F.expr(f"key & {int(MASK[d])}")).groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "pw")))


def log_probabilities(table: DataFrame) -> DataFrame:
    """key and value (log10 of the probability of its last byte after the others) of every run."""
    n_parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    zero = F.lit(0.0)
    run_rows = table.select("key", "n_train", context("key", DEALT).alias("part"))

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts(batches):
            level, _, _ = lowest(t.column("key").to_numpy().view(np.uint64), t.column("n_train").to_numpy())
            for d in range(DEPTH - 1, DEALT - 1, -1):
                level, _ = above(level, d)
            yield node_rows(level, MASK[DEALT])

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield node_rows(level_of(b), ~np.uint64(0))

    # levels[d]: nodes of contexts of d bytes; those below DEALT are sums over the ones above
    levels = {DEALT: common.stored(run_rows.repartition(n_parts, "part").sortWithinPartitions("part", "key").mapInArrow(up, NODES), "lm-nodes")}
    sums = {}
    for d in range(DEALT - 1, 0, -1):
        sums[d] = summed(levels[d + 1], d)
        levels[d] = sums[d].mapInArrow(weighted, NODES)
    top = level_of(sums[1].toArrow().sort_by("key"))
    root, at = above(top, 0)
    left = (1 - root.share())[at]
    mixed = (root.share() * root.one())[at] + left * top.share() * top.one()
    # by key of a one-byte context: what depths 0 and 1 give to a bit 1, and the weight that they leave
    given, rest = np.zeros(1 << 16), np.zeros(1 << 16)
    given[top.key.astype(np.int64)], rest[top.key.astype(np.int64)] = mixed, left * (1 - top.share())

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a level's nodes and all shorter ones give, and the weight they leave; of depth 2 from the arrays."""
        for b in batches:
            key, n0, n1, pw = (b.column(c).to_numpy() for c in ("key", "n0", "n1", "pw"))
            got, weight = (b.column(c).to_numpy() for c in ("given", "rest")) if "given" in b.schema.names else (x[(key & 0xFFFF)] for x in (given, rest))
            share = np.exp(log_kt(n0, n1) - pw - math.log(2))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(got + weight * share * (n1 + 0.5) / (n0 + n1 + 1)), pa.array(weight * (1 - share))], names=["key", "given", "rest"])

    out = levels[2].mapInArrow(handed, "key long, given double, rest double")
    for d in range(3, DEALT + 1):
        shorter = out.withColumnRenamed("key", "shorter")
        out = levels[d].withColumn("shorter", F.expr(f"key & {int(MASK[d - 1])}")).join(shorter, "shorter").drop("shorter").mapInArrow(handed, "key long, given double, rest double")
    nodes = out.select("key", F.lit(0).cast("long").alias("n_train"), context("key", DEALT).alias("part"), "given", "rest", F.lit(True).alias("is_node"))
    rows = nodes.unionByName(run_rows.withColumn("given", zero).withColumn("rest", zero).withColumn("is_node", F.lit(False)))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in parts(batches):
            key, n, is_node = t.column("key").to_numpy().view(np.uint64), t.column("n_train").to_numpy(), t.column("is_node").to_numpy()
            code = key[~is_node]
            level, node, bit = lowest(code, n[~is_node])
            lower, places = [level], []
            for d in range(DEPTH - 1, DEALT - 1, -1):
                level, at = above(level, d)
                lower.append(level)
                places.append(at)
            order = np.argsort(key[is_node])
            mine = order[np.searchsorted(key[is_node], lower[-1].key & MASK[DEALT], sorter=order)]
            got, weight = (t.column(c).to_numpy()[is_node][mine] for c in ("given", "rest"))
            for d, at in zip(range(len(lower) - 2, -1, -1), places[::-1], strict=True):
                got, weight = got[at], weight[at]
                if d:
                    share = lower[d].share()
                    got, weight = got + weight * share * lower[d].one(), weight * (1 - share)
            p1 = got + weight * lower[0].one()
            p = np.where(bit, p1[node], 1 - p1[node])
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(np.log10(np.maximum(p, 1e-300)).sum(axis=1))], names=["key", "value"])

    return rows.repartition(n_parts, "part").sortWithinPartitions("part", "key").mapInArrow(down, "key long, value double")


class Lookup:
    """A fixed table of numbers in two hash arrays; a key that finds no free place in either isn't in it."""

    def __init__(self, key: np.ndarray, value: np.ndarray, known: np.ndarray) -> None:
        self.bits = max(4, int(2 * max(1, len(key)) - 1).bit_length())
        self.keys = np.zeros((2, 1 << self.bits), np.uint64)
        self.used = np.zeros((2, 1 << self.bits), bool)
        self.value = np.zeros((2, 1 << self.bits))
        self.known = np.zeros((2, 1 << self.bits), bool)
        left = np.arange(len(key))
        for t in range(2):
            slot = self._slot(key[left], t)
            first, at = np.unique(slot, return_index=True)
            mine = left[at]
            self.keys[t, first], self.used[t, first], self.value[t, first], self.known[t, first] = key[mine], True, value[mine], known[mine]
            left = np.setdiff1d(left, mine)

    def _slot(self, key: np.ndarray, t: int) -> np.ndarray:
        return ((key * (common.BASE, common.MIX)[t]) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Value (0 if not found), known and found."""
        slot = self._slot(key, 0)
        found = self.used[0, slot] & (self.keys[0, slot] == key)
        value, known = np.where(found, self.value[0, slot], 0.0), found & self.known[0, slot]
        rest = np.flatnonzero(~found)
        slot = self._slot(key[rest], 1)
        yes = self.used[1, slot] & (self.keys[1, slot] == key[rest])
        value[rest], known[rest], found[rest] = np.where(yes, self.value[1, slot], 0.0), yes & self.known[1, slot], yes
        return value, known, found


def frequent(values: DataFrame, kind: int) -> Lookup:
    """The keys in the highest octave parts of n_all that hold at most HOT keys together."""
    mine = values.where(F.col("kind") == kind)
    part = F.floor(8 * F.log2("n_all"))
    least, total = None, 0
    for r in mine.groupBy(part.alias("part")).count().orderBy(F.desc("part")).collect():  # at most 512 rows
        total += r["count"]
        if total > HOT:
            break
        least = r["part"]
    got = mine.where(part >= least if least is not None else F.lit(False)).select("key", "value", "known").toArrow()
    return Lookup(got["key"].to_numpy().view(np.uint64), got["value"].to_numpy(), got["known"].to_numpy())


def stored_row() -> Column:
    """A number for each row of a stored table, the same at every reading: its file's, and its place there."""
    name = F.col("_metadata.file_name")
    task, file = (F.regexp_extract(name, p, 1).cast("long") for p in (r"part-(\d+)", r"c(\d+)\."))
    return F.shiftleft(task, 42) + F.shiftleft(file, 34) + F.col("_metadata.row_index")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, n_bytes, base_score, score and bits_per_byte (the code length)
    of each document."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    table = common.stored(counts(docs), "lm-counts")
    words = table.where(F.col("kind") == WORD_KIND)
    n, v = words.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.coalesce(F.sum((F.col("n_train") > 0).cast("long")), F.lit(0))).first()
    of_words = words.select("kind", "key", "n_all", F.log10((F.col("n_train") + 1) / F.lit(float(n + v + 1))).alias("value"), (F.col("n_train") > 0).alias("known"))
    of_runs = table.where(F.col("kind") == RUN_KIND)
    chances = common.stored(log_probabilities(of_runs), "lm-runs")
    of_runs = of_runs.join(chances, "key").select("kind", "key", "n_all", "value", F.lit(False).alias("known"))
    values = common.stored(of_words.unionByName(of_runs), "lm-values")
    hot = spark.sparkContext.broadcast([frequent(values, WORD_KIND), frequent(values, RUN_KIND)])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over frequent keys; the others with their number in the document."""
        like = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_bytes", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), *((f"{c}{k}", pa.list_(t)) for k in (0, 1) for c, t in (("key", pa.int64()), ("n", pa.int32())))])
        for b in common.sliced(batches):
            ids = b.column("doc_id").to_pylist()
            for begin, some in _some(b.column("text").to_pylist()):
                code, n_bytes = runs(some)
                each = np.array([len(t) for t in some])
                cols = {"doc_id": ids[begin : begin + len(some)], "n_tokens": each, "n_bytes": n_bytes}
                cols["held_out"] = [held_out(i) for i in cols["doc_id"]]
                for kind, key, n, name in ((WORD_KIND, common.hashes([w for t in some for w in t]), each, "base_score"), (RUN_KIND, code, n_bytes, "score")):
                    value, known, found = hot.value[kind].get(key)
                    doc = np.repeat(np.arange(len(some)), n)
                    cols[name] = np.bincount(doc, value, len(some))
                    if kind == WORD_KIND:
                        cols["n_known"] = np.bincount(doc, known, len(some)).astype(np.int64)
                    rest = np.flatnonzero(~found)
                    ends = np.searchsorted(doc[rest], np.arange(len(some) + 1))
                    made = [np.unique(key[rest[a:z]], return_counts=True) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                    cols[f"key{kind}"] = [u.view(np.int64) for u, _ in made]
                    cols[f"n{kind}"] = [m.astype(np.int32) for _, m in made]
                yield common.batch(cols, like)

    rows = common.stored(docs.mapInArrow(first, "doc_id long, held_out boolean, n_tokens long, n_known long, n_bytes long, base_score double, score double, key0 array<long>, n0 array<int>, key1 array<long>, n1 array<int>"), "lm-rows").withColumn("row", stored_row())
    lists = [rows.select("row", F.lit(k).cast("byte").alias("kind"), F.explode(F.arrays_zip(F.col(f"key{k}").alias("key"), F.col(f"n{k}").alias("n"))).alias("x")).select("row", "kind", "x.key", "x.n") for k in (0, 1)]
    rare = lists[0].unionByName(lists[1]).join(values.select("kind", "key", "value", "known"), ["kind", "key"])
    sums = rare.groupBy("row").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.col("value")).otherwise(0.0)).alias("base_rest"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.col("value")).otherwise(0.0)).alias("rest"),
        F.sum(F.when(F.col("known"), F.col("n").cast("long")).otherwise(0)).alias("known_rest"),
    )
    zero = F.lit(0.0)
    return rows.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known_rest", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), "n_bytes",
        (F.col("base_score") + F.coalesce("base_rest", zero)).alias("base_score"), (F.col("score") + F.coalesce("rest", zero)).alias("score"),
        (-(F.col("score") + F.coalesce("rest", zero)) * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
