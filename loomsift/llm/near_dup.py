"""MinHash near-dedup with sequential Bayesian verification.

A text's set is its distinct 5-word shingles, as 64-bit hashes. Texts with equal sets are one node: their fingerprint of 64
bits, and another of 64 more that is made from other hashes of the shingles. Sets that agree in the first only are told apart
by a new node, so it takes 128 bits for two sets to be one without being compared.
1. Each node has BANDS * ROWS minima; ``BANDS`` bands of ``ROWS`` minima put nodes into buckets. Two sets of similarity
   0.75 share no bucket with probability (1 - 0.75**7)**64, one in ten thousand; of similarity 0.8, three in ten
   million. Bands are long, so texts that share only a common passage seldom meet. The minima are
   kept of nodes that share a bucket.
2. Candidate pairs are checked batch by batch of minima: after each the posterior (uniform prior) that the similarity
   reaches 0.75, given the matches so far, is bounded; pairs below ``MISS`` are pruned. On independent minima all
   batches together prune a pair of similarity 0.75 with probability 8e-7. Survivors are confirmed on their full
   sets, so no wrong link is made.
3. A bucket's pairs are never all made. Each node is first checked against one hub, the node of its buckets that meets
   most others in all of its own (the text that a group was copied from, if it is there); then buckets that still hold
   nodes of several components have further hubs from the largest of them; last, every pair that still matters (two
   components in one bucket, the smaller one's nodes against the others) is checked, block by block, with the full sets
   at hand, likeliest first and until the two components are linked. Pairs inside one component can add nothing, so no
   link between components is lost, and a group of n copies costs about n checks.
4. Components: large-star and small-star steps, as DataFrame aggregates and joins, until nothing changes.

Defined results: texts of any length are compared whole; a similarity of just 0.75 is a link; of nodes that tie as hubs or
mains the greatest is taken; null, empty and wordless texts have an empty set and are linked with nothing; texts of under five
words have their whole sequence as one shingle; rows with a null doc_id are linked with nothing and kept; rows with equal
doc_id share its component and are all kept if it is the least; an empty table gives no rows; extra columns are
ignored by :func:`components` and kept by :func:`keep`.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common

SHINGLE, BANDS, ROWS, BATCH = 5, 64, 7, 32
HASHES = BANDS * ROWS
#: Posterior below which a pair is pruned: 1e-6, dealt out over the batches.
MISS = 1e-6 / (HASHES // BATCH)
#: Links ask for 100 * intersection >= SHARE * union.
SHARE = 75
PIVOT_ROUNDS = 1
#: Nodes of a bucket that are held against each other at once: so many of other components, so many of all.
SMALL, LARGE = 128, 512
#: Shingles of a block's nodes together, a mean: so many that their sets take some 16 MB.
VALUES = 2_000_000


def shingles(text: str | None) -> tuple[np.ndarray, int]:
    """Sorted distinct shingle hashes of a text, and the sum of other hashes of these shingles (a signed long)."""
    ws = common.ascii_lower(text).split()
    if not ws:
        return np.empty(0, np.uint64), 0
    k = min(SHINGLE, len(ws))
    h = common.window_hashes(common.hashes(ws), k)
    at = np.argsort(h)
    h = h[at]
    first = np.concatenate([[True], h[1:] != h[:-1]])
    s, at = h[first], at[first]
    others = common.window_hashes(np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws)), k)
    return s, int(others[at].sum(dtype=np.uint64).astype(np.int64))


def fingerprint(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


@functools.lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    return r.integers(1, 1 << 62, HASHES, np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 62, HASHES, np.uint64)


def minima(s: np.ndarray) -> np.ndarray:
    """The least value of the set under each of HASHES multiply-shift hashes."""
    a, b = _multipliers()
    out = np.full(len(a), ~np.uint64(0))
    for k in range(0, len(s), 256):
        h = s[k : k + 256, None] * a
        h += b
        np.minimum(out, h.min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def bucket_hashes(low: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band and its minima; of one set, or of many (rows)."""
    x = low.reshape(*low.shape[:-1], BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * common.MIX, x.shape[:-1])
    for j in range(ROWS):
        h = common.mixed(h * common.BASE + x[..., j])
    return h


@functools.lru_cache(maxsize=1)
def least_matches() -> dict[int, int]:
    """After n minima, the fewest matches that leave P(similarity >= 0.75 | matches) at MISS or more.

    The posterior under a uniform prior is a beta distribution, integrated here on a grid.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            log = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n - m + 1) + m * np.log(grid) + (n - m) * np.log1p(-grid)
            if np.exp(log)[grid >= SHARE / 100].mean() * (1 - SHARE / 100) >= MISS:
                out[n] = m
                break
    return out


def survivors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two arrays of minima are not pruned; later batches look at the rows left only."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for n, fewest in least_matches().items():
        matches += (a[left, n - BATCH : n] == b[left, n - BATCH : n]).sum(axis=1)
        keep = matches >= fewest
        left, matches = left[keep], matches[keep]
    return left


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SHARE * (len(a) + len(b) - both)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two fingerprints of the set (null if it is empty) and buckets of each document."""
    like = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.int64()), ("other", pa.int64()), ("buckets", pa.binary())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            ids, n, prints, others, bands = b.column("doc_id"), [], [], [], []
            for i, t in zip(ids.to_pylist(), b.column("text").to_pylist(), strict=True):
                s, other = shingles(t)
                n.append(len(s))
                alone = not len(s) or i is None
                prints.append(None if alone else fingerprint(s))
                others.append(None if alone else other)
                bands.append(None if alone else bucket_hashes(minima(s)).tobytes())
            yield common.batch({"doc_id": ids, "n_shingles": n, "print": prints, "other": others, "buckets": bands}, like)

    return docs.mapInArrow(of, "doc_id long, n_shingles long, print long, other long, buckets binary")


def with_nodes(rows: DataFrame) -> DataFrame:
    """Rows with their node: the fingerprint, or a new one for sets that share it and differ in the other (but for the least)."""
    clash = rows.groupBy("print").agg(F.min("other").alias("least"), F.max("other").alias("most")).where("least <> most")
    if not clash.take(1):  # nearly always, short of some 10^9 different sets
        return rows.withColumn("node", F.col("print"))
    x = rows.join(clash.select("print", "least"), "print", "left")
    return common.stored(x.select(*rows.columns, F.when(F.col("other") > F.col("least"), F.xxhash64("print", "other")).otherwise(F.col("print")).alias("node")), "near-nodes")


def buckets(nodes: DataFrame) -> DataFrame:
    """bucket (64-bit hash of band and its minima) and node, BANDS rows a node."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            h = np.frombuffer(b"".join(b.column("buckets").to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.repeat(b.column("node").to_numpy(), BANDS))], names=["bucket", "node"])

    return nodes.select("node", "buckets").mapInArrow(of, "bucket long, node long")


def _stacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def pruned(pairs: DataFrame, minima_of: DataFrame) -> DataFrame:
    """The pairs (a, b) left after looking at their minima batch by batch."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            yield b.select(["a", "b"]).take(pa.array(survivors(_stacked(b.column("ma")), _stacked(b.column("mb")))))

    x = pairs.join(minima_of.toDF("a", "ma"), "a").join(minima_of.toDF("b", "mb"), "b").select("a", "b", "ma", "mb")
    return x.mapInArrow(of, "a long, b long")


def some_links(i: np.ndarray, j: np.ndarray, comp: np.ndarray, matches: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Of pairs of rows (i, j) those whose full sets are linked; of i with each component at least one, if there is one.

    The likeliest come first. Once i is linked with a component, its other pairs with that can add nothing.
    """
    out: tuple[list[int], list[int]] = ([], [])
    order = np.lexsort((-matches, i))
    i, j = i[order], j[order]
    for mine in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1) if len(i) else ():
        own, rest = sets[i[mine[0]]], j[mine]
        while len(rest):
            some = rest[:64]
            flat = np.concatenate([sets[k] for k in some])
            hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            size = np.array([len(sets[k]) for k in some])
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
            found = some[100 * both >= SHARE * (len(own) + size - both)]
            _, first = np.unique(comp[found], return_index=True)
            out[0].extend([int(i[mine[0]])] * len(first))
            out[1].extend(found[first].tolist())
            rest = rest[64:]
            rest = rest[~np.isin(comp[rest], comp[found])]
    return out


def remainder(mixed: DataFrame, whole: DataFrame) -> DataFrame:
    """Links (a, b) between nodes of two components in a bucket, of which one is not the main one.

    Every such pair that its minima don't prune is verified on its full sets, until the node is linked with the other's
    component. A bucket's other nodes are cut into blocks of some SMALL, all its nodes into blocks of some LARGE, fewer if
    their sets are large; a task holds one block of each, so a group of any size is bounded there, and pairs are never
    rows. A pair is looked at in the first of the buckets that its nodes share.
    """
    other = F.col("comp") != F.col("main")
    blocks = lambda some, n, values: F.ceil(F.greatest(F.count_if(some) / n, F.sum(F.when(some, F.col("n_shingles")).otherwise(0)) / values)).cast("int")
    size = mixed.groupBy("bucket").agg(blocks(other, SMALL, VALUES).alias("ss"), blocks(F.lit(True), LARGE, VALUES).alias("ll"))
    x = mixed.select("bucket", "node", "comp", (~other).alias("is_main")).join(size, "bucket")
    block = F.pmod(F.xxhash64("node"), F.lit(1 << 20)).cast("int")
    every = F.sequence(F.lit(0), F.col("ll") - 1), F.sequence(F.lit(0), F.col("ss") - 1)
    small = x.where(~F.col("is_main")).select("bucket", F.pmod(block, "ss").alias("s"), F.explode(every[0]).alias("l"), F.lit(0).alias("side"), "node", "comp", "is_main")
    large = x.select("bucket", F.explode(every[1]).alias("s"), F.pmod(block, "ll").alias("l"), F.lit(1).alias("side"), "node", "comp", "is_main")
    n = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small.unionByName(large).join(whole, "node").repartition(n, "bucket", "s", "l").sortWithinPartitions("bucket", "s", "l", "side")

    def held(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        side, node, comp, main = (t.column(c).to_numpy() for c in ("side", "node", "comp", "is_main"))
        low = _stacked(t.column("minima").combine_chunks())
        i, j = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        want = (comp[i][:, None] != comp[j]) & (main[j] | (node[i][:, None] < node[j]))
        i, j = (v[k] for v, k in zip((i, j), np.nonzero(want), strict=True))
        left = np.concatenate([np.empty(0, np.int64), *(k + survivors(low[i[k : k + 20_000]], low[j[k : k + 20_000]]) for k in range(0, len(i), 20_000))])
        i, j = i[left], j[left]
        # in the first bucket that both are in, and in no later one
        same = low[i] == low[j]
        band = same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
        here = bucket_hashes(low)[i, band] == np.uint64(np.int64(t.column("bucket")[0].as_py()).astype(np.uint64))
        sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
        a, b = (node[k] for k in some_links(i[here], j[here], comp, same[here].sum(axis=1), sets))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []
        for b in batches:
            keys = [b.column(c).to_numpy() for c in ("bucket", "s", "l")]
            cut = [0, *(np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1).tolist(), b.num_rows]
            for start, end in zip(cut[:-1], cut[1:], strict=True):
                if start == end:
                    continue
                key = tuple(k[start] for k in keys)
                if rows and key != last:
                    yield held(rows)
                    rows = []
                last = key
                rows.append(b.slice(start, end - start))
        if rows:
            yield held(rows)

    return dealt.mapInArrow(of, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            yes = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))

    return pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb").mapInArrow(of, "a long, b long")


def connected(links: DataFrame, rounds: int = 50) -> DataFrame:
    """node and comp (the least node of its component) for the nodes of the links (a, b).

    Large-star joins each node's larger neighbours to its least neighbour, small-star the smaller ones; both keep
    components, and end in stars. Work and rows follow the number of links. Raises if edges still change in the last round.
    """
    edges = common.stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    count, total = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
    for _ in range(rounds if count else 0):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = common.stored(small.distinct(), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())
        if now == (count, total):
            break
        count, total = now
    else:
        if count:
            raise RuntimeError(f"components aren't whole after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row a document."""
    docs = docs.select("doc_id", "text")
    rows = with_nodes(common.stored(signatures(docs), "near-signatures"))
    known = rows.where(F.col("node").isNotNull())
    nodes = known.groupBy("node").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n_shingles", "print", "other")])  # equal in all its rows
    in_buckets = buckets(known.groupBy("node").agg(F.first("buckets").alias("buckets")))
    several = in_buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = common.stored(in_buckets.join(several, "bucket"), "near-buckets")
    meets = shared.groupBy("node").agg(F.sum("n").alias("meets")).join(nodes.select("node", "n_shingles"), "node")
    members = common.stored(shared.select("bucket", "node").join(meets, "node"), "near-members")
    few = meets.select("node")
    whole = common.stored(_sets(docs, nodes.select("node", "doc_id", "print", "other").join(few, "node")), "near-sets")
    minima_of, sets = whole.select("node", "minima"), whole.select("node", "shingles")

    hubs = members.groupBy("bucket").agg(F.max(F.struct("meets", "node")).alias("hub"))
    hub = F.max("hub")["node"]
    first = members.select("bucket", "node").join(hubs, "bucket").where("node <> hub.node").groupBy("node").agg(hub.alias("hub")).select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
    links = common.stored(confirmed(pruned(first, minima_of), sets), "near-links")
    comp = connected(links)
    for k in range(PIVOT_ROUNDS + 1):
        # buckets that hold several components; a node without links is its own
        now = members.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        sizes = now.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.max(F.struct((F.col("meets") * (0.5 + F.pmod(F.xxhash64("node", F.lit(k)), F.lit(1000)) / 2000)).alias("meets"), "node")).alias("some"))
        top = sizes.groupBy("bucket").agg(F.max(F.struct("n", "comp", "some")).alias("top"), F.count("*").alias("comps")).where("comps > 1").select("bucket", F.col("top.comp").alias("main"), F.col("top.some.node").alias("pivot"))
        mixed = common.stored(now.join(top, "bucket"), "near-mixed")
        if not mixed.take(1):
            break
        if k < PIVOT_ROUNDS:
            pairs = mixed.where("comp <> main").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
            more = confirmed(pruned(pairs, minima_of), sets)
        else:
            more = remainder(mixed, whole)
        more = common.stored(more, "near-links")
        if more.take(1):
            links = links.unionByName(more)
            comp = connected(links)

    least = nodes.select("node", "doc_id").join(comp, "node").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_node = nodes.select("node", F.col("doc_id").alias("first")).join(comp.join(least, "comp").select("node", "component_id"), "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id"))
    return rows.select("doc_id", "n_shingles", "node").join(of_node, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept")
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents without those whose component has a smaller doc_id, with all their columns."""
    gone = components(docs).groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, its full set and its minima, from one document of each wanted node."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            out = []
            for node, print_, other, t in zip(*(b.column(c).to_pylist() for c in ("node", "print", "other", "text")), strict=True):
                s, of_text = shingles(t)
                if (fingerprint(s), of_text) == (print_, other):  # else another row with this doc_id
                    out.append((node, s.tobytes(), minima(s).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), *(pa.array([x[k] for x in out], pa.binary()) for k in (1, 2))], names=["node", "shingles", "minima"])

    return docs.join(wanted, "doc_id").mapInArrow(of, "node long, shingles binary, minima binary").dropDuplicates(["node"])
