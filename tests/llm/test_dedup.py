import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomsift.llm import near_dup, substring


def components(rows):
    """Brute force: all pairs that share a shingle, on real word tuples."""
    sets = []
    for _, t in rows:
        ws = (t or "").encode().lower().split()
        sets.append(set() if not ws else {tuple(ws)} if len(ws) < 5 else {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    where = defaultdict(list)
    for n, s in enumerate(sets):
        if rows[n][0] is not None:
            for g in s:
                where[g].append(n)
    both = Counter((a, b) for v in where.values() for i, b in enumerate(v) for a in v[:i])
    for (a, b), c in both.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            root[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted(((i, len(sets[n]), i if i is None else least[find(n)], i is None or i == least[find(n)]) for n, (i, _) in enumerate(rows)), key=str)


def test_near_duplicates(tables, nothing, texts):
    for df in tables:
        assert sorted(map(tuple, near_dup.components(df).collect()), key=str) == components(texts(df))
    assert near_dup.components(nothing).collect() == []


def test_near_keep_has_all_columns(odd):
    got = near_dup.keep(odd)
    assert got.columns == odd.columns
    ids = [r.doc_id for r in got.collect()]
    assert 4 not in ids and 9 not in ids and None in ids and 1 in ids and 3 in ids


def test_pruning_keeps_what_may_be_similar():
    """Sets of similarity 0.75 survive; unlike ones are pruned at the first batch."""
    r = np.random.default_rng(3)
    low = []
    for _ in range(200):
        both = r.integers(0, 1 << 63, 300, np.uint64)
        a, b = r.integers(0, 1 << 63, 50, np.uint64), r.integers(0, 1 << 63, 50, np.uint64)
        low.append(tuple(near_dup.minima(np.concatenate([both, c])) for c in (a, b)))
    x, y = (np.stack(v) for v in zip(*low, strict=True))
    assert len(near_dup.survivors(x, y)) == 200
    assert len(near_dup.survivors(x, np.roll(y, 1, axis=0))) == 0


def test_few_similar_pairs_are_missed():
    """Of pairs of similarity 0.75, on independent minima: by the bands, and by all batches of pruning together."""
    s = near_dup.SHARE / 100
    assert (1 - s**near_dup.ROWS) ** near_dup.BANDS < 1.1e-4
    batch = [math.comb(near_dup.BATCH, k) * s**k * (1 - s) ** (near_dup.BATCH - k) for k in range(near_dup.BATCH + 1)]
    left, lost = np.ones(1), 0.0
    for fewest in near_dup.least_matches().values():
        left = np.convolve(left, batch)
        lost += left[:fewest].sum()
        left[:fewest] = 0
    assert lost < 1e-6


def test_components_raise_when_rounds_run_out(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long")
    assert {r.comp for r in near_dup.connected(chain).collect()} == {0}
    assert near_dup.connected(chain.where("a < 0")).collect() == []
    with pytest.raises(RuntimeError, match="1 rounds"):
        near_dup.connected(chain, rounds=1)


def test_links_of_a_block():
    """Against all pairs: each row is linked with just the components that it has a linked partner in."""
    r = np.random.default_rng(5)
    base = np.sort(r.choice(1 << 40, 200, False).astype(np.uint64))
    sets = [np.unique(np.concatenate([r.choice(base, int(r.integers(120, 200)), False), r.integers(0, 1 << 40, int(r.integers(0, 60)), np.uint64)])) for _ in range(150)]
    comp = r.integers(0, 6, 150)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(20), np.arange(20, 150), indexing="ij"))
    found = near_dup.some_links(i, j, comp, r.integers(0, 448, len(i)), sets)
    assert all(near_dup.linked(sets[a], sets[b]) for a, b in zip(*found, strict=True))
    want = {(a, comp[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True) if near_dup.linked(sets[a], sets[b])}
    assert {(a, comp[b]) for a, b in zip(*found, strict=True)} == want and 10 < len(want) < 120
    assert near_dup.some_links(i[:0], j[:0], comp, i[:0], sets) == ([], [])


def test_chain_of_links(spark):
    """Each text is like the next only: one component, whose ends are unlike."""
    w = [f"c{k}" for k in range(400)]
    rows = [(k, " ".join(w[8 * k : 8 * k + 100])) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_dup.components(df).collect()), key=str) == components(rows)


def removed(rows):
    """Brute force on real word tuples."""
    first, ws_of = {}, [(i, (t or "").encode().split()) for i, t in rows]
    for i, ws in ws_of:
        for k in range(len(ws) - 12 if i is not None else 0):
            w = tuple(ws[k : k + 13])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, ws in ws_of:
        gone = [False] * len(ws)
        for k in range(len(ws) - 12 if i is not None else 0):
            if first[tuple(ws[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = b" ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out.append((i, len(ws), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeated_passages(tables, nothing, texts):
    for df, group in zip(tables, (3, 50), strict=True):
        assert sorted(map(tuple, substring.digest(df, group).collect()), key=str) == removed(texts(df))
    assert substring.digest(nothing).collect() == []


def test_remove_cuts_texts(odd, texts):
    got = substring.remove(odd)
    assert got.columns == odd.columns
    words = sorted(((i, hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest()) for i, t in texts(got)), key=str)
    assert words == sorted(((i, h) for i, _, _, h in removed(texts(odd))), key=str)


def test_prefixes_lengthen_where_many_share_them(spark):
    rows = [(k, "a b " + " ".join(f"{k % 3}x{j}" for j in range(20))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substring.digest(df, 5).collect()), key=str) == removed(rows)


def maximal(rows, deepest):
    """Brute force over word tuples: repeats that no word to the left or right extends in all places, of 13 words on. Longer
    ones than ``deepest`` stand for each of their stretches of that many words."""
    ws_of = {}
    for i, t in sorted(rows, reverse=True):
        ws_of[tuple((t or "").split())] = i  # one document of each class
    places = {}
    for ws, i in ws_of.items():
        for p in range(len(ws)):
            for n in range(13, min(deepest, len(ws) - p) + 1):
                places.setdefault(ws[p : p + n], []).append((i, p, ws))
    out = []
    for run, at in places.items():
        if len(at) > 1:
            n = len(run)
            after = [ws[p + n] if p + n < len(ws) else None for _, p, ws in at]
            before = [ws[p - 1] if p else None for _, p, ws in at]
            if (n == deepest or None in after or len(set(after)) > 1) and (None in before or len(set(before)) > 1):
                out.append((n, len(at), min(i for i, _, _ in at)))
    return sorted(out)


def test_maximal_repeats(spark):
    w = [f"v{k}" for k in range(60)]
    rows = [(1, " ".join(w[:40])), (2, "x " + " ".join(w[3:20]) + " y"), (3, "z " + " ".join(w[3:18]) + " q"), (4, " ".join(w[25:39]) + " end"), (5, " ".join(w[:40])), (6, " ".join(w[40:55]) + " a"), (7, "k " + " ".join(w[40:55]) + " b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    deepest = substring.WINDOW + substring.AHEAD
    got = substring.maximal_repeats(df).collect()
    assert sorted((r.words, r.occurrences, r.least_doc_id) for r in got) == maximal(rows, deepest)
    text = {i: t.split() for i, t in rows}
    assert all(len(text[r.doc_id][r.pos : r.pos + r.words]) == r.words for r in got)
    assert substring.maximal_repeats(df.where("doc_id < 0")).collect() == []


def test_nodes_give_their_depth():
    """Nodes go by the window's two hashes, then by the codes of the words after it."""
    window = np.array([5, 5, 5, 9, 9, 11, 12, 12], np.int64)
    codes = np.zeros((8, 4 + substring.AHEAD + 1), np.uint16)
    codes[0, 4:7], codes[1, 4:7], codes[2, 4:7] = (1, 2, 3), (1, 2, 4), (1, 9, 0)
    codes[7, 2] = 1  # windows that one hash doesn't tell apart
    tree = substring.Subtree(window, codes, np.array([7, 3, 4, 8, 8, 1, 1, 2]))
    assert tree.common.tolist() == [0, 15, 14, 0, 13, 0, 0, 0]
    assert tree.repeated().tolist() == [True, False, True, False, False, False, False, False]
    assert sorted((d, n, least) for d, _, n, least in tree.maximal()) == [(13, 2, 8), (14, 3, 3), (15, 2, 3)]


def test_words_of_equal_codes_are_kept(spark):
    """The words after a repeat agree in the 16 bits of their codes, and in nothing else."""
    a, b = b"word86", b"word383"
    assert np.ptp(substring.word_codes(substring.common.hashes([a, b]))) == 0
    w = " ".join(f"s{k}" for k in range(13))
    rows = [(1, f"alpha {w} word86 zig"), (2, f"beta {w} word383 zag")]
    got = substring.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == removed(rows) and sorted(r.n_removed for r in got) == [0, 13]


def test_heavy_slots():
    x = np.array([0, 1 << 63, 5, (1 << 64) - 1], np.uint64)
    h = substring.Heavy(substring.slots(x[1:2]))
    assert h.some and h.of(x).tolist() == [False, True, False, False] and len(h.bits) == 1 << substring.SLOTS - 3
    assert not substring.Heavy(np.empty(0, np.int64)).of(x).any()


def test_groups_stay_small(spark):
    """No label has more rows than a group, whatever shares its first words; windows held by more are apart."""
    common = " ".join(f"s{k}" for k in range(9))
    rows = [(k, f"{common} {k % 40} " + " ".join(f"{k % 40}t{j}" for j in range(12))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "concat(text, ' end', doc_id) as text")
    _, _, runs = substring.candidates(docs)
    heavy = substring.prefixes(runs, 50)
    sizes = [r["count"] for r in substring.suffixes(runs, heavy, False).groupBy("label").count().collect()]
    assert heavy[0].some and max(sizes) <= 50 and sum(sizes) > 3000 and substring.suffixes(runs, heavy, True).count() == 0
    assert substring.suffixes(runs, substring.prefixes(runs, 5), True).count() == 4000


def test_remove_with_clashing_columns(odd, texts):
    df = odd.selectExpr("*", "1 as cuts", "2 as key", "3 as __cuts", "4 as `CUTS_`", "5 as found")
    got = substring.remove(df)
    assert got.columns == df.columns
    assert sorted(texts(got), key=str) == sorted(texts(substring.remove(odd)), key=str)


def test_heavy_seeds_are_salted(spark, texts, monkeypatch):
    monkeypatch.setattr(substring, "HEAVY", 5)
    monkeypatch.setattr(substring, "SHARES", 50)
    w = " ".join(f"s{k}" for k in range(30))
    rows = [(k, f"p{k} " * (k % 4) + w + f" t{k % 6}") for k in range(60)] + [(k, " ".join(f"r{k}x{j}" for j in range(20))) for k in range(60, 70)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for group in (3, 200_000):
        assert sorted(map(tuple, substring.digest(df, group).collect()), key=str) == removed(rows)


def test_kept_tables_may_be_empty(odd, nothing):
    assert near_dup.keep(nothing).collect() == [] and substring.remove(nothing).collect() == []
    assert near_dup.keep(nothing).columns == odd.columns == substring.remove(nothing).columns


def test_cut_text_keeps_spaces_of_kept_words():
    assert substring.cut_text("a\tb  c\nd ", [False, True, False, False]) == "a  c\nd"
    assert substring.cut_text(" a b", [True, False]) == "b"


def test_sets_with_one_fingerprint_stay_apart(spark, monkeypatch):
    """Sets that share 64 bits are told apart by 64 more; documents of one set stay one node."""
    rows = [(1, "a b c d e f"), (2, "v w x y z"), (3, "A b c d e f"), (4, "v w x y z q"), (5, "one"), (6, None), (7, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = near_dup.signatures(df).withColumn("print", F.when(F.col("print").isNotNull(), F.lit(7).cast("long")))
    nodes = near_dup.with_nodes(made).groupBy("node").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"), F.count_distinct("other").alias("n"))
    assert sorted((r.ids, r.n) for r in nodes.where("node is not null").collect()) == [([1, 3], 1), ([2], 1), ([4], 1), ([5, 7], 1)]
    assert near_dup.with_nodes(near_dup.signatures(df)).where("node <> print").count() == 0
    for f in (lambda s: len(s) % 2, lambda s: 7):
        monkeypatch.setattr(near_dup, "fingerprint", f)
        made = near_dup.with_nodes(near_dup.signatures(df))
        assert made.where("node is not null").select("node").distinct().count() == 4
        assert sorted(map(tuple, near_dup.components(df).collect()), key=str) == components(rows)
