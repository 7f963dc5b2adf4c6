import itertools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomsift.llm import best_fit, queries


def library():
    tok = Tokenizer.from_file(public_tokenizers.path(best_fit.VOCABULARY))
    tok.encode_special_tokens = True
    return lambda t: [*tok.encode(t or "", add_special_tokens=False).ids, best_fit.END_ID]


def little(ids):
    return np.array(ids, "<u4").tobytes()


def cut(ids):
    """The pieces by the definition: the rest first."""
    n = best_fit.LENGTH
    edges = sorted({0, *range(len(ids) % n, len(ids) + 1, n)})
    return [(k, a, ids[a:z]) for k, (a, z) in enumerate(itertools.pairwise(edges))]


def sound(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        at = 0
        for off, n in sorted(v):
            assert off == at
            at += n
        assert at <= best_fit.LENGTH
    return len(by)


@pytest.mark.parametrize("group", [7, best_fit.GROUP])
def test_packing(tables, nothing, texts, group):
    lib = library()
    for df in tables:
        want = Counter((i, k, a, len(x), little(x), zlib.crc32(little(x))) for i, t in texts(df) for k, a, x in cut(lib(t)))
        rows = best_fit.pack(df, group=group).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids), r.ids_crc32) for r in rows) == want
        n = sound(rows)
        counts = np.bincount([r.length for r in rows], minlength=best_fit.LENGTH + 1)
        assert best_fit.bound(counts) <= n
        if group > 7:
            assert n <= best_fit.bound(counts) + 1
    assert best_fit.pack(nothing).collect() == []


def test_query(spark, texts):
    rows = queries.op12_best_fit(spark, "/root/testdata/sf0.001").collect()
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lib = library()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter((i, k, a, len(x), zlib.crc32(little(x))) for i, t in texts(df) for k, a, x in cut(lib(t)))
    sound(rows)


@pytest.mark.parametrize("most", [700, 1000])
def test_exchange_lowers_the_bins(spark, most):
    """Small partitions leave gaps; documents that are exchanged fill them, and no round is taken that doesn't."""
    n = np.random.default_rng(most).integers(1, most, 2000).tolist()
    rests = spark.createDataFrame(list(enumerate(n)), "place long, length long")
    used = []
    for k in (1, 4):
        rows = best_fit.repacked(rests, 20, k).join(rests, "place").collect()
        assert sorted(r.place for r in rows) == list(range(2000))
        used.append(sound(rows))
    assert used[0] > used[1] >= best_fit.bound(np.bincount(n, minlength=best_fit.LENGTH + 1))
    assert best_fit.repacked(rests.where("place < 0")) is None


def test_certified_groups_stay(spark):
    """Every group of the first round that meets its bound is in the result as it was."""
    rests = spark.createDataFrame(list(enumerate(np.random.default_rng(5).integers(1, 900, 600).tolist())), "place long, length long")
    first, last = (sorted(map(tuple, best_fit.repacked(rests, 20, k).collect())) for k in (1, 4))
    gaps = {r.sequence_id >> 24: r.gap for r in best_fit.packed(rests, 0, 30).collect()}
    certified = [r for r in first if gaps[r[1] >> 24] == 0]
    assert min(gaps.values()) == 0 < max(gaps.values()) and set(certified) <= set(last)


def test_equal_rows_are_dealt_to_many_groups(spark):
    same = spark.createDataFrame([(7, "the same words again " * 40)] * 600, "doc_id long, text string").coalesce(1)
    rows = best_fit.pack(same, group=60, rounds=1, with_ids=False).collect()
    groups = Counter(r.sequence_id >> 24 for r in rows)
    assert len(rows) == 600 and len(groups) > 7 and max(groups.values()) < 120


sizes = st.lists(st.integers(1, 24), min_size=1, max_size=60)


@settings(max_examples=200, deadline=None)
@given(sizes)
def test_best_fit_takes_the_fullest_bin(n):
    n = sorted(n, reverse=True)
    bins, offsets, full = best_fit.best_fit(np.array(n), 24)
    room = []
    for size, k, off in zip(n, bins.tolist(), offsets.tolist(), strict=True):
        fits = [r for r in room if r >= size]
        if k == len(room):
            assert not fits
            room.append(24)
        else:
            assert room[k] == min(fits)
        assert off == 24 - room[k]
        room[k] -= size
    assert full.tolist() == [24 - r for r in room]


def fewest(n, room):
    """The least number of bins, by search."""
    best = len(n)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(n):
            best = len(bins)
            return
        for j in {b: i for i, b in enumerate(bins)}.values():
            if bins[j] >= n[k]:
                bins[j] -= n[k]
                go(k + 1, bins)
                bins[j] += n[k]
        go(k + 1, [*bins, room - n[k]])

    go(0, [])
    return best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_is_below_the_least(n):
    assert best_fit.bound(np.bincount(n, minlength=21)) <= fewest(sorted(n, reverse=True), 20)


def test_bound_sees_what_sums_don_t():
    count = lambda n: np.bincount(n, minlength=101)
    assert best_fit.bound(count([51] * 10)) == 10
    assert best_fit.bound(count([34] * 9)) == 5
    assert best_fit.bound(count([60] * 4 + [41] * 4)) == 6  # 41s go by two, and not beside a 60
