import hashlib
import random
import re

import numpy as np
import pytest

from loomsift.llm import fim, queries
import oracle


def plain(doc_id, text, units=None):
    """The definition, on lists of units."""
    t = text or ""
    units = list(t) if units is None else units
    n = len(units)
    x = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h = [int(x[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if doc_id is None or not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, t
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:z], units[z:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_digest(tables, nothing, texts, spark):
    more = spark.createDataFrame([(k, t) for k, t in enumerate(["<P>", "a<S", "<", "x<M", "P>", "<<P", "S><", "é\U0001f600<M>", "日本語" * 4000, "<" * 50])], "doc_id long, text string")
    for df in [*tables, more]:
        want = sorted(((i, *(x := plain(i, t))[:4], sha(x[4]), sha(t or "")) for i, t in texts(df)), key=str)
        assert sorted(map(tuple, fim.digest(df).collect()), key=str) == want
    assert fim.digest(nothing).collect() == []


def test_query_equals_its_sql(spark):
    assert oracle.sparked(queries.op13_fim(spark, "/root/testdata/sf0.001")) == oracle.duck("/root/testdata/sf0.001", queries.ORACLE_SQL["op13_fim"])


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_boundaries_in_blocks(block):
    r = random.Random(block)
    for _ in range(60):
        t = "".join(r.choice("ab é漢\U0001f600\n<") for _ in range(r.randrange(40)))
        for unit in (None, re.compile(r"\s*\w+|\s+"), re.compile("é*")):
            b = fim.Blocks(t, unit, block)
            ends = [0]
            at = 0
            while at < len(t):
                m = unit.match(t, at) if unit else None
                at = max(at + 1, m.end() if m else 0)
                ends.append(at)
            assert b.n == len(ends) - 1
            assert [b.boundary(k) for k in range(b.n + 1)] == [(len(t[:e].encode()), e) for e in ends]


def test_fenwick_goes_to_the_last_block_that_fits():
    r = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 8, 13, 100):
        counts = r.integers(0, 4, (n, 2))
        tree, sums = fim.Fenwick(counts), np.vstack([np.zeros((1, 2), int), np.cumsum(counts, axis=0)])
        for rank in range(int(sums[-1, 0]) + 2):
            at, both = tree.down(rank)
            assert at == np.flatnonzero(sums[:, 0] <= rank)[-1] and both.tolist() == sums[at].tolist()


def test_words_as_units_and_clashing_columns(odd, texts):
    df = odd.selectExpr("*", "'x' as fim", "1 as n", "'y' as form", "'z' as output")
    rows = fim.transform(df, unit=r"\s*\S+|\s+").collect()
    assert df.columns[:-4] == [c for c in rows[0].asDict() if c not in ("fim", "n", "form", "output")] and {r.form for r in rows} == {"y"}
    want = sorted(((i, *plain(i, t, re.findall(r"\s*\S+|\s+", t or ""))) for i, t in texts(df)), key=str)
    assert sorted(((r.doc_id, *r.fim) for r in rows), key=str) == want
    assert all(fim.restored(r.fim.output, r.fim.form) == (r.text or "") for r in rows)
