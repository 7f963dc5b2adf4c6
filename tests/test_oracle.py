"""Every query with SQL gives the rows of that SQL; every other one those of a slow form."""

import re
from collections import Counter

import pytest
from oracle import duck, sparked

import __spark_entry__ as entry
from loomsift.functions import guards
from loomsift.operators import dedup
from loomsift.plans import queries as plans
from loomsift.schema import TITLE_RATIO
from slow import slow_anchors, slow_cascade, slow_redaction, slow_sections

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_same_rows(spark, name):
    assert sparked(entry.queries()[name](spark, SF)) == duck(SF, plans.ORACLE[name])


def rows(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]


def ran(spark, name):
    return sorted((tuple(r) for r in entry.queries()[name](spark, SF).collect()), key=str)


def test_every_query_is_held_against_something():
    here = {"q_redact", "q_scan_entropy", "q_anchor_kinds", "q_firewall", "q_sections", "q_dedup_greedy", "q_dedup_rounds"}
    assert set(plans.QUERIES) - set(plans.ORACLE) == here


def test_redaction_of_all_documents(spark):
    assert ran(spark, "q_redact") == sorted(((i, None if t is None else slow_redaction(t)) for i, t in rows(spark, "documents", "doc_id", "text")), key=str)


def test_long_tokens_of_all_documents(spark):
    want = []
    for i, t in rows(spark, "documents", "doc_id", "text"):
        for kind, raw, start, end in guards.secret_spans(t or ""):
            assert t[start:end] == raw
            want += [(i, start, end)] if kind == guards.HIGH_ENTROPY else []
        inside = [(m.start(), m.end()) for p in guards.RULES.values() for m in re.finditer(p, t or "")]
        dense = [(i, m.start(), m.end()) for m in re.finditer(guards.LONG_TOKEN, t or "") if guards.bits(m[0]) >= 4 and not any(s <= m.start() < e for s, e in inside)]
        assert [x for x in want if x[0] == i] == dense
    assert sorted((x[0], x[3], x[4]) for x in ran(spark, "q_scan_entropy")) == sorted(want)


def test_anchors_of_all_documents(spark):
    want = Counter((i, kind) for i, t in rows(spark, "documents", "doc_id", "text") for kind, _, _ in slow_anchors(t or ""))
    assert ran(spark, "q_anchor_kinds") == sorted(((i, k, n) for (i, k), n in want.items()), key=str)


def test_answers_against_what_was_said(spark):
    turns, want = rows(spark, "conversations", "conv_id", "turn", "text"), []
    normal = lambda t: " ".join((t or "").translate(str.maketrans("‘’“”–—", "''\"\"--")).split())
    for c, k, t in turns:
        before = [normal(x) for d, j, x in turns if d == c and j < k and x]
        found = [normal((t or "")[s:e] if kind != "port" else re.search(r"\d+", t[s:e])[0]) for kind, s, e in slow_anchors(t or "")]
        want.append((c, k, True, len(found), sum(not any(x in b for b in before) for x in found)))
    assert ran(spark, "q_firewall") == sorted(want, key=str)


def test_sections_of_all_documents(spark):
    got = {}
    for i, _, heading, n, _ in sorted(ran(spark, "q_sections"), key=lambda x: x[:2]):
        got.setdefault(i, []).append((heading, n))
    want = {i: [(h, len(b)) for h, b in slow_sections(t)] for i, t in rows(spark, "documents", "doc_id", "text") if t and slow_sections(t)}
    assert got == want


def test_cascade_of_all_titles(spark):
    t = [tuple(r) for r in plans.titles(spark, SF).select("uid", "title_normalized", "authority_tier", "seq").collect()]
    want = slow_cascade([x for x in t if x[3] % 3], [x for x in t if x[3] % 3 == 0], TITLE_RATIO)
    got = entry.queries()["q_dedup_greedy"](spark, SF).collect()
    assert sorted((r.uid, r.seq, r.action, r.matched_uid, round(r.score, 6)) for r in got) == sorted(want)


def test_rounds_of_all_titles(spark):
    hot = lambda k, t: "a title that a third of all rows has" if k % 3 == 0 else t
    t = [(r.uid, hot(r.seq, r.title_normalized), (-1 - r.seq) % 31, r.seq) for r in plans.titles(spark, SF).collect()]
    want = slow_cascade(t, [], TITLE_RATIO)
    got = entry.queries()["q_dedup_rounds"](spark, SF).collect()
    assert sorted((r.uid, r.seq, r.action, r.matched_uid, round(r.score, 6)) for r in got) == sorted(want, key=lambda x: x[0])
    assert {r.took > 0 for r in got if r.action == "supersedes"} == {True} and max(r.took for r in got) > 1


def test_all_like_titles_are_paired(spark):
    """Brute force over every two parts, of equal and unequal parity."""
    t = sorted(tuple(r) for r in plans.titles(spark, SF).select("uid", "title_normalized").collect())
    want = {(i, j) for k, (j, b) in enumerate(t) for i, a in t[:k] if a and b and dedup.ratio(a, b) >= TITLE_RATIO}
    got = entry.queries()["q_dedup_pairs"](spark, SF).collect()
    assert len(got) == len(want) and {(r.left_id, r.right_id) for r in got} == want
    assert any((int(i) - int(j)) % 2 == 0 for i, j in want)


def test_all_copies_are_found(spark):
    """Brute force over all documents, of equal and unequal parity."""
    first, want = {}, set()
    for i, t in sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").collect()):
        if first.setdefault(t, i) != i:
            want.add((i, first[t]))
    assert set(map(tuple, entry.queries()["q_dedup_copies"](spark, SF).collect())) == want
    assert any((i - j) % 2 == 0 for i, j in want)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_registry_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=entry.ROOT, check=False).returncode == 0
