"""Stateful operators, sources, sinks, plans and streams against golden values."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomsift import schema
from loomsift.operators import alerts, cascade, dedup, health, screening, tables
from loomsift.plans import heal, ingest
from loomsift.sources import readers, remote, sinks
from loomsift.streaming import flows
from slow import slow_cascade

T0 = dt.datetime(2026, 7, 6, 12)


def at(hours):
    return T0 - dt.timedelta(hours=hours)


def now():
    return F.lit(T0).cast("timestamp")


def test_queue_orders_and_limits(spark):
    rows = [(f"d{k}", "queued", float(s), k) for k, s in enumerate([50, 90, 70, 60, 85, 95, 40])] + [("x", "approved", 99.0, 0)]
    got = tables.queue(spark.createDataFrame(rows, "uid string, status string, rubric_score double, fetched_at int")).collect()
    assert [r.rubric_score for r in got] == [95, 90, 85, 70, 60]


def test_ttl(spark):
    df = spark.createDataFrame([("a", "queued", at(73)), ("b", "approved", at(73)), ("c", "rejected", at(99)), ("d", "queued", at(71))], "uid string, status string, last_interaction_at timestamp")
    kept, log = tables.purged(df, now())
    assert {r.uid for r in kept.collect()} == {"b", "c", "d"} and [tuple(r) for r in log.collect()] == [("a", "PURGED", "")]


def test_attempts_are_capped(spark):
    dlq = spark.createDataFrame([(1, 1, True), (2, 4, True), (3, 3, True)], "id long, attempts int, retry_eligible boolean")
    got = {r.id: (r.attempts, r.retry_eligible) for r in tables.bumped(dlq, dlq.where("id < 3")).collect()}
    assert got == {1: (2, True), 2: (5, False), 3: (3, True)}


def test_upsert_keeps_first_source_and_time(spark):
    cols = "uid string, source string, fetched_at timestamp, last_interaction_at timestamp, status string"
    old = spark.createDataFrame([("a", "s1", at(9), at(9), "queued"), ("b", "s1", at(8), at(8), "queued")], cols)
    new = spark.createDataFrame([("a", "s2", at(1), at(1), "approved"), ("c", "s2", at(1), at(1), "queued")], cols)
    got = {r.uid: r for r in tables.upserted(old, new, touch=False).collect()}
    assert (got["a"].source, got["a"].fetched_at, got["a"].last_interaction_at, got["a"].status) == ("s1", at(9), at(9), "approved")
    assert got["c"].source == "s2" and len(got) == 3
    assert {r.uid: r for r in tables.upserted(old, new).collect()}["a"].last_interaction_at == at(1)


def test_append_numbers_rows(spark):
    log = spark.createDataFrame([(7, "a", at(1))], "id long, uid string, created_at timestamp")
    rows = spark.createDataFrame([(f"u{k}",) for k in range(50)], "uid string").repartition(7)
    got = tables.appended(log, rows, now()).collect()
    assert sorted(r.id for r in got) == [7, *range(8, 58)]


def test_breaker(spark):
    kinds = ["transient"] * 5 + ["ok"]
    rows = [("a", k, x) for k, x in enumerate(kinds)] + [("b", k, x) for k, x in enumerate(["transient", "permanent", "transient", "ok", "transient", "transient", "ok"])]
    got = tables.broken_circuits(spark.createDataFrame(rows, "source string, seq int, kind string"), 3).collect()
    assert sum(r.source == "a" for r in got) == 3 and sum(r.source == "b" for r in got) == 7


def test_plan_of_ids(spark):
    rows = [("s", 0, "q0", 0, "1"), ("s", 0, "q0", 1, "2"), ("s", 1, "q1", 0, "2"), ("s", 1, "q1", 1, "3"), ("s", 1, "q1", 2, "4")]
    got = tables.ranked_ids(spark.createDataFrame(rows, "source string, query_no int, query string, pos int, id string"), 3).orderBy("rank").collect()
    assert [(r.id, r.rank, r.found_by_query) for r in got] == [("1", 1, "q0"), ("2", 2, "q0"), ("3", 3, "q1")]


def rated(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id long, uid string, agent string, verdict string, confidence string, criterion_id string")


def pair(uid, a, b):
    return [(uid, "screener_a", a, "high", None), (uid, "screener_b", b, "high", None)]


@pytest.mark.parametrize(("pairs", "want"), [([("include", "include"), ("exclude", "exclude")], 1.0), ([("include", "exclude"), ("exclude", "include")], -1.0), ([("include", "include")], None), ([("include", "include")] * 2, 1.0)])
def test_kappa(spark, pairs, want):
    got = screening.agreement(rated(spark, [r for k, p in enumerate(pairs) for r in pair(str(k), *p)])).first()
    assert got.n == len(pairs) and (got.kappa is None if want is None else got.kappa == pytest.approx(want))


def test_last_verdict_counts(spark):
    got = screening.pairs(rated(spark, [*pair("a", "include", "include"), ("a", "screener_a", "exclude", "high", None), ("b", "screener_a", "include", "high", None)])).collect()
    assert [tuple(r) for r in got] == [("a", "exclude", "include")]


def test_decisions(spark):
    tie = lambda u, v, c: (u, "tiebreaker", v, c, None)
    rows = [*pair("in", "include", "include"), *pair("ex", "exclude", "exclude"), *pair("hi", "include", "exclude"), tie("hi", "exclude", "high"), *pair("lo", "include", "exclude"), tie("lo", "include", "low"), *pair("bad", "invalid", "include"), *pair("wait", "include", "exclude"), tie("bad", "include", "high"), ("one", "screener_a", "include", "high", None)]
    got = {r.uid: (r.needs, r.event_type, r.status) for r in screening.decided(screening.by_agent(rated(spark, rows))).collect()}
    assert got == {
        "in": (None, "SCREEN_INCLUDED", "queued"), "ex": (None, "SCREEN_EXCLUDED", "rejected"), "hi": (None, "SCREEN_EXCLUDED", "rejected"), "lo": (None, "SCREEN_ESCALATED", "queued"),
        "bad": (None, "SCREEN_INCLUDED", "queued"), "wait": ("tiebreaker", None, "queued"), "one": ("screeners", None, "queued"),
    }
    stats = screening.statistics(rated(spark, rows)).first()
    assert (stats.agreement, stats.disagreement_resolved, stats.escalated) == (2, 1, 3)


def test_verdict_rules(spark):
    v = spark.createDataFrame([(1, "exclude", "ET1", "a “quote”", 'has a "quote" in it'), (2, "exclude", "ZZ", "quote", "quote"), (3, "exclude", "ET1", "other", "quote"), (4, "include", "ET1", "q", "x"), (5, "odd", None, None, "x")], "id int, verdict string, criterion_id string, evidence_quote string, source_text string")
    got = {r.id: (r.verdict, r.criterion_id) for r in screening.validated(v, spark.createDataFrame([("ET1",)], "code string")).collect()}
    assert got == {1: ("exclude", "ET1"), 2: ("invalid", "ZZ"), 3: ("invalid", "ET1"), 4: ("include", None), 5: ("invalid", None)}


def test_fields_and_grounding(spark):
    x = spark.createDataFrame([("true", "we release", "We  release code"), ("true", "invented", "text"), ("true", None, "text"), (" None ", "", "text"), (None, None, None)], "v string, q string, s string")
    assert [r.y for r in x.select(screening.verified(F.col("v"), F.col("q"), F.col("s")).alias("y")).collect()] == [1, 0, 0, 2, 2]
    g = screening.grounding(spark.createDataFrame([("a", 1), ("a", 0), ("a", 2), ("b", 2)], "uid string, verified int")).first()
    assert (g.grounding_avg, g.docs_count) == (0.5, 2)


def frames(spark, dlq=(), runs=(), screening_=(), events=(), docs=()):
    make = lambda rows, cols: spark.createDataFrame(list(rows), cols)
    return (
        make(docs, "uid string, status string, rubric_score double, tech_meta string, full_text string"),
        make([(k, *r) for k, r in enumerate(dlq)], "id long, uid string, error_type string, attempts int, retry_eligible boolean, created_at timestamp"),
        make(events, "id long, uid string, event_type string, detail string, created_at timestamp"),
        make([(k, *r) for k, r in enumerate(runs)], "id long, started_at timestamp, report_json string"),
        make(screening_, "id long, uid string, agent string, verdict string, confidence string, criterion_id string"),
        make([], "uid string, verified int, created_at timestamp"),
    )


@pytest.mark.parametrize(
    ("dlq", "runs", "want"),
    [
        ([(f"a:{k}", "net", 1, True, at(25)) for k in range(5)], [], {"DLQ_SPIKE"}),
        ([("a:batch", "net", 1, True, at(1))], [], {"SOURCE_DOWN:a"}),
        ([(f"b:{k}", "net", 1, True, at(1)) for k in range(3)], [], {"SOURCE_DOWN:b"}),
        ([], [(at(40), "{}")], {"NO_BATCH_36H"}),
        ([], [(at(1), '{"fetched": 10, "dlq": 4}')], {"DLQ_SPIKE"}),
        ([("a:1", "layout", 5, False, at(99))], [], {"DLQ_PERMANENT"}),
        ([], [], set()),
    ],
)
def test_alert_rules(spark, dlq, runs, want):
    snap = health.snapshot(*frames(spark, dlq, runs), now())
    assert {r.key for r in alerts.desired(snap).collect()} == want


def test_alert_states(spark):
    none = spark.createDataFrame([], schema.TABLES["alerts"])
    want = spark.createDataFrame([("K", "d")], "key string, detail string")

    def step(old, wanted, hours):
        got = alerts.evaluated(old, wanted, F.lit(T0 + dt.timedelta(hours=hours)).cast("timestamp")).collect()
        return spark.createDataFrame([r[:5] for r in got], schema.TABLES["alerts"]), [r.transition for r in got]

    seen = []
    old = none
    for wanted, h in ((want, 0), (want, 1), (want, 25), (want.limit(0), 26), (want.limit(0), 27), (want, 28)):
        old, told = step(old, wanted, h)
        seen += told
    assert seen == ["OPEN", None, "REALERT", "RESOLVED", None, "OPEN"]
    assert alerts.open_alerts(old).first().first_seen == T0 + dt.timedelta(hours=28)


def test_flow_report(spark):
    docs = [("a", "approved", 1.0, None, ""), ("b", "rejected", 1.0, None, "x"), ("c", "queued", 1.0, None, "x")]
    events = [(k, f"e{k}", "FETCHED", "", at(1)) for k in range(5)] + [(9, "x", "DUPLICATE_ID", "", at(1)), (10, "x", "REJECTED", "Rubric", at(1))]
    rows = [(1, "a", "screener_a", "include", "high", None), (2, "c", "screener_a", "exclude", "high", "ET1")]
    d, _, e, r, s, _ = frames(spark, events=events, docs=docs, screening_=rows, runs=[(at(1), "broken"), (at(2), '{"fetched": 3}')])
    got = health.flow_report(d, e, r, s)
    assert tuple(got.first()) == (5, 1, 1, 2, 1, 1, 0, 1, 1)
    text = health.flow_markdown(got, health.exclusion_reasons(s))
    assert "ET1: 1" in text and "mermaid" in text


# --- duplicates ---


def test_ratio_is_indel():
    assert dedup.ratio("abcd", "acbd") == 75.0 and dedup.ratio("", "") == 100.0


def test_blocked_join_loses_no_pair(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abc de") for _ in range(r.randint(3, 45))).strip() or "a" for _ in range(60)]
    every = set(base)
    for b in base:
        for _ in range(4):
            x = list(b)
            for _ in range(r.randint(1, 3)):
                k = r.randrange(len(x) + 1)
                x[k : k + r.randint(0, 1)] = r.choice(["", "z", "a"])
            every.add("".join(x) or "q")
    titles = sorted(every)
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(titles)], "id string, title string")
    want = {(str(i), str(j)) for i, a in enumerate(titles) for j, b in enumerate(titles) if dedup.ratio(a, b) >= 85}
    assert {(x.left_id, x.right_id) for x in dedup.similar(df, df, 85.0).collect()} == want


@pytest.mark.parametrize("pack", [3, 256])
def test_pairs_of_packs_are_those_of_rows(spark, monkeypatch, pack):
    """Copies in many packs, a repeated row, an id under two titles, null ids, and titles that are like none."""
    monkeypatch.setattr(dedup, "PACK", pack)
    hot, near, other = "a title that many rows have", "a title that many rows had", "something else altogether"
    rows = [(f"{k}", (hot, hot, near, other)[k % 4]) for k in range(60)] + [("7", other), ("7", hot), ("4", hot), ("90", ""), ("91", ""), ("92", None), (None, hot), (None, near)]
    df = spark.createDataFrame(rows, "id string, title string")
    want = Counter((i, j, round(dedup.ratio(a, b), 6)) for i, a in rows for j, b in rows if i and j and i < j and a and b and dedup.ratio(a, b) >= 93)
    assert len(want) > 900 and Counter(map(tuple, dedup.pairs(df).collect())) == want


def test_a_title_is_sketched_once_however_many_copies(spark):
    df = spark.createDataFrame([("a", "a title")], "id string, title string")
    plan = dedup.pairs(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and not [x for x in plan.splitlines() if " Filter " in x and "xxhash64(substring" in x]


DOCS = "uid string, title_normalized string, authority_tier int, seq long, status string"


@pytest.mark.parametrize("part", [12, 10_000_000])
def test_turns_against_what_was_said(spark, part):
    """Pieces of a long conversation, needles in parts, odd turns; against a loop over all earlier turns."""
    from loomsift.functions import guards
    from loomsift.operators import firewall

    r = random.Random(7)
    words = ["10.0.0.1", "10.0.0.12", "see", "port 8080", "192.168.1.1:80", "v1.2.3", "“q” – x", "2024-01-05", "https://a.example/b"]
    turns = [(r.choice([1, 1, 1, 2, 3]), k, " ".join(r.choice(words) for _ in range(r.randrange(5)))) for k in range(150)]
    turns += [(4, 0, None), (4, 1, ""), (5, 0, "10.0.0.1"), (5, 1, "x10.0.0.1y"), (None, 1, "10.0.0.1"), (6, None, "10.0.0.1")]
    normal = lambda t: " ".join((t or "").translate(str.maketrans("‘’“”–—", "''\"\"--")).split())
    want = []
    for c, k, t in turns:
        if c is not None and k is not None:
            before = [normal(x) for d, j, x in turns if d == c and j is not None and j < k and x]
            found = [normal(a[1]) for a in guards.anchor_spans(t or "")]
            n = sum(not any(x in b for b in before) for x in found)
            want.append((c, k, n == 0, len(found), n, 0))
    df = spark.createDataFrame(turns, "conv_id int, turn int, text string").withColumn("piece", F.lit(1)).withColumn("part", F.lit("x"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert sorted(map(tuple, firewall.checked_turns(df, strict=True, part=part).collect())) == sorted(want)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.passed for r in firewall.checked_turns(df).collect()} == {True} and firewall.checked_turns(df.where("turn < 0")).collect() == []


def test_clashing_column_names(spark):
    """Columns with the names that operators add for themselves stay as they are."""
    from loomsift.functions import guards
    from loomsift.operators import sections

    dlq = spark.createDataFrame([(1, 4, True, "x", "y", "z")], "id long, attempts int, retry_eligible boolean, again string, `AGAIN_` string, __again string")
    assert [tuple(r) for r in tables.bumped(dlq, dlq).collect()] == [(1, 5, False, "x", "y", "z")]
    log = spark.createDataFrame([(7, "a", "p", 1, T0)], "id long, part string, at string, shift int, created_at timestamp")
    rows = spark.createDataFrame([("c", "q", 2), ("b", "q", 3)], "part string, at string, shift int")
    assert sorted(tuple(r)[:4] for r in tables.appended(log, rows, now()).collect()) == [(7, "a", "p", 1), (8, "b", "q", 3), (9, "c", "q", 2)]
    docs = spark.createDataFrame([("1. Introduction\nsome text", "ieee", 5, 6)], "full_text string, source string, parts int, rules int")
    r = sections.canonical(docs).first()
    assert (r.parts, r.sections.context.content) == (5, "some text")
    assert [tuple(r) for r in guards.sanitized(docs, "full_text").collect()] == [tuple(r) for r in docs.collect()]


def test_daily_bitmaps_add_up(spark):
    from loomsift.operators import distinct

    r = random.Random(1)
    rows = [(r.choice("ab"), dt.date(2024, 1, 1 + r.randrange(9)), r.choice([None, *(f"u{k}" for k in range(300))])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "kind string, day date, uid string")
    ids = distinct.numbered(df.where("uid < 'u2'"))
    every = distinct.numbered(df, ids)
    assert sorted(x.id for x in every.collect()) == list(range(len({u for _, _, u in rows if u}))) and set(map(tuple, ids.collect())) <= set(map(tuple, every.collect()))
    days = distinct.daily(df, every, ["kind"])
    count = lambda k, a, z: len({u for x, d, u in rows if x == k and a <= d.day <= z and u})
    got = {x.kind: x.n for x in distinct.counted(days.where("day between date'2024-01-02' and date'2024-01-05'"), ["kind"]).collect()}
    assert got == {k: count(k, 2, 5) for k in "ab"}
    assert {(x.kind, x.day.day): x.n for x in distinct.rolling(days, ["kind"], 3).collect()} == {(k, z): count(k, z - 2, z) for k in "ab" for z in range(1, 10)}
    assert distinct.counted(distinct.added(days, days, ["kind"]), []).first().n == every.count() and distinct.counted(days.where("day is null"), ["kind"]).collect() == []


@pytest.mark.parametrize("part", [3000, 10_000_000])
def test_needles_in_texts(spark, part):
    """Against every text and needle, in one part and in many."""
    from loomsift.operators import containment

    r = random.Random(5)
    texts = [(k, "".join(r.choice("abé\U0001f600 ") for _ in range(r.randrange(60)))) for k in range(80)] + [(80, None), (81, ""), (3, "xyz" * 5000)]
    needles = [(k, "".join(r.choice("abé ") for _ in range(r.randint(1, 5)))) for k in range(60)] + [(90, None), (91, ""), (92, "zx" + "yzx" * 3000), (93, "b"), (94, "b"), (95, "\U0001f600")]
    df, some = spark.createDataFrame(texts, "key long, text string").withColumn("id", F.lit(1)), spark.createDataFrame(needles, "id int, needle string").withColumn("key", F.lit(1))
    want = {(k, i) for k, t in texts for i, n in needles if t and n and n in t}
    got = containment.held(df, some, part).collect()
    assert len(got) == len(want) and {tuple(x) for x in got} == want
    assert containment.held(df, some.where("id = 91")).collect() == [] and containment.held(df.where("key < 0"), some).collect() == []


@pytest.mark.parametrize("limit", [1, 5])
def test_circuits_of_split_sources(spark, limit):
    """A loop over each source, one of which has most rows, against pieces of many partitions."""
    r = random.Random(limit)
    rows = [(r.choice("aaaaaabcd"), k, r.choice(["ok", "transient", "transient", "transient", "permanent"]), k % 3) for k in range(3000)] + [("e", 9000 + k, "transient", 0) for k in range(limit - 1)]
    runs, gone, want = {}, set(), []
    for s, k, kind, x in rows:
        if s not in gone:
            runs[s] = 0 if kind == "ok" else runs.get(s, 0) + (kind == "transient")
            breaks = kind == "transient" and runs[s] == limit
            gone |= {s} if breaks else set()
            want.append((s, k, kind, x, breaks))
    df = spark.createDataFrame(r.sample(rows, len(rows)), "source string, seq int, kind string, stop int").repartition(5)
    got = tables.broken_circuits(df, limit)
    assert got.columns == [*df.columns, "breaks"] and sorted(map(tuple, got.collect())) == sorted(want)
    assert tables.broken_circuits(df.where("seq < 0"), limit).collect() == []


def test_circuits_split_one_source(spark):
    """Each piece of the one source is some of its rows, and no break is lost where pieces meet."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small pieces stay apart
    df = spark.range(40_000).selectExpr("'s' as source", "id as seq", "case when id % 100 < 90 or id >= 35000 then 'transient' else 'ok' end as kind")
    pieces, name = tables.pieces_of(df)
    sizes = [r["count"] for r in pieces.groupBy(name).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 15_000
    for limit in (91, 2000):
        runs, stop = 0, None
        for k in range(40_000):
            runs = runs + 1 if k % 100 < 90 or k >= 35_000 else 0
            if runs == limit:
                stop = k
                break
        assert [r.seq for r in tables.broken_circuits(df, limit).where("breaks").collect()] == [stop]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_cascade(spark):
    staged = spark.createDataFrame([("ieee:1", "deep learning for graphs a survey", 1, 0, "queued"), ("arxiv:2", "attention is all you need", 2, 1, "queued")], DOCS)
    new = spark.createDataFrame([("ieee:1", "x", 1, 2, ""), ("arxiv:3", "deep learning for graph a survey", 2, 3, ""), ("ieee:4", "attention is all you need", 1, 4, ""), ("arxiv:5", "quite other", 2, 5, "")], DOCS)
    want = {"ieee:1": ("duplicate_id", "ieee:1"), "arxiv:3": ("duplicate_fuzzy", "ieee:1"), "ieee:4": ("supersedes", "arxiv:2"), "arxiv:5": ("new", None)}
    assert {r.uid: (r.action, r.matched_uid) for r in dedup.decided(new, staged).collect()} == want
    assert {r.uid: (r.action, r.matched_uid) for r in cascade.resolved(new, staged).collect()} == want


def test_order_matters_inside_a_batch(spark):
    none = spark.createDataFrame([], DOCS)
    batch = spark.createDataFrame([("arxiv:1", "a b c d e f g h", 2, 0, ""), ("ieee:2", "a b c d e f g h", 1, 1, ""), ("arxiv:3", "a b c d e f g h", 2, 2, ""), ("arxiv:1", "zzz", 2, 3, "")], DOCS)
    got = {r.seq: (r.action, r.matched_uid) for r in cascade.resolved(batch, none).collect()}
    assert got == {0: ("new", None), 1: ("supersedes", "arxiv:1"), 2: ("duplicate_fuzzy", "ieee:2"), 3: ("new", None)}


def test_superseding_chain_and_titles_that_come_back(spark):
    """A superseded row leaves its title to the row before it; took names what was replaced, nearest first."""
    t = "a b c d e f g h i j"
    old = spark.createDataFrame([("x:1", t, 5, 0, "queued"), ("x:2", t, 4, 1, "queued"), ("x:3", "far from it all", 1, 2, "queued")], DOCS)
    batch = spark.createDataFrame([("y:1", t, 3, 0, ""), ("y:2", t, 2, 1, ""), ("y:3", t, 9, 2, ""), ("x:3", "w", 1, 3, "")], DOCS)
    got = {r.seq: (r.action, r.matched_uid, [tuple(k) for k in r.took]) for r in cascade.resolved(batch, old).collect()}
    assert got == {0: ("supersedes", "x:2", [(True, 1)]), 1: ("supersedes", "y:1", [(False, 0), (True, 1)]), 2: ("duplicate_fuzzy", "y:2", []), 3: ("duplicate_id", "x:3", [])}


def test_cascade_against_one_loop(spark):
    """Random rows of few titles, tiers and uids, one by one against every live row."""
    r = random.Random(3)
    names = ["graph neural nets for all", "graph neural nets for al", "graph neural nets for", "deep learning of titles", "deep learning of title", "other"]
    old = [(f"s:{k}", r.choice(names), r.randint(1, 3), k, "queued") for k in range(6)]
    new = [(r.choice([f"n:{k}", f"s:{r.randrange(6)}", f"n:{r.randrange(30)}"]), r.choice(names), r.randint(1, 3), k, "") for k in range(40)]
    want = slow_cascade([x[:4] for x in new], [x[:4] for x in old], 93)
    got = cascade.resolved(spark.createDataFrame(new, DOCS), spark.createDataFrame(old, DOCS)).collect()
    assert sorted(((x.uid, x.seq, x.action, x.matched_uid, round(x.score, 6)) for x in got), key=str) == sorted(want, key=str)


def test_cascade_of_a_hot_title_with_many_tiers(spark):
    """A third of the rows have one title; tiers are many, uids come again, and some titles are empty: like none."""
    r = random.Random(2)
    names = ["one hot title of all titles here"] * 4 + ["one hot title of all titles her", "one hot title of all title here", "one hot title of all titles", "alone", ""]
    old = [(f"s:{k}", r.choice(names), r.randint(1, 9), k, "queued") for k in range(8)]
    new = [(r.choice([f"n:{k}", f"s:{r.randrange(8)}", f"n:{r.randrange(90)}"]), r.choice(names), r.randint(1, 9), k, "") for k in range(120)]
    own = lambda rows: [(u, t or chr(0x4E00 + k) * 30, tier, k) for u, t, tier, k, _ in rows]
    want = slow_cascade(own(new), own(old), 93)
    got = cascade.resolved(spark.createDataFrame(new, DOCS), spark.createDataFrame(old, DOCS)).collect()
    assert sorted(((x.uid, x.seq, x.action, x.matched_uid, round(x.score, 6)) for x in got), key=str) == sorted(want, key=str)


def test_a_hot_title_costs_rows_by_its_tiers(spark):
    """Rounds look at the rows that may change the state, however many share a title."""
    batch = spark.range(5000).selectExpr("concat('u:', id) as uid", "'the title of them all' as title_normalized", "cast(9 - id % 7 as int) as authority_tier", "id as seq")
    none = spark.createDataFrame([], DOCS)
    got = cascade.resolved(batch, none)
    assert {(r.action, r["count"]) for r in got.groupBy("action").count().collect()} == {("new", 1), ("supersedes", 6), ("duplicate_fuzzy", 4993)}
    last = got.where("seq = 6").first()
    assert [k.seq for k in last.took] == [5, 4, 3, 2, 1, 0]
    rows = batch.selectExpr("uid", "title_normalized as title", "authority_tier as tier", "struct(1 as batch, seq) as at")
    near = spark.createDataFrame([("the title of them all", "the title of them all", 100.0)], "title string, other string, score double")
    spans = rows.where("at.seq < 7").withColumn("end", F.expr("case when at.seq < 6 then struct(1 as batch, at.seq + 1 as seq) end"))
    assert cascade._changing(rows, spans, near).count() <= 7 * 8


@pytest.mark.parametrize(("few", "block"), [(4096, 20_000), (3, 20_000), (4096, 10), (3, 10)])
def test_cascade_in_blocks_settles_at_once(spark, monkeypatch, few, block):
    """Chains of replacements among like titles, walked whole or by stretches, in one block and in many. In one block the second
    round finds nothing new, however long a chain is."""
    monkeypatch.setattr(cascade, "FEW", few)
    monkeypatch.setattr(cascade, "BLOCK", block)
    r = random.Random(4)
    names = [f"a title of some length that ends in {k}" for k in range(12)] + ["another title that is like none of them"]
    old = [(f"s:{k}", r.choice(names), r.randint(20, 31), k, "queued") for k in range(5)]
    new = [(r.choice([f"n:{k}", f"n:{r.randrange(90)}"]) if few < 9 else f"n:{k}", r.choice(names), max(1, 30 - k // 3 + r.randint(0, 4)), k, "") for k in range(90)]
    want = slow_cascade([x[:4] for x in new], [x[:4] for x in old], 93)
    assert sum(x[2] == "supersedes" for x in want) > 12
    got = cascade.resolved(spark.createDataFrame(new, DOCS), spark.createDataFrame(old, DOCS), rounds=2 if few + block > 20_003 else 200).collect()
    assert sorted(((x.uid, x.seq, x.action, x.matched_uid, round(x.score, 6)) for x in got), key=str) == sorted(want, key=str)


def test_copies_of_staged_rows_do_not_multiply(spark, monkeypatch):
    """Each staged row is one line of one block, however many documents have a title like its own."""
    names = ["a title that very many staged rows have", "a title that very many staged rows had"]
    old = [(f"s:{k}", names[k % 2], 1 + k % 3, k, "queued") for k in range(120)]
    new = [(f"n:{k}", names[k % 5 % 2], 1 + (k * 7) % 3, k, "") for k in range(90)]
    seen, walked = [], cascade._walked
    monkeypatch.setattr(cascade, "_walked", lambda *x: [seen.append(sum(df.count() for df in x[:4])), walked(*x)][1])
    got = cascade.resolved(spark.createDataFrame(new, DOCS), spark.createDataFrame(old, DOCS)).collect()
    want = slow_cascade([x[:4] for x in new], [x[:4] for x in old], 93)
    assert sorted(((x.uid, x.seq, x.action, x.matched_uid, round(x.score, 6)) for x in got), key=str) == sorted(want, key=str)
    assert seen and max(seen) == len(old) + len(new)


def test_cascade_raises_when_rounds_run_out(spark):
    batch = spark.createDataFrame([(f"u:{k}", "the title of them all", 9 - k, k, "") for k in range(4)], DOCS)
    with pytest.raises(RuntimeError, match="1 rounds"):
        cascade.resolved(batch, spark.createDataFrame([], DOCS), rounds=1)
    assert cascade.resolved(batch.where("seq < 0"), batch).collect() == []


def test_many_lanes_give_the_ratio(spark):
    r = random.Random(1)
    words = ["".join(r.choice("abcé ") for _ in range(r.choice([0, 1, 5, 40, 62, 63, 64, 90, 300]))) for _ in range(120)] + ["\0a", "a\0"]
    pairs = [(r.choice(words), r.choice(words)) for _ in range(400)] + [(None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [x.r for x in df.select(dedup.indel_ratio("a", "b").alias("r")).collect()]
    assert got == [None if a is None or b is None else pytest.approx(dedup.ratio(a, b)) for a, b in pairs]


def test_winner_takes_over_what_it_lacks(spark):
    cols = "uid string, alternate_uids array<string>, abstract string, authors array<string>, full_text string, seq long"
    lost = spark.createDataFrame([("l", ["o"], "abs", ["n"], None, 0), ("k", [], None, None, "deep", 1)], cols).withColumn("staged", F.lit(False))
    took = "took array<struct<staged boolean, seq long>>"
    winner = spark.createDataFrame([("w", [], "", [], None, 5, [(False, 0)]), ("v", ["l"], "own", ["m"], "t", 6, [(False, 0)]), ("u", None, None, None, None, 7, [(False, 0), (False, 1)]), ("t", [], "x", [], "", 8, [])], f"{cols}, {took}")
    got = {r.uid: (r.alternate_uids, r.abstract, r.authors, r.full_text) for r in dedup.merged(winner, lost).collect()}
    assert got == {"w": (["o", "l"], "abs", ["n"], None), "v": (["l"], "own", ["m"], "t"), "u": (["o", "k", "l"], "abs", ["n"], "deep"), "t": ([], "x", [], "")}


# --- sources, sinks and plans ---


def written(path, x):
    path.write_text(x if isinstance(x, str) else json.dumps(x), encoding="utf-8")
    return f"file://{path}"


def test_articles(spark, tmp_path):
    a = {"article_number": "38111222", "title": " T ", "abstract": " ", "publication_year": "2025", "pdf_url": "p", "authors": {"authors": [{"full_name": "A B"}]}}
    ok = written(tmp_path / "a.json", {"articles": [a, {**a, "article_number": "123"}]})
    (r,) = readers.articles(spark, ok).collect()
    assert (r.uid, r.title, r.abstract, r.authors, r.url, r.authority_tier, r.published_date.year) == ("ieee:38111222", "T", None, ["A B"], "p", 1, 2025)
    for bad in ({"total": 1}, {"articles": [{**a, "title": " "}]}, {"articles": [{**a, "title": None, "article_number": "7"}]}):
        for columns in (["*"], ["uid"], ["url"]):
            with pytest.raises(Exception, match="articles|no title"):
                readers.articles(spark, written(tmp_path / "b.json", bad)).select(*columns).collect()


def test_atom(spark, tmp_path):
    entry = "<entry><id>http://x.org/abs/{0}v2</id><title>A\n  title</title><summary> S </summary><published>2024-01-02T03:04:05Z</published><author><name>N M</name></author></entry>"
    (a, b) = readers.atom(spark, written(tmp_path / "f.xml", f"<feed>{entry.format('2401.12345')}{entry.format('2503.00042')}</feed>")).orderBy("uid").collect()
    assert (a.uid, a.title, a.abstract, a.authors) == ("arxiv:2401.12345", "A title", "S", ["N M"]) and b.uid == "arxiv:2503.00042"
    for bad in (f"<feed>{entry.format('none')}</feed>", f"<feed>{entry.format('2401.12345').replace('A\n  title', ' ')}</feed>", "no feed", "<feed><title>cut of"):
        for columns in (["*"], ["uid"], ["url"]):
            with pytest.raises(Exception, match="valid id|no feed"):
                readers.atom(spark, written(tmp_path / "g.xml", bad)).select(*columns).collect()
    assert readers.atom(spark, written(tmp_path / "e.xml", "<?xml version='1.0'?><feed xmlns='http://www.w3.org/2005/Atom'><title>none</title></feed>")).collect() == []


def test_seed_manifest_and_config(spark, tmp_path):
    p = {"source": "arxiv", "source_id": "arxiv:2401.12345", "authority_tier": 2, "title": "X: y", "authors": ["a"], "published_date": "2024-01-01T00:00:00+00:00", "url": "u", "abstract": "b"}
    assert readers.seed(spark, written(tmp_path / "s.json", {"papers": [p]})).first().title_normalized == "x y"
    items = [{"source": "ieee", "id": "12345678", "rank": 2}, {"source": "ieee", "id": "87654321", "rank": 1}, {"source": "ieee", "id": "7", "rank": 3}]
    ids, bad = readers.manifest(spark, written(tmp_path / "m.json", {"items": items}))
    assert ids.first().ids == ["87654321", "12345678"] and [r.raw_id for r in bad.collect()] == ["7"]
    written(tmp_path / "c.json", {"sources": {}})
    assert readers.config(str(tmp_path / "c.json"), ("sources",)) == {"sources": {}}
    with pytest.raises(readers.LayoutError):
        readers.config(str(tmp_path / "c.json"), ("criteria",))


def test_remote_source(spark):
    spark.dataSource.register(remote.source("fake_papers", "id string, n int", lambda ids: [(i, len(ids)) for i in ids], 2))
    got = spark.read.format("fake_papers").option("ids", "a,b,c").load().collect()
    assert sorted(map(tuple, got)) == [("a", 2), ("b", 2), ("c", 1)]
    assert spark.read.format("fake_papers").load().count() == 0


def test_retries():
    calls, waits = [], []

    def call():
        calls.append(1)
        remote.failed(503 if len(calls) < 3 else 200)
        return "ok"

    assert remote.retried(call, sleep=waits.append) == "ok" and len(waits) == 2
    with pytest.raises(remote.Transient):
        remote.retried(lambda: remote.failed(429), sleep=waits.append)
    with pytest.raises(ValueError, match="404"):
        remote.retried(lambda: remote.failed(404), sleep=waits.append)


PAPERS = "uid string, source string, source_id string, authority_tier int, alternate_uids array<string>, title string, title_normalized string, abstract string, authors array<string>, published_date timestamp, url string, full_text string, status string, seq long"


def paper(n, title, tier=2, words=200, link="github.com zenodo"):
    sid = f"arxiv:2401.{10000 + n}" if tier == 2 else f"{10000000 + n}"
    source = "arxiv" if tier == 2 else "ieee"
    return (sid if tier == 2 else f"ieee:{sid}", source, sid, tier, [], title, title, f"{'w ' * words}{link}", ["a"], at(24), "u", None, "fetched", n)


def staged(spark, rows=()):
    return spark.createDataFrame(list(rows), PAPERS).withColumn("last_interaction_at", F.lit(at(1)))


def test_batch(spark):
    first = [paper(1, "one long title of a paper"), paper(2, "another title altogether"), paper(3, "one long title of a paper", tier=1), paper(4, "third of them", words=1, link=""), paper(5, "another title altogethe")]
    b = ingest.run(spark.createDataFrame(first, PAPERS), staged(spark), now())
    r = b.report.first()
    assert (r.fetched, r.new, r.duplicates, r.superseded, r.rubric_rejected, r.queued, r.dlq) == (5, 3, 1, 1, 1, 3, 0)  # the loser was queued before it was superseded
    assert {x.uid: x.status for x in b.staged.collect()} == {"arxiv:2401.10002": "queued", "ieee:10000003": "queued", "arxiv:2401.10004": "rejected"}
    again = ingest.run(spark.createDataFrame(first, PAPERS), b.staged.withColumn("last_interaction_at", F.lit(at(1))).checkpoint(), now()).report.first()
    assert (again.new, again.duplicates, again.superseded) == (0, 5, 0)
    wrong = ingest.run(spark.createDataFrame([(*paper(1, "x")[:2], "nonsense", *paper(1, "x")[3:])], PAPERS), staged(spark), now())
    assert wrong.report.first().dlq == 1 and wrong.staged.count() == 0


def test_batch_keeps_all_rows_and_merges(spark):
    """A uid that lost comes again under another title; the winner lacks an abstract and gets the loser's."""
    rows = [paper(1, "one long title of a paper"), (*paper(3, "one long title of a paper", tier=1)[:7], "", *paper(3, "", tier=1)[8:]), (*paper(1, "quite another title")[:13], 9)]
    b = ingest.run(spark.createDataFrame(rows, PAPERS), staged(spark), now())
    r = b.report.first()
    assert (r.fetched, r.new, r.superseded, r.queued, r.dlq) == (3, 2, 1, 3, 0)
    got = {x.uid: (x.title, x.alternate_uids, x.abstract, x.status) for x in b.staged.collect()}
    assert got == {"ieee:10000003": ("one long title of a paper", ["arxiv:2401.10001"], rows[0][7], "queued"), "arxiv:2401.10001": ("quite another title", [], rows[2][7], "queued")}
    assert sorted((e.uid, e.event_type, e.detail) for e in b.events.collect()) == [("ieee:10000003", "DEDUP_MERGED", "arxiv:2401.10001")]


def failing(kinds):
    """Parse with an error by uid: transient or permanent."""
    known = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])

    def parse(df):
        kind = F.try_element_at(known, F.col("uid"))
        return df.withColumn("error", F.when(kind.isNotNull(), F.struct(kind.alias("type"), F.lit("why").alias("detail"), (kind == "transient").alias("transient"))).cast(ingest.ERROR))

    return parse


def uids(n):
    return f"arxiv:2401.{10000 + n}"


def test_batch_failures(spark):
    rows = [paper(k, f"{'abcdefgh'[k] * 9} title {k}") for k in range(8)] + [paper(9, "last of all the titles", tier=1)]
    good = (*paper(8, "x")[:2], "nonsense", *paper(8, "x")[3:])
    out = spark.createDataFrame([("s", "Timeout", "no answer", True)], ingest.OUTAGE)
    kinds = {uids(0): "transient", uids(1): "permanent", uids(3): "transient", uids(4): "transient", uids(5): "transient", uids(6): "transient"}
    asked, parse = [], failing(kinds)

    def counted(df):
        asked.extend(x.uid for x in df.select("uid").collect())
        return parse(df)

    b = ingest.run(spark.createDataFrame([*rows, good], PAPERS), staged(spark), now(), parse=counted, outages=out)
    r = b.report.first()
    assert len(asked) == len(set(asked)) == 9  # the round after a break asks nothing again
    # 3, 4 and 5 fail in a row: 6 and 7 were never looked at; the other source goes on
    assert (r.fetched, r.new, r.queued, r.dlq, r.skipped_sources) == (9, 7, 2, 7, ["arxiv", "s"])
    assert {x.uid: x.status for x in b.staged.collect()} == {uids(2): "queued", "ieee:10000009": "queued"} | {uids(k): "dlq" for k in (0, 1, 3, 4, 5)}
    assert sorted((x.uid, x.retry_eligible, x.attempts) for x in b.dlq.collect()) == sorted([("s:batch", True, 1), (good[0], False, 1), (uids(1), False, 1), *((uids(k), True, 1) for k in (0, 3, 4, 5))])
    assert sorted(x.uid for x in b.quarantined.collect()) == sorted([good[0], uids(1)]) and all("title" in json.loads(x.raw) for x in b.quarantined.collect())

    todo = b.dlq.where("retry_eligible and uid like 'arxiv%'").withColumn("id", F.xxhash64("uid")).checkpoint()
    fetch = lambda t: t.where(F.col("uid") != uids(4)).select("uid", F.col("id").alias("entry_id")).join(spark.createDataFrame(rows, PAPERS), "uid").select("entry_id", *[c.split()[0] for c in PAPERS.split(", ")])
    kept = b.staged.withColumn("seq", F.monotonically_increasing_id()).withColumn("last_interaction_at", F.lit(at(1))).checkpoint()
    again, done = ingest.retried(todo, fetch, kept, now(), parse=failing({uids(5): "transient"}))
    assert sorted(x.uid for x in done.join(todo, "id").collect()) == [uids(0), uids(3)]
    assert {x.uid: x.status for x in again.staged.collect()} == {uids(k): "queued" for k in (0, 2, 3)} | {"ieee:10000009": "queued", uids(1): "dlq", uids(5): "dlq"}


def test_heal(spark):
    d, dlq, e, runs, _, _ = frames(spark, dlq=[("a:1", "net", 4, True, at(1)), ("a:2", "net", 1, True, at(1)), ("b:1", "net", 1, True, at(1)), ("a:batch", "net", 1, True, at(1))], docs=[(f"d{k}", "queued", float(k), None, "x") for k in range(12)], runs=[(at(2), "{}")])
    up = spark.createDataFrame([("a",)], "source string")
    h = heal.cycle(d, dlq, e, up, lambda f: f.where("uid = 'a:1'"), lambda f: f.withColumn("tech_meta", F.lit("m")), now(), 3)
    assert {r.uid: (r.attempts, r.retry_eligible) for r in h.dlq.collect()} == {"a:1": (5, False), "b:1": (1, True), "a:batch": (1, True)}
    assert h.enriched.count() == heal.ENRICH_LIMIT and h.batch is None
    assert {x.event_type for x in h.new_events.collect()} == {"ENRICHED"} and h.failed.count() == 0
    assert heal.cycle(d, dlq, e, up, lambda f: f, lambda f: f, now(), 12).enriched.count() == 0

    kinds = {"d11": "permanent", "d9": "transient", "d8": "permanent"}
    h = heal.cycle(d, dlq, e, up, lambda f: f.limit(0), failing(kinds), now(), 3)
    assert {x.uid: x.status for x in h.enriched.collect()} == {"d11": "dlq", "d10": "queued"}  # best first, up to the transient one
    assert [(x.uid, x.retry_eligible) for x in h.failed.collect()] == [("d11", False)] and [x.uid for x in h.quarantined.collect()] == ["d11"]

    asked = []

    def rerun(query):
        asked.append(query)
        return ingest.run(spark.createDataFrame([paper(1, "one long title of a paper"), paper(2, "one long title of a paper")], PAPERS), staged(spark), now(), outages=spark.createDataFrame([("a", "Timeout", "", True)], ingest.OUTAGE))

    h = heal.cycle(d, dlq, e, up, lambda f: f.limit(0), None, now(), 12, runs.withColumn("query", F.lit("rag")), rerun)
    assert asked == ["rag"] and "a:batch" not in [x.uid for x in h.dlq.collect()] and [x.uid for x in h.failed.collect()] == ["a:batch"]
    assert [x.event_type for x in h.new_events.collect()] == ["DEDUP_DROPPED"] and h.batch.report.first().queued == 1


def test_upsert_takes_new_rows_in_order(spark):
    cols = "uid string, source string, fetched_at long, status string"
    old = spark.createDataFrame([("a", "s", 1, "x"), ("b", "s", 1, "x")], cols)
    new = spark.createDataFrame([("a", "t", 2, "y", 1), ("a", "u", 3, "z", 2), ("c", "v", 4, "p", 1), ("c", "w", 5, "q", 2)], cols + ", n long")
    assert sorted(map(tuple, tables.upserted(old, new, seq="n").collect())) == [("a", "s", 1, "z"), ("b", "s", 1, "x"), ("c", "v", 4, "q")]


def test_sinks(spark, tmp_path, capsys):
    df = spark.createDataFrame([(1, "mail a.b@example.org now")], "id long, t string")
    sinks.audit(df, "id", "t", f"file://{tmp_path}/audit", now())
    (line,) = spark.read.json(f"file://{tmp_path}/audit").collect()
    assert line.rule_id == "EMAIL" and len(line.match_sha256_12) == 12 and "example" not in str(line)
    sinks.quarantine(spark.createDataFrame([("a:1", "raw")], "uid string, raw string"), f"file://{tmp_path}/q", now())
    assert spark.read.json(f"file://{tmp_path}/q").first().name == "a_1"
    with pytest.raises(ValueError, match="no ids"):
        sinks.manifest(df.where("id < 0"), f"file://{tmp_path}/m")
    sinks.manifest(df, f"file://{tmp_path}/m")
    sinks.notify("t", "m", (lambda t, m: 1 / 0,))
    assert "[alert] t: m" in capsys.readouterr().err


def test_publish(spark):
    d = spark.createDataFrame([], schema.DOCUMENT)
    rows = [("a", "p1"), ("b", None)]
    docs = spark.createDataFrame(rows, "uid string, page_id string")
    for f in d.schema.fields:
        if f.name not in ("uid", "page_id"):
            docs = docs.withColumn(f.name, F.lit("x" * 3000 if f.name == "title" else "queued" if f.name == "status" else None).cast(f.dataType))
    dry = {r.uid: (r.status, r.page_id, r.event_type) for r in sinks.published(docs, None).collect()}
    assert dry == {"a": ("queued", "p1", None), "b": ("approved_local", None, "APPROVED")}
    sent = {r.uid: (r.status, r.page_id) for r in sinks.published(docs, lambda u, p: f"page-{u}-{len(json.loads(p)['reference']['title'])}").collect()}
    assert sent == {"a": ("queued", "p1"), "b": ("approved", "page-b-2000")}


def test_streams(spark, tmp_path):
    spark.createDataFrame([("K", True, at(30)), ("K", True, at(29)), ("K", True, at(3)), ("K", False, at(2))], "key string, wanted boolean, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/s")
    s = spark.readStream.schema("key string, wanted boolean, at timestamp").parquet(f"{tmp_path}/s")
    q = flows.alert_transitions(s).writeStream.format("memory").queryName("steps").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [r.transition for r in spark.table("steps").orderBy("at").collect()] == ["OPEN", "REALERT", "RESOLVED"]
    seen = []
    flows.incremental(s, lambda df, n: seen.append(df.count()), f"{tmp_path}/c").awaitTermination(120)
    assert seen == [4]
    spark.createDataFrame([("a:1", at(1)), ("a:2", at(1)), ("b:1", at(1))], "uid string, created_at timestamp").write.parquet(f"{tmp_path}/d")
    w = flows.windowed_failures(spark.read.parquet(f"{tmp_path}/d"), span="24 hours", step="24 hours").collect()
    assert sorted((r.source, r.n) for r in w) == [("a", 2), ("b", 1)]


def test_titles_as_they_come(spark, tmp_path):
    """Three micro-batches give the pairs of one batch; a batch that comes again gives its own, and adds nothing."""
    from loomsift.streaming import title_index

    r = random.Random(11)
    seeds = ["deep learning for large graphs", "a survey of entity resolution", "streams with timers and state"]
    rows = [(str(k), "".join(c for c in r.choice(seeds) if r.random() > 0.03)) for k in range(60)] + [("60", ""), ("61", None), ("62", seeds[0]), ("63", seeds[0])]
    batch = {i: k % 3 for k, (i, _) in enumerate(rows)}
    for n in range(3):
        spark.createDataFrame([x for x in rows if batch[x[0]] == n], "id string, title string").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    df = spark.createDataFrame(rows, "id string, title string")
    want = {(x.left_id, x.right_id, round(x.score, 6)) for x in dedup.similar(df, df).collect() if batch[x.right_id] <= batch[x.left_id]}
    s = spark.readStream.schema("id string, title string").option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    index, got = title_index.TitleIndex(f"{tmp_path}/index"), {}
    keep = lambda pairs, n: got.__setitem__(n, [(x.left_id, x.right_id, round(x.score, 6)) for x in pairs.collect()])
    title_index.similar_as_they_come(s, index, keep, f"{tmp_path}/c").awaitTermination(300)
    assert sorted(sum(got.values(), [])) == sorted(want) and len(got) == 3 and len(want) > 200
    runs = spark.read.parquet(f"{tmp_path}/index/runs").count()
    again = index.extended(spark.read.schema("id string, title string").parquet(f"{tmp_path}/in/1"), 1).collect()
    assert sorted((x.left_id, x.right_id, round(x.score, 6)) for x in again) == sorted(got[1]) and spark.read.parquet(f"{tmp_path}/index/runs").count() == runs


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def fed(spark, tmp_path, batches, schema, flow):
    """The rows of a stream over the batches, one a trigger."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{k}")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    name = f"t{tmp_path.name.replace('-', '_')}"
    q = flow(s).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(300)
    return spark.table(name)


def test_alerts_go_off_without_new_rows(rocks, tmp_path):
    """The clock is other keys' rows: an open alert reminds each day, a silent source opens after 36 hours."""
    h = lambda n: dt.datetime(2026, 1, 1) + dt.timedelta(hours=n)
    batches = [[("down", True, h(0)), ("calm", False, h(0)), ("tick", False, h(0))], [("tick", False, h(20))], [("tick", False, h(30))], [("tick", False, h(50)), ("down", False, h(52))], [("tick", False, h(60)), ("calm", False, h(61))], [("tick", False, h(62))]]
    rows = fed(rocks, tmp_path, batches, "key string, wanted boolean, at timestamp", flows.timed_alerts)
    got = sorted((r.key, (r.at - h(0)).total_seconds() / 3600, r.transition) for r in rows.collect())
    assert got == [("calm", 36, "OPEN"), ("calm", 60, "REALERT"), ("calm", 61, "RESOLVED"), ("down", 0, "OPEN"), ("down", 24, "REALERT"), ("down", 48, "REALERT"), ("down", 52, "RESOLVED")]


def test_touches_run_out_without_new_rows(rocks, tmp_path):
    h = lambda n: dt.datetime(2026, 1, 1) + dt.timedelta(hours=n)
    batches = [[("a", h(0)), ("b", h(1)), ("c", h(30))], [("a", h(40)), ("c", h(72))], [("c", h(80))], [("c", h(120))], [("c", h(121))]]
    rows = fed(rocks, tmp_path, batches, "uid string, at timestamp", flows.expired)
    assert sorted((r.uid, (r.at - h(0)).total_seconds() / 3600) for r in rows.collect()) == [("a", 112), ("b", 73)]
