"""Screening, extraction and review batches, with models that are tables of answers."""

import datetime as dt
import json

from pyspark.sql import functions as F

from loomsift.operators import tables
from loomsift.plans import review

def now():
    return F.lit(dt.datetime(2026, 7, 6, 12)).cast("timestamp")


DOC = "uid string, title string, abstract string, status string, seq long"
VERDICTS = "id long, uid string, agent string, model string, verdict string, criterion_id string, evidence_quote string, confidence string"
MODELS = {"screener_a": "m1", "screener_b": "m2", "tiebreaker": "m1"}


def said(verdict, criterion=None, quote=None, confidence="high"):
    return json.dumps({"verdict": verdict, "criterion_id": criterion, "evidence_quote": quote, "confidence": confidence})


def answering(spark, answers, seen=None):
    """answers: by (uid, agent)."""
    table = spark.createDataFrame([(*k, v) for k, v in answers.items()], "uid string, agent string, answer string")

    def ask(df):
        if seen is not None:
            seen.extend(tuple(r) for r in df.select("uid", "agent", *[c for c in ("first", "second") if c in df.columns]).collect())
        return df.join(table, ["uid", "agent"], "left").select("uid", "answer")

    return ask


def test_single_screener(spark):
    docs = spark.createDataFrame([(f"d{k}", "A title", "the abstract says so", "queued" if k < 6 else "approved", k) for k in range(7)], DOC)
    had = spark.createDataFrame([(1, "d0", "screener_a", "m1", "include", None, None, "high"), (2, "d1", "screener_b", "m1", "include", None, None, "high")], VERDICTS)
    criteria = spark.createDataFrame([("ET1",), ("ET2",)], "code string")
    answers = {("d1", "screener_a"): said("include", "ET1", "x"), ("d2", "screener_a"): said("exclude", "ET1", "THE  abstract"), ("d3", "screener_a"): said("exclude", "ET9", "the abstract"), ("d4", "screener_a"): "no json", ("d5", "screener_a"): None}
    verdicts, log = review.single(docs, had, criteria, answering(spark, answers), "m1")
    got = {r.uid: (r.verdict, r.criterion_id, r.confidence) for r in verdicts.collect()}
    assert got == {"d1": ("include", None, "high"), "d2": ("exclude", "ET1", "high"), "d3": ("invalid", "ET9", "high"), "d4": ("invalid", None, "low")}
    assert {r.uid: r.detail for r in log.collect()}["d2"] == "agent=screener_a, verdict=exclude, criterion=ET1"
    assert [r.uid for r in review.single(docs, had, criteria, answering(spark, answers), "m1", limit=2)[0].orderBy("uid").collect()] == ["d1", "d2"]


def test_dual_screening(spark):
    docs = spark.createDataFrame([(f"d{k}", "A title", "abstract", "queued", k) for k in range(7)], DOC)
    had = spark.createDataFrame([(1, "d0", "screener_a", "m1", "include", None, None, "high")], VERDICTS)
    log = spark.createDataFrame([("d6", "SCREEN_INCLUDED")], "uid string, event_type string")
    criteria = spark.createDataFrame([("ET1",), ("ET2",)], "code string")
    no = lambda c: said("exclude", c, "abstract")
    answers = {
        ("d0", "screener_b"): said("include"), ("d1", "screener_a"): no("ET1"), ("d1", "screener_b"): no("ET2"), ("d2", "screener_a"): said("include"), ("d2", "screener_b"): no("ET1"), ("d2", "tiebreaker"): no("ET1"),
        ("d3", "screener_a"): said("include"), ("d3", "screener_b"): no("ET1"), ("d3", "tiebreaker"): said("include", confidence="low"), ("d4", "screener_a"): "?", ("d4", "screener_b"): said("include"), ("d4", "tiebreaker"): None,
        ("d5", "screener_a"): said("include"), ("d5", "screener_b"): None,
    }
    seen = []
    got = review.dual(docs, had, log, criteria, answering(spark, answers, seen), MODELS, "r1")
    assert {r.uid: r.status for r in got.statuses.collect()} == {"d0": "queued", "d1": "rejected", "d2": "rejected", "d3": "queued"}
    events = {(r.uid, r.event_type) for r in got.events.collect()}
    assert {("d0", "SCREEN_INCLUDED"), ("d1", "SCREEN_EXCLUDED"), ("d2", "SCREEN_EXCLUDED"), ("d3", "SCREEN_ESCALATED")} <= events and not any(u == "d4" and e.startswith("SCREEN_") for u, e in events)
    assert ("d0", "screener_a") not in [x[:2] for x in seen] and not any(x[0] == "d6" for x in seen)
    assert sorted(x for x in seen if x[1] == "tiebreaker") == [("d2", "tiebreaker", "include", "exclude ET1"), ("d3", "tiebreaker", "include", "exclude ET1"), ("d4", "tiebreaker", "invalid", "include")]
    r = got.report.first()
    assert (r.processed, r.escalated, r.kappa_docs, r.single_model_mode) == (4, 1, 4, False) and r.kappa is not None
    alone = review.dual(docs, had, log, criteria, answering(spark, answers), MODELS | {"screener_b": "m1"}, "r1")
    assert alone.report.first().kappa is None and "SCREEN_SINGLE_MODEL" in [r.event_type for r in alone.events.collect()]


def test_extraction(spark):
    docs = spark.createDataFrame([(f"d{k}", "A title", "the data is open", "queued", k, "full text") for k in range(3)], DOC + ", full_text string")
    section = "struct<heading_raw:string,content:string,confidence:double>"
    docs = docs.withColumn("sections", F.lit(None).cast(f"struct<doc_type:string,context:{section},method:{section},findings:{section},implications:{section}>"))
    had = spark.createDataFrame([("d0",)], "uid string")
    facts = [{"field": review.FIELDS[1], "value": "open", "quote": "THE data", "section": "abstract"}, {"field": review.FIELDS[0], "value": "true", "quote": "made up", "section": "abstract"}, {"field": review.FIELDS[2], "value": "none", "quote": "", "section": "title"}, {"field": "other", "value": "x"}]
    table = spark.createDataFrame([("d1", json.dumps(facts)), ("d2", "broken")], "uid string, answer string")
    got, log = review.extraction(docs, had, lambda df: df.join(table, "uid").select("uid", "answer"), now())
    assert {(r.uid, r.field): r.verified for r in got.collect()} == {("d1", review.FIELDS[0]): 0, ("d1", review.FIELDS[1]): 1, ("d1", review.FIELDS[2]): 2}
    assert [tuple(r) for r in log.collect()] == [("d1", "EXTRACT_UNVERIFIED", review.FIELDS[0])]


def test_reject_and_lookups(spark):
    docs = spark.createDataFrame([("a", "queued", 1), ("b", "queued", 2)], "uid string, status string, authority_tier int")
    after, log = review.rejected(docs, spark.createDataFrame([("a", "off topic"), ("z", "x")], "uid string, reason string"))
    assert {r.uid: r.status for r in after.collect()} == {"a": "rejected", "b": "queued"} and [tuple(r) for r in log.collect()] == [("a", "REJECTED", "off topic")]
    assert tables.looked_up(docs, "b").first().authority_tier == 2 and tables.looked_up(docs, "z").first() is None
    assert {r.uid: r.held for r in tables.held(docs, spark.createDataFrame([("a",), ("z",)], "uid string")).collect()} == {"a": True, "z": False}
    assert [tuple(r) for r in tables.tier_index(spark.createDataFrame([("a", '{"authority_tier": 3}'), ("b", "?")], "uid string, p string"), "p").orderBy("uid").collect()] == [("a", 3), ("b", None)]
    rows = spark.createDataFrame([(2, "a", 0, 5), (1, "a", 1, 7), (3, "b", 1, 1)], "id long, uid string, verified int, created_at long")
    assert [r.id for r in tables.history(rows, "a").collect()] == [2, 1] and [r.id for r in tables.history(rows, "a", True).collect()] == [1]
    days = spark.createDataFrame([(dt.date(2026, 4, 7),), (dt.date(2026, 4, 6),)], "day date")
    assert [r.day.day for r in tables.aged_out(days, now()).collect()] == [7]
