"""Sinks and sources over injected transports, and model calls: in Python workers, so what they did is counted in files."""

import json
import os
import sys
import time
import uuid
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from loomsift.plans import calls
from loomsift.sources import outbox, remote, search

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't find this file


def note(folder, what):
    name = uuid.uuid4().hex
    with open(f"{folder}/.{name}", "w") as f:
        json.dump(what, f)
    os.replace(f"{folder}/.{name}", f"{folder}/{name}")  # readers see whole notes


def noted(folder):
    return [json.load(open(f"{folder}/{n}")) for n in os.listdir(folder) if n[0] != "."]


def made(tmp_path, name):
    os.makedirs(f"{tmp_path}/{name}")
    return f"{tmp_path}/{name}"


def service(sent, fails):
    """A service that notes what it is sent, and stops once after each uid in ``fails``, before it answers."""

    def send(uid, payload):
        note(sent, [uid, payload])
        mark = f"{fails}/{uid}"
        if os.path.exists(mark):
            os.remove(mark)
            raise RuntimeError("killed")
        return f"page-{uid}"

    def find(uid):
        return next((f"page-{u}" for u, _ in noted(sent) if u == uid), None)

    return send, find


def test_a_killed_and_repeated_job_sends_nothing_twice(spark, tmp_path):
    sent, fails = made(tmp_path, "sent"), made(tmp_path, "fails")
    for k in (3, 40):
        open(f"{fails}/u{k}", "w").close()
    send, find = service(sent, fails)
    box, told = outbox.Folder(f"{tmp_path}/box"), []
    spark.dataSource.register(outbox.outbox("pages_once", box, send, find, lease=60.0, told=lambda *n: told.append(n)))
    docs = spark.range(50).selectExpr("concat('u', id) as uid", "concat('p', id) as payload").repartition(4).unionByName(spark.createDataFrame([("u7", "p7")], "uid string, payload string"))
    for _ in range(2):
        with pytest.raises(Exception, match="killed"):
            docs.coalesce(1).write.format("pages_once").mode("append").save()
    docs.write.format("pages_once").mode("append").save()
    docs.write.format("pages_once").mode("append").save()
    assert Counter(u for u, _ in noted(sent)) == {f"u{k}": 1 for k in range(50)}
    assert {tuple(r) for r in spark.read.format("pages_once").load().collect()} == {(f"u{k}", f"page-u{k}") for k in range(50)}


def test_claims_are_taken_over_after_their_lease(tmp_path):
    """An attempt that died before it sent: its claim counts until the lease is over."""
    sent, fails = made(tmp_path, "sent"), made(tmp_path, "fails")
    send, find = service(sent, fails)
    box, waits = outbox.Folder(f"{tmp_path}/box"), []
    assert box.claim("u1") is None and box.claim("u1") >= 0
    at = box._at("claims", "u1")

    def sleep(s):
        waits.append(s)
        os.utime(at, (time.time() - 100, time.time() - 100))

    assert outbox.delivered("u1", "p", box, send, find, 50.0, sleep) == ("page-u1", True) and waits
    assert outbox.delivered("u1", "p", box, send, find, 50.0) == ("page-u1", False) and len(noted(sent)) == 1


def parts(limits):
    """Part names as a service: 'type' finds parts of a type, by pages; every third call is told to wait."""

    def ask(query, start, size):
        note(limits, [query, start, size])
        if len(os.listdir(limits)) % 3 == 0:
            remote.failed(429)
        t = pq.read_table("/root/testdata/sf0.001/part.parquet", columns=["p_partkey", "p_name", "p_type"]).to_pylist()
        found = [(r["p_partkey"], r["p_name"]) for r in t if query in r["p_type"]]
        return len(found), found[start : start + size]

    return ask


def test_search_with_pages_and_rate_limits(spark, tmp_path):
    calls_ = made(tmp_path, "calls")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(search.source("part_search", "p_partkey long, p_name string", parts(calls_), size=7, sleep=lambda s: None))
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    kind = part.first().p_type.split()[0]
    want = {(kind, r.p_partkey, r.p_name) for r in part.where(F.contains("p_type", F.lit(kind))).collect()}
    df = spark.read.format("part_search").load()
    got = df.where(F.col("query") == kind).where("p_partkey >= 0")
    assert len(want) > 14 and set(map(tuple, got.collect())) == want and got.rdd.getNumPartitions() == -(-len(want) // 7)
    assert {q for q, _, _ in noted(calls_)} == {kind}
    assert search.found(spark, "part_search", kind, "no such").count() == len(want) and search.found(spark, "part_search", "no such").collect() == []
    assert search.found(spark, "part_search", kind, most=9).count() == 9
    assert spark.read.format("part_search").option("most", "10").option("query", kind).load().count() == 10
    with pytest.raises(Exception, match="query"):
        spark.read.format("part_search").load().count()
    q = spark.readStream.format("part_search").option("query", kind).load().writeStream.format("memory").queryName("found_parts").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start()
    for _ in range(60):
        if spark.table("found_parts").count() == len(want):
            break
        time.sleep(1)
    q.stop()
    assert set(map(tuple, spark.table("found_parts").collect())) == want


def test_model_calls(spark, tmp_path):
    """Each prompt is asked as often as it must be, whatever is made of the result afterwards."""
    asked = made(tmp_path, "asked")

    def call(text):
        note(asked, text)
        head = text.split("\n")[0]
        times = sum(t.split("\n")[0] == head for t in noted(asked))
        if head == "busy" or (head == "late" and times < 3):
            raise remote.Transient("HTTP 429")
        if head == "broken":
            raise ValueError("HTTP 400")
        if head == "prose" or (head == "mended" and "\n" not in text):
            return "I think so"
        return json.dumps({"verdict": "maybe" if head == "choice" else "include", "score": len(head)})

    todo = spark.createDataFrame([(k, t, "old") for k, t in enumerate(["good", "late", "busy", "broken", "prose", "mended", "choice", None])], "id int, prompt string, answer string")
    got = calls.answered(todo, F.col("prompt"), call, "verdict string, score int", {"verdict": ("include", "exclude")}, wait=lambda s: None)
    again = got.where("error is null").count(), got.count(), sorted(got.columns)
    rows = {r.id: r for r in got.collect()}
    assert again == (4, 8, ["answer", "error", "id", "prompt"])
    assert {k: tuple(rows[k].answer) for k in rows if rows[k].answer} == {0: ("include", 4), 1: ("include", 4), 5: ("include", 6)}
    assert {k: (rows[k].error.type, rows[k].error.transient) for k in rows if rows[k].error} == {2: ("Transient", True), 3: ("ValueError", False), 4: ("InvalidAnswer", False), 6: ("InvalidAnswer", False)}
    assert Counter(t.split("\n")[0] for t in noted(asked)) == {"good": 1, "late": 3, "busy": 3, "broken": 1, "prose": 2, "mended": 2, "choice": 2}


def test_rate_is_kept():
    rate, began = calls.Rate(50), time.monotonic()
    for _ in range(11):
        rate.wait()
    assert time.monotonic() - began >= 0.19
