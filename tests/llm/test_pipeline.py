from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from loomsift.llm import common, near_dup, queries, quality, secrets, substring
from oracle import duck, sparked

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    raw = docs = common.table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = common.stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == raw.columns
    before = {r.doc_id: r.text for r in raw.collect()}
    kept = {r.doc_id: r.text for r in seen["quality"].collect()}
    assert 0.7 * len(before) < len(kept) < len(before) and all(before[i] == t for i, t in kept.items())
    assert not any(quality.base_failed(r.n_words, r.n_repeat_words) for r in quality.score(seen["quality"], None).collect())
    assert all(r.kept for r in near_dup.components(seen["near_dedup"]).collect())
    assert {r.doc_id for r in near_dup.components(seen["quality"]).where("kept").collect()} == {r.doc_id for r in seen["near_dedup"].collect()}
    cut = {r.doc_id: len((r.text or "").split()) for r in seen["substring"].collect()}
    want = {r.doc_id: r.n_words - r.n_removed for r in substring.digest(seen["near_dedup"]).collect()}
    assert cut == want and sum(cut.values()) < sum(len(t.split()) for t in kept.values())
    assert all(r.n_assign + r.n_access + r.n_hex == 0 for r in secrets.scan(seen["secrets"]).collect())
    packed = seen["packing"].groupBy("doc_id").agg({"doc_tokens": "max", "length": "sum"}).collect()
    assert len(packed) == len(cut) and all(r[1] == r[2] for r in packed)


def plain(rows, columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


def test_stages_on_odd_rows_and_columns(spark, odd, nothing):
    """Nulls, blanks, ties, repeats and clashing names: every stage keeps the columns, drops or changes only what it must."""
    extra = odd.withColumn("bucket", F.lit(1)).withColumn("key", F.lit("k")).withColumn("cuts", F.lit(None).cast("int")).withColumn("n_chars", F.length("text"))
    docs = extra
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = common.stored(stage(spark, docs, SF), name)
        after = docs.collect()
        if name == "packing":
            assert plain(Counter((r.doc_id) for r in after if not r.start).items(), (0, 1)) == plain(Counter(r.doc_id for r in before).items(), (0, 1))
            break
        assert docs.dtypes == extra.dtypes
        same = [c for c in extra.columns if c not in ("text", "n_chars")]
        if name in ("quality", "near_dedup"):
            assert set(plain(after, extra.columns)) <= set(plain(before, extra.columns))
        else:
            assert plain(before, same) == plain(after, same)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, nothing, SF)
        assert got.collect() == [] and (name == "packing" or got.columns == nothing.columns)


def test_run_is_the_stages(spark):
    rows = entry.queries()["pipeline"](spark, SF).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in common.table(spark, SF, "documents").collect()}


def test_sql_gives_the_same_rows(spark):
    for name, sql in queries.ORACLE_SQL.items():
        assert sparked(queries.QUERIES[name](spark, SF)) == duck(SF, sql), name


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
