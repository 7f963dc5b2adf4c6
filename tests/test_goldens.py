"""Two small batches of known papers: counts, statuses and scores to the second decimal, and a second run of the first."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomsift.functions.text import plain_title
from loomsift.plans import ingest

DAY = dt.datetime(2026, 7, 6)
COLUMNS = "uid string, source string, source_id string, authority_tier int, alternate_uids array<string>, title string, title_normalized string, abstract string, authors array<string>, published_date timestamp, url string, full_text string, status string, seq long"
# Id, date, words of the abstract, whether it links code (c) and data (d), title.
RAG = [
    ("2005.11401", "2020-05-22", 103, "", "Retrieval-Augmented Generation for Knowledge-Intensive NLP Tasks"),
    ("2310.11511", "2023-10-17", 105, "c", "Self-RAG: Learning to Retrieve, Generate, and Critique through Self-Reflection"),
    ("2401.15884", "2024-01-29", 93, "c", "Corrective Retrieval Augmented Generation"),
    ("2404.16130", "2024-04-24", 94, "c", "From Local to Global: A Graph RAG Approach to Query-Focused Summarization"),
    ("2401.18059", "2024-01-31", 104, "c", "RAPTOR: Recursive Abstractive Processing for Tree-Organized Retrieval"),
    ("2212.10496", "2022-12-20", 112, "c", "Precise Zero-Shot Dense Retrieval without Relevance Labels"),
    ("2301.12652", "2023-01-30", 94, "", "REPLUG: Retrieval-Augmented Black-Box Language Models"),
    ("2208.03299", "2022-08-05", 100, "c", "Atlas: Few-shot Learning with Retrieval Augmented Language Models"),
    ("2312.10997", "2023-12-18", 97, "", "Retrieval-Augmented Generation for Large Language Models: A Survey"),
    ("2501.09136", "2025-01-15", 93, "", "Agentic Retrieval-Augmented Generation: A Survey on Agentic RAG"),
    ("2312.10998", "2023-12-19", 28, "", "Retrieval Augmented Generation for Large Language Models -- A Survey"),
    ("10651234", "2024-11-10", 100, "c", "Retrieval-Augmented Generation for Large Language Models: A Survey"),
    ("10787654", "2025-03-05", 101, "cd", "Benchmarking Retrieval-Augmented Generation Systems: Metrics, Datasets, and Pitfalls"),
]
AGENTS = [
    ("2210.03629", "2022-10-06", 106, "c", "ReAct: Synergizing Reasoning and Acting in Language Models"),
    ("2303.11366", "2023-03-20", 94, "c", "Reflexion: Language Agents with Verbal Reinforcement Learning"),
    ("2302.04761", "2023-02-09", 105, "", "Toolformer: Language Models Can Teach Themselves to Use Tools"),
    ("2304.03442", "2023-04-07", 91, "c", "Generative Agents: Interactive Simulacra of Human Behavior"),
    ("2305.16291", "2023-05-25", 97, "c", "Voyager: An Open-Ended Embodied Agent with Large Language Models"),
    ("2308.11432", "2023-08-22", 92, "c", "A Survey on Large Language Model based Autonomous Agents"),
    ("2308.08155", "2023-08-16", 92, "c", "AutoGen: Enabling Next-Gen LLM Applications via Multi-Agent Conversation"),
    ("2308.03688", "2023-08-07", 94, "c", "AgentBench: Evaluating LLMs as Agents"),
    ("2310.06770", "2023-10-10", 100, "cd", "SWE-bench: Can Language Models Resolve Real-World GitHub Issues?"),
    ("2402.01030", "2024-02-01", 94, "c", "Executable Code Actions Elicit Better LLM Agents"),
    ("2405.15793", "2024-05-06", 90, "c", "SWE-agent: Agent-Computer Interfaces Enable Automated Software Engineering"),
    ("2407.16741", "2024-07-23", 90, "c", "OpenHands: An Open Platform for AI Software Developer Agents"),
]


def batch(spark, seed):
    rows = []
    for k, (sid, date, words, links, title) in enumerate(seed):
        source = "arxiv" if "." in sid else "ieee"
        uid = f"{source}:{sid}"
        told = [x for x, y in (("github.com/x", "c"), ("zenodo", "d")) if y in links]
        rows.append((uid, source, uid if source == "arxiv" else sid, 2 if source == "arxiv" else 1, [], title, plain_title(title), " ".join(["word"] * (words - len(told)) + told), ["a"], dt.datetime.fromisoformat(date), "u", None, "fetched", k))
    return spark.createDataFrame(rows, COLUMNS)


def held(df):
    return df.select(*[c.split()[0] for c in COLUMNS.split(", ")], "rubric").withColumn("last_interaction_at", F.lit(DAY)).checkpoint()


def empty(spark):
    return spark.createDataFrame([], COLUMNS).withColumn("last_interaction_at", F.lit(DAY))


def counts(b):
    r = b.report.first()
    return r.fetched, r.new, r.duplicates, r.superseded, r.rubric_rejected, r.queued, r.dlq


def scores(staged, status):
    return {r.uid: r.total for r in staged.where(F.col("status") == status).select("uid", "rubric.total").collect()}


def test_first_batch_and_its_second_run(spark):
    b = ingest.run(batch(spark, RAG), empty(spark), F.lit(DAY).cast("timestamp"))
    assert counts(b) == (13, 11, 1, 1, 4, 8, 0)
    staged = held(b.staged)
    queued = sorted(scores(staged, "queued").items(), key=lambda x: -x[1])[:5]
    assert queued == [("ieee:10787654", 93.81), ("ieee:10651234", 81.25), ("arxiv:2401.18059", 71.43), ("arxiv:2404.16130", 71.38), ("arxiv:2310.11511", 70.77)]
    assert scores(staged, "rejected") == {"arxiv:2005.11401": 49.63, "arxiv:2301.12652": 55.8, "arxiv:2501.09136": 59.31}
    assert staged.where("uid = 'ieee:10651234'").first().alternate_uids == ["arxiv:2312.10997"] and staged.count() == 11
    rejected = {r.uid: r.detail for r in b.events.where("event_type = 'RUBRIC_REJECTED'").collect()}
    assert float(rejected["arxiv:2312.10997"]) == 58.19  # rejected before it was superseded

    again = ingest.run(batch(spark, RAG), staged, F.lit(DAY).cast("timestamp"))
    assert counts(again) == (13, 0, 13, 0, 0, 0, 0) and again.staged.count() == 11
    assert sorted((r.uid, r.detail) for r in again.events.collect()) == [("arxiv:2312.10997", "ieee:10651234"), ("arxiv:2312.10998", "ieee:10651234")]  # the other eleven by id


def test_other_batch(spark):
    b = ingest.run(batch(spark, AGENTS), empty(spark), F.lit(DAY).cast("timestamp"))
    assert counts(b) == (12, 12, 0, 0, 1, 11, 0)
    top = sorted(scores(b.staged, "queued").items(), key=lambda x: -x[1])[:5]
    assert [x[1] for x in top] == [82.91, 71.62, 71.21, 70.81, 69.59] and [x[0] for x in top] == [f"arxiv:{x}" for x in ("2310.06770", "2407.16741", "2405.15793", "2402.01030", "2308.03688")]
    assert scores(b.staged, "rejected") == {"arxiv:2302.04761": pytest.approx(56.55)}
