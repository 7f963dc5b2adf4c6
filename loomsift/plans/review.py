"""Screening, extraction and review as batches. Model calls are injected callables from DataFrame to DataFrame.

ask: takes uid, title, abstract, source_text and agent (and for the tie-breaker first and second, the screeners' verdicts
without their names), and returns uid and answer, a JSON text; null is a transient failure, which leaves the document for
the next batch. What isn't a whole answer counts as an invalid verdict.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.operators.screening import AGENTS, by_agent, decided, run_agreement, validated, verified, without_consensus, without_extraction
from loomsift.operators.sections import section_text
from loomsift.scratch import checkpointed

Ask = Callable[[DataFrame], DataFrame]
ANSWER = "verdict string, criterion_id string, evidence_quote string, confidence string"
CHOICES = {"verdict": ("include", "exclude"), "confidence": ("high", "low")}
EXTRACTED = "array<struct<field:string,value:string,quote:string,section:string>>"
#: Fields asked of a document (fixed values).
FIELDS = ("has_code_repo", "dataset_specification", "evaluated_benchmarks", "declared_limitations")
VERDICT = ("uid", "agent", "model", "verdict", "criterion_id", "evidence_quote", "confidence")


def structured(answer: Column, schema: str, choices: dict[str, tuple[str, ...]]) -> Column:
    """A model's JSON answer as a struct; null if it is no JSON or a field with choices has none of them."""
    x = F.from_json(answer, schema)
    whole = F.lit(True)
    for name, known in choices.items():
        whole = whole & F.coalesce(x[name].isin(*known), F.lit(False))
    return F.when(whole, x)


def waiting(docs: DataFrame, limit: int | None) -> DataFrame:
    """The first documents in order of arrival, with the text that quotes must stand in."""
    some = docs.select("uid", "title", "abstract", F.concat_ws("\n", "title", F.coalesce("abstract", F.lit(""))).alias("source_text"), "seq").orderBy("seq")
    return (some if limit is None else some.limit(limit)).drop("seq")


def asked(todo: DataFrame, agent: str, model: str, ask: Ask, criteria: DataFrame) -> DataFrame:
    """Checked verdicts of one agent, a row for each document that was answered."""
    got = ask(todo.withColumn("agent", F.lit(agent))).where("answer is not null").select("uid", structured(F.col("answer"), ANSWER, CHOICES).alias("a"))
    rows = got.join(todo.select("uid", "source_text"), "uid").select(
        "uid", "source_text", F.lit(agent).alias("agent"), F.lit(model).alias("model"), F.coalesce("a.verdict", F.lit("invalid")).alias("verdict"), "a.criterion_id", "a.evidence_quote",
        F.coalesce("a.confidence", F.lit("low")).alias("confidence"),
    )
    return validated(rows, criteria).select(*VERDICT)


def screened_event(verdicts: DataFrame) -> DataFrame:
    detail = F.concat(F.lit("agent="), "agent", F.lit(", verdict="), "verdict", F.lit(", criterion="), F.coalesce("criterion_id", F.lit("")))
    return verdicts.select("uid", F.lit("SCREENED").alias("event_type"), detail.alias("detail"))


def single(docs: DataFrame, screening: DataFrame, criteria: DataFrame, ask: Ask, model: str, agent: str = AGENTS[0], limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One screener over queued documents that it hasn't rated: verdicts and log rows; no status changes."""
    todo = waiting(docs.where("status = 'queued'").join(screening.where(F.col("agent") == agent).select("uid"), "uid", "left_anti"), limit)
    made = checkpointed(asked(todo, agent, model, ask, criteria))  # a model isn't asked twice
    return made, screened_event(made)


class Screened(NamedTuple):
    """verdicts: new ones. events: log rows. statuses: uid and status of decided documents. report: a row of the run."""

    verdicts: DataFrame
    events: DataFrame
    statuses: DataFrame
    report: DataFrame


def dual(docs: DataFrame, screening: DataFrame, events: DataFrame, criteria: DataFrame, ask: Ask, models: dict[str, str], run_id: str, limit: int | None = None) -> Screened:
    """Two screeners, and a third where they disagree or one is invalid, over queued documents without a consensus.

    Verdicts that exist are used again. A document whose verdicts aren't all there yet stays as it is. models: by agent;
    one model for both screeners gives no kappa and says so in the log.
    """
    a, b, third = AGENTS
    todo = checkpointed(waiting(without_consensus(docs, events), limit))
    had = screening.join(todo.select("uid"), "uid", "left_semi")
    new = [checkpointed(asked(todo.join(had.where(F.col("agent") == x).select("uid"), "uid", "left_anti"), x, models[x], ask, criteria)) for x in (a, b)]

    def every(made: list[DataFrame]) -> DataFrame:
        rows = had.select("uid", "agent", "verdict", "criterion_id", "confidence", "id")
        for x in made:  # new verdicts come after all others
            rows = rows.unionByName(x.select("uid", "agent", "verdict", "criterion_id", "confidence", F.lit((1 << 62)).alias("id")))
        return rows

    said = lambda x: F.concat_ws(" ", F.col(f"{x}.verdict"), F.col(f"{x}.criterion_id"))
    split = by_agent(every(new))
    open_ = decided(split).where("needs = 'tiebreaker'").select("uid")
    solved = checkpointed(asked(todo.join(split.join(open_, "uid").select("uid", said(a).alias("first"), said(b).alias("second")), "uid"), third, models[third], ask, criteria))
    outcome = checkpointed(decided(by_agent(every([*new, solved]))).where("needs is null"))

    verdicts = new[0].unionByName(new[1]).unionByName(solved)
    one_model = models[a] == models[b]
    log = screened_event(verdicts).unionByName(outcome.select("uid", "event_type", F.lit("").alias("detail")))
    if one_model:
        spark = docs.sparkSession
        log = log.unionByName(spark.createDataFrame([("screening:batch", "SCREEN_SINGLE_MODEL", f"both screeners are {models[a]}")], "uid string, event_type string, detail string"))
    agreed = run_agreement(every(new).withColumn("run_id", F.lit(run_id)), one_model)
    counts = outcome.agg(F.count("*").alias("processed"), F.count_if(F.col("event_type") == "SCREEN_ESCALATED").alias("escalated"))
    report = counts.crossJoin(F.broadcast(agreed.agg(F.first("kappa").alias("kappa"), F.coalesce(F.first("n"), F.lit(0)).alias("kappa_docs")))).withColumn("single_model_mode", F.lit(one_model))  # one row each
    return Screened(verdicts, log, outcome.select("uid", "status"), report)


def extraction(docs: DataFrame, extracted: DataFrame, ask: Ask, as_of: Column, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Facts of queued documents that have none yet, each held against the section it names; and log rows of those not found.

    ask takes uid and context, and returns uid and answer: JSON of an array of field, value, quote and section, or null. A
    document whose answer isn't whole is left out.
    """
    todo = without_extraction(docs, extracted).orderBy("seq")
    todo = checkpointed(todo if limit is None else todo.limit(limit))
    made = checkpointed(ask(todo).select("uid", F.from_json("answer", EXTRACTED).alias("facts")).where("facts is not null"))
    rows = made.join(todo, "uid").select(*todo.columns, F.explode("facts").alias("f")).where(F.col("f.field").isin(*FIELDS))
    facts = rows.select("uid", "f.field", "f.value", "f.quote", "f.section", verified(F.col("f.value"), F.col("f.quote"), section_text(F.col("f.section"))).alias("verified"), as_of.alias("created_at"))
    return facts, facts.where("verified = 0").select("uid", F.lit("EXTRACT_UNVERIFIED").alias("event_type"), F.col("field").alias("detail"))


def rejected(docs: DataFrame, choices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The review action reject. choices: uid and reason. All documents after it, and log rows."""
    mine = choices.join(docs.select("uid"), "uid", "left_semi").dropDuplicates(["uid"])
    after = docs.join(mine.select("uid", F.lit(True).alias("__gone")), "uid", "left").withColumn("status", F.when(F.col("__gone"), "rejected").otherwise(F.col("status"))).select(*docs.columns)
    return after, mine.select("uid", F.lit("REJECTED").alias("event_type"), F.coalesce("reason", F.lit("")).alias("detail"))
