"""Two-reviewer screening: verdict rules, agreement, tie-breaks, Cohen's kappa, evidence and grounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions.text import contains_quote
from loomsift.operators.tables import latest, since

AGENTS = ("screener_a", "screener_b", "tiebreaker")
CONSENSUS = ("SCREEN_INCLUDED", "SCREEN_EXCLUDED", "SCREEN_ESCALATED")
#: Values that claim nothing and so need no quote (fixed values).
NOTHING = ("", "false", "null", "none", "[]")


def validated(verdicts: DataFrame, criteria: DataFrame) -> DataFrame:
    """An exclusion needs a known criterion and a verbatim quote of source_text, else it is invalid (fields stay);
    an inclusion has neither. criteria: code (a small dimension)."""
    x = verdicts.join(criteria.select(F.col("code").alias("__code")).distinct(), F.col("criterion_id") == F.col("__code"), "left")
    good = F.col("__code").isNotNull() & F.coalesce(contains_quote(F.col("source_text"), F.col("evidence_quote")), F.lit(False))
    include = F.col("verdict") == "include"
    out = F.when(include, "include").when((F.col("verdict") == "exclude") & good, "exclude").otherwise("invalid")
    return x.withColumn("criterion_id", F.when(~include, F.col("criterion_id"))).withColumn("evidence_quote", F.when(~include, F.col("evidence_quote"))).withColumn("verdict", out).select(*verdicts.columns)


def by_agent(verdicts: DataFrame, keys: tuple[str, ...] = ("uid",)) -> DataFrame:
    """A row a uid: each agent's last verdict and confidence."""
    row = F.struct("verdict", "confidence", "criterion_id")
    return verdicts.groupBy(*keys).pivot("agent", list(AGENTS)).agg(F.max_by(row, "id"))


def pairs(verdicts: DataFrame, keys: tuple[str, ...] = ("uid",)) -> DataFrame:
    """The two screeners' last include or exclude verdicts, of uids that both rated."""
    valid = verdicts.where(F.col("verdict").isin("include", "exclude"))
    last = latest(valid.select(*keys, "agent", "verdict", "id"), [*keys, "agent"], "id")
    return last.groupBy(*keys).pivot("agent", list(AGENTS[:2])).agg(F.first("verdict")).toDF(*keys, "a", "b").where("a is not null and b is not null")


def kappa(a: Column, b: Column) -> list[Column]:
    """Aggregates kappa and n of two columns of include or exclude; null under two pairs."""
    n = F.count("*").cast("double")
    share = {(x, y): F.count_if((a == x) & (b == y)) / n for x in ("include", "exclude") for y in ("include", "exclude")}
    agreed = share["include", "include"] + share["exclude", "exclude"]
    chance = F.lit(0.0)
    for x in ("include", "exclude"):
        chance = chance + (share[x, "include"] + share[x, "exclude"]) * (share["include", x] + share["exclude", x])
    sure = F.abs(1 - chance) < 1e-9
    value = F.when(n < 2, F.lit(None).cast("double")).when(sure, F.when(agreed == 1.0, 1.0).otherwise(0.0)).otherwise(F.try_divide(agreed - chance, 1 - chance))
    return [value.alias("kappa"), F.count("*").alias("n")]


def agreement(verdicts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """kappa and n over all pairs, or for each value of keys (such as a run)."""
    p = pairs(verdicts, (*keys, "uid"))
    return p.groupBy(*keys).agg(*kappa(F.col("a"), F.col("b"))) if keys else p.agg(*kappa(F.col("a"), F.col("b")))


def run_agreement(verdicts: DataFrame, single_model: bool) -> DataFrame:
    """Kappa by run_id; null with a reason when one model plays both screeners."""
    x = agreement(verdicts, ("run_id",))
    if single_model:
        return x.withColumn("kappa", F.lit(None).cast("double")).withColumn("reason", F.lit("single model"))
    return x.withColumn("reason", F.lit(None).cast("string"))


def outcome(a: Column, b: Column, t: Column) -> Column:
    """agreement, disagreement_resolved or escalated; null if a screener has not rated."""
    same = F.when((a["verdict"] == "invalid") | (b["verdict"] == "invalid"), "escalated").when(a["verdict"] == b["verdict"], "agreement")
    solved = (t["verdict"] != "invalid") & (t["confidence"] == "high")
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.coalesce(same, F.when(F.coalesce(solved, F.lit(False)), "disagreement_resolved").otherwise("escalated")))


def statistics(screening: DataFrame, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """Counts of the three outcomes, in the last hours if a time is given."""
    rows = by_agent(screening if as_of is None else since(screening, as_of, hours))
    o = rows.select(outcome(*[F.col(x) for x in AGENTS]).alias("o"))
    return o.agg(*[F.count_if(F.col("o") == k).alias(k) for k in ("agreement", "disagreement_resolved", "escalated")])


def decided(rows: DataFrame) -> DataFrame:
    """The decision table on rows by_agent: status and event of each uid; null while a verdict that is needed is missing.

    Agreement decides; an invalid verdict or a disagreement asks for the tie-breaker, who decides with high
    confidence only: otherwise the document stays queued and is escalated.
    """
    a, b, t = (F.col(x) for x in AGENTS)
    agreed = (a["verdict"] == b["verdict"]) & (a["verdict"] != "invalid")
    need = F.when(a.isNull() | b.isNull(), "screeners").when(~agreed & t.isNull(), "tiebreaker")
    solved = (t["verdict"] != "invalid") & (t["confidence"] == "high")
    verdict = F.when(agreed, a["verdict"]).when(F.coalesce(solved, F.lit(False)), t["verdict"])
    event = F.when(need.isNotNull(), F.lit(None)).when(verdict == "exclude", "SCREEN_EXCLUDED").when(verdict == "include", "SCREEN_INCLUDED").otherwise("SCREEN_ESCALATED")
    return rows.select("uid", need.alias("needs"), event.alias("event_type"), F.when(event == "SCREEN_EXCLUDED", "rejected").otherwise("queued").alias("status"))


def to_screen(docs: DataFrame, screening: DataFrame, agent: str | None = None) -> DataFrame:
    """Queued documents without a verdict (of the agent)."""
    done = screening if agent is None else screening.where(F.col("agent") == agent)
    return docs.where("status = 'queued'").join(done.select("uid"), "uid", "left_anti")


def without_consensus(docs: DataFrame, events: DataFrame) -> DataFrame:
    return docs.where("status = 'queued'").join(events.where(F.col("event_type").isin(*CONSENSUS)).select("uid"), "uid", "left_anti")


def escalated(docs: DataFrame, events: DataFrame) -> DataFrame:
    return docs.where("status = 'queued'").join(events.where("event_type = 'SCREEN_ESCALATED'").select("uid"), "uid", "left_semi")


def without_extraction(docs: DataFrame, extraction: DataFrame) -> DataFrame:
    return docs.where("status = 'queued'").join(extraction.select("uid"), "uid", "left_anti")


def verified(value: Column, quote: Column, section_text: Column) -> Column:
    """1: the quote stands in the section it claims; 0: it doesn't, or a claim has none; 2: nothing is claimed."""
    blank = F.coalesce(quote, F.lit("")) == ""
    empty = F.lower(F.trim(F.coalesce(value, F.lit("")))).isin(*NOTHING)
    return F.when(~blank, contains_quote(section_text, quote).cast("int")).otherwise(F.when(empty, 2).otherwise(0))


def unverified_events(extraction: DataFrame) -> DataFrame:
    return extraction.where("verified = 0").select("uid", F.lit("EXTRACT_UNVERIFIED").alias("event_type"), F.col("field").alias("detail"))


def grounding(extraction: DataFrame) -> DataFrame:
    """grounding_avg (mean share of verified among checked fields; null if none) and docs_count (all documents)."""
    each = extraction.groupBy("uid").agg(F.try_divide(F.count_if(F.expr("verified = 1")).cast("double"), F.count_if(F.expr("verified in (0, 1)"))).alias("score"))
    return each.agg(F.avg("score").alias("grounding_avg"), F.count("*").alias("docs_count"))
