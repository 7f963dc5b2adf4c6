"""Registered queries: each operator on tables derived from the given ones, and SQL for the same rows.

The derivations in ``DERIVED`` are plain SQL that both engines read, so a query and its SQL start from the same rows.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.functions import guards, rubric, search_text, text
from loomsift.operators import alerts, cascade, containment, dedup, distinct, firewall, health, screening, sections, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

AS_OF = "2024-01-28 12:00:00"


def now() -> F.Column:
    return F.expr(f"timestamp_ntz'{AS_OF}'")


DERIVED = {
    "staged": """select concat(d.source, ':', cast(d.doc_id as string)) as uid, d.doc_id as seq, d.source,
        case when l.quality is null then 'approved' when l.toxic = 1 then 'rejected' else 'queued' end as status,
        cast(d.n_chars % 997 as double) / 10 as rubric_score, d.doc_id % 11 as fetched_at,
        case when l.quality = 1 then 'seen' end as tech_meta, case when d.doc_id % 4 = 0 then ' ' else d.text end as full_text
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "log": """select event_id as id, concat('src', cast(user_id % 20 as string), ':', cast(user_id as string)) as uid,
        case event_type when 'click' then 'FETCHED' when 'error' then 'SCREEN_ESCALATED' when 'purchase' then 'APPROVED' when 'signup' then 'REJECTED' else 'DUPLICATE_ID' end as event_type,
        case when event_id % 3 = 0 then 'below the Rubric gate' else '' end as detail, ts as created_at from events""",
    "dlq": """select event_id as id, concat('src', cast(user_id % 20 as string), ':', case when event_id % 40 = 0 then 'batch' else cast(user_id as string) end) as uid,
        event_type as error_type, cast(event_id % 6 + 1 as int) as attempts, value > 20 as retry_eligible, ts as created_at from events""",
    "runs": """select event_id as id, ts as started_at, case when event_id % 10 = 0 then 'broken' else concat('{"fetched": ', cast(user_id as string), ', "duplicates": ', cast(event_id % 5 as string), ', "rubric_rejected": 1}') end as report_json
        from events where event_type = 'purchase'""",
    "ratings": """select doc_id * 3 as id, concat('src', cast(doc_id % 20 as string), ':', cast(doc_id as string)) as uid, 'screener_a' as agent, case when doc_id % 17 = 0 then 'invalid' when quality = 1 then 'include' else 'exclude' end as verdict,
        case when doc_id % 5 = 0 then cast(null as string) else concat('ET', cast(doc_id % 7 + 1 as string)) end as criterion_id, 'high' as confidence from labels
        union all select doc_id * 3 + 1, concat('src', cast(doc_id % 20 as string), ':', cast(doc_id as string)), 'screener_b', case when toxic = 1 then 'exclude' else 'include' end, cast(null as string), 'high' from labels where doc_id % 9 <> 0
        union all select doc_id * 3 + 2, concat('src', cast(doc_id % 20 as string), ':', cast(doc_id as string)), 'tiebreaker', case when doc_id % 6 = 0 then 'invalid' else 'include' end, cast(null as string), case when doc_id % 4 = 0 then 'low' else 'high' end from labels where doc_id % 2 = 0""",
    "facts": """select concat('src', cast(doc_id % 20 as string), ':', cast(doc_id as string)) as uid, f as field, (doc_id + f * quality) % 3 as verified from labels cross join (select 1 as f union all select 2 union all select 3) x
        where doc_id % 8 <> 0 or f > 1""",
}


def over(spark: SparkSession, sf_dir: str, sql: str, tables_: tuple[str, ...]) -> DataFrame:
    """SQL over given tables: views of this call only, which go when its plan is made."""
    views = []
    for name in tables_:
        if f" {name}" in sql:
            views.append(f"{name}_{uuid.uuid4().hex}")
            base(spark, sf_dir, name).createTempView(views[-1])
            sql = sql.replace(f"from {name}", f"from {views[-1]}").replace(f"join {name}", f"join {views[-1]}")
    try:
        return spark.sql(sql)
    finally:
        for v in views:
            spark.catalog.dropTempView(v)


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return over(spark, sf_dir, DERIVED[name], ("documents", "labels", "events"))


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_sql(names: str, sql: str) -> str:
    """SQL over derived tables, given as common table expressions."""
    return f"with {', '.join(f'{n} as ({DERIVED[n]})' for n in names.split())} {sql}" if names else sql


def query(names: str = "", sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = with_sql(names, sql)
        return f

    return add


# --- aggregates and reports ------------------------------------------------------------------------------------------


@query("staged", "select status, count(*) as n from staged group by status")
def q_status_counts(spark, d):
    return health.status_counts(derived(spark, d, "staged"))


@query("", """with x as (select distinct event_type, user_id, cast(ts as date) as day from events)
    select a.event_type, a.day, count(distinct b.user_id) as n from (select distinct event_type, day from x) a join x b on a.event_type = b.event_type and b.day between a.day - 6 and a.day group by 1, 2""")
def q_rolling_users(spark, d):
    """Distinct users of each week that ends on a day, by type of event, from a bitmap a day."""
    rows = base(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), F.col("user_id").alias("uid"))
    return distinct.rolling(distinct.daily(rows, distinct.numbered(rows), ["event_type"]), ["event_type"], 7)


DATED = "select uid, coalesce(criterion_id, 'Unknown') as criterion_id, verdict, date '2024-01-01' + cast(id % 28 as int) as day from ratings"


@query("ratings", f"select criterion_id, count(distinct uid) as n from ({DATED}) x where verdict = 'exclude' and day between date '2024-01-05' and date '2024-01-18' group by criterion_id")
def q_exclusion_span(spark, d):
    """Exclusion reasons over two weeks, from daily bitmaps that were made in two loads."""
    r = derived(spark, d, "ratings").where("verdict = 'exclude'")
    rows = r.select("uid", F.coalesce("criterion_id", F.lit("Unknown")).alias("criterion_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 28).cast("int")).alias("day"), (F.col("id") % 2).alias("load"))
    some = rows.where("load = 0")
    ids = distinct.numbered(rows, distinct.numbered(some))
    kept = distinct.added(distinct.daily(some, ids, ["criterion_id"]), distinct.daily(rows.where("load = 1"), ids, ["criterion_id"]), ["criterion_id"])
    return distinct.counted(kept.where("day between date'2024-01-05' and date'2024-01-18'"), ["criterion_id"])


@query("dlq", "select error_type, count(*) as n, cast(sum(case when retry_eligible then 1 else 0 end) as bigint) as eligible from dlq group by error_type")
def q_error_rollup(spark, d):
    return health.failures_by_error(derived(spark, d, "dlq"))


DOWN = f"""with r as (select *, split_part(uid, ':', 1) as source from dlq where retry_eligible and created_at > timestamp '{AS_OF}' - interval 24 hour)
    select source from r where uid ilike '%:batch' union select source from r where uid not ilike '%:batch' group by source having count(*) >= 3"""


@query("dlq", f"select * from ({DOWN}) t")
def q_sources_down(spark, d):
    return health.sources_down(derived(spark, d, "dlq"), now())


@query("dlq", f"select error_type, count(*) as n from dlq where created_at > timestamp '{AS_OF}' - interval 24 hour group by error_type")
def q_window_counts(spark, d):
    return tables.since(derived(spark, d, "dlq"), now(), 24).groupBy("error_type").agg(F.count("*").alias("n"))


@query("log", f"select count(*) as n from log where event_type = 'APPROVED' and created_at >= date_trunc('day', timestamp '{AS_OF}')")
def q_approved_today(spark, d):
    return health.approved_today(derived(spark, d, "log"), now())


@query("runs", f"select round(date_diff('second', max_by(started_at, id), timestamp '{AS_OF}') / 3600.0, 6) as hours from runs")
def q_hours_since_run(spark, d):
    return health.hours_since_last_run(derived(spark, d, "runs"), now()).select(F.round("hours", 6).alias("hours"))


@query("ratings", "select coalesce(criterion_id, 'Unknown') as criterion_id, count(distinct uid) as n from ratings where verdict = 'exclude' group by 1")
def q_exclusion_reasons(spark, d):
    return health.exclusion_reasons(derived(spark, d, "ratings"))


FLOW = """select greatest(r.fetched, e.ev_fetched, s.held) as identified, greatest(r.duplicates, e.ev_duplicates) as duplicates, greatest(r.rubric_rejected, e.ev_rejected, u.n) as rubric_rejected,
    t.screened, t.excluded, t.screened - t.excluded as eligible, cast(0 as bigint) as full_text_excluded, s.abstract_only, s.included from
    (select cast(coalesce(sum(try_cast(json_extract_string(j, '$.fetched') as bigint)), 0) as bigint) as fetched, cast(coalesce(sum(try_cast(json_extract_string(j, '$.duplicates') as bigint)), 0) as bigint) as duplicates,
      cast(coalesce(sum(try_cast(json_extract_string(j, '$.rubric_rejected') as bigint)), 0) as bigint) as rubric_rejected from (select case when json_valid(report_json) then report_json end as j from runs)) r,
    (select count(*) filter (where event_type = 'FETCHED') as ev_fetched, count(*) filter (where event_type in ('DUPLICATE_ID', 'DUPLICATE_FUZZY')) as ev_duplicates, count(*) filter (where event_type = 'REJECTED' and detail ilike '%rubric%') as ev_rejected from log) e,
    (select count(*) as held, count(*) filter (where status in ('approved', 'approved_local', 'queued') and trim(coalesce(full_text, '')) = '') as abstract_only, count(*) filter (where status in ('approved', 'approved_local')) as included from staged) s,
    (select count(*) as n from staged where status = 'rejected' and uid not in (select uid from ratings)) u,
    (select count(distinct uid) as screened, count(distinct case when verdict = 'exclude' then uid end) as excluded from ratings) t"""


@query("staged log runs ratings", FLOW)
def q_flow_report(spark, d):
    return health.flow_report(*(derived(spark, d, n) for n in ("staged", "log", "runs", "ratings")))


# --- filters, queues and state ---------------------------------------------------------------------------------------


@query("staged", "select uid, rubric_score, fetched_at from staged where status = 'queued' order by rubric_score desc, fetched_at, uid limit 5")
def q_queue(spark, d):
    return tables.queue(derived(spark, d, "staged")).select("uid", "rubric_score", "fetched_at")


@query("staged", "select uid, rubric_score from staged where status = 'queued' and tech_meta is null")
def q_degraded(spark, d):
    return tables.degraded(derived(spark, d, "staged")).select("uid", "rubric_score")


@query("staged", "select uid from staged where status in ('approved', 'approved_local', 'queued') and trim(coalesce(full_text, '')) = ''")
def q_abstract_only(spark, d):
    return tables.abstract_only(derived(spark, d, "staged")).select("uid")


USED = "select concat('o', cast(o_orderkey as string)) as uid, case o_orderstatus when 'F' then 'approved' when 'O' then 'queued' else 'rejected' end as status, o_orderdate as last_interaction_at from orders"


def used(spark: SparkSession, d: str) -> DataFrame:
    return base(spark, d, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("uid"), F.expr("case o_orderstatus when 'F' then 'approved' when 'O' then 'queued' else 'rejected' end").alias("status"), F.col("o_orderdate").alias("last_interaction_at"))


OLD = "1996-01-01 00:00:00"
ORACLE["q_ttl_purge"] = f"with o as ({USED}) select uid, 'PURGED' as event_type, '' as detail from o where last_interaction_at < timestamp '{OLD}' - interval 72 hour and status not in ('approved', 'approved_local', 'rejected')"


@query()
def q_ttl_purge(spark, d):
    return tables.purged(used(spark, d), F.expr(f"timestamp_ntz'{OLD}'"))[1]


ORACLE["q_ttl_kept"] = f"with o as ({USED}) select status, count(*) as n from o where not (last_interaction_at < timestamp '{OLD}' - interval 72 hour and status not in ('approved', 'approved_local', 'rejected')) group by status"


@query()
def q_ttl_kept(spark, d):
    return health.status_counts(tables.purged(used(spark, d), F.expr(f"timestamp_ntz'{OLD}'"))[0])


@query("dlq", f"select id, uid, attempts from dlq where created_at >= timestamp '{AS_OF}' - interval 10 day or retry_eligible")
def q_retention(spark, d):
    dlq = derived(spark, d, "dlq")
    return tables.retained(dlq, dlq, now(), days=10)[1].select("id", "uid", "attempts")


@query("dlq", "select id, attempts from dlq where not retry_eligible and attempts >= 5")
def q_permanent_failures(spark, d):
    return tables.permanent_failures(derived(spark, d, "dlq")).select("id", "attempts")


@query("dlq", "select id, uid from dlq where retry_eligible and uid not ilike '%:batch' and split_part(uid, ':', 1) in ('src1', 'src2', 'src3')")
def q_retryable(spark, d):
    return tables.retryable(derived(spark, d, "dlq"), base(spark, d, "documents").select("source").where(F.col("source").isin("src1", "src2", "src3")).distinct()).select("id", "uid")


BUMP = """select id, cast(attempts + case when error_type = 'error' then 1 else 0 end as int) as attempts,
    retry_eligible and not (error_type = 'error' and attempts + 1 >= 5) as retry_eligible from dlq"""


@query("dlq", BUMP)
def q_dlq_bump(spark, d):
    dlq = derived(spark, d, "dlq")
    return tables.bumped(dlq, dlq.where("error_type = 'error'").select("id")).select("id", "attempts", "retry_eligible")


@query("log", "select uid, event_type, id, created_at from (select *, row_number() over (partition by uid, event_type order by id desc) as r from log) t where r = 1")
def q_latest_wins(spark, d):
    return tables.latest(derived(spark, d, "log"), ["uid", "event_type"], "id").select("uid", "event_type", "id", "created_at")


@query("runs", "select id, started_at from runs order by id desc limit 1")
def q_last_run(spark, d):
    return tables.last(derived(spark, d, "runs"), "id").select("id", "started_at")


UPSERT = """select uid, case when seq % 3 = 0 then source else source end as source, fetched_at, case when seq % 3 = 0 then 'queued' else status end as status, case when seq % 3 = 0 then rubric_score + 1 else rubric_score end as rubric_score from staged
    union all select concat('new:', uid) as uid, 'new' as source, cast(0 as bigint) as fetched_at, 'queued' as status, rubric_score from staged where seq % 5 = 0"""


@query("staged", UPSERT)
def q_upsert(spark, d):
    s = derived(spark, d, "staged").select("uid", "seq", "source", "fetched_at", "status", "rubric_score")
    old = s.drop("seq")
    again = s.where("seq % 3 = 0").select("uid", F.lit("other").alias("source"), F.lit(-1).cast("long").alias("fetched_at"), F.lit("queued").alias("status"), (F.col("rubric_score") + 1).alias("rubric_score"))
    more = s.where("seq % 5 = 0").select(F.concat(F.lit("new:"), "uid").alias("uid"), F.lit("new").alias("source"), F.lit(0).cast("long").alias("fetched_at"), F.lit("queued").alias("status"), "rubric_score")
    return tables.upserted(old, again.unionByName(more))


@query("log", "select id, uid, event_type, created_at from log union all select m + row_number() over (order by uid), uid, 'SEEN', timestamp '%s' from (select distinct uid from log) u, (select max(id) as m from log) x" % AS_OF)
def q_append_log(spark, d):
    log = derived(spark, d, "log").select("id", "uid", "event_type", "created_at")
    return tables.appended(log, log.select("uid", F.lit("SEEN").alias("event_type")).distinct(), now())


FOUND = "select concat('s', cast(event_id % 4 as string)) as source, user_id % 10 as query_no, concat('q', cast(user_id % 10 as string)) as query, event_id as pos, cast(cast(floor(value) as bigint) as string) as id from events"


@query("", f"select source, id, cast(r as int) as rank, query as found_by_query from (select *, row_number() over (partition by source order by query_no, pos, id) as r from (select *, row_number() over (partition by source, id order by query_no, pos) as k from ({FOUND}) f) g where k = 1) h where r <= 20")
def q_plan_rank(spark, d):
    e = base(spark, d, "events").select(F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string")).alias("source"), (F.col("user_id") % 10).alias("query_no"), F.concat(F.lit("q"), (F.col("user_id") % 10).cast("string")).alias("query"), F.col("event_id").alias("pos"), F.floor("value").cast("long").cast("string").alias("id"))
    return tables.ranked_ids(e, 20)


CUT = """with x as (select user_id as source, event_id as seq, case event_type when 'error' then 'transient' when 'signup' then 'permanent' when 'view' then 'transient' else 'ok' end as kind from events),
    r as (select *, sum(case when kind = 'ok' then 1 else 0 end) over (partition by source order by seq) as run from x),
    f as (select *, sum(case when kind = 'transient' then 1 else 0 end) over (partition by source, run order by seq) as fails from r),
    b as (select source, min(seq) as stop from f where kind = 'transient' and fails = 3 group by source)
    select x.source, x.seq, x.kind, coalesce(x.seq = b.stop, false) as breaks from x left join b on x.source = b.source where b.stop is null or x.seq <= b.stop"""


@query("", CUT)
def q_circuit_breaker(spark, d):
    kind = F.expr("case event_type when 'error' then 'transient' when 'signup' then 'permanent' when 'view' then 'transient' else 'ok' end")
    return tables.broken_circuits(base(spark, d, "events").select(F.col("user_id").alias("source"), F.col("event_id").alias("seq"), kind.alias("kind")), 3)


@query("", CUT.replace("user_id as source", "'all' as source").replace("fails = 3", "fails = 8"))
def q_breaker_one_source(spark, d):
    """All outcomes as those of one source: its pieces are many tasks' work."""
    kind = F.expr("case event_type when 'error' then 'transient' when 'signup' then 'permanent' when 'view' then 'transient' else 'ok' end")
    return tables.broken_circuits(base(spark, d, "events").select(F.lit("all").alias("source"), F.col("event_id").alias("seq"), kind.alias("kind")), 8)


# --- joins -----------------------------------------------------------------------------------------------------------

RATED = "select uid from ratings"


@query("staged ratings", f"select uid from staged where status = 'queued' and uid not in ({RATED} where agent = 'tiebreaker' and verdict <> 'invalid')")
def q_unscreened_anti(spark, d):
    """Queued documents that no valid tie-breaking verdict stands for."""
    solved = derived(spark, d, "ratings").where("agent = 'tiebreaker' and verdict <> 'invalid'")
    return screening.to_screen(derived(spark, d, "staged"), solved).select("uid")


@query("staged ratings", f"select uid from staged where status = 'queued' and uid not in ({RATED} where agent = 'screener_b')")
def q_to_screen_b(spark, d):
    return screening.to_screen(derived(spark, d, "staged"), derived(spark, d, "ratings"), "screener_b").select("uid")


@query("staged facts", "select uid from staged where status = 'queued' and uid not in (select uid from facts where field = 1)")
def q_without_extraction(spark, d):
    return screening.without_extraction(derived(spark, d, "staged"), derived(spark, d, "facts").where("field = 1")).select("uid")


@query("staged log", "select distinct s.uid from staged s join log e on s.uid = e.uid where s.status = 'queued' and e.event_type = 'SCREEN_ESCALATED'")
def q_escalated_semi(spark, d):
    return screening.escalated(derived(spark, d, "staged"), derived(spark, d, "log")).select("uid")


@query("staged log", "select uid from staged where status = 'queued' and uid not in (select uid from log where event_type in ('SCREEN_INCLUDED', 'SCREEN_EXCLUDED', 'SCREEN_ESCALATED'))")
def q_without_consensus(spark, d):
    return screening.without_consensus(derived(spark, d, "staged"), derived(spark, d, "log")).select("uid")


# --- screening -------------------------------------------------------------------------------------------------------

PAIRS = """select a.verdict as a, b.verdict as b from ratings a join ratings b on a.uid = b.uid where a.agent = 'screener_a' and b.agent = 'screener_b' and a.verdict in ('include', 'exclude') and b.verdict in ('include', 'exclude')"""
KAPPA = f"""select round(case when abs(1 - pe) < 1e-9 then case when po = 1.0 then 1.0 else 0.0 end else (po - pe) / (1 - pe) end, 9) as kappa, n from (
    select count(*) as n, sum(case when a = b then 1.0 else 0.0 end) / count(*) as po,
    sum(case when a = 'include' then 1.0 else 0.0 end) / count(*) * sum(case when b = 'include' then 1.0 else 0.0 end) / count(*) + sum(case when a = 'exclude' then 1.0 else 0.0 end) / count(*) * sum(case when b = 'exclude' then 1.0 else 0.0 end) / count(*) as pe from ({PAIRS}) p) x"""


@query("ratings", KAPPA.replace("1.0 else 0.0", "cast(1 as double) else cast(0 as double)"))
def q_kappa(spark, d):
    return screening.agreement(derived(spark, d, "ratings")).select(F.round("kappa", 9).alias("kappa"), "n")


OUTCOME = """select case when av = 'invalid' or bv = 'invalid' then 'escalated' when av = bv then 'agreement' when tv <> 'invalid' and tc = 'high' then 'disagreement_resolved' else 'escalated' end as o from
    (select a.verdict as av, b.verdict as bv, t.verdict as tv, t.confidence as tc from (select * from ratings where agent = 'screener_a') a join (select * from ratings where agent = 'screener_b') b on a.uid = b.uid left join (select * from ratings where agent = 'tiebreaker') t on a.uid = t.uid) x"""


@query("ratings", f"select count(*) filter (where o = 'agreement') as agreement, count(*) filter (where o = 'disagreement_resolved') as disagreement_resolved, count(*) filter (where o = 'escalated') as escalated from ({OUTCOME}) y")
def q_screen_stats(spark, d):
    return screening.statistics(derived(spark, d, "ratings"))


DECIDED = """select uid, needs, case when needs is null then case v when 'exclude' then 'SCREEN_EXCLUDED' when 'include' then 'SCREEN_INCLUDED' else 'SCREEN_ESCALATED' end end as event_type, case when needs is null and v = 'exclude' then 'rejected' else 'queued' end as status from (
    select uid, case when av is null or bv is null then 'screeners' when not (av = bv and av <> 'invalid') and tv is null then 'tiebreaker' end as needs, case when av = bv and av <> 'invalid' then av when tv <> 'invalid' and tc = 'high' then tv end as v from (
    select uid, max(case when agent = 'screener_a' then verdict end) as av, max(case when agent = 'screener_b' then verdict end) as bv, max(case when agent = 'tiebreaker' then verdict end) as tv, max(case when agent = 'tiebreaker' then confidence end) as tc from ratings group by uid) p) q"""


@query("ratings", DECIDED)
def q_screen_decisions(spark, d):
    return screening.decided(screening.by_agent(derived(spark, d, "ratings")))


@query("facts", "select round(avg(s), 9) as grounding_avg, count(*) as docs_count from (select uid, sum(case when verified = 1 then cast(1 as double) else 0 end) / nullif(sum(case when verified in (0, 1) then 1 else 0 end), 0) as s from facts group by uid) x")
def q_grounding(spark, d):
    return screening.grounding(derived(spark, d, "facts")).select(F.round("grounding_avg", 9).alias("grounding_avg"), "docs_count")


STRAIGHT = "trim(regexp_replace(translate(coalesce({0}, ''), '‘’“”–—', '''''\"\"--'), '\\s+', ' ', 'g'))"
# case folding, as far as these texts need more than lower case
FOLDED = f"replace(lower({STRAIGHT}), 'ß', 'ss')"
QUOTED = f"select d.doc_id, b.item_id from documents d, benchmark b where contains({FOLDED.format('d.text')}, {FOLDED.format('b.text')})"


@query("", QUOTED)
def q_verify_quote(spark, d):
    """Which benchmark passages stand in which documents."""
    docs = base(spark, d, "documents").select(F.col("doc_id").alias("key"), text.quote_form(F.col("text")).alias("text"))
    quotes = base(spark, d, "benchmark").select(F.col("item_id").alias("id"), text.quote_form(F.col("text")).alias("needle"))
    return containment.held(docs, quotes).select(F.col("key").alias("doc_id"), F.col("id").alias("item_id"))


# Needles of every length, from two letters to sentences: part names, their first words, segments, and passages.
NEEDLES = "select distinct n from (select p_name as n from part union all select split_part(p_name, ' ', 1) from part union all select substr(p_type, 1, 2) from part union all select lower(c_mktsegment) from customer union all select text from benchmark) x where n <> ''"


@query("", f"select doc_id, n as needle from documents, ({NEEDLES}) y where contains(text, n)")
def q_contains_any(spark, d):
    """Every needle of a large list in every document that holds it."""
    part, customer = base(spark, d, "part"), base(spark, d, "customer")
    names = [part.select(F.col("p_name").alias("n")), part.select(F.split("p_name", " ")[0].alias("n")), part.select(F.substring("p_type", 1, 2).alias("n")), customer.select(F.lower("c_mktsegment").alias("n")), base(spark, d, "benchmark").select(F.col("text").alias("n"))]
    needles = functools.reduce(DataFrame.unionByName, names).distinct()
    docs = base(spark, d, "documents").select(F.col("doc_id").alias("key"), "text")
    return containment.held(docs, needles.select(F.col("n").alias("id"), F.col("n").alias("needle"))).select(F.col("key").alias("doc_id"), F.col("id").alias("needle"))


VERIFIED = f"""select doc_id, case when coalesce(q, '') <> '' then case when coalesce(text, '') <> '' and contains({FOLDED.format('text')}, {FOLDED.format('q')}) then 1 else 0 end when lower(trim(v)) in ('', 'false', 'null', 'none', '[]') then 2 else 0 end as verified from (
    select doc_id, text, case doc_id % 3 when 0 then substr(text, 5, 40) when 1 then 'not in the text' end as q, case doc_id % 2 when 0 then ' None ' else 'true' end as v from documents) x"""


@query("", VERIFIED)
def q_verified_fields(spark, d):
    q = F.expr("case doc_id % 3 when 0 then substr(text, 5, 40) when 1 then 'not in the text' end")
    return base(spark, d, "documents").select("doc_id", screening.verified(F.expr("case doc_id % 2 when 0 then ' None ' else 'true' end"), q, F.col("text")).alias("verified"))


# --- text ------------------------------------------------------------------------------------------------------------


@query("", "select doc_id, trim(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) as title from documents")
def q_normalize_title(spark, d):
    return base(spark, d, "documents").select("doc_id", text.normalized_title("text").alias("title"))


@query("", f"select doc_id, {FOLDED.format('text')} as t from documents")
def q_quote_normalize(spark, d):
    return base(spark, d, "documents").select("doc_id", text.quote_form(F.col("text")).alias("t"))


@query("", "select p_partkey, trim(both '-' from regexp_replace(translate(strip_accents(lower(concat(p_name, ' Tìm kiếm ở Đường / ', p_brand))), 'đ', 'd'), '[^a-z0-9]+', '-', 'g')) as slug from part")
def q_slug(spark, d):
    return base(spark, d, "part").select("p_partkey", text.slug(F.concat("p_name", F.lit(" Tìm kiếm ở Đường / "), "p_brand")).alias("slug"))


IDS = "select event_id, case event_id % 5 when 0 then cast(10000000 + event_id as string) when 1 then concat('http://x.org/abs/2401.', cast(10000 + event_id % 80000 as string), 'v2') when 2 then concat('ARXIV:2402.', cast(10000 + event_id % 80000 as string), 'v11') when 3 then concat('10.1000/', cast(event_id as string)) else concat(' 2403.', cast(1000 + event_id % 9000 as string), ' ') end as raw from events"
ARXIV = "regexp_extract(case when regexp_matches(t, 'abs/\\d{4}\\.\\d{4,5}(v\\d+)?/?$') then regexp_extract(t, 'abs/(\\d{4}\\.\\d{4,5})(v\\d+)?/?$', 1) else regexp_replace(regexp_replace(t, '^arxiv:', '', 'i'), 'v\\d+$', '') end, '^\\d{4}\\.\\d{4,5}$')"


@query("", f"select event_id, case when regexp_matches(t, '^\\d{{8}}$') then 'ieee' when {ARXIV} <> '' then 'arxiv' end as source, case when regexp_matches(t, '^\\d{{8}}$') then t when {ARXIV} <> '' then concat('arxiv:', {ARXIV}) end as id from (select event_id, trim(raw) as t from ({IDS}) i) x")
def q_route_ids(spark, d):
    base(spark, d, "events").createOrReplaceTempView("loomsift_events")
    raw = spark.sql(IDS.replace("from events", "from loomsift_events"))
    return raw.select("event_id", text.source_of_id(F.col("raw")).alias("source"), text.canonical_id(F.col("raw")).alias("id"))


@query("", "select c_custkey, case when starts_with(c_name, concat(c_mktsegment, ':')) then c_name else concat(c_mktsegment, ':', c_name) end as uid, split_part(concat(c_mktsegment, ':', c_name), ':', 1) as source from customer")
def q_uid(spark, d):
    u = text.uid(F.col("c_mktsegment"), F.col("c_name"))
    return base(spark, d, "customer").select("c_custkey", u.alias("uid"), text.uid_source(u).alias("source"))


@query("", "select doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) as n_words from documents")
def q_word_count(spark, d):
    return base(spark, d, "documents").select("doc_id", text.word_count(F.col("text")).cast("long").alias("n_words"))


@query("", "select p_partkey, round(-list_sum(list_transform(list_distinct(string_split(p_name, '')), lambda c: len(list_filter(string_split(p_name, ''), lambda y: y = c)) / cast(length(p_name) as double) * log2(len(list_filter(string_split(p_name, ''), lambda y: y = c)) / cast(length(p_name) as double)))), 6) as bits from part")
def q_entropy(spark, d):
    return base(spark, d, "part").select("p_partkey", F.round(text.entropy(F.col("p_name")), 6).alias("bits"))


MAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b"


@query("", f"select doc_id, case when length(m) <= 8 then concat(substr(m, 1, 2), '…(len=', cast(length(m) as string), ')') else concat(substr(m, 1, 4), '…', substr(m, -2), '(len=', cast(length(m) as string), ')') end as masked_match, substr(sha256(m), 1, 12) as match_sha256_12 from (select doc_id, unnest(regexp_extract_all(text, '\\b{MAIL}')) as m from documents) x")
def q_scan_email(spark, d):
    return guards.findings(base(spark, d, "documents"), "doc_id", "text").where("rule_id = 'EMAIL'").select("doc_id", "masked_match", "match_sha256_12")


# Patterns without look-around, which the other engine lacks: runs of digits (and a plus before them) are taken whole.
COUNTED = {rule: (p, None) for rule, p in guards.RULES.items() if "(?" not in p.replace("(?:", "")} | {
    "PHONE_VN": (r"\d*\+?\d+", r"(\d*\+)?0[35789]\d{8}|\+84[35789]\d{8}"), "CCCD_VN": (r"\d+", r"\d{12}"),
}


def _counted(rule: str) -> str:
    pattern, whole = (None if x is None else x.replace("'", "''") for x in COUNTED[rule])
    found = f"regexp_extract_all(text, '{pattern}')"
    return f"select '{rule}' as rule_id, cast(sum(len({found if whole is None else f'list_filter({found}, lambda x: regexp_full_match(x, {chr(39)}{whole}{chr(39)}))'})) as bigint) as n from t"


SCANNED = "with t as (select text from documents union all select html from pages) select * from (" + " union all ".join(map(_counted, guards.RULES)) + ") x where n > 0"


@query("", SCANNED)
def q_scan_counts(spark, d):
    """Findings by rule, in documents and pages. Long tokens of high entropy have a query of their own."""
    x = base(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").unionByName(base(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text")))
    return guards.findings(x, "id", "text").where(F.col("rule_id") != guards.HIGH_ENTROPY).groupBy("rule_id").agg(F.count("*").alias("n"))


@query()
def q_scan_entropy(spark, d):
    """Long tokens of high entropy outside the other findings."""
    return guards.findings(base(spark, d, "documents"), "doc_id", "text").where(F.col("rule_id") == guards.HIGH_ENTROPY)


@query()
def q_redact(spark, d):
    return base(spark, d, "documents").select("doc_id", guards.redacted("text").alias("text"))


@query("", "select doc_id, len(regexp_extract_all(text, '\\b\\d{1,3}(?:\\.\\d{1,3}){3}(?::\\d{1,5})?\\b')) as n from documents")
def q_anchor_ips(spark, d):
    x = guards.anchors("text")
    return base(spark, d, "documents").select("doc_id", F.size(F.filter(x, lambda a: a["kind"] == "ip")).cast("long").alias("n"))


@query()
def q_anchor_kinds(spark, d):
    """Anchors by kind and text; kinds don't overlap, earlier ones first."""
    x = base(spark, d, "documents").select("doc_id", F.explode(guards.anchors("text")).alias("a"))
    return x.groupBy("doc_id", "a.kind").agg(F.count("*").alias("n"))


@query()
def q_firewall(spark, d):
    """Each answer of a conversation against all that was said before it: numbers that came from nowhere are warnings."""
    return firewall.checked_turns(base(spark, d, "conversations")).select("conv_id", "turn", "passed", "anchors_checked", "n_warnings")


@query()
def q_sections(spark, d):
    x = base(spark, d, "documents").select("doc_id", F.posexplode(sections.split("text")).alias("pos", "part"))
    return x.select("doc_id", "pos", "part.heading", F.length("part.body").alias("n_chars"), sections.role(F.col("part.heading")).alias("role"))


HEADS = "select p_partkey, concat(case p_partkey % 6 when 0 then 'Introduction to ' when 1 then 'Proposed ' when 2 then 'RESULTS of ' when 3 then 'Limitations: ' when 4 then 'Problem design ' else '' end, p_name) as h from part"


@query("", f"select p_partkey, case when regexp_matches(lower(h), 'introduction|background|problem|motivation') then 'context' when regexp_matches(lower(h), 'method|approach|proposed|architecture|design') then 'method' when regexp_matches(lower(h), 'result|evaluation|experiment|findings') then 'findings' when regexp_matches(lower(h), 'discussion|conclusion|limitation|future work') then 'implications' end as role from ({HEADS}) x")
def q_roles(spark, d):
    return over(spark, d, HEADS, ("part",)).select("p_partkey", sections.role(F.col("h")).alias("role"))


# --- rubric ----------------------------------------------------------------------------------------------------------

RUBRIC_DAY = "1999-01-01 00:00:00"
PAPER = """select o.o_orderkey as uid, cast(o.o_orderkey % 3 + 1 as int) as authority_tier, o.o_orderdate as published_date, c.c_name as title, case when o.o_orderkey % 7 = 0 then '' else d.text end as abstract, cast(null as string) as full_text,
    case o.o_orderkey % 4 when 0 then 'https://GitHub.com/x' when 1 then 'https://zenodo.org/github.com' else 'https://x.org' end as url, cast(o.o_custkey % 2 as int) as n_authors from orders o join customer c on o.o_custkey = c.c_custkey left join documents d on o.o_orderkey = d.doc_id"""
AGE = f"floor(date_diff('second', published_date, timestamp '{RUBRIC_DAY}') / 86400) / cast(365.25 as double)"
WORDS = "len(list_filter(regexp_split_to_array(coalesce(abstract, ''), '\\s+'), lambda x: x <> ''))"
SUBS = f"""select uid, case authority_tier when 1 then cast(100 as double) when 2 then 70 else 0 end as s1, case when age <= 2 then cast(100 as double) when age >= 10 then 0 else 100 * (10 - age) / 8 end as s2,
    cast(50 as double) * (case when regexp_matches(hay, 'github\\.com|gitlab\\.com|bitbucket\\.org') then 1 else 0 end + case when regexp_matches(hay, 'zenodo|huggingface\\.co/datasets|figshare|dryad') then 1 else 0 end) as s3,
    case when n = 0 then cast(0 as double) when n < 80 then cast(50 as double) * n / 80 when n >= 200 then 100 else 50 + cast(50 as double) * (n - 80) / 120 end as s4,
    cast(100 as double) * (1 + n_authors + 1) / 3 as s5 from (select *, {AGE} as age, {WORDS} as n, lower(concat_ws(' ', nullif(abstract, ''), nullif(full_text, ''), nullif(url, ''))) as hay from ({PAPER}) p) q"""
TOTAL = f"select uid, round_even((30 * s1 + 20 * s2 + 25 * s3 + 15 * s4 + 10 * s5) / 100, 2) as total from ({SUBS}) s"


def papers(spark: SparkSession, d: str) -> DataFrame:
    return over(spark, d, PAPER, ("orders", "customer", "documents")).withColumn("authors", F.when(F.col("n_authors") == 1, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")))


def rated_papers(spark: SparkSession, d: str) -> DataFrame:
    return rubric.scored(papers(spark, d), F.expr(f"timestamp_ntz'{RUBRIC_DAY}'"))


@query("", TOTAL)
def q_rubric_score(spark, d):
    return rated_papers(spark, d).select("uid", F.col("rubric.total").alias("total"))


@query("", f"select total >= 60 as passed, count(*) as n from ({TOTAL}) t group by 1")
def q_rubric_gate(spark, d):
    return rated_papers(spark, d).groupBy(F.col("rubric.passed").alias("passed")).agg(F.count("*").alias("n"))


@query("", f"select uid, 'source_authority' as key, round(s1, 6) as sub_score from ({SUBS}) a union all select uid, 'recency', round(s2, 6) from ({SUBS}) b union all select uid, 'artifact_availability', round(s3, 6) from ({SUBS}) c union all select uid, 'abstract_completeness', round(s4, 6) from ({SUBS}) e union all select uid, 'metadata_integrity', round(s5, 6) from ({SUBS}) f")
def q_rubric_breakdown(spark, d):
    return rated_papers(spark, d).select("uid", F.explode("rubric.breakdown").alias("b")).select("uid", "b.key", F.round("b.sub_score", 6).alias("sub_score"))


@query("", f"select uid, total from ({TOTAL}) t where total >= 60 order by total desc, uid limit 5")
def q_rubric_queue(spark, d):
    """The flagship: score every paper, gate, and queue the best five."""
    x = rated_papers(spark, d).where("rubric.passed").select("uid", F.col("rubric.total").alias("total"))
    return x.orderBy(F.desc("total"), "uid").limit(5)


# --- duplicates ------------------------------------------------------------------------------------------------------


@query("", "select doc_id from documents where text in (select text from documents group by text having count(*) > 1)")
def q_dedup_exact(spark, d):
    """Every document that has a copy."""
    docs = base(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("h"))
    return docs.join(docs.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "h").select("doc_id")


@query("", "select doc_id, first_id from (select doc_id, min(doc_id) over (partition by text) as first_id from documents where text is not null) t where doc_id > first_id")
def q_dedup_copies(spark, d):
    """Every document that has an earlier copy, and the first one."""
    docs = base(spark, d, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("h"))
    first = docs.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return docs.join(first, "h").where("doc_id > first_id").select("doc_id", "first_id")


def titles(spark: SparkSession, d: str) -> DataFrame:
    """Part names with brand: short titles of few words, many of them alike."""
    return base(spark, d, "part").select(F.col("p_partkey").cast("string").alias("uid"), F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string")).alias("title_normalized"), F.col("p_partkey").alias("seq"), (F.col("p_size") % 3 + 1).cast("int").alias("authority_tier"), F.lit("queued").alias("status"))


# The LCS of two titles by rows of the usual table, as nested folds over lists of code points; most pairs are told apart by
# their edit distance, which is at most their Indel distance.
LCS = """list_extract(list_reduce(list_transform(string_split(x, ''), lambda c: [ord(c)]), lambda r, c: list_reduce(list_transform(range(1, length(y) + 1), lambda j: [j]),
    lambda acc, j: list_append(acc, greatest(acc[j[1]], r[j[1] + 1], r[j[1]] + case when ord(substr(y, j[1], 1)) = c[1] then 1 else 0 end)), [0]),
    list_transform(range(0, length(y) + 1), lambda k: 0)), length(y) + 1)"""
NAMES = "select distinct concat_ws(' ', p_name, p_type, cast(p_size as string)) as {0} from part"
LIKE = f"""select x, y, case when x = y then cast(100 as double) else 200 * cast({LCS} as double) / (length(x) + length(y)) end as score from (
    select x, y from ({NAMES.format("x")}) a, ({NAMES.format("y")}) b where x <> '' and y <> '' and levenshtein(x, y) <= 0.07 * (length(x) + length(y)) + 1e-9) p"""
ROWS = "select cast(p_partkey as string) as uid, concat_ws(' ', p_name, p_type, cast(p_size as string)) as t, p_partkey as seq, p_size % 3 + 1 as tier from part"


@query("", f"with s as (select * from ({LIKE}) q where score >= 93), r as ({ROWS}) select a.uid as left_id, b.uid as right_id, round(score, 6) as score from s join r a on a.t = s.x join r b on b.t = s.y where a.uid < b.uid")
def q_dedup_pairs(spark, d):
    t = titles(spark, d).select(F.col("uid").alias("id"), F.col("title_normalized").alias("title"))
    return dedup.pairs(t)


# Odd parts are staged; a title stands for its last row, and titles of one score come in the order of their first.
DECIDE = f"""with s as (select * from ({LIKE}) q where score >= 93), r as ({ROWS}), held as (select t, min(seq) as first, max_by(uid, seq) as uid, max_by(tier, seq) as tier from r where seq % 2 = 1 group by t),
    best as (select c.uid, c.tier, h.uid as matched_uid, h.tier as held_tier, s.score, row_number() over (partition by c.uid order by s.score desc, h.first) as k from r c join s on s.x = c.t join held h on h.t = s.y where c.seq % 2 = 0)
    select c.uid, case when b.uid is null then 'new' when b.tier < b.held_tier then 'supersedes' else 'duplicate_fuzzy' end as action, b.matched_uid, round(coalesce(b.score, 0), 6) as score from r c left join (select * from best where k = 1) b on b.uid = c.uid where c.seq % 2 = 0"""


@query("", DECIDE)
def q_dedup_decide(spark, d):
    t = titles(spark, d)
    return dedup.decided(t.where("seq % 2 = 0"), t.where("seq % 2 = 1")).withColumn("score", F.round("score", 6))


@query()
def q_dedup_greedy(spark, d):
    t = titles(spark, d)
    return cascade.resolved(t.where("seq % 3 > 0"), t.where("seq % 3 = 0")).drop("took")


@query()
def q_dedup_rounds(spark, d):
    """All parts as one batch of many tiers, with the number of rows that each one replaces; a third has one title."""
    t = titles(spark, d).withColumn("title_normalized", F.when(F.col("seq") % 3 == 0, "a title that a third of all rows has").otherwise(F.col("title_normalized")))
    t = t.withColumn("authority_tier", F.pmod(-1 - F.col("seq"), F.lit(31)).cast("int"))
    return cascade.resolved(t, t.where(F.lit(False))).withColumn("took", F.size("took"))


# --- alerts ----------------------------------------------------------------------------------------------------------

ALERTS = f"""select source as key, case when n % 2 = 0 then 'OPEN' else 'RESOLVED' end as state, 'was' as detail, timestamp '2024-01-01 00:00:00' as first_seen, case when n % 3 = 0 then timestamp '2024-01-28 00:00:00' else timestamp '2024-01-20 00:00:00' end as last_notified from (select split_part(uid, ':', 1) as source, count(*) as n from dlq where error_type <> 'view' group by 1) a"""
FSM = f"""with al as ({ALERTS}), w as (select source as key from ({DOWN}) t)
    select key, case step when 'OPEN' then 'OPEN' when 'RESOLVED' then 'RESOLVED' else state end as state, step as transition, case when step = 'OPEN' then timestamp '{AS_OF}' else first_seen end as first_seen, case when step is not null then timestamp '{AS_OF}' else last_notified end as last_notified from (
    select coalesce(al.key, w.key) as key, state, first_seen, last_notified, case when w.key is not null and coalesce(state, '') <> 'OPEN' then 'OPEN' when w.key is not null and last_notified <= timestamp '{AS_OF}' - interval 24 hour then 'REALERT' when w.key is null and state = 'OPEN' then 'RESOLVED' end as step from al full outer join w on al.key = w.key) x"""


@query("dlq", f"select * from ({FSM}) y")
def q_alert_fsm(spark, d):
    dlq = derived(spark, d, "dlq")
    n = dlq.where("error_type <> 'view'").groupBy(text.uid_source(F.col("uid")).alias("key")).agg(F.count("*").alias("n"))
    held = n.select("key", F.expr("case when n % 2 = 0 then 'OPEN' else 'RESOLVED' end").alias("state"), F.lit("was").alias("detail"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("first_seen"), F.expr("case when n % 3 = 0 then timestamp_ntz'2024-01-28 00:00:00' else timestamp_ntz'2024-01-20 00:00:00' end").alias("last_notified"))
    wanted = health.sources_down(dlq, now()).select(F.col("source").alias("key"), F.lit("down").alias("detail"))
    return alerts.evaluated(held, wanted, now()).select("key", "state", "transition", "first_seen", "last_notified")


DAY_AGO = f"timestamp '{AS_OF}' - interval 24 hour"
FIGURES = f"""select (select count(*) from dlq) as dlq_total, (select count(*) from dlq where retry_eligible) as dlq_retry_eligible, (select count(*) from dlq where created_at > {DAY_AGO}) as dlq_last_24h,
    (select count(*) from dlq where not retry_eligible and attempts >= 5) as dlq_permanent, (select count(*) from staged where status = 'queued' and tech_meta is null) as degraded_count,
    (select count(*) from staged where status = 'queued' and uid in (select uid from log where event_type = 'SCREEN_ESCALATED')) as screen_escalated_count,
    (select count(*) from ({PAIRS}) p) as screen_kappa_docs_count, (select count(*) > 0 from log where event_type = 'SCREEN_SINGLE_MODEL' and created_at > {DAY_AGO}) as single_model_mode_recent,
    (select count(distinct uid) from facts) as extraction_docs_count_24h, (select count(*) from log where event_type = 'APPROVED' and created_at >= date_trunc('day', timestamp '{AS_OF}')) as approved_today"""
PARTS = "staged log dlq runs ratings facts"


@query(PARTS, FIGURES)
def q_health_snapshot(spark, d):
    snap = _snapshot(spark, d)
    return snap.select("dlq_total", "dlq_retry_eligible", "dlq_last_24h", "dlq_permanent", "degraded_count", "screen_escalated_count", "screen_kappa_docs_count", "single_model_mode_recent", "extraction_docs_count_24h", "approved_today")


def _snapshot(spark: SparkSession, d: str) -> DataFrame:
    t = {n: derived(spark, d, n) for n in DERIVED}
    return health.snapshot(t["staged"], t["dlq"], t["log"], t["runs"], t["ratings"], t["facts"].withColumn("created_at", now()), now())


GROUNDED = "select avg(s) as g from (select sum(case when verified = 1 then cast(1 as double) else 0 end) / nullif(sum(case when verified in (0, 1) then 1 else 0 end), 0) as s from facts group by uid) x"
DOUBLE_KAPPA = KAPPA.replace("1.0 else 0.0", "cast(1 as double) else cast(0 as double)")
RULES = f"""select key from (select f.*, k.kappa, g.g, (select date_diff('second', max_by(started_at, id), timestamp '{AS_OF}') / 3600.0 from runs) as hours from ({FIGURES}) f, ({DOUBLE_KAPPA}) k, ({GROUNDED}) g) z,
    (select unnest(['DLQ_SPIKE', 'OLLAMA_DEGRADED', 'NO_BATCH_36H', 'DLQ_PERMANENT', 'SCREEN_DISAGREEMENT', 'EXTRACT_UNGROUNDED']) as key) r
    where case key when 'DLQ_SPIKE' then dlq_retry_eligible >= 5 when 'OLLAMA_DEGRADED' then degraded_count > 0 when 'NO_BATCH_36H' then hours > 36 when 'DLQ_PERMANENT' then dlq_permanent > 0
      when 'SCREEN_DISAGREEMENT' then kappa < 0.6 and screen_kappa_docs_count >= 5 else g < 0.8 and extraction_docs_count_24h >= 5 end
    union all select concat('SOURCE_DOWN:', source) from ({DOWN}) t"""


@query(PARTS, RULES)
def q_alert_rules(spark, d):
    """Every alert that the snapshot asks for while the model is down; the last report has no DLQ ratio."""
    return alerts.desired(_snapshot(spark, d), model_up=False).select("key")


# --- search strings --------------------------------------------------------------------------------------------------


@query("", """select c_custkey, r_name as source, concat('ti:("', n_name, '" OR "', r_name, '") AND "', c_mktsegment, '"') as query from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def q_query_render(spark, d):
    """A query for each customer: the nation or its region, and the market segment."""
    r = base(spark, d, "nation").join(base(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    x = base(spark, d, "customer").join(r, F.col("c_nationkey") == F.col("n_nationkey"))
    query_ = search_text.render_columns('ti:"{P}" AND "{I}"', search_text.concept_column(F.array("n_name", "r_name")), search_text.concept_column(F.array("c_mktsegment")))
    return x.select("c_custkey", F.col("r_name").alias("source"), query_.alias("query"))
