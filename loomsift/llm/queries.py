"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomsift.llm import best_fit, bpe, common, ctw, fim, media, near_dup, packing, quality, secrets, substring, tokens, toxicity, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels")))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


@query
def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(common.table(spark, sf_dir, "documents"))


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenise(common.table(spark, sf_dir, "documents"), digest=True)


@query
def op5_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(common.table(spark, sf_dir, "documents"))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(common.table(spark, sf_dir, "documents"))


@query
def op7_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read(tokens.write(common.table(spark, sf_dir, "documents")), with_ids=False)


@query
def op8_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.describe(media.encode(common.table(spark, sf_dir, "documents")))


@query
def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(common.table(spark, sf_dir, "documents"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), with_ids=False)


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return whitening.digest(vectors, whitening.fit(vectors))


@query
def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(common.table(spark, sf_dir, "documents"), with_ids=False)


@query
def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(common.table(spark, sf_dir, "documents"))


WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

DRAW = "('0x' || substr(sha256('1:' || doc_id), {0}, 8))::bigint"

ORACLE_SQL: dict[str, str] = {
    "op13_fim": f"""with t as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, {DRAW.format(1)} as h1, {DRAW.format(9)} as h2, {DRAW.format(17)} as h3, {DRAW.format(25)} as h4 from documents),
        c as (select *, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or doc_id is null or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form,
            least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as z from t),
        p as (select *, substr(t, 1, a) as pre, substr(t, a + 1, z - a) as mid, substr(t, z + 1) as suf from c)
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then z - a end as middle_chars,
            sha256(case form when 'plain' then t when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else '<P>' || pre || '<S>' || suf || '<M>' || mid end) as output_sha256, sha256(t) as restored_sha256 from p""",
    "op3_near_dup": f"""with recursive w as (select doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws from documents),
        s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')] else list_transform(range(1, len(ws) - 3), lambda p: array_to_string(ws[p:p+4], ' ')) end) as g from w),
        n as (select doc_id, count(*) as n from s group by doc_id),
        pair as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        link as (select x, y from pair join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * k >= 75 * (nx.n + ny.n - k)),
        edge as (select x, y from link union select y, x from link),
        reach as (select x, y from edge union select r.x, e.y from reach r join edge e on r.y = e.x)
        select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(m.m, d.doc_id)) as kept
        from documents d left join n on n.doc_id = d.doc_id left join (select x, min(y) as m from reach group by x) m on m.x = d.doc_id""",
    "op9_substring": f"""with w as (select doc_id, {WORDS.format("text")} as ws from documents),
        v as (select doc_id, ws, unnest(range(1, len(ws) - 11)) as p from w where len(ws) >= 13),
        k as (select doc_id, p, sha256(array_to_string(ws[p:p+12], ' ')) as g from v),
        f as (select g, min(doc_id) as m from k group by g),
        gone as (select distinct k.doc_id, k.p + o.o as at from k join f on k.g = f.g, (select unnest(range(0, 13)) as o) o where f.m < k.doc_id),
        words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as at from w),
        kept as (select words.doc_id, count(*) as n, array_to_string(list(word order by words.at), ' ') as t from words left join gone on words.doc_id = gone.doc_id and words.at = gone.at where gone.at is null group by words.doc_id)
        select w.doc_id, len(w.ws) as n_words, len(w.ws) - coalesce(kept.n, 0) as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256 from w left join kept on w.doc_id = kept.doc_id""",
}
