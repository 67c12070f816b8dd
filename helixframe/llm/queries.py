"""The registered queries of this subpackage, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import divergence, fingerprints, language_id, licences, mixing, near_join, packing, piece_sampling, quality, spellings, suffix_dedup, vectors

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op3_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.round_trip(_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op4_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.link_documents(_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).drop("kept_text", "removed")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(_table(spark, sf_dir, "embeddings"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    return language_id.predict(docs.select("doc_id", language_id.held_out().alias("held_out"), "text"), model)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.select(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(_table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(_table(spark, sf_dir, "documents"))


def fingerprint_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates by the fingerprints of ``op12_fingerprints``: their bands joined, candidates verified on texts."""
    return fingerprints.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_packing, op3_piece_sampling, op4_near_join, op5_suffix_dedup, op6_nearest, op7_top_k, op8_licences, op9_language_id, op10_quality,
        op11_spellings, op12_fingerprints, fingerprint_classes, op13_divergence,
    )
}

ORACLE_SQL = {
    "op4_near_join": """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                             when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y on x.s = y.s and x.doc_id < y.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
r(doc_id, root) as (select doc_id, doc_id from documents union select e.b, r.root from r join e on e.a = r.doc_id where r.root < e.b)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(r.root)::bigint as component_id
from documents d left join n using (doc_id) join r using (doc_id) group by d.doc_id, n.n""",
    "op7_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        pairs as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
            from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 100 = 0),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from pairs)
        select query_id, rank, vec_id, score from ranked where rank <= 10""",
    "op13_divergence": """
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
t as (select r, lang, source, unnest(w) as term from d),
k as (select lang, term, count(*) as n from t group by 1, 2 having count(distinct r) >= 10),
c as (select lang, source, term, count(*) as n from t group by 1, 2, 3),
g as (select distinct lang, source from d),
m as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as lang_n from g join k on k.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
s as (select *, sum(n) over (partition by lang, source)::hugeint as total, sum(lang_n) over (partition by lang, source)::hugeint as lang_total, count(*) over (partition by lang, source) as v from m),
p as (select lang, source, term, n, 1 + 1000000000::hugeint * (n + 2) // (total + 2 * v) as p, 1 + 1000000000::hugeint * (lang_n + 2) // (lang_total + 2 * v) as q from s),
a as (select x.lang, x.source, y.source as item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) as value from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by 1, 2, 3),
f as (select x.lang, x.source, 'pair' as part, y.source as item, coalesce(a.value, 0)::bigint as value from g x join g y on x.lang = y.lang and x.source <> y.source left join a on a.lang = x.lang and a.source = x.source and a.item = y.source
      union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p where n > 0 and p > q),
o as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from f)
select lang, source, part, item, value, rank from o where part = 'pair' or rank <= 10""",
}

# Bands find all links of these tables; the links are those of the exact join.
ORACLE_SQL["fingerprint_classes"] = f"select doc_id, component_id as class_id from ({ORACLE_SQL['op4_near_join']})"
