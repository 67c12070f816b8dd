"""Registered queries of scalar and row rules on whole driver tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import chains as K
from helixframe.functions import scalars as S
from helixframe.operators import complexes, refinement, reports
from helixframe.plans.catalogue import QUERIES, _t, query
from helixframe.plans.structural import _pick, _text
from helixframe.sources import sinks

__all__ = ["QUERIES"]


@query("""
    with r as (select p_partkey, p_name, p_type, p_brand, p_size, case p_size % 4 when 0 then '' when 1 then null when 2 then ' se ' else 'd' end as e from part)
    select p_partkey, case when trim(coalesce(e, '')) <> '' then upper(trim(e)) when upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g'))[1:2] in ('BR', 'CL', 'SE') then upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g'))[1:2]
                           else upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g'))[1:1] end as element,
           coalesce(p_type || ':' || p_size || trim(case when p_size % 3 = 0 then 'A ' else '' end), '') as residue, coalesce(try_cast(regexp_extract(p_size || 'B', '^(\\d+)', 1) as int), 0) as number,
           case when length(trim(regexp_replace(p_brand, '[^A-Za-z0-9_.=-]+', '_', 'g'), '_')) > 0 then trim(regexp_replace(p_brand, '[^A-Za-z0-9_.=-]+', '_', 'g'), '_') else 'case' end as slug,
           replace(replace(replace(replace(replace(p_name || '<&">''', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') as html,
           'dir/' || p_name as moved, substr(sha256(concat_ws('|', p_name, p_type, p_size::varchar)), 1, 32) as key
    from r""")
def atom_and_text_rules(spark, sf_dir):
    """Elements, residue ids, numbering labels, slugs, escapes, paths and alignment keys."""
    e = _pick(F.col("p_size"), "", None, " se ", "d")
    r = _t(spark, sf_dir, "part")
    tail = F.when(F.col("p_size") % 3 == 0, "A ").otherwise("")
    return r.select(
        "p_partkey", S.element_symbol(e, F.col("p_name")).alias("element"), S.residue_id(F.col("p_type"), F.col("p_size"), tail).alias("residue"), S.leading_number(F.concat(_text("p_size"), F.lit("B"))).alias("number"),
        S.slug(F.col("p_brand")).alias("slug"), S.html_text(F.concat("p_name", F.lit("<&\">'"))).alias("html"), S.moved_path(F.concat(F.lit("/x/y/"), "p_name"), "dir/").alias("moved"),
        S.alignment_key(F.col("p_name"), F.col("p_type"), F.col("p_size")).alias("key"),
    )


_LOCI = "hla-dq|hla-dr|hla-dp|h2-ia|h2-ie"


@query(f"""
    with c as (select c_custkey, case c_custkey % 9 when 0 then 'HLA class II DR alpha chain' when 1 then 'MHC CLASS-I antigen' when 2 then 'HLA-A*02:01' when 3 then 'HLA-DRB1 beta 1 chain' when 4 then 'Beta-2-microglobulin'
                              when 5 then 'T cell receptor delta chain' when 6 then 'TCR' when 7 then null else 'lysozyme ' || c_name end as d from customer),
    l as (select c_custkey, lower(coalesce(d, '')) as d from c),
    k as (select *, case when regexp_matches(d, '\\bclass[\\s-]*ii\\b') then 'II' when regexp_matches(d, '\\bclass[\\s-]*i\\b') then 'I' when regexp_matches(d, '{_LOCI}') then 'II'
                         when regexp_matches(d, 'hla-a|hla-b|hla-c|hla-e|hla-f|hla-g') then 'I' else 'unknown' end as k from l)
    select c_custkey, k as mhc_class,
           case when k = 'I' then 'class_i_heavy' when k = 'II' and regexp_matches(d, '\\balpha\\b') then 'class_ii_alpha' when k = 'II' and (regexp_matches(d, '\\bbeta\\b') or contains(d, 'hla-drb')) then 'class_ii_beta' else 'unknown' end as mhc_role,
           case when contains(d, 'beta-2-microglobulin') then 'beta2m or auxiliary immune chain' when regexp_matches(d, 'mhc|hla-|histocompatibility') then 'MHC heavy chain' when regexp_matches(d, 't cell receptor|tcr') then 'TCR chain' end as chain_type
    from k""")
def description_rules(spark, sf_dir):
    """Class and role of presenting chains, and the type that a description gives."""
    d = F.coalesce(
        _pick(F.col("c_custkey"), "HLA class II DR alpha chain", "MHC CLASS-I antigen", "HLA-A*02:01", "HLA-DRB1 beta 1 chain", "Beta-2-microglobulin", "T cell receptor delta chain", "TCR", None, None),
        F.when(F.col("c_custkey") % 9 == 8, F.concat(F.lit("lysozyme "), "c_name")),
    )
    rows = _t(spark, sf_dir, "customer").select("c_custkey", d.alias("d"))
    return rows.select("c_custkey", K.mhc_class(F.col("d")).alias("mhc_class"), K.mhc_role(F.col("d")).alias("mhc_role"), K.described_type(F.col("d"))["type"].alias("chain_type"))


_TYPES = ("antibody heavy chain", "antibody light chain", "TCR chain", "MHC heavy chain", "peptide antigen", "other protein chain", "DNA chain", "RNA chain", "glycan / branched component", "metal ion", "small molecule compound", "other entity")
_SQL_TYPES = "[" + ", ".join(f"'{t}'" for t in _TYPES) + "]"


@query(f"""
    with r as (select l_orderkey, l_partkey, l_suppkey, {_SQL_TYPES}[l_partkey % 12 + 1] as t1, {_SQL_TYPES}[l_suppkey % 12 + 1] as t2, l_partkey % 5 = l_suppkey % 5 as same, l_quantity as n from lineitem),
    s as (select *, case when t1 < t2 then t1 else t2 end as lo, case when t1 < t2 then t2 else t1 end as hi from r)
    select case when same then 'same-entity:' || lo else lo || '__' || hi end as label, count(*) as n, count(*) filter (contains(t1, 'antibody') or contains(t2, 'antibody')) as antibody,
           count(*) filter (t1 in ('peptide antigen', 'other protein chain') and n <= 30) as peptides, count(distinct least(l_partkey, l_suppkey) * 1000000 + greatest(l_partkey, l_suppkey)) as pairs,
           min(case when t1 in ('DNA chain', 'RNA chain') then 'nucleic_acid_chains' when t1 like 'glycan%' then 'branched_entities' when t1 = 'metal ion' then 'metal_ions' when t1 = 'small molecule compound' then 'small_molecule_compounds'
                    when t1 = 'other entity' then 'other_entities' else 'protein_chains' end) as first_group
    from s group by 1""")
def interface_rules(spark, sf_dir):
    """Labels of interfaces, antibody flags, peptide candidates, keys of copies, output groups."""
    t1, t2 = _pick(F.col("l_partkey"), *_TYPES), _pick(F.col("l_suppkey"), *_TYPES)
    same = F.col("l_partkey") % 5 == F.col("l_suppkey") % 5
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", t1.alias("t1"), t2.alias("t2"), same.alias("same"))
    label = S.interface_label(F.col("t1"), F.col("t2"), F.col("same"))
    side = lambda c: F.struct(F.col(c).alias("chain"), F.lit("").alias("entity"))
    key = S.interface_key(F.lit("m"), F.lit("1"), side("l_partkey"), side("l_suppkey"), label, F.col("same"))
    antibody = F.col("t1").contains("antibody") | F.col("t2").contains("antibody")
    return rows.groupBy(label.alias("label")).agg(
        F.count("*").alias("n"), F.count_if(antibody).alias("antibody"), F.count_if(complexes.is_peptide(F.col("t1"), F.col("l_quantity"))).alias("peptides"), F.countDistinct(key).alias("pairs"), F.min(S.output_group(F.col("t1"))).alias("first_group"),
    )


@query("""
    with r as (select o_orderkey, ['alpha_beta', 'gamma_delta', 'single_tcr'][o_orderkey % 3 + 1] as k, (o_orderkey % 4 + 1)::int as n from orders)
    select o_orderkey, array_to_string(list_transform(range(1, n + 1), lambda i: case when k = 'alpha_beta' and i <= 2 then ['alpha', 'beta'][i] when k = 'gamma_delta' and i <= 2 then ['gamma', 'delta'][i] else 'tcr_' || i end), ',') as roles,
           case o_orderkey % 5 when 0 then 'heavy' when 1 then 'light' else 'antibody_member' end as antibody_role,
           case when o_orderkey % 3 = 0 then 'alpha_beta' when o_orderkey % 3 = 1 then 'gamma_delta' end as pair_type,
           case when n = 2 and o_orderkey % 2 = 0 then 'homodimer' when n = 2 then 'tight_dimer' when o_orderkey % 2 = 0 then 'homomultimer' else 'heteromultimer' end as multimer_type,
           o_orderkey || case when o_orderkey % 2 = 0 then ':' || n else '' end || ':c' as monomer_id, case when n * 50 >= 140 then 'high' when n * 50 >= 80 then 'medium' else 'low' end as confidence,
           greatest(0, least(n + 3, 6) - greatest(n, 2)) as overlap from r""")
def member_rules(spark, sf_dir):
    """Roles by place, pair and multimer types, ids, confidence, overlaps."""
    k, n, o = _pick(F.col("o_orderkey"), "alpha_beta", "gamma_delta", "single_tcr"), (F.col("o_orderkey") % 4 + 1).cast("int"), _text("o_orderkey")
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", o.alias("o"), k.alias("k"), n.alias("n"))
    subtype = lambda a, b: _pick(F.col("o_orderkey"), a, b, "unknown")
    chain = _pick(F.col("o_orderkey"), "h", "l", "x", "x", "x")
    return rows.select(
        "o_orderkey", F.array_join(refinement.tcr_roles(F.col("k"), F.col("n")), ",").alias("roles"), refinement.antibody_role(chain, F.lit("h"), F.lit("l")).alias("antibody_role"),
        complexes.pair_type(subtype("beta", "gamma"), subtype("alpha", "delta")).alias("pair_type"), S.multimer_type(F.col("n"), F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(2)).alias("multimer_type"),
        S.monomer_id(F.col("o"), F.when(F.col("o_orderkey") % 2 == 0, F.col("n").cast("string")).otherwise(""), F.lit("c")).alias("monomer_id"), S.confidence(F.col("n") * 50, F.lit(80)).alias("confidence"),
        S.overlap(F.col("n"), F.col("n") + 3, F.lit(2), F.lit(6)).alias("overlap"),
    )


@query("""
    with s as (select doc_id, lang, upper(replace(regexp_replace(coalesce(text, ''), '\\s+', '', 'g'), 'ß', 'SS')) as s from documents)
    select doc_id, lang as polymer_class, '>' || doc_id || chr(10) || regexp_replace(regexp_replace(s, '(.{80})', '\\1' || chr(10), 'g'), '\\n$', '') as record from s where lang is not null and lang <> 'other_polymer'""")
def fasta_records(spark, sf_dir):
    """Whole sequences as records in lines of eighty letters."""
    docs = _t(spark, sf_dir, "documents").select(F.col("lang").alias("polymer_class"), _text("doc_id").alias("monomer_id"), S.sequence_key(F.coalesce("text", F.lit(""))).alias("sequence"))
    return sinks.fasta_records(docs).select(F.col("monomer_id").cast("long").alias("doc_id"), "polymer_class", "record")


@query("""
    with w as (select user_id::varchar as c, event_type as code, count(*) as n from events group by 1, 2)
    select c as case_dir, code, n, row_number() over (partition by code order by n desc, c)::int as rank from w""")
def warning_cases_ranked(spark, sf_dir):
    """All cases of each warning code with their rank."""
    rows = _t(spark, sf_dir, "events").groupBy(_text("user_id").alias("case_dir"), F.lit("parse").alias("kind"), F.col("event_type").alias("code")).agg(F.count("*").alias("n"))
    return reports.cases_by_code(rows).select("case_dir", "code", "n", "rank")


@query("""
    select l_orderkey, count(distinct l_linenumber % 3)::int as keys, count(*) as total from lineitem group by 1""")
def merged_count_maps(spark, sf_dir):
    """Maps of counts, one for each half of a case's rows, added up."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_linenumber") % 3).cast("string").alias("k"), (F.col("l_suppkey") % 2).alias("half"))
    counted = rows.groupBy("l_orderkey", "half", "k").agg(F.count("*").cast("int").alias("n"))
    maps = counted.groupBy("l_orderkey").pivot("half", [0, 1]).agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))))
    none = F.create_map().cast("map<string,int>")
    merged = reports.merged_counts(F.coalesce("`0`", none), F.coalesce("`1`", none))
    return maps.select("l_orderkey", F.size(merged).alias("keys"), F.aggregate(F.map_values(merged), F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))


@query("""
    with q as (select doc_id, max(quality) as q from labels group by 1),
    d as (select d.*, q.q, case coalesce(q.q, 9) when 1 then 'X-RAY DIFFRACTION' when 0 then 'SOLUTION NMR' else '' end as m from documents d left join q using (doc_id))
    select source, doc_id, row_number() over (partition by source order by case m when 'X-RAY DIFFRACTION' then 0 when 'SOLUTION NMR' then 2 else 99 end, case when doc_id % 3 = 0 then null else doc_id % 7 end nulls last,
                                              -(n_chars % 10) / 10.0, printf('%09d', doc_id))::int as rank from d""")
def structure_quality_order(spark, sf_dir):
    """Order of structures by method, resolution, resolved share and id."""
    from pyspark.sql import Window

    known = _t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"))
    rows = _t(spark, sf_dir, "documents").join(known, "doc_id", "left")
    method = F.when(F.col("q") == 1, "X-RAY DIFFRACTION").when(F.col("q") == 0, "SOLUTION NMR").otherwise("")
    rows = rows.select(
        "source", "doc_id", S.method_priority(method).alias("method_priority"), F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 7).alias("resolution"), ((F.col("n_chars") % 10) / 10).alias("resolved_fraction"), F.format_string("%09d", "doc_id").alias("monomer_id"),
    )
    return rows.select("source", "doc_id", F.row_number().over(Window.partitionBy("source").orderBy(*refinement.quality_order())).alias("rank"))


@query("""
    with m as (select l_orderkey as o, l_partkey % 50 as chain, l_suppkey % 3 as sym from lineitem),
    n as (select o, count(distinct chain) as n from m group by 1), h as (select o, sym, count(distinct chain) as k from m group by 1, 2)
    select o as structure, min(sym) as sym_id from h join n using (o) where k = n group by 1""")
def common_symmetry(spark, sf_dir):
    """The least copy number that all chains of a structure have."""
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("structure"), (F.col("l_partkey") % 50).alias("chain_id"), (F.col("l_suppkey") % 3).alias("sym_id"))
    return refinement.common_symmetry(rows)
