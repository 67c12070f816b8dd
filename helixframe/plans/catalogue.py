"""The registered queries of the structural engine on the relational tables, and their SQL.

Operators live in ``helixframe.operators`` and ``helixframe.functions`` and take
column names; here they get stand-in tables: documents are sequences, line
items interfaces of parts and suppliers, orders entries with dates, events
warnings, embeddings structures, conversations ordered members.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions import scalars as S
from helixframe.operators import clustering as C
from helixframe.operators import geometry as G3
from helixframe.operators import graphs as G
from helixframe.operators import relational as R

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "interface_dedup_argmax"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


# Sequences


@query("""
    with k as (select doc_id, upper(replace(regexp_replace(text, '\\s+', '', 'g'), 'ß', 'SS')) as s from documents),
    g as (select s, min(doc_id) as representative, count(*) as size,
                 row_number() over (order by length(s) desc, s) as n from k group by s)
    select k.doc_id, 'prot_' || n as cluster_id, representative, size from k join g using (s)""")
def exact_sequence_clusters(spark, sf_dir):
    """A24, C1."""
    docs = _t(spark, sf_dir, "documents")
    return C.exact_clusters(docs, "doc_id", S.sequence_key(F.col("text")), "prot_").select("doc_id", "cluster_id", "representative", "size")


@query("select doc_id, 'op_' || (row_number() over (order by doc_id)) as cluster_id from documents")
def singleton_clusters(spark, sf_dir):
    """A25."""
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    return C.numbered_groups(docs, "doc_id", [F.col("doc_id").asc()], "op_")


@query("""
    with d as (select lang, text, doc_id from documents),
    g as (select lang, md5(text) as k, min(doc_id) as best, count(*) as copies from d group by lang, text)
    select lang, best as doc_id, copies from g""")
def identical_subcluster(spark, sf_dir):
    """Of equal sequences in a bucket, the best copy only."""
    docs = _t(spark, sf_dir, "documents").withColumn("k", F.md5("text"))
    return docs.groupBy("lang", "k", F.length("text")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("lang", "doc_id", "copies")


@query("""
    select d.doc_id, coalesce('labelled_' || l.quality, 'fallback') as assignment
    from documents d left join (select doc_id, max(quality) as quality from labels group by doc_id) l using (doc_id)""")
def missing_assignment_fallback(spark, sf_dir):
    """J32, its anti join: members without an assignment are marked; ``missing_assignment_clusters`` clusters them."""
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    known = _t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    named = docs.join(known.select("doc_id", F.concat(F.lit("labelled_"), F.col("quality").cast("string")).alias("assignment")), "doc_id")
    missing = docs.join(known, "doc_id", "left_anti").select("doc_id", F.lit("fallback").alias("assignment"))
    return named.unionByName(missing)


@query("""
    with l as (select doc_id, 'labelled_' || max(quality) as c from labels where quality is not null group by doc_id),
    k as (select doc_id, upper(replace(regexp_replace(coalesce(text, ''), '\\s+', '', 'g'), 'ß', 'SS')) as s from documents where doc_id not in (select doc_id from l)),
    f as (select coalesce(max(substr(c, 10)::bigint), 0) as n from l),
    g as (select s, min(doc_id) as representative, count(*) as size, row_number() over (order by length(s) desc, s) + (select n from f) as n from k group by s)
    select d.doc_id, c as assignment, min(d.doc_id) over (partition by c) as representative, count(*) over (partition by c) as size from documents d join l using (doc_id)
    union all select doc_id, 'labelled_' || n, representative, size from k join g using (s)""")
def missing_assignment_clusters(spark, sf_dir):
    """Members without an assignment are clustered by equal sequences, numbered from the next free cluster."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    best = _t(spark, sf_dir, "labels").where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = best.select("doc_id", F.concat(F.lit("labelled_"), F.col("quality").cast("string")).alias("assignment"))
    missing = C.missing_clusters(docs, "doc_id", S.sequence_key(F.col("text")), known, "labelled_", "assignment")
    named = docs.select("doc_id").join(known, "doc_id")
    sizes = named.groupBy("assignment").agg(F.min("doc_id").alias("representative"), F.count("*").alias("size"))
    return named.join(sizes, "assignment").unionByName(missing)


@query("""
    select source, doc_id, rank from (
        select d.source, d.doc_id, row_number() over (partition by d.source order by l.quality nulls last, d.n_chars desc, d.doc_id)::int as rank
        from documents d left join (select doc_id, max(quality) as quality from labels group by doc_id) l using (doc_id))
    where rank = 1""")
def quality_ranking(spark, sf_dir):
    """The first of each source by quality (nulls last), length and id."""
    known = _t(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = _t(spark, sf_dir, "documents").select("source", "doc_id", "n_chars").join(known, "doc_id", "left")
    order = [F.col("quality").asc_nulls_last(), F.col("n_chars").desc(), F.col("doc_id").asc()]
    return R.top_by(rows, ["source"], order, 1).select("source", "doc_id", "rank")


# Dates and entries

_CUTOFF = "1996-01-01"


@query("""
    select d as decision, count(*) as n from (
        select case when o_orderdate::date < date '1996-01-01' then 'kept' else 'too_recent' end as d from orders) group by d""")
def cutoff_filter_stats(spark, sf_dir):
    """how many entries the release cutoff keeps, and why others go."""
    rows = _t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return rows.select(S.date_decision(F.col("d"), F.lit(_CUTOFF).cast("date")).alias("decision")).groupBy("decision").agg(F.count("*").alias("n"))


@query("""
    select l_orderkey, count(*) as n from lineitem
    where l_orderkey in (select o_orderkey from orders where o_orderdate::date < date '1996-01-01') group by l_orderkey""")
def release_filtered_inventory(spark, sf_dir):
    """Interfaces of entries before the cutoff."""
    old = _t(spark, sf_dir, "orders").where(F.to_date("o_orderdate") < F.lit(_CUTOFF).cast("date"))
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey")
    return R.semi(rows, old.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("""
    with v as (select o_orderkey, o_orderdate as d, strftime(o_orderdate, '%Y-%m-%d') as s from orders),
    w as (select o_orderkey, case o_orderkey % 6 when 0 then s when 1 then year(d) || '-' || month(d) || '-' || day(d) when 2 then strftime(d, '%Y%m%d') when 3 then ''
                                                 when 4 then year(d) || '-02-30' else s || ' ' end as v from v)
    select o_orderkey, v as value, case when regexp_full_match(v, '\\d{4}-\\d{2}-\\d{2}') then try_cast(v as date) end::varchar as parsed from w""")
def strict_date_parse(spark, sf_dir):
    """dates of orders, five of six written in another way."""
    kind = F.col("o_orderkey") % 6
    text = lambda form: F.date_format("o_orderdate", form)
    value = F.when(kind == 0, text("yyyy-MM-dd")).when(kind == 1, text("yyyy-M-d")).when(kind == 2, text("yyyyMMdd")).when(kind == 3, "").when(kind == 4, F.concat(text("yyyy"), F.lit("-02-30")))
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", value.otherwise(F.concat(text("yyyy-MM-dd"), F.lit(" "))).alias("value"))
    return rows.select("o_orderkey", "value", S.strict_date(F.col("value")).cast("string").alias("parsed"))


@query("""
    select o_orderstatus as status, count(*) as n, sum(round(o_totalprice * 100)::bigint)::bigint as cents,
           min(o_orderdate::date)::varchar as first_date, count(*) filter (o_orderpriority like '1%') as urgent
    from orders group by o_orderstatus""")
def batch_summary(spark, sf_dir):
    """Status counts and totals; ``batch_totals`` is the operator."""
    rows = _t(spark, sf_dir, "orders").select("*", _cents("o_totalprice").alias("cents"))
    return rows.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"), F.min(F.to_date("o_orderdate")).cast("string").alias("first_date"),
        F.count_if(F.col("o_orderpriority").startswith("1")).alias("urgent"),
    )


# Lookups and joins


@query("select p_brand as entity, count(*) as n, sum(round(l_extendedprice * 100)::bigint)::bigint as cents from lineitem join part on p_partkey = l_partkey group by p_brand")
def mandatory_lookup(spark, sf_dir):
    """Interfaces with the entity of their first side; a missing one is an error."""
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), _cents("l_extendedprice").alias("cents"))
    found = R.looked_up(rows, _t(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_partkey"], "part")
    return found.groupBy(F.col("p_brand").alias("entity")).agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("""
    select o_orderkey from orders where o_orderdate::date < date '1996-01-01'
    union select l_orderkey from lineitem""")
def reference_backfill(spark, sf_dir):
    """Canonical entries, and those that only interfaces refer to."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    canon = orders.where(F.to_date("o_orderdate") < F.lit(_CUTOFF).cast("date")).select("o_orderkey")
    refs = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.backfill(canon, refs, orders, ["o_orderkey"]).distinct()


@query("""
    select l_suppkey, count(*) as n from lineitem semi join
        (select s_suppkey from supplier join nation on n_nationkey = s_nationkey where n_regionkey = 2) s on s_suppkey = l_suppkey
    group by l_suppkey""")
def source_semi_join(spark, sf_dir):
    """J20."""
    nation = _t(spark, sf_dir, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    scope = _t(spark, sf_dir, "supplier").join(nation, "s_nationkey", "left_semi").select(F.col("s_suppkey").alias("l_suppkey"))
    return R.semi(_t(spark, sf_dir, "lineitem").select("l_suppkey"), scope, ["l_suppkey"]).groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("""
    select r_name, n_name, count(c_custkey) as customers, coalesce(sum(round(c_acctbal * 100)::bigint), 0)::bigint as cents
    from region full join nation on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey group by r_name, n_name""")
def dimension_chain_join(spark, sf_dir):
    """A chain of outer joins with dimension tables."""
    region, nation = _t(spark, sf_dir, "region"), _t(spark, sf_dir, "nation")
    per = _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.sum(_cents("c_acctbal")).alias("cents"))
    rows = region.join(nation, F.col("n_regionkey") == F.col("r_regionkey"), "full").join(per, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    zero = F.lit(0).cast("long")
    return rows.groupBy("r_name", "n_name").agg(F.coalesce(F.sum("customers"), zero).alias("customers"), F.coalesce(F.sum("cents"), zero).alias("cents"))


@query("""
    with m as (select distinct l_orderkey, l_partkey from lineitem)
    select x.l_orderkey, x.l_partkey as a, y.l_partkey as b from m x join m y on x.l_orderkey = y.l_orderkey and x.l_partkey < y.l_partkey""")
def pair_self_join(spark, sf_dir):
    """Pairs of members of each case; cases are small."""
    return R.member_pairs(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@query("""
    with m as (select distinct l_orderkey, l_suppkey from lineitem)
    select x.l_suppkey as a, y.l_suppkey as b, count(*) as shared
    from m x join m y on x.l_orderkey = y.l_orderkey and x.l_suppkey < y.l_suppkey group by 1, 2""")
def member_cooccurrence(spark, sf_dir):
    """In how many groups two members meet."""
    return R.cooccurrences(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey")


@query("""
    with s as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate from lineitem),
    m as (select p_partkey from part where p_size <= 25),
    z as (select l_partkey, l_suppkey, round(l_extendedprice * 100)::bigint as cents,
                 l_partkey in (select p_partkey from m) as a, l_suppkey in (select p_partkey from m) as b from s)
    select case when a then l_partkey else l_suppkey end as inside, count(*) as n, sum(cents)::bigint as cents from z where a <> b group by 1""")
def antibody_side_join(spark, sf_dir):
    """Interfaces with exactly one side in a unit."""
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", _cents("l_extendedprice").alias("cents"))
    unit = _t(spark, sf_dir, "part").where("p_size <= 25").select("p_partkey")
    sided = R.two_sided(rows, "l_partkey", "l_suppkey", unit, "p_partkey")
    return sided.groupBy("inside").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("""
    with b as (select distinct l_orderkey as o, l_suppkey as m from lineitem),
    u as (select distinct l_partkey as u, l_suppkey as m from lineitem),
    n as (select u, count(*) as n from u group by u)
    select u.u as unit, b.o as support from u join b using (m) join n using (u) group by u.u, b.o, n.n having count(*) = n.n""")
def set_containment_all(spark, sf_dir):
    """Cases that hold every member of a unit, whose members are those of all rows."""
    rows = _t(spark, sf_dir, "lineitem")
    sets = rows.select(F.col("l_orderkey").alias("support"), F.col("l_suppkey").alias("m"))
    units = rows.select(F.col("l_partkey").alias("unit"), F.col("l_suppkey").alias("m"))
    return R.contained(units, sets, "unit", "support", "m")


@query("""
    select l_orderkey, l_partkey from lineitem where l_returnflag = 'R'
    intersect select l_orderkey, l_partkey from lineitem where l_linestatus = 'F'""")
def contact_intersection(spark, sf_dir):
    """J18, U3."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    return rows.where("l_returnflag = 'R'").select("l_orderkey", "l_partkey").intersect(rows.where("l_linestatus = 'F'").select("l_orderkey", "l_partkey"))


@query("""
    with m as (select l_orderkey, max(l_linenumber) as k from lineitem group by l_orderkey)
    select l_orderkey, unnest(range(1, k + 1))::int as position from m
    except select l_orderkey, l_linenumber from lineitem""")
def expected_minus_resolved(spark, sf_dir):
    """U4: expected positions without a resolved one."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("position"))
    most = rows.groupBy("l_orderkey").agg(F.max("position").alias("k"))
    expected = most.select("l_orderkey", F.explode(F.sequence(F.lit(1), "k")).alias("position"))
    return expected.join(rows.distinct(), ["l_orderkey", "position"], "left_anti")


# Aggregations and windows

@query("""
    with r as (select *, row_number() over (partition by l_partkey order by l_extendedprice desc, l_quantity desc, l_suppkey, l_linenumber, l_shipdate) as r from lineitem),
    c as (select l_partkey, count(distinct l_suppkey) as num_supporting from lineitem group by l_partkey)
    select l_partkey, l_suppkey, round(l_extendedprice * 100)::bigint as cents, num_supporting from r join c using (l_partkey) where r = 1""")
def interface_dedup_argmax(spark, sf_dir):
    """The best interface of each key and its number of distinct supports."""
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    order = [F.col("l_extendedprice").desc(), F.col("l_quantity").desc(), *(F.col(c).asc() for c in ("l_suppkey", "l_linenumber", "l_shipdate"))]
    best = R.deduplicated_interfaces(rows, ["l_partkey"], order, ["l_suppkey"])
    return best.select("l_partkey", "l_suppkey", _cents("l_extendedprice").alias("cents"), "num_supporting")


@query("""
    with p as (select l_orderkey, p_brand, l_partkey, sum(round(l_extendedprice * 100)::bigint)::bigint as area from lineitem join part on p_partkey = l_partkey group by 1, 2, 3)
    select l_orderkey, p_brand, arg_max(l_partkey, row(area, -l_partkey)) as representative, sum(area)::bigint as total_area, count(*) as members from p group by 1, 2""")
def entity_collapse(spark, sf_dir):
    """A13, W22."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"), _cents("l_extendedprice").alias("area"))
    rows = rows.join(_t(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey")
    return R.collapsed(rows.withColumnRenamed("p_partkey", "l_partkey"), "l_orderkey", "p_brand", "l_partkey", "area")


@query("""
    with d as (select distinct l_orderkey, l_linenumber as x from lineitem),
    i as (select *, x - row_number() over (partition by l_orderkey order by x) as g from d)
    select l_orderkey, min(x)::int as first, max(x)::int as last, count(*) as length from i group by l_orderkey, g""")
def segments(spark, sf_dir):
    """Runs of consecutive positions."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("x"))
    return R.segments(rows, ["l_orderkey"], "x")


@query("""
    with c as (select *, case when event_type is not distinct from lag(event_type) over w and row_number() over w > 1 then 0 else 1 end as c from events
               window w as (partition by user_id order by ts, event_id)),
    r as (select *, sum(c) over (partition by user_id order by ts, event_id rows unbounded preceding)::bigint as run from c)
    select user_id, run, min(event_type) as event_type, count(*) as length from r group by user_id, run""")
def run_length_residues(spark, sf_dir):
    """W5, W6."""
    rows = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return R.runs(rows, ["user_id"], ["ts", "event_id"], "event_type")


@query("""
    select p_brand, arg_min(p_name, row(p_size, p_partkey)) as first_name, arg_max(p_partkey, row(p_size, -p_partkey)) as largest from part group by p_brand""")
def largest_assembly(spark, sf_dir):
    """Arg-max with a tie-break."""
    rows = _t(spark, sf_dir, "part")
    return rows.groupBy("p_brand").agg(
        F.min_by("p_name", F.struct("p_size", "p_partkey")).alias("first_name"),
        F.max_by("p_partkey", F.struct(F.col("p_size"), -F.col("p_partkey"))).alias("largest"),
    )


@query("""
    with v as (select p_partkey, p_brand, case p_partkey % 4 when 0 then p_size::varchar when 1 then '00' || p_size when 2 then p_type || p_size else p_partkey::varchar end as v from part)
    select p_partkey, v as assembly_id, row_number() over (partition by p_brand order by regexp_full_match(v, '\\d+') desc, try_cast(v as bigint), v, p_partkey)::int as place from v""")
def numeric_aware_order(spark, sf_dir):
    """Assemblies of a brand by number, then names."""
    kind, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    name = F.when(kind == 0, size).when(kind == 1, F.concat(F.lit("00"), size)).when(kind == 2, F.concat("p_type", size)).otherwise(F.col("p_partkey").cast("string"))
    rows = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", name.alias("assembly_id"))
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(S.assembly_order(F.col("assembly_id")), "p_partkey"))
    return rows.select("p_partkey", "assembly_id", place.alias("place"))


@query("""
    select p_type, sum(p_size * case when p_type like '%A%' then 8 when p_type like '%O%' then 20 else 5 end)::bigint as summed,
           arg_max(p_size * case when p_type like '%A%' then 8 when p_type like '%O%' then 20 else 5 end, p_partkey)::bigint as last_row
    from part group by p_type""")
def assembly_atom_estimate(spark, sf_dir):
    """Weighted sizes, summed, and as the last row has them."""
    each = F.when(F.col("p_type").contains("A"), 8).when(F.col("p_type").contains("O"), 20).otherwise(5)
    rows = _t(spark, sf_dir, "part").select("p_type", "p_partkey", (F.col("p_size") * each).cast("long").alias("atoms"))
    return rows.groupBy("p_type").agg(F.sum("atoms").alias("summed"), F.max_by("atoms", "p_partkey").alias("last_row"))


@query("""
    select p_partkey, case p_partkey % 6 when 0 then '(1-' || p_size || ')(P,Q)' when 1 then '1-' || p_size || ',2' when 2 then p_size || '-1' when 3 then '(1, 2)(A)(3-' || p_size || ')' when 4 then '?' else p_size || ',' || p_size || ', P' end as expression,
           array_to_string(case p_partkey % 6 when 0 then flatten(list_transform(range(1, p_size + 1), lambda x: [x || 'xP', x || 'xQ'])) when 1 then list_transform(range(1, greatest(p_size, 2) + 1), lambda x: x::varchar)
               when 2 then list_transform(range(p_size, 0, -1), lambda x: x::varchar)
               when 3 then flatten(list_transform(['1', '2'], lambda g: list_transform(case when p_size < 3 then range(3, p_size - 1, -1) else range(3, p_size + 1) end, lambda x: g || 'xAx' || x))) when 4 then ['1'] else [p_size::varchar, 'P'] end, ',') as operations
    from part where p_size > 0""")
def oper_expression(spark, sf_dir):
    """Expressions of parts: products, ranges up and down, names, repeats, none."""
    kind, size = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    made = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    text = F.when(kind == 0, made("(1-", size, ")(P,Q)")).when(kind == 1, made("1-", size, ",2")).when(kind == 2, made(size, "-1")).when(kind == 3, made("(1, 2)(A)(3-", size, ")"))
    rows = _t(spark, sf_dir, "part").where("p_size > 0").select("p_partkey", text.when(kind == 4, "?").otherwise(made(size, ",", size, ", P")).alias("expression"))
    return rows.select("p_partkey", "expression", F.array_join(S.operations(F.col("expression")), ",").alias("operations"))


@query("""
    select page_id, regexp_replace(lower(regexp_extract(url, '([^/\\\\]*)$', 1)), '\\.b?cif(\\.gz)?$', '') as case_id,
           nullif(regexp_extract(regexp_replace(lower(regexp_extract(url, '([^/\\\\]*)$', 1)), '\\.b?cif(\\.gz)?$', ''), '^([0-9][a-z0-9]{3})(?:[-_].*)?$', 1), '') as entry_id from pages""")
def case_id_from_path(spark, sf_dir):
    """X5, X6."""
    return _t(spark, sf_dir, "pages").select("page_id", S.case_id(F.col("url")).alias("case_id"), S.entry_from_name(F.col("url")).alias("entry_id"))


@query("""
    with c as (select p_partkey, case p_partkey % 8 when 0 then 'other protein chain' when 1 then 'DNA chain' when 2 then 'RNA chain' when 3 then 'other nucleic acid chain'
                                      when 4 then 'other polymer chain' when 5 then 'metal ion' when 6 then 'TCR chain' else 'other polymer chain' end as k,
                      case p_size % 5 when 0 then 'polyDeoxyribonucleotide' when 1 then 'polyribonucleotide' when 2 then 'polypeptide(D)' when 3 then null else 'other' end as t from part)
    select p_partkey, case when k in ('other protein chain', 'TCR chain') then 'protein' when k = 'DNA chain' then 'dna' when k = 'RNA chain' then 'rna' when k = 'metal ion' then null
                           when t ilike '%deoxyribo%' then 'dna' when t ilike '%ribo%' then 'rna' when k = 'other nucleic acid chain' then 'other_nucleic_acid'
                           when t ilike '%peptide%' then 'protein' else 'other_polymer' end as polymer_class from c""")
def polymer_class_map(spark, sf_dir):
    """Classes of chains by type, then polymer type; null for what is no polymer."""
    pick = lambda key, values: F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int") + 1)
    kinds = ("other protein chain", "DNA chain", "RNA chain", "other nucleic acid chain", "other polymer chain", "metal ion", "TCR chain", "other polymer chain")
    kind = pick(F.col("p_partkey"), kinds)
    text = pick(F.col("p_size"), ("polyDeoxyribonucleotide", "polyribonucleotide", "polypeptide(D)", None, "other"))
    return _t(spark, sf_dir, "part").select("p_partkey", S.polymer_class(kind, text).alias("polymer_class"))


# Signatures


@query("""
    with i as (select l_orderkey, string_agg(p_type, '|' order by p_type) as sig from
                 (select distinct l_orderkey, p_type from lineitem join part on p_partkey = l_partkey) group by l_orderkey),
    g as (select sig, count(*) as size, row_number() over (order by count(*) desc, sig) as n from i group by sig)
    select l_orderkey, 'mulsig_' || n as signature_cluster_id, size from i join g using (sig)""")
def signature_groups(spark, sf_dir):
    """X31, W19, A24, S60."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    rows = rows.join(_t(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey").select("l_orderkey", "p_type").distinct()
    sig = rows.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("p_type")), "|").alias("sig"))
    out = C.signature_groups(sig, "l_orderkey", "sig", "mulsig_")
    return out.select("l_orderkey", F.col("cluster_id").alias("signature_cluster_id"), "size")


@query("""
    with t as (select *, row_number() over (partition by conv_id order by turn, role, text) - 1 as i, turn % 3 > 0 as named from conversations)
    select conv_id, count(*) as n,
           coalesce(string_agg(upper(role) || case when turn % 2 = 0 then ':' || role else '' end, '|' order by turn, i) filter (named),
                    'fallback|polymer_type=' || 'p' || (conv_id % 5) || '|description=' || 'd ' || (conv_id % 3) || '|sequence=' || 'AB' || (conv_id % 7)) as key
    from t group by conv_id""")
def component_key(spark, sf_dir):
    """Components with their types in order of position, or the texts that stand for a polymer without any."""
    detail = F.struct(F.col("turn").cast("int").alias("label_seq_id"), F.when(F.col("turn") % 3 > 0, F.col("role")).otherwise("?").alias("monomer_id"), F.when(F.col("turn") % 2 == 0, F.col("role")).alias("chem_comp_type"))
    rows = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", detail.alias("d")))).alias("t"), F.count("*").alias("n"))
    number = lambda text, k: F.concat(F.lit(text), (F.col("conv_id") % k).cast("string"))
    key = S.component_key(F.transform("t", lambda x: x["d"]), number(" p", 5), number("d  ", 3), number("a b", 7))
    return rows.select("conv_id", key.alias("key"), "n")


@query("""
    select conv_id, turn, case when p = 1 then 'alpha' when p = 2 then 'beta' else 'auxiliary' end as descriptor
    from (select *, row_number() over (partition by conv_id order by turn) as p from conversations)""")
def role_descriptors(spark, sf_dir):
    """Roles by position; ``member_rules`` has the operators."""
    rows = _t(spark, sf_dir, "conversations").select("conv_id", "turn")
    p = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    return rows.withColumn("p", p).select("conv_id", "turn", F.when(F.col("p") == 1, "alpha").when(F.col("p") == 2, "beta").otherwise("auxiliary").alias("descriptor"))


# Reviews


@query("select event_type as code, count(*) as n, count(distinct user_id) as cases from events group by event_type")
def warning_counts(spark, sf_dir):
    """Counts and cases of each warning code."""
    return _t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("code")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("cases"))


@query("""
    select user_id, n, rank from (select user_id, count(*) as n, row_number() over (order by count(*) desc, user_id)::int as rank from events group by user_id) where rank <= 10""")
def top_cases(spark, sf_dir):
    """The ten cases with most warnings (a report's own limit)."""
    top = _t(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(10)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "user_id")))


@query("""
    select code, user_id, n, rank from (
        select event_type as code, user_id, count(*) as n, row_number() over (partition by event_type order by count(*) desc, user_id)::int as rank from events group by 1, 2)
    where rank <= 10""")
def top_by_code(spark, sf_dir):
    """The ten first cases of each warning code (a report's own limit)."""
    rows = _t(spark, sf_dir, "events").groupBy(F.col("event_type").alias("code"), "user_id").agg(F.count("*").alias("n"))
    return R.top_by(rows, ["code"], [F.desc("n"), F.col("user_id").asc()], 10)


@query("""
    with p as (select l_orderkey, count(*) as n, sum(round(l_extendedprice * 100)::bigint)::bigint as cents from lineitem group by 1)
    select count(*) as cases, sum(n)::bigint as interfaces, sum(cents)::bigint as cents, max(n) as most, arg_max(l_orderkey, row(n, -l_orderkey)) as largest_case,
           (select count(*) from orders where o_orderkey not in (select l_orderkey from lineitem)) as empty_cases from p""")
def smoke_aggregate(spark, sf_dir):
    """Totals and the largest case; ``smoke_totals`` is the operator."""
    per = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(_cents("l_extendedprice")).alias("cents"))
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = per.withColumn("own", F.lit(1)).join(orders.withColumn("entry", F.lit(1)), "l_orderkey", "full")
    return rows.agg(
        F.count("own").alias("cases"), F.sum("n").alias("interfaces"), F.sum("cents").alias("cents"), F.max("n").alias("most"),
        F.max_by("l_orderkey", F.when(F.col("own").isNotNull(), F.struct(F.col("n"), -F.col("l_orderkey")))).alias("largest_case"),
        F.count_if(F.col("own").isNull()).alias("empty_cases"),
    )


@query("select event_id, event_type, len(json_keys(props)) as fields, json_extract_string(props, '$.page') as page from events")
def json_flatten(spark, sf_dir):
    """Fields of nested values."""
    rows = _t(spark, sf_dir, "events")
    return rows.select("event_id", "event_type", F.size(F.json_object_keys("props")).cast("long").alias("fields"), F.get_json_object("props", "$.page").alias("page"))


@query("""
    select t.l_partkey, t.l_suppkey, m.p is not null as memoised from (select distinct l_partkey, l_suppkey from lineitem) t
    left join (select distinct l_partkey as p, l_suppkey as s from lineitem where l_returnflag = 'N') m on m.p = t.l_partkey and m.s = t.l_suppkey""")
def memo_antijoin(spark, sf_dir):
    """Tasks, and whether any row has their result; ``memo_lookup`` is the operator."""
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return rows.groupBy("l_partkey", "l_suppkey").agg(F.max(F.coalesce(F.col("l_returnflag") == "N", F.lit(False))).alias("memoised"))


@query("""
    select page_id, len(regexp_extract_all(html, '<[a-zA-Z][^>]*>')) as opening, len(regexp_extract_all(html, '</[a-zA-Z][^>]*>')) as closing, length(html) as size from pages""")
def html_tokenise(spark, sf_dir):
    """Markup tokens by kind."""
    rows = _t(spark, sf_dir, "pages")
    return rows.select(
        "page_id", F.size(F.regexp_extract_all("html", F.lit("<[a-zA-Z][^>]*>"), F.lit(0))).cast("long").alias("opening"),
        F.size(F.regexp_extract_all("html", F.lit("</[a-zA-Z][^>]*>"), F.lit(0))).cast("long").alias("closing"), F.length("html").cast("long").alias("size"),
    )


# Graphs and clusters


def _edges(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").join(_t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("case")), "l_suppkey")
    area = _cents("l_extendedprice").alias("area")
    rows = rows.select("case", "l_suppkey", (F.col("l_partkey") + 1_000_000_000).alias("l_partkey"), area, "l_quantity", "l_linenumber")
    return G.edge_table(rows, "case", "l_suppkey", "l_partkey", "area", 6_000_000, ["area", "l_quantity", "l_linenumber"])


@query("""
    with recursive e as (select distinct s_nationkey as c, l_suppkey as u, l_partkey + 1000000000 as v from lineitem join supplier on s_suppkey = l_suppkey where round(l_extendedprice * 100) >= 6000000),
    x as (select c, u, v from e union all select c, v, u from e),
    r(c, node, root) as (select c, u, u from x union select x.c, x.v, r.root from r join x on x.c = r.c and x.u = r.node where r.root < x.v)
    select c as "case", node, min(root) as component from r group by 1, 2""")
def connected_components(spark, sf_dir):
    """Components of case graphs."""
    return G.case_components(_edges(spark, sf_dir), "case")


@query()
def bridge_pruned_communities(spark, sf_dir):
    """Communities after bridge pruning; checked by invariants in the tests."""
    return G.communities(_edges(spark, sf_dir), "case")


@query()
def greedy_matching(spark, sf_dir):
    """Greedy pairs of each case; checked against brute force in the tests."""
    return G.greedy_matching(_edges(spark, sf_dir), "case", "u", "v", ["area"], [True])


@query()
def leader_clusters(spark, sf_dir):
    """Structures of a bucket join the first leader near enough; checked against brute force in the tests."""
    rows = _t(spark, sf_dir, "embeddings").select("label", "vec_id", "embedding")
    return C.leader_clusters(rows, "label", "vec_id", ["vec_id"], "embedding", _near)


def _near(leaders, members, least: float = 0.2) -> np.ndarray:
    return np.array(members, float) @ np.array(leaders, float).T >= least


_HALVES = "list_min(embedding[1:32])::double as lo1, list_max(embedding[1:32])::double as hi1, list_min(embedding[33:64])::double as lo2, list_max(embedding[33:64])::double as hi2"


@query(f"""
    with b as (select vec_id, {_HALVES} from embeddings)
    select vec_id, greatest(0, lo1 - hi2, lo2 - hi1) as gap, greatest(0, lo1 - hi2, lo2 - hi1) <= 0.0 as near from b""")
def bbox_filter(spark, sf_dir):
    """Distance of two intervals; ``box_distances`` is the operator."""
    half = lambda i: F.slice("embedding", i, 32)
    lo1, hi1, lo2, hi2 = (f(half(i)).cast("double") for i in (1, 33) for f in (F.array_min, F.array_max))
    gap = F.greatest(F.lit(0.0), lo1 - hi2, lo2 - hi1)
    return _t(spark, sf_dir, "embeddings").select("vec_id", gap.alias("gap"), (gap <= 0).alias("near"))


def _places(spark, sf_dir):
    """The first three components as places, in double precision; two groups of owners by id."""
    rows = _t(spark, sf_dir, "embeddings")
    xyz = [F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate("xyz")]
    return rows.select(F.col("label").alias("case"), F.col("vec_id").alias("id"), F.pmod("vec_id", F.lit(7)).alias("owner"), *xyz)


_PAIRS = """
    with p as (select label as "case", vec_id as id, vec_id % 7 as owner, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z from embeddings),
    d as (select a."case", a.id, b.id as id_2, a.owner, b.owner as owner_2,
                 sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) as d
          from p a join p b on a."case" = b."case" and a.id < b.id)"""


@query(_PAIRS + """ select "case", id, id_2 from d where d <= 0.1""")
def distance_contacts(spark, sf_dir):
    """Pairs within a distance, by a grid join."""
    rows = _places(spark, sf_dir)
    return G3.contacts(rows, rows, "case", 0.1).where("id < id_2").select("case", "id", "id_2")


@query(_PAIRS.replace("a.id < b.id", "a.id <> b.id") + """
    select "case", id, arg_min(owner_2, row(d, id_2)) as owner from d where d <= 0.1 group by 1, 2""")
def nearest_owner(spark, sf_dir):
    """The owner of the nearest row within a distance."""
    rows = _places(spark, sf_dir)
    return G3.nearest_owner(G3.contacts(rows, rows, "case", 0.1).where("id <> id_2"), "case").select("case", "id", "owner")
