"""Registered queries of what runs do between tables: references, primary methods, unpaired chains, structures of observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.engine import cluster, structures
from helixframe.functions import scalars as S
from helixframe.operators import complexes
from helixframe.operators.tables import dealt, written
from helixframe.plans.catalogue import QUERIES, _t, query
from helixframe.plans.structural import _text

__all__ = ["QUERIES"]


def _observed(spark, sf_dir):
    """Interfaces, multimers and complexes of entries (customers) whose chains are named by parts and suppliers."""
    rows, orders = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    size = rows.count() + orders.count()
    rows = written(dealt(rows, size, "l_orderkey").join(dealt(orders, size, "l_orderkey"), "l_orderkey"))
    chain = lambda c, n: F.concat(F.lit("c"), (F.col(c) % n).cast("string"))
    rows = rows.select(
        F.concat(F.lit("e"), _text("o_custkey")).alias("pdb_id"), ((F.col("l_orderkey") % 2) + 1).cast("string").alias("assembly_id"), (F.col("l_linenumber") % 4).alias("kind"),
        chain("l_partkey", 7).alias("a"), chain("l_suppkey", 5).alias("b"),
    )
    both = F.to_json(F.array("a", "b"))
    one = lambda c: F.to_json(F.array(c))
    of = lambda k: rows.where(F.col("kind") == k)
    return {
        "dimers": of(0).select("pdb_id", "assembly_id", F.col("a").alias("label_asym_id_1"), F.col("b").alias("label_asym_id_2")), "multimers": of(1).select("pdb_id", "assembly_id", both.alias("member_chain_ids")),
        "antibody_complexes": of(2).select("pdb_id", "assembly_id", one("a").alias("antibody_chain_ids"), one("b").alias("antigen_chain_ids")),
        "tcr_complexes": of(3).select("pdb_id", "assembly_id", one("a").alias("tcr_chain_ids"), one("b").alias("mhc_chain_ids"), F.lit("[]").alias("peptide_chain_ids"), F.lit(None).cast("string").alias("auxiliary_chain_ids")),
    }


@query("""
    with r as (select 'e' || o_custkey as pdb_id, (l_orderkey % 2 + 1)::varchar as assembly_id, 'c' || (l_partkey % 7) as a, 'c' || (l_suppkey % 5) as b from lineitem join orders on o_orderkey = l_orderkey),
    refs as (select pdb_id, assembly_id, a as chain from r union select pdb_id, assembly_id, b from r),
    own as (select 'e' || c_custkey || ':1:c' || k as monomer_id, 'e' || c_custkey as pdb_id, '1' as assembly_id, 'c' || k as chain, c_name || k as sequence from (select c_custkey, c_name, unnest(range(0, c_custkey % 6)) as k from customer)),
    more as (select r.pdb_id || ':' || r.assembly_id || ':' || r.chain as monomer_id, r.pdb_id, r.assembly_id, r.chain, o.sequence from refs r join own o using (pdb_id, chain) where r.assembly_id <> o.assembly_id)
    select monomer_id, pdb_id, assembly_id, chain as label_asym_id, sequence from own union all select * from more""")
def backfilled_inventory(spark, sf_dir):
    """The inventory, and chains that interfaces, multimers or complexes name in another assembly."""
    own = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.explode(F.expr("sequence(0, cast(c_custkey % 6 as int) - 1)")).alias("k")).where("k >= 0 and c_custkey % 6 > 0")
    pdb, chain = F.concat(F.lit("e"), _text("c_custkey")), F.concat(F.lit("c"), _text("k"))
    own = own.select(S.monomer_id(pdb, F.lit("1"), chain).alias("monomer_id"), pdb.alias("pdb_id"), F.lit("1").alias("assembly_id"), chain.alias("label_asym_id"), F.concat("c_name", _text("k")).alias("sequence"))
    return cluster.backfilled(own, cluster.high_order_references(_observed(spark, sf_dir)))


@query("""
    with m as (select o_custkey, case o_orderkey % 7 when 0 then 'X-RAY DIFFRACTION' when 1 then 'ELECTRON MICROSCOPY' when 2 then 'SOLUTION NMR' when 3 then 'SOLID-STATE NMR' when 4 then 'neutron diffraction' when 5 then ' ' else 'Powder Diffraction' end as m from orders),
    p as (select *, case lower(m) when 'x-ray diffraction' then 0 when 'electron microscopy' then 1 when 'solution nmr' then 2 when 'solid-state nmr' then 2 else 99 end as p from m where trim(m) <> ''),
    b as (select o_custkey, arg_min(m, row(p, m)) as method from p group by 1)
    select c.o_custkey::varchar as entry, b.method from (select distinct o_custkey from orders) c left join b using (o_custkey)""")
def entry_methods(spark, sf_dir):
    """Of the methods of an entry the first by priority, then name; entries with blanks only have none."""
    names = ["X-RAY DIFFRACTION", "ELECTRON MICROSCOPY", "SOLUTION NMR", "SOLID-STATE NMR", "neutron diffraction", " ", "Powder Diffraction"]
    rows = _t(spark, sf_dir, "orders").select(_text("o_custkey").alias("entry"), F.element_at(F.array(*map(F.lit, names)), (F.col("o_orderkey") % 7).cast("int") + 1).alias("m"))
    return rows.groupBy("entry").agg(S.primary_method(F.collect_set("m")).alias("method"))


@query("""
    with f as (select l_orderkey as c, 'h' || (l_partkey % 3) as h, 'l' || (l_suppkey % 3) as l, round(l_extendedprice * 100)::bigint as area, l_linenumber as n, l_partkey, l_suppkey from lineitem),
    e as (select c, h, l, max(area) as area from f group by 1, 2, 3),
    best as (select *, row_number() over (partition by c order by area desc, h, l) as r from e),
    one as (select c, h, l from best where r = 1),
    two as (select e.*, row_number() over (partition by e.c order by e.area desc, e.h, e.l) as r from e join one o on o.c = e.c and e.h <> o.h and e.l <> o.l),
    second as (select c, h, l from two where r = 1),
    three as (select e.*, row_number() over (partition by e.c order by e.area desc, e.h, e.l) as r from e join one o on o.c = e.c join second s on s.c = e.c where e.h not in (o.h, s.h) and e.l not in (o.l, s.l))
    select c::varchar as "case", h as heavy, l as light from (select * from one union all select * from second union all select c, h, l from three where r = 1)""")
def heavy_light_matching(spark, sf_dir):
    """Heavy and light chains of a case paired one by one by largest area; three of each at most, so three turns say it in SQL."""
    rows = _t(spark, sf_dir, "lineitem")
    faces = rows.select(
        _text("l_orderkey").alias("case"), F.concat(F.lit("h"), (F.col("l_partkey") % 3).cast("string")).alias("label_asym_id_1"), F.concat(F.lit("l"), (F.col("l_suppkey") % 3).cast("string")).alias("label_asym_id_2"),
        F.lit(complexes.HEAVY).alias("chain_type_1"), F.lit(complexes.LIGHT).alias("chain_type_2"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("buried_area"),
    ).groupBy("case", "label_asym_id_1", "label_asym_id_2", "chain_type_1", "chain_type_2").agg(F.max("buried_area").alias("buried_area"))
    faces = faces.withColumns({"num_atom_contacts": F.lit(1), "num_residue_contacts": F.lit(1), "_h": F.col("label_asym_id_1")})
    ends = [faces.select("case", F.col(f"label_asym_id_{i}").alias("label_asym_id"), F.col(f"chain_type_{i}").alias("chain_type")) for i in (1, 2)]
    chains = ends[0].union(ends[1]).distinct().withColumns({"subtype": F.lit("x"), "unit_type": F.lit(None).cast("string")})
    return complexes.heavy_light_pairs(chains, faces.drop("_h")).select("case", "heavy", "light")


@query("""
    with m as (select l_orderkey as o, l_linenumber as n, l_suppkey % 4 as c, l_partkey % 3 as s from lineitem)
    select o::varchar as observation_id, count(*) as parts, count(distinct c) as chains, min(s)::int as least_copy from m group by 1""")
def structure_parts(spark, sf_dir):
    """The parts of multimers by their instances, with the copy of each."""
    rows = _t(spark, sf_dir, "lineitem")
    chain = F.concat(F.lit("c"), (F.col("l_suppkey") % 4).cast("string"))
    instance = F.struct(F.concat(chain, F.lit("@"), (F.col("l_partkey") % 3 + 1).cast("string")).alias("instance_id"), chain.alias("label_asym_id"))
    made = rows.groupBy(_text("l_orderkey").alias("observation_id")).agg(F.to_json(F.collect_list(instance)).alias("member_instances"), F.to_json(F.collect_set(chain)).alias("member_chain_ids"))
    parts = structures.multimer_parts(made.withColumns({"source_path": F.lit("s"), "assembly_id": F.lit("1")}))
    return parts.groupBy(F.col("structure").alias("observation_id")).agg(F.count("*").alias("parts"), F.countDistinct("chain_id").alias("chains"), F.min("sym_id").cast("int").alias("least_copy"))
