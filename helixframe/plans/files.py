"""Registered queries of the file reader: structure files that Spark writes from the driver's tables, read back, and SQL over the tables.

An order is a file in text form: its line items are atoms, suppliers are chains.
Of some orders the last row of the atoms is cut, so these files are damaged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.tables import shared_folder
from helixframe.plans.catalogue import QUERIES, _t, query
from helixframe.sources import mmcif

__all__ = ["QUERIES"]

_ATOM = ("id", "group_PDB", "type_symbol", "label_atom_id", "label_alt_id", "label_comp_id", "label_asym_id", "label_entity_id", "label_seq_id", "auth_seq_id", "pdbx_PDB_ins_code", "Cartn_x", "Cartn_y", "Cartn_z", "occupancy", "pdbx_PDB_model_num")
_MOVE = [f"matrix[{i}][{j}]" for i in (1, 2, 3) for j in (1, 2, 3)] + [f"vector[{i}]" for i in (1, 2, 3)]


def _text(*lines) -> F.Column:
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def _files(spark, sf_dir) -> DataFrame:
    """(path, content) of a file for each order with line items."""
    line = _t(spark, sf_dir, "lineitem")
    text = lambda c: F.col(c).cast("string")
    whole = lambda c: F.col(c).cast("int").cast("string")
    cells = [
        text("l_linenumber"), F.lit("ATOM"), F.when(F.col("l_linenumber") == 5, "H").otherwise("C"), F.when(F.col("l_linenumber") == 5, "H1").otherwise("CA"), F.lit("."),
        F.when(F.col("l_returnflag") == "R", "'it''s a'").otherwise("GLY"), text("l_suppkey"), F.lit("1"), F.when(F.col("l_partkey") % 4 == 0, "?").otherwise((F.col("l_partkey") % 40).cast("string")), text("l_linenumber"), F.lit("?"),
        whole("l_quantity"), F.when(F.col("l_partkey") % 9 == 0, "?").otherwise(text("l_linenumber")), (F.col("l_suppkey") % 17).cast("string"), F.lit("1.0"), F.when(F.col("l_linenumber") == 7, "2").otherwise("1"),
    ]
    rows = line.groupBy("l_orderkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey", F.concat_ws(" ", *cells).alias("t")))), lambda x: x["t"]), "\n").alias("atoms"),
        F.array_join(F.array_sort(F.collect_set(text("l_suppkey"))), ",").alias("chains"),
    )
    key = text("l_orderkey")
    content = _text(
        F.concat(F.lit("data_"), key), F.concat(F.lit("_entry.id "), key), "_struct.title", F.concat(F.lit(";order "), key), " second line", ";", "_exptl.method 'X-RAY DIFFRACTION' # a remark",
        "loop_", *[f"_atom_site.{c}" for c in _ATOM], F.col("atoms"),
        "loop_", *[f"_pdbx_struct_assembly_gen.{c}" for c in ("assembly_id", "asym_id_list", "oper_expression")], F.concat(F.lit("1 "), F.col("chains"), F.lit(" 1,2")),
        "loop_", *[f"_pdbx_struct_oper_list.{c}" for c in ("id", *_MOVE)], "1 1 0 0 0 1 0 0 0 1 0 0 0", F.when(F.col("l_orderkey") % 11 == 0, "2 -1 0").otherwise("2 -1 0 0 0 -1 0 0 0 1 10 0 0"), "",
    )
    return rows.select(key.alias("path"), F.encode(content, "UTF-8").alias("content"))


def _parsed(spark, sf_dir, *names: str) -> DataFrame:
    """The files' rows of the named categories, written once by category: every category reads its own of them."""
    return mmcif.stored(mmcif.parsed(_files(spark, sf_dir), *names), f"{shared_folder(spark)}/{uuid.uuid4().hex}")


@query("""
    select l_orderkey::varchar as path, l_orderkey % 11 <> 0 as whole, case when l_orderkey % 11 <> 0 then l_orderkey::varchar end as entry,
           case when l_orderkey % 11 <> 0 then 'order ' || l_orderkey || chr(10) || ' second line' end as title, case when l_orderkey % 11 <> 0 then 'X-RAY DIFFRACTION' end as method,
           case when l_orderkey % 11 <> 0 then count(*) end as atoms, case when l_orderkey % 11 <> 0 then string_agg(l_suppkey::varchar, ',' order by l_linenumber, l_suppkey, l_partkey) end as chains
    from lineitem group by l_orderkey""")
def file_contents(spark, sf_dir):
    """Each file with whether it is whole, its first values, row counts and a column in order; damaged files have nothing else."""
    found = _parsed(spark, sf_dir, "entry", "struct", "exptl", "atom_site")
    status = mmcif.files(found)
    out = status.where("error is null").select("path", F.lit(True).alias("whole"))
    for name, (category, column) in {"entry": ("entry", "id"), "title": ("struct", "title"), "method": ("exptl", "method")}.items():
        out = out.join(mmcif.first_value(found, category, column).withColumnRenamed("value", name), "path", "left")
    out = out.join(mmcif.row_counts(found, "atom_site", "id").withColumnRenamed("rows", "atoms"), "path", "left")
    out = out.join(mmcif.column_values(found, "atom_site", "label_asym_id").select("path", F.array_join("values", ",").alias("chains")), "path", "left")
    return out.unionByName(status.where("error is not null").select("path", F.lit(False).alias("whole")), allowMissingColumns=True)


_PLACES = """
    with a as (select l_orderkey::varchar as path, l_suppkey::varchar as chain_id, case when l_partkey % 4 = 0 then l_linenumber else l_partkey % 40 end::int as res_id,
                      case when l_returnflag = 'R' then 'it''''s a' else 'GLY' end as res_name, l_quantity::int::double as x, l_linenumber::double as y, (l_suppkey % 17)::double as z, l_linenumber
               from lineitem where l_orderkey % 11 <> 0 and l_linenumber not in (5, 7) and l_partkey % 9 <> 0)"""


@query(_PLACES + " select path, chain_id, res_id, res_name, x, y, z from a")
def file_atoms(spark, sf_dir):
    """Atoms of the first model of whole files, without hydrogens and without places that are missing."""
    found = _parsed(spark, sf_dir, "atom_site")
    rows = mmcif.undamaged(mmcif.atoms(found), found)
    return rows.select("path", "chain_id", "res_id", "res_name", *[F.col(c).cast("double").alias(c) for c in "xyz"])


@query(_PLACES + """
    select path, chain_id, 0 as sym_id, x, y, z from a union all select path, chain_id, 1, 10 - x, -y, z from a""")
def file_assemblies(spark, sf_dir):
    """Atoms of each file's assembly: two copies of its chains, as they are and moved."""
    found = _parsed(spark, sf_dir, "atom_site", "pdbx_struct_assembly_gen", "pdbx_struct_oper_list")
    rows = mmcif.undamaged(mmcif.assembly_atoms(found, "1"), found)
    return rows.select("path", "chain_id", F.col("sym_id").cast("int").alias("sym_id"), *[F.col(c).cast("double").alias(c) for c in "xyz"])
