"""Placed atoms of cases as a table that later stages read by source, assembly and chain.

Atoms are Parquet in folders by assembly, sorted by source and chain, so that a
reader of some sources and chains prunes folders and row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The assembly of an asymmetric unit.
UNIT = "au"


def store(atoms: DataFrame, target: str, as_assembly: str | None = None) -> None:
    """Atoms (source_path, assembly_id, chain_id, sym_id, atom_idx, ...); without an assembly they are the
    asymmetric unit, or the assembly that it stands for."""
    named = atoms.withColumn("assembly_id", F.coalesce("assembly_id", F.lit(as_assembly or UNIT)))
    named.repartition("source_path").sortWithinPartitions("source_path", "chain_id", "sym_id", "atom_idx").write.mode("append").partitionBy("assembly_id").parquet(target)


def load(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).withColumn("assembly_id", F.col("assembly_id").cast("string"))


def assembly(atoms: DataFrame, wanted: DataFrame) -> DataFrame:
    """Atoms of (source_path, assembly_id); where a source has no such assembly but only one at all, that one."""
    have = atoms.select("source_path", "assembly_id").distinct()
    only = have.groupBy("source_path").agg(F.count("*").alias("_n"), F.min("assembly_id").alias("_a")).where("_n = 1")
    asked = wanted.select("source_path", F.coalesce("assembly_id", F.lit(UNIT)).alias("asked"))
    exact = asked.join(have.withColumnRenamed("assembly_id", "asked"), ["source_path", "asked"], "left_semi").withColumn("assembly_id", F.col("asked"))
    rest = asked.join(exact.select("source_path", "asked"), ["source_path", "asked"], "left_anti").join(only, "source_path").select("source_path", "asked", F.col("_a").alias("assembly_id"))
    return atoms.join(exact.unionByName(rest), ["source_path", "assembly_id"])


def chains(atoms: DataFrame, wanted: DataFrame) -> DataFrame:
    """Atoms of structures given as (structure, source_path, assembly_id, chain_id, sym_id, part).

    A null sym_id takes every copy. A structure of which any chain is missing
    has no atoms at all.
    """
    base = assembly(atoms, wanted.select("source_path", "assembly_id").distinct()).drop("assembly_id").withColumnRenamed("asked", "assembly_id")
    specs = wanted.withColumn("assembly_id", F.coalesce("assembly_id", F.lit(UNIT)))
    named = base.withColumnRenamed("sym_id", "own_sym")
    found = specs.join(named, ["source_path", "assembly_id", "chain_id"]).where("sym_id is null or sym_id = own_sym").drop("sym_id").withColumnRenamed("own_sym", "sym_id")
    parts = specs.groupBy("structure").agg(F.countDistinct("part").alias("_want"))
    have = found.groupBy("structure").agg(F.countDistinct("part").alias("_have"))
    whole = parts.join(have, "structure").where("_want = _have").select("structure")
    return found.join(whole, "structure", "left_semi")


def missing(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """Structures that could not be put together."""
    return wanted.select("structure").distinct().join(found.select("structure").distinct(), "structure", "left_anti")


def oversized(found: DataFrame, most: int = 10_000) -> DataFrame:
    """structures with more atoms than a refinement takes."""
    return found.groupBy("structure").agg(F.count("*").alias("atoms")).where(F.col("atoms") > most)


def removed_counts(raw: DataFrame, keys: list[str]) -> DataFrame:
    """how many atoms a structure loses as hydrogens, and as atoms without finite places."""
    from helixframe.functions.scalars import is_hydrogen

    light = is_hydrogen(F.col("element"), F.col("atom_name"))
    lost = F.exists(F.array("x", "y", "z"), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return raw.groupBy(*keys).agg(F.count_if(light).alias("hydrogen_atoms_removed"), F.count_if(lost).alias("nonfinite_atoms_removed"), F.count_if(~light & ~lost).alias("kept"))


def inventory_rows(spark: SparkSession, path: str) -> DataFrame:
    """A monomer inventory of JSON lines; of rows with one id the last counts."""
    rows = spark.read.json(path).withColumn("_at", F.monotonically_increasing_id())
    w = Window.partitionBy("monomer_id").orderBy(F.desc("_at"))
    return rows.where("coalesce(monomer_id, '') <> ''").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_at")
