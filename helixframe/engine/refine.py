"""Refined antibody complexes: variable domains and touched antigen domains, as intervals and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.engine import structures
from helixframe.operators import domains
from helixframe.operators.tables import written


def annotation(chains: DataFrame, asked: DataFrame) -> DataFrame:
    """Of a case's rows of one chain the first; chains without a row keep nulls."""
    kept = [c for c in chains.columns if c not in ("source_path", "chain_id", "place")]
    first = chains.groupBy("source_path", "chain_id").agg(F.min_by(F.struct(*kept), "place").alias("_c")).select("source_path", "chain_id", "_c.*")
    return asked.join(first, ["source_path", "chain_id"], "left")


def run(complexes: DataFrame, atoms: DataFrame, annotated: DataFrame, target: str | None = None, **limits) -> DataFrame:
    """(structure, chain, role, intervals, warning) of each antibody complex, and its PDB files under a target.

    ``complexes`` is the prep table; ``annotated`` has source_path, chain_id,
    place, chain_type, domains and units of immune chains.
    """
    wanted = structures.antibody_parts(complexes)
    found = written(structures.stored.chains(atoms, wanted))
    role = F.when(F.col("side") == 1, "antibody").otherwise("antigen")
    trace = found.where(F.col("atom_name").isin("CA", "P")).groupBy(F.col("structure").alias("complex"), F.col("chain_id").alias("chain"), role.alias("role"), "res_id").agg(
        F.min_by(F.struct("x", "y", "z"), "atom_idx").alias("_p")
    ).select("complex", "chain", "role", "res_id", "_p.*")
    own = annotation(annotated, wanted.where("side = 1").select("structure", "source_path", "chain_id")).join(complexes.select(F.col("observation_id").alias("structure"), "antibody_unit_type"), "structure")
    chosen = domains.kept_domains(F.col("domains"), F.coalesce("units", F.array().cast(dict(annotated.dtypes)["units"])), F.col("antibody_unit_type"), F.col("chain_type"))
    kept = own.where("domains is not null").select(F.col("structure").alias("complex"), F.col("chain_id").alias("chain"), chosen.alias("domains"))
    out = written(domains.refined_chains(trace, written(kept), **limits))
    if target:
        inside = F.exists("intervals", lambda x: (F.col("res_id") >= x["first"]) & (F.col("res_id") <= x["last"]))
        named = out.select(F.col("complex").alias("structure"), F.col("chain").alias("chain_id"), "intervals")
        structures.files(found.join(named, ["structure", "chain_id"]).where(inside)).write.mode("overwrite").json(target)
    return out
