"""Structures of observations: which chains they are of, their atoms, what is compared, and files of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.scalars import distinct_in_order
from helixframe.operators import refinement
from helixframe.sources import atoms as stored
from helixframe.sources import sinks

_TEXTS = "array<string>"
_MEMBERS = "array<struct<instance_id:string,label_asym_id:string,operation_id:string,sym_id:int>>"


def chain_ids(*lists: Column) -> Column:
    """The chains of several lists in order, each once."""
    return distinct_in_order(F.concat(*[F.coalesce(x, F.array().cast(_TEXTS)) for x in lists]))


def _parts(rows: DataFrame, parts: Column) -> DataFrame:
    """(structure, source_path, assembly_id, chain_id, sym_id, part, side) of an array of (chain, sym, side) structs."""
    return rows.select(F.col("observation_id").alias("structure"), "source_path", F.nullif("assembly_id", F.lit("")).alias("assembly_id"), F.posexplode(parts).alias("part", "p")).select(
        "structure", "source_path", "assembly_id", F.col("p.chain").alias("chain_id"), F.col("p.sym").alias("sym_id"), "part", F.col("p.side").alias("side")
    )


def _spec(chain: Column, sym: Column | None = None, side: int = 1) -> Column:
    return F.struct(chain.alias("chain"), (F.lit(None).cast("int") if sym is None else sym.cast("int")).alias("sym"), F.lit(side).alias("side"))


def monomer_parts(monomers: DataFrame) -> DataFrame:
    """The one chain of each monomer."""
    return _parts(monomers.withColumnRenamed("monomer_id", "observation_id"), F.array(_spec(F.col("label_asym_id"), F.lit(0))))


def dimer_parts(dimers: DataFrame) -> DataFrame:
    """Both sides of an interface, each with its copy."""
    return _parts(dimers, F.array(*[_spec(F.col(f"label_asym_id_{i}"), F.col(f"sym_id_{i}"), i) for i in (1, 2)]))


def multimer_parts(multimers: DataFrame) -> DataFrame:
    """A multimer's instances with their copies; without instances its chains."""
    given = F.from_json("member_instances", _MEMBERS)
    none = F.array().cast(_TEXTS)
    instances = F.transform(given, lambda x: _spec(x["label_asym_id"], refinement.member_symmetry(x, none)))
    plain = F.transform(chain_ids(F.from_json("member_chain_ids", _TEXTS)), lambda c: _spec(c))
    return _parts(multimers, F.when(F.size(F.coalesce(given, F.array().cast(_MEMBERS))) > 0, instances).otherwise(plain))


def antibody_parts(complexes: DataFrame) -> DataFrame:
    """C20: the chains of the antibody and of its antigens, as two sides."""
    own, other = (chain_ids(F.from_json(c, _TEXTS)) for c in ("antibody_chain_ids", "antigen_chain_ids"))
    return _parts(complexes, F.concat(F.transform(own, lambda c: _spec(c, None, 1)), F.transform(other, lambda c: _spec(c, None, 2))))


def tcr_parts(complexes: DataFrame) -> DataFrame:
    """Receptor, presenting, peptide and auxiliary chains."""
    every = chain_ids(*[F.from_json(f"{c}_chain_ids", _TEXTS) for c in ("tcr", "mhc", "peptide", "auxiliary")])
    return _parts(complexes, F.transform(every, lambda c: _spec(c)))


PARTS = {"monomers": monomer_parts, "dimers": dimer_parts, "multimers": multimer_parts, "antibody_complexes": antibody_parts, "tcr_complexes": tcr_parts}
#: How near the other side a residue has to be to stay, in Angstrom.
CUTOFFS = {"dimers": 8.0, "antibody_complexes": 20.0}


def extracted(stage: str, observations: DataFrame, atoms: DataFrame, most_atoms: int | None = None) -> DataFrame:
    """Atoms of each observation's structure, all of its chains or none.

    Chains without a given copy take the least copy that all of them have.
    Interfaces and antibody complexes keep the residues near the other side.
    A source that many observations share is read once.
    """
    wanted = PARTS[stage](observations)
    found = stored.chains(atoms, wanted)
    loose = wanted.where("sym_id is null").select("structure", "part").join(found.select("structure", "part", "chain_id", "sym_id").distinct(), ["structure", "part"])
    common = refinement.common_symmetry(loose).withColumnRenamed("sym_id", "common")
    free = wanted.select("structure", "part", F.col("sym_id").isNull().alias("free"))
    found = found.join(free, ["structure", "part"]).join(common, "structure", "left").where("not free or sym_id = common").drop("free", "common")
    if stage in CUTOFFS:
        near = refinement.interface_residues(found.withColumn("part", F.col("side")), CUTOFFS[stage])
        near = near.select("structure", F.col("part").alias("side"), "chain_id", "res_id", F.coalesce("ins_code", F.lit("")).alias("_i"))
        found = found.withColumn("_i", F.coalesce("ins_code", F.lit(""))).join(near, ["structure", "side", "chain_id", "res_id", "_i"], "left_semi").drop("_i")
    if most_atoms:
        found = found.join(stored.oversized(found, most_atoms).select("structure"), "structure", "left_anti")
    return found


def traces(found: DataFrame) -> DataFrame:
    """(observation_id, parts): the trace of each chain of the structures of a stage, which are compared by these."""
    each = refinement.traces(found, ["structure", "part"])
    parts = F.transform(F.array_sort(F.collect_list(F.struct("part", "trace"))), lambda p: p["trace"].cast("array<double>"))
    return each.groupBy(F.col("structure").alias("observation_id")).agg(parts.alias("parts"))


def monomer_traces(found: DataFrame) -> DataFrame:
    """(monomer_id, trace) of extracted monomers."""
    return traces(found).select(F.col("observation_id").alias("monomer_id"), F.flatten("parts").alias("trace"))


def files(found: DataFrame) -> DataFrame:
    """(structure, document) of the structures as PDB files."""
    return sinks.pdb_documents(sinks.pdb_atoms(found))


def set_metrics(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Contacts of two sets of chains: sums over the interfaces between them, and their least distance.

    ``parts``: structure, case, chain_id, side; ``pairs``: case, label_asym_id_1/2 and measures.
    """
    a, b = (parts.where(F.col("side") == i).select("structure", "case", F.col("chain_id").alias(f"c{i}")) for i in (1, 2))
    both = pairs.select("case", F.array_sort(F.array("label_asym_id_1", "label_asym_id_2")).alias("ends"), "num_residue_contacts", "num_atom_contacts", "buried_area", "min_distance")
    joined = a.join(b, ["structure", "case"]).withColumn("ends", F.array_sort(F.array("c1", "c2"))).join(both, ["case", "ends"])
    return joined.groupBy("structure").agg(
        F.sum("num_residue_contacts").alias("num_residue_contacts"), F.sum("num_atom_contacts").alias("num_atom_contacts"), F.round(F.sum("buried_area"), 4).alias("buried_area"), F.min("min_distance").alias("min_distance")
    )
