"""Refined antibody complexes: variable domains of antibody chains, and the antigen domains that they touch.

Residues are rows (complex, chain, role, res_id, ins_code, atom_idx, x, y, z of
the trace atom). Contacts and the antigen's own graph come from grid joins;
domains are communities of one chain's residue graph, which is bounded by the
chain.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.operators import geometry, relational
from helixframe.operators.graphs import communities_of

CONTACT, LEAST_SIZE, LEAST_CONTACTS = 8.0, 10, 3
FALLBACK_RESIDUES = 120


def kept_domains(domains: Column, units: Column, unit_type: Column, chain_type: Column) -> Column:
    """The domains of a chain that stand for its unit: those of the unit of the complex's type, then of the chain's
    single type, then of the first unit; without units by code. Domains are structs of number and code."""
    name = lambda d: F.concat(F.format_string("vd_%02d_", d["number"] + 1), d["code"])
    single = F.when(chain_type == "antibody heavy chain", "single_heavy_variable_domain").when(chain_type == "antibody light chain", "single_light_variable_domain")
    of = lambda kind: F.filter(units, lambda u: u["unit_type"] == kind)
    chosen = F.coalesce(F.try_element_at(of(unit_type), F.lit(1)), F.try_element_at(of(single), F.lit(1)), F.try_element_at(units, F.lit(1)))
    matched = F.filter(domains, lambda d: F.coalesce(F.array_contains(chosen["domain_ids"], name(d)), F.lit(False)))
    coded = lambda codes: F.filter(domains, lambda d: d["code"].isin(*codes))
    one = lambda found: F.when(F.size(found) > 0, F.slice(found, 1, 1)).otherwise(F.slice(domains, 1, 1))
    by_code = (
        F.when(unit_type == "scFv", coded("HKL")).when((unit_type == "VHH") & (F.size(coded("H")) > 0), coded("H"))
        .when((unit_type == "VHH") | (chain_type == "antibody heavy chain"), one(coded("H"))).when(chain_type == "antibody light chain", one(coded("KL")))
        .otherwise(F.slice(domains, 1, 1))
    )
    return F.when(F.size(matched) > 0, matched).otherwise(by_code)


def boundary_warnings(domains: Column) -> Column:
    """Warnings about the ends of kept domains; an end that a motif moved is to be reviewed."""
    said = F.flatten(F.transform(domains, lambda d: F.filter(d["warnings"], lambda w: w.contains("fr4"))))
    moved = F.when(F.exists(domains, lambda d: d["end_motif"] != ""), F.array(F.lit("fv_boundary_repaired_by_motif_requires_review"))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(said, moved)))


def antibody_residues(residues: DataFrame, kept: DataFrame) -> DataFrame:
    """Residues of the kept domains of each antibody chain; of chains without any, the first 120;
    of chains whose domains hold no residue, all.

    ``kept`` has complex, chain and domains (structs with fv_start and fv_end).
    """
    rows = residues.where("role = 'antibody'").join(kept, ["complex", "chain"], "left")
    none = F.size(F.coalesce("domains", F.array().cast("array<struct<fv_start:int>>" if "domains" not in kept.columns else dict(kept.dtypes)["domains"]))) == 0
    inside = F.coalesce(F.exists("domains", lambda d: (F.col("res_id") >= d["fv_start"]) & (F.col("res_id") <= d["fv_end"])), F.lit(False))
    from pyspark.sql import Window

    w = Window.partitionBy("complex", "chain")
    placed = rows.withColumns({"_in": inside, "_none": none, "_r": F.dense_rank().over(w.orderBy("res_id"))})
    placed = placed.withColumn("_any", F.max(F.col("_in").cast("int")).over(w) == 1)
    keep = F.when(F.col("_none"), F.col("_r") <= FALLBACK_RESIDUES).when(F.col("_any"), F.col("_in")).otherwise(F.lit(True))
    return placed.where(keep).select(*residues.columns)


def _points(rows: DataFrame) -> DataFrame:
    return rows.select("complex", F.concat_ws("|", "chain", F.col("res_id").cast("string")).alias("id"), F.col("chain").alias("owner"), "x", "y", "z")


def contacts(antibody: DataFrame, antigen: DataFrame, cutoff: float = CONTACT) -> DataFrame:
    """Pairs of antibody and antigen residues within the cutoff."""
    found = geometry.contacts(_points(antibody), _points(antigen), "complex", cutoff)
    return found.select("complex", F.col("id").alias("antibody_residue"), F.col("owner_2").alias("chain"), F.col("id_2").alias("antigen_residue"), "distance")


def residue_graph(antigen: DataFrame, cutoff: float = CONTACT) -> DataFrame:
    """Pairs of residues of one antigen chain within the cutoff, each once."""
    points = _points(antigen)
    found = geometry.contacts(points, points, "complex", cutoff).where("owner = owner_2 and id < id_2")
    return found.select("complex", F.col("owner").alias("chain"), F.col("id").alias("u"), F.col("id_2").alias("v"))


def antigen_domains(antigen: DataFrame, touched: DataFrame, cutoff: float = CONTACT, resolution: float = 1.0, least_size: int = LEAST_SIZE, least_contacts: int = LEAST_CONTACTS) -> DataFrame:
    """(complex, chain, residue, domain, size, touching, kept): communities of each antigen chain's residue graph;
    those of enough residues, enough of which touch the antibody, are kept. A residue near none is a domain of its own."""
    edges = residue_graph(antigen, cutoff)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        home = communities_of({(u, v): 1.0 for u, v in zip(pdf["u"], pdf["v"], strict=True)}, resolution)
        return pd.DataFrame({"complex": pdf["complex"].iloc[0], "chain": pdf["chain"].iloc[0], "residue": list(home), "domain": list(home.values())})

    kind = dict(antigen.dtypes)["complex"]
    home = edges.groupBy("complex", "chain").applyInPandas(one, f"complex {kind}, chain string, residue string, domain string")
    every = _points(antigen).select("complex", F.col("owner").alias("chain"), F.col("id").alias("residue")).distinct()
    near = touched.select("complex", "chain", F.col("antigen_residue").alias("residue")).distinct().withColumn("_t", F.lit(1))
    rows = every.join(home, ["complex", "chain", "residue"], "left").withColumn("domain", F.coalesce("domain", "residue")).join(near, ["complex", "chain", "residue"], "left")
    sizes = rows.groupBy("complex", "chain", "domain").agg(F.count("*").alias("size"), F.count("_t").alias("touching"))
    return rows.drop("_t").join(sizes, ["complex", "chain", "domain"]).withColumn("kept", (F.col("size") >= least_size) & (F.col("touching") >= least_contacts))


def refined_chains(residues: DataFrame, kept: DataFrame, **limits) -> DataFrame:
    """(complex, chain, role, intervals, warnings): the residues of each chain that stay, as intervals.

    An antigen chain without a kept domain stays whole, with a warning.
    """
    own = antibody_residues(residues, kept)
    antigen = residues.where("role = 'antigen'")
    touched = contacts(own, antigen)
    found = antigen_domains(antigen, touched, **limits)
    state = found.groupBy("complex", "chain").agg(F.max("kept").alias("_some"), F.sum(F.when(F.col("touching") > 0, 1).otherwise(0)).alias("_near"))
    named = antigen.withColumn("residue", F.concat_ws("|", "chain", F.col("res_id").cast("string")))
    placed = named.join(found.select("complex", "chain", "residue", "kept"), ["complex", "chain", "residue"], "left").join(state, ["complex", "chain"], "left")
    stays = placed.where(F.col("kept") | ~F.coalesce("_some", F.lit(False))).select("complex", "chain", "role", F.col("res_id").cast("long").alias("res_id"))
    rows = stays.unionByName(own.select("complex", "chain", "role", F.col("res_id").cast("long").alias("res_id")))
    runs = relational.segments(rows, ["complex", "chain", "role"], "res_id")
    spans = runs.groupBy("complex", "chain", "role").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("intervals"))
    warned = F.when(F.col("_some"), None).when(F.coalesce("_near", F.lit(0)) == 0, "no antibody-antigen residue contacts; kept full antigen").otherwise("no contacting antigen domain passed filters; kept full antigen")
    return spans.join(state.select("complex", "chain", warned.alias("warning"), F.lit("antigen").alias("role")), ["complex", "chain", "role"], "left")
