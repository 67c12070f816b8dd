"""Prep tables to clusters: monomer inventory, sequence clusters, structure clusters, and the four high-order stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.engine import structures as shapes
from helixframe.engine.settings import ClusterSettings, check_cutoff
from helixframe.functions.scalars import component_key, date_decision, moved_path
from helixframe.operators import clustering, identity, refinement, relational
from helixframe.operators.tables import dealt, written
from helixframe.sources import bundles, sinks

# Cluster prefixes by polymer class.
CLASS_PREFIXES = {"dna": "dna_", "rna": "rna_", "other_nucleic_acid": "na_"}
_DETAILS = "array<struct<label_seq_id:int, monomer_id:string, chem_comp_type:string>>"


def release_decisions(quality: DataFrame, cutoff: str) -> DataFrame:
    """one decision a source: kept, missing, invalid or too_recent."""
    first = bundles.first_quality(quality)
    return first.select("source_path", date_decision(F.col("release_date"), F.lit(cutoff or None).cast("date")).alias("decision"))


def inventory(monomers: DataFrame, quality: DataFrame, settings: ClusterSettings, folder: str | None = None) -> DataFrame:
    """Canonical monomers of the sources that the cutoff keeps; of one id the least source's."""
    rows = monomers.withColumn("source_path", moved_path(F.col("source_path"), folder))
    if settings.cutoff_date:
        kept = release_decisions(quality, settings.cutoff_date).where("decision = 'kept'").withColumn("source_path", moved_path(F.col("source_path"), folder))
        rows = rows.join(kept, "source_path", "left_semi")
    others = [c for c in rows.columns if c != "monomer_id"]
    return rows.groupBy("monomer_id").agg(F.min_by(F.struct(*others), F.struct("source_path", "source_case_dir")).alias("_m")).select("monomer_id", "_m.*")


def high_order_references(prep: dict[str, DataFrame]) -> DataFrame:
    """(pdb_id, assembly_id, chain) that interfaces, multimers or complexes name."""
    text = "array<string>"
    listed = {
        "multimers": ("member_chain_ids",), "antibody_complexes": ("antibody_chain_ids", "antigen_chain_ids"),
        "tcr_complexes": ("tcr_chain_ids", "mhc_chain_ids", "peptide_chain_ids", "auxiliary_chain_ids"),
    }
    d = prep["dimers"]
    out = d.select("pdb_id", "assembly_id", F.explode(F.array("label_asym_id_1", "label_asym_id_2")).alias("chain"))
    for name, columns in listed.items():
        chains = F.concat(*[F.coalesce(F.from_json(c, text), F.array().cast(text)) for c in columns])
        out = out.union(prep[name].select("pdb_id", "assembly_id", F.explode(chains).alias("chain")))
    # Each row names two chains or a few; they are dealt before any task gathers distinct ones.
    size = 2 * sum(prep[name].count() for name in ("dimers", *listed))
    return dealt(out.where("chain <> ''"), size, "pdb_id", "assembly_id", "chain").distinct()


def backfilled(own: DataFrame, references: DataFrame) -> DataFrame:
    """The inventory, and for references that it lacks the row of the same entry's chain in another assembly (the least id)."""
    from helixframe.functions.scalars import monomer_id

    asked = written(references.withColumn("monomer_id", monomer_id(F.col("pdb_id"), F.col("assembly_id"), F.col("chain"))))
    size = asked.count() + own.count()
    asked = dealt(asked, size, "monomer_id").join(dealt(own.select("monomer_id"), size, "monomer_id"), "monomer_id", "left_anti")
    others = [c for c in own.columns if c not in ("monomer_id", "assembly_id", "pdb_id", "label_asym_id")]
    by_chain = dealt(own.withColumnRenamed("label_asym_id", "chain"), size, "pdb_id", "chain").groupBy("pdb_id", "chain").agg(F.min_by(F.struct(*others), "monomer_id").alias("_m"))
    more = dealt(asked, size, "pdb_id", "chain").join(by_chain, ["pdb_id", "chain"]).select("monomer_id", "pdb_id", "assembly_id", F.col("chain").alias("label_asym_id"), "_m.*")
    return own.unionByName(more)


def sequence_clusters(monomers: DataFrame, settings: ClusterSettings) -> DataFrame:
    """Membership of all polymer classes: proteins by mode, nucleic acids by equal sequences, others by components."""
    protein = monomers.where("polymer_class = 'protein'")
    shape = lambda rows, kind, method: rows.select(
        F.lit("sequence").alias("cluster_stage"), F.lit(method).alias("cluster_method"), F.lit(kind).alias("polymer_class"), "cluster_id", F.col("representative").alias("representative_monomer_id"), F.col("monomer_id").alias("member_monomer_id")
    )
    if settings.protein_sequence_mode == "skip":
        alone = clustering.numbered_groups(protein.select("monomer_id"), "monomer_id", [F.col("monomer_id").asc()], "prot_")
        out = shape(alone.withColumn("representative", F.col("monomer_id")), "protein", "singleton")
    elif settings.protein_sequence_mode == "exact":
        out = shape(clustering.exact_clusters(protein, "monomer_id", F.col("sequence"), "prot_"), "protein", "exact_sequence")
    else:
        near = written(identity.identity_clusters(protein, "monomer_id", "sequence", settings.protein_min_seq_id, settings.protein_coverage))
        rest = clustering.missing_clusters(protein, "monomer_id", F.col("sequence"), near, "prot_")
        out = shape(near, "protein", "identity").unionByName(shape(rest, "protein", "exact_sequence_fallback"))
    for kind, prefix in CLASS_PREFIXES.items():
        rows = monomers.where(F.col("polymer_class") == kind)
        out = out.unionByName(shape(clustering.exact_clusters(rows, "monomer_id", F.col("sequence"), prefix), kind, "exact_sequence"))
    key = component_key(F.from_json("special_residue_details", _DETAILS), F.col("polymer_type"), F.col("entity_description"), F.col("sequence"))
    rows = monomers.where("polymer_class = 'other_polymer'")
    return out.unionByName(shape(clustering.exact_clusters(rows, "monomer_id", key, "op_"), "other_polymer", "exact_component_sequence"))


#: Fixed value: multimers of more atoms are not compared.
MOST_ATOMS = 10_000
STAGES = {
    "dimers": lambda rows, known, own: refinement.dimer_observations(rows, known), "multimers": lambda rows, known, own: refinement.multimer_observations(rows, known),
    "antibody_complexes": refinement.antibody_observations, "tcr_complexes": refinement.tcr_observations,
}


def high_order(stage: str, rows: DataFrame, known: DataFrame, own: DataFrame, structures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations of a stage in scope, their signatures, structure clusters, and warnings."""
    observed = written(STAGES[stage](refinement.in_scope(rows, own), known, own))
    return refinement.refined(observed, structures, stage)


def from_pairs(pairs: DataFrame, own: DataFrame, prefix: str = "prot_") -> DataFrame:
    """Clusters that another program told as (representative, member) pairs; a member that the inventory lacks fails the job.

    Clusters are numbered in order of representatives.
    """
    known = own.select("monomer_id")
    rows = relational.looked_up(pairs.withColumnRenamed("member", "monomer_id"), known, ["monomer_id"], "monomer")
    sizes = rows.groupBy("representative").agg(F.count("*").alias("size"))
    return rows.join(clustering.numbered_groups(sizes, "representative", [F.col("representative").asc()], prefix), "representative").select("monomer_id", "cluster_id", "representative", "size")


def buckets(membership: DataFrame) -> DataFrame:
    """(sequence_cluster_id, monomer_ids) of the protein clusters."""
    rows = membership.where("polymer_class = 'protein' and cluster_id <> '' and member_monomer_id <> ''")
    return rows.groupBy(F.col("cluster_id").alias("sequence_cluster_id")).agg(F.array_sort(F.collect_set("member_monomer_id")).alias("monomer_ids"))


def dataset(spark: SparkSession, target: str, settings: ClusterSettings, structures: bool = False) -> dict[str, DataFrame]:
    """The tables of an earlier sequence stage, if it was made with this cutoff; with structures, if there are any."""
    made = {r["name"]: r["value"] for r in spark.read.json(f"{target}/settings").collect()}
    check_cutoff(settings, made.get("cutoff_date", ""))
    out = {"monomer_inventory": spark.read.json(f"{target}/monomer_inventory"), "sequence_clusters": spark.read.option("header", "true").csv(f"{target}/sequence_clusters")}
    if structures:
        if made.get("protein_structure_mode") != "greedy" or made.get("structure_clusters") != "true":
            raise ValueError("the run has no structure clusters")
        out["structure_clusters"] = spark.read.option("header", "true").csv(f"{target}/structure_clusters")
    return out


def run(
    spark: SparkSession, prep_dir: str, target: str, settings: ClusterSettings | None = None, traces: DataFrame | None = None, structures: dict[str, DataFrame] | None = None, folder: str | None = None, atoms: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All stages over prep tables. ``traces`` has monomer_id and trace; ``structures`` a table (observation_id, parts) a stage.

    With stored ``atoms`` (``documents.atoms``) both are taken from these. A run in
    mode ``greedy`` has to have either.
    """
    settings = settings or ClusterSettings()
    if settings.protein_structure_mode == "greedy" and traces is None and atoms is None:
        raise ValueError("structure clusters need stored atoms or traces; or set protein_structure_mode to skip")
    prep = {name: bundles.prep_table(spark, prep_dir, name) for name in bundles.TABLES}
    own = written(backfilled(inventory(prep["monomers"], prep["entry_quality"], settings, folder), high_order_references(prep)))
    own.write.mode("overwrite").json(f"{target}/monomer_inventory")
    sinks.fasta(own, f"{target}/fasta")
    sequence = sequence_clusters(own, settings)
    sinks.csv_rows(sequence, f"{target}/sequence_clusters")
    out = {"monomer_inventory": own, "sequence_clusters": spark.read.option("header", "true").csv(f"{target}/sequence_clusters")}
    structure = None
    if traces is None and atoms is not None:
        traces = shapes.monomer_traces(shapes.extracted("monomers", own, atoms))
    if settings.protein_structure_mode == "greedy" and traces is not None:
        quality = bundles.first_quality(prep["entry_quality"]).select("source_path", "method_priority", "resolution")
        resolved = refinement.resolved_residues(F.from_json("parsed_coordinate_segments", "array<struct<label_seq_start:int,label_seq_end:int>>"))
        share = F.when(F.col("length") > 0, resolved / F.col("length")).otherwise(0.0)
        members = out["sequence_clusters"].where("polymer_class = 'protein'").select(F.col("cluster_id").alias("sequence_cluster_id"), F.col("member_monomer_id").alias("monomer_id"))
        members = members.join(own.select("monomer_id", "sequence", "source_path", share.alias("resolved_fraction")), "monomer_id").join(quality, "source_path", "left").join(traces, "monomer_id", "left")
        structure = refinement.structure_clusters(members)
        sinks.csv_rows(structure, f"{target}/structure_clusters")
        out["structure_clusters"] = structure = spark.read.option("header", "true").csv(f"{target}/structure_clusters")
    made = [(k, str(v)) for k, v in sorted(settings.fingerprint().items())] + [("structure_clusters", str(structure is not None).lower())]
    spark.createDataFrame(made, "name string, value string").coalesce(1).write.mode("overwrite").json(f"{target}/settings")
    known = written(refinement.assignments(out["sequence_clusters"], structure))
    empty = spark.createDataFrame([], "observation_id string, parts array<array<double>>")
    for stage in STAGES:
        given = (structures or {}).get(stage, empty)
        if structures is None and atoms is not None:
            scoped = refinement.in_scope(prep[stage], own)
            given = written(shapes.traces(shapes.extracted(stage, scoped, atoms, MOST_ATOMS if stage == "multimers" else None)))
        found, warned = high_order(stage, prep[stage], known, own, given)
        sinks.parquet(found, f"{target}/{stage}")
        sinks.parquet(warned, f"{target}/{stage}_warnings")
        out[stage], out[f"{stage}_warnings"] = (spark.read.parquet(f"{target}/{name}") for name in (stage, f"{stage}_warnings"))
    return out
