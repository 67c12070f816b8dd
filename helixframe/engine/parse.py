"""Structure files to case bundles: one plan for all files of a batch, with skip codes, resume and a review."""

from __future__ import annotations

import dataclasses
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.engine import documents
from helixframe.engine.settings import ParseSettings, check_resume
from helixframe.functions.scalars import entry_id
from helixframe.operators import complexes, graphs, interfaces, inventory, reports
from helixframe.operators.tables import written
from helixframe.sources import attempts, mmcif, sinks

#: Categories that the engine reads.
WANTED = inventory.CATEGORIES


def guarded(cif: dict[str, DataFrame], settings: ParseSettings) -> DataFrame:
    """(path, warning_code) of all files; null where a file goes on."""
    counts = inventory.preflight(cif)
    code = inventory.size_guard(F.col("polymer_chain_count"), F.col("max_polymer_chain_length"), settings.max_polymer_chains, settings.min_polymer_chain_length)
    out = counts.select("path", code.alias("size_code"))
    if settings.assembly_mode == "input_assembly":
        twice = inventory.duplicate_chains(cif["struct_asym"]).select("path", F.lit("duplicate_chain_ids_in_input_assembly").alias("twice_code"))
    else:
        twice = counts.select("path", F.lit(None).cast("string").alias("twice_code"))
    whole = F.lit(None).cast("string")
    if settings.assembly_mode in ("largest_assembly", "first_assembly", "all"):
        sizes = inventory.within_limit(inventory.assembly_sizes(cif), settings.max_assembly_atoms)
        dropped = sizes.groupBy("path").agg(F.max("dropped").alias("dropped"))
        out = out.join(dropped, "path", "left")
        whole = F.when(F.col("dropped"), "all_assemblies_exceed_max_atoms")
        if settings.assembly_mode == "all":
            whole = F.coalesce(whole, F.when(F.col("dropped").isNull(), "no_available_assemblies_for_all_mode"))
    return out.join(twice, "path", "left").select("path", F.coalesce("twice_code", "size_code", whole).alias("warning_code"))


def assemblies(cif: dict[str, DataFrame], settings: ParseSettings) -> DataFrame:
    """(path, assembly_id) to work on, by mode; null is the asymmetric unit."""
    kept = inventory.within_limit(inventory.assembly_sizes(cif), settings.max_assembly_atoms).where("not dropped").select("path", "assembly_id")
    if settings.assembly_mode == "all":
        return kept
    if settings.assembly_mode == "largest_assembly":
        return inventory.largest_assembly(cif).select("path", "assembly_id")
    if settings.assembly_mode == "first_assembly":
        from helixframe.functions.scalars import assembly_order

        return kept.groupBy("path").agg(F.min_by("assembly_id", assembly_order(F.col("assembly_id"))).alias("assembly_id"))
    return cif["struct_asym"].select("path", F.lit(None).cast("string").alias("assembly_id")).distinct()


def placed_atoms(found: DataFrame, chosen: DataFrame, settings: ParseSettings) -> DataFrame:
    """Atoms of each chosen assembly, or of the asymmetric unit, as instances."""
    if settings.assembly_mode in ("asymmetric_unit", "input_assembly"):
        rows = mmcif.atoms(found, settings.model, settings.drop_hydrogens_for_analysis).withColumn("sym_id", F.lit(0)).withColumn("assembly_id", F.lit(None).cast("string"))
        instance = F.col("chain_id")
    else:
        rows = mmcif.assembly_atoms(found, None, settings.model).join(chosen, ["path", "assembly_id"], "left_semi")
        instance = interfaces.instance_id(F.col("chain_id"), F.col("sym_id"))
    case = F.concat_ws("#", "path", "assembly_id")
    return rows.select(case.alias("case"), "path", "assembly_id", instance.alias("instance"), "chain_id", F.col("sym_id").cast("int"), "atom_idx", "res_id", "ins_code", "res_name", "atom_name", "element", "x", "y", "z")


def multimers(faces: DataFrame, settings: ParseSettings) -> DataFrame:
    """Communities of large interfaces as multimers, one for each set of chains."""
    area = settings.tight_multimer_min_buried_area
    edges = graphs.edge_table(faces, "case", "instance_1", "instance_2", "buried_area", area, ["buried_area", "num_atom_contacts"])
    home = graphs.communities(edges, "case", settings.tight_multimer_louvain_resolution, settings.tight_multimer_min_member_instances)
    ends = [faces.select("case", F.col(f"instance_{i}").alias("node"), F.col(f"label_asym_id_{i}").alias("chain"), F.col(f"entity_id_{i}").alias("entity"), F.col(f"chain_type_{i}").alias("type")) for i in (1, 2)]
    member = home.join(ends[0].union(ends[1]).distinct(), ["case", "node"])
    a, b = (home.select("case", F.col("node").alias(f"instance_{i}"), F.col("community").alias(f"_c{i}")) for i in (1, 2))
    inside = faces.where(F.col("buried_area") >= area).join(a, ["case", "instance_1"]).join(b, ["case", "instance_2"]).where("_c1 = _c2").groupBy("case", F.col("_c1").alias("community"))
    inside = inside.agg(F.count("*").alias("num_internal_edges"), F.round(F.avg("num_atom_contacts"), 4).alias("support_score"))
    from helixframe.functions.scalars import multimer_type

    rows = member.groupBy("case", "community").agg(
        F.array_sort(F.collect_list("node")).alias("instances"), F.array_sort(F.collect_set("chain")).alias("member_chain_ids"), F.array_sort(F.collect_set(F.struct("chain", "type", "entity"))).alias("_m"),
        F.countDistinct("entity").alias("_e"), F.count("*").alias("num_member_instances"),
    ).join(inside, ["case", "community"])
    rows = rows.withColumns({"num_members": F.size("member_chain_ids"), "multimer_type": multimer_type(F.col("num_member_instances"), F.col("_e"))})
    order = F.struct("support_score", "num_members", "num_internal_edges", F.negative(F.xxhash64("instances")).alias("tie"))
    kept = [c for c in rows.columns if c not in ("case", "member_chain_ids")]
    best = rows.groupBy("case", "member_chain_ids").agg(F.max_by(F.struct(*kept), order).alias("_b"), F.count("*").alias("num_component_copies")).select("case", "member_chain_ids", "_b.*", "num_component_copies")
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy("case").orderBy("member_chain_ids"))
    return best.withColumns({
        "multimer_id": F.format_string("multimer_%03d", number), "member_chain_types": F.transform("_m", lambda x: x["type"]), "member_entity_ids": F.transform("_m", lambda x: x["entity"]),
    }).drop("_m", "_e", "community")


TABLES = ("chains", "interfaces", "multimers", "antibody_pairs", "coverage", "antibody_complexes", "tcr_complexes", "metadata", "atoms", "cases", "results")


def run(spark: SparkSession, inputs: str, target: str, settings: ParseSettings | None = None, immune: DataFrame | None = None, resume: bool = False) -> dict[str, DataFrame]:
    """All structure files below a folder: tables of chains, interfaces, multimers and complexes, atoms, results, review.

    An attempt writes apart and counts once its commit is there (``attempts``), so
    a run may break at any place. One that resumes reads what committed attempts
    with like settings finished, leaves those files alone, and tries files with
    errors again; it gives what an unbroken run gives. A file that is damaged, or
    without chains, has a result with status ``error`` and its message.
    """
    settings = settings or ParseSettings()
    tries = attempts.Attempts(spark, target)
    seen = tries.commits()
    done = None
    if resume and seen:
        check_resume(dict(seen[-1]["settings"]), _AsIs(_shown(settings)))
        done = tries.read("results", "input_path").where("status <> 'error'").select(F.col("input_path").alias("path"))
    own = tries.begin()
    found = tries.write(own, "items", mmcif.scan(spark, inputs, but=done), "category")
    items = mmcif.whole(found)
    cif = mmcif.categories(items, WANTED)
    codes = mmcif.files(found).join(guarded(cif, settings).withColumn("_seen", F.lit(True)), "path", "left")
    codes = written(codes.withColumn("error", F.coalesce("error", F.when(F.col("_seen").isNull(), "no chains: struct_asym is missing or empty"))).drop("_seen"))
    going = codes.where("warning_code is null and error is null").select("path")
    only = lambda rows: rows.join(going, "path", "left_semi")
    chains = written(only(inventory.chain_inventory(cif, immune)))
    chosen = written(only(assemblies(cif, settings)))
    atoms = tries.write(own, "atoms", only(placed_atoms(items, chosen, settings)))
    cases = chosen.withColumn("case", F.concat_ws("#", "path", "assembly_id"))
    owners = written(only(inventory.coverage(chains, mmcif.atoms(items, settings.model, settings.drop_hydrogens_for_analysis))))
    held = chains.join(inventory.covered(owners), ["path", "label_asym_id"], "left").join(cases.select("path", "case"), "path")
    none = F.array().cast("array<string>")
    held = held.withColumns({c: F.coalesce(c, none) for c in ("covered_nonpolymer_ids", "covered_branched_ids")}).withColumn("unit_type", F.when(F.col("subtype").isin("VHH", "scFv"), F.col("subtype")))
    faces = written(_faces(atoms, held, settings))
    tight = written(multimers(faces, settings))
    pairs = written(complexes.heavy_light_pairs(held, faces))
    tables = {
        "chains": held.drop("case").distinct(), "interfaces": faces, "multimers": tight, "antibody_pairs": pairs, "coverage": owners,
        "antibody_complexes": complexes.antibody_complexes(held, faces, tight, pairs), "tcr_complexes": complexes.tcr_complexes(held, faces, tight, settings.peptide_max_length),
        "metadata": inventory.case_metadata(cif), "cases": cases,
    }
    fresh = {name: tries.write(own, name, rows) for name, rows in tables.items()}
    tries.write(own, "results", _results(cif, codes, cases, fresh))
    tries.commit(own, list(TABLES), _shown(settings), done is None, [r["attempt"] for r in seen])
    read = tables_of(spark, target)
    sinks.csv_rows(read["results"], f"{target}/metadata_csv", sinks.CASE_COLUMNS)
    export(read, target, settings)
    read["summary"] = reports.batch_summary(read["results"])
    return read


def tables_of(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The tables of a run: what its committed attempts wrote; of a file that was tried again, the last result."""
    tries = attempts.Attempts(spark, target)
    return {name: tries.read(name, "input_path" if name == "results" else None) for name in TABLES}


def export(read: dict[str, DataFrame], target: str, settings: ParseSettings) -> None:
    """The tables once more as the asked format: JSON lines and a document for each case, or CSV with nested values as JSON."""
    for name in ("chains", "interfaces", "multimers", "antibody_complexes", "tcr_complexes"):
        if settings.output_format == "csv":
            sinks.csv_rows(read[name], f"{target}/csv/{name}")
        else:
            sinks.json_lines(read[name], f"{target}/json/{name}")
    if settings.output_format != "csv":
        bundle = documents.cases(read, settings.assembly_mode).drop("document", "assembly_hint", "_corrupt_record")
        sinks.json_documents(bundle, "case_dir", f"{target}/documents")


def _faces(atoms: DataFrame, chains: DataFrame, settings: ParseSettings) -> DataFrame:
    from helixframe.functions import fixed as X

    polymer = chains.where(F.col("chain_type").isin(*X.POLYMER_TYPES))
    kinds = polymer.select("case", F.col("label_asym_id").alias("chain_id"), "chain_type")
    kept = atoms.join(kinds.drop("chain_type"), ["case", "chain_id"], "left_semi")
    pairs = written(interfaces.accepted(
        interfaces.residues(kept, kinds), kept, settings.residue_contact_cutoff, settings.atom_contact_cutoff, settings.min_residue_contacts, settings.min_atom_contacts
    ))
    measured = pairs.join(interfaces.areas(pairs, kept), ["case", "instance_1", "instance_2"])
    return interfaces.deduplicated(interfaces.interface_records(measured, polymer, settings.assembly_mode))


def _results(cif: dict[str, DataFrame], codes: DataFrame, cases: DataFrame, read: dict[str, DataFrame]) -> DataFrame:
    """A row for each file: ok, skipped or error, with counts and metadata."""
    of = cases.select("case", "path")

    def counted(name: str, column: str) -> DataFrame:
        rows = read[name] if "path" in read[name].columns else read[name].join(of, "case")
        return rows.groupBy("path").agg(F.count("*").alias(column))

    out = codes
    for name, column in (("chains", "num_chains"), ("interfaces", "num_dimers"), ("multimers", "num_multimers"), ("antibody_complexes", "num_antibody_antigen_complexes"), ("tcr_complexes", "num_tcr_pmhc_complexes")):
        out = out.join(counted(name, column), "path", "left").withColumn(column, F.coalesce(column, F.lit(0)))
    out = out.join(of.groupBy("path").agg(F.count("*").alias("num_assemblies_processed")), "path", "left").join(read["metadata"], "path", "left")
    declared = mmcif_entry(cif)
    out = out.join(declared, "path", "left")
    from helixframe.functions.scalars import case_id

    status = F.when(F.col("error").isNotNull(), "error").when(F.col("warning_code").isNull(), "ok").otherwise("skipped")
    return out.select(case_id(F.col("path")).alias("case_id"), entry_id(F.col("declared"), F.col("path")).alias("pdb_id"), F.col("path").alias("input_path"), status.alias("status"), *[c for c in out.columns if c not in ("path", "declared")])


def mmcif_entry(cif: dict[str, DataFrame]) -> DataFrame:
    return cif["entry"].groupBy("path").agg(F.min_by("id", "row_idx").alias("declared"))


def _shown(settings: ParseSettings) -> dict[str, str]:
    return {k: repr(v) for k, v in sorted(dataclasses.asdict(settings).items())}


class _AsIs:
    def __init__(self, values: dict):
        self.values = values

    def fingerprint(self) -> dict:
        return self.values


def rebuilt(spark: SparkSession, target: str) -> DataFrame:
    """The summary of a run from its results alone."""
    return reports.batch_summary(attempts.Attempts(spark, target).read("results", "input_path"))


def merged_shards(spark: SparkSession, shards: list[str], target: str) -> dict[str, DataFrame]:
    """The runs of several shards as one run under a target, with all tables, and its summary.

    Case ids that meet are numbered by shard. A file that several shards have
    counts in the first of them: its rows of the others are left out of every table.
    """
    from pyspark.sql import Window

    tries = attempts.Attempts(spark, target)
    seen, own, parts = tries.commits(), tries.begin(), [tables_of(spark, s) for s in shards]
    joined = lambda name: functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p[name].withColumn("_shard", F.lit(k)) for k, p in enumerate(parts)])
    results = joined("results")
    first = written(results.groupBy(F.col("input_path").alias("path")).agg(F.min("_shard").alias("_shard")))
    results = results.join(first.withColumnRenamed("path", "input_path"), ["input_path", "_shard"], "left_semi")
    w = Window.partitionBy("case_id")
    n = F.row_number().over(w.orderBy("_shard", "input_path"))
    case = F.when(n > 1, F.concat("case_id", F.lit("_shard"), F.format_string("%02d", F.col("_shard")), F.when(n > 2, F.concat(F.lit("_"), n.cast("string"))).otherwise(""))).otherwise(F.col("case_id"))
    columns = [c for c in parts[0]["results"].columns]
    tries.write(own, "results", results.withColumn("case_id", case).select(*columns))
    for name in TABLES:
        if name == "results":
            continue
        rows = joined(name)
        if "path" not in rows.columns:
            rows = rows.withColumn("path", F.regexp_replace("case", "#[^#]*$", ""))
            rows = rows.join(first, ["path", "_shard"], "left_semi").drop("path", "_shard")
        else:
            rows = rows.join(first, ["path", "_shard"], "left_semi").drop("_shard")
        tries.write(own, name, rows)
    tries.commit(own, list(TABLES), dict(attempts.Attempts(spark, shards[0]).commits()[-1]["settings"]), True, [r["attempt"] for r in seen])
    read = tables_of(spark, target)
    return read | {"summary": reports.batch_summary(read["results"])}
