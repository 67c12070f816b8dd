"""Case documents (JSON, plain or gzip) as tables: entry quality, monomers, interfaces, multimers, complexes.

Four layouts are read: one bundle a case, a bundle for each assembly, folders
of assemblies, and one file for each artifact. One scan of whole files feeds
all tables; a document that does not parse is listed and does not stop the
others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions.scalars import assembly_order, base_name, has_identity, is_polymer, method_priority, monomer_id, number_or_null, polymer_class, sequence_key

_TEXTS = "array<string>"
_SEGMENTS = "array<struct<label_seq_start:int, label_seq_end:int, auth_seq_start:string, auth_seq_end:string, length:int>>"
_CHAIN = (
    "struct<pdb_id:string, label_asym_id:string, auth_asym_id:string, entity_id:string, entity_type:string, entity_description:string, polymer_type:string,"
    " chain_type:string, subtype:string, sequence:string, length:int, residue_count:int, atom_count:int, paired_label_asym_id:string, annotation_confidence:double,"
    f" parsed_coordinate_segments:{_SEGMENTS}, unresolved_sequence_segments:{_SEGMENTS},"
    " special_residue_details:array<struct<label_seq_id:int, auth_seq_id:string, monomer_id:string, chem_comp_type:string, chem_comp_name:string, resolved:boolean>>,"
    " special_component_details:array<struct<component_id:string, chem_comp_type:string, chem_comp_name:string, formula:string>>,"
    f" features:struct<antibody_unit_type:string, antibody_analysis:struct<unit_type:string, heavy_only_evidence:struct<is_true_heavy_only:boolean>>>, warnings:{_TEXTS}>"
)
_INTERFACE = (
    "struct<assembly_mode:string, assembly_id:string, label_asym_id_1:string, auth_asym_id_1:string, entity_id_1:string, chain_type_1:string, sym_id_1:int,"
    " label_asym_id_2:string, auth_asym_id_2:string, entity_id_2:string, chain_type_2:string, sym_id_2:int, interface_label:string, is_same_entity:boolean,"
    " contains_antibody_unit:boolean, contains_tcr_pmhc_unit:boolean, buried_area:double, num_residue_contacts:int, num_atom_contacts:int, min_distance:double,"
    f" num_supporting_instance_pairs:int, warnings:{_TEXTS}>"
)
_MEMBER = "struct<instance_id:string, label_asym_id:string, auth_asym_id:string, entity_id:string, chain_type:string, assembly_id:string, operation_id:string, copy_ordinal:int, sym_id:int>"
_MULTIMER = (
    "struct<assembly_mode:string, assembly_id:string, multimer_id:string, num_component_copies:int, num_members:int, num_member_instances:int, num_internal_edges:int,"
    " multimer_type:string, support_score:double, contains_antibody_unit:boolean, contains_tcr_pmhc_unit:boolean,"
    f" member_chain_ids:{_TEXTS}, member_auth_asym_ids:{_TEXTS}, member_entity_ids:{_TEXTS}, member_chain_types:{_TEXTS}, member_copy_numbers:array<int>,"
    f" member_instances:array<{_MEMBER}>, warnings:{_TEXTS}>"
)
_ANTIBODY_LISTS = (
    "antibody_chain_ids", "antibody_auth_asym_ids", "antigen_chain_ids", "antigen_auth_asym_ids", "antigen_chain_types",
    "auxiliary_component_ids", "auxiliary_component_auth_asym_ids", "auxiliary_branched_ids", "auxiliary_branched_auth_asym_ids",
)
_ANTIBODY = (
    "struct<assembly_mode:string, assembly_id:string, complex_id:string, antibody_unit_type:string, antibody_heavy_chain:string, antibody_heavy_auth_asym_id:string,"
    " antibody_light_chain:string, antibody_light_auth_asym_id:string, " + ", ".join(f"{c}:{_TEXTS}" for c in _ANTIBODY_LISTS)
    + f", num_antigen_chains:int, num_antibody_antigen_interfaces:int, contact_score:double, warnings:{_TEXTS}>"
)
_TCR_LISTS = (
    "tcr_chain_ids", "tcr_auth_asym_ids", "tcr_entity_ids", "mhc_chain_ids", "mhc_auth_asym_ids", "mhc_entity_ids", "mhc_chain_roles",
    "peptide_chain_ids", "peptide_auth_asym_ids", "peptide_entity_ids", "auxiliary_chain_ids", "auxiliary_auth_asym_ids", "auxiliary_entity_ids",
)
_TCR = (
    "struct<assembly_mode:string, assembly_id:string, complex_id:string, tcr_type:string, mhc_class:string, " + ", ".join(f"{c}:{_TEXTS}" for c in _TCR_LISTS)
    + f", num_tcr_chains:int, num_peptide_chains:int, num_tcr_pmhc_interfaces:int, contact_score:double, warnings:{_TEXTS}>"
)
_SUMMARY = (
    f"struct<pdb_id:string, source_path:string, assembly_mode:string, assembly_id:string, assembly_ids:{_TEXTS}, title:string, warnings:{_TEXTS},"
    " entry_metadata:struct<experimental_method:string, resolution:string, release_date:string, metadata_source:string, metadata_warning:string>>"
)
#: Artifacts of a case with their types; in one bundle, or a file each.
ARTIFACTS = {
    "structure_summary": _SUMMARY, "chain_inventory": f"array<{_CHAIN}>", "dimer_interfaces": f"array<{_INTERFACE}>", "tight_multimers": f"array<{_MULTIMER}>",
    "antibody_antigen_complexes": f"array<{_ANTIBODY}>", "tcr_pmhc_complexes": f"array<{_TCR}>",
}
SCHEMA = ", ".join(f"{k} {v}" for k, v in ARTIFACTS.items()) + ", _corrupt_record string"


def _stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.json(\.gz)?$", "")


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def files(spark: SparkSession, path: str, pattern: str = "*.json*") -> DataFrame:
    """The JSON files of cases under a path, with the unit (folder) and case that each belongs to.

    ``layout``: 0 one bundle, 1 a bundle of one assembly, 3 one artifact; ``nested``
    units are folders of one assembly of their case.
    """
    rows = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("document"), "value")
    stem, folder = _stem(base_name(F.col("document"))), _parent(F.col("document"))
    layout = F.when(stem == "result", 0).when(stem.startswith("result_assembly_"), 1).when(stem.isin(*ARTIFACTS), 3)
    unit = F.when((layout == 3) & (base_name(folder) == "final"), _parent(folder)).otherwise(folder)
    rows = rows.withColumns({"layout": layout, "artifact": stem, "unit": unit}).where("layout is not null")
    nested = base_name(F.col("unit")).startswith("assembly_")
    case = F.when(nested, _parent(F.col("unit"))).otherwise(F.col("unit"))
    named = F.when(F.col("layout") == 1, F.regexp_replace("artifact", "^result_assembly_", "")).when(nested, F.regexp_replace(base_name(F.col("unit")), "^assembly_", ""))
    return rows.withColumns({"nested": nested, "case_dir": case, "assembly_hint": F.nullif(named, F.lit(""))})


def case_dirs(found: DataFrame) -> DataFrame:
    """Case folders; those inside another case are not cases of their own."""
    cases = found.select("case_dir").distinct()
    parts = F.split("case_dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    inside = cases.select("case_dir", F.explode(F.when(F.size(parts) > 1, above).otherwise(F.array().cast(_TEXTS))).alias("up"))
    return cases.join(inside.join(cases.select(F.col("case_dir").alias("up")), "up"), "case_dir", "left_anti")


def scan(spark: SparkSession, path: str, pattern: str = "*.json*") -> DataFrame:
    """One row for each bundle, of the first layout that its case has, with the assembly that it is of."""
    found = files(spark, path, pattern)
    found = found.join(case_dirs(found), "case_dir", "left_semi")
    # The bundle of a case comes before those of its assemblies, then folders of assemblies, then single artifacts.
    rank = F.when(F.col("nested"), 2).otherwise(F.col("layout"))
    found = found.withColumn("_r", rank).withColumn("_first", F.min("_r").over(Window.partitionBy("case_dir"))).where("_r = _first")
    found = found.withColumn("_own", F.min("layout").over(Window.partitionBy("unit"))).where("layout = _own")
    whole = found.where("layout < 3").withColumn("_j", F.from_json("value", SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    whole = whole.select("case_dir", "document", "assembly_hint", *[F.col(f"_j.{k}").alias(k) for k in ARTIFACTS], F.when(F.col("_j.structure_summary").isNull(), F.coalesce("_j._corrupt_record", "value")).alias("_corrupt_record"))
    split = found.where("layout = 3").groupBy("case_dir", "unit", "assembly_hint").agg(
        F.min("document").alias("document"), *[F.max(F.when(F.col("artifact") == k, F.col("value"))).alias(k) for k in ARTIFACTS]
    )
    split = split.select("case_dir", "document", "assembly_hint", *[F.from_json(k, v).alias(k) for k, v in ARTIFACTS.items()], F.when(F.col("structure_summary").isNull(), F.lit("no structure_summary")).alias("_corrupt_record"))
    return whole.unionByName(split).withColumn("assembly", bundle_assembly())


def single(cases: DataFrame) -> DataFrame:
    """The cases, each of which has to have exactly one bundle."""
    n = F.count("*").over(Window.partitionBy("case_dir"))
    fails = F.raise_error(F.concat(F.lit("more than one bundle under "), F.col("case_dir"))).cast("boolean")
    return cases.withColumn("_n", n).where(F.when(F.col("_n") == 1, True).otherwise(fails)).drop("_n")


def artifact(cases: DataFrame, name: str) -> DataFrame:
    """One named artifact of each case; a case without it fails the job."""
    missing = F.raise_error(F.concat(F.lit(f"no {name} under "), F.col("case_dir"))).cast("boolean")
    return cases.where(F.when(F.col(name).isNotNull(), True).otherwise(missing)).select("case_dir", name)


def bundle_assembly() -> Column:
    """The summary's assembly, else the place's, else the only one that any record is of, else the only one listed, else empty."""
    of = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: x["assembly_id"])
    seen = F.concat(*[of(F.col(k)) for k in ("dimer_interfaces", "tight_multimers", "antibody_antigen_complexes", "tcr_pmhc_complexes")])
    seen = F.array_distinct(F.filter(seen, lambda x: x.isNotNull() & (x != "")))
    listed = F.filter(F.coalesce("structure_summary.assembly_ids", F.array().cast(_TEXTS)), lambda x: x != "")
    return F.coalesce(
        F.nullif("structure_summary.assembly_id", F.lit("")), "assembly_hint", F.when(F.size(seen) == 1, seen[0]), F.when(F.size(listed) == 1, listed[0]), F.lit("")
    )


def corrupt(cases: DataFrame) -> DataFrame:
    """Documents that do not parse, or have no summary."""
    return cases.where("structure_summary is null").select("document", "_corrupt_record")


def _identity() -> list[Column]:
    text = lambda c: F.coalesce(c, F.lit(""))
    return [text("structure_summary.pdb_id").alias("pdb_id"), text("structure_summary.source_path").alias("source_path"), base_name(F.col("case_dir")).alias("source_case_dir")]


def _rows(cases: DataFrame, field: str, ordinal: str) -> DataFrame:
    base = cases.where("structure_summary is not null").select(*_identity(), "assembly", F.col("structure_summary.assembly_mode").alias("_mode"), F.posexplode(field).alias("_pos", "_row"))
    return base.where("_row is not null").withColumn(ordinal, F.col("_pos") + 1)


def entry_quality(cases: DataFrame) -> DataFrame:
    """Method, resolution and release date; ``first_quality`` has one row for each source."""
    meta = F.col("structure_summary.entry_metadata")
    text = lambda c: F.coalesce(c, F.lit(""))
    method = F.nullif(F.trim(text(meta["experimental_method"])), F.lit(""))
    return cases.where("structure_summary is not null").select(
        *_identity(), F.to_json(F.filter(F.array(method), lambda x: x.isNotNull())).alias("experimental_methods"), method.alias("primary_method"),
        method_priority(method).alias("method_priority"), number_or_null(meta["resolution"]).alias("resolution"), text(meta["release_date"]).alias("release_date"),
        text(meta["metadata_source"]).alias("metadata_source"), text(meta["metadata_warning"]).alias("metadata_warning"), "document",
    )


def first_quality(quality: DataFrame) -> DataFrame:
    """Of the rows of one source the first."""
    kept = [c for c in quality.columns if c not in ("source_path", "document")]
    return quality.groupBy("source_path").agg(F.min_by(F.struct(*kept), "document").alias("_q")).select("source_path", "_q.*")


def monomers(cases: DataFrame) -> DataFrame:
    """Polymer chains with a sequence, or named components; nested values as JSON."""
    rows = _rows(cases, "chain_inventory", "chain_index").where(is_polymer(F.col("_row.chain_type")))
    kind, sequence = polymer_class(F.col("_row.chain_type"), F.col("_row.polymer_type")), sequence_key(F.coalesce("_row.sequence", F.lit("")))
    rows = rows.withColumns({"polymer_class": kind, "sequence": sequence, "pdb_id": F.coalesce(F.nullif("_row.pdb_id", F.lit("")), "pdb_id")})
    rows = rows.where(F.col("polymer_class").isNotNull() & has_identity(F.col("polymer_class"), F.col("sequence"), F.col("_row.special_residue_details")))
    rows = rows.where("pdb_id <> '' and coalesce(_row.label_asym_id, '') <> ''")
    own = F.length("sequence")
    counted = lambda *c: F.coalesce(*[F.nullif(F.col(f"_row.{x}"), F.lit(0)) for x in c], own)
    lists = ("parsed_coordinate_segments", "unresolved_sequence_segments", "special_residue_details", "special_component_details")
    return rows.select(
        "pdb_id", "source_path", "source_case_dir", F.col("assembly").alias("assembly_id"), *[F.col(f"_row.{c}") for c in ("label_asym_id", "auth_asym_id", "entity_id", "entity_type", "entity_description", "polymer_type")],
        "polymer_class", "_row.chain_type", "_row.subtype", "sequence", counted("length").alias("length"), counted("residue_count", "length").alias("residue_count"),
        F.coalesce("_row.atom_count", F.lit(0)).alias("atom_count"), *[_json(F.col(f"_row.{c}")).alias(c) for c in lists],
        monomer_id(F.col("pdb_id"), F.col("assembly"), F.col("_row.label_asym_id")).alias("monomer_id"),
    )


def _json(c: Column) -> Column:
    return F.coalesce(F.to_json(c), F.lit("[]"))


def _observations(rows: DataFrame, ordinal: str, name: str, plain: list[str], lists: tuple[str, ...] = ()) -> DataFrame:
    """Each with its id: entry, assembly (or 'na') and place in the bundle."""
    own = F.coalesce(F.nullif("_row.assembly_id", F.lit("")), F.nullif("assembly", F.lit("")))
    mode = F.coalesce(F.nullif("_row.assembly_mode", F.lit("")), "_mode", F.lit(""))
    return rows.select(
        "pdb_id", "source_path", "source_case_dir", F.coalesce(own, F.lit("")).alias("assembly_id"), mode.alias("assembly_mode"), ordinal,
        *[F.col(f"_row.{c}") for c in plain], *[_json(F.col(f"_row.{c}")).alias(c) for c in lists],
        F.concat_ws(":", "pdb_id", F.coalesce(own, F.lit("na")), F.col(ordinal).cast("string")).alias("observation_id"),
    )


def interfaces(cases: DataFrame) -> DataFrame:
    sides = [f"{c}_{i}" for i in (1, 2) for c in ("label_asym_id", "auth_asym_id", "chain_type", "sym_id")]
    kept = [*sides, "interface_label", "is_same_entity", "contains_antibody_unit", "contains_tcr_pmhc_unit", "buried_area", "num_residue_contacts", "num_atom_contacts"]
    return _observations(_rows(cases, "dimer_interfaces", "dimer_index"), "dimer_index", "dimer", kept)


def multimers(cases: DataFrame) -> DataFrame:
    kept = ["multimer_id", "num_component_copies", "num_members", "num_member_instances", "num_internal_edges", "multimer_type", "support_score", "contains_antibody_unit", "contains_tcr_pmhc_unit"]
    lists = ("member_chain_ids", "member_auth_asym_ids", "member_entity_ids", "member_chain_types", "member_copy_numbers", "member_instances")
    return _observations(_rows(cases, "tight_multimers", "multimer_index"), "multimer_index", "multimer", kept, lists)


def antibody_complexes(cases: DataFrame) -> DataFrame:
    kept = ["complex_id", "antibody_unit_type", "antibody_heavy_chain", "antibody_heavy_auth_asym_id", "antibody_light_chain", "antibody_light_auth_asym_id", "num_antigen_chains", "num_antibody_antigen_interfaces", "contact_score"]
    return _observations(_rows(cases, "antibody_antigen_complexes", "complex_index"), "complex_index", "complex", kept, _ANTIBODY_LISTS)


def tcr_complexes(cases: DataFrame) -> DataFrame:
    kept = ["complex_id", "tcr_type", "mhc_class", "num_tcr_chains", "num_peptide_chains", "num_tcr_pmhc_interfaces", "contact_score"]
    return _observations(_rows(cases, "tcr_pmhc_complexes", "complex_index"), "complex_index", "complex", kept, _TCR_LISTS)


TABLES = {
    "entry_quality": entry_quality, "monomers": monomers, "dimers": interfaces, "multimers": multimers,
    "antibody_complexes": antibody_complexes, "tcr_complexes": tcr_complexes,
}


def source_map(cases: DataFrame) -> DataFrame:
    """The case folder of each source; assemblies of one source are listed in order."""
    rows = cases.where("structure_summary is not null").select(F.col("structure_summary.source_path").alias("source_path"), "case_dir", "assembly").distinct()
    return rows.groupBy("source_path").agg(F.min("case_dir").alias("case_dir"), F.transform(F.array_sort(F.collect_set(assembly_order(F.col("assembly")))), lambda x: x["name"]).alias("assembly_ids"))


def build_prep(spark: SparkSession, inputs: str | DataFrame, target: str) -> dict[str, int]:
    """All tables of the cases under a path, or of cases given as rows, as Parquet (zstd, level 3), the map of sources, and a manifest of rows.

    Empty tables keep their schema. Bundles are parsed once and written before
    the tables are taken from them.
    """
    found = scan(spark, inputs) if isinstance(inputs, str) else inputs
    found.write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/bundles")
    cases, counts = spark.read.parquet(f"{target}/bundles"), {}
    for name, table in {**TABLES, "source_map": source_map, "corrupt": corrupt}.items():
        writer = table(cases).write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3")
        writer.parquet(f"{target}/{name}")
        counts[name] = spark.read.parquet(f"{target}/{name}").count()
    manifest = spark.createDataFrame(sorted(counts.items()), "name string, rows long")
    manifest.coalesce(1).write.mode("overwrite").json(f"{target}/manifest")
    return counts


def prep_table(spark: SparkSession, target: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One prep table, with the named columns only."""
    rows = spark.read.parquet(f"{target}/{name}")
    return rows.select(*columns) if columns else rows


def merge(spark: SparkSession, parts: list[str], target: str) -> None:
    """Parquet tables of equal columns as one, with the first one's schema."""
    schema = spark.read.parquet(parts[0]).schema
    spark.read.schema(schema).parquet(*parts).write.mode("overwrite").option("compression", "zstd").parquet(target)


def source_paths(target_tables: list[DataFrame]) -> DataFrame:
    """The distinct sources of several tables."""
    out = target_tables[0].select("source_path")
    for t in target_tables[1:]:
        out = out.union(t.select("source_path"))
    return out.distinct()
