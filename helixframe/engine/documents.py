"""Case documents of a run: what one case's tables hold, as one bundle, ready for the prep tables or as JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.sources import atoms as stored
from helixframe.sources import bundles


def _listed(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """(key, name): the key's rows in order as the artifact's type; fields that it doesn't have go, missing ones are null."""
    fields = [c for c in rows.columns if c != key]
    items = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("_o"), F.struct(*fields).alias("_v"))))
    return rows.groupBy(key).agg(F.from_json(F.to_json(F.transform(items, lambda x: x["_v"])), bundles.ARTIFACTS[name]).alias(name))


def _members(multimers: DataFrame) -> DataFrame:
    chain = lambda x: F.split(x, "@")[0]
    count = lambda c: F.size(F.filter("instances", lambda x: chain(x) == c))
    instances = F.transform("instances", lambda x: F.struct(x.alias("instance_id"), chain(x).alias("label_asym_id")))
    return multimers.withColumns({"member_copy_numbers": F.transform("member_chain_ids", count), "member_instances": instances})


def cases(tables: dict[str, DataFrame], mode: str = "asymmetric_unit") -> DataFrame:
    """The bundle of each case of a run (a file, or one of its assemblies), with the columns of ``bundles.scan``.

    A case's rows are those of one structure, so a bundle stays as large as that.
    """
    done = tables["results"].where("status = 'ok'").select(F.col("input_path").alias("path"), "case_id", "pdb_id", "experimental_method", "resolution", "release_date")
    out = tables["cases"].join(done, "path")
    meta = F.struct(F.coalesce("experimental_method", F.lit("")).alias("experimental_method"), F.col("resolution").cast("string").alias("resolution"), F.coalesce("release_date", F.lit("")).alias("release_date"), F.lit("file").alias("metadata_source"))
    summary = F.struct("pdb_id", F.col("path").alias("source_path"), F.lit(mode).alias("assembly_mode"), "assembly_id", meta.alias("entry_metadata"))
    out = out.select("path", "case", "case_id", "assembly_id", F.from_json(F.to_json(summary), bundles.ARTIFACTS["structure_summary"]).alias("structure_summary"))
    lists = {
        "chain_inventory": ("path", tables["chains"], ["label_asym_id"]), "dimer_interfaces": ("case", tables["interfaces"], ["instance_1", "instance_2"]),
        "tight_multimers": ("case", _members(tables["multimers"]), ["multimer_id"]), "antibody_antigen_complexes": ("case", tables["antibody_complexes"], ["complex_id"]),
        "tcr_pmhc_complexes": ("case", tables["tcr_complexes"], ["complex_id"]),
    }
    for name, (key, rows, order) in lists.items():
        out = out.join(_listed(rows, key, order, name), key, "left")
    folder = F.concat(F.lit("cases/"), "case_id")
    return out.select(
        folder.alias("case_dir"), F.concat_ws("_assembly_", F.concat(folder, F.lit("/result")), "assembly_id").alias("document"), F.col("assembly_id").alias("assembly_hint"), "structure_summary",
        *[_filled(name).alias(name) for name in lists], F.lit(None).cast("string").alias("_corrupt_record"),
    ).withColumn("assembly", bundles.bundle_assembly())


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(bundles.ARTIFACTS[name]))


def atoms(tables: dict[str, DataFrame]) -> DataFrame:
    """The run's placed atoms as stored ones: by source and assembly, the asymmetric unit where there is none."""
    rows = tables["atoms"].withColumnRenamed("path", "source_path")
    return rows.withColumn("assembly_id", F.coalesce("assembly_id", F.lit(stored.UNIT))).drop("case", "instance")
