"""Inputs of a batch: files, lists, cases, and entry metadata from files, tables or trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions.scalars import base_name, case_id, entry_from_assembly, number_or_null, warning_codes

# Suffixes of structure files.
SUFFIXES = (".cif", ".cif.gz", ".bcif", ".bcif.gz")


def input_list(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a list in order, without blank ones and those that start with '#'."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("place", "line"))
    return rows.select("place", F.trim("line").alias("path")).where("path <> '' and not path like '#%'")


def expanded(spark: SparkSession, folder: str) -> DataFrame:
    """Structure files below a folder, by suffix, then path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*{" + ",".join(SUFFIXES) + "}").load(folder)
    w = Window.orderBy(F.coalesce(*[F.when(F.lower("path").endswith(s), i) for i, s in reversed(list(enumerate(SUFFIXES)))]), "path")
    return found.select("path", F.col("length").alias("bytes")).withColumn("place", F.row_number().over(w) - 1)


def resolved(candidates: DataFrame) -> DataFrame:
    """Structure files of (place, path), each path once, at its first place."""
    ok = F.coalesce(*[F.when(F.lower("path").endswith(s), True) for s in SUFFIXES], F.lit(False))
    key = F.regexp_replace(F.regexp_replace("path", r"^file:/+", "/"), r"/(\./)+", "/")
    return candidates.where(ok).withColumn("_k", key).groupBy("_k").agg(F.min_by("path", "place").alias("path"), F.min("place").alias("place")).drop("_k")


def case_specs(inputs: DataFrame, folder: str) -> DataFrame:
    """A case for each input; inputs that share a name are numbered in order."""
    named = inputs.withColumn("_c", case_id(F.col("path")))
    w = Window.partitionBy("_c")
    n = F.row_number().over(w.orderBy("place"))
    case = F.when(F.count("*").over(w) > 1, F.concat("_c", F.format_string("_%02d", n))).otherwise(F.col("_c"))
    return named.select("place", case.alias("case_id"), F.col("path").alias("input_path")).withColumn("output_dir", F.concat(F.lit(f"{folder.rstrip('/')}/cases/"), "case_id"))


def whole_entries(specs: DataFrame, tree: DataFrame) -> DataFrame:
    """The entry's own file for each entry of the inputs, as a case of its own (assembly 0); missing ones are told."""
    entries = specs.select(entry_from_assembly(F.col("input_path")).alias("entry")).where("entry <> ''").distinct()
    found = entries.join(first_in_tree(tree), "entry", "left")
    case = F.concat(F.lower("entry"), F.lit("-assembly0"))
    rows = found.select(case.alias("case_id"), F.col("path").alias("input_path"), F.when(F.col("path").isNull(), "missing_metadata_cif_for_include_asym").alias("warning_code"))
    return rows.join(specs.select("case_id"), "case_id", "left_anti")


def first_in_tree(tree: DataFrame) -> DataFrame:
    """Of the files (path) of a tree the one that stands for each entry: named in lower case, then upper case, then in its folder; by suffix."""
    name = base_name(F.col("path"))
    suffix = F.coalesce(*[F.when(F.lower(name).endswith(s), i) for i, s in enumerate((".cif.gz", ".bcif.gz"))], F.when(F.lower(name).endswith(".bcif"), 3), F.when(F.lower(name).endswith(".cif"), 2))
    stem = F.regexp_replace(name, r"(?i)\.b?cif(\.gz)?$", "")
    nested = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1) == F.substring(F.lower(stem), 2, 2)
    rank = F.when(nested, 2).when(stem == F.lower(stem), 0).otherwise(1)
    rows = tree.where(suffix.isNotNull()).select(F.upper(stem).alias("entry"), "path", F.struct(rank, suffix, F.col("path").alias("p")).alias("k"))
    return rows.groupBy("entry").agg(F.min_by("path", "k").alias("path"))


def metadata_table(spark: SparkSession, path: str) -> DataFrame:
    """(entry, experimental_method, resolution, release_date) of a Parquet or CSV table; the last row of an entry counts."""
    rows = spark.read.option("header", "true").csv(path) if path.lower().endswith(".csv") else spark.read.parquet(path)
    lower = {c.lower(): c for c in rows.columns}
    pick = lambda c: F.col(f"`{lower[c]}`").cast("string") if c in lower else F.lit(None).cast("string")
    kept = rows.select(F.upper(pick("pdb_id")).alias("entry"), pick("experimental_method").alias("m"), pick("resolution").alias("r"), pick("release_date").alias("d"), F.monotonically_increasing_id().alias("at"))
    last = kept.where("entry <> ''").groupBy("entry").agg(F.max_by(F.struct("m", "r", "d"), "at").alias("l"))
    text = lambda c: F.coalesce(c, F.lit(""))
    return last.select("entry", text("l.m").alias("experimental_method"), F.round(number_or_null(F.col("l.r")), 2).alias("resolution"), text("l.d").alias("release_date"))


def enriched(own: DataFrame, table: DataFrame | None = None, tree: DataFrame | None = None) -> DataFrame:
    """Each input's own metadata, else the table's, else that of the entry's file in a tree; what stays unknown is warned of.

    All have path or entry, experimental_method, resolution and release_date.
    """
    rows = own.withColumn("entry", entry_from_assembly(F.col("path")))
    fields = ("experimental_method", "resolution", "release_date")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit("")) == ""
    lacks = blank(F.col("experimental_method")) | blank(F.col("resolution")) | blank(F.col("release_date"))
    pick = [F.struct(F.lit("input_cif").alias("source"), *fields)]
    for name, other, needed in (("metadata_table", table, lambda s: s.isNotNull()), ("full_mmcif", tree, lambda s: ~blank(s["experimental_method"]) | ~blank(s["resolution"]))):
        if other is not None:
            rows = rows.join(other.select("entry", F.struct(F.lit(name).alias("source"), *[F.col(c).cast(dict(own.dtypes)[c]).alias(c) for c in fields]).alias(f"_{name}")), "entry", "left")
            pick.append(F.when(needed(F.col(f"_{name}")), F.col(f"_{name}")))
    best = F.when(lacks, F.coalesce(*pick[1:], pick[0]) if len(pick) > 1 else pick[0]).otherwise(pick[0])
    found = rows.withColumn("_b", best)
    codes = F.filter(F.array(
        F.when(lacks & (F.col("_b.source") == "input_cif"), "no_entry_metadata_found_for_input_assembly"),
        F.when(F.col("_b.resolution").isNull(), "missing_resolution_in_entry_metadata"),
    ), lambda x: x.isNotNull())
    before = warning_codes(F.col("metadata_warning")) if "metadata_warning" in own.columns else F.array().cast("array<string>")
    return found.select("path", "entry", *[F.col(f"_b.{c}").alias(c) for c in fields], F.col("_b.source").alias("metadata_source"), F.array_join(F.array_distinct(F.concat(before, codes)), "; ").alias("metadata_warning"))
