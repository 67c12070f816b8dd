"""Review of parsed cases: metrics of each case, warnings, priority lists, totals of a batch.

Cases are the rows of ``sources.bundles.scan``, several bundles a case where it
has several assemblies; results are one row a case with ``status`` ok, skipped
or error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import fixed as X
from helixframe.functions.scalars import confidence_score, warning_codes
from helixframe.operators.relational import top_by

_TEXTS = "array<string>"

# Warnings about the owners of ligands, and the priority lists of a review by metric or by warning.
COVERAGE_WARNINGS = (
    "coverage skipped because atom array extraction failed", "coverage skipped because the chain has no coordinates",
    "coverage assigned to multiple main chains", "coverage owner not found within the nearest-distance threshold",
)
METRIC_LISTS = {
    "antibody_low_confidence": "num_low_confidence_antibody_chains", "antibody_unpaired_heavy": "num_unpaired_antibody_heavy_chains",
    "antibody_unpaired_light": "num_unpaired_antibody_light_chains", "antibody_true_heavy_only": "num_true_heavy_only_chains",
    "antibody_annotation_conflicts": "num_antibody_annotation_conflicts", "tcr_contextual_peptide": "num_contextual_peptide_chains_in_complexes",
}
WARNING_LISTS = {
    "immune_annotation_conflicts": ("chain", ("description_and_sequence_immune_annotation_disagree",)),
    "missing_auth_asym_id_warning": ("chain", ("auth_asym_id not found in scheme categories or atom_site",)),
    "coverage_assignment_warning": ("chain", COVERAGE_WARNINGS),
    "antibody_antigen_contacts_not_on_heavy_warning": ("antibody_complex", ("paired_unit_antigen_contacts_not_on_heavy_chain",)),
    "tcr_unpaired_chain_warning": ("tcr_complex", ("unpaired_tcr_chain",)),
    "large_multimer_after_bridge_pruning_warning": ("multimer", ("large_component_after_bridge_pruning",)),
}
WHOLE_LISTS = {"tcr_missing_peptide_warning": "mhc_without_bound_peptide", "tcr_missing_auxiliary_warning": "class_i_mhc_without_beta2m_or_auxiliary_chain"}
TOP = 10


def warnings_of(cases: DataFrame) -> DataFrame:
    """(case_dir, kind, code, n) over the records of each kind; a summary's metadata warning counts where its own list lacks it."""
    def of(kind: str, c: Column) -> DataFrame:
        return cases.select("case_dir", F.lit(kind).alias("kind"), F.explode(F.coalesce(c, F.array().cast(_TEXTS))).alias("code"))

    flat = lambda c: F.flatten(F.transform(c, lambda x: F.coalesce(x["warnings"], F.array().cast(_TEXTS))))
    own = F.coalesce("structure_summary.warnings", F.array().cast(_TEXTS))
    meta = F.col("structure_summary.entry_metadata.metadata_warning")
    extra = F.when((F.coalesce(meta, F.lit("")) != "") & ~F.array_contains(own, meta), F.array(meta)).otherwise(F.array().cast(_TEXTS))
    # The chains of a case are the same in all its bundles: those of the first count.
    first = F.row_number().over(Window.partitionBy("case_dir").orderBy("document"))
    lead = cases.withColumn("_f", first).where("_f = 1")
    rows = of("summary", F.concat(own, extra)).unionByName(of("antibody_complex", flat("antibody_antigen_complexes")))
    rows = rows.unionByName(of("tcr_complex", flat("tcr_pmhc_complexes"))).unionByName(of("multimer", flat("tight_multimers")))
    rows = rows.unionByName(lead.select("case_dir", F.lit("chain").alias("kind"), F.explode(F.coalesce(flat("chain_inventory"), F.array().cast(_TEXTS))).alias("code")))
    counted = rows.where("code is not null").groupBy("case_dir", "kind", "code").agg(F.count("*").alias("n"))
    return counted.unionByName(counted.groupBy("case_dir", "code").agg(F.sum("n").alias("n")).withColumn("kind", F.lit("parse")))


def case_metrics(cases: DataFrame, low: float = X.LOW_CONFIDENCE) -> DataFrame:
    """Conditional counts of each case, its chains counted once."""
    chains = F.col("chain_inventory")
    none = lambda c: F.coalesce(c, F.lit("")) == ""
    count = lambda test: F.coalesce(F.size(F.filter(chains, test)), F.lit(0))
    antibody = lambda x: x["chain_type"].isin(*X.ANTIBODY_TYPES)
    heavy = lambda x: x["chain_type"] == X.ANTIBODY_TYPES[0]
    featured = "features" in _fields(cases)
    analysis = lambda x: x["features"]["antibody_analysis"]
    told = lambda x: [F.nullif(analysis(x)["unit_type"], F.lit("")), F.nullif(x["features"]["antibody_unit_type"], F.lit(""))] if featured else []
    single = lambda x: F.coalesce(F.coalesce(*told(x), x["subtype"]).isin("VHH", "scFv"), F.lit(False))
    alone = lambda x: ~single(x) & none(x["paired_label_asym_id"])
    # What the analysis found counts before what the pairing left over.
    true_only = lambda x: F.coalesce(analysis(x)["heavy_only_evidence"]["is_true_heavy_only"], alone(x)) if featured else alone(x)
    score = lambda x: F.coalesce(x["annotation_confidence"], F.lit(0.0)) if "annotation_confidence" in _fields(cases) else F.lit(0.0)
    lead = cases.withColumn("_f", F.row_number().over(Window.partitionBy("case_dir").orderBy("document"))).where("_f = 1").select(
        "case_dir",
        count(lambda x: antibody(x) & (score(x) < low)).alias("num_low_confidence_antibody_chains"),
        count(lambda x: heavy(x) & alone(x)).alias("num_unpaired_antibody_heavy_chains"),
        count(lambda x: (x["chain_type"] == X.ANTIBODY_TYPES[1]) & none(x["paired_label_asym_id"])).alias("num_unpaired_antibody_light_chains"),
        count(lambda x: heavy(x) & true_only(x)).alias("num_true_heavy_only_chains"),
        count(lambda x: F.coalesce(F.array_contains(x["warnings"], "description_and_sequence_antibody_annotation_disagree"), F.lit(False))).alias("num_antibody_annotation_conflicts"),
        count(lambda x: x["chain_type"] == X.TCR).alias("num_tcr_chains"), count(lambda x: x["chain_type"] == X.MHC).alias("num_mhc_heavy_chains"),
    )
    size = lambda c: F.sum(F.coalesce(F.size(F.coalesce(F.col(c), F.array())), F.lit(0)))
    whole = cases.groupBy("case_dir").agg(
        size("antibody_antigen_complexes").alias("num_antibody_antigen_complexes"), size("tcr_pmhc_complexes").alias("num_tcr_pmhc_complexes"), F.count("*").alias("num_processed_assemblies")
    )
    short = chains_of(cases).where((F.col("chain_type") == "other protein chain")).select("case_dir", F.col("label_asym_id").alias("chain")).distinct()
    bound = cases.select("case_dir", F.explode("tcr_pmhc_complexes").alias("t")).select("case_dir", F.explode("t.peptide_chain_ids").alias("chain")).distinct()
    context = bound.join(short, ["case_dir", "chain"], "left_semi").groupBy("case_dir").agg(F.count("*").alias("num_contextual_peptide_chains_in_complexes"))
    total = warnings_of(cases).where("kind = 'parse'").groupBy("case_dir").agg(F.sum("n").alias("total_parse_warnings"))
    out = lead.join(whole, "case_dir").join(context, "case_dir", "left").join(total, "case_dir", "left")
    zero = F.lit(0).cast("long")
    return out.withColumns({c: F.coalesce(c, zero) for c in ("num_contextual_peptide_chains_in_complexes", "total_parse_warnings")})


def _fields(cases: DataFrame) -> list[str]:
    return [f.name for f in cases.schema["chain_inventory"].dataType.elementType.fields]


def chains_of(cases: DataFrame) -> DataFrame:
    return cases.select("case_dir", F.explode("chain_inventory").alias("_c")).select("case_dir", "_c.*")


def antibody_confidence(label: Column, own: Column) -> Column:
    """The score of a label, else the chain's own."""
    return F.coalesce(confidence_score(F.lower(label)), own, F.lit(0.0))


# Lists


def top_cases(metrics: DataFrame, case: str, metric: str, limit: int = TOP) -> DataFrame:
    """Cases with the largest positive values, ties by name; a report's own limit."""
    return metrics.where(F.col(metric) > 0).select(case, F.col(metric).cast("long").alias("n")).orderBy(F.desc("n"), case).limit(limit)


def metric_lists(metrics: DataFrame, case: str = "case_dir", limit: int = TOP) -> DataFrame:
    """(list, case, n, rank): the top cases of each metric, in one pass over the metrics."""
    items = F.array(*[F.struct(F.lit(name).alias("list"), F.col(metric).cast("long").alias("n")) for name, metric in METRIC_LISTS.items()])
    rows = metrics.select(case, F.explode(items).alias("i")).select(case, "i.list", "i.n").where("n > 0")
    return top_by(rows, ["list"], [F.desc("n"), F.col(case).asc()], limit)


def warning_lists(warnings: DataFrame, case: str = "case_dir", limit: int = TOP) -> DataFrame:
    """The cases with most warnings of each list's codes."""
    lists = [(name, kind, code) for name, (kind, codes) in WARNING_LISTS.items() for code in codes]
    table = warnings.sparkSession.createDataFrame(lists, "list string, kind string, code string")
    rows = warnings.join(F.broadcast(table), ["kind", "code"]).groupBy("list", case).agg(F.sum("n").alias("n"))
    return top_by(rows, ["list"], [F.desc("n"), F.col(case).asc()], limit)


def unmatched_receptors(metrics: DataFrame, case: str = "case_dir") -> DataFrame:
    """Cases with receptor and MHC chains but no complex of them."""
    return metrics.where("num_tcr_chains > 0 and num_mhc_heavy_chains > 0 and num_tcr_pmhc_complexes = 0").select(case, "num_tcr_chains", "num_mhc_heavy_chains").orderBy(case)


def top_by_code(warnings: DataFrame, case: str = "case_dir", limit: int = TOP) -> DataFrame:
    """W16."""
    return top_by(warnings, ["kind", "code"], [F.desc("n"), F.col(case).asc()], limit)


def cases_by_code(warnings: DataFrame, case: str = "case_dir") -> DataFrame:
    """All cases of each warning with their rank."""
    w = Window.partitionBy("kind", "code").orderBy(F.desc("n"), case)
    return warnings.withColumn("rank", F.row_number().over(w))


def status_cases(results: DataFrame, status: str) -> DataFrame:
    """Cases of a status in order, with what explains it."""
    more = {"skipped": ["warning_code", "warning"], "error": ["error"]}.get(status, [])
    return results.where(F.col("status") == status).select("case_id", "input_path", *more).orderBy("case_id")


def count_by(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each value of a key; blanks are left out."""
    return rows.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.count("*").alias("n"))


def totals_by_kind(warnings: DataFrame) -> DataFrame:
    """Warnings of each kind and code over all cases."""
    return warnings.groupBy("kind", "code").agg(F.sum("n").alias("n"), F.count("*").alias("cases"))


def merged_counts(*maps: Column) -> Column:
    """Maps of counts added up, in order of keys."""
    out = maps[0]
    for more in maps[1:]:
        out = F.map_zip_with(out, more, lambda k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    return F.map_from_entries(F.array_sort(F.map_entries(out)))


SUMS = {
    "total_chains": "num_chains", "total_dimers": "num_dimers", "total_multimers": "num_multimers", "total_antibody_antigen_complexes": "num_antibody_antigen_complexes",
    "total_tcr_pmhc_complexes": "num_tcr_pmhc_complexes",
}


def batch_summary(results: DataFrame) -> DataFrame:
    """Counts by status, totals over what succeeded, averages to two decimals, skip codes."""
    ok = F.col("status") == "ok"
    sums = [F.coalesce(F.sum(F.when(ok, F.coalesce(F.col(c), F.lit(0)))), F.lit(0)).alias(name) for name, c in SUMS.items()]
    out = results.agg(
        F.count("*").alias("total_cases"), F.count_if(ok).alias("success_count"), F.count_if(F.col("status") == "skipped").alias("skipped_count"), F.count_if(F.col("status") == "error").alias("failure_count"), *sums,
        F.coalesce(F.sum(F.when(ok, F.coalesce("num_assemblies_processed", F.lit(1)))), F.lit(0)).alias("total_processed_assemblies"),
    )
    mean = lambda c: F.when(F.col("success_count") > 0, F.round(F.col(c) / F.col("success_count"), 2)).otherwise(0.0)
    return out.withColumns({f"average_{c}_per_successful_case": mean(f"total_{c}") for c in ("chains", "dimers", "multimers")})


def smoke_totals(metrics: DataFrame, case: str, columns: list[str]) -> DataFrame:
    """For each metric its total, average, share of cases with any, and the case with most (ties by name)."""
    items = F.array(*[F.struct(F.lit(c).alias("metric"), F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("v")) for c in columns])
    rows = metrics.select(case, F.explode(items).alias("i")).select(case, "i.*")
    return rows.groupBy("metric").agg(
        F.sum("v").alias("total"), F.round(F.avg("v"), 2).alias("average"), F.round(F.avg((F.col("v") > 0).cast("double")), 4).alias("share"),
        F.min_by(case, F.struct(-F.col("v"), F.col(case))).alias("largest_case"), F.max("v").alias("largest"),
    )


def size_histogram(metrics: DataFrame, column: str, edges: list[int]) -> DataFrame:
    """Cases by size: each bin from one edge up to the next."""
    bins = F.lit(0)
    for k, edge in enumerate(edges):
        bins = F.when(F.col(column) >= edge, k + 1).otherwise(bins)
    return metrics.groupBy(bins.alias("bin")).agg(F.count("*").alias("cases"))


def priority_counts(lists: DataFrame) -> DataFrame:
    """Cases on each priority list."""
    return lists.groupBy("list").agg(F.count("*").alias("cases"))


def skip_codes(results: DataFrame) -> DataFrame:
    """Codes of skipped cases; several are separated by ';'."""
    rows = results.where("status = 'skipped'").select(F.explode(warning_codes(F.col("warning_code"))).alias("code"))
    return count_by(rows, "code")
