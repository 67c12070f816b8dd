"""Suites of runs: a seeded sample of files, and a list of representative ones in several modes."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.engine import parse
from helixframe.engine.settings import MODES, ParseSettings
from helixframe.operators import reports, scheduling
from helixframe.sources import inputs

METRICS = ["num_chains", "num_dimers", "num_multimers", "num_antibody_antigen_complexes", "num_tcr_pmhc_complexes"]


def smoke(spark: SparkSession, folder: str, target: str, files: int = 50, settings: ParseSettings | None = None) -> DataFrame:
    """Totals of a run over a seeded sample of a folder's files (a sampling operator's own limit)."""
    chosen = scheduling.seeded_sample(inputs.expanded(spark, folder), files)
    paths = [r["path"] for r in chosen.collect()]  # at most ``files``
    out = parse.run(spark, ",".join(paths), target, settings)
    return reports.smoke_totals(out["results"].where("status = 'ok'"), "case_id", METRICS)


def representative(spark: SparkSession, paths: str, target: str, settings: ParseSettings | None = None, modes: tuple[str, ...] = MODES[:3]) -> dict[str, DataFrame]:
    """The files of a list, run in each mode; the summary of each."""
    listed = inputs.resolved(inputs.input_list(spark, paths)).orderBy("place")
    files = ",".join(r["path"] for r in listed.collect())  # a list that a person wrote
    base = settings or ParseSettings()
    return {mode: parse.run(spark, files, f"{target}/{mode}", dataclasses.replace(base, assembly_mode=mode))["summary"].withColumn("mode", F.lit(mode)) for mode in modes}
