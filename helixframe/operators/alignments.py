"""Alignments of pairs of structures: independent rows of one table, as many at once as the cluster has cores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.operators import memo, superposition
from helixframe.operators.refinement import accepts

RESULT = "aligned_length int, rmsd double, tm_score_query double, tm_score_target double, coverage double, error string"


def _points(trace) -> np.ndarray:
    return np.asarray(trace, float).reshape(-1, 3)


def _found(traces: list[tuple]) -> list[tuple[dict, str | None]]:
    """Alignments of pairs, or what is wrong with them; those that can be aligned are so in batches."""
    out: list[tuple[dict, str | None]] = [({}, None)] * len(traces)
    good = []
    for k, (a, b) in enumerate(traces):
        try:
            pair = _points(a), _points(b)
            if not all(np.isfinite(x).all() for x in pair):
                raise ValueError("a place is not finite")
            good.append((k, pair))
        except (TypeError, ValueError) as error:
            out[k] = {}, f"{type(error).__name__}: {error}"[-4000:]
    for (k, _), found in zip(good, superposition.align_many([p for _, p in good]), strict=True):
        out[k] = found, None if found["aligned_length"] else "fewer than three residues"
    return out


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = _found(list(zip(pdf["trace_query"], pdf["trace_target"], strict=True)))
        names = [x.split(" ")[0] for x in RESULT.split(", ")]
        got = pd.DataFrame([(*(x.get(k) for k in names[:-1]), bad) for x, bad in found], columns=names, index=pdf.index)
        got["aligned_length"] = got["aligned_length"].astype("Int32")
        yield pd.concat([pdf.drop(columns=["trace_query", "trace_target"]), got], axis=1)


def _dealt(pairs: DataFrame) -> DataFrame:
    """The pairs in as many partitions as shuffles have: aligning is dear beside its bytes."""
    return pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def aligned(pairs: DataFrame) -> DataFrame:
    """Pairs (trace_query, trace_target and further columns) with their alignment or its error."""
    kept = [f for f in pairs.schema if f.name not in ("trace_query", "trace_target")]
    return _dealt(pairs).mapInPandas(_run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), RESULT]))


COMPLEX = RESULT + ", chains array<struct<query:int,target:int>>"


def _found_complexes(pairs: list[tuple]) -> list[tuple[dict, str | None]]:
    """Alignments of pairs of complexes, or what is wrong with them; where one stops a batch, each goes alone."""
    out: list[tuple[dict, str | None]] = [({}, None)] * len(pairs)
    good = []
    for k, pair in enumerate(pairs):
        try:
            shaped = tuple([_points(p) for p in parts] for parts in pair)
            if not all(np.isfinite(p).all() for parts in shaped for p in parts):
                raise ValueError("a place is not finite")
            good.append((k, shaped))
        except (TypeError, ValueError) as error:
            out[k] = {}, f"{type(error).__name__}: {error}"[-4000:]
    wrong = TypeError, ValueError, np.linalg.LinAlgError
    try:
        found = [(x, None) for x in superposition.align_complexes([pair for _, pair in good])]
    except wrong:
        found = []
        for _, pair in good:
            try:
                found.append((superposition.align_complex(*pair), None))
            except wrong as error:
                found.append(({}, f"{type(error).__name__}: {error}"[-4000:]))
    for (k, _), (x, bad) in zip(good, found, strict=True):
        out[k] = x, bad or (None if x["aligned_length"] else "fewer than three residues")
    return out


def _run_complexes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split(" ")[0] for x in RESULT.split(", ")]
    for pdf in batches:
        rows = []
        for found, bad in _found_complexes(list(zip(pdf["parts_query"], pdf["parts_target"], strict=True))):
            chains = [{"query": int(i), "target": int(j)} for i, j in found.get("chains", [])]
            rows.append((*(found.get(k) for k in names[:-1]), bad, chains))
        got = pd.DataFrame(rows, columns=[*names, "chains"], index=pdf.index)
        got["aligned_length"] = got["aligned_length"].astype("Int32")
        yield pd.concat([pdf.drop(columns=["parts_query", "parts_target"]), got], axis=1)


def aligned_complexes(pairs: DataFrame) -> DataFrame:
    """Pairs of complexes (parts_query, parts_target: a trace for each chain) with their alignment, the assigned chains, or the error."""
    kept = [f for f in pairs.schema if f.name not in ("parts_query", "parts_target")]
    return _dealt(pairs).mapInPandas(_run_complexes, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), COMPLEX]))


def scored(rows: DataFrame, least_score: float = 0.5, least_coverage: float = 0.5) -> DataFrame:
    """The smaller and the larger score, and whether they and the coverage suffice."""
    low, high = F.least("tm_score_query", "tm_score_target"), F.greatest("tm_score_query", "tm_score_target")
    return rows.withColumns({
        "tm_score_min": low, "tm_score_max": high, "tm_score_for_clustering": high, "meets_tm_threshold": F.coalesce(high >= least_score, F.lit(False)),
        "meets_coverage_threshold": F.coalesce(F.col("coverage") >= least_coverage, F.lit(False)),
    })


def identical(same: Column, residues_query: Column, residues_target: Column) -> Column:
    """C11: the alignment of two equal structures, without aligning them."""
    n = F.least(residues_query, residues_target)
    return F.when(same, F.struct(n.alias("aligned_length"), F.lit(0.0).alias("rmsd"), F.lit(1.0).alias("tm_score_query"), F.lit(1.0).alias("tm_score_target"), F.lit(1.0).alias("coverage")))


def remembered(tasks: DataFrame, path: str) -> DataFrame:
    """Alignments of tasks (cache_key, trace_query, trace_target): known ones from the memo, others made and added."""
    spark = tasks.sparkSession
    before = memo.connect(spark, path)
    memo.ask(tasks, before, path)
    fresh = aligned(memo.open_tasks(tasks, before).select("cache_key", "trace_query", "trace_target"))
    result = F.when(F.col("error").isNull(), F.struct("aligned_length", "rmsd", "tm_score_query", "tm_score_target", "coverage"))
    memo.answer(fresh.select("cache_key", result.alias("result"), "error"), path)
    after = memo.latest(memo.connect(spark, path))
    return tasks.drop("trace_query", "trace_target").join(after, "cache_key", "left")


__all__ = ["COMPLEX", "RESULT", "accepts", "aligned", "aligned_complexes", "identical", "remembered", "scored"]
