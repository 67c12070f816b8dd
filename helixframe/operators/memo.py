"""A memo of alignments as a table: what is asked, known, done or failed.

The memo is Parquet that only grows: each write is a set of rows (key, state,
result, error, at), and the state of a key is that of its latest row, results
before errors before pending ones of the same time. Readers see whole writes,
lost executors leave none, and no lock is held.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.scalars import alignment_key

RESULT = "aligned_length int, rmsd double, tm_score_query double, tm_score_target double, coverage double"
SCHEMA = f"cache_key string, state string, result struct<{', '.join(x.replace(' ', ':', 1) for x in RESULT.split(', ') )}>, error string, at timestamp"
PENDING, DONE, FAILED = "pending", "done", "failed"


def keyed(tasks: DataFrame) -> DataFrame:
    """Tasks with their key; sides are ordered by the asker, and everything that changes a result is part of it."""
    digest = lambda c: F.sha2(F.coalesce(c, F.lit("")), 256)
    parts = [digest("seq_query"), digest("seq_target"), *[F.coalesce(c, F.lit("")) for c in ("source_query", "source_target", "query_id", "target_id", "query_fingerprint", "target_fingerprint")]]
    return tasks.withColumn("cache_key", alignment_key(*parts, F.coalesce("model", F.lit(1)), F.coalesce("keep_h", F.lit(False)).cast("int"), F.coalesce("mode", F.lit("monomer"))))


def _append(rows: DataFrame, path: str) -> None:
    rows.select("cache_key", "state", "result", "error", F.current_timestamp().alias("at")).write.mode("append").parquet(path)


def _blank() -> dict:
    return {"result": F.lit(None).cast(SCHEMA.split("result ")[1].split(", error")[0]), "error": F.lit(None).cast("string")}


def connect(spark: SparkSession, path: str) -> DataFrame:
    """The memo under a path; a new one is made empty."""
    spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def latest(memo: DataFrame) -> DataFrame:
    """The state of each key."""
    rank = F.struct("at", F.when(F.col("state") == DONE, 2).when(F.col("state") == FAILED, 1).otherwise(0))
    return memo.groupBy("cache_key").agg(F.max_by(F.struct("state", "result", "error"), rank).alias("_l")).select("cache_key", "_l.*")


def known(tasks: DataFrame, memo: DataFrame) -> DataFrame:
    """Tasks with the memo's results, null where it has none."""
    done = latest(memo).where(F.col("state") == DONE).select("cache_key", "result")
    return tasks.join(done, "cache_key", "left")


def open_tasks(tasks: DataFrame, memo: DataFrame) -> DataFrame:
    """The tasks without a result, one of each key."""
    done = latest(memo).where(F.col("state") == DONE).select("cache_key")
    return tasks.join(done, "cache_key", "left_anti").dropDuplicates(["cache_key"])


def ask(tasks: DataFrame, memo: DataFrame, path: str) -> None:
    """Keys that the memo has not yet are pending."""
    new = tasks.select("cache_key").distinct().join(memo.select("cache_key").distinct(), "cache_key", "left_anti")
    _append(new.withColumn("state", F.lit(PENDING)).withColumns(_blank()), path)


def answer(results: DataFrame, path: str) -> None:
    """Results (cache_key, result, error) of alignments; an error without a result is a failure."""
    state = F.when(F.col("result").isNotNull(), DONE).otherwise(FAILED)
    _append(results.withColumn("state", state), path)


def copied(spark: SparkSession, source: str, target: str) -> None:
    """Results of one memo that another lacks."""
    have = latest(connect(spark, target)).where(F.col("state") == DONE).select("cache_key")
    more = latest(spark.read.schema(SCHEMA).parquet(source)).where(F.col("state") == DONE).join(have, "cache_key", "left_anti")
    _append(more, target)


def status_counts(memo: DataFrame) -> DataFrame:
    """Keys of each state."""
    return latest(memo).groupBy("state").agg(F.count("*").alias("n"))


def pending_by_cost(tasks: DataFrame, memo: DataFrame, cost: str) -> DataFrame:
    """Open tasks, the dearest first."""
    return open_tasks(tasks, memo).orderBy(F.desc(cost), "cache_key")
