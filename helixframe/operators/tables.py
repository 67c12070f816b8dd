"""Tables that a plan of several steps writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where none is set on a single machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    set_one = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_one.isDefined():
        return set_one.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="helixframe-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Rows of one partition of a table that is dealt by size.
DEALT_ROWS = 1_000_000


def dealt(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """``rows`` by keys in as many partitions as shuffles have, or more: what a task holds does not grow with ``size``, the rows to be dealt."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(parts, -(-size // DEALT_ROWS)), *keys)


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, read again: later steps see one and the same result."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
