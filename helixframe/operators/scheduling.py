"""Work in parts of like size: shards of files, batches of groups, samples."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.scalars import shard_group


def shard_groups(files: DataFrame) -> DataFrame:
    """(group, bytes, files) of input files: an entry's assemblies stay together."""
    return files.groupBy(shard_group(F.col("path")).alias("group")).agg(F.sum(F.coalesce("bytes", F.lit(0))).alias("bytes"), F.count("*").alias("files"))


def bin_packing(groups: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Each group's shard: the heaviest next into the lightest shard so far (ties: the lower number)."""
    shards = min(max(1, shards), len(groups))
    heap = [(0, k) for k in range(shards)]
    out = {}
    for size, name in sorted(groups, reverse=True):
        total, k = heapq.heappop(heap)
        out[name] = k
        heapq.heappush(heap, (total + size, k))
    return out


#: Groups that are packed one by one; lighter ones beyond them are dealt by their running sum.
HEAVY_GROUPS = 100_000


def shard_plan(files: DataFrame, shards: int, heavy: int = HEAVY_GROUPS) -> DataFrame:
    """(path, shard). The heaviest groups are packed on the driver (a bounded list); the rest, each lighter than
    any of them, follow by a hash, which evens out as they are many."""
    spark = files.sparkSession
    sizes = shard_groups(files)
    top = [(r["bytes"], r["group"]) for r in sizes.orderBy(F.desc("bytes"), F.desc("group")).limit(heavy).collect()]
    if not top:
        return files.select("path", F.lit(0).alias("shard"))
    placed = bin_packing(top, shards)
    table = spark.createDataFrame(list(placed.items()), "group string, shard int")
    named = files.withColumn("group", shard_group(F.col("path"))).join(table, "group", "left")
    rest = F.pmod(F.xxhash64("group"), F.lit(min(max(1, shards), len(top)))).cast("int")
    return named.select("path", F.coalesce("shard", rest).alias("shard"))


def batches(groups: DataFrame, size: str, order: str, target: int, most_groups: int = 64) -> DataFrame:
    """Groups in order as batches of about ``target`` members and at most ``most_groups`` groups.

    A batch ends where the running number of members passes a multiple of the
    target, or the running number of groups one of its limit; both counts run in
    ranges whose sums give the offsets.
    """
    w = Window.orderBy(order)
    parts = groups.withColumn("_b", F.floor(F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) / target))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1
    return parts.withColumn("batch", F.struct(F.col("_b").alias("range"), F.floor(inside / most_groups).alias("part"))).drop("_b")


def work_groups(rows: DataFrame, keys: list[str], order: str, most: int) -> DataFrame:
    """Rows of one source as one group, those of large ones split into equal runs of at most ``most``."""
    w = Window.partitionBy(*keys)
    n, r = F.count("*").over(w), F.row_number().over(w.orderBy(order)) - 1
    parts = F.ceil(n / most)
    return rows.withColumn("work", F.floor(r * parts / n).cast("int"))


def seeded_sample(files: DataFrame, n: int, seed: int = 20260416) -> DataFrame:
    """N files by a seeded hash of their paths, in order of paths (a sampling operator's own limit)."""
    return files.orderBy(F.xxhash64("path", F.lit(seed)), "path").limit(n).orderBy("path")
