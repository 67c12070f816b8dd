"""Shared state of multi-step operators: tables in the cluster's shared folder, graph components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


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


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again, which cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trim() -> None:
    """Give freed memory of this Python worker back, as workers stay for later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def free_names(taken, *names: str) -> list[str]:
    """The names, each after as many underscores as it takes to be none of those taken (whatever their case)."""
    taken, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
        taken.add(name.lower())
    return out


def without(columns, *added: str) -> list[str]:
    """The columns but those named like added ones, which take their place."""
    added = {x.lower() for x in added}
    return [c for c in columns if c.lower() not in added]


def fields(schema, columns) -> list[str]:
    """DDL of some columns of a schema."""
    return [f"`{schema[c].name}` {schema[c].dataType.simpleString()}" for c in columns]


#: Counters in one block of a count vector.
BLOCK = 1 << 15


def count_blocks(counts: np.ndarray) -> pa.RecordBatch:
    """A vector of counts as rows (block, counts) of its blocks that are not all zero."""
    parts = [(k, counts[k * BLOCK : (k + 1) * BLOCK]) for k in range(-(-len(counts) // BLOCK))]
    parts = [(k, zlib.compress(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)) for k, x in parts if x.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in parts], pa.int64()), pa.array([x for _, x in parts], pa.binary())], names=["block", "counts"]
    )


def _block(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _add_blocks(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            x = _block(raw)
            total[k] = total[k] + x if k in total else x
    for k, x in total.items():
        one = np.zeros((k + 1) * BLOCK, np.int64)[: k * BLOCK + len(x)]
        one[k * BLOCK :] = x
        yield count_blocks(one)


def sum_counts(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of count vectors given by rows (block, counts): ``size`` numbers, whatever the input.

    Blocks are summed where they meet, as a stream; each task holds its blocks' sums only.
    """
    counts = np.zeros(size, np.int64)
    summed = rows.select("block", "counts").repartition(-(-size // BLOCK), "block")
    for r in summed.mapInArrow(_add_blocks, "block long, counts binary").collect():
        x = _block(r["counts"])
        counts[r["block"] * BLOCK : r["block"] * BLOCK + len(x)] = x
    return counts


#: Bits of the bitmaps of ``likely``: one megabyte, whatever the input.
BITMAP_BITS = 23


def likely(rows: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """Those rows whose ``col`` may be among ``ids``, by a bitmap of fixed size over hashed ids.

    A filter before a join that ships wide rows: no row that joins is lost, and
    a row that the bitmap lets through by accident only costs time.
    """
    spark = rows.sparkSession
    slots = 1 << BITMAP_BITS
    parts = (
        ids.select(F.pmod(F.xxhash64(ids.columns[0]), F.lit(slots)).alias("slot"))
        .groupBy(F.shiftright("slot", 15).alias("part"))
        .agg(F.bitmap_construct_agg(F.pmod("slot", F.lit(1 << 15))).alias("bits"))
        .collect()  # at most 2**(BITMAP_BITS - 15) rows of 4 KB
    )
    bits = np.zeros(slots >> 3, np.uint8)
    for r in parts:
        bits[r["part"] << 12 : (r["part"] + 1) << 12] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    def marked(batches):
        for batch in batches:
            slot = batch.column("_slot").to_numpy(zero_copy_only=False)
            keep = (shared.value[slot >> 3] >> (slot & 7) & 1).astype(bool)
            yield batch.drop_columns(["_slot"]).filter(pa.array(keep))

    slot = F.pmod(F.xxhash64(col), F.lit(slots)).alias("_slot")
    return rows.select("*", slot).mapInArrow(marked, rows.schema)


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One large-star or small-star step over edges (u > v)."""
    if small:
        near = edges
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = near.join(low, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
    else:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = near.join(low, "u").where("v > u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every child has one parent, and no parent is a child."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up > 0 and down > 0)").limit(1).count() == 0


#: Links that one task merges by union-find: 16 bytes each, and about 200 a node while it runs.
TASK_LINKS = 1_000_000


def _union(batches):
    """(node, component) of a stream of links."""
    parent: dict[int, int] = {}

    def root(x):
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(parent.setdefault(u, u)), root(parent.setdefault(v, v))
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "component"]
    )


def components(links: DataFrame, a: str = "a", b: str = "b", task_links: int = TASK_LINKS) -> DataFrame:
    """(node, component) of the nodes of ``links``: the smallest node that links reach.

    Up to ``task_links`` links are one task's union-find. More links go by
    alternating large-star and small-star steps on the edge table until every
    component is a star; each is a minimum per node (combined before the
    shuffle) joined back to the edges, a join that adaptive execution can split
    where a node has very many edges. Each round's edges are written to the
    shared folder. Null ends are ignored.
    """
    edges = materialize(
        links.where(f"{a} is not null and {b} is not null and {a} <> {b}")
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    if edges.count() <= task_links:
        return materialize(edges.repartition(1).mapInArrow(_union, "node long, component long"))
    while not _is_stars(edges):
        edges = materialize(_star(_star(edges, small=False), small=True))
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
