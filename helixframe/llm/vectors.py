"""Vector search: exact top-k by tiled products, and an inverted file with product-quantised residuals.

Both searches pack rows into blocks (one row of a few MB each), pair every
query block with the blocks it has to see, take the best of each tile in numpy
and merge the tiles' lists per query in two rounds. Nothing is collected but
bounded samples for fitting; blocks are made by salted keys, so equal vectors
or one crowded inverted list spread over many blocks.

Edge cases: vectors that are null or hold null or non-finite components (and
for cosines zero vectors) are neither queries nor candidates, as are rows with
null ids; vectors of another width than most are left out; equal scores go to
the smaller id; vectors of any width are held a block at a time; rows that
repeat an id count as rows of their own, except that a query never meets rows of
its own id; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm._shared import materialize

BLOCK = "key long, ids binary, vectors binary"


def usable(rows: DataFrame, id_col: str, vec_col: str, nonzero: bool) -> DataFrame:
    """(id, v) of the rows that take part; components as doubles."""
    v = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    ok = v.isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad)
    if nonzero:
        ok &= F.exists(v, lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), ok.alias("ok")).where("ok").drop("ok")


def width_of(rows: DataFrame) -> int:
    """The most common number of components (the smaller of equally common ones)."""
    r = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return r["w"] if r else 0


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def blocks(rows: DataFrame, key: str, width: int, dtype: str) -> DataFrame:
    """One row for each key: the ids in order, and their vectors."""

    def packed(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        v = _matrix(table.column("v"), width)[order].astype(dtype)
        return pa.table(
            {"key": pa.array([table.column("key")[0].as_py()], pa.int64()), "ids": [ids[order].tobytes()], "vectors": [v.tobytes()]}
        )

    return rows.select(F.col(key).cast("long").alias("key"), "id", "v").groupBy("key").applyInArrow(packed, BLOCK)


def merge_best(found: DataFrame, k: int, parts: int, score: str, *also: str) -> DataFrame:
    """The k best rows of each query by score, then smaller id (and further columns); in two rounds over groups of tiles."""
    near = Window.partitionBy("query_id", "part").orderBy(F.desc(score), "vec_id", *also)
    last = Window.partitionBy("query_id").orderBy(F.desc(score), "vec_id", *also)
    split = max(1, math.isqrt(parts))
    return (
        found.withColumn("part", F.pmod("tile", F.lit(split)))
        .withColumn("r", F.row_number().over(near))
        .where(F.col("r") <= k)
        .withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score, *also)
    )


def best_of_tile(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores of each row, ties to smaller ids; ids are in ascending order."""
    n = scores.shape[1]
    if n <= k:
        return np.argsort(-scores, axis=1, kind="stable")
    kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above = scores > kth
    rank = np.cumsum(scores == kth, axis=1, dtype=np.int32)
    take = above | ((scores == kth) & (rank <= (k - above.sum(axis=1))[:, None]))
    cols = np.nonzero(take)[1].reshape(-1, k)
    order = np.argsort(-np.take_along_axis(scores, cols, 1), axis=1, kind="stable")
    return np.take_along_axis(cols, order, 1)


# Exact search


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products of integral doubles, saturated to 64 bits."""
    bound = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, q.shape[1])
    if bound < 2.0**53:
        return (q @ v.T).astype(np.int64)
    if bound < 2.0**62:
        return q.astype(np.int64) @ v.astype(np.int64).T
    big = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in v], object).T
    return np.clip(big, -(2**63), 2**63 - 1).astype(np.int64)


def exact_top_k(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    every: int = 100,
    k: int = 10,
    scale: float = 1024.0,
    shard_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """The k largest integer inner products of each query with all other rows.

    Components are floor(scale * x); queries are the rows whose id is divisible
    by ``every``. Query blocks are dealt to every shard by an equi-join on the
    shard number: the number of tiles is blocks times shards, and each tile
    yields at most k rows per query.
    """
    v = usable(rows, id_col, vec_col, nonzero=False)
    width = width_of(v)
    v = v.where(F.size("v") == width).withColumn("v", F.transform("v", lambda x: _floor(x, scale)))
    n = v.count()
    shards = max(1, -(-n // shard_rows))
    base = v.withColumn("key", F.pmod(F.xxhash64("id"), F.lit(shards)))
    queries = v.where(F.col("id") % every == 0)
    deal = max(1, -(-(n // every + 1) // query_rows))
    q = blocks(queries.withColumn("key", F.pmod(F.xxhash64("id"), F.lit(deal))), "key", width, "f8")
    q = q.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("key"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    tiles = blocks(base, "key", width, "f8").join(q, "key")

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                x = np.frombuffer(row["vectors"], "f8").reshape(len(ids), width)
                y = np.frombuffer(row["q_vectors"], "f8").reshape(len(q_ids), width)
                for lo in range(0, len(y), 256):
                    part, own = y[lo : lo + 256], q_ids[lo : lo + 256]
                    score = _products(part, x)
                    top = best_of_tile(score, ids, k + 1) if len(np.unique(ids)) == len(ids) else best_of_tile(np.where(own[:, None] == ids, np.iinfo(np.int64).min, score), ids, k)
                    who = ids[top]
                    keep = who != own[:, None]
                    keep &= np.cumsum(keep, axis=1) <= k
                    yield _found(row["key"], own, who, np.take_along_axis(score, top, 1), keep, pa.int64())

    found = tiles.mapInArrow(search, "tile long, query_id long, vec_id long, score long")
    return merge_best(found, k, shards, "score")


def _floor(x, scale: float):
    """floor(scale * x) as a double; doubles beyond 2**52 are whole already."""
    y = x * F.lit(scale)
    return F.when(F.abs(y) < 2.0**52, F.floor(y).cast("double")).otherwise(y)


def _found(tile: int, own, who, score, keep, kind) -> pa.RecordBatch:
    q = np.repeat(own, keep.sum(axis=1))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(q), tile)), pa.array(q), pa.array(who[keep]), pa.array(score[keep], kind)],
        names=["tile", "query_id", "vec_id", "score"],
    )


# Inverted file with product-quantised residuals


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's centroids from a k-means++ like start; empty cells restart at the farthest rows."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        d = (c**2).sum(1) - 2 * x @ c.T
        near = d.argmin(1)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        full = count > 0
        c[full] = total[full] / count[full, None]
        if not full.all():
            far = np.argsort(-(d.min(1) + (x**2).sum(1)), kind="stable")[: (~full).sum()]
            c[~full] = x[far]
    return c


class IvfPq:
    """Coarse centroids, and codebooks of their residuals by subspace, of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int, codes: int, seed: int = 7):
        x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.coarse = kmeans(x, lists, 12, seed)
        self.parts = np.array_split(np.arange(x.shape[1]), min(parts, x.shape[1]))
        rest = x - self.coarse[self.near(x, 1)[:, 0]]
        self.books = [kmeans(rest[:, p], codes, 10, seed + 1 + i) for i, p in enumerate(self.parts)]

    def near(self, x: np.ndarray, n: int) -> np.ndarray:
        d = (self.coarse**2).sum(1) - 2 * x @ self.coarse.T
        return np.argsort(d, axis=1, kind="stable")[:, :n]

    def far(self, x: np.ndarray) -> np.ndarray:
        """Distances to all centroids."""
        return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (self.coarse**2).sum(1) - 2 * x @ self.coarse.T))

    def encode(self, rest: np.ndarray) -> np.ndarray:
        return np.stack(
            [((b**2).sum(1) - 2 * rest[:, p] @ b.T).argmin(1) for p, b in zip(self.parts, self.books, strict=True)], 1
        ).astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], 1)

    def tables(self, rest: np.ndarray) -> list[np.ndarray]:
        """Squared distances of query residuals to every code, by subspace."""
        return [
            ((rest[:, p] ** 2).sum(1)[:, None] + (b**2).sum(1) - 2 * rest[:, p] @ b.T)
            for p, b in zip(self.parts, self.books, strict=True)
        ]


CODED = "key long, ids binary, lists binary, codes binary, errors binary, vectors binary"
ASKED = "key long, part long, q_ids binary, q_vectors binary, within binary, visits array<binary>"
#: What rounding may add to a distance of unit vectors, or take from a cosine.
FAR_SLACK, SCORE_SLACK = 1e-6, 1e-9


def _even(x: np.ndarray) -> np.ndarray:
    """Rows by a power of two of their own, which changes no cosine, so that no product overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _even(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _few_copies(vectors: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the k best of a query: of equal vectors those of smallest ids; whatever id a query leaves out, k stay."""
    def place(sorted_keys: np.ndarray) -> np.ndarray:
        first = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
        return np.arange(len(first)) - np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))

    vectors = vectors + 0.0  # no negative zeros
    same = np.unique(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    order = np.lexsort((ids, same))
    own = np.unique(np.stack([same[order], ids[order]], 1), axis=0, return_inverse=True)[1].ravel()
    order = order[place(own) < k]
    return np.sort(order[place(same[order]) < 2 * k])


def nearest(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    sample_rows: int = 16384,
    lists: int | None = None,
    probes: int | None = None,
    parts: int = 16,
    block_rows: int = 16384,
    query_rows: int = 2048,
    bound_rows: int = 2048,
) -> DataFrame:
    """The k nearest rows by cosine of each query (ids divisible by ``every``) in an inverted file.

    The index is fitted on at most ``sample_rows`` rows (those of smallest id
    hash); every row is indexed, as its list, a byte for each of ``parts``
    subspaces, and how far its code is from it. A query visits each list that
    may hold a row as near as its k-th nearest of ``bound_rows`` rows of the
    sample (by the list's centre and radius), or with ``probes`` only its so
    many nearest lists. There, asymmetric distances less and plus a row's own
    error bound its distance: rows that may be among the k nearest, however
    many, are scored exactly on their original vectors, in double precision. So
    without ``probes`` no near row is lost, whatever the rows look like. A list
    that holds many rows is many blocks.
    """
    v = usable(rows, id_col, vec_col, nonzero=True)
    width = width_of(v)
    v = materialize(v.where(F.size("v") == width))
    n = v.count()
    if not n:
        return v.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = v.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toPandas()
    x = np.array(sample["v"].tolist(), np.float64)
    lists = lists or int(min(4096, max(1, round(n**0.5 / 2))))
    model = IvfPq(_unit(x), lists, parts, 256)
    lists = len(model.coarse)
    probes = min(lists, probes or lists)
    block_rows = max(1, min(block_rows, (1 << 20) // width))
    # At most 4096 + 256 + ``bound_rows`` rows of one vector's width.
    shared = v.sparkSession.sparkContext.broadcast((model, sample["id"].to_numpy(np.int64)[:bound_rows], _unit(x[:bound_rows])))

    def encode(batches):
        m = shared.value[0]
        for batch in batches:
            x = _unit(_matrix(batch.column("v"), width))
            own = m.near(x, 1)[:, 0]
            rest = x - m.coarse[own]
            codes = m.encode(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(own.astype(np.int64)), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(np.linalg.norm(rest, axis=1)), pa.array(np.linalg.norm(rest - m.decode(codes), axis=1))],
                names=["id", "v", "list", "codes", "off", "error"],
            )

    index = materialize(v.mapInArrow(encode, "id long, v array<double>, list long, codes binary, off double, error double"))
    found = index.groupBy("list").agg(F.count("*").alias("n"), F.max("off").alias("off")).collect()  # two numbers for each of at most 4096 lists
    sizes = {r["list"]: r["n"] for r in found}
    radius = np.full(lists, -np.inf)
    radius[[r["list"] for r in found]] = [r["off"] for r in found]
    ends = np.cumsum([sizes.get(i, 0) for i in range(lists)])
    # Lists follow one another in blocks of about ``block_rows`` rows; a list over several deals its rows to them.
    first = np.concatenate([[0], ends[:-1]]) // block_rows
    last = np.maximum(first, (ends - 1) // block_rows)
    total = int(last.max()) + 1
    table = v.sparkSession.createDataFrame([(i, int(first[i]), int(last[i] - first[i] + 1)) for i in sizes], "list long, first long, salts long")

    def packed(batch: pa.Table) -> pa.Table:
        ids, own, error = (batch.column(c).to_numpy() for c in ("id", "list", "error"))
        x = _even(_matrix(batch.column("v"), width))
        kept = _few_copies(x, ids, k)
        order = kept[np.lexsort((ids[kept], own[kept]))]
        codes = batch.column("codes").to_pylist()
        return pa.table({
            "key": batch.column("key")[:1], "ids": [ids[order].tobytes()], "lists": [own[order].tobytes()], "codes": [b"".join(codes[i] for i in order.tolist())],
            "errors": [error[order].tobytes()], "vectors": [x[order].tobytes()],
        })

    coded = index.join(F.broadcast(table), "list").withColumn("key", F.col("first") + F.pmod(F.xxhash64("id"), "salts"))
    coded = coded.select("key", "id", "v", "list", "codes", "error").groupBy("key").applyInArrow(packed, CODED)

    def visits(batches):
        m, known_ids, known = shared.value
        for batch in batches:
            y, ids = _unit(_matrix(batch.column("v"), width)), batch.column("id").to_numpy()
            far = m.far(y)
            # As far as the k-th nearest row of the sample is, further rows need no look.
            within = np.full(len(y), np.inf)
            if len(known) >= k:
                score = y @ known.T
                score[ids[:, None] == known_ids] = -np.inf
                least = np.partition(score, len(known) - k, axis=1)[:, len(known) - k]
                within = np.sqrt(np.maximum(0, 2 - 2 * least)) + FAR_SLACK
            may = far - radius <= within[:, None] + FAR_SLACK
            if probes < lists:
                near = np.zeros_like(may)
                np.put_along_axis(near, np.argsort(far, axis=1, kind="stable")[:, :probes], True, 1)
                may &= near
            at, keys, chosen = [], [], []
            for i, row in enumerate(may):
                blocks: dict[int, list[int]] = {}
                for one in np.flatnonzero(row).tolist():
                    for key in range(first[one], last[one] + 1) if one in sizes else ():
                        blocks.setdefault(key, []).append(one)
                at += [i] * len(blocks)
                keys += blocks
                chosen += [np.array(x, np.int64).tobytes() for x in blocks.values()]
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column("part").take(at), batch.column("id").take(at), batch.column("v").take(at), pa.array(within).take(at), pa.array(chosen, pa.binary())],
                names=["key", "part", "id", "v", "within", "visits"],
            )

    def asked(batch: pa.Table) -> pa.Table:
        ids, within = batch.column("id").to_numpy(), batch.column("within").to_numpy()
        return pa.table({
            "key": batch.column("key")[:1], "part": batch.column("part")[:1], "q_ids": [ids.tobytes()], "q_vectors": [_even(_matrix(batch.column("v"), width)).tobytes()],
            "within": [within.tobytes()], "visits": pa.array([batch.column("visits").to_pylist()], pa.list_(pa.binary())),
        })

    queries = v.where(F.col("id") % every == 0)
    # Queries of a block come in groups, so that the block is not repeated for each.
    part = F.pmod(F.xxhash64("id"), F.lit(max(1, n // every // query_rows))).alias("part")
    each = queries.select(part, "id", "v").mapInArrow(visits, "key long, part long, id long, v array<double>, within double, visits binary")
    each = each.groupBy("key", "part").applyInArrow(asked, ASKED)

    def search(batches):
        m = shared.value[0]
        for batch in batches:
            for row in batch.to_pylist():
                ids, own, q_ids = (np.frombuffer(row[c], np.int64) for c in ("ids", "lists", "q_ids"))
                error, within = np.frombuffer(row["errors"], "f8"), np.frombuffer(row["within"], "f8")
                codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
                x, y = (np.frombuffer(row[c], "f8").reshape(-1, width) for c in ("vectors", "q_vectors"))
                u, x_norm, y_norm = _unit(x), np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
                starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                stops = np.append(starts[1:], len(own))
                place = {int(own[a]): (a, z) for a, z in zip(starts.tolist(), stops.tolist(), strict=True)}
                for lo in range(0, len(y), 64):
                    mine, some = q_ids[lo : lo + 64], _unit(y[lo : lo + 64])
                    far = np.full((len(mine), len(ids)), np.inf)
                    seen: dict[int, list[int]] = {}
                    for i, raw in enumerate(row["visits"][lo : lo + 64]):
                        for one in np.frombuffer(raw, np.int64).tolist():
                            seen.setdefault(one, []).append(i)
                    for one, who in seen.items():
                        if one in place:
                            a, z = place[one]
                            part = np.zeros((len(who), z - a))
                            for j, t in enumerate(m.tables(some[who] - m.coarse[one])):
                                part += t[:, codes[a:z, j]]
                            far[who, a:z] = np.sqrt(np.maximum(part, 0))
                    far[mine[:, None] == ids] = np.inf
                    limit = within[lo : lo + 64] + FAR_SLACK
                    if len(ids) > k:
                        limit = np.minimum(limit, np.partition(far + error, k - 1, axis=1)[:, k - 1] + FAR_SLACK)
                    may = np.isfinite(far) & (far - error <= limit[:, None])
                    score = np.where(may, some @ u.T, -np.inf)
                    if len(ids) > k:
                        may &= score >= np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k, None] - SCORE_SLACK
                    q, r = np.nonzero(may)
                    exact = np.empty(len(q))
                    for at in range(0, len(q), 1 << 16):
                        i, j = q[at : at + (1 << 16)] + lo, r[at : at + (1 << 16)]
                        exact[at : at + (1 << 16)] = np.einsum("ij,ij->i", x[j], y[i]) / (x_norm[j] * y_norm[i])
                    order = np.lexsort((ids[r], -exact, q))
                    head = np.searchsorted(q[order], np.arange(len(mine)))
                    order = order[np.arange(len(order)) - head[q[order]] < k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(order), row["key"])), pa.array(mine[q[order]]), pa.array(ids[r[order]]), pa.array(exact[order])],
                        names=["tile", "query_id", "vec_id", "score"],
                    )

    found = coded.join(each, "key").mapInArrow(search, "tile long, query_id long, vec_id long, score double")
    return merge_best(found, k, total, "score")
