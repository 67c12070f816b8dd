"""Vector searches against brute force."""

import math

import numpy as np
import pytest

from helixframe.llm import vectors


def table(spark, data):
    return spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding")


def brute(rows, every, k, score, ok):
    rows = [(i, v) for i, v in rows if i is not None and v is not None and ok(v)]
    out = []
    for q, x in rows:
        if q % every == 0:
            found = sorted(((-score(x, y), i) for i, y in rows if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def finite(v):
    return all(x is not None and math.isfinite(x) for x in v)


def whole(x, y):
    f = lambda v: [math.floor(1024 * float(a)) for a in v]
    return sum(a * b for a, b in zip(f(x), f(y), strict=True))


def cosine(x, y):
    x, y = np.array(x, float), np.array(y, float)
    return float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)))


ODD = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-1.0, 0.5]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
       (6, [float("inf"), 1.0]), (7, [0.0, 0.0]), (200, [0.0, 0.0]), (None, [1.0, 1.0]), (8, [3e20, -2e20]), (9, [1.0, 2.0, 3.0])]


@pytest.mark.parametrize("shards", [8192, 37])
def test_exact(spark, data, shards):
    rows = table(spark, data)
    got = sorted(tuple(r) for r in vectors.exact_top_k(rows, shard_rows=shards, query_rows=2).collect())
    assert got == brute([tuple(r) for r in rows.collect()], 100, 10, whole, finite)


def test_exact_odd(spark):
    rows = spark.createDataFrame(ODD, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.exact_top_k(rows).collect())
    want = brute([r for r in ODD if r[1] is None or len(r[1]) == 2], 100, 10, whole, finite)
    assert got == [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in want]
    assert vectors.exact_top_k(rows.limit(0)).collect() == []


def test_nearest_recall(spark):
    rows = table(spark, "/root/testdata/sf0.1")
    got = [tuple(r) for r in vectors.nearest(rows).collect()]
    x = [tuple(r) for r in rows.collect()]
    ids = np.array([i for i, _ in x])
    u = np.array([v for _, v in x], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = want = 0
    found = {}
    for q, _, i, s in got:
        found.setdefault(q, {})[i] = s
    for row in np.flatnonzero(ids % 50 == 0):
        score = u @ u[row]
        score[row] = -2
        best = np.lexsort((ids, -score))[:5]
        want += 5
        hit += sum(int(ids[b]) in found[int(ids[row])] for b in best)
        for i, s in found[int(ids[row])].items():
            assert abs(s - score[np.flatnonzero(ids == i)[0]]) < 1e-9
    assert hit >= 0.9 * want


def test_nearest_odd_and_blocks(spark):
    rng = np.random.default_rng(0)
    same = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300)]
    other = [(i, rng.normal(size=3).tolist()) for i in range(300, 400)]
    rows = spark.createDataFrame(same + other, "vec_id long, embedding array<double>")
    got = sorted((q, r, i) for q, r, i, _ in vectors.nearest(rows, block_rows=16, probes=99).collect())
    want = sorted((q, r, i) for q, r, i, _ in brute(same + other, 50, 5, lambda a, b: round(cosine(a, b), 12), finite))
    assert got == want
    odd = spark.createDataFrame(ODD, "vec_id long, embedding array<double>")
    got = vectors.nearest(odd).collect()
    assert {r.query_id for r in got} == {0, 100} and {r.vec_id for r in got} == {0, 1, 2, 8, 100}
    assert vectors.nearest(odd.limit(0)).collect() == []


def test_nearest_without_structure(spark):
    # Wide vectors without clusters: near ones are in any list, and short codes tell little of them.
    x = np.random.default_rng(3).normal(size=(3000, 256))
    rows = list(enumerate(x.tolist()))
    got = sorted((q, r, i) for q, r, i, _ in vectors.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=500).collect())
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = []
    for q in range(0, 3000, 50):
        score = u @ u[q]
        score[q] = -2
        want += [(q, r + 1, int(i)) for r, i in enumerate(np.argsort(-score, kind="stable")[:5])]
    assert got == want
