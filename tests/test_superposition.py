"""Paths, alignments of traces, and complexes with assigned chains against plain tables and all assignments."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import alignments, refinement
from helixframe.operators import superposition as S


def walk(n, seed):
    """A trace with steps of 3.8 that bend like a chain."""
    d = np.random.default_rng(seed).normal(size=(n, 3))
    for i in range(1, n):
        d[i] = 0.7 * d[i - 1] / np.linalg.norm(d[i - 1]) + 0.5 * d[i]
    return np.cumsum(3.8 * d / np.linalg.norm(d, axis=1)[:, None], 0)


def turn(seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(3, 3)))
    return q * np.sign(np.linalg.det(q))


def plain(score, opened, grown):
    """The best total of a table with three states, cell by cell."""
    n, m = score.shape
    pair, rows, columns = (np.full((n + 1, m + 1), -1e18) for _ in range(3))
    best = 0.0
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            pair[i, j] = score[i - 1, j - 1] + max(0, pair[i - 1, j - 1], rows[i - 1, j - 1], columns[i - 1, j - 1])
            rows[i, j] = max(pair[i - 1, j] + opened, rows[i - 1, j] + grown)
            columns[i, j] = max(pair[i, j - 1] + opened, rows[i, j - 1] + opened, columns[i, j - 1] + grown)
            best = max(best, pair[i, j])
    return best


def worth(score, path, opened, grown):
    total, last = 0.0, None
    for i, j in enumerate(path.tolist()):
        if j < 0:
            continue
        total += score[i, j]
        for skipped in (i - last[0] - 1, j - last[1] - 1) if last else ():
            assert skipped >= 0
            total += opened + grown * (skipped - 1) if skipped else 0.0
        last = (i, j)
    return total


def test_paths_equal_a_plain_table():
    """1,000 random tables, batched: totals, and what the returned paths are worth."""
    rng = np.random.default_rng(0)
    for k in range(50):
        n, m = rng.integers(1, 14, 2)
        opened, grown = -1.2 * rng.random(), -0.3 * rng.random() * (k % 2)
        score = rng.random((20, n, m)) - 0.3 * (k % 3 == 0)
        paths, totals = S.best_paths(score, opened=opened, grown=grown)
        for one, path, total in zip(score, paths, totals, strict=True):
            assert abs(plain(one, opened, grown) - total) < 1e-9 and abs(worth(one, path, opened, grown) - total) < 1e-9


def test_banded_paths():
    """A band that moves along gives what the table without the cells outside of it gives."""
    rng = np.random.default_rng(1)
    for _ in range(40):
        n, m, w = 12, 15, 6
        low = np.minimum(np.cumsum(rng.integers(0, 3, n)), m - w)
        score = rng.random((1, n, w))
        whole = np.full((n, m), -1e9)
        for i in range(n):
            whole[i, low[i] : low[i] + w] = score[0, i]
        paths, totals = S.best_paths(score, low[None], -0.5, -0.1)
        # Gaps may run through cells outside of a band that is narrow; then the band's total is smaller.
        assert totals[0] <= plain(whole, -0.5, -0.1) + 1e-9 and abs(worth(whole, paths[0], -0.5, -0.1) - totals[0]) < 1e-9
    full = rng.random((1, 9, 9))
    assert S.best_paths(full, np.zeros((1, 9), int), -0.5, -0.1)[1] == S.best_paths(full, None, -0.5, -0.1)[1]


def test_alignment_finds_insertions_and_deletions():
    a = walk(120, 1)
    b = np.concatenate([a[:40], a[50:90], walk(8, 5) + a[90], a[90:]]) @ turn(2) + 5
    found = S.align_many([(a, b), (a, walk(100, 9)), (a[:2], a), (b, a)])
    assert found[0]["aligned_length"] >= 105 and found[0]["tm_score_query"] > 0.85 and found[3]["tm_score_target"] > 0.85
    assert found[1]["tm_score_query"] < 0.4 and found[2]["aligned_length"] == 0
    match = S.matches([(a, b)])[0]
    assert (match[:38] == np.arange(38)).all() and (match[52:88] == np.arange(42, 78)).all()
    assert np.array_equal(refinement.trace_rows([a.ravel().tolist()], [b.ravel().tolist(), walk(100, 9).ravel().tolist(), []]), [[True], [False], [False]])


def test_long_traces_go_by_a_band():
    a = walk(900, 4)
    found = S.align_many([(a, np.delete(a, slice(300, 320), 0) @ turn(3))])[0]
    assert found["aligned_length"] >= 875 and found["tm_score_query"] > 0.95


def test_assignment_equals_all_permutations():
    rng = np.random.default_rng(6)
    for n, m in [(1, 1), (2, 4), (4, 2), (4, 4), (3, 5), (5, 5)] * 6:
        value = rng.random((n, m)).round(1)
        got = S.assignment(value)
        small = value if n <= m else value.T
        best = max(sum(small[i, p[i]] for i in range(len(small))) for p in itertools.permutations(range(small.shape[1]), len(small)))
        assert abs(sum(value[i, j] for i, j in enumerate(got) if j >= 0) - best) < 1e-9
        assert len({j for j in got.tolist() if j >= 0}) == min(n, m)


def by_all_assignments(first, second):
    """The best score by the shorter structure over all assignments of chains, each with its chains' own paths."""
    small, large = sorted((first, second), key=len)
    n = min(sum(map(len, first)), sum(map(len, second)))
    paths = {(i, j): S.matches([(small[i], large[j])])[0] for i in range(len(small)) for j in range(len(large))}
    best = 0.0
    for p in itertools.permutations(range(len(large)), len(small)):
        both = [(small[i][paths[i, j] >= 0], large[j][paths[i, j][paths[i, j] >= 0]]) for i, j in enumerate(p)]
        x, y = (np.concatenate([b[k] for b in both]) for k in (0, 1))
        best = max(best, float(S.fitted(x[None], y[None], np.ones((1, len(x)), bool), np.array([S.scale(n)]))[0][0] / n))
    return best


@pytest.mark.parametrize("count", [2, 3, 4])
def test_complexes_equal_all_assignments(count):
    rng = np.random.default_rng(count)
    first = [walk(int(rng.integers(30, 60)), 10 * count + k) + 25 * rng.normal(size=3) for k in range(count)]
    for missing, noise, move in ((0, 0.0, 0.0), (0, 0.6, 0.0), (1, 0.4, 0.0), (0, 0.3, 4.0)):
        second = [(p + move * rng.normal(size=3) + noise * rng.normal(size=p.shape)) @ turn(3) + 7 for p in first][missing:]
        scores = set()
        orders = list(itertools.permutations(range(len(second))))
        for order in orders[:: -(-len(orders) // 4)]:
            found = S.align_complex(first, [second[k] for k in order])
            scores.add((found["tm_score_query"], found["tm_score_target"]))
            assert sorted(order[j] + missing for _, j in found["chains"]) == sorted(i for i, _ in found["chains"]) and all(i == order[j] + missing for i, j in found["chains"])
        assert len(scores) == 1 and max(scores.pop()) >= by_all_assignments(first, second) - 0.01


def test_complexes_of_equal_chains():
    """Copies of one chain at other places: only an assignment that keeps the arrangement scores one."""
    base = walk(40, 3) - walk(40, 3).mean(0)
    spots = np.array([[0, 0, 0], [40, 0, 0], [0, 60, 0], [0, 0, 90.0]])
    first = [base @ turn(k) + x for k, x in enumerate(spots)]
    for order in ([0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]):
        found = S.align_complex(first, [first[k] @ turn(9) - 3 for k in order])
        assert found["tm_score_query"] == 1.0 and sorted(found["chains"]) == [(i, order.index(i)) for i in range(4)]
    assert S.align_complex(first, [])["aligned_length"] == 0 and S.align_complex([base[:2]], first)["chains"] == []
    assert refinement.complex_rows([[p.ravel().tolist() for p in first]], [[first[k].ravel().tolist() for k in (2, 0, 3, 1)], []]).tolist() == [[True], [False]]


def test_swapped_complexes_share_a_cluster(spark):
    """Observations of one signature whose chains come in another order are one cluster; another arrangement is not."""
    one, two = walk(40, 1), walk(50, 2) + 30
    flat = lambda *parts: [p.ravel().tolist() for p in parts]
    shapes = spark.createDataFrame([("a", flat(one, two)), ("b", flat(two @ turn(4), one @ turn(4))), ("c", flat(walk(40, 7), walk(50, 8) - 20))], "observation_id string, parts array<array<double>>")
    rows = spark.createDataFrame([(k, "sig", 10.0 - n, 1, 1) for n, k in enumerate("abc")], "observation_id string, signature_key string, buried_area double, num_atom_contacts int, num_residue_contacts int")
    out, warned = refinement.refined(rows, shapes, "dimers")
    assert {r.observation_id: (r.cluster_id, r.representative_id) for r in out.collect()} == {"a": ("dim_1_1", "a"), "b": ("dim_1_1", "a"), "c": ("dim_1_2", "c")}
    assert warned.count() == 0


def test_tables_of_pairs(spark):
    a, b = walk(40, 1), walk(30, 2) + 20
    flat = lambda *parts: [p.ravel().tolist() for p in parts]
    pairs = spark.createDataFrame([(1, flat(a, b), flat(b @ turn(5), a @ turn(5))), (2, flat(a), None), (3, flat(a[:2]), flat(a)), (4, flat(a), [[1.0]])], "id int, parts_query array<array<double>>, parts_target array<array<double>>")
    got = {r.id: r for r in alignments.aligned_complexes(pairs).withColumn("n", F.size("chains")).collect()}
    assert got[1].tm_score_query == 1.0 and [tuple(x) for x in got[1].chains] == [(0, 1), (1, 0)] and got[1].error is None
    assert "TypeError" in got[2].error and got[3].error == "fewer than three residues" and "ValueError" in got[4].error and got[4].n == 0


# Registered queries


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    """A folder with the first vectors of the small table."""
    folder = tmp_path_factory.mktemp("vectors")
    spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("vec_id < 130").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_complex_query(spark, vectors):
    """Each complex against itself with its chains in another order and one of them replaced."""
    from helixframe.plans import structural

    rows = {r.case: r for r in structural.complex_alignments(spark, vectors).collect()}
    assert len(rows) == spark.read.parquet(f"{vectors}/embeddings.parquet").selectExpr("floor(vec_id / 4)").distinct().count() and not any(r.error for r in rows.values())
    pairs = {r.case: r for r in structural._complexes(spark, vectors).collect()}
    shaped = lambda parts: [np.asarray(p, float).reshape(-1, 3) for p in parts]
    for k, r in rows.items():
        full = len(pairs[k].parts_query) == 4
        assert not full or (r.tm_score_query >= 0.74 and {(1, 0), (2, 1), (3, 2)} <= {tuple(map(int, x.split("-"))) for x in r.chains.split(",")})
    for k in sorted(rows)[:6]:
        assert rows[k].tm_score_query >= by_all_assignments(shaped(pairs[k].parts_query), shaped(pairs[k].parts_target)) - 0.01


def test_structure_cluster_query(spark, vectors):
    """Leaders of one bucket by a plain loop over its members in order of quality."""
    from helixframe.plans import structural

    got = {r.member_monomer_id: r for r in structural.structure_clusters(spark, vectors).collect()}
    rows = structural._monomers(spark, vectors).collect()
    assert len(got) == len(rows)
    bucket = min(r.sequence_cluster_id for r in rows)
    own = sorted((r for r in rows if r.sequence_cluster_id == bucket), key=lambda r: (r.method_priority, r.resolution, -r.resolved_fraction, r.monomer_id))
    leaders: list = []
    for r in own:
        trace = np.asarray(r.trace, float).reshape(-1, 3)
        found = S.align_many([(t, trace) for _, t in leaders])
        hits = [x for (x, t), f in zip(leaders, found, strict=True) if np.array_equal(t, trace) or refinement.accepts(f)]
        if not hits:
            leaders.append((r.monomer_id, trace))
        assert got[r.monomer_id].representative_monomer_id == (hits[0] if hits else r.monomer_id)
    assert 1 < len(leaders) < len(own)


def test_alone_as_in_batches():
    """An alignment does not hang on the pairs or complexes of its batch."""
    rng = np.random.default_rng(5)
    cloud = lambda n: rng.normal(0, 2.5, (n, 3))
    pairs = [(cloud(n), cloud(m)) for n, m in zip(rng.integers(15, 24, 60), rng.integers(15, 24, 60), strict=True)]
    assert S.align_many(pairs) == [S.align_many([p])[0] for p in pairs]
    complexes = [([walk(20 + k, 3 * k + j) for j in range(3)], [walk(20 + k, 3 * k + j) @ kabsch_turn(k) + 7 for j in (1, 2, 0)]) for k in range(4)]
    together = S.align_complexes(complexes)
    assert together == [S.align_complex(*c) for c in complexes]
    assert all(sorted(x["chains"]) == [(0, 2), (1, 0), (2, 1)] and x["tm_score_query"] > 0.99 for x in together)


def kabsch_turn(seed: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(3, 3)))
    return q if np.linalg.det(q) > 0 else -q


def test_leaders_are_dealt(spark):
    """Buckets of a dear comparison go to several tasks, and get the leaders of a plain loop."""
    from pyspark.sql import functions as F

    from helixframe.operators.clustering import leader_clusters

    def near(pairs):
        return [a[1] == 0 and abs(a[0] - b[0]) < 3 for a, b in pairs]

    rows = [(f"b{k % 16}", k, [float(k * 37 % 11), 0.0]) for k in range(320)]
    df = spark.createDataFrame(rows, "bucket string, id long, p array<double>")
    for size in (512, 7):
        got = leader_clusters(df, "bucket", "id", ["id"], "p", lambda a, b: np.array([near([(x, y) for x in a]) for y in b], bool).reshape(len(b), len(a)), lead_rows=size, pairs=near)
        found = {r.id: r.leader for r in got.collect()}
        want: dict = {}
        for b in range(16):
            leaders: list = []
            for _, k, p in (r for r in rows if r[0] == f"b{b}"):
                hit = [j for j, q in leaders if near([(q, p)])[0]]
                want[k] = hit[0] if hit else k
                if not hit:
                    leaders.append((k, p))
        assert found == want and len(got.collect()) == 320
    files = leader_clusters(df, "bucket", "id", ["id"], "p", lambda a, b: np.array([near([(x, y) for x in a]) for y in b], bool).reshape(len(b), len(a)), pairs=near).select(F.input_file_name().alias("f")).where("f like '%/part-%'").distinct().count()
    # One file a task that led something, with four tasks.
    assert files > 1


def test_wrong_complex_of_a_batch(spark):
    """A complex that cannot be aligned has its error; the others of its batch their alignments."""
    parts = [[x for p in [walk(20, k)] for x in p.ravel().tolist()] for k in range(2)]
    rows = [(0, parts, parts[::-1]), (1, [[float("nan")] * 60], parts), (2, parts, [[1.0, 2.0]]), (3, parts, parts)]
    df = spark.createDataFrame(rows, "k long, parts_query array<array<double>>, parts_target array<array<double>>").coalesce(1)
    got = {r.k: r for r in alignments.aligned_complexes(df).collect()}
    assert got[0].chains == [(0, 1), (1, 0)] and got[3].chains == [(0, 0), (1, 1)] and not got[0].error and not got[3].error
    assert "not finite" in got[1].error and "ValueError" in got[2].error and got[1].aligned_length is None
