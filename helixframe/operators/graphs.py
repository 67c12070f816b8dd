"""Graphs of interfaces: components, bridges, communities, greedy matching."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.operators.tables import written


def edge_table(rows: DataFrame, case: str, a: str, b: str, area: str, least: float, order: list) -> DataFrame:
    """G1: one undirected edge for each pair of a case with an area of ``least`` or more; the last in order wins."""
    kept = rows.where((F.col(area) >= least) & (F.col(a) != F.col(b)))
    ends = kept.withColumn("u", F.least(a, b)).withColumn("v", F.greatest(a, b))
    best = F.max_by(F.col(area), F.struct(*order)).alias("area")
    return ends.groupBy(case, "u", "v").agg(best).withColumn("weight", F.col("area") / 1000)


#: Edges of one case that a single task handles; larger cases go by rounds over tables.
TASK_EDGES = 1_000_000


def _by_size(edges: DataFrame, case: str, task_edges: int) -> tuple[DataFrame, DataFrame | None]:
    """Edges of cases that fit one task, and of those that do not (None where there are none); edges are made once."""
    edges = written(edges)
    large = edges.groupBy(case).count().where(F.col("count") > task_edges).select(case)
    if large.isEmpty():
        return edges, None
    large = written(large)
    return edges.join(large, case, "left_anti"), edges.join(large, case, "left_semi")


#: Rows of an answer that leave a task at once.
OUT_ROWS = 1 << 16


def in_turn(rows: DataFrame, keys: list[str], order: list[Column], one: Callable[[tuple, Iterator[tuple]], Iterable[tuple]], out: dict[str, str | pa.DataType], schema: str) -> DataFrame:
    """``one(key, rows)`` of each key in turn, whose rows come in order: partitions are sorted, so cases cost no call of their own and a task holds one at a time.

    ``rows`` gives tuples in the order of the table's columns, ``one`` gives
    tuples; ``out`` names their columns, each with its type or the column of the
    table that has this type.
    """
    place = [rows.columns.index(k) for k in keys]

    def run(batches):
        kinds: list = []
        held: list[tuple] = []

        def each():
            for batch in batches:
                kinds[:] = [batch.schema.field(k).type if isinstance(k, str) else k for k in out.values()]
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        def flush():
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=list(out))
            held.clear()
            return made

        for key, group in groupby(each(), itemgetter(*place)):
            # A case's answer leaves in parts as well.
            for row in one(key, group):
                held.append(row)
                if len(held) >= OUT_ROWS:
                    yield flush()
        if held:
            yield flush()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _sorting(rows: DataFrame, order: list[str], descending: list[bool]) -> list[Column]:
    """Columns to sort by; what is missing or no number comes last."""
    kinds = dict(rows.dtypes)
    known = [F.when(~F.isnan(c), F.col(c)) if kinds[c] in ("double", "float") else F.col(c) for c in order]
    return [c.desc_nulls_last() if d else c.asc_nulls_last() for c, d in zip(known, descending, strict=True)]


def case_components(edges: DataFrame, case: str, task_edges: int = TASK_EDGES) -> DataFrame:
    """(case, node, component) of each case's graph; graphs are local to their case."""

    def one(key, rows):
        return ((key, x, c) for x, c in components_of((u, v) for _, u, v in rows).items())

    kind, node = dict(edges.dtypes)[case], dict(edges.dtypes)["u"]
    small, large = _by_size(edges.select(case, "u", "v"), case, task_edges)
    out = in_turn(small, [case], [], one, {case: case, "node": "u", "component": "u"}, f"`{case}` {kind}, node {node}, component {node}")
    if large is None:
        return out
    end = lambda c: F.struct(F.col(case).alias("case"), F.col(c).alias("x"))
    links = large.select(end("u").alias("u"), end("v").alias("v"))
    found = components(links, links.select(F.col("u").alias("node")).union(links.select("v")).distinct())
    return out.unionByName(found.select(F.col("node.case").alias(case), F.col("node.x").alias("node"), F.col("component.x").alias("component")))


def components_of(edges) -> dict:
    """Least node that each node is connected with."""
    up: dict = {}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for u, v in edges:
        for x in (u, v):
            up.setdefault(x, x)
        a, b = root(u), root(v)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def bridges_of(adjacent: dict) -> set:
    """Edges (u < v) whose removal disconnects their ends, by depth-first low points."""
    order, low, found, clock = {}, {}, set(), 0
    for start in sorted(adjacent):
        if start in order:
            continue
        order[start] = low[start] = clock
        clock += 1
        stack = [(start, None, iter(sorted(adjacent[start])))]
        while stack:
            x, parent, rest = stack[-1]
            for y in rest:
                if y == parent:
                    continue
                if y in order:
                    low[x] = min(low[x], order[y])
                else:
                    order[y] = low[y] = clock
                    clock += 1
                    stack.append((y, x, iter(sorted(adjacent[y]))))
                    break
            else:
                stack.pop()
                if parent is not None:
                    low[parent] = min(low[parent], low[x])
                    if low[x] > order[parent]:
                        found.add((min(x, parent), max(x, parent)))
    return found


def pruned(weights: dict, least_members: int, from_size: int) -> dict:
    """Without the bridges of at most the upper median weight, in components larger than both limits."""
    label = components_of(weights)
    size = pd.Series(label).groupby(pd.Series(label)).size().to_dict() if label else {}
    adjacent: dict = defaultdict(set)
    by: dict = defaultdict(list)
    for (u, v), w in weights.items():
        adjacent[u].add(v)
        adjacent[v].add(u)
        by[label[u]].append(w)
    middle = {c: sorted(w)[len(w) // 2] for c, w in by.items()}
    cut = {e for e in bridges_of(adjacent) if size[label[e[0]]] > max(least_members, from_size) and weights[e] <= middle[label[e[0]]]}
    return {e: w for e, w in weights.items() if e not in cut}


def _bridges(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """Which edges of nodes by number are bridges, as ``bridges_of``, in flat arrays: some 50 bytes an edge in place of sets and tuples."""
    heads = np.concatenate([u, v])
    by = np.argsort(heads, kind="stable").astype(np.int32)
    first = array("i", np.searchsorted(heads[by], np.arange(nodes + 1)).astype(np.int32).tobytes())
    to, edge = array("i", np.concatenate([v, u])[by].tobytes()), array("i", (by % max(len(u), 1)).astype(np.int32).tobytes())
    del heads, by
    place, order, low, entered = array("i", first), array("i", [-1]) * nodes, array("i", [0]) * nodes, array("i", [-1]) * nodes
    found, clock = np.zeros(len(u), bool), 0
    for start in range(nodes):
        if order[start] >= 0:
            continue
        order[start] = low[start] = clock
        clock += 1
        stack = array("i", [start])
        while stack:
            x = stack[-1]
            k = place[x]
            if k < first[x + 1]:
                place[x] = k + 1
                y, e = to[k], edge[k]
                if e == entered[x]:
                    continue
                if order[y] < 0:
                    order[y] = low[y] = clock
                    clock += 1
                    entered[y] = e
                    stack.append(y)
                elif order[y] < low[x]:
                    low[x] = order[y]
            else:
                stack.pop()
                if stack:
                    parent = stack[-1]
                    low[parent] = min(low[parent], low[x])
                    found[entered[x]] = low[x] > order[parent]
    return found


def kept_edges(rows: Iterable[tuple], least_members: int, from_size: int) -> Iterator[tuple]:
    """``pruned`` of one component, whose distinct edges (u, v, weight) come in order of u and v."""
    number: dict = {}
    u, v, w = array("i"), array("i"), array("d")
    for a, b, weight in rows:
        for side, x in ((u, a), (v, b)):
            side.append(number.setdefault(x, len(number)))
        w.append(weight)
    ends, others, weights = np.frombuffer(u, np.int32), np.frombuffer(v, np.int32), np.frombuffer(w)
    keep = np.ones(len(w), bool)
    if len(number) > max(least_members, from_size):
        middle = np.partition(weights, len(w) // 2)[len(w) // 2]
        keep = ~(_bridges(ends, others, len(number)) & (weights <= middle))
    names = list(number)
    del number
    return ((names[u[k]], names[v[k]], w[k]) for k in range(len(w)) if keep[k])


def communities_of(weights: dict, resolution: float = 1.0, total: float | None = None) -> dict:
    """Communities by local moves and aggregation (Louvain), nodes in sorted order, so that runs agree.

    ``total`` is the weight of the whole graph where ``weights`` are some of its components only: moves never leave one.
    """
    member = {x: x for e in weights for x in e}
    graph: dict = defaultdict(lambda: defaultdict(float))
    for (u, v), w in weights.items():
        graph[u][v] += w
        graph[v][u] += w
    total = sum(weights.values()) if total is None else total
    while total:
        degree = {x: sum(n.values()) + n.get(x, 0.0) for x, n in graph.items()}
        home = {x: x for x in graph}
        mass = dict(degree)
        moved = changed = True
        improved = False
        while moved:
            moved = False
            for x in sorted(graph):
                links: dict = defaultdict(float)
                for y, w in graph[x].items():
                    if y != x:
                        links[home[y]] += w
                own = home[x]
                mass[own] -= degree[x]
                gain = lambda c: links.get(c, 0.0) - resolution * degree[x] * mass[c] / (2 * total)  # noqa: B023, E731
                best = max(sorted({own, *links}), key=lambda c: (gain(c) > gain(own) + 1e-12, gain(c), c == own))  # noqa: B023
                mass[best] += degree[x]
                if best != own:
                    home[x], moved, improved = best, True, True
        if not improved:
            break
        member = {x: home[c] for x, c in member.items()}
        merged: dict = defaultdict(lambda: defaultdict(float))
        for x, n in graph.items():
            for y, w in n.items():
                merged[home[x]][home[y]] += w / 2 if x != y and home[x] == home[y] else w
        graph, changed = merged, len(merged) < len(graph)
        if not changed:
            break
    least: dict = {}
    for x in sorted(member):
        least.setdefault(member[x], x)
    return {x: least[c] for x, c in member.items()}


def communities(edges: DataFrame, case: str, resolution: float = 1.0, least_members: int = 2, from_size: int = 8) -> DataFrame:
    """(case, node, community) after bridge pruning, with at least ``least_members`` nodes.

    Bridges, medians and moves are matters of one connected component, so these
    are the tasks; of the rest of its case a component needs the weight only.
    """
    kinds = dict(edges.dtypes)
    kind, node = kinds[case], kinds["u"]
    named = written(edges.select(F.col(case).alias("_case"), "u", "v", F.col("weight").cast("double").alias("weight")))
    label = case_components(named, "_case").select(F.col("_case").alias("_c"), F.col("node").alias("_x"), "component")
    parts = named.join(label, F.col("_case").eqNullSafe(F.col("_c")) & (F.col("u") == F.col("_x"))).select("_case", "component", "u", "v", "weight")

    def cut(key, rows):
        return ((*key, *edge) for edge in kept_edges((r[-3:] for r in rows), least_members, from_size))

    def one(key, rows):
        weights, whole = {}, None
        for *_, u, v, w, whole in rows:
            weights[u, v] = w
        found = communities_of(weights, resolution, whole)
        count: dict = defaultdict(int)
        for c in found.values():
            count[c] += 1
        return ((key[0], x, found[x]) for x in sorted(found) if count[found[x]] >= least_members)

    same = {c: c for c in parts.columns}
    keys, turns = ["_case", "component"], [F.col("u").asc(), F.col("v").asc()]
    left = written(in_turn(parts, keys, turns, cut, same, f"_case {kind}, component {node}, u {node}, v {node}, weight double"))
    total = left.groupBy(F.col("_case").alias("_c")).agg(F.sum("weight").alias("total"))
    whole = left.join(total, F.col("_case").eqNullSafe(F.col("_c"))).select(*left.columns, "total")
    return in_turn(whole, keys, turns, one, {case: "_case", "node": "u", "community": "u"}, f"`{case}` {kind}, node {node}, community {node}")


def _dominant(rows: DataFrame, case: str, a: str, b: str, order: list, sides: bool) -> DataFrame:
    """Greedy pairs by rounds: an edge that is the best one at both of its ends is taken, its ends' other edges go.

    With a strict order these are the pairs that taking the best remaining edge
    one by one gives, as an edge that is best at both ends is taken before any
    other edge could use an end up. With ``sides`` a and b are nodes apart.
    """
    ends = lambda r: [r.select(case, F.col("_k"), F.struct(F.lit(i if sides else 0).alias("s"), F.col(c).cast("string").alias("n")).alias("end")) for i, c in enumerate((a, b))]
    rest = written(rows.select(case, a, b, F.struct(*order, F.col(a).alias("_a"), F.col(b).alias("_b")).alias("_k")))
    done = None
    while not rest.isEmpty():
        one, two = ends(rest)
        best = one.unionByName(two).groupBy(case, "end").agg(F.min("_k").alias("_k"))
        taken = written(best.groupBy(case, "_k").count().where("count = 2").select(case, "_k"))
        pairs = rest.join(taken, [case, "_k"], "left_semi")
        done = pairs if done is None else done.unionByName(pairs)
        used = best.join(taken, [case, "_k"], "left_semi").select(case, "end")
        for i, c in enumerate((a, b)):
            rest = rest.withColumn("end", F.struct(F.lit(i if sides else 0).alias("s"), F.col(c).cast("string").alias("n"))).join(used, [case, "end"], "left_anti").drop("end")
        rest = written(rest)
    return done if done is not None else rest


def _order(order: list[str], descending: list[bool]) -> list:
    """Columns whose least struct is the first in order; numbers only are turned around."""
    return [(-F.col(c) if d else F.col(c)).alias(f"_o{i}") for i, (c, d) in enumerate(zip(order, descending, strict=True))]


def greedy_matching(rows: DataFrame, case: str, a: str, b: str, order: list[str], descending: list[bool], task_edges: int = TASK_EDGES) -> DataFrame:
    """In each case, the best remaining pair is taken until no pair of free members is left. Orders are of numbers."""

    def one(key, group):
        used_a, used_b, out = set(), set(), []
        for _, x, y, *_ in group:
            if x not in used_a and y not in used_b:
                used_a.add(x)
                used_b.add(y)
                out.append((key, x, y))
        return out

    t = dict(rows.dtypes)
    small, large = _by_size(rows.select(case, a, b, *order), case, task_edges)
    turns = _sorting(rows, [*order, a, b], [*descending, False, False])
    out = in_turn(small, [case], turns, one, {case: case, a: a, b: b}, f"`{case}` {t[case]}, `{a}` {t[a]}, `{b}` {t[b]}")
    if large is None:
        return out
    best = large.groupBy(case, a, b).agg(F.min(F.struct(*_order(order, descending))).alias("_k")).select(case, a, b, "_k.*")
    return out.unionByName(_dominant(best, case, a, b, [F.col(f"_o{i}") for i in range(len(order))], True).select(case, a, b))


def greedy_pairs(rows: DataFrame, case: str, a: str, b: str, order: list[str], descending: list[bool]) -> DataFrame:
    """As ``greedy_matching`` where a node may be on either side: each is in one pair at most; ``place`` is a pair's turn."""

    def one(key, group):
        used, out = set(), []
        for _, x, y, *_ in group:
            if x not in used and y not in used:
                used |= {x, y}
                out.append((key, x, y, len(out)))
        return out

    t = dict(rows.dtypes)
    columns = list(dict.fromkeys([case, a, b, *order]))
    out = {case: case, a: a, b: b, "place": pa.int32()}
    return in_turn(rows.select(*columns), [case], _sorting(rows, order, descending), one, out, f"`{case}` {t[case]}, `{a}` {t[a]}, `{b}` {t[b]}, place int")


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Every node's neighbours are linked with its least one: those above it (large star) or it and all below (small star)."""
    near = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", (F.col("m") if small else F.least("u", "m")).alias("m"))
    joined = near.join(low, "u")
    out = (joined if small else joined.where("v > u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        out = out.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """G2 for graphs of any size: (node, component) with the least node of each component, by star rounds on the edge table."""
    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        roots = edges.select(F.col("v").alias("x")).distinct()
        flat = edges.join(roots, edges["u"] == roots["x"], "left_semi").limit(1).count() == 0 and edges.groupBy("u").count().where("count > 1").limit(1).count() == 0
        if flat:
            break
        edges = written(_star(_star(edges, small=False), small=True))
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").withColumn("component", F.coalesce("component", "node"))
