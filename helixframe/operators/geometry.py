"""Distances between structures: boxes, contacts by grid join, nearest owners, superposition."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def box_gap(a_min: list[Column], a_max: list[Column], b_min: list[Column], b_max: list[Column]) -> Column:
    """K1: distance of two axis-parallel boxes."""
    gaps = [F.greatest(F.lit(0.0), bl - ah, al - bh) for al, ah, bl, bh in zip(a_min, a_max, b_min, b_max, strict=True)]
    return F.sqrt(sum((g * g for g in gaps), F.lit(0.0)))


def _cells(rows: DataFrame, cutoff: float) -> DataFrame:
    return rows.withColumns({f"_c{c}": F.floor(F.col(c) / cutoff).cast("int") for c in "xyz"})


def contacts(left: DataFrame, right: DataFrame, case: str, cutoff: float) -> DataFrame:
    """Pairs of rows of one case within ``cutoff``: an equi-join on grid cells, with the right side in its 27 cells.

    Both sides have the case, ``id``, ``owner`` and x, y, z; distances are taken in single precision.
    """
    a = _cells(left, cutoff)
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    b = _cells(right, cutoff)
    for c in "xyz":
        b = b.withColumn("_s", F.explode(step)).withColumn(f"_c{c}", F.col(f"_c{c}") + F.col("_s")).drop("_s")
    b = b.select(case, *[f"_c{c}" for c in "xyz"], F.col("id").alias("id_2"), F.col("owner").alias("owner_2"), *[F.col(c).alias(f"{c}2") for c in "xyz"])
    joined = a.join(b, [case, "_cx", "_cy", "_cz"])
    d = F.sqrt(sum(((F.col(c) - F.col(f"{c}2")) * (F.col(c) - F.col(f"{c}2")) for c in "xyz"), F.lit(0.0).cast("float")))
    return joined.withColumn("distance", d).where(F.col("distance") <= cutoff).select(case, "id", "owner", "id_2", "owner_2", "distance")


def near_rows(left: DataFrame, right: DataFrame, case: str, reach: float) -> DataFrame:
    """Rows of both sides of one case within a reach, with all their columns (the right ones with ``_2``): the join of ``contacts``, for further columns."""
    a = _cells(left, reach)
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    b = _cells(right, reach)
    for c in "xyz":
        b = b.withColumn("_s", F.explode(step)).withColumn(f"_c{c}", F.col(f"_c{c}") + F.col("_s")).drop("_s")
    cells = [case, *[f"_c{c}" for c in "xyz"]]
    b = b.select(*cells, *[F.col(c).alias(f"{c}_2") for c in right.columns if c != case])
    square = sum(((F.col(c) - F.col(f"{c}_2")) * (F.col(c) - F.col(f"{c}_2")) for c in "xyz"), F.lit(0.0))
    return a.join(b, cells).where(square <= reach * reach).drop(*cells[1:])


def nearest_owner(found: DataFrame, case: str) -> DataFrame:
    """The owner of the nearest contact of each row."""
    return found.groupBy(case, "id").agg(F.min_by("owner_2", F.struct("distance", "id_2")).alias("owner"), F.min("distance").alias("distance"))


def interface_metrics(found: DataFrame, case: str) -> DataFrame:
    """Contacts between owners: pairs, distinct rows on each side, least distance."""
    return found.where("owner < owner_2").groupBy(case, "owner", "owner_2").agg(
        F.count("*").alias("pairs"), F.countDistinct("id").alias("left"), F.countDistinct("id_2").alias("right"), F.min("distance").alias("distance")
    )


def superpose(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotation and translation that bring paired points b onto a with least squares."""
    ca, cb = a.mean(0), b.mean(0)
    u, _, vt = np.linalg.svd((b - cb).T @ (a - ca))
    sign = np.sign(np.linalg.det(u @ vt))
    r = u @ np.diag([1, 1, sign]) @ vt
    return r, ca - cb @ r


def tm_score(a: np.ndarray, b: np.ndarray, length: int, rounds: int = 20) -> float:
    """K7: TM-score of paired residues for a structure of ``length``, superposed on the pairs near each other in turn."""
    d0 = max(0.5, 1.24 * max(length - 15, 1) ** (1 / 3) - 1.8)
    best, near = 0.0, np.ones(len(a), bool)
    for _ in range(rounds):
        r, t = superpose(a[near], b[near])
        d = np.linalg.norm(a - (b @ r + t), axis=1)
        best = max(best, float((1 / (1 + (d / d0) ** 2)).sum() / length))
        again = d <= max(d0, np.sort(d)[min(3, len(d)) - 1])
        if again.sum() < 3 or (again == near).all():
            break
        near = again
    return best


def accessible_area(places: np.ndarray, radii: np.ndarray, probe: float = 1.4, points: int = 100) -> np.ndarray:
    """K4: solvent-accessible area of each atom, by points on its sphere that no other atom covers."""
    k = np.arange(points) + 0.5
    polar, turn = np.arccos(1 - 2 * k / points), np.pi * (1 + 5**0.5) * k
    sphere = np.stack([np.cos(turn) * np.sin(polar), np.sin(turn) * np.sin(polar), np.cos(polar)], 1)
    grown = radii + probe
    out = np.empty(len(places))
    for i, (x, r) in enumerate(zip(places, grown, strict=True)):
        d = np.linalg.norm(places - x, axis=1)
        near = np.flatnonzero((d < r + grown) & (np.arange(len(places)) != i))
        spots = x + r * sphere
        free = (((spots[:, None] - places[near]) ** 2).sum(2) >= grown[near] ** 2).all(1) if len(near) else np.ones(points, bool)
        out[i] = 4 * np.pi * r * r * free.mean()
    return out
