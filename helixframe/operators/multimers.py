"""Tight multimers: communities of large interfaces, with their type and support."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions.scalars import multimer_type
from helixframe.operators import graphs


def tight_multimers(interfaces: DataFrame, least_area: float = 500.0, resolution: float = 1.0, least_members: int = 2) -> DataFrame:
    """One row for each community of a case.

    ``interfaces`` has case, instance_1/2, entity_1/2, buried_area and
    num_atom_contacts. Support is the mean number of atom contacts of the
    edges inside a community.
    """
    edges = graphs.edge_table(interfaces, "case", "instance_1", "instance_2", "buried_area", least_area, ["buried_area", "num_atom_contacts"])
    home = graphs.communities(edges, "case", resolution, least_members)
    sides = [interfaces.select("case", F.col(f"instance_{i}").alias("node"), F.col(f"entity_{i}").alias("entity")) for i in (1, 2)]
    entity = sides[0].union(sides[1]).groupBy("case", "node").agg(F.min("entity").alias("entity"))
    members = home.join(entity, ["case", "node"]).groupBy("case", "community").agg(
        F.array_sort(F.collect_list("node")).alias("member_instances"), F.count("*").alias("num_member_instances"), F.countDistinct("entity").alias("entities")
    )
    ends = interfaces.where(F.col("buried_area") >= least_area).select(
        "case", F.least("instance_1", "instance_2").alias("u"), F.greatest("instance_1", "instance_2").alias("v"), "buried_area", "num_atom_contacts"
    )
    best = ends.groupBy("case", "u", "v").agg(F.max_by("num_atom_contacts", F.struct("buried_area", "num_atom_contacts")).alias("contacts"))
    a = home.select("case", F.col("node").alias("u"), "community")
    b = home.select("case", F.col("node").alias("v"), F.col("community").alias("other"))
    inside = best.join(a, ["case", "u"]).join(b, ["case", "v"]).where("community = other")
    support = inside.groupBy("case", "community").agg(F.count("*").alias("num_internal_edges"), F.round(F.avg("contacts"), 4).alias("support_score"))
    out = members.join(support, ["case", "community"])
    return out.withColumn("multimer_type", multimer_type(F.col("num_member_instances"), F.col("entities"))).drop("entities")


def deduplicated(multimers: DataFrame, key: list[str]) -> DataFrame:
    """Of copies of one multimer the best supported, with the number of copies."""
    order = F.struct("support_score", "num_member_instances", "num_internal_edges", F.negative(F.xxhash64("community")).alias("tie"))
    kept = [c for c in multimers.columns if c not in key]
    return multimers.groupBy(*key).agg(F.max_by(F.struct(*kept), order).alias("_m"), F.count("*").alias("num_component_copies")).select(*key, "_m.*", "num_component_copies")
