"""Relational operators on tables of chains, interfaces and cases; column names are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.tables import dealt, written


def first_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order; a partial top row leaves each task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def top_by(rows: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each key with their rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def semi(rows: DataFrame, scope: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose source is in scope."""
    return rows.join(scope.select(*on).distinct(), on, "left_semi")


def looked_up(rows: DataFrame, table: DataFrame, on: list[str], what: str) -> DataFrame:
    """An inner lookup that fails the job where a row has no match."""
    joined = rows.join(table.withColumn("_hit", F.lit(True)), on, "left")
    missing = F.raise_error(F.concat(F.lit(f"no {what} for "), F.concat_ws(":", *[F.col(k).cast("string") for k in on])))
    return joined.withColumn("_hit", F.when(F.col("_hit"), True).otherwise(missing.cast("boolean"))).where("_hit").drop("_hit")


def backfill(rows: DataFrame, references: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Rows, and for references that rows lack the rows of the source with that key."""
    missing = references.select(*on).distinct().join(rows.select(*on).distinct(), on, "left_anti")
    return rows.unionByName(source.join(missing, on, "left_semi").select(*rows.columns))


def member_pairs(rows: DataFrame, group: str, member: str) -> DataFrame:
    """Pairs (a < b) of distinct members of each group."""
    members = rows.select(group, member).distinct()
    left = members.select(group, F.col(member).alias("a"))
    right = members.select(group, F.col(member).alias("b"))
    return left.join(right, group).where("a < b")


def cooccurrences(rows: DataFrame, group: str, member: str) -> DataFrame:
    """Pairs (a < b) of distinct members and in how many groups they meet; tasks hold rows and pairs by number, whatever there is of them."""
    members = rows.where(F.col(group).isNotNull() & F.col(member).isNotNull()).select(group, member)
    sets = written(dealt(members, members.count(), group).groupBy(group).agg(F.array_sort(F.collect_set(member)).alias("_m")))
    n = F.size("_m").cast("long")
    size = sets.agg(F.sum(n * (n - 1) / 2).cast("long")).first()[0] or 0
    pairs = sets.select("_m", F.posexplode("_m").alias("_k", "a")).select("a", F.explode(F.slice("_m", F.col("_k") + 2, F.size("_m"))).alias("b"))
    return dealt(pairs, size, "a", "b").groupBy("a", "b").agg(F.count("*").alias("shared"))


def deduplicated_interfaces(rows: DataFrame, keys: list[str], order: list[Column], support: list[str]) -> DataFrame:
    """A10: the best interface of each key and how many distinct supports it has."""
    counts = rows.groupBy(*keys).agg(F.countDistinct(*support).alias("num_supporting"))
    return first_by(rows, keys, order).join(counts, keys)


def two_sided(rows: DataFrame, left: str, right: str, members: DataFrame, key: str) -> DataFrame:
    """Rows with exactly one side among the members; ``inside`` and ``outside`` tell the sides."""
    m = members.select(key).distinct()
    a = rows.join(m.withColumnRenamed(key, left).withColumn("_a", F.lit(1)), left, "left")
    b = a.join(m.withColumnRenamed(key, right).withColumn("_b", F.lit(1)), right, "left")
    one = b.where(F.col("_a").isNull() != F.col("_b").isNull())
    inside = F.when(F.col("_a").isNotNull(), F.col(left)).otherwise(F.col(right))
    outside = F.when(F.col("_a").isNotNull(), F.col(right)).otherwise(F.col(left))
    return one.withColumn("inside", inside).withColumn("outside", outside).drop("_a", "_b")


def segments(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Runs of consecutive positions of each key: first, last, length."""
    distinct = rows.select(*keys, position).distinct()
    island = F.col(position) - F.row_number().over(Window.partitionBy(*keys).orderBy(position))
    return (
        distinct.withColumn("_i", island).groupBy(*keys, "_i")
        .agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("length"))
        .drop("_i")
    )


def runs(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Runs of equal values in order: number, value, length."""
    w = Window.partitionBy(*keys).orderBy(*order)
    change = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    numbered = rows.withColumn("_c", change).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "run").agg(F.first(value).alias(value), F.count("*").alias("length"))


def collapsed(rows: DataFrame, group: str, entity: str, member: str, area: str) -> DataFrame:
    """Per group and entity the member of largest total area (then smallest name), total area and members."""
    per = rows.groupBy(group, entity, member).agg(F.sum(area).alias("area"))
    return per.groupBy(group, entity).agg(
        F.max_by(member, F.struct(F.col("area"), -F.col(member))).alias("representative"),
        F.sum("area").alias("total_area"),
        F.count("*").alias("members"),
    )


def contained(units: DataFrame, sets: DataFrame, unit: str, set_id: str, member: str) -> DataFrame:
    """(unit, set) where every member of the unit is in the set, by counting shared members.

    A set that holds a unit holds the unit's rarest member and has as many
    members at least: only such pairs are counted.
    """
    own, sets = units.select(unit, member).distinct(), sets.select(set_id, member).distinct()
    held = sets.groupBy(member).agg(F.count("*").alias("_f"))
    # A member that no set holds comes first, and meets none.
    rarest = own.join(held, member, "left").groupBy(unit).agg(F.count("*").alias("_n"), F.min_by(member, F.struct(F.coalesce("_f", F.lit(0)), member)).alias(member))
    sizes = sets.groupBy(set_id).agg(F.count("*").alias("_s"))
    small = rarest.join(F.broadcast(sizes.agg(F.max("_s").alias("_most"))), F.col("_n") <= F.col("_most")).drop("_most")
    same = F.col(set_id).eqNullSafe(F.col("_set"))
    sized = sets.join(sizes.withColumnRenamed(set_id, "_set"), same).drop("_set")
    pairs = small.join(sized, member).where("_s >= _n").select(unit, "_n", F.col(set_id).alias("_set"))
    # One member is no more to be counted.
    one = pairs.where("_n = 1").select(unit, F.col("_set").alias(set_id))
    wanted = pairs.where("_n > 1").join(own, unit).withColumnRenamed(member, "_member")
    both = wanted.join(sets, same & (F.col(member) == F.col("_member")))
    return both.groupBy(unit, set_id, "_n").agg(F.count("*").alias("_m")).where("_m = _n").select(unit, set_id).unionByName(one)


def supporting(units: DataFrame, others: DataFrame, sets: DataFrame, unit: str, set_id: str, member: str) -> DataFrame:
    """(unit, set) where every member of the unit is in the set, and one at least of the unit's other members."""
    met = others.select(unit, member).distinct().join(sets.select(set_id, member).distinct(), member)
    return contained(units, sets, unit, set_id, member).join(met.select(unit, set_id).distinct(), [unit, set_id], "left_semi")
