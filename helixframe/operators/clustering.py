"""Clusters of sequences and observations: by exact key, by signature, by leaders."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.tables import written


def numbered_groups(rows: DataFrame, key: str, order: list[Column], prefix: str, name: str = "cluster_id", start: int = 1) -> DataFrame:
    """Distinct keys numbered from a start in an order.

    Only the distinct keys are sorted: ranges of them are numbered in parallel
    and written with their range, whose sizes (a number for each range) give the
    offsets. Both come from the written table, so that one sampling of borders
    decides, whatever is computed again.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    local = written(placed.withColumn("_l", F.col("_m") - F.shiftleft(F.col("_p").cast("long"), 33)).drop("_m"))
    sizes = local.groupBy("_p").agg(F.count("*").alias("_c"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    out = local.join(F.broadcast(offsets), "_p")
    return out.withColumn(name, F.concat(F.lit(prefix), (F.col("_l") + F.col("_o") + start).cast("string"))).drop("_p", "_l", "_o")


#: Characters of a key that sort it; equal ones are told apart by the rest.
HEAD = 64


def exact_clusters(rows: DataFrame, member: str, key: Column, prefix: str, name: str = "cluster_id", start: int = 1) -> DataFrame:
    """Members with equal keys; clusters are numbered by longer key, then key; the least member stands for it.

    Columns: member, cluster, representative, size; a member without a key is in
    none. Keys are told apart by digest and length, which are taken once and
    written; only digests, lengths and heads of keys are shuffled and sorted. Whole
    keys are read again only where keys of one length share a head, one of each.
    """
    keyed = rows.select(member, key.alias("_key")).where("_key is not null")
    named = written(keyed.select(member, F.unhex(F.md5("_key")).alias("_d"), F.length("_key").alias("_n"), F.substring("_key", 1, HEAD).alias("_h")))
    groups = written(named.groupBy("_d", "_n").agg(F.min(member).alias("representative"), F.count("*").alias("size"), F.min("_h").alias("_h")))
    alike = groups.where(F.col("_n") > HEAD).groupBy("_n", "_h").agg(F.count("*").alias("_k")).where("_k > 1").select("_n", "_h")
    alike = written(groups.join(alike, ["_n", "_h"], "left_semi").select("_d", "_n", "_h", F.col("representative").alias(member)))
    placed = groups.withColumn("_t", F.lit(1))
    if not alike.isEmpty():
        whole = keyed.join(alike, member).where((F.length("_key") == F.col("_n")) & (F.unhex(F.md5("_key")) == F.col("_d")))
        tie = F.row_number().over(Window.partitionBy("_n", "_h").orderBy("_key"))
        tied = whole.groupBy("_d", "_n", "_h").agg(F.min("_key").alias("_key")).select("_d", "_n", tie.alias("_t"))
        placed = groups.join(tied, ["_d", "_n"], "left").withColumn("_t", F.coalesce("_t", F.lit(1)))
    numbered = numbered_groups(placed, "_d", [F.col("_n").desc(), F.col("_h").asc(), F.col("_t").asc()], prefix, name, start)
    return named.select(member, "_d", "_n").join(numbered.drop("_h", "_t"), ["_d", "_n"]).select(member, name, "representative", "size")


def next_cluster_index(clusters: DataFrame, name: str, prefix: str) -> int:
    """One more than the greatest number of the prefix's clusters, 1 where there are none."""
    number = F.when(F.col(name).startswith(prefix), F.substring(name, len(prefix) + 1, 1 << 30).try_cast("long"))
    return max(0, clusters.agg(F.max(number)).first()[0] or 0) + 1


def missing_clusters(rows: DataFrame, member: str, key: Column, clusters: DataFrame, prefix: str, name: str = "cluster_id") -> DataFrame:
    """Exact clusters of the members that no cluster has, numbered from the next free one.

    Columns: member, cluster, least member of the cluster, size. A member
    without a key has the empty one.
    """
    missing = rows.join(clusters.select(member).distinct(), member, "left_anti")
    return exact_clusters(missing, member, F.coalesce(key, F.lit("")), prefix, name, next_cluster_index(clusters, name, prefix))


def signature(members: Column) -> Column:
    """Canonical JSON of a sorted list of members."""
    return F.to_json(F.array_sort(members))


def signature_groups(rows: DataFrame, item: str, sig: str, prefix: str) -> DataFrame:
    """Signatures numbered by larger group, then text; each item with its group and group's size."""
    # A left join, as only its right side may be broadcast: long equal texts take little of a file, so Spark takes their rows for a small table.
    return rows.where(F.col(sig).isNotNull()).select(item, sig).join(signature_sizes(rows, sig, prefix), sig, "left")


def signature_sizes(rows: DataFrame, sig: str, prefix: str) -> DataFrame:
    """The groups of ``signature_groups`` with their sizes."""
    groups = rows.groupBy(sig).agg(F.count("*").alias("size"))
    return numbered_groups(groups, sig, [F.col("size").desc(), F.col(sig).asc()], prefix)


#: Members of a bucket that one task leads in a round.
LEAD_ROWS = 512
#: Members that meet all earlier leaders in one call.
BLOCK_ROWS = 32
#: Members of a bucket that one task compares with a round's leaders.
CHUNK_ROWS = 4096


def leader_clusters(rows: DataFrame, bucket: str, member: str, order: list[str], payload: str, accept, kind: str = "long", lead_rows: int = LEAD_ROWS, pairs=None) -> DataFrame:
    """In each bucket, members in order join the first leader that accepts them, or lead a new cluster.

    ``accept(leaders, members)`` gets two lists of payloads and tells, as a
    matrix of a row a member, which leaders accept which. Rounds: the first
    members of each bucket find their leaders in one task; all others meet
    these leaders in chunks, in parallel, and those that none accepts go on.
    As leaders are tried in the order they arose, this is what one pass over
    the bucket gives. Where comparing is dear, ``pairs`` tells for a list of
    (leader, member) which are accepted: small buckets of a task then go on
    together, a leader each in turn against what is left of its bucket. Returns
    bucket, leader and member.
    """
    b = dict(rows.dtypes)[bucket]
    found = f"`{bucket}` {b}, leader {kind}, `{member}` {kind}"

    def lead(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        names, load, led, out = pdf[member].tolist(), pdf[payload].tolist(), [], []
        for lo in range(0, len(load), BLOCK_ROWS):
            # A block meets all leaders before it at once; what none accepts then meets those that arise in the block.
            block = load[lo : lo + BLOCK_ROWS]
            before = accept([load[x] for x in led], block) if led else np.zeros((len(block), 0), bool)
            older, fresh = list(led), []
            for k, hits in enumerate(before, lo):
                hit = np.flatnonzero(hits)
                if not len(hit) and fresh:
                    hit = np.flatnonzero(accept([load[x] for x in fresh], [load[k]])[0])
                    out.append(fresh[hit[0]] if len(hit) else k)
                else:
                    out.append(older[hit[0]] if len(hit) else k)
                if out[-1] == k:
                    fresh.append(k)
            led += fresh
        return pd.DataFrame({bucket: pdf[bucket].iloc[0], "leader": [names[k] for k in out], member: names})

    def lead_many(batches):
        held: dict = {}
        for batch in batches:
            for name, *row in zip(*(batch.column(c).to_pylist() for c in (bucket, member, payload)), strict=True):
                if name not in held and sum(map(len, held.values())) >= lead_rows:
                    yield from led_together(held, batch.schema)
                    held = {}
                held.setdefault(name, []).append(row)
        if held:
            yield from led_together(held, batch.schema)

    def led_together(held: dict, schema):
        left, out = {name: list(range(len(rows))) for name, rows in held.items()}, []
        while left:
            # The first that no leader has accepted leads; leaders come in the order in which they arise.
            asked = [(name, own[0], k) for name, own in left.items() for k in own[1:]]
            hits = pairs([(held[name][j][1], held[name][k][1]) for name, j, k in asked]) if asked else []
            out += [(name, own[0], own[0]) for name, own in left.items()]
            out += [x for x, hit in zip(asked, hits, strict=True) if hit]
            rest: dict = {}
            for (name, _, k), hit in zip(asked, hits, strict=True):
                if not hit:
                    rest.setdefault(name, []).append(k)
            left = rest
        columns = [[name for name, _, _ in out], [held[name][j][0] for name, j, _ in out], [held[name][k][0] for name, _, k in out]]
        kinds = [schema.field(bucket).type, schema.field(member).type, schema.field(member).type]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=[bucket, "leader", member])

    def follow(leaders: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if not len(leaders) or not len(others):
            return pd.DataFrame({bucket: [], "leader": [], member: []})
        leaders = leaders.sort_values("_place")
        hit = accept(leaders[payload].tolist(), others[payload].tolist())
        some = hit.any(1)
        names = leaders[member].to_numpy(object)[hit.argmax(1)[some]]
        return pd.DataFrame({bucket: others[bucket].to_numpy(object)[some], "leader": names, member: others[member].to_numpy(object)[some]})

    # Comparing is dear beside its bytes: partitions are not put together for being small.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    # Turns are written before rows are dealt: dealing straight after a window by bucket is taken for done, and leaves one task.
    turn = F.row_number().over(Window.partitionBy(bucket).orderBy("_place"))
    pending = written(rows.select(bucket, member, payload, place.alias("_place")).withColumn("_turn", F.col("_place")))
    done = None
    while not pending.isEmpty():
        firsts = pending.where(F.col("_turn") <= lead_rows).repartition(parts, bucket)
        if pairs is None:
            first = written(firsts.groupBy(bucket).applyInPandas(lead, found))
        else:
            first = written(firsts.sortWithinPartitions(bucket, "_place").select(bucket, member, payload).mapInArrow(lead_many, found))
        rest = pending.where(F.col("_turn") > lead_rows).withColumn("_chunk", F.floor(F.col("_turn") / CHUNK_ROWS)).drop("_turn")
        chunks = rest.select(bucket, "_chunk").distinct()
        leaders = pending.drop("_turn").join(first.where(f"leader = `{member}`").select(bucket, member), [bucket, member], "left_semi").join(chunks, bucket)
        # Columns of its own, as both sides come from one table.
        leaders = leaders.select(*[F.col(f"`{c}`").alias(c) for c in leaders.columns])
        leaders, others = (x.repartition(parts, bucket, "_chunk").groupBy(bucket, "_chunk") for x in (leaders, rest))
        joined = leaders.cogroup(others).applyInPandas(follow, found)
        joined = written(joined)
        done = first.unionByName(joined) if done is None else done.unionByName(first).unionByName(joined)
        pending = written(rest.drop("_chunk").join(joined.select(bucket, member), [bucket, member], "left_anti").withColumn("_turn", turn))
    return rows.sparkSession.createDataFrame([], found) if done is None else done
