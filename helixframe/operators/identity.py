"""Clusters of protein sequences by identity, greedily by length.

In order of length (longest first), then id, a sequence joins the first
representative among its candidates that it is identical enough with over enough
of the longer one, or represents a new cluster.

Candidates of each other are sequences that share two words on one diagonal, or
one long word. Words that more than ``MOST`` distinct sequences hold don't make
pairs: their occurrences go by longer words instead, level by level, so that tags
and common stretches tell sequences apart by what stands beside them. Words of the
last level that are still as frequent belong to families of near copies: their
longest sequence is their centre, and all others meet it; then the next one that
is no member of a cluster yet, as long as there is any. No word makes more pairs
than ``MOST`` for each of its sequences in a round.

Accepted pairs are a graph with few edges; who represents whom is settled on it
in rounds over tables: a sequence without an earlier accepting one that may still
represent a cluster represents one itself.

Edge cases: null and empty sequences are in no cluster; equal sequences are one
and share a cluster; ids are expected to be distinct.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators import clustering
from helixframe.operators.refinement import sequence_identity
from helixframe.operators.tables import written

#: Letters of the words of each level; from ``LONG`` letters on one shared word is enough.
LEVELS = (5, 8, 14, 30)
LONG = 14
#: Sequences of a word that meet each other.
MOST = 64


def accepts(x: str, y: str, least_identity: float, least_cover: float) -> bool:
    """The shorter sequence has to be so long a share of the longer one (coverage mode 5), and as identical in a global alignment."""
    short, long = sorted((len(x), len(y)))
    return x == y or (short >= least_cover * long and sequence_identity(x, y) >= least_identity)


def _words(rows: DataFrame, size: int) -> DataFrame:
    """(w, m, n, at) of each distinct word of each sequence, at its first place; a sequence shorter than a word is one."""
    last = F.greatest(F.length("s") - size + 1, F.lit(1))
    each = F.transform(F.sequence(F.lit(1), last), lambda k: F.struct(F.substring(F.col("s"), k, F.lit(size)).alias("w"), k.alias("at")))
    return rows.select("m", "n", F.explode(each).alias("x")).groupBy("m", "n", "x.w").agg(F.min("x.at").alias("at")).select("w", "m", "n", "at")


def words(rows: DataFrame, levels: tuple[int, ...] = LEVELS, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Words (w, m, n, at, size) of at most ``most`` sequences, of the level that makes them so rare, and those of the last level that are more frequent."""
    kept, hot = None, None
    for k, size in enumerate(levels):
        own = _words(rows, size)
        if hot is not None:
            own = own.join(hot.select(F.col("w").alias("_p")), F.substring("w", 1, levels[k - 1]) == F.col("_p")).drop("_p")
        own = written(own)
        counts = own.groupBy("w").agg(F.count("*").alias("_c")).where("_c > 1")
        hot = written(counts.where(F.col("_c") > most).select("w"))
        rare = own.join(counts.where(F.col("_c") <= most).select("w"), "w", "left_semi").withColumn("size", F.lit(size))
        kept = rare if kept is None else kept.unionByName(rare)
        if hot.isEmpty():
            return kept, own.where("false")
    return kept, own.join(hot, "w", "left_semi")


def candidates(kept: DataFrame, least_cover: float) -> DataFrame:
    """(a, b): pairs that share two words on one diagonal or a long one, the earlier (longer, then least) sequence first."""
    one, two = (kept.select("w", "size", F.col("m").alias(x), F.col("n").alias(f"n{x}"), F.col("at").alias(f"at{x}")) for x in "ab")
    both = one.join(two, ["w", "size"]).where(_before("a", "b") & (F.col("nb") >= least_cover * F.col("na")))
    found = both.groupBy("a", "b", (F.col("atb") - F.col("ata")).alias("d")).agg(F.count("*").alias("k"), F.max("size").alias("size"))
    return found.where((F.col("k") > 1) | (F.col("size") >= LONG)).select("a", "b").distinct()


def _before(a: str, b: str):
    """Whether the sequence a comes before b: longer, then of the least id."""
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    return (na > nb) | ((na == nb) & (F.col(a) < F.col(b)))


def aligned(pairs: DataFrame, rows: DataFrame, least_identity: float, least_cover: float) -> DataFrame:
    """The pairs (a, b) whose sequences accept each other."""
    for x in "ab":
        pairs = pairs.join(rows.select(F.col("m").alias(x), F.col("s").alias(f"s{x}")), x)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [accepts(x, y, least_identity, least_cover) for x, y in zip(pdf["sa"], pdf["sb"], strict=True)]
            yield pdf.loc[keep, ["a", "b"]]

    kind = dict(rows.dtypes)["m"]
    # Aligning is dear beside its bytes.
    dealt = pairs.select("a", "b", "sa", "sb").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return written(dealt.mapInPandas(run, f"a {kind}, b {kind}"))


def settled(edges: DataFrame, order: DataFrame) -> DataFrame:
    """(m, leader) of all sequences of ``order`` (m, n): each joins the first of its accepting earlier ones (edges a, b) that leads, or leads itself.

    Rounds: who has no earlier accepting one that is open or leads, leads; who has
    a leader before all that are open among these joins it.
    """
    n = lambda x: order.select(F.col("m").alias(x), F.struct((-F.col("n")).alias("n"), F.col("m").alias("m")).alias(f"o{x}"))
    state = written(order.select("m", F.lit(None).cast(dict(order.dtypes)["m"]).alias("leader")))
    edges = written(edges.join(n("a"), "a").select("a", "b", "oa"))
    while not state.where("leader is null").isEmpty():
        of = state.select(F.col("m").alias("a"), F.col("leader").alias("la"))
        # Those that can still matter: open ones and leaders.
        live = edges.join(of, "a").where("la is null or la = a").groupBy("b").agg(F.min(F.struct("oa", F.col("la").isNotNull().alias("leads"))).alias("f"))
        state = state.join(live.withColumnRenamed("b", "m"), "m", "left")
        leader = F.when(F.col("leader").isNotNull(), F.col("leader")).when(F.col("f").isNull(), F.col("m")).when(F.col("f.leads"), F.col("f.oa.m"))
        state = written(state.select("m", leader.alias("leader")))
    return state


def identity_clusters(
    rows: DataFrame, member: str, sequence: str, least_identity: float = 0.4, least_cover: float = 0.8, prefix: str = "prot_", levels: tuple[int, ...] = LEVELS, most: int = MOST,
) -> DataFrame:
    """(member, cluster_id, representative, size), clusters numbered in order of representatives."""
    kept = written(rows.where(F.coalesce(F.col(sequence), F.lit("")) != "").select(F.col(member).alias("m"), F.col(sequence).alias("s"), F.xxhash64(sequence).alias("h")))
    first = kept.groupBy("h", "s").agg(F.min("m").alias("m"))
    own = written(first.select("m", "s", "h", F.length("s").alias("n")))
    order = own.select("m", "n")
    some, hot = words(own.select("m", "n", "s"), levels, most)
    edges = aligned(candidates(some, least_cover), own, least_identity, least_cover)
    state = settled(edges, order)
    hot, tried = written(hot.select("w", "m", "n")), None
    while not hot.isEmpty():
        # A frequent word's first sequence that leads is its centre; sequences before it and members stay only to meet centres.
        led = written(hot.join(state, "m"))
        centre = led.where("leader = m").groupBy("w").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("m").alias("a"))).alias("c")).select("w", "c.a", (-F.col("c.n")).alias("na"))
        pairs = led.join(centre, "w").select("a", "na", F.col("m").alias("b"), F.col("n").alias("nb")).where(_before("a", "b") & (F.col("nb") >= least_cover * F.col("na"))).select("a", "b").distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs)
        tried = pairs if tried is None else tried.unionByName(pairs)
        edges = written(edges.unionByName(aligned(pairs, own, least_identity, least_cover)).distinct())
        state = settled(edges, order)
        # The centres have met all that hold their words; words without two leaders left are done.
        hot = hot.join(centre.select("w", F.col("a").alias("m")), ["w", "m"], "left_anti").join(centre.select("w"), "w", "left_semi")
        open_words = hot.join(state.where("leader = m").select("m"), "m", "left_semi").groupBy("w").count().select("w")
        hot = written(hot.join(open_words, "w", "left_semi"))
    led = kept.join(own.select("h", "s", F.col("m").alias("_m")), ["h", "s"]).join(state.select(F.col("m").alias("_m"), "leader"), "_m").select("m", "leader")
    sizes = led.groupBy(F.col("leader").alias("representative")).agg(F.count("*").alias("size"))
    numbered = clustering.numbered_groups(sizes, "representative", [F.col("representative").asc()], prefix)
    return led.select(F.col("m").alias(member), F.col("leader").alias("representative")).join(numbered, "representative")
