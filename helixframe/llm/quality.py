"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k.

Two bags of hashed n-grams are modelled for the target texts and for all (raw)
texts: byte 4-grams, and pairs of word shapes (character classes, length, and
whether a word repeats one shortly before). A document's log weight is the
mean log ratio of the two models over its n-grams. Keys of log weight over
``TEMPERATURE`` plus Gumbel noise (seeded by the id) are drawn, and the k
largest are selected; k is the number of documents whose log weight reaches
the limit that best tells good from bad among the labelled sample.

Counts of the raw model cover all documents. The target's come from a bounded
sample of labelled documents (``SAMPLE`` of smallest id hash).

Edge cases: null and empty texts, and such short ones that they have no
n-grams, have log weight 0; rows with null ids draw the noise of a null id;
repeated rows get equal results (rows that tie with the k-th key are all
selected); without labels of both kinds, all are selected; a text of any length
is a slice of its own; an empty table gives an empty result; ``select`` reads no
further columns, ``keep_selected`` hands them through, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._shared import count_blocks, fields, free_names, materialize, sum_counts, trim
from helixframe.llm._text import LOWER, NOT_SPACE, mix, text_slices, word_bounds, word_hashes

BYTE_BITS, SHAPE_BITS = 15, 13
SIZE = (1 << BYTE_BITS) + (1 << SHAPE_BITS)
SAMPLE = 20_000
TEMPERATURE = 0.005

#: Character classes of word shapes; letters and marks beyond ASCII are as lower-case letters.
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = _CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
for _i, _c in enumerate(b".,!?;:#*%&$|"):
    _CLASS[_c] = 4 + _i


def features(data: np.ndarray, off: np.ndarray):
    """Two (n-gram slot, document) lists: byte 4-grams, and shape pairs in slots of their own."""
    n, none = len(data), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    a = da = none
    if n >= 4:
        d = data.astype(np.uint32)
        gram = d[:-3] | d[1:-2] << 8 | d[2:-1] << 16 | d[3:] << 24
        whole = owner[:-3] == owner[3:]
        a = (gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BYTE_BITS)).astype(np.int64)[whole]
        da = owner[:-3][whole]
    s, e, doc = word_bounds(data, off, NOT_SPACE)
    if len(s) < 2:
        return (a, da), (none, none)
    h = word_hashes(LOWER[data], s, e)
    again = np.zeros(len(h), np.int64)
    for k in range(1, 5):
        again[k:] |= (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])
    shape = _CLASS[data[s]] * 16 + _CLASS[data[np.minimum(s + 1, e - 1)]]
    shape = (shape * 16 + _CLASS[data[e - 1]]) * 8 + again * 4 + np.minimum((e - s) // 8, 3)
    pair = mix((shape[:-1] * 65536 + shape[1:]).astype(np.uint64)) >> np.uint64(64 - SHAPE_BITS)
    whole = doc[1:] == doc[:-1]
    return (a, da), (pair.astype(np.int64)[whole] + (1 << BYTE_BITS), doc[1:][whole])


def _count(batches):
    raw, target = np.zeros(SIZE, np.int64), np.zeros(SIZE, np.int64)
    for batch in batches:
        good = batch.column("quality").fill_null(0).to_numpy(zero_copy_only=False) == 1
        for lo, hi, data, off in text_slices(batch.column("text")):
            for f, doc in features(data, off):
                raw += np.bincount(f, minlength=SIZE)
                target += np.bincount(f[good[lo:hi][doc]], minlength=SIZE)
    yield count_blocks(np.concatenate([raw, target]))
    trim()


class RatioModel:
    """Log ratios of the target and raw n-gram models, smoothed by half a count."""

    def __init__(self, raw: np.ndarray, target: np.ndarray):
        self.ratio = np.zeros(SIZE)
        for part in (slice(0, 1 << BYTE_BITS), slice(1 << BYTE_BITS, SIZE)):
            r, t = raw[part], target[part]
            if t.sum():
                n = len(r) / 2
                self.ratio[part] = np.log((t + 0.5) / (t.sum() + n)) - np.log((r + 0.5) / (r.sum() + n))

    def weights(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        out = np.zeros(n)
        for f, doc in features(data, off):
            count = np.bincount(doc, minlength=n)
            out += np.bincount(doc, self.ratio[f], n) / np.maximum(count, 1)
        return out


def _weigh(shared, name: str):
    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column("text")):
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(shared.value.weights(data, off))], names=[*rows.schema.names, name]
                )
        trim()

    return run


def best_limit(good: np.ndarray, bad: np.ndarray) -> float:
    """The limit with the fewest errors (good ones below it, bad ones from it on); the lowest of equal ones."""
    if not len(good) or not len(bad):
        return -math.inf
    points = np.unique(np.concatenate([good, bad]))
    limits = np.concatenate([[points[0] - 1], (points[1:] + points[:-1]) / 2])
    errors = np.searchsorted(np.sort(good), limits) / len(good) + 1 - np.searchsorted(np.sort(bad), limits) / len(bad)
    return float(limits[int(np.argmin(errors))])


def kth_largest(rows: DataFrame, col: str, k: int) -> int | None:
    """The k-th largest value of a column of 48-bit integers, by histograms of 4096 bins; None for k < 1 or too few rows."""
    if k < 1:
        return None
    low, shift = -(1 << 47), 36
    left = k
    while shift >= 0:
        span = rows.where((F.col(col) >= low) & (F.col(col) < low + (1 << shift + 12)))
        bins = span.groupBy(F.shiftright(F.col(col) - low, shift).alias("bin")).count().collect()
        for r in sorted(bins, key=lambda r: -r["bin"]):
            if left <= r["count"]:
                low += r["bin"] << shift
                break
            left -= r["count"]
        else:
            return None
        shift -= 12
    return low


class Selection:
    """The fitted models and the least key of the k selected documents of ``docs`` (doc_id, text, ...)."""

    def __init__(self, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, temperature: float = TEMPERATURE):
        context = docs.sparkSession.sparkContext
        self.temperature = temperature
        known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        known = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
        # At most ``sample`` rows: a bounded broadcast.
        rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left")
        counts = sum_counts(rows.select("text", "quality").mapInArrow(_count, "block long, counts binary"), 2 * SIZE)
        self.model = context.broadcast(RatioModel(counts[:SIZE], counts[SIZE:]))
        self.keys = materialize(self.weigh(rows).drop("text"))
        # One row for each sampled id, the least weight where rows share it.
        shown = self.keys.where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("_log_weight").alias("_log_weight")).toPandas()
        q, w = shown["quality"].to_numpy(), shown["_log_weight"].to_numpy()
        self.limit = best_limit(w[q == 1], w[q == 0])
        self.last = None
        if self.limit > -math.inf:
            self.last = kth_largest(self.keys, "_fixed", self.keys.where(F.col("_log_weight") >= self.limit).count())

    def weigh(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their log weights, keys, and keys as integers: columns of the names of ``added``."""
        weight, key_name, whole = self.added(rows.columns)
        u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(10)), 11).cast("double") + 0.5) / float(1 << 53)
        key = F.col(weight) / self.temperature - F.log(-F.log(u))
        fixed = F.round(F.greatest(F.lit(-1e7), F.least(F.lit(1e7), key_name)) * (1 << 20)).cast("long")
        schema = [*fields(rows.schema, rows.columns), f"{weight} double"]
        weighed = rows.mapInArrow(_weigh(self.model, weight), ", ".join(schema))
        return weighed.withColumn(key_name, key).withColumn(whole, fixed)

    @staticmethod
    def added(columns) -> list[str]:
        """Names for the added columns that the rows have not."""
        return free_names(columns, "_log_weight", "_key", "_fixed")

    def chosen(self, fixed: str = "_fixed"):
        """Whether a weighed row is among the k of largest key; all are where nothing tells good from bad."""
        if self.limit == -math.inf:
            return F.lit(True)
        return F.lit(False) if self.last is None else F.col(fixed) >= self.last


def select(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """(doc_id, log_weight, key, selected) of each row of ``docs``, given labels (doc_id, quality)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = Selection(docs, labels, **fitting)
    return chosen.keys.select("doc_id", F.col("_log_weight").alias("log_weight"), F.col("_key").alias("key"), chosen.chosen().alias("selected"))


def keep_selected(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """The selected rows of ``docs``, with their columns."""
    chosen = Selection(docs, labels, **fitting)
    return chosen.weigh(docs).where(chosen.chosen(chosen.added(docs.columns)[2])).select(*[f"`{c}`" for c in docs.columns])
