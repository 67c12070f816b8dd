"""Source divergence audit: how each source's terms differ from its language's and from the other sources'.

Terms are runs of letters and of all characters beyond ASCII, A-Z lower-cased.
A language keeps the terms that at least ``MIN_DOCS`` of its documents hold.

1. Each task counts documents by (language, term) in a count-min sketch whose
   counters stop at the threshold; the sketches are merged block by block. The
   merged sketch never underestimates, so a term whose estimate is below the
   threshold is in no language's list, and leaves before any shuffle.
2. What survives is counted exactly by (language, source, term), combined in the
   task, then by Spark; the exact document counts decide.
3. Pairs of sources meet only on terms that both hold. A term that one of them
   lacks adds a value that hangs on its count alone, so those are summed by
   count, and terms that both lack by their number.

The sketch's width follows the number of documents up to ``MOST_CELLS``; beyond
that its estimates rise and more terms go on to be counted, with the same result.

Edge cases: null text, lang and source read as ''; a group without terms, or a
language that keeps none (every value 0), has its pairs; a language of one source
has no pairs; repeated rows are documents of their own; doc_id and further
columns are not read, whatever their names; an empty table gives an empty result;
texts are taken in slices of whole documents, a long one alone.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm._shared import materialize, trim
from helixframe.llm._text import LOWER, distinct_counts, mix, spread, text_slices, word_bounds, word_hashes

MIN_DOCS = 10
TOP_TERMS = 10
#: Rows of the sketch.
DEPTH = 3
#: Cells of a row for each document, at least and at most.
CELLS_A_DOC, LEAST_CELLS, MOST_CELLS = 16, 1 << 16, 1 << 24
#: Cells of a block, which tasks merge.
BLOCK = 1 << 18
#: Bytes of texts whose terms are counted together.
SLICE = 8 << 20
_SALTS = [np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)]

#: Bytes of terms: a-z and all above ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[97:123] = True
LETTERS[128:] = True


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _slices(batch: pa.RecordBatch):
    """Of each slice: languages and sources as codes with their values, and its distinct (document, term) with occurrences.

    Terms are told apart by Arrow's dictionary, so no two share a code.
    """
    coded = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
    codes = [np.asarray(x.indices, np.int64) for x in coded]
    names = [x.dictionary for x in coded]
    for lo, hi, data, off in text_slices(batch.column("text"), SLICE):
        data = LOWER[data]
        s, e, doc = word_bounds(data, off, LETTERS)
        ends = np.cumsum(e - s).astype(np.int32)
        raw = data[spread(s, e - s)].tobytes()
        terms = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(np.concatenate([np.zeros(1, np.int32), ends]).tobytes()), pa.py_buffer(raw)])
        terms = terms.dictionary_encode()
        n = max(1, len(terms.dictionary))
        pair, times = distinct_counts(doc * n + np.asarray(terms.indices, np.int64))
        doc, term = pair // n, pair % n
        yield [x[lo:hi] for x in codes], names, terms.dictionary, doc, term, times


def _keys(langs: pa.Array, lang: np.ndarray, terms: pa.Array, term: np.ndarray) -> np.ndarray:
    """64-bit keys of (language, term)."""
    off = np.frombuffer(terms.buffers()[1], np.int32)[: len(terms) + 1].astype(np.int64)
    data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)
    h = word_hashes(data, off[:-1], off[1:])
    own = np.array([zlib.crc32((x or "").encode()) for x in langs.to_pylist()], np.uint64) << np.uint64(17)
    return mix(h[term] ^ mix(own[lang] + np.uint64(1)))


def _cells(keys: np.ndarray, width: int):
    shift = np.uint64(64 - int(math.log2(width)))
    return [(mix(keys + salt) >> shift).astype(np.int64) for salt in _SALTS[:DEPTH]]


def _sketched(width: int, least: int):
    """Sketch of a task's texts as blocks (block, cells)."""
    kind = np.min_scalar_type(2 * least)

    def run(batches):
        cells = np.zeros((DEPTH, width), kind)
        for batch in batches:
            for (lang, _), (langs, _), terms, doc, term, _ in _slices(batch):
                if not len(term):
                    continue
                for row, at in zip(cells, _cells(_keys(langs, lang[doc], terms, term), width), strict=True):
                    at, n = distinct_counts(at)
                    row[at] = np.minimum(row[at] + n, least)
        flat = cells.ravel()
        parts = [(k, flat[k * BLOCK : (k + 1) * BLOCK]) for k in range(-(-len(flat) // BLOCK))]
        parts = [(k, zlib.compress(x.tobytes(), 1)) for k, x in parts if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([x for _, x in parts], pa.binary())], names=["block", "cells"])
        trim()

    return run


def _merged(least: int):
    kind = np.min_scalar_type(2 * least)

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(raw), kind)
                total[k] = np.minimum(total[k] + x, least).astype(kind) if k in total else x
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()], pa.binary())], names=["block", "cells"]
        )

    return run


def sketch(docs: DataFrame, width: int, min_docs: int = MIN_DOCS) -> np.ndarray:
    """Count-min document frequencies of (language, term), none above ``min_docs``: ``DEPTH`` rows of ``width`` cells.

    What comes to the driver is the merged sketch, of a size that ``width`` sets.
    """
    kind = np.min_scalar_type(2 * min_docs)
    rows = _read(docs).mapInArrow(_sketched(width, min_docs), "block int, cells binary")
    blocks = max(1, DEPTH * width // BLOCK)
    merged = rows.repartition(blocks, "block").mapInArrow(_merged(min_docs), "block int, cells binary")
    flat = np.zeros(DEPTH * width, kind)
    for r in merged.collect():
        flat[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(zlib.decompress(r["cells"]), kind)
    return flat.reshape(DEPTH, width)


COUNTS = "lang string, source string, term string, n long, docs long"


def counts(docs: DataFrame, cells: np.ndarray, min_docs: int = MIN_DOCS) -> DataFrame:
    """Exact (lang, source, term, n, docs) of the terms that the sketch doesn't rule out."""
    shared = docs.sparkSession.sparkContext.broadcast(cells)
    width = cells.shape[1]

    def run(batches):
        for batch in batches:
            for (lang, source), (langs, sources), terms, doc, term, times in _slices(batch):
                if not len(term):
                    continue
                at = _cells(_keys(langs, lang[doc], terms, term), width)
                low = np.min([row[x] for row, x in zip(shared.value, at, strict=True)], 0)
                keep = low >= min_docs
                doc, term, times = doc[keep], term[keep], times[keep]
                key = (lang[doc] * len(sources) + source[doc]) * len(terms) + term
                one, docs_n = distinct_counts(key)
                _, n = distinct_counts(key, times)
                group = one // len(terms)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(group // len(sources))), sources.take(pa.array(group % len(sources))), terms.take(pa.array(one % len(terms))).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs_n, pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )
        trim()

    rows = _read(docs).mapInArrow(run, COUNTS)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10**9 * (n + 2) / (total + 2 * kept)), in decimals, as the product may pass 64 bits."""
    return F.expr("1L") + F.call_function("div", (n + 2).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)"), F.greatest(total + 2 * kept, F.lit(1)).cast("decimal(20,0)"))


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); both are at most 10**9 + 1, so 64 bits do."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, width: int | None = None) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): each other source of the language, and the terms that a source has more of.

    ``width`` sets the cells of a row of the sketch (a power of two).
    """
    if width is None:
        n = docs.count()
        width = 1 << max(LEAST_CELLS.bit_length() - 1, min(MOST_CELLS.bit_length() - 1, (CELLS_A_DOC * n).bit_length()))
    counted = materialize(counts(docs, sketch(docs, width, min_docs), min_docs))
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("_d"), F.sum("n").alias("lang_n")).where(F.col("_d") >= min_docs).drop("_d")
    rows = materialize(counted.drop("docs").join(kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    own = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    groups = _read(docs).select("lang", "source").distinct().join(langs, "lang", "left").join(own, ["lang", "source"], "left").na.fill(0)
    zero = F.lit(0).cast("long")
    groups = materialize(groups.withColumn("none", _share(zero, F.col("total"), F.col("v"))))
    valued = rows.join(groups.select("lang", "source", "total", "v", "lang_total", "none"), ["lang", "source"])
    valued = materialize(valued.select("lang", "source", "term", "none", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")))

    over = valued.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    sides = [groups.select("lang", *[F.col(c).alias(f"{c}_{i}") for c in ("source", "none", "held")], *(["v"] if i == 1 else [])) for i in (1, 2)]
    pairs = sides[0].join(sides[1], "lang").where("source_1 <> source_2")
    # Terms that both hold: in place of what they'd add if one lacked them, one for both orders.
    a, b = (valued.select("lang", "term", *[F.col(c).alias(f"{c}_{i}") for c in ("source", "p", "none")]) for i in (1, 2))
    p1, p2, n1, n2 = (F.col(c) for c in ("p_1", "p_2", "none_1", "none_2"))
    both = a.join(b, ["lang", "term"]).where("source_1 < source_2").groupBy("lang", "source_1", "source_2").agg(
        F.sum(_apart(p1, p2) - _apart(p1, n2) - _apart(n1, p2)).alias("both_value"), F.count("*").alias("both")
    )
    both = materialize(both)
    turned = both.select("lang", F.col("source_2").alias("source_1"), F.col("source_1").alias("source_2"), "both_value", "both")
    # Terms as if the other lacked them: a row for each distinct count.
    hist = valued.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    hist = hist.select("lang", F.col("source").alias("source_1"), "p", "times")
    one = hist.join(groups.select("lang", F.col("source").alias("source_2"), F.col("none").alias("none_2")), "lang").where("source_1 <> source_2")
    one = materialize(one.groupBy("lang", "source_1", "source_2").agg(F.sum(_apart(F.col("p"), n2) * F.col("times")).alias("one_value")))
    back = one.select("lang", F.col("source_1").alias("source_2"), F.col("source_2").alias("source_1"), F.col("one_value").alias("back_value"))
    ends = ["lang", "source_1", "source_2"]
    found = pairs.join(one, ends, "left").join(back, ends, "left").join(both.unionByName(turned), ends, "left").na.fill(0)
    rest = (F.col("v") - F.col("held_1") - F.col("held_2") + F.col("both")) * _apart(n1, n2)
    found = found.select("lang", F.col("source_1").alias("source"), F.lit("pair").alias("part"), F.col("source_2").alias("item"), (F.col("one_value") + F.col("back_value") + F.col("both_value") + rest).alias("value"))
    found = found.withColumn("rank", F.row_number().over(order))
    return found.unionByName(over).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
