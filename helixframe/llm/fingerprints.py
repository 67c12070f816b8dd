"""Document fingerprints: MinHash signatures over word shingles, compared, banded and verified.

A fingerprint holds, for each of ``HASHES`` universal hash permutations (random
odd multiplier and shift modulo 2**64), 16 bits of the least hash among the
text's shingles of five words; shared values estimate the Jaccard similarity of
two texts with a standard deviation of at most 0.044.

``compare_edits`` fingerprints each text and an edited text, whose second half is
replaced by the beginning of the next document's. Documents are dealt to ranges of
ids by borders that are ids themselves; each range also gets the first document
of the next, so a task that reads ranges in order sees each document's successor.
Texts travel once, compressed.

``near_duplicates`` joins fingerprints on bands of four values in Spark. Equal
fingerprints are one node; each band's documents meet pivots of the band in turns,
and in bands where components still differ all documents of different components meet.
Candidates are verified on their texts' shingle sets, each pair once.

Edge cases: null text is empty; an empty text, or one without words, has no
shingle and the fingerprint of all ones (which equals other such ones: likeness
1); one to four words are one shingle; rows with a null id come first in order;
of rows with one id the order is by a hash of their texts, equal rows being
interchangeable; a single document is its own next; an empty table gives an empty
result; a text of any length is a slice of its own; further columns are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._shared import components, materialize, trim
from helixframe.llm._text import LOWER, NOT_SPACE, mix, slices, text_buffers, text_slices, word_bounds, word_hashes
from helixframe.llm.near_join import verify

WORDS = 5
HASHES = 128
#: Ranges of ids for each shuffle partition.
RANGES = 8
_RNG = np.random.default_rng(20260731)
_MULTIPLY = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_WEIGHTS = np.array([pow(0x9FB21C651E98DF25, k, 1 << 64) for k in range(WORDS)], np.uint64)
_CODEC = "zstd"


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, one text after the other, and how many each has."""
    s, e, doc = word_bounds(LOWER[data], off, NOT_SPACE)
    h = word_hashes(LOWER[data], s, e)
    words = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(words) - words
    n = np.where(words >= WORDS, words - WORDS + 1, (words > 0).astype(np.int64))
    whole = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for k in range(WORDS if len(h) >= WORDS else 0):
        whole += h[k : len(h) - WORDS + 1 + k] * _WEIGHTS[k]
    whole = mix(whole)
    at = np.arange(len(h)) - np.repeat(first, words)
    inside = at < np.repeat(np.maximum(n, 0), words)
    out = np.zeros(len(h), np.uint64)
    out[: len(whole)] = whole
    for d in np.flatnonzero((words > 0) & (words < WORDS)).tolist():
        x = h[first[d] : first[d] + words[d]]
        out[first[d]] = mix((x * _WEIGHTS[: len(x)]).sum(keepdims=True) ^ np.uint64(len(x) << 56))[0]
    return out[inside], n


def signatures(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Fingerprints of texts as rows of ``HASHES`` values of 16 bits."""
    x, n = shingles(data, off)
    out = np.full((len(off) - 1, HASHES), 0xFFFF, np.uint16)
    some = np.flatnonzero(n)
    if len(some):
        begin = (np.cumsum(n) - n)[some]
        v = np.empty_like(x)
        for k in range(HASHES):
            np.multiply(x, _MULTIPLY[k], out=v)
            v += _ADD[k]
            # The high bits order the hashes; the least one's next 16 bits stand for it.
            out[some, k] = (np.minimum.reduceat(v, begin) >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal values of rows of two arrays of fingerprints."""
    return (a == b).mean(1)


def _hex(rows: np.ndarray) -> list[str]:
    return [x.tobytes().hex() for x in rows.astype(">u2")]


def _many(texts: list[bytes]) -> np.ndarray:
    """Fingerprints of a list of texts, slice by slice."""
    off = np.cumsum([0, *map(len, texts)])
    parts = [signatures(np.frombuffer(b"".join(texts[lo:hi]), np.uint8), off[lo : hi + 1] - off[lo]) for lo, hi in slices(off)]
    return np.concatenate(parts) if parts else np.zeros((0, HASHES), np.uint16)


# Documents beside their successors

_DEALT = "part int, guest int, doc_id long, h long, text binary, size long"


def _ranges(docs: DataFrame) -> tuple[list[int], int | None]:
    """Borders of the ranges (ids that begin one), and the id of the first document (null ids come first)."""
    parts = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = ", ".join(str(k / parts) for k in range(1, parts)) or "0.5"
    found = docs.selectExpr(f"percentile_approx(doc_id, array({shares}), 20000) as borders", "min(doc_id) as low", "count_if(doc_id is null) as none").first()
    low = found["low"]
    return sorted({x for x in found["borders"] or [] if x != low}), None if found["none"] else low


def _deal(borders: list[int], first: int | None):
    """Each document to its range, and the first ones of a range to the range before it as guests (the very first to the last one)."""

    def run(batches):
        edges = np.array(borders, np.int64)
        for batch in batches:
            ids = batch.column("doc_id")
            known = np.asarray(ids.is_valid())
            x = np.asarray(ids.fill_null(0))
            part = np.where(known, np.searchsorted(edges, x, "right"), 0)
            begins = known & (part > 0) & (edges[np.maximum(part, 1) - 1] == x if len(edges) else False)
            very = ~known if first is None else known & (x == first)
            row = np.concatenate([np.arange(len(x)), np.flatnonzero(begins), np.flatnonzero(very)])
            to = np.concatenate([part, part[begins] - 1, np.full(very.sum(), len(edges))])
            guest = np.repeat([0, 1], [len(x), len(row) - len(x)])
            data, off = text_buffers(batch.column("text"))
            packed = [pa.compress(data[i:j], _CODEC, asbytes=True) for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            texts, sizes = pa.array(packed, pa.binary()), np.diff(off)
            for k in range(0, len(row), 1000):
                r = row[k : k + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[k : k + 1000].astype(np.int32)), pa.array(guest[k : k + 1000].astype(np.int32)), ids.take(pa.array(r)), batch.column("h").take(pa.array(r)), texts.take(pa.array(r)), pa.array(sizes[r])],
                    names=["part", "guest", "doc_id", "h", "text", "size"],
                )
        trim()

    return run


EDITS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Bytes of texts that are edited at once.
HELD = 4 << 20


def edited(text: str, after: str) -> str:
    """``text`` with its second half replaced by as much as there is of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _compared(batches):
    """Rows of each document but guests; rows come range by range in order, guests last."""
    held: list[tuple] = []
    size = 0

    def flush(last: bool):
        """All rows held but the last, which the next batch follows; that too at the end."""
        nonlocal held, size
        texts = [x[3] for x in held]
        sign = _many(texts)
        own = [k for k, x in enumerate(held[:-1]) if not x[1]]
        changed = [edited(texts[k].decode(), texts[k + 1].decode()) for k in own]
        raw = [x.encode() for x in changed]
        other = _many(raw)
        one, after = sign[own], sign[[k + 1 for k in own]]
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([held[k][2] for k in own], pa.int64()), pa.array([len(texts[k].decode()) for k in own], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                pa.array(_hex(one), pa.string()), pa.array(_hex(other), pa.string()), pa.array(likeness(one, other)), pa.array(likeness(one, after)),
            ],
            names=[x.split()[0] for x in EDITS.split(", ")],
        )
        held = [] if last else held[-1:]
        size = len(held[0][3]) if held else 0
        return out

    for batch in batches:
        columns = [batch.column(c) for c in ("part", "guest", "doc_id", "text", "size")]
        for i in range(batch.num_rows):
            part, guest, doc, text, n = (c[i].as_py() for c in columns)
            held.append((part, guest, doc, pa.decompress(text, n, _CODEC, asbytes=True) if n else b""))
            size += n
            if size > HELD:
                yield flush(False)
    if held:
        yield flush(True)
    trim()


def compare_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    borders, first = _ranges(docs)
    rows = docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).mapInArrow(_deal(borders, first), _DEALT)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartition(parts, "part").sortWithinPartitions("part", "guest", "doc_id", "h")
    return placed.mapInArrow(_compared, EDITS)


# Near duplicates

#: Values of a band: 32 bands of 4 values find a pair of Jaccard similarity 0.75 but for 5 in a million.
BAND = 4
#: Share of values below which a pair is not verified, and turns of pivots before all of a band's remaining pairs.
LEAST_ALIKE, PIVOT_ROUNDS = 0.55, 5


def _signed(batches):
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, off in text_slices(batch.column("text")):
            sign = signatures(data, off)
            bare = (sign == 0xFFFF).all(1)
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array([x.tobytes() for x in sign], pa.binary()), pa.array(bare)], names=["doc_id", "sign", "bare"])
    trim()


def _bands(nodes: DataFrame) -> DataFrame:
    """(rep, band, value) of each node's bands."""
    size = 2 * BAND
    cut = F.transform(F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)), lambda k: F.substring("sign", k * size + 1, F.lit(size)))
    return nodes.select("rep", F.posexplode(cut).alias("band", "value"))


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose fingerprints share as many values as all but three in a million of those at a similarity of 0.75."""
    for x in "ab":
        pairs = pairs.join(nodes.select(F.col("rep").alias(x), F.col("sign").alias(f"s{x}")), x)

    def run(batches):
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sa", "sb"))
            yield batch.select(["a", "b"]).filter(pa.array(likeness(one, two) >= LEAST_ALIKE))

    return materialize(pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): the smallest id that links of similarity 0.75 or more reach, over pairs that share a band.

    Documents without words, and those with a null id, are in no class but
    their own. Links are verified on texts; what bands miss is lost, five pairs
    in a million at 0.75 and fewer above.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(docs.mapInArrow(_signed, "doc_id long, sign binary, bare boolean"))
    nodes = materialize(signed.where("not bare and doc_id is not null").groupBy("sign").agg(F.min("doc_id").alias("rep")))
    bands = materialize(_bands(nodes))
    found = tried = None
    for turn in range(PIVOT_ROUNDS + 1):
        # Bands whose documents are of several components yet.
        named = bands.withColumn("component", F.col("rep"))
        if found is not None:
            named = bands.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        place = F.struct(F.xxhash64("rep", F.lit(turn)).alias("o"), "rep", "component")
        mixed = named.groupBy("band", "value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(place).alias("p")).where("low < high")
        # Components only grow together: a band of one document or component stays so, and goes into no further turn.
        named = materialize(named.join(mixed.select("band", "value", F.col("p.rep").alias("p"), F.col("p.component").alias("pc")), ["band", "value"]))
        bands = named.select("rep", "band", "value")
        if turn < PIVOT_ROUNDS:
            pairs = named.where("component <> pc").select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b"))
        else:
            one, two = (named.select("band", "value", F.col("rep").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
            pairs = one.join(two, ["band", "value"]).where("a < b and ca <> cb").select("a", "b")
        pairs = pairs.distinct()
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        tried = pairs if tried is None else tried.union(pairs)
        links = verify(docs, _alike(pairs, nodes))
        found = components(links if found is None else links.union(found))
    label = nodes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("sign", F.coalesce("component", "rep").alias("class"))
    out = signed.join(label, "sign", "left").select("doc_id", F.when(F.col("bare") | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("class")).alias("class_id"))
    return out
