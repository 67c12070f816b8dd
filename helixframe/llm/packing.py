"""Packing of tokenised documents into sequences by shortest-pack-first over the length histogram.

A document's ids are those of a public tokenizer and one end id. Documents
longer than a sequence are cut into full pieces and a rest. Only the histogram
of piece lengths (at most ``max_len`` numbers) reaches the driver; there,
lengths are placed longest first, each onto the packs with the most room left,
by updating counts of packing patterns. Pieces then find their place by their
rank among the pieces of their length.

Edge cases: null text is empty (its only id is the end id); a null ``doc_id``
is an id like any other; repeated rows are packed once each; an empty table
gives an empty table; a text of any length is cut into pieces, and its ids are
held at once; further columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm._shared import materialize, trim
from helixframe.llm._text import NOT_SPACE, spread, text_slices, word_bounds, word_hashes

MAX_LEN = 4096
END_ID = 2
#: White-space separated chunks kept in a worker's memory between batches.
MEMO_WORDS = 2_500_000
#: Chunks of letters and plain punctuation, whose pre-tokens are their runs of either.
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ.,;:!?|*#%&$()\-]+")
RUNS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[^A-Za-zÀ-ÖØ-öø-ÿ]+")

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordTokenizer:
    """Ids of whole texts through a memo of white-space separated chunks.

    Equal to encoding each text at once: the tokenizer's normaliser and
    pre-tokenizer act within chunks, so a text's ids are its chunks' in order.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size + 1, bool)
        for i in range(size):
            token = self.tokenizer.id_to_token(i)
            self.ends[i] = token is not None and token.endswith("</w>")

    def _clear(self) -> None:
        self.known, self.begin, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pools, self.pool_end = [np.zeros(0, np.int32)], 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, words: list[str], group: int = 256) -> list[np.ndarray]:
        """Ids of each chunk; plain ones are encoded in joined groups, cut apart at the ends of pre-tokens."""
        out: list = [None] * len(words)
        plain, other = [], []
        for i, w in enumerate(words):
            (plain if PLAIN.fullmatch(w) else other).append(i)
        for k in range(0, len(plain), group):
            part = plain[k : k + group]
            ids = np.array(self._encode([" ".join([words[i] for i in part])])[0], np.int32)
            at = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum([len(RUNS.findall(words[i])) for i in part])
            if len(at) != last[-1]:
                other += part
                continue
            cuts = [0, *at[last - 1].tolist()]
            for j, i in enumerate(part):
                out[i] = ids[cuts[j] : cuts[j + 1]]
        for k in range(0, len(other), 4096):
            part = other[k : k + 4096]
            for i, x in zip(part, self._encode([words[i] for i in part]), strict=True):
                out[i] = np.array(x, np.int32)
        return out

    def batch(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (and the last's end).

        Chunks are known by 64-bit hashes; ids lie in one pool, which stays
        with the worker from batch to batch until it holds ``MEMO_WORDS``.
        """
        s, e, doc = word_bounds(data, off, NOT_SPACE)
        h = word_hashes(data, s, e)
        order = np.argsort(h)
        first = np.ones(len(h), bool)
        first[1:] = h[order[1:]] != h[order[:-1]]
        inverse = np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(first) - 1
        seen, at = h[order[first]], order[first]
        if len(self.known) > MEMO_WORDS:
            self._clear()
        k = np.searchsorted(self.known, seen)
        new = np.flatnonzero(self.known[np.minimum(k, len(self.known) - 1)] != seen) if len(self.known) else np.arange(len(seen))
        if len(new):
            raw = data.tobytes()
            ids = self.encode([raw[i:j].decode("utf-8", "replace") for i, j in zip(s[at[new]].tolist(), e[at[new]].tolist(), strict=True)])
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            begin = self.pool_end + np.cumsum(lengths) - lengths
            self.pools.append(np.concatenate(ids))
            self.pool_end += len(self.pools[-1])
            known = np.concatenate([self.known, seen[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.begin = np.concatenate([self.begin, begin])[order]
            self.length = np.concatenate([self.length, lengths])[order]
            self.pools = [np.concatenate(self.pools)]
            k = np.searchsorted(self.known, seen)
        k = k[inverse]
        lengths = self.length[k]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.pools[0][spread(self.begin[k], lengths)]
        return ids, total[np.searchsorted(doc, np.arange(len(off)))]


#: Tokenizers of this Python worker; a worker outlives its tasks.
_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _pieces(tokenizer_path: str, end_id: int, max_len: int):
    def run(batches):
        tok = tokenizer(tokenizer_path)
        for batch in batches:
            docs = batch.column("doc_id")
            for lo, hi, data, off in text_slices(batch.column("text"), 2 << 20):
                ids, at = tok.batch(data, off)
                n = np.diff(at) + 1
                full = np.insert(ids, at[1:], end_id).astype("<u4")
                begin = np.cumsum(n) - n
                count = -(-n // max_len)
                row = np.repeat(np.arange(hi - lo), count)
                start = spread(np.zeros(hi - lo, np.int64), count) * max_len
                length = np.minimum(max_len, n[row] - start)
                raw, where = memoryview(full).cast("B"), (begin[row] + start) * 4
                crc = [zlib.crc32(raw[i : i + k]) for i, k in zip(where.tolist(), (length * 4).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(lo, hi - lo).take(pa.array(row)), *map(pa.array, (start, length, np.array(crc, np.int64), n[row]))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )
        trim()

    return run


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, max_len: int = MAX_LEN
) -> DataFrame:
    """Pieces of at most ``max_len`` ids of each (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(tokenizer_path, end_id, max_len), PIECE_SCHEMA
    )


def shortest_pack_first(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns as (count, [(length, times), ...]).

    Lengths go longest first, each onto the packs with the most room (the
    shortest packs); packs of one pattern are handled as a count. Every length
    splits at most one pattern in two besides those that it opens, so there are
    at most two patterns for each distinct length.
    """
    room: dict[int, list[list]] = {}

    def put(left: int, count: int, items: tuple) -> None:
        room.setdefault(left, []).append([count, items])

    def plus(items: tuple, length: int, times: int) -> tuple:
        if items and items[-1][0] == length:
            return (*items[:-1], (length, items[-1][1] + times))
        return (*items, (length, times))

    for length in sorted((k for k, c in histogram.items() if c), reverse=True):
        n = histogram[length]
        while n:
            left = max((r for r in room if r >= length), default=0)
            if not left:
                each = max_len // length
                full, rest = divmod(n, each)
                if full:
                    put(max_len - each * length, full, ((length, each),))
                if rest:
                    put(max_len - rest * length, 1, ((length, rest),))
                break
            group = room[left]
            count, items = group.pop()
            if not group:
                del room[left]
            if count > n:
                put(left, count - n, items)
                put(left - length, n, plus(items, length, 1))
                break
            below = max((r for r in room if r >= length), default=0)
            times = 1 if group else max(1, min((left - below) // length, left // length, n // count))
            put(left - times * length, count, plus(items, length, times))
            n -= times * count
    return [(count, list(items)) for left in sorted(room) for count, items in room[left]]


def _places(patterns) -> np.ndarray:
    """Rows (length, first rank, times, first sequence, first offset), sorted by length and rank."""
    rows, used, base = [], {}, 0
    for count, items in patterns:
        offset = 0
        for length, times in items:
            rank = used.get(length, 0)
            rows.append((length, rank, times, base, offset))
            used[length] = rank + count * times
            offset += length * times
        base += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _assign(places):
    def run(batches):
        table = places.value
        key = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(key, length << 48 | rank, side="right") - 1]
            copy, slot = np.divmod(rank - row[:, 1], row[:, 2])
            keep = batch.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield pa.RecordBatch.from_arrays(
                [*keep.columns, pa.array(row[:, 3] + copy), pa.array(row[:, 4] + slot * length)],
                names=[*keep.schema.names, "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id``, ``start`` and ``length``.

    A piece's rank among those of its length is its rank in a salted group of
    the length plus the sizes of the groups before; the salts grow with the
    square root of the rows, so one very common length is many groups.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces)
    salts = max(1, int(pieces.count() ** 0.5))
    pieces = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
    sizes = pieces.groupBy("length", "_salt").count()
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(sizes.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places = _places(shortest_pack_first(histogram, max_len))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("_row", F.row_number().over(within) - 1)
        .join(sizes.select("length", "_salt", "_before"), ["length", "_salt"])
        .withColumn("_rank", (F.col("_row") + F.col("_before")).cast("long"))
    )
    # At most two patterns for each length: the table has a size bound of its own.
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "_rank").mapInArrow(
        _assign(spark.sparkContext.broadcast(places)), PIECE_SCHEMA + ", sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, max_len: int = MAX_LEN
) -> DataFrame:
    """One row for each piece of each document: its ids' digest, its sequence and its offset there."""
    return pack(token_pieces(docs, tokenizer_path, end_id, max_len), max_len)
