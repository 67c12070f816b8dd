"""Sampled SentencePiece segmentations by forward filtering and backward sampling, and lossless decoding.

A text is a lattice of vocabulary pieces. Forward filtering sums the weights
of all segmentations up to each place; backward sampling then draws pieces from
the end, each in proportion to what leads up to it. A piece of the vocabulary
weighs ``rank ** -alpha``, by its rank in the model file. Between two
bytes that no piece has side by side (as before the space of a word) every
segmentation has a border, so the lattice falls apart into chunks there: a
chunk's forward sums are computed once and kept, and all chunks of a slice are sampled side by side in numpy. Draws are
hashes of the row's key, the chunk's number and the step: the same row gives
the same pieces anywhere.

As in the model, one space goes before every text, and characters without a
piece are spelled in byte pieces. A literal U+2581 is spelled in bytes as well,
so that decoding gives back every text exactly.

Edge cases: null texts are empty and have the one piece of the leading space;
rows with null ids are keyed by null; repeated rows get equal pieces; a text of
any length is a slice of its own, whose arrays are about 100 bytes a byte of it
while it is sampled; an empty table gives an empty result; further columns come
through ``encode`` and ``decode``, and ``round_trip`` does not read them.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._shared import fields, free_names, trim, without
from helixframe.llm._text import mix, prefix_hash, span_hash, spread, text_slices

ALPHA = 1.0
SEED = 3
#: Chunks whose sums a worker keeps.
MEMO_CHUNKS = 250_000
SPACE = 0x20
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Pieces:
    """Vocabulary of a model file: bytes and log weights of its pieces."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_id = [0] * 256
        self.weight = np.zeros(size)
        self.of: dict[bytes, int] = {}
        first = 0
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                raw = bytes([int(piece[3:5], 16)])
                self.byte_id[raw[0]] = i
                self.weight[i] = -alpha * math.log(size)
                first = i + 1
            elif model.is_control(i) or model.is_unknown(i):
                raw = b""
            else:
                raw = piece.replace("▁", " ").encode()
                self.of[raw] = i
                self.weight[i] = -alpha * math.log(i - first + 2)
            self.bytes.append(raw)
        self.length = np.array([len(b) for b in self.bytes])
        self.begin = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(self.bytes), np.uint8)
        # Neighbouring bytes within some piece; between others every segmentation has a border.
        self.joined = np.zeros((256, 256), bool)
        for raw in self.of:
            x = np.frombuffer(raw, np.uint8)
            self.joined[x[:-1], x[1:]] = True
        ids = np.array(list(self.of.values()))
        c = prefix_hash(self.pool)
        hashes = span_hash(c, self.begin[ids], self.begin[ids] + self.length[ids])
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[hashes >> np.uint64(44)] = True
        self.longest = int(self.length[ids].max())
        self.byte_ids = np.array(self.byte_id)

    def lattice(self, text: np.ndarray, size: np.ndarray):
        """(start node, end node, piece) of all pieces in chunks of those sizes, side by side; a chunk has a node more than bytes."""
        n = len(text)
        chunk = np.repeat(np.arange(len(size)), size)
        stop = np.cumsum(size)[chunk] if n else np.zeros(0, np.int64)
        c = prefix_hash(text)
        head = np.append(text & 0xC0 != 0x80, True)
        head[np.cumsum(size) - size] = True
        at = np.flatnonzero(head[:-1])
        following = np.minimum(np.append(at[1:], n), stop[at])
        starts, ends, found = [], [], []
        alone = np.zeros(n, bool)
        for k in range(1, self.longest + 1):
            i = at[at + k <= stop[at]]
            if not len(i):
                break
            i = i[head[i + k] | (i + k == stop[i])]
            h = span_hash(c, i, i + k)
            hit = self.maybe[h >> np.uint64(44)]
            i, h = i[hit], h[hit]
            slot = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[slot] == h
            i = i[hit]
            starts.append(i)
            ends.append(i + k)
            found.append(self.ids[slot[hit]])
            alone[i] |= following[np.searchsorted(at, i)] == i + k
        # One way through a character without a piece: its bytes.
        bare = ~alone[at]
        i = spread(at[bare], (following - at)[bare])
        starts.append(i)
        ends.append(i + 1)
        found.append(self.byte_ids[text[i]])
        start, end, piece = (np.concatenate(x).astype(np.int64) for x in (starts, ends, found))
        own = chunk[start]
        return start + own, end + own, piece

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the pieces, one after the other."""
        return self.pool[spread(self.begin[ids], self.length[ids])]


class Sampler:
    """Forward sums of the chunks seen so far, as flat arrays of nodes and their incoming pieces."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.known, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.cumulative, self.log = np.zeros(0), np.zeros(0, np.float32)
        self.piece, self.edge = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def learn(self, text: np.ndarray, size: np.ndarray, hashes: np.ndarray) -> None:
        """Forward sums of new chunks, all chunks' places of one distance at a time."""
        first = np.cumsum(size + 1) - size - 1
        start, end, piece = self.pieces.lattice(text, size)
        distance = end - np.repeat(first, size + 1)[end]
        order = np.argsort(distance * (len(text) + len(size)) + end, kind="stable")
        start, end, piece, distance = start[order], end[order], piece[order], distance[order]
        forward = np.full(int((size + 1).sum()), -np.inf)
        forward[first] = 0
        weight = self.pieces.weight[piece]
        cuts = np.flatnonzero(np.diff(distance)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(start)], strict=True):
            if i == j:
                continue
            value = forward[start[i:j]] + weight[i:j]
            at = np.flatnonzero(np.concatenate(([True], end[i + 1 : j] != end[i : j - 1])))
            top = np.maximum.reduceat(value, at)
            safe = np.where(top > -np.inf, top, 0)
            count = np.diff(np.append(at, j - i))
            total = np.add.reduceat(np.exp(value - np.repeat(safe, count)), at)
            forward[end[i:j][at]] = np.where(total > 0, safe + np.log(np.maximum(total, 1e-300)), -np.inf)
        live = (forward[start] > -np.inf) & (forward[end] > -np.inf)
        start, end, piece = start[live], end[live], piece[live]
        log = forward[start] + weight[live] - forward[end]
        # A node's likeliest pieces come first, so that most draws look at one or two.
        order = np.lexsort((-log, end))
        end, piece, log = end[order], piece[order], log[order]
        share = np.exp(log)
        run = np.cumsum(share)
        at = np.flatnonzero(np.concatenate(([True], end[1:] != end[:-1])))
        last = np.append(at[1:], len(end)) - 1
        cumulative = run - np.repeat((run - share)[at], last - at + 1)
        cumulative[last] = 2  # a draw that rounds past the sum is the node's last piece
        edge = np.zeros(len(forward), np.int64)
        edge[end[at]] = len(self.piece) + at
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known = known[order]
        self.first = np.concatenate([self.first, len(self.edge) + first])[order]
        self.edge = np.concatenate([self.edge, edge])
        self.cumulative = np.concatenate([self.cumulative, cumulative])
        self.piece = np.concatenate([self.piece, piece.astype(np.int32)])
        self.log = np.concatenate([self.log, log.astype(np.float32)])

    def sample(self, data: np.ndarray, off: np.ndarray, seeds: np.ndarray):
        """(ids, text borders in them, log probability of each text's pieces) of a slice of texts."""
        n = len(off) - 1
        text = np.full(len(data) + n, SPACE, np.uint8)
        doc = np.repeat(np.arange(n), np.diff(off))
        text[np.arange(len(data)) + doc + 1] = data
        begin = off[:-1] + np.arange(n)
        head = text & 0xC0 != 0x80
        head[1:] &= ~self.pieces.joined[text[:-1], text[1:]]
        head[begin] = True
        s = np.flatnonzero(head)
        e = np.append(s[1:], len(text))
        c = prefix_hash(text)
        h = span_hash(c, s, e)
        order = np.argsort(h)
        new = np.concatenate(([True], h[order[1:]] != h[order[:-1]])) if len(h) else np.zeros(0, bool)
        inverse = np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(new) - 1
        seen, at = h[order[new]], order[new]
        if len(self.known) > MEMO_CHUNKS:
            self.clear()
        k = np.searchsorted(self.known, seen)
        miss = self.known[np.minimum(k, len(self.known) - 1)] != seen if len(self.known) else np.ones(len(seen), bool)
        if miss.any():
            at, size = at[miss], (e - s)[at[miss]]
            self.learn(text[spread(s[at], size)], size, seen[miss])
            k = np.searchsorted(self.known, seen)
        node0 = self.first[k][inverse]
        owner = np.searchsorted(begin, s, side="right") - 1
        number = np.arange(len(s)) - np.searchsorted(s, begin)[owner]
        key = mix(seeds[owner] + number.astype(np.uint64) * _K1)
        place = e - s
        logs = np.zeros(n)
        steps, count = [], np.zeros(len(s), np.int64)
        live = np.arange(len(s))
        step = 0
        while len(live):
            u = (mix(key[live] + _K2 * np.arange(step, step + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
            edge = self.edge[node0[live] + place[live]]
            on = np.flatnonzero(self.cumulative[edge] <= u)
            while len(on):
                edge[on] += 1
                on = on[self.cumulative[edge[on]] <= u[on]]
            piece = self.piece[edge]
            steps.append((live, piece))
            logs += np.bincount(owner[live], self.log[edge], n)
            count[live] += 1
            place[live] -= self.pieces.length[piece]
            live = live[place[live] > 0]
            step += 1
        last = np.cumsum(count) - 1
        ids = np.empty(int(count.sum()), np.int32)
        for step, (live, piece) in enumerate(steps):
            ids[last[live] - step] = piece
        borders = np.concatenate([[0], np.cumsum(np.bincount(owner, count, n).astype(np.int64))])
        return ids, borders, logs


#: Samplers of this Python worker, by model file and alpha.
_samplers: dict[tuple[str, float], Sampler] = {}


def sampler(path: str, alpha: float = ALPHA) -> Sampler:
    if (path, alpha) not in _samplers:
        _samplers[path, alpha] = Sampler(Pieces(path, alpha))
    return _samplers[path, alpha]


def _encode(path: str, alpha: float, key: str):
    def run(batches):
        own = sampler(path, alpha)
        for batch in batches:
            keep = batch.drop_columns([key])
            seeds = batch.column(key).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo, hi, data, off in text_slices(batch.column("text")):
                ids, borders, logs = own.sample(data, off, seeds[lo:hi])
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[i * 4 : j * 4]) for i, j in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids))
                rows = keep.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, lists, pa.array(crc, pa.int64()), pa.array(logs)], names=[*rows.schema.names, "ids", "ids_crc32", "log_prob"]
                )
        trim()

    return run


def _decode(path: str, alpha: float):
    def run(batches):
        pieces = sampler(path, alpha).pieces
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                out = []
                for x in part.column("ids"):
                    raw = pieces.decode(x.values.to_numpy(zero_copy_only=False)).tobytes() if x.is_valid else b" "
                    out.append(raw[1:].decode("utf-8", "replace"))
                keep = part.drop_columns(["ids"])
                yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(out, pa.string())], names=[*keep.schema.names, "decoded"])

    return run


def _round_trip(path: str, alpha: float):
    """Encode, decode and compare a slice of texts at a time; no text or ids leave the task."""

    def run(batches):
        own = sampler(path, alpha)
        for batch in batches:
            seeds = batch.column("_key").to_numpy(zero_copy_only=False).view(np.uint64)
            for lo, hi, data, off in text_slices(batch.column("text")):
                ids, borders, logs = own.sample(data, off, seeds[lo:hi])
                back = own.pieces.decode(ids)
                size = np.concatenate([[0], np.cumsum(own.pieces.length[ids])])[borders]
                raw = memoryview(ids.astype("<u4")).cast("B")
                cuts = list(zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True))
                crc = [zlib.crc32(raw[i * 4 : j * 4]) for i, j in cuts]
                same = [
                    back[i] == SPACE and np.array_equal(back[i + 1 : j], data[a:b])
                    for i, j, a, b in zip(size[:-1].tolist(), size[1:].tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(borders)), pa.array(crc, pa.int64()), pa.array(logs), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "ids_crc32", "log_prob", "lossless"],
                )
        trim()

    return run


def encode(docs: DataFrame, path: str, seed: int = SEED, alpha: float = ALPHA) -> DataFrame:
    """Add to (doc_id, text, ...) the sampled ``ids``, their crc32, and their log probability.

    Further columns come through; those named like an added one give way to it.
    """
    kept = without(docs.columns, "ids", "ids_crc32", "log_prob")
    (key,) = free_names(docs.columns, "_key")
    keyed = docs.select(*[f"`{c}`" for c in kept], F.xxhash64("doc_id", F.lit(seed)).alias(key))
    schema = [*fields(docs.schema, kept), "ids array<int>", "ids_crc32 long", "log_prob double"]
    return keyed.mapInArrow(_encode(path, alpha, key), ", ".join(schema))


def decode(rows: DataFrame, path: str, alpha: float = ALPHA) -> DataFrame:
    """Replace ``ids`` by the ``decoded`` text; null ids decode to the empty text. An own column of that name gives way."""
    kept = without(rows.columns, "decoded")
    schema = [*fields(rows.schema, without(kept, "ids")), "decoded string"]
    return rows.select(*[f"`{c}`" for c in kept]).mapInArrow(_decode(path, alpha), ", ".join(schema))


def round_trip(docs: DataFrame, path: str, seed: int = SEED, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, log_prob, lossless) of each text's sampled pieces and their decoding."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", F.lit(seed)).alias("_key"))
    return keyed.mapInArrow(_round_trip(path, alpha), "doc_id long, n_pieces long, ids_crc32 long, log_prob double, lossless boolean")
