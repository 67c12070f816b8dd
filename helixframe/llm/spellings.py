"""Spelling variants: words of a corpus that differ by one character, found through an index of positional q-grams.

Words are maximal runs of Latin letters, A-Z lower-cased; one in 97 by hash of
document and word loses a character, which plants misspellings. A word is a row
of Latin-1 bytes: one byte a character.

1. Words are counted in each task by Arrow's dictionary, then by Spark.
2. Each word, padded at both ends, has one gram of ``Q`` characters at each
   position. One edit leaves at least T = l - 1 grams (both of length l) or l
   (lengths l and l + 1) at their position or, behind an inserted character, at
   the next: the count filter's bound. So two near words share one of the four
   grams that are rarest in the corpus in each of them. The index's posting lists
   are kept by (gram, position, shorter length): length and position limits are
   part of the key, and only those four grams are posted.
3. A task reads whole posting lists in order of their key. Within a list, words
   get their four rarest grams of that list in turn; the lists of these are merged
   by one sort of their pairs, pairs below T shared grams go, and the rest are
   verified. A pair is reported by the list of the rarest gram that it shares, so
   it leaves once.
4. A list of more than ``TILE`` words is dealt to tiles of two blocks each.
5. The form of a word is its near word of largest count, if that is at least twice
   its own. Roots follow forms by pointer doubling: counts double at each step,
   so chains are short.

Edge cases: null and empty texts have no words; a null id hashes as an empty one;
equal rows count each; ties between near words go to the smaller in code-point
order; a word of any length is taken whole; further columns are not read, whatever
their names; an empty table, or one without frequent words, gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._shared import count_blocks, materialize, sum_counts, trim
from helixframe.llm._text import LOWER, distinct_counts, distinct_sorted, spread, text_slices, word_bounds

MIN_LENGTH = 5
MIN_COUNT = 3
#: One in so many (document, word) pairs loses a character.
PLANTED = 97
#: Characters of a gram, and grams of a word that are posted.
Q, PREFIX = 3, 4
#: a-z, 64 further letters, and the padding.
SYMBOLS = 91
GRAMS = SYMBOLS**Q
#: Words of a posting list in one block.
TILE = 8192
#: Postings that a task works on at once, and bytes of pairs that it compares at once.
CHUNK_ROWS, PAIR_BYTES = 1 << 16, 1 << 26
SLICE = 8 << 20

#: Latin-1 bytes to symbols.
CODE = np.zeros(256, np.int64)
CODE[97:123] = np.arange(1, 27)
CODE[0xC0:] = np.arange(27, 91)


def latin(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with each letter as its Latin-1 byte, a-z in place of A-Z, and all else as zero."""
    lead = data == 0xC3
    out = LOWER[data]
    out[~((out >= 97) & (out <= 122))] = 0
    after = np.flatnonzero(lead) + 1
    out[after] = data[after] + np.uint8(0x40)
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(~lead)])
    return out[~lead], at[off]


def _planted(word: bytes, h: int) -> bytes:
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _counted(batches):
    """(word, n) of each slice of texts."""
    for batch in batches:
        ids = [b"%d:" % x if x is not None else b":" for x in batch.column("doc_id").to_pylist()]
        ids = [zlib.crc32(x) for x in ids]
        for lo, _, data, off in text_slices(batch.column("text"), SLICE):
            data, off = latin(data, off)
            s, e, doc = word_bounds(data, off, np.arange(256) > 0)
            ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(e - s).astype(np.int32)])
            raw = data[spread(s, e - s)].tobytes()
            words = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw)]).dictionary_encode()
            names = words.dictionary.to_pylist()
            n = max(1, len(names))
            pair, times = distinct_counts(doc * n + np.asarray(words.indices, np.int64))
            doc, word = pair // n + lo, pair % n
            whole = [x.decode("latin-1").encode() for x in names]
            h = np.fromiter(map(zlib.crc32, map(whole.__getitem__, word.tolist()), map(ids.__getitem__, doc.tolist())), np.int64, len(word))
            hit = h % PLANTED == 0
            total = np.zeros(n, np.int64)
            np.add.at(total, word[~hit], times[~hit])
            # Few pairs are hit: one in 97.
            cut = [_planted(names[w], x) for w, x in zip(word[hit].tolist(), h[hit].tolist(), strict=True)]
            keep = [k for k in np.flatnonzero(total).tolist() if len(names[k]) >= MIN_LENGTH]
            more = [k for k, w in enumerate(cut) if len(w) >= MIN_LENGTH]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in keep] + [cut[k] for k in more], pa.binary()), pa.array(np.concatenate([total[keep], times[hit][more]]), pa.int64())], names=["word", "n"]
            )
    trim()


def word_counts(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(word as Latin-1 bytes, n) of the words with at least ``least`` occurrences."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_counted, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def grams(words: np.ndarray) -> np.ndarray:
    """Grams (position by position) of padded words of one length, given as rows of bytes."""
    m, size = words.shape
    code = np.zeros((m, size + 2 * (Q - 1)), np.int64)
    code[:, Q - 1 : Q - 1 + size] = CODE[words]
    out = code[:, : size + Q - 1].copy()
    for k in range(1, Q):
        out = out * SYMBOLS + code[:, k : size + Q - 1 + k]
    return out


def _by_length(column: pa.Array, most: int = PAIR_BYTES):
    """(rows, words as a matrix) of each length of a binary column; ``most`` bounds a matrix's bytes."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    length = np.diff(off)
    order = np.argsort(length, kind="stable")
    for size in np.unique(length).tolist():
        rows = order[np.searchsorted(length[order], size) : np.searchsorted(length[order], size, "right")]
        step = max(1, most // (32 * (size + 1)))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            yield part, data[off[part][:, None] + np.arange(size)] if size else np.zeros((len(part), 0), np.uint8)


def _frequencies(batches):
    total = np.zeros(GRAMS, np.int64)
    for batch in batches:
        for _, words in _by_length(batch.column("word")):
            total += np.bincount(grams(words).ravel(), minlength=GRAMS)
    yield count_blocks(total)


def frequencies(words: DataFrame) -> np.ndarray:
    """Occurrences of each gram in the words: ``GRAMS`` numbers, whatever the input."""
    return sum_counts(words.select("word").mapInArrow(_frequencies, "block long, counts binary"), GRAMS)


def rarest(gram: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Positions of each row's first ``PREFIX`` grams in order of (how often, gram, position)."""
    return np.argsort(often << 20 | gram, axis=1, kind="stable")[:, :PREFIX]


def _key(size: np.ndarray | int, gram: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Key of a posting list; sizes and positions beyond its bits share lists, which costs time only."""
    return (np.asarray(size, np.int64) & (1 << 23) - 1) << 40 | gram << 20 | at & (1 << 20) - 1


def _posted(shared, whole: bool):
    """Postings (key, long, word, n) of words; without ``whole`` the keys alone."""

    def run(batches):
        often = shared.value
        for batch in batches:
            column, n = batch.column("word"), np.asarray(batch.column("n"))
            for rows, words in _by_length(column):
                gram = grams(words)
                at = rarest(gram, often[gram])
                picked = np.take_along_axis(gram, at, 1)
                size = words.shape[1]
                # As the word of equal or shorter length; as the longer one behind or before the edit.
                lists = [(_key(size, picked, at), 0), (_key(size - 1, picked, at), 1), (np.where(at > 0, _key(size - 1, picked, at - 1), -1), 1)]
                key = np.concatenate([k for k, _ in lists], 1)
                side = np.concatenate([np.full(k.shape, x) for k, x in lists], 1)
                row = np.repeat(np.arange(len(words)), key.shape[1])
                key, side = key.ravel(), side.ravel()
                order = np.lexsort([side, key, row])
                key, side, row = key[order], side[order], row[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
                new &= key >= 0
                key, side, row = key[new], side[new], rows[row[new]]
                if whole:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(side.astype(np.int32)), column.take(pa.array(row)), pa.array(n[row])], names=["key", "long", "word", "n"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])

    return run


def postings(words: DataFrame, often: np.ndarray, tile: int = TILE) -> DataFrame:
    """The index: (key, tile, block, long, word, n); lists of more than ``tile`` words go to tiles of two blocks (equal ones: that block alone)."""
    shared = words.sparkSession.sparkContext.broadcast(often)
    rows = words.mapInArrow(_posted(shared, True), "key long, long int, word binary, n long")
    sizes = words.mapInArrow(_posted(shared, False), "key long").groupBy("key").agg(F.count("*").alias("_m")).where(F.col("_m") > tile)
    sizes = materialize(sizes.select("key", F.ceil(F.col("_m") / tile).cast("int").alias("_k")))
    if sizes.isEmpty():
        return rows.select("key", F.lit(0).alias("tile"), F.lit(0).alias("block"), "long", "word", "n")
    rows = rows.join(sizes, "key", "left").withColumn("_k", F.coalesce("_k", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("word"), F.col("_k")).cast("int"))
    other = F.explode(F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda x: F.least(x, F.col("block")) * F.col("_k") + F.greatest(x, F.col("block"))))
    # The sign tells tiles of two blocks from tiles of one.
    rows = rows.withColumn("tile", other)
    cross = F.floor(F.col("tile") / F.col("_k")) != F.col("tile") % F.col("_k")
    return rows.select("key", F.when(cross, -F.col("tile") - 1).otherwise(F.col("tile")).cast("int").alias("tile"), "block", "long", "word", "n")


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values of a sorted array."""
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]]))
    return at, np.diff(np.append(at, len(x)))


def _merge(base: np.ndarray, base_row: np.ndarray, longer: np.ndarray, longer_row: np.ndarray, rows: int):
    """Merged posting lists of one chunk: distinct pairs of rows that share an entry, as (a, b), base rows first in a."""
    order = np.argsort(base, kind="stable")
    base, base_row = base[order], base_row[order]
    at, n = _runs(base)
    # Each entry with those behind it in its run.
    behind = np.repeat(at + n, n) - np.arange(len(base)) - 1
    left = np.repeat(np.arange(len(base)), behind)
    pairs = [base_row[left] * rows + base_row[spread(np.arange(len(base)) + 1, behind)]]
    for shift in (0, 1):
        x = longer - shift
        lo, hi = np.searchsorted(base, x), np.searchsorted(base, x, "right")
        pairs.append(base_row[spread(lo, hi - lo)] * rows + np.repeat(longer_row, hi - lo))
    found = distinct_sorted(np.concatenate(pairs))
    return found // rows, found % rows


def _owner(gx: np.ndarray, same: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shared gram of each pair, and its position in the first word."""
    order = np.where(same, often[gx] << 20 | gx, np.iinfo(np.int64).max)
    at = order.argmin(1)
    return np.take_along_axis(gx, at[:, None], 1)[:, 0], at


def _near(key: np.ndarray, tile: np.ndarray, block: np.ndarray, side: np.ndarray, words: list[tuple[np.ndarray, np.ndarray]], size: int, often: np.ndarray):
    """Near pairs of rows of one chunk with ``size`` characters (side 0) or one more (side 1); ``words``: rows and matrices of both sides."""
    (rows0, text0), (rows1, text1) = words
    rows = len(key)
    gram = [grams(text0), grams(text1)]
    shard = np.zeros(rows, np.int64)
    shard[1:] = np.cumsum((key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))
    # How often a gram occurs in its list, then the rarest of each row.
    ids = [shard[r][:, None] << 20 | g for r, g in zip((rows0, rows1), gram, strict=True)]
    all_ids = np.concatenate([x.ravel() for x in ids])
    values, counts = distinct_counts(all_ids)
    entries = []
    for r, g, x in zip((rows0, rows1), gram, ids, strict=True):
        at = rarest(g, counts[np.searchsorted(values, x)]) if len(r) else np.zeros((0, PREFIX), np.int64)
        entry = np.take_along_axis(np.searchsorted(values, x), at, 1) * (size + Q + 2) + at + 1 if len(r) else at
        entries.append((entry.ravel(), np.repeat(r, at.shape[1])))
    a, b = _merge(*entries[0], *entries[1], rows)
    keep = (tile[a] >= 0) | (block[a] != block[b])
    a, b = a[keep], b[keep]
    place = np.zeros(rows, np.int64)
    place[rows0], place[rows1] = np.arange(len(rows0)), np.arange(len(rows1))
    out = [(np.zeros(0, np.int64),) * 2]
    step = max(1, PAIR_BYTES // (64 * (size + 4)))
    for kind in (0, 1):
        x, y = a[side[b] == kind], b[side[b] == kind]
        for k in range(0, len(x), step):
            i, j = x[k : k + step], y[k : k + step]
            gx, gy = gram[0][place[i]], gram[kind][place[j]]
            same = gx == gy if kind == 0 else (gx == gy[:, :-1]) | (gx == gy[:, 1:])
            ok = same.sum(1) >= (size - 1 if kind == 0 else size)
            i, j, gx, same = i[ok], j[ok], gx[ok], same[ok]
            p, q = text0[place[i]], (text0, text1)[kind][place[j]]
            if kind == 0:
                ok = (p != q).sum(1) == 1
            else:
                head = np.cumprod(p == q[:, :-1], 1).sum(1)
                tail = np.cumprod((p == q[:, 1:])[:, ::-1], 1).sum(1)
                ok = head + tail >= size
            g, at = _owner(gx[ok], same[ok], often) if ok.any() else (np.zeros(0, np.int64),) * 2
            i, j = i[ok], j[ok]
            mine = key[i] == _key(size, g, at)
            out.append((i[mine], j[mine]))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


PAIRS = "word binary, near binary, near_n long"


def near_pairs(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, near, near_n) of all words at one edit from each other, both ways, each once."""
    often = frequencies(words)
    shared = words.sparkSession.sparkContext.broadcast(often)

    def solve(table: pa.Table):
        columns = {c: np.asarray(table.column(c)) for c in ("key", "tile", "block", "long", "n")}
        column = table.column("word").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
        key, tiles, block, side, n = columns.values()
        off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        size = np.diff(off).astype(np.int64) - side
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        for length in np.unique(size).tolist():
            own = np.flatnonzero(size == length)
            words = []
            for kind in (0, 1):
                at = np.flatnonzero(side[own] == kind)
                words.append((at, data[off[own[at]].astype(np.int64)[:, None] + np.arange(length + kind)]))
            if not len(words[0][0]):
                continue
            a, b = _near(key[own], tiles[own], block[own], side[own], words, length, shared.value)
            a, b = own[a], own[b]
            one, two = np.concatenate([a, b]), np.concatenate([b, a])
            yield pa.RecordBatch.from_arrays([column.take(pa.array(one)), column.take(pa.array(two)), pa.array(n[two], pa.int64())], names=["word", "near", "near_n"])

    def run(batches):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows >= CHUNK_ROWS:
                key, tiles = np.asarray(held.column("key")), np.asarray(held.column("tile"))
                last = int(np.flatnonzero((key != key[-1]) | (tiles != tiles[-1])).max(initial=-1)) + 1
                if last:
                    yield from solve(held.slice(0, last))
                    held = held.slice(last)
        if held is not None and held.num_rows:
            yield from solve(held)
        trim()

    index = postings(words, often, tile)
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(parts, "key", "tile").sortWithinPartitions("key", "tile").mapInArrow(run, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of the chain of forms, by pointer doubling; each round halves what is left of it."""
    found = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = materialize(found.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if after.where("_moved").isEmpty():
            return after.drop("_moved")
        found = after.drop("_moved")


def variants(docs: DataFrame, min_count: int = MIN_COUNT, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the frequent words of ``docs``."""
    words = materialize(word_counts(docs, min_count))
    near = near_pairs(words, tile).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    rows = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
    formed = F.col("form_n") >= 2 * F.col("n")
    rows = materialize(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")))
    rows = rows.join(roots(rows.where("form is not null")), "word", "left")
    text = lambda c: F.decode(c, "ISO-8859-1")
    return rows.select(text("word").alias("word"), text("form").alias("form"), text(F.coalesce("root", "word")).alias("root"), "n", "n_near", "form_n")
