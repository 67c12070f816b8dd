"""Similarity join of documents on word n-grams: exact Jaccard links by prefix filtering, and their components.

A document's set holds its distinct shingles of ``WORDS`` words. Sets are
ordered rare-first by how many sets hold each shingle. Two sets with Jaccard
similarity of at least 3/4 share a shingle in their prefixes (a quarter of each
set), so candidates come from an equi-join on prefix shingles with length and
positional filters, and a suffix filter on bitmaps of the sets of documents that
share common shingles; a pair leaves from one bucket (that of the rarest common
shingle it shares), and is then verified once on texts. Shingles of one set only
cannot join and do not travel.

To keep groups of copies linear:

1. Documents with equal sets are one node, found by a fingerprint and a minimum.
2. A first round tries each node with one pivot for each of its three rarest
   shared shingles; two more, where components of these links still differ, for
   its next dozen and for the rest of its prefix. A shingle's pivot is the
   document of the least hash with it, so that pivots vary.
3. The last round takes whole prefixes, and pairs only documents whose
   components still differ. No link between components is lost: every linked
   pair shares a prefix shingle, and is either verified or inside one component.

The counts come from batches of documents that deal their shingles to buckets,
where they are summed, and get the sums back; hashes of 32 bits within a bucket
do for that, as any order is a valid one. Very frequent shingles are dealt to
tiles of salts, so that no task gathers all their documents.

Edge cases: null and empty texts have empty sets and link with nothing (their
component is their own id); texts of one to four words are one shingle; rows
with a null id keep their count and get a null component; repeated rows get
equal results; ids are expected to name one text, and rows of one id with
different texts are rows of their own with equal ids; an empty table gives an
empty result; a text of any length is a slice of its own, whose arrays are about
60 bytes a byte of it; further columns are not read, and ``keep_one`` hands them
through, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm._shared import components, free_names, likely, materialize, trim
from helixframe.llm._text import (
    LOWER,
    NOT_SPACE,
    distinct_counts,
    distinct_sorted,
    merge_counts,
    mix,
    pack_keys,
    text_slices,
    unpack_keys,
    word_bounds,
    word_hashes,
)

WORDS = 5
#: Documents in a batch that counts its shingles at once.
BATCH_DOCS = 1500
#: Documents of one shingle in one tile.
TILE_ROWS = 200_000
#: Documents of one shingle that meet its pivot in one task.
PIVOT_ROWS = 256
#: Shared shingles (first, how many) of each pivot round; the last takes the rest of the prefix.
ROUNDS = ((1, 3), (4, 12), (16, 1 << 30))
_WEIGHTS = np.array([pow(0x9FB21C651E98DF25, k, 1 << 64) for k in range(WORDS)], np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data = LOWER[data]
    s, e, doc = word_bounds(data, off, NOT_SPACE)
    h = word_hashes(data, s, e)
    at = np.searchsorted(doc, np.arange(len(off)))
    n = len(h)
    whole = np.zeros(max(0, n - WORDS + 1), np.uint64)
    for k in range(WORDS if n >= WORDS else 0):
        whole += h[k : n - WORDS + 1 + k] * _WEIGHTS[k]
    whole = mix(whole)
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if j - i >= WORDS:
            out.append(distinct_sorted(whole[i : j - WORDS + 1]))
        elif j > i:
            tail = np.uint64(j - i) << np.uint64(56)
            out.append(mix((h[i:j] * _WEIGHTS[: j - i]).sum(keepdims=True) ^ tail))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have 100 * intersection >= 75 * union."""
    n, m = len(a), len(b)
    if not n or not m or 4 * min(n, m) < 3 * max(n, m):
        return False
    need = -(-3 * (n + m) // 7)
    # Suffix filter: pivots cut both sets; what lies between two of them can only meet there.
    pivots = b[np.linspace(0, m - 1, 18, dtype=int)[1:-1]]
    p = np.diff(np.concatenate([[0], np.searchsorted(a, pivots), [n]]))
    q = np.diff(np.concatenate([[0], np.searchsorted(b, pivots), [m]]))
    if np.minimum(p, q).sum() < need:
        return False
    both = np.sort(np.concatenate([a, b]), kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= 75 * (n + m - same)


# Fingerprints of sets


def _profile(batches):
    for batch in batches:
        docs = batch.column("doc_id")
        for lo, hi, data, off in text_slices(batch.column("text")):
            sets = shingle_sets(data, off)
            n = np.array([len(x) for x in sets], np.int64)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            owner = np.cumsum(np.concatenate([[0], n]))
            fp = []
            for salt in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(flat ^ np.uint64(salt)))])
                fp.append((sums[owner[1:]] - sums[owner[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [docs.slice(lo, hi - lo), pa.array(n), pa.array(fp[0]), pa.array(fp[1])], names=["doc_id", "n", "fp1", "fp2"]
            )


# How many sets hold each shingle


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    return [x for _, _, data, off in text_slices(table.column("text")) for x in shingle_sets(data, off)]


def _codes(flat: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket and 32 further bits of each shingle."""
    return (flat & np.uint64(0xFFFFFFFF)) % np.uint64(buckets) << np.uint64(32) | flat >> np.uint64(32)


def _deal_shingles(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        code, count = distinct_counts(_codes(np.concatenate(_sets_of(table)), buckets))
        bucket = (code >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(code) else np.zeros(0, np.int64)
        ends = np.append(at[1:], len(code))
        packed = [pack_keys(code[i:j] & np.uint64(0xFFFFFFFF), count[i:j]) for i, j in zip(at, ends, strict=False)]
        return pa.table(
            {
                "bucket": pa.array(bucket[at]),
                "batch": pa.array([table.column("batch")[0].as_py()] * len(at), pa.int64()),
                "shingles": pa.array(packed, pa.binary()),
            }
        )

    return run


def _sum_shingles(table: pa.Table) -> pa.Table:
    parts = [unpack_keys(x) for x in table.column("shingles").to_pylist()]
    key, total = merge_counts(parts)
    level = np.minimum(63, np.ceil(2 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
    back = [zlib.compress(level[np.searchsorted(key, k)].tobytes(), 1) for k, _ in parts]
    return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "levels": pa.array(back, pa.binary())})


def prefix_length(n):
    """A set shares a prefix shingle of so many with any set of similarity 3/4 or more."""
    return n - -(-3 * n // 4) + 1


#: Shingles that so many sets hold bring a bitmap of each of their documents, for the suffix filter on candidates.
COMMON = 16
_COMMON_LEVEL = np.uint64(np.ceil(2 * np.log2(COMMON)))
PREFIX = "doc_id long, n long, keys array<long>, places array<int>, bits binary"


def bitmap(x: np.ndarray) -> bytes:
    """A set's shingles as bits by hash: eight or more bits a shingle, a power of two."""
    size = 64
    while size < 8 * len(x):
        size *= 2
    marks = np.zeros(size, np.uint8)
    marks[(x >> np.uint64(8)).astype(np.int64) & (size - 1)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def alone_bits(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of two arrays of bitmaps: bits of a that b has not, and the other way.

    Each stands for a shingle at least that the other set has not. A longer
    bitmap is folded to the size of the other one.
    """

    def folded(x, width):
        while x.shape[1] > width:
            x = x[:, : x.shape[1] // 2] | x[:, x.shape[1] // 2 :]
        return x

    width = min(a.shape[1], b.shape[1])
    a, b = folded(a, width), folded(b, width)
    return np.bitwise_count(a & ~b).sum(1, dtype=np.int64), np.bitwise_count(b & ~a).sum(1, dtype=np.int64)


def _prefixes(buckets: int):
    """Rare-first prefixes of a batch's sets, without the shingles of one set."""

    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        sets = _sets_of(table)
        code = _codes(np.concatenate(sets or [np.zeros(0, np.uint64)]), buckets)
        distinct = distinct_sorted(code)
        rows = sorted(back.select(["bucket", "levels"]).to_pylist(), key=lambda r: r["bucket"])
        levels = np.frombuffer(b"".join(zlib.decompress(r["levels"]) for r in rows), np.uint8)
        level = levels[np.searchsorted(distinct, code)].astype(np.uint64)
        keys, places, bits, begin = [], [], [], 0
        for x in sets:
            own = level[begin : begin + len(x)]
            begin += len(x)
            key = np.sort(own << np.uint64(58) | x >> np.uint64(6))[: prefix_length(len(x)) if len(x) else 0]
            shared = np.flatnonzero(key >> np.uint64(58))
            keys.append(key[shared].view(np.int64))
            places.append(shared.astype(np.int32))
            bits.append(bitmap(x) if len(shared) and key[shared[-1]] >> np.uint64(58) >= _COMMON_LEVEL else b"")
        n = np.array([len(x) for x in sets], np.int64)
        out = pa.table({"doc_id": table.column("doc_id"), "n": n, "keys": pa.array(keys, pa.list_(pa.int64())), "places": pa.array(places, pa.list_(pa.int32())), "bits": pa.array(bits, pa.binary())})
        trim()
        return out

    return run


# Verification


def _check(batches):
    last: dict = {}

    def of(doc, text):
        if doc not in last:
            if len(last) > 64:
                last.clear()
            raw = np.frombuffer((text or "").encode(), np.uint8)
            last[doc] = shingle_sets(raw, np.array([0, len(raw)]))[0]
        return last[doc]

    for batch in batches:
        cols = [batch.column(c) for c in ("a", "b", "text_a", "text_b")]
        a, b = cols[0].to_pylist(), cols[1].to_pylist()
        keep = [links(of(a[i], cols[2][i].as_py()), of(b[i], cols[3][i].as_py())) for i in range(len(a))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose texts link; each pair's texts meet once."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    texts = likely(docs.where("doc_id is not null").select("doc_id", "text"), "doc_id", ids)
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(_check, "a long, b long")


# Last round: whole prefixes

POSTINGS = "bucket long, ids binary, sizes binary, alone binary, parts binary, bits array<binary>, common array<binary>, keys binary, doc binary, place binary"
#: Documents of a run on each side of a tile of pairs.
TILE = 512
#: Pairs of postings that are held before they are filtered.
HELD_PAIRS = 1_000_000


def _tiles(tile_rows: int) -> np.ndarray:
    """Salts of the shingles of each level, which holds those of up to 2**(level / 2) sets."""
    return np.maximum(1, np.ceil(2 ** (np.arange(64) / 2) / tile_rows)).astype(np.int64)


def _tile_key(key, one, other):
    """The key of a shingle's tile of two salts."""
    return mix(key + mix(np.minimum(one, other) * np.uint64(0x100000001) + np.maximum(one, other)))


def _deal(buckets: int, tile_rows: int):
    tiles = _tiles(tile_rows)

    def run(batches):
        held, count = [], 0

        def flush():
            ids = np.array([x[0] for x in held], np.int64)
            sizes = np.array([x[1] for x in held], np.int32)
            alone = np.array([x[4][0] for x in held], np.int32)
            parts = np.array([x[2] for x in held], np.int64)
            keys = np.concatenate([x[3] for x in held])
            bits = [x[5] for x in held]
            doc = np.repeat(np.arange(len(held), dtype=np.int32), [len(x[3]) for x in held])
            place = np.concatenate([x[4] for x in held])
            common = keys >> np.uint64(58) >= _COMMON_LEVEL
            shared = [x[3][x[3] >> np.uint64(58) >= _COMMON_LEVEL].tobytes() for x in held]
            # A very frequent shingle is dealt to tiles of two salts each, so that all its pairs meet.
            salts = tiles[(keys >> np.uint64(58)).astype(np.int64)]
            hot = salts > 1
            if hot.any():
                at = np.flatnonzero(hot)
                own = mix(ids.view(np.uint64))[doc[at]] % salts[at].astype(np.uint64)
                again = np.repeat(np.arange(len(at)), salts[at])
                other = (np.arange(len(again)) - np.repeat(np.cumsum(salts[at]) - salts[at], salts[at])).astype(np.uint64)
                tiled = _tile_key(keys[at][again], own[again], other)
                keys = np.concatenate([keys[~hot], tiled])
                doc = np.concatenate([doc[~hot], doc[at][again]])
                place = np.concatenate([place[~hot], place[at][again]])
                common = np.concatenate([common[~hot], common[at][again]])
            bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows = []
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                who, index = np.unique(doc[part], return_inverse=True)
                with_bits = np.bincount(index, common[part], len(who)) > 0
                own_bits, own_common = ([x[i] if w else b"" for i, w in zip(who.tolist(), with_bits.tolist(), strict=True)] for x in (bits, shared))
                rows.append((int(bucket[part[0]]), ids[who].tobytes(), sizes[who].tobytes(), alone[who].tobytes(), parts[who].tobytes(), own_bits, own_common, keys[part].tobytes(), index.astype(np.int32).tobytes(), place[part].tobytes()))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64(), *[pa.binary()] * 4, *[pa.list_(pa.binary())] * 2, *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                names=["bucket", "ids", "sizes", "alone", "parts", "bits", "common", "keys", "doc", "place"],
            )

        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "n", "part", "keys", "places", "bits")]
            for i in range(batch.num_rows):
                doc, n, part = (c[i].as_py() for c in columns[:3])
                keys, places = (c[i].values.to_numpy() for c in columns[3:5])
                held.append((doc, n, part, keys.view(np.uint64), places, columns[5][i].as_py()))
                count += len(keys)
                if count > 1_000_000:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()
        trim()

    return run


def _fits(bits: list[bytes], sizes: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Suffix filter: which pairs of rows may have sets of similarity 3/4, by bitmaps; rows without one pass."""
    fits = np.ones(len(u), bool)
    width = np.array([len(x) for x in bits])
    kind = width[u] * (1 << 32) + width[v]
    for k in np.unique(kind[(width[u] > 0) & (width[v] > 0)]).tolist():
        of = np.flatnonzero(kind == k)
        for lo in range(0, len(of), max(1, (1 << 23) // (k >> 32))):
            part = of[lo : lo + max(1, (1 << 23) // (k >> 32))]
            a, b = (np.frombuffer(b"".join([bits[i] for i in x[part].tolist()]), np.uint8).reshape(len(part), -1) for x in (u, v))
            only_a, only_b = alone_bits(a, b)
            n, m = sizes[u[part]], sizes[v[part]]
            fits[part] = 7 * np.minimum(n - only_a, m - only_b) >= 3 * (n + m)
    return fits


def _home(a: bytes, b: bytes, id_a: int, id_b: int, buckets: int, tiles: np.ndarray) -> int:
    """The bucket of the rarest common shingle that two documents share, -1 without one."""
    both = np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True)
    if not len(both):
        return -1
    key, salts = both[:1], tiles[int(both[0] >> np.uint64(58))]
    if salts > 1:
        one, other = mix(np.array([id_a, id_b], np.int64).view(np.uint64)) % np.uint64(salts)
        key = _tile_key(key, one, other)
    return int(mix(key)[0] % np.uint64(buckets))


def _pairs(buckets: int, tile_rows: int):
    """Pairs of documents of different components that share a shingle of a bucket and pass the filters.

    A pair that shares common shingles leaves from the bucket of the rarest one
    only, so that it is not told by each of them.
    """
    tiles = _tiles(tile_rows)

    def run(table: pa.Table) -> pa.Table:
        pairs = _pairs_of(table, buckets, tiles)
        trim()
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return run


def _pairs_of(table: pa.Table, buckets: int, tiles: np.ndarray) -> np.ndarray:
    own_bucket = table.column("bucket")[0].as_py()
    cols: dict[str, list] = {k: [] for k in ("ids", "sizes", "alone", "parts", "keys", "place", "row")}
    bits: list[bytes] = []
    common: list[bytes] = []
    for row in table.select([c for c in table.column_names if c != "bucket"]).to_pylist():
        doc = np.frombuffer(row["doc"], np.int32)
        cols["row"].append(doc + len(bits))
        bits += row["bits"]
        common += row["common"]
        for k, kind in (("ids", np.int64), ("sizes", np.int32), ("alone", np.int32), ("parts", np.int64)):
            cols[k].append(np.frombuffer(row[k], kind)[doc])
        cols["keys"].append(np.frombuffer(row["keys"], np.uint64))
        cols["place"].append(np.frombuffer(row["place"], np.int32))
    ids, sizes, alone, parts, keys, place, row_of = (np.concatenate(x) for x in cols.values())
    # Runs of one shingle, in order of size: what is too long for a document comes after all that is not.
    order = np.lexsort((ids, sizes, keys))
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    begin, end = at[:-1], at[1:]
    many = end - begin > 1
    begin, end = begin[many], end[many]
    own = parts[order]
    if len(begin):
        ends = np.stack([begin, end], 1).ravel()
        ends[-1] = min(ends[-1], len(own))
        padded = np.append(own, own[-1])
        low = np.minimum.reduceat(padded, ends)[::2]
        high = np.maximum.reduceat(padded, ends)[::2]
        differ = low != high
        begin, end = begin[differ], end[differ]
    sizes_of, ids_of = np.zeros(len(bits), np.int64), np.zeros(len(bits), np.int64)
    sizes_of[row_of], ids_of[row_of] = sizes, ids

    def settled(found: list[np.ndarray]) -> np.ndarray:
        """Pairs of ids, of pairs of postings, that pass the filters; one that shares many shingles of the bucket is seen once."""
        pairs = np.concatenate(found)
        u, v = row_of[pairs[:, 0]], row_of[pairs[:, 1]]
        u, v = np.divmod(np.unique(np.minimum(u, v) * len(bits) + np.maximum(u, v)), len(bits))
        keep = _fits(bits, sizes_of, u, v)
        for k in np.flatnonzero(keep).tolist():
            i, j = u[k], v[k]
            if common[i] and common[j]:
                keep[k] = _home(common[i], common[j], ids_of[i], ids_of[j], buckets, tiles) in (own_bucket, -1)
        return np.sort(np.stack([ids_of[u[keep]], ids_of[v[keep]]], 1), axis=1)

    found, kept, count = [], [np.zeros((0, 2), np.int64)], 0
    for i, j in zip(begin.tolist(), end.tolist(), strict=True):
        run = order[i:j]
        n, p, w, c, d = sizes[run].astype(np.int64), place[run].astype(np.int64), alone[run].astype(np.int64), parts[run], ids[run]
        for lo in range(0, len(run), TILE):
            x = slice(lo, lo + TILE)
            stop = int(np.searchsorted(n, 4 * n[x][-1] // 3, side="right"))
            for to in range(lo, stop, TILE):
                y = slice(to, min(to + TILE, stop))
                n1, n2, p1, p2 = n[x, None], n[None, y], p[x, None], p[None, y]
                ok = (c[x, None] != c[None, y]) & (d[x, None] != d[None, y]) & (4 * n1 >= 3 * n2)
                if to == lo:
                    ok &= np.arange(len(p1))[:, None] < np.arange(p2.shape[1])
                # Shingles of one set only come first and are not shared.
                most = np.minimum(p1 - w[x, None], p2 - w[None, y]) + np.minimum(n1 - p1, n2 - p2)
                ok &= 7 * most >= 3 * (n1 + n2)
                u, v = np.nonzero(ok)
                if len(u):
                    found.append(np.stack([run[lo + u], run[to + v]], 1))
                    count += len(u)
                if count > HELD_PAIRS:
                    kept.append(settled(found))
                    found, count = [], 0
    if found:
        kept.append(settled(found))
    return np.unique(np.concatenate(kept), axis=0)


def _with_parts(prefixes: DataFrame, found: DataFrame | None) -> DataFrame:
    """Prefixes with the component of their document so far; documents without links are their own."""
    if found is None:
        return prefixes.withColumn("part", F.col("doc_id"))
    named = found.select(F.col("node").alias("doc_id"), "component")
    return prefixes.join(named, "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")).drop("component")


def _pivots(prefixes: DataFrame, begin: int, count: int) -> DataFrame:
    """Pairs of each document with the pivots of some of its shared shingles, where components differ and sizes allow a link."""
    rows = prefixes.select("doc_id", "n", "part", F.col("places")[0].alias("u"), F.explode(F.slice("keys", begin, count)).alias("f"))
    # A shingle's key tells about how many sets hold it: frequent ones meet their pivot in many tasks.
    salts = F.ceil(F.pow(F.lit(2.0), F.shiftrightunsigned("f", 58) / 2) / PIVOT_ROWS)
    order = F.xxhash64("f", "doc_id").alias("o")
    pivot = rows.groupBy("f").agg(
        F.min(F.struct(order, "part", "n", "doc_id", "u")).alias("p"), F.min("part").alias("low"), F.max("part").alias("high")
    )
    pivot = pivot.where("low < high").select(
        "f", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), "p.part", "p.n", "p.doc_id", "p.u"
    ).toDF("f", "salt", "part_p", "m", "a", "w")
    return (
        rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts)).join(pivot, ["f", "salt"])
        .where("part <> part_p and 4 * least(n, m) >= 3 * greatest(n, m) and 7 * least(n - u, m - w) >= 3 * (n + m)")
        .select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b"))
        .distinct()
    )


def _untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    """The pairs that no earlier round has verified, written to the shared folder."""
    return materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profile = materialize(docs.mapInArrow(_profile, "doc_id long, n long, fp1 long, fp2 long"))
    nodes = materialize(
        profile.where("n > 0 and doc_id is not null").groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep"))
    )
    reps = nodes.select(F.col("rep").alias("doc_id"), "n")
    batches = max(1, -(-nodes.count() // BATCH_DOCS))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), batches // 4)

    texts = likely(docs.where("doc_id is not null"), "doc_id", reps)
    texts = texts.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)))
    shingles = texts.groupBy("batch").applyInArrow(_deal_shingles(buckets), "bucket long, batch long, shingles binary")
    levels = shingles.groupBy("bucket").applyInArrow(_sum_shingles, "batch long, bucket long, levels binary")
    prefixes = texts.groupBy("batch").cogroup(levels.groupBy("batch")).applyInArrow(_prefixes(buckets), PREFIX)
    prefixes = materialize(prefixes.where("size(keys) > 0").join(reps, ["doc_id", "n"], "left_semi"))

    found = tried = None
    for begin, count in ROUNDS:
        pairs = _untried(_pivots(_with_parts(prefixes, found), begin, count), tried)
        linked = verify(docs, pairs)
        found = components(linked if found is None else linked.union(found))
        tried = pairs if tried is None else tried.union(pairs)

    parts = _with_parts(prefixes, found)
    dealt = parts.mapInArrow(_deal(buckets, tile_rows), POSTINGS)
    pairs = dealt.groupBy("bucket").applyInArrow(_pairs(buckets, tile_rows), "a long, b long").distinct()
    found = components(verify(docs, _untried(pairs, tried)).union(found))

    label = nodes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "fp1", "fp2", "n", F.coalesce("component", "rep").alias("component")
    )
    linked = profile.where("n > 0").join(label, ["fp1", "fp2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id")
    )
    return linked.union(profile.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents: that of the smallest id, a null id being the last.

    Where ids are null or repeated, rows are linked by keys of their own.
    """
    odd = docs.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1))
    if not odd.isEmpty():
        return _keep_one_row(docs, id_col, text_col)
    linked = materialize(link_documents(docs, id_col, text_col))
    first = linked.where("doc_id = component_id").select(F.col("doc_id").alias(id_col))
    return docs.join(first, id_col, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def _keep_one_row(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``keep_one`` with hashes of id, text and copy number for ids."""
    copy, key = free_names(docs.columns, "_copy", "_key")
    copies = Window.partitionBy(id_col, text_col).orderBy(F.xxhash64(*[f"`{c}`" for c in docs.columns]))
    keyed = docs.withColumn(copy, F.row_number().over(copies))
    keyed = materialize(keyed.withColumn(key, F.xxhash64(F.col(id_col).isNull(), id_col, text_col, copy)))
    linked = link_documents(keyed.select(key, text_col), key, text_col).select(F.col("doc_id").alias(key), "component_id")
    place = F.struct(F.col(id_col).isNull(), id_col, key)
    first = keyed.select(id_col, key).join(linked, key).groupBy("component_id").agg(F.min(place)[key].alias(key))
    return keyed.join(first.select(key), key, "left_semi").select(*[f"`{c}`" for c in docs.columns])
