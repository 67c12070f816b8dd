"""Removal of repeated 400-byte strings, by suffix arrays over shards of what may repeat.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
anywhere else in the corpus, the same text included.

1. Anchors: every string of ``LENGTH`` bytes holds the smallest hash of its
   ``GRAM``-byte grams, so two equal strings share an anchor at one place. The
   window of an anchor holds all such strings around it. Anchors are about one
   for each 170 bytes; only their hashes and those of their windows travel.
2. Windows that occur twice as a whole are repeated throughout (exact copies,
   and the inside of shared passages); they need no text. Equal windows of a text
   that overlap (of a line over and over, say) are one row, however many.
3. Windows that share an anchor and differ are brought together by anchor, one
   text for each different window, in shards of bounded size. Each shard gets a
   suffix array by induced sorting and its permuted common prefixes; a position
   with ``LENGTH`` bytes in common with a neighbour is repeated.
4. An anchor with more different windows than a shard holds is dealt to many
   shards. These then pass on a hash of each such string that they have not
   found repeated, and one of each that they have; those that meet again in
   another shard are repeated as well.

Edge cases: null and empty texts, and texts shorter than ``LENGTH``, lose
nothing; repeated rows are copies, and lose everything from ``LENGTH`` bytes
on; rows with null ids take part like others; an empty table gives an empty
result; a text of any length is a slice of its own while its anchors are taken,
and its windows go to many shards; further columns come through, but for those
named like an added one. Removed bytes may cut a character; the
kept bytes are exact, the kept text leaves out incomplete characters.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._shared import fields, free_names, likely, materialize, trim, without
from helixframe.llm._text import mix, prefix_hash, span_hash, spread, text_slices
from helixframe.llm.suffix_arrays import permuted_common_prefixes, suffix_array

LENGTH = 400
GRAM = 64
#: Strings of so many bytes are sure to share an anchor, and shared ones of ``PASSAGE`` bytes are reported.
SURE, PASSAGE = 340, 300
SHARD_BYTES = 750_000
#: Different windows of one anchor in one shard.
SHARD_WINDOWS = 1_500


def _slide(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over each run x[i : i + w], for all i with a whole run."""
    n = len(x)
    blocks = -(-n // w)
    pad = np.concatenate([x, np.full(blocks * w - n, x[-1])]).reshape(blocks, w)
    ahead = op.accumulate(pad, axis=1).ravel()
    back = op.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM, sure: int | None = None):
    """(document, position, hash, window start, window end, window hash) of each anchor of a slice of texts.

    Every string of ``sure`` bytes holds an anchor; windows hold all strings of
    ``length`` bytes around it.
    """
    sure = min(length, sure or length)
    n, w, reach = len(data), sure - gram + 1, length - gram
    none = (np.zeros(0, np.int64),) * 6
    if n < sure:
        return none
    c = prefix_hash(data)
    at = np.arange(n - gram + 1)
    size = np.diff(off)
    end = np.repeat(off[1:], size)
    g = span_hash(c, at, at + gram)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    g[at + gram > end[: len(at)]] = top
    low = _slide(g, w, np.minimum)
    low[np.arange(len(low)) + sure > end[: len(low)]] = 0
    # A gram is an anchor if some whole window has it as its minimum.
    edge = np.zeros(w - 1, np.uint64)
    high = _slide(np.concatenate([edge, low, edge]), w, np.maximum)
    pos = np.flatnonzero((g == high) & (g != top))
    doc = np.searchsorted(off, pos, side="right") - 1
    lo = np.maximum(off[doc], pos - reach)
    hi = np.minimum(off[doc + 1], pos + length)
    h = g[pos]
    wh = mix(span_hash(c, lo, hi) + (pos - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return doc, pos - off[doc], h.view(np.int64), lo - off[doc], hi - off[doc], wh.view(np.int64)


def runs(doc: np.ndarray, h: np.ndarray, begin: np.ndarray, end: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each run of equal windows of a text that overlap or touch, and by how much the run goes on after it."""
    order = np.lexsort((begin, wh, h, doc))
    doc, h, begin, end, wh = (x[order] for x in (doc, h, begin, end, wh))
    new = np.ones(len(order), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (wh[1:] != wh[:-1]) | (begin[1:] > end[:-1])
    at = np.flatnonzero(new)
    return order[at], end[np.append(at[1:], len(order)) - 1] - end[at] if len(at) else at


def _anchor_rows(length: int, gram: int, sure: int):
    def run(batches):
        for batch in batches:
            for lo, _, data, off in text_slices(batch.column("text")):
                doc, _, h, begin, end, wh = anchors(data, off, length, gram, sure)
                first, more = runs(doc, h, begin, end, wh)
                row = pa.array(lo + doc[first])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(row) for k in ("th", "tm", "rid")), *(pa.array(x[first]) for x in (h, wh, begin, end)), pa.array(more)],
                    names=["th", "tm", "rid", "h", "wh", "lo", "hi", "more"],
                )
        trim()

    return run


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as sorted maximal ones; touching intervals are one."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate(([True], lo[1:] > hi[:-1]))
    at = np.flatnonzero(new)
    return lo[at], hi[np.append(at[1:], len(lo)) - 1]


SHARD = "th long, tm int, lo long, hi long, bucket long, entries binary, cut boolean"
_ENTRY = np.dtype([("hash", "<u8"), ("th", "<i8"), ("tm", "<i4"), ("pos", "<i8"), ("open", "?")])


def _shard(length: int, passage: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["th", "tm", "lo", "hot", "win"]).to_pylist()
        rows.sort(key=lambda r: (r["th"], r["tm"], r["lo"]))
        # Windows that overlap in their text are one segment: each position occurs once.
        segments: list[list] = []
        for r in rows:
            last = segments[-1] if segments else None
            stop = r["lo"] + len(r["win"])
            if last and last[0] == (r["th"], r["tm"]) and r["lo"] <= last[2]:
                if stop > last[2]:
                    last[3].append(r["win"][last[2] - r["lo"] :])
                    last[2] = stop
            else:
                last = [(r["th"], r["tm"]), r["lo"], stop, [r["win"]], []]
                segments.append(last)
            if r["hot"]:
                last[4].append((r["lo"], stop))
        raw = [np.frombuffer(b"".join(s[3]), np.uint8) for s in segments]
        size = np.array([len(x) + 1 for x in raw])
        begin = np.cumsum(size) - size
        t = np.ones(int(size.sum()) + 1, np.int16)
        t[-1] = 0
        for at, x in zip(begin.tolist(), raw, strict=True):
            t[at : at + len(x)] = x
            t[at : at + len(x)] += 2
        sa = suffix_array(t, 258)
        common = permuted_common_prefixes(t, sa)
        after = np.empty(len(t), np.int64)
        after[sa[:-1]] = sa[1:]
        after[sa[-1]] = sa[0]
        longest = np.maximum(common, common[after])[:-1]
        room = np.repeat(begin + size - 1, size) - np.arange(len(t) - 1)
        whole = room >= length
        repeated = (longest >= length) & whole
        base = np.array([x[1] for x in segments]) - begin
        keys = np.array([x[0][0] for x in segments], np.int64), np.array([x[0][1] for x in segments], np.int32)
        out: dict[str, list] = {k: [] for k in ("th", "tm", "lo", "hi", "bucket", "cut")}
        for least, is_cut, starts in ((length, True, repeated), (passage, False, (longest >= passage) & (room >= passage))):
            start = np.flatnonzero(starts)
            seg = np.searchsorted(begin, start, side="right") - 1
            # Runs of starts within a segment become intervals of text.
            new = np.concatenate(([True], (np.diff(start) > 1) | (np.diff(seg) > 0))) if len(start) else np.zeros(0, bool)
            a = np.flatnonzero(new)
            z = np.append(a[1:], len(start)) - 1
            s = seg[a] if len(a) else a
            for k, x in (("th", keys[0][s]), ("tm", keys[1][s]), ("lo", start[a] + base[s]), ("hi", start[z] + base[s] + least), ("bucket", np.zeros(len(a), np.int64)), ("cut", np.full(len(a), is_cut))):
                out[k].append(x)
        entries: list = [None] * sum(map(len, out["th"]))
        hot = np.zeros(len(t) - 1, bool)
        for k, x in enumerate(segments):
            for i, j in x[4]:
                hot[begin[k] + i - x[1] : begin[k] + j - x[1]] = True
        at = np.flatnonzero(hot & whole)
        if len(at):
            from helixframe.llm.suffix_arrays import _prefix

            c = _prefix(t)
            h = span_hash(c, at, at + length)
            seg = np.searchsorted(begin, at, side="right") - 1
            e = np.zeros(len(at), _ENTRY)
            e["hash"], e["th"], e["tm"], e["pos"], e["open"] = h, keys[0][seg], keys[1][seg], at + base[seg], ~repeated[at]
            done = e[~e["open"]]
            done = done[np.unique(done["hash"], return_index=True)[1]]
            e = np.concatenate([e[e["open"]], done])
            bucket = (mix(e["hash"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
            entries += [e[p].tobytes() for p in parts]
            none = np.zeros(len(parts), np.int64)
            for k in ("th", "tm", "lo", "hi"):
                out[k].append(none)
            out["bucket"].append(np.array([bucket[p[0]] for p in parts]))
            out["cut"].append(np.ones(len(parts), bool))
        kinds = {"tm": pa.int32(), "cut": pa.bool_()}
        found = pa.table({k: pa.array(np.concatenate(v), kinds.get(k, pa.int64())) for k, v in out.items()} | {"entries": pa.array(entries, pa.binary())})
        trim()
        return found

    return run


def _meet(length: int):
    """Strings of very frequent anchors that meet again in another shard."""

    def run(table: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(x, _ENTRY) for x in table.column("entries").to_pylist()])
        e = e[np.lexsort((e["pos"], e["tm"], e["th"], e["hash"]))]
        same = np.concatenate(([False], (e["hash"][1:] == e["hash"][:-1]) & (e["th"][1:] == e["th"][:-1]) & (e["tm"][1:] == e["tm"][:-1]) & (e["pos"][1:] == e["pos"][:-1])))
        e = e[~same]
        at = np.flatnonzero(np.concatenate(([True], e["hash"][1:] != e["hash"][:-1])))
        size = np.diff(np.append(at, len(e)))
        e = e[(np.repeat(size, size) > 1) & e["open"]]
        return pa.table({"th": e["th"], "tm": e["tm"], "lo": e["pos"], "hi": e["pos"] + length, "cut": np.ones(len(e), bool)})

    return run


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_windows: int = SHARD_WINDOWS, shard_bytes: int = SHARD_BYTES,
    sure: int = SURE, passage: int = PASSAGE,
) -> DataFrame:
    """(th, tm, lo, hi, cut): byte intervals covered by repeated strings, by text hash; intervals may overlap.

    Those of ``length`` bytes are to be cut; those of ``passage`` bytes are as
    the shards show them: all from ``sure`` bytes on, most of the shorter ones.
    """
    sure, passage = min(sure, length), min(passage, length)
    rows = docs.where("text is not null").select(*text_key(), F.coalesce("doc_id", F.lit(-(1 << 62))).alias("rid"), "text")
    found = rows.mapInArrow(_anchor_rows(length, gram, sure), "th long, tm int, rid long, h long, wh long, lo long, hi long, more long")
    # Copies of a text are counted before they travel on; a run of equal windows counts as two.
    found = materialize(
        found.groupBy("h", "wh", "th", "tm", "lo", "hi", "more")
        .agg(F.sum(F.when(F.col("more") > 0, 2).otherwise(1)).alias("c"), F.min("rid").alias("rid"))
    )
    windows = found.groupBy("h", "wh").agg(
        F.sum("c").alias("n"), F.min(F.struct("th", "tm", "lo", "hi", "rid")).alias("one")
    )
    kinds = windows.groupBy("h").agg(F.count("*").alias("kinds"), F.max("n").alias("most"))
    windows = materialize(windows.join(kinds.where("kinds > 1 or most > 1"), "h"))
    size = F.col("hi") - F.col("lo")
    marks = found.join(windows.where("n > 1").select("h", "wh"), ["h", "wh"]).where(size >= passage).select("th", "tm", "lo", (F.col("hi") + F.col("more")).alias("hi"), (size >= length).alias("cut"))

    differ = windows.where("kinds > 1").select("h", "wh", "kinds", "one.*")
    total = differ.agg(F.sum(F.col("hi") - F.col("lo"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    chunk = F.pmod("wh", F.ceil(F.col("kinds") / shard_windows))
    differ = differ.select(
        "th", "tm", "rid", "lo", "hi", (F.col("kinds") > shard_windows).alias("hot"),
        F.pmod(F.xxhash64("h", chunk), F.lit(shards)).alias("shard"),
    )
    texts = likely(rows, "th", differ.select("th"))
    win = F.expr("substring(cast(text as binary), cast(lo + 1 as int), cast(hi - lo as int))").alias("win")
    differ = differ.join(texts, ["th", "tm", "rid"]).select("shard", "th", "tm", "lo", "hot", win)
    sorted_shards = materialize(differ.groupBy("shard").applyInArrow(_shard(length, passage, shards), SHARD))
    again = (
        sorted_shards.where("entries is not null").select("bucket", "entries").groupBy("bucket")
        .applyInArrow(_meet(length), "th long, tm int, lo long, hi long, cut boolean")
    )
    return marks.union(sorted_shards.where("entries is null").select("th", "tm", "lo", "hi", "cut")).union(again)


def text_key():
    """A text's key: two hashes, 96 bits."""
    return F.xxhash64("text").alias("th"), F.hash("text").alias("tm")


def _cut(found: str):
    def run(batches):
        for batch in batches:
            out = []
            spans = batch.column(found)
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            for i in range(batch.num_rows):
                raw = texts[i].as_py()
                shared = 0
                if spans[i].is_valid:
                    pairs = spans[i].values
                    lo, hi, cut = (pairs.field(k).to_numpy(zero_copy_only=False) for k in ("lo", "hi", "cut"))
                    begin, end = merged(lo, hi)
                    shared = int((end - begin).sum())
                    lo, hi = merged(lo[cut], hi[cut])
                    stops = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(raw)]
                    kept = b"".join(raw[stops[k] : stops[k + 1]] for k in range(0, len(stops), 2))
                    pairs = [{"lo": a, "hi": b} for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                else:
                    kept, pairs = raw, []
                out.append((len(raw), len(raw) - len(kept), len(pairs), shared, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"), pairs))
            cols = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))]
            keep = batch.drop_columns(["text", found])
            yield pa.RecordBatch.from_arrays(
                [*keep.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=[*keep.schema.names, "n_bytes", "n_removed", "n_spans", "n_shared", "kept_sha256", "kept_text", "removed"],
            )
        trim()

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """``docs`` with ``text`` replaced by what is removed and what stays of it.

    ``docs`` has ``doc_id`` and ``text``; its other columns come through, but for
    those named like an added one. Adds ``n_bytes``, ``n_removed``, ``n_spans``,
    ``n_shared`` (bytes of passages that repeat, whether cut or too short for
    that), ``kept_sha256``, ``kept_text`` and ``removed``, the byte intervals.
    """
    spans = repeated_spans(docs, length, **limits)
    added = ("n_bytes", "n_removed", "n_spans", "n_shared", "kept_sha256", "kept_text", "removed")
    others = without(docs.columns, "text", *added)
    th, tm, found = free_names([*others, "text"], "th", "tm", "spans")
    spans = spans.groupBy(F.col("th").alias(th), F.col("tm").alias(tm)).agg(F.collect_set(F.struct("lo", "hi", "cut")).alias(found))
    keyed = docs.select(*[f"`{c}`" for c in others], "text", *[k.alias(n) for k, n in zip(text_key(), (th, tm), strict=True)])
    joined = keyed.join(spans, [th, tm], "left").drop(th, tm)
    schema = [*fields(docs.schema, others), "n_bytes long", "n_removed long", "n_spans long", "n_shared long", "kept_sha256 string", "kept_text string"]
    return joined.mapInArrow(_cut(found), ", ".join([*schema, "removed array<struct<lo: long, hi: long>>"]))
