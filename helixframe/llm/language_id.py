"""Language ID by a bidirectional gated recurrent network over bytes, in numpy.

The network reads segments of a text's bytes from both ends and labels every
position; a document's probabilities are the means of its positions'. It is
trained by backpropagation through time on a bounded, documented sample of
labelled documents (``TRAIN_DOCS`` of smallest id hash, their whole texts) and then
applied to all bytes of all texts.

Edge cases: null texts and texts without a letter are ``und`` with score 0;
null ``lang`` is not learned from, and of rows that share an id only the first by
language and text is; with nothing to learn from every document
is ``und``; rows with null ids are predicted and not learned from; repeated
rows get equal results; an empty table gives an empty result; a text of any
length is read in segments, all of them. Label, source and id are never inputs
of a prediction; further columns come through, but for those named like an
added one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._shared import fields, trim, without
from helixframe.llm._text import spread, text_slices

HIDDEN = 8
SEGMENT = 128
#: Documents that are learned from.
TRAIN_DOCS = 6000
STEPS, LANES, SPAN = 350, 320, 64
UNKNOWN = "und"


def squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place."""
    y = np.abs(x)
    y += 1
    x /= y
    return x


def _slope(s: np.ndarray) -> np.ndarray:
    y = 1 - np.abs(s)
    return y * y


class Direction:
    """One gated recurrent layer over byte rows; ``x`` holds the input part of the gates of every byte."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.x = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.u = rng.normal(0, 0.4 / hidden**0.5, (hidden, 3 * hidden)).astype(np.float32)

    def step(self, byte: np.ndarray, h: np.ndarray):
        k = self.hidden
        gate, inner = self.x[byte], h @ self.u
        zr = gate[:, : 2 * k] + inner[:, : 2 * k]
        squash(zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :k], zr[:, k:]
        new = r * inner[:, 2 * k :]
        new += gate[:, 2 * k :]
        squash(new)
        out = h - new
        out *= z
        out += new
        return out, (z, r, new, inner[:, 2 * k :])

    def back(self, byte: np.ndarray, before: list, kept: list, grads: list):
        """Gradients of (x, u) for gradients of the states at each time."""
        k = self.hidden
        du, carry = np.zeros_like(self.u), 0.0
        rows = []
        for h, (z, r, new, inner), g in zip(reversed(before), reversed(kept), reversed(grads), strict=True):
            d = g + carry
            dn = d * (1 - z) * _slope(new)
            dz = d * (h - new) * 0.5 * _slope(2 * z - 1)
            dr = dn * inner * 0.5 * _slope(2 * r - 1)
            gates = np.concatenate([dz, dr, dn * r], 1)
            du += h.T @ gates
            carry = d * z + gates @ self.u.T
            rows.append(np.concatenate([dz, dr, dn], 1))
        flat, at = np.concatenate(rows[::-1]), byte.ravel()
        dx = np.stack([np.bincount(at, flat[:, c], 256) for c in range(3 * k)], 1)
        return dx.astype(np.float32), du


class ByteTagger:
    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.labels, self.rng = labels, rng
        self.ahead, self.behind = Direction(rng, hidden), Direction(rng, hidden)
        self.out = rng.normal(0, 0.3, (2, hidden, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.u, self.behind.x, self.behind.u, self.out, self.bias]

    def loss(self, byte: np.ndarray, label: np.ndarray):
        """Mean cross entropy over all positions of byte[time, lane], and its gradients."""
        span, lanes = byte.shape
        runs = []
        for layer, order in ((self.ahead, range(span)), (self.behind, range(span - 1, -1, -1))):
            h = np.zeros((lanes, layer.hidden), np.float32)
            before, kept, after = [], [], []
            for t in order:
                before.append(h)
                h, keep = layer.step(byte[t], h)
                kept.append(keep)
                after.append(h)
            runs.append((before, kept, after))
        hf, hb = np.stack(runs[0][2]), np.stack(runs[1][2][::-1])
        logits = hf @ self.out[0] + hb @ self.out[1] + self.bias
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(2, keepdims=True)
        lane = np.arange(lanes)
        loss = -np.log(p[:, lane, label] + 1e-9).mean()
        p[:, lane, label] -= 1
        p /= span * lanes
        d_out = np.stack([np.einsum("tlh,tlc->hc", hf, p), np.einsum("tlh,tlc->hc", hb, p)])
        gf, gb = p @ self.out[0].T, p @ self.out[1].T
        fx, fu = self.ahead.back(byte, runs[0][0], runs[0][1], list(gf))
        bx, bu = self.behind.back(byte[::-1], runs[1][0], runs[1][1], list(gb[::-1]))
        return loss, [fx, fu, bx, bu, d_out, p.sum((0, 1))]

    def train(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, lanes: int = LANES, span: int = SPAN):
        """Adam on random windows of span bytes; lanes take every label in turn."""
        texts = [x + b" " * (span - len(x)) for x in texts]
        of = [np.flatnonzero(labels == k) for k in range(len(self.labels))]
        m = [np.zeros_like(p) for p in self.parameters()]
        v = [np.zeros_like(p) for p in self.parameters()]
        for step in range(1, steps + 1):
            label = ((step - 1) * lanes + np.arange(lanes)) % len(of)
            byte = np.empty((span, lanes), np.uint8)
            for i, k in enumerate(label):
                x = texts[self.rng.choice(of[k])]
                at = self.rng.integers(0, len(x) - span + 1)
                byte[:, i] = np.frombuffer(x, np.uint8, span, at)
            _, grads = self.loss(byte, label)
            rate = 0.02 * min(1.0, step / 20) * (0.05 ** (step / steps))
            for p, g, a, b in zip(self.parameters(), grads, m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        return self

    def probabilities(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean label probabilities over the positions of each text; zeros for empty texts."""
        size = np.diff(off)
        count = -(-size // SEGMENT)
        doc = np.repeat(np.arange(len(size)), count)
        part = spread(np.zeros(len(size), np.int64), count)
        share = np.maximum(count, 1)
        lo = part * size[doc] // share[doc]
        hi = (part + 1) * size[doc] // share[doc]
        length, begin = hi - lo, off[doc] + lo
        order = np.argsort(-length, kind="stable")
        length, begin = length[order], begin[order]
        total = np.zeros((len(order), len(self.labels)), np.float32)
        longest = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
        bytes_at = [data[begin[: active[t]] + t] for t in range(longest)]
        h = np.zeros((len(order), self.ahead.hidden), np.float32)
        forward = []
        for t in range(longest):
            h, _ = self.ahead.step(bytes_at[t], h[: active[t]])
            forward.append(h @ self.out[0] + self.bias)
        h = np.zeros((0, self.behind.hidden), np.float32)
        for t in range(longest - 1, -1, -1):
            if active[t] > len(h):
                h = np.concatenate([h, np.zeros((active[t] - len(h), h.shape[1]), np.float32)])
            h, _ = self.behind.step(bytes_at[t], h)
            logits = h @ self.out[1]
            logits += forward[t]
            forward[t] = None
            np.exp(logits, out=logits)
            logits /= logits.sum(1, keepdims=True)
            total[: active[t]] += logits
        out = np.zeros((len(size), len(self.labels)))
        np.add.at(out, doc[order], total)
        return out / np.maximum(size, 1)[:, None]


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """Whether a document is held out: crc32 of its id as text, by folds. Null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> ByteTagger | None:
    """A network trained on the sample; None with nothing to learn from."""
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & (F.col("text") != ""))
    ids = usable.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs).distinct()
    # At most train_docs ids: a bounded broadcast, and as many rows on the driver.
    rows = usable.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row")).select("doc_id", "row.*").collect()
    rows = sorted((r["doc_id"], r["lang"], r["text"]) for r in rows)
    if not rows:
        return None
    labels = sorted({lang for _, lang, _ in rows})
    index = {x: i for i, x in enumerate(labels)}
    return ByteTagger(labels).train([t.encode() for _, _, t in rows], np.array([index[x] for _, x, _ in rows]))


def _label(model: ByteTagger | None, data: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
    n = len(off) - 1
    if model is None:
        return [UNKNOWN] * n, np.zeros(n)
    p = model.probabilities(data, off)
    best = p.argmax(1)
    letters = _letters(data, off)
    score = np.where(letters, np.minimum(1.0, p[np.arange(n), best]), 0.0)
    return [model.labels[k] if ok else UNKNOWN for k, ok in zip(best, letters, strict=True)], score


def _predict(shared):
    def run(batches):
        for batch in batches:
            keep = batch.drop_columns(["text"])
            for lo, hi, data, off in text_slices(batch.column("text")):
                names, score = _label(shared.value, data, off)
                rows = keep.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(names, pa.string()), pa.array(score)], names=[*rows.schema.names, "lang_pred", "score"]
                )
        trim()

    return run


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _letters(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII one are decoded."""
    seen = np.concatenate([[0], np.cumsum(_LETTER[data])])
    out = seen[off[1:]] > seen[off[:-1]]
    for i in np.flatnonzero(~out & (off[1:] > off[:-1])).tolist():
        out[i] = any(c.isalpha() for c in data[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predict(docs: DataFrame, model: ByteTagger | None) -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score``, which take the place of columns so named."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = without(docs.columns, "lang_pred", "score")
    schema = [*fields(docs.schema, without(kept, "text")), "lang_pred string", "score double"]
    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(_predict(shared), ", ".join(schema))


def keep_known(docs: DataFrame, model: ByteTagger | None, least: float = 0.35) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language with a score of ``least`` or more; all without a model."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column("text")):
                names, score = _label(shared.value, data, off)
                keep = [n != UNKNOWN and s >= least for n, s in zip(names, score, strict=True)]
                yield batch.slice(lo, hi - lo).filter(pa.array(keep, pa.bool_()))
        trim()

    return docs.mapInArrow(run, docs.schema)
