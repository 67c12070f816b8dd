"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its UTF-8 bytes and an end symbol. Each bit of a byte is predicted
from counts of that bit after the same 1, 2, 3 or 5 bytes, or after the same
word so far (and the bits before it in its byte). A mixer whose
weights are gated by the bit's place and by how much the longer contexts have
seen combines the predictors' logits; an adaptive probability map refines the
result. Logarithms of the bits' probabilities add up to the text's.

The counts are of all training texts and exact, however many contexts there
are: batches of documents deal their distinct contexts with the bytes after
them to buckets by a hash of the context, each bucket sums whole keys and sends
every batch the bytes and counts after the contexts it asked for, so that no
table grows on the driver or is shipped whole. Byte contexts are their own keys;
words so far are 40 bits of hash, apart in each bucket.

Mixer and map learn from all whole training texts: every batch of documents
makes an online pass over its texts in reading order (in lanes side by side), by the
counts of its own training texts without the occurrence that is learned from; a
context that occurs more than once counts as often where it comes first. Weights and map are
averaged by how often each was used, in a fixed order, and reach the batches
with the counts. Every text is scored from that mean and the counts of all
training texts, so that scores do not depend on order. As a byte's
probability depends on the bytes and the word up to it, each slice of texts
evaluates each of its distinct contexts once.

The word-level baseline needs each word's count over all training texts, which
go the same way.

Edge cases: null texts are empty (one end symbol, one end token); rows with
null ids are held out; repeated rows are scored and learned from once each; with
no training rows all counts are zero; an empty table gives an empty result; a
text of any length is a slice of its own, whose arrays are about 100 bytes a
byte of it; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._shared import materialize, trim
from helixframe.llm._text import (
    LOWER,
    NOT_SPACE,
    distinct_counts,
    distinct_sorted,
    merge_counts,
    mix,
    powers,
    prefix_hash,
    spread,
    text_slices,
    word_bounds,
    word_hashes,
)

#: Bytes of the contexts before a byte.
LENGTHS = (1, 2, 3, 5)
ORDERS, LEAD = len(LENGTHS), max(LENGTHS)
#: Predictors: the orders of bytes, and the word so far.
INPUTS = ORDERS + 1
#: Slots of each order, and of the words, in a hashed table given to a model.
TABLE_BITS, WORD_BITS = 20, 22
END = 0xFF
SLICE = 1 << 18
#: Slots of a batch's table of contexts met so far.
SLOT_BITS = 22
#: Contexts of training texts that are counted at once.
COUNTED = 1 << 21
#: Bytes whose words are hashed at once.
BLOCK = 1 << 14
#: Buckets that add up what batches learned.
LOTS = 8
#: Lanes in which a batch's contexts are read while a mixer learns.
LANES = 1024
BATCH_DOCS = 2500
FOLDS, FOLD = 7, 2


def held_out():
    """Whether a document is held out: crc32 of its id as text modulo FOLDS is FOLD."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == FOLD, F.lit(True))


# Contexts of bytes and their bits

#: Bytes that no word holds.
_OUTSIDE = (~NOT_SPACE).astype(np.int64)
_OUTSIDE[END] = 1


def grams(data: np.ndarray, off: np.ndarray):
    """For each byte and end symbol: the 48-bit key of it and the five bytes before, and the key of it and
    the word so far (40 bits of its hash); and how many of them each document has."""
    lead, size = LEAD, np.diff(off) + 1
    if not len(size):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Each document's bytes and end symbol after ``lead`` end symbols; two more bytes before all, as keys are read from eight.
    end = np.cumsum(size + lead)
    raw = np.full(int(end[-1]) + 2, END, np.uint8)
    text = raw[2:]
    spans = [(z - n, z - 1, a) for z, n, a in zip(end.tolist(), size.tolist(), off.tolist(), strict=False)]
    for a, z, at in spans:
        text[a:z] = data[at : at + z - a]
    n = len(text) - lead
    key = np.ndarray((n,), ">u8", raw, strides=(1,)).astype(np.uint64)
    key &= np.uint64((1 << 8 * (lead + 1)) - 1)
    # Where the word so far begins: after the last byte of none.
    place = np.arange(len(text) + 1)
    begin = place[1:] * _OUTSIDE.take(text)
    begin = np.maximum.accumulate(begin, out=begin)[lead - 1 : -1]
    c, word = prefix_hash(LOWER.take(text)), np.empty(n, np.uint64)
    back = powers(len(c))[1]
    for lo in range(0, n, BLOCK):
        # The hashes of spans that end at one place after the other.
        start, ends = begin[lo : lo + BLOCK], slice(lead + lo, lead + min(n, lo + BLOCK))
        part = c[ends] - c.take(start)
        part *= back.take(start)
        long = (place[ends] - start).view(np.uint64)
        long *= np.uint64(0xD6E8FEB86659FD93)
        part += long
        part = mix(part)
        part >>= np.uint64(24)
        part <<= np.uint64(8)
        np.bitwise_or(part, text[lead + lo : lead + lo + BLOCK], out=word[lo : lo + BLOCK])
    key, word = (np.concatenate([x[a - lead : z + 1 - lead] for a, z, _ in spans]) for x in (key, word))
    return key, word, size


#: First slot of each order's table, the last one that of the words.
BASE = np.append(np.arange(ORDERS + 1) << TABLE_BITS, (ORDERS << TABLE_BITS) + (1 << WORD_BITS))


def _nodes(key: np.ndarray) -> np.ndarray:
    """The bits of the byte before each of its bits, after a leading one: shape (8, keys)."""
    byte = (key & np.uint64(255)).astype(np.int64)
    return byte >> np.arange(8, 0, -1)[:, None] | 1 << np.arange(8)[:, None]


def _bits(key: np.ndarray) -> np.ndarray:
    """The bits of the byte: shape (8, keys)."""
    return (key & np.uint64(255)).astype(np.int64) >> np.arange(7, -1, -1)[:, None] & 1


#: Nodes and bits of each byte.
NODES, BITS = _nodes(np.arange(256, dtype=np.uint64)), _bits(np.arange(256, dtype=np.uint64))


def _cells(context: np.ndarray, key: np.ndarray, order: int) -> np.ndarray:
    """Table cells (2 * slot + bit) of an order's contexts: shape (8, keys)."""
    bits = TABLE_BITS if order < ORDERS else WORD_BITS
    base = mix(context * np.uint64(ORDERS + 1) + np.uint64(order + 1))
    byte = (key & np.uint64(255)).astype(np.int64)
    out = np.empty((8, len(key)), np.int64)
    for k, node in enumerate(_nodes(key)):
        h = (base + node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        out[k] = (BASE[order] + (h >> np.uint64(64 - bits)).astype(np.int64)) * 2 + ((byte >> 7 - k) & 1)
    return out


def gram_cells(key: np.ndarray) -> np.ndarray:
    """Cells of byte contexts: shape (orders, 8, keys)."""
    return np.stack([_cells((key >> np.uint64(8)) & np.uint64((1 << 8 * size) - 1), key, k) for k, size in enumerate(LENGTHS)])


def word_cells(word: np.ndarray) -> np.ndarray:
    """Cells of word contexts: shape (1, 8, keys)."""
    return _cells(word >> np.uint64(8), word, ORDERS)[None]


def cells(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return np.concatenate([gram_cells(key), word_cells(word)])


#: Counts as one byte: up to 32 as they are, then in steps of an eighth of an octave.
_LEVELS = np.concatenate([np.arange(33), 32 * 2 ** (np.arange(1, 224) / 8)])


def _to_level(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.searchsorted(_LEVELS, count, side="right") - 1, 255).astype(np.uint8)


_LOW = _to_level(np.arange(4096))


def to_level(count: np.ndarray) -> np.ndarray:
    low = _LOW.take(count, mode="clip")
    if len(count) and count.max() > 4095:
        high = np.flatnonzero(count > 4095)
        low[high] = _to_level(count[high])
    return low


#: What a level is multiplied by to stand, against none, at each bit of a byte: shape (256, 8).
ALONE = np.uint16(1) << (np.uint16(8) * (1 - BITS.T).astype(np.uint16))

_PAIRS = np.arange(65536)
_N0, _N1 = _LEVELS[_PAIRS >> 8], _LEVELS[_PAIRS & 255]
#: Logit and amount seen of a pair of levels.
LOGIT = np.log((_N1 + 0.3) / (_N0 + 0.3)).astype(np.float32)
SEEN = np.digitize(_N0 + _N1, [1, 3, 16]).astype(np.int16)


def _less_one(pair: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Levels with one occurrence of the bit taken out, where single ones count."""
    set_ = bit == 1
    low = np.where(set_, pair & 255, pair >> 8)
    return pair - ((low > 0) & (low <= 32)) * np.where(set_, np.uint16(1), np.uint16(256))


#: A pair of levels less one occurrence of the bit: by 65536 * bit + pair.
LESS = np.concatenate([_less_one(_PAIRS.astype(np.uint16), np.int64(bit)) for bit in (0, 1)])

#: First weight set of each bit.
_SETS = np.arange(0, 512, 64)[:, None]
#: One for each clear bit of a byte.
_CLEAR = 1.0 - BITS
#: Keys whose levels are looked up at once, a multiple of a learning step's.
FOUND = 1 << 14
#: Answered keys whose levels are made at once.
ASKED = 1 << 15
#: Keys that are scored at once.
STEP = 1 << 11


def _gate(seen: np.ndarray, order: int) -> np.ndarray:
    """An order's part in the gate: the amounts seen of the longest contexts, two bits each."""
    return (seen << 2 * (order - ORDERS + 2) if order >= ORDERS - 2 else 0 * seen).astype(np.uint8)


class Mixer:
    """Gated weights over the orders' logits, and the adaptive map after them."""

    BINS = 24

    def __init__(self):
        self.weights = np.full((8 * 64, INPUTS + 1), 0.3, np.float32)
        self.weights[:, INPUTS] = 0
        self.map = np.tile(1 / (1 + np.exp(-np.linspace(-8, 8, self.BINS))), (256, 1))
        self.visits, self.hits = np.zeros(len(self.weights)), np.zeros(self.map.size)
        self.used, self.mapped = np.zeros(self.weights.shape), np.zeros(self.map.size)

    def copy(self) -> "Mixer":
        """The same weights and map, with nothing visited."""
        out = Mixer()
        out.weights, out.map = self.weights.copy(), self.map.copy()
        return out

    def mixed(self, weights: np.ndarray, logit: np.ndarray, gate: np.ndarray):
        """Weight set, mixed probability and place on the map's axis, of logits (inputs, 8, ...) and gates; ``weights``
        by input."""
        at = gate + _SETS
        dot = weights[INPUTS].take(at)
        for k in range(INPUTS):
            part = weights[k].take(at)
            part *= logit[k]
            dot += part
        np.clip(dot, -12, 12, out=dot)
        p = np.exp(-dot)
        p += 1
        np.reciprocal(p, out=p)
        dot += 8
        dot *= (self.BINS - 1) / 16
        return at, p, np.clip(dot, 0, self.BINS - 1, out=dot)

    def predict(self, logit: np.ndarray, gate: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Probabilities of set bits."""
        _, p, at = self.mixed(np.ascontiguousarray(self.weights.T), logit, gate)
        cell = np.minimum(at.astype(np.intp), self.BINS - 2)
        part, flat = at - cell, self.map.ravel()
        cell += (NODES * self.BINS).take(byte, axis=1)
        low = flat.take(cell)
        cell += 1
        refined = flat.take(cell)
        refined -= low
        refined *= part
        refined += low
        refined += p
        refined /= 2
        return np.clip(refined, 1e-5, 1 - 1e-5, out=refined)

    def learn(self, inputs, byte: np.ndarray, times: np.ndarray, done: float = 0, share: float = 1, batch: int = 1024) -> None:
        """Online over contexts in order: predict a batch, then move weights and map by its errors.

        Contexts count as often as they occur; ``inputs`` gives logits and gates of those from one place to another,
        ``byte`` the byte that each ends with. The pass is the given share of all
        learning, after the part that is done.
        """
        weights, used, sets = np.ascontiguousarray(self.weights.T), np.zeros(self.weights.T.shape), len(self.weights)
        flat = self.map.reshape(-1)
        # A cell of the map for each bit after its node.
        spots, bits = 2 * self.BINS * NODES + BITS, BITS.astype(float)
        for lo in range(0, len(byte), batch):
            if lo % FOUND == 0:
                logits, gates = inputs(lo, lo + FOUND)
            here, part = slice(lo % FOUND, lo % FOUND + batch), byte[lo : lo + batch]
            n = times[lo : lo + batch].astype(float)
            logit = logits[:, :, here]
            at, p, spot = self.mixed(weights, logit, gates[:, here])
            error = bits.take(part, axis=1)
            error -= p
            error *= n
            n, at, error = np.tile(n, 8), at.ravel(), error.ravel()
            count = np.bincount(at, n, sets)
            self.visits += count
            # A step is bounded, however often a key occurs.
            rate = 0.3 / (1 + 4 * (done + share * lo / len(byte))) * np.sqrt(np.minimum(count, batch)) / np.maximum(count, 1)
            logit = np.clip(logit, -6, 6).reshape(INPUTS, -1)
            for k in range(INPUTS):
                weights[k] += rate * np.bincount(at, error * logit[k], sets) / 8
            weights[INPUTS] += rate * np.bincount(at, error, sets) / 8
            spot += 0.5
            spot = spot.astype(np.intp)
            spot *= 2
            spot += spots.take(part, axis=1)
            clear, ones = np.bincount(spot.ravel(), n, 2 * flat.size).reshape(-1, 2).T
            hits = clear + ones
            self.hits += hits
            cell = np.flatnonzero(hits)
            hits, now = hits.take(cell), flat.take(cell)
            now += np.minimum(0.5, 0.02 * hits) * (ones.take(cell) / hits - now)
            flat[cell] = now
            used += weights * count
            self.mapped[cell] += now * hits
        self.weights[:] = weights.T
        self.used += used.T

    def parts(self) -> np.ndarray:
        """What this mixer learned, to be added to others': weights and map summed over their visits, and visits."""
        own = self.used, self.visits, self.mapped, self.hits
        return np.concatenate([x.ravel() for x in own]).astype(np.float64)

    def averaged(self, parts: np.ndarray) -> "Mixer":
        """The mean of the mixers whose parts were added up, by visits; what none visited stays as it is here."""
        out = Mixer()
        w, v, m, h = np.split(parts, np.cumsum([self.weights.size, len(self.visits), self.map.size]))
        w, m = w.reshape(self.weights.shape), m.reshape(self.map.shape)
        h = h.reshape(self.map.shape)
        out.weights = np.where(v[:, None] > 0, w / np.maximum(v, 1)[:, None], self.weights).astype(np.float32)
        out.map = np.where(h > 0, m / np.maximum(h, 1), self.map)
        return out


class Model:
    """Levels, mixer and map; log10 probabilities of keys.

    ``find`` gives the logits and gates of keys; without one they come from a hashed table.
    """

    def __init__(self, table: np.ndarray | None, mixer: Mixer, find=None):
        self.table, self.mixer = table, mixer
        self.find = find or self._hashed

    def _hashed(self, key: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = self.table[cells(key, word) >> 1]
        return LOGIT.take(pair), sum(_gate(SEEN.take(x), k) for k, x in enumerate(pair))

    def log10(self, key: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.empty(len(key))
        for lo in range(0, len(key), STEP):
            if lo % FOUND == 0:
                logits, gates = self.find(key[lo : lo + FOUND], word[lo : lo + FOUND])
            here, byte = slice(lo % FOUND, lo % FOUND + STEP), (key[lo : lo + STEP] & np.uint64(255)).view(np.int64)
            p = self.mixer.predict(logits[:, :, here], gates[:, here], byte)
            # The probability of a clear bit is what is left.
            p -= _CLEAR.take(byte, axis=1)
            out[lo : lo + STEP] = np.log10(np.abs(p.prod(0)))
        return out


# Counts of all training texts


def _kept(key: np.ndarray, order: int) -> np.ndarray:
    """Keys of an order: its context and the byte; the words' are whole."""
    return key & np.uint64((1 << 8 * (LENGTHS[order] + 1)) - 1) if order < ORDERS else key


class Batch:
    """Distinct keys and words of a column of texts, in reading order of their first places: ``key``, ``word``, and
    ``times``, how often each is in training texts."""

    def __init__(self, column, train: np.ndarray, sums: bool = True):
        """``sums``: whether values are to be summed over texts, for which each byte's context is kept."""
        self.rows, self.slices, self.learns = len(column), [], bool(train.any())
        held: list[list[np.ndarray]] = [[], [], []]
        # Hashes met so far, each in its slot, with its number in place of the bits that tell the slot. A hash whose slot
        # another one took, or that came after as many as slots, is numbered again when it comes back.
        bits, none = np.uint64(SLOT_BITS), np.uint64((1 << SLOT_BITS) - 1)
        table, met = np.full(1 << SLOT_BITS, 0xFFFFFFFFFFFFFFFF, np.uint64), 0
        times, counted = np.zeros(0, np.int64), []
        for lo, hi, data, off in text_slices(column, SLICE):
            key, word, size = grams(data, off)
            both = key * np.uint64(0xD6E8FEB86659FD93)
            word_part = word * np.uint64(0x9E3779B97F4A7C15)
            both += word_part
            slot = (both >> (np.uint64(64) - bits)).view(np.int64)
            found = table.take(slot)
            found ^= np.left_shift(both, bits, out=word_part)
            # What stays is the number, if the rest of the hash is equal.
            new, inverse = np.flatnonzero(found >= none), found.astype(np.int32)
            first, own = _numbered(both.take(new))
            own += np.int32(met)
            inverse[new] = own
            first = new.take(first)
            for kept, x in zip(held, (both, key, word), strict=True):
                kept.append(x.take(first))
            put = first[: max(0, int(none) - met)]
            table[slot.take(put)] = word_part.take(put) | np.arange(met, met + len(put), dtype=np.uint64)
            met += len(first)
            if self.learns:
                counted.append(inverse[np.repeat(train[lo:hi], size)])
                if sum(map(len, counted)) > COUNTED:
                    times, counted = _grown(times, counted, met), []
            if sums:
                self.slices.append((lo, hi, inverse, off[:-1] + np.arange(hi - lo)))
        del table
        both, key, word = (np.concatenate([*x, np.zeros(0, np.uint64)]) for x in held)
        held.clear()
        lead, self.own = _numbered(both)
        self.key, self.word = key.take(lead), word.take(lead)
        if self.learns:
            self.times = np.bincount(self.own, _grown(times, counted, met), len(lead)).astype(np.int64)
        else:
            self.times = np.zeros(len(lead), np.int64)

    def kinds(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each order, and the words: sorted distinct keys, and how often they are in training texts; ``at`` has
        each context's place among them."""
        out, key, times, at = [], self.key, self.times if self.learns else None, None
        word, word_times, own = _distinct(self.word, times)
        self.at = [own]
        for k in range(ORDERS - 1, -1, -1):
            # Shorter contexts are those of longer ones, cut.
            key, times, own = _distinct(_kept(key, k), times)
            at = own if at is None else own[at]
            self.at.insert(0, at)
            out.append((key, times))
        return [(x, np.zeros(len(x), np.int64) if n is None else n) for x, n in [*out[::-1], (word, word_times)]]

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Of a value for each distinct context, the sum over each text."""
        out, value = np.zeros(self.rows), value.take(self.own)
        for lo, hi, inverse, starts in self.slices:
            out[lo:hi] = np.add.reduceat(value.take(inverse), starts)
        return out


def _order(x: np.ndarray) -> np.ndarray:
    """Stable order of numbers of up to 48 bits: numbers and places sorted as one, by halves where they do not fit."""
    n = np.arange(len(x), dtype=np.uint64)
    bits = np.uint64(max(1, len(x).bit_length()))
    place = (np.uint64(1) << bits) - np.uint64(1)
    if int(x.max(initial=0)).bit_length() + int(bits) <= 64:
        return (np.sort(x << bits | n) & place).view(np.int64)
    low = (np.sort((x & np.uint64((1 << 24) - 1)) << bits | n) & place).view(np.int64)
    return low.take((np.sort(x.take(low) >> np.uint64(24) << bits | n) & place).view(np.int64))


def _grown(times: np.ndarray, more: list[np.ndarray], n: int) -> np.ndarray:
    """How often each of n numbers came: as often as before, and among the numbers since."""
    out = np.bincount(np.concatenate([*more, np.zeros(0, np.int32)]), minlength=n)
    out[: len(times)] += times
    return out


def _distinct(x: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Sorted distinct values, their sums of weights if there are any, and the place of each value among them."""
    if not len(x):
        return x, weights, np.zeros(0, np.int32)
    order = _order(x)
    x = x.take(order)
    new = np.concatenate(([True], x[1:] != x[:-1]))
    at, own = np.flatnonzero(new), np.empty(len(x), np.int32)
    own[order] = np.cumsum(new, dtype=np.int32) - 1
    return x.take(at), None if weights is None else np.add.reduceat(weights.take(order), at), own


def _groups(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of hashes, and which of them lead a group of equal hashes: its first place."""
    bits = np.uint64(max(1, len(both).bit_length()))
    # Hashes and places in one number: sorted, a hash's first place leads it.
    packed = both >> bits
    packed <<= bits
    packed |= np.arange(len(both), dtype=np.uint64)
    packed.sort()
    place = (packed & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    seen = both.take(place)
    new = np.ones(len(both), bool)
    np.not_equal(seen[1:], seen[:-1], out=new[1:])
    packed >>= bits
    if np.count_nonzero(new[1:]) != np.count_nonzero(packed[1:] != packed[:-1]):  # hashes that only differ in the bits of places
        place = np.argsort(both, kind="stable")
        seen = both.take(place)
        np.not_equal(seen[1:], seen[:-1], out=new[1:])
    return place, new


def _numbered(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes by first place: these places, and each hash's number among them."""
    place, new = _groups(both)
    at = np.flatnonzero(new)
    first = place.take(at)
    leads = np.zeros(len(both), bool)
    leads[first] = True
    number = np.cumsum(leads, dtype=np.int32).take(first)
    number -= 1
    own = np.empty(len(both), np.int32)
    own[place] = np.repeat(number, np.diff(at, append=len(both)))
    return np.flatnonzero(leads), own


def contexts(column, train: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, and the words: distinct keys of a column of texts, and how often they are in training texts."""
    return Batch(column, train).kinds()


def _buckets(key: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """All bytes after one context meet in one bucket."""
    return (mix((key >> np.uint64(8)) * np.uint64(ORDERS + 1) + np.uint64(order + 1)) % np.uint64(buckets)).astype(np.int64)


def _split(bucket: np.ndarray, buckets: int):
    """Rows by bucket in their order, and each bucket's end among them."""
    return np.argsort(bucket.astype(np.uint16) if buckets <= 65536 else bucket, kind="stable"), np.cumsum(np.bincount(bucket, minlength=buckets))


def _pressed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True) if raw else b""


def _unpressed(raw: bytes) -> bytes:
    return _ZSTD.decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True) if raw else b""


_ZSTD = pa.Codec("zstd", compression_level=1)


def _planes(x: np.ndarray) -> bytes:
    """Numbers by byte planes, as many as the largest has, compressed."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return bytes([width]) + _pressed(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def _numbers(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpressed(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<u8").ravel()


def _joined(parts: list[bytes]) -> bytes:
    return np.array([len(x) for x in parts], "<i8").tobytes() + b"".join(parts)


def _parted(raw: bytes, n: int) -> list[bytes]:
    size = np.frombuffer(raw, "<i8", n)
    ends = 8 * n + np.cumsum(size)
    return [raw[e - k : e] for e, k in zip(ends.tolist(), size.tolist(), strict=True)]


def pack_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Keys (sorted, as differences) and counts of each order."""
    return _joined([x for key, count in parts for x in (_planes(np.diff(key, prepend=np.uint64(0))), _planes(count.astype(np.uint64)))])


def levels(key: np.ndarray, count: np.ndarray, asked: np.ndarray | None = None) -> np.ndarray:
    """Pairs of levels at each bit of sorted distinct keys that hold all bytes of their contexts, or of the places
    asked for: shape (keys, 8)."""
    asked = np.arange(len(key)) if asked is None else asked
    context = key >> np.uint64(8)
    same = np.zeros(len(key) + 1, bool)
    np.equal(context[1:], context[:-1], out=same[1:-1])
    several = same[1:] | same[:-1]
    out = np.empty((len(asked), 8), np.uint16)
    # A byte that is alone after its context is seen against none.
    more = several.take(asked)
    one, more = np.flatnonzero(~more), np.flatnonzero(more)
    at = asked.take(one)
    out[one] = ALONE.take(key.take(at).astype(np.uint8), axis=0) * to_level(count.take(at)).astype(np.uint16)[:, None]
    # The others from the last bit to the first: bytes that agree before a bit meet in one node, whose two sides
    # count against each other.
    node, at, count = key[several], (np.cumsum(several) - 1).take(asked.take(more)), count[several]
    found = np.empty((len(more), 8), np.uint16)
    for k in range(7, -1, -1):
        up = (node.astype(np.uint16) & np.uint16(1)) << np.uint16(3)
        node = node >> np.uint64(1)
        left = np.flatnonzero(node[1:] == node[:-1])
        right, other = left + 1, np.zeros(len(node), count.dtype)
        other[left], other[right] = count.take(right), count.take(left)
        # The set bit's level goes last.
        pair = to_level(count).astype(np.uint16) << (np.uint16(8) - up)
        pair |= to_level(other).astype(np.uint16) << up
        found[:, k] = pair.take(at)
        kept = np.ones(len(node), bool)
        kept[right] = False
        at = (np.cumsum(kept) - 1).take(at)
        count += other
        node, count = node[kept], count[kept]
    out[more] = found
    return out


def _answers(requests: list[bytes]) -> list[bytes]:
    """For each request of a bucket, the bytes after each of its contexts with the bucket's summed counts."""
    requests = [_parted(x, 2 * (ORDERS + 1)) for x in requests]
    answers: list[list[bytes]] = [[] for _ in requests]
    for k in range(ORDERS + 1):
        keys = [np.cumsum(_numbers(r[2 * k])) for r in requests]
        key, count = merge_counts([(x, _numbers(r[2 * k + 1]).astype(np.int64)) for x, r in zip(keys, requests, strict=True)])
        key, count = key[count > 0], count[count > 0]
        at = np.flatnonzero(np.concatenate(([True], np.diff(key >> np.uint64(8)) > 0))) if len(key) else np.zeros(0, np.int64)
        known, size, after = key[at] >> np.uint64(8), np.diff(np.append(at, len(key))), (key & np.uint64(255)).astype(np.uint8)
        for x, out in zip(keys, answers, strict=True):
            asked = distinct_sorted(x >> np.uint64(8))
            slot = np.minimum(np.searchsorted(known, asked), max(0, len(known) - 1))
            hit = known[slot] == asked if len(known) else np.zeros(len(asked), bool)
            n = np.zeros(len(asked), np.int64)
            n[hit] = size[slot[hit]]
            rows = spread(at[slot[hit]], n[hit])
            out += [_planes(n), _pressed(after[rows].tobytes()), _planes(count[rows])]
    return [_joined(x) for x in answers]


def answered(own: np.ndarray, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and counts that a bucket answered to its sorted keys, with those that have no count, and the places of its own."""
    context = own >> np.uint64(8)
    context = context[np.concatenate(([True], context[1:] != context[:-1]))] if len(own) else context
    known = np.repeat(context, _numbers(parts[0]).astype(np.int64)) << np.uint64(8) | np.frombuffer(_unpressed(parts[1]), np.uint8)
    count = _numbers(parts[2]).astype(np.int64)
    # Keys without a count are among their contexts' with none.
    at = np.searchsorted(known, own)
    new = known.take(at, mode="clip") != own if len(known) else np.ones(len(own), bool)
    # Each one moves by those that came before it.
    at += np.cumsum(new) - new
    put, old = at[new], np.ones(len(known) + np.count_nonzero(new), bool)
    old[put] = False
    keys, counts = np.empty(len(old), np.uint64), np.zeros(len(old), np.int64)
    keys[old], keys[put], counts[old] = known, own[new], count
    return keys, counts, at


class Levels:
    """The levels of sorted keys of each kind: arrays of shape (keys, 8)."""

    def __init__(self, keys: list[np.ndarray], level: list[np.ndarray]):
        self.keys, self.level = keys, level

    def find(self, key: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.empty((INPUTS, 8, len(key)), np.uint16)
        for k, (known, level) in enumerate(zip(self.keys, self.level, strict=True)):
            asked = _kept(key, k) if k < ORDERS else word
            # In order, neighbours are found near each other.
            order = np.argsort(asked)
            at = np.empty(len(key), np.int64)
            at[order] = np.searchsorted(known, asked[order])
            out[k] = level[at].T
        return out


class Inputs:
    """A mixer's inputs by a batch's contexts, from each kind's levels, which are changed in place; gates are made once
    for each key.

    ``less``: without one occurrence of each key.
    """

    def __init__(self, levels: Levels, at: list[np.ndarray], less: bool):
        self.at, self.level, self.gate = at, levels.level, []
        bits = (BITS.T << 16).astype(np.int32)
        for k, (key, level) in enumerate(zip(levels.keys, levels.level, strict=True)):
            gate = np.empty((len(key), 8), np.uint8)
            for lo in range(0, len(key), FOUND):
                pair = level[lo : lo + FOUND]
                if less:
                    pair[:] = LESS.take(pair + bits.take((key[lo : lo + FOUND] & np.uint64(255)).view(np.int64), axis=0))
                if k >= ORDERS - 2:
                    gate[lo : lo + FOUND] = _gate(SEEN.take(pair), k)
            if k >= ORDERS - 2:
                self.gate.append(gate.view(np.uint64).ravel())

    def rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits (inputs, 8, rows) and gates (8, rows) of some contexts."""
        own = [at.take(rows) for at in self.at]
        out = np.empty((INPUTS, 8, len(rows)), np.float32)
        for k, level in enumerate(self.level):
            out[k] = LOGIT.take(level.take(own[k], axis=0).T)
        # The eight bits' gates are added as one number: none is above 63.
        gate = sum(x.take(at) for x, at in zip(self.gate, own[ORDERS - 2 :], strict=True))
        return out, np.ascontiguousarray(gate.view(np.uint8).reshape(-1, 8).T)


class Contexts(Levels):
    """The levels of a batch's keys, as the buckets answered."""

    def __init__(self, keys: list[np.ndarray], buckets: int, rows: list[dict]):
        parts = [(r["bucket"], _parted(r["levels"], 3 * (ORDERS + 1))) for r in rows]
        known = []
        for n, key in enumerate(keys):
            order, ends = _split(_buckets(key, n, buckets), buckets)
            level, held, size = np.zeros((len(key), 8), np.uint16), [], 0
            for b, raw in parts:
                own = order[ends[b - 1] if b else 0 : ends[b]]
                bytes_, counts, at = answered(key.take(own), raw[3 * n : 3 * n + 3])
                held.append((own, bytes_, counts, at + size))
                size += len(bytes_)
                # Buckets go on together: no two hold bytes of one context.
                if size > ASKED or b == parts[-1][0]:
                    own, *found = (np.concatenate(x) for x in zip(*held, strict=True))
                    level[own], held, size = levels(*found), [], 0
            known.append(level)
        super().__init__(keys, known)


# Learning from all training texts


def pack_lesson(parts: np.ndarray) -> bytes:
    """What a mixer learned, in single precision; what it never visited costs little."""
    return _pressed(parts.astype("<f4").tobytes())


def unpack_lesson(raw: bytes) -> np.ndarray:
    return np.frombuffer(_unpressed(raw), "<f4").astype(np.float64)


def learned(batch: Batch, kinds: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """What a mixer learns in an online pass over a batch's training texts in reading order, by the batch's own counts."""
    mixer, train = Mixer(), np.flatnonzero(batch.times > 0)
    # Lanes of contexts in reading order, read side by side: each step holds contexts of many places.
    train = train[np.argsort(np.arange(len(train)) % max(1, -(-len(train) // LANES)), kind="stable")]
    own = Inputs(Levels([k for k, _ in kinds], [levels(k, n) for k, n in kinds]), batch.at, less=True)
    byte = (batch.key.take(train) & np.uint64(255)).view(np.int64)
    mixer.learn(lambda lo, hi: own.rows(train[lo:hi]), byte, batch.times.take(train))
    return mixer.parts()


# Word counts for the baseline


def _words(text_column):
    """Distinct word hashes of a column of texts, each document's words as positions among them, and their documents."""
    hashes, docs = [], []
    for lo, _, data, off in text_slices(text_column):
        data = LOWER[data]
        s, e, doc = word_bounds(data, off, NOT_SPACE)
        hashes.append(word_hashes(data, s, e))
        docs.append(doc + lo)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    return h, doc


def _dealt_words(text_column, buckets: int):
    """Distinct word hashes, their rows by bucket, each bucket's end, and every word's place among the distinct and its document."""
    h, doc = _words(text_column)
    distinct, at = h, np.zeros(len(h), np.int32)
    if len(h):
        place, new = _groups(h)
        distinct = h[place[new]]
        at[place] = np.cumsum(new, dtype=np.int32) - 1
    order, ends = _split((mix(distinct) % np.uint64(buckets)).astype(np.int64), buckets)
    return distinct, order, ends, at, doc


def _batch_counts(buckets: int, lots: int):
    """A batch's distinct words and contexts with their counts in training texts, by bucket; and in a bucket of its lot
    what a mixer learned from it."""

    def run(table: pa.Table) -> pa.Table:
        # However rows come, they are read in one order.
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        train = ~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        distinct, order, ends, at, doc = _dealt_words(table.column("text"), buckets)
        count = np.bincount(at[train[doc]], minlength=len(distinct))
        words = np.split(order, ends[:-1])
        batch = Batch(table.column("text"), train, sums=False)
        kinds = batch.kinds()
        lesson = pack_lesson(learned(batch, kinds))
        del batch
        grown = []
        while kinds:
            key, n = kinds.pop(0)
            at, ends = _split(_buckets(key, len(grown), buckets), buckets)
            grown.append([(key[p], n[p]) for p in np.split(at, ends[:-1])])
        used = [b for b in range(buckets) if len(words[b]) or any(len(x[b][0]) for x in grown)]
        number = table.column("batch")[0].as_py()
        out = pa.table(
            {
                "bucket": pa.array([*used, buckets + number % lots], pa.int64()),
                "batch": pa.array([number] * (len(used) + 1), pa.int64()),
                "words": pa.array([*(distinct[words[b]].tobytes() for b in used), b""], pa.binary()),
                "counts": pa.array([*(count[words[b]].astype("<u4").tobytes() for b in used), b""], pa.binary()),
                "grams": pa.array([*(pack_counts([x[b] for x in grown]) for b in used), lesson], pa.binary()),
            }
        )
        trim()
        return out

    return run


def _sum_counts(buckets: int, batches: int):
    """A bucket's sums, sent to each batch that asked; a lot's sum of what mixers learned, sent to every batch."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: -r["batch"])
        bucket = rows[0]["bucket"]
        if bucket >= buckets:
            total = pack_lesson(sum(unpack_lesson(r["grams"]) for r in rows))
            to, none = list(range(batches)), [b""] * batches
            return pa.table({
                "batch": pa.array(to, pa.int64()), "bucket": pa.array([bucket] * batches, pa.int64()), "totals": pa.array(none, pa.binary()),
                "kinds": pa.array([0] * batches, pa.int64()), "levels": pa.array([total] * batches, pa.binary()),
            })
        words = [np.frombuffer(r["words"], np.uint64) for r in rows]
        key, total = merge_counts([(w, np.frombuffer(r["counts"], "<u4").astype(np.int64)) for w, r in zip(words, rows, strict=True)])
        out = pa.table(
            {
                "batch": pa.array([r["batch"] for r in rows], pa.int64()),
                "bucket": pa.array([r["bucket"] for r in rows], pa.int64()),
                "totals": pa.array([_pressed(np.minimum(total[np.searchsorted(key, w)], 2**32 - 1).astype("<u4").tobytes()) for w in words], pa.binary()),
                "kinds": pa.array([int((total > 0).sum())] + [0] * (len(rows) - 1), pa.int64()),
                "levels": pa.array(_answers([r["grams"] for r in rows]), pa.binary()),
            }
        )
        trim()
        return out

    return run


SCORED = "doc_id long, held_out boolean, n_bytes long, n_words long, n_known long, words_log10 double, score double, kinds long"


def _lesson(table: pa.Table) -> pa.Table:
    """What a mixer learned from a batch, alone."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    batch = Batch(table.column("text"), ~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool), sums=False)
    return pa.table({"batch": table.column("batch")[:1], "parts": pa.array([pack_lesson(learned(batch, batch.kinds()))], pa.binary())})


def _add_lessons(table: pa.Table) -> pa.Table:
    rows = sorted(table.select(["batch", "parts"]).to_pylist(), key=lambda r: -r["batch"])
    return pa.table({"lot": table.column("lot")[:1], "parts": pa.array([pack_lesson(sum(unpack_lesson(r["parts"]) for r in rows))], pa.binary())})


def lessons(docs: DataFrame, rows: int) -> np.ndarray | None:
    """What mixers learned from batches of the standard size, added up: for texts that are scored in other batches."""
    dealt = docs.withColumn("batch", _batch(rows, BATCH_DOCS))
    parts = dealt.groupBy("batch").applyInArrow(_lesson, "batch long, parts binary").withColumn("lot", F.col("batch") % LOTS)
    found = sorted((r["lot"], bytes(r["parts"])) for r in parts.groupBy("lot").applyInArrow(_add_lessons, "lot long, parts binary").collect())  # at most LOTS rows
    return sum(unpack_lesson(x) for _, x in found) if found else None


def _batch(rows: int, batch_docs: int):
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-rows // batch_docs))))


def _score_batch(buckets: int, taught: np.ndarray | None = None):
    def run(docs: pa.Table, back: pa.Table) -> pa.Table:
        n = docs.num_rows
        rows = sorted(back.select(["bucket", "totals", "kinds", "levels"]).to_pylist(), key=lambda r: r["bucket"])
        found = sum(r["kinds"] for r in rows)
        asked, lots = [r for r in rows if r["bucket"] < buckets], [r for r in rows if r["bucket"] >= buckets]
        distinct, order, _, at, doc = _dealt_words(docs.column("text"), buckets)
        total = np.zeros(len(distinct), np.int64)
        if asked:
            total[order] = np.concatenate([np.frombuffer(_unpressed(r["totals"]), "<u4") for r in asked])
        seen = total[at]
        mixer = Mixer()
        if taught is not None:
            mixer = mixer.averaged(taught)
        elif lots:
            mixer = mixer.averaged(sum(unpack_lesson(r["levels"]) for r in lots))
        batch = Batch(docs.column("text"), np.zeros(n, bool))
        known = Contexts([k for k, _ in batch.kinds()], buckets, asked)
        del asked, rows
        known = Inputs(known, batch.at, less=False)
        model = Model(None, mixer, lambda _, rows: known.rows(rows))
        score = batch.sums(model.log10(batch.key, np.arange(len(batch.key))))
        size = docs.column("text").cast(pa.large_binary())
        size = pc.fill_null(pc.binary_length(size), 0).to_numpy()
        kinds = np.zeros(n, np.int64)
        kinds[:1] = found
        columns = [
            docs.column("doc_id").combine_chunks(),
            docs.column("held_out").combine_chunks(),
            *(pa.array(x) for x in (size.astype(np.int64), np.bincount(doc, minlength=n), np.bincount(doc, seen > 0, n).astype(np.int64), np.bincount(doc, np.log10(seen + 1.0), n), score, kinds)),
        ]
        trim()
        return pa.table(columns, names=["doc_id", "held_out", "n_bytes", "n_words", "n_known", "words_log10", "score", "kinds"])

    return run


def scored_batches(docs: DataFrame, rows: int, batch_docs: int) -> DataFrame:
    """Batches of documents deal their words and contexts, and score their texts with what comes back, in one plan:
    batches are shuffled once, counts to buckets, and answers to batches."""
    batches = max(1, -(-rows // batch_docs))
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), batches // 4)
    # What is learned depends on how texts are dealt out: always by the same size of batches.
    taught = None if batch_docs == BATCH_DOCS else lessons(docs, rows)
    dealt = docs.withColumn("batch", _batch(rows, batch_docs))
    counts = dealt.groupBy("batch").applyInArrow(_batch_counts(buckets, LOTS), "bucket long, batch long, words binary, counts binary, grams binary")
    sums = counts.groupBy("bucket").applyInArrow(_sum_counts(buckets, batches), "batch long, bucket long, totals binary, kinds long, levels binary")
    return materialize(dealt.groupBy("batch").cogroup(sums.groupBy("batch")).applyInArrow(_score_batch(buckets, taught), SCORED))


def score(docs: DataFrame, batch_docs: int = BATCH_DOCS) -> DataFrame:
    """One row for each (doc_id, text): the model's score and the word baseline."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held_out())
    scored = scored_batches(docs, docs.count(), batch_docs)
    # The end token: one in each text, in training N counts it and V holds it.
    row = scored.agg(
        F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n_words") + 1)), F.lit(0)).alias("n"),
        F.coalesce(F.sum("kinds"), F.lit(0)).alias("v"),
        F.count(F.when(~F.col("held_out"), 1)).alias("ends"),
    ).first()
    n, v, ends = row["n"], row["v"] + (row["ends"] > 0), row["ends"]
    tokens = F.col("n_words") + 1
    base = F.col("words_log10") + float(np.log10(ends + 1.0)) - tokens * float(np.log10(float(n + v + 1)))
    return scored.select(
        "doc_id",
        "held_out",
        tokens.alias("n_tokens"),
        (F.col("n_known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        (-F.col("score") * float(np.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
