"""Licence scan: matching statistics of texts against a generalised suffix automaton of licence tokens.

The automaton knows every run of tokens of the templates below. Texts are
streamed through it: for each word it gives the longest run ending there that
occurs in some template. Long matches of one template are chained where they
are in order in text and template, and a chain that covers enough of the
template is a span of that licence. Words that no template holds reset the
automaton, so whole texts are first reduced to the stretches of words known to
it; numpy does that on the bytes.

Edge cases: null and empty texts have no words, no labels and score 0; rows
with null ids and repeated rows keep their row each; an empty table gives an
empty result; a text of any length is streamed word by word; further columns
are not read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._text import ALNUM, LOWER, text_slices, word_bounds, word_hashes

#: Phrases whose every place counts, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Public licence notices as templates, by label.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("cc-by", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)

#: A match of fewer words is no evidence; a span covers this share of its template.
MIN_MATCH = 4
MIN_COVER = 0.75
MAX_GAP = 8


def tokens(text: str) -> list[str]:
    """Words of a short text, as the scan sees them."""
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    s, e, _ = word_bounds(data, np.array([0, len(data)]), ALNUM)
    raw = data.tobytes()
    return [raw[i:j].decode() for i, j in zip(s, e, strict=True)]


class SuffixAutomaton:
    """Generalised suffix automaton over token ids; states know where their runs end in each template."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for t, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c, ends)
                ends[last].add((t, i))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            ends[self.link[state]] |= ends[state]
        self.ends = [sorted(x) for x in ends]

    def _new(self, length: int, ends: list) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        ends.append(set())
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int, ends: list) -> int:
        clone = self._new(self.length[p] + 1, ends)
        self.next[clone] = dict(self.next[q])
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int, ends: list) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c, ends)
        new, p = self._new(self.length[last] + 1, ends), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c, ends)
        return new

    def stream(self, seq):
        """(state, length) of the longest match that ends at each token."""
        state = length = 0
        for c in seq:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            yield state, length


class Scanner:
    """Templates, their automaton, and the hashes of their words."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        words = sorted({w for _, x in (*templates, *((b, a) for a, b in phrases)) for w in tokens(x)})
        self.ids = {w: i for i, w in enumerate(words)}
        raw = [np.frombuffer(w.encode(), np.uint8) for w in words]
        hashes = np.array([word_hashes(r, np.array([0]), np.array([len(r)]))[0] for r in raw], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.labels = [label for label, _ in templates]
        self.templates = [[self.ids[w] for w in tokens(x)] for _, x in templates]
        self.automaton = SuffixAutomaton(self.templates)
        self.phrases = [([self.ids[w] for w in tokens(x)], label) for x, label in phrases]

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the words of those hashes, -1 for words of no template."""
        slot = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[slot] == hashes, self.order[slot], -1)

    def matches(self, seq: list[int]) -> list[tuple[int, int, int, int]]:
        """Maximal matches (template, template start, text start, length) of at least MIN_MATCH words."""
        out, found = [], [*self.automaton.stream(seq), (0, 0)]
        for i in range(len(seq)):
            state, n = found[i]
            if n >= min(MIN_MATCH, len(seq)) and found[i + 1][1] != n + 1:
                out += [(t, e - n + 1, i - n + 1, n) for t, e in self.automaton.ends[state]]
        return out

    def spans(self, seq: list[int]) -> list[tuple[int, int, int, float]]:
        """(template, first, last, cover) of the best chain of matches for each template and place."""
        by: dict[int, list] = {}
        for t, a, b, n in self.matches(seq):
            by.setdefault(t, []).append((b, a, n))
        out = []
        for t, rows in by.items():
            rows.sort()
            best: list[tuple[int, int]] = []  # words covered by the chain that ends here, its first row
            starts = [r[0] for r in rows]
            for i, (b, a, n) in enumerate(rows):
                cover, head = n, i
                for j in range(bisect_left(starts, b - MAX_GAP - len(self.templates[t])), i):
                    bj, aj, nj = rows[j]
                    gap, step = b - (bj + nj), a - (aj + nj)
                    if -n < gap <= MAX_GAP and -n < step <= MAX_GAP and a > aj and b > bj:
                        new = best[j][0] + n + min(0, gap, step)
                        if new > cover:
                            cover, head = new, best[j][1]
                best.append((cover, head))
            chains: dict[int, tuple[int, int]] = {}
            for i, (cover, head) in enumerate(best):
                chains[head] = max(chains.get(head, (0, 0)), (cover, rows[i][0] + rows[i][2] - 1))
            size = len(self.templates[t])
            out += [
                (t, rows[head][0], last, cover / size)
                for head, (cover, last) in chains.items()
                if cover >= MIN_COVER * size
            ]
        return out


def _scan(templates, phrases):
    def run(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            docs = batch.column("doc_id")
            for lo, hi, data, off in text_slices(batch.column("text")):
                data = LOWER[data]
                s, e, doc = word_bounds(data, off, ALNUM)
                ids = scanner.known(word_hashes(data, s, e))
                at = np.searchsorted(doc, np.arange(hi - lo + 1))
                base: dict[int, list] = {}
                for seq, label in scanner.phrases:
                    n = len(seq)
                    hit = np.ones(max(0, len(ids) - n + 1), bool)
                    for k, c in enumerate(seq):
                        hit &= ids[k : len(ids) - n + 1 + k] == c
                    if len(hit):
                        hit &= doc[: len(hit)] == doc[n - 1 :]
                    for i in np.flatnonzero(hit).tolist():
                        base.setdefault(int(doc[i]), []).append((i, label))
                spans: dict[int, list] = {}
                far = np.flatnonzero(ids >= 0)
                if len(far):
                    cut = np.flatnonzero((np.diff(far) > 1 + MAX_GAP) | (np.diff(doc[far]) > 0)) + 1
                    for part in np.split(far, cut):
                        if len(part) >= MIN_MATCH and _longest(part) >= MIN_MATCH:
                            i, j = int(part[0]), int(part[-1]) + 1
                            for t, a, b, cover in scanner.spans(ids[i:j].tolist()):
                                spans.setdefault(int(doc[i]), []).append(
                                    (scanner.labels[t], i + a - int(at[doc[i]]), i + b - int(at[doc[i]]), min(1.0, cover))
                                )
                out = []
                for d in range(hi - lo):
                    hits, own = base.get(d, ()), spans.get(d, ())
                    where = [i - int(at[d]) for i, _ in hits]
                    base_labels = sorted({x for _, x in hits})
                    labels = sorted({*base_labels, *(x[0] for x in own)})
                    score = max([x[3] for x in own], default=0.5 if hits else 0.0)
                    listed = sorted(own, key=lambda x: (x[1], x[2], x[0]))
                    out.append((int(at[d + 1] - at[d]), len(hits), min(where, default=None), max(where, default=None), ",".join(base_labels), ",".join(labels), score, [{"label": a, "first": b, "last": c, "cover": f} for a, b, c, f in listed]))
                cols = list(zip(*out, strict=True))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(lo, hi - lo), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
                )

    return run


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())]))


def _longest(part: np.ndarray) -> int:
    """The longest run of consecutive numbers."""
    cut = np.flatnonzero(np.diff(part) != 1)
    return int(np.diff(np.concatenate([[-1], cut, [len(part) - 1]])).max())


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """One row for each (doc_id, text): phrase places, licence labels and covered template spans."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(templates, phrases),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, spans array<struct<label: string, first: long, last: long, cover: double>>",
    )
