"""Spelling variants, fingerprints and the source audit against brute-force versions, on small tables and on odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import divergence, fingerprints, near_join, spellings

LOWER = {i: i + 32 for i in range(65, 91)}


def counted(rows):
    return collections.Counter(map(tuple, rows))


# Spelling variants


def spelled(rows):
    """(word, form, root, n, n_near, form_n) by sets of words with one character left out or starred."""
    n = collections.Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            k = h % len(w)
            w = w[:k] + w[k + 1 :] if h % 97 == 0 else w
            n[w] += len(w) >= 5
    n = {w: c for w, c in n.items() if c >= 3}
    stars, near = collections.defaultdict(set), collections.defaultdict(set)
    for w in n:
        for k in range(len(w)):
            stars[w[:k] + "*" + w[k + 1 :]].add(w)
            less = w[:k] + w[k + 1 :]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for group in stars.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(x, key=lambda o: (-n[o], o)) for w, x in near.items() if x}
    form = {w: o for w, o in best.items() if n[o] >= 2 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return counted((w, form.get(w), root(w), c, len(near[w]), n[form[w]] if w in form else None) for w, c in n.items())


@pytest.mark.parametrize("tile", [8192, 4])
def test_variants(spark, data, tile):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    want = spelled([tuple(r) for r in docs.collect()])
    assert counted(spellings.variants(docs, tile=tile).collect()) == want and any(r[1] != r[2] and r[1] for r in want)


def test_variants_of_odd_rows(spark, odd, odd_rows, empty):
    rows = [(*r[:2],) for r in odd_rows]
    clashing = odd.withColumns({c: F.lit(1) for c in ("word", "n", "form", "near", "key", "tile")})
    assert counted(spellings.variants(clashing).collect()) == spelled(rows)
    assert spellings.variants(empty).collect() == []
    # Repeated letters, edits at both ends, letters beyond ASCII, and one run of letters far longer than any word.
    long = "".join(chr(97 + (i * i + i // 5) % 26) for i in range(3000))
    words = "aaaaa aaaaaa aaaaaaa baaaaaa abababab bababab abababa éabcdé éabcd abcdé ÉABCDÉ xabcdefg abcdefg abcdefgh ßabcdefg".split()
    rows = [(i, " ".join([*words, long, long[1:]])) for i in range(5)] + [(None, "abcdefg " * 9), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(spellings.variants(docs, tile=3).collect()) == spelled(rows)
    long = "".join(chr(97 + (i * i + i // 5) % 26) for i in range(300_000))
    docs = spark.createDataFrame([(i, f"{long} {long[1:]}") for i in range(4)], "doc_id long, text string")
    assert {(len(r.word), r.n_near) for r in spellings.variants(docs).collect()} == {(300_000, 1), (299_999, 1)}


# Fingerprints


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check_edits(got, rows):
    """Rows of distinct ids (None first) against edits made one after the other."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    by_id, errors, prints = {r.doc_id: r for r in got}, [], {}
    assert len(by_id) == len(got) == len(rows)
    for (d, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        r, half = by_id[d], len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint and prints.setdefault(changed, r.edited_fingerprint) == r.edited_fingerprint
        errors += [r.near_edited - jaccard(text, changed), r.near_next - jaccard(text, after)]
        assert r.near_edited == 1 or changed != text
    assert max(map(abs, errors)) < 0.2 and abs(np.mean(errors)) < 0.02


def test_edits(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    check_edits(fingerprints.compare_edits(docs).collect(), [tuple(r) for r in docs.collect()])


def test_edits_of_odd_rows(spark, odd, odd_rows, empty):
    rows = [r[:2] for k, r in enumerate(odd_rows) if k not in (2, 12)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, part int, h long, size int")
    check_edits(fingerprints.compare_edits(docs).collect(), rows)
    assert fingerprints.compare_edits(empty).collect() == []
    assert len(fingerprints.compare_edits(odd).collect()) == len(odd_rows)
    one = fingerprints.compare_edits(spark.createDataFrame([(5, "äb cde")], "doc_id long, text string")).collect()
    check_edits(one, [(5, "äb cde")])
    long = "".join(chr(97 + (i * i + i // 5) % 26) for i in range(1_300_000))
    rows = [(1, long), (2, "x " * 700_000), (3, long)]
    check_edits(fingerprints.compare_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_permutations_estimate_similarity():
    """Estimates of many pairs are without bias, with the spread that the number of permutations gives."""
    rng = np.random.default_rng(5)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.9):
        for _ in range(60):
            words = rng.integers(0, 10**6, 400)
            kept = int(400 * 2 * share / (1 + share))
            texts = [" ".join(map(str, words)), " ".join(map(str, np.concatenate([words[:kept], rng.integers(0, 10**6, 400 - kept)])))]
            raw = [t.encode() for t in texts]
            sign = fingerprints.signatures(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
            errors.append(float(fingerprints.likeness(sign[:1], sign[1:])[0]) - jaccard(*texts))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_near_duplicates(spark, data, odd, empty):
    """Bands find what the exact join links; classes of odd rows agree with it."""
    for docs in (spark.read.parquet(f"{data}/documents.parquet"), odd):
        want = counted(r[::2] for r in near_join.link_documents(docs).collect())
        assert counted(fingerprints.near_duplicates(docs).collect()) == want
    assert fingerprints.near_duplicates(empty).collect() == []


# Source audit


def audited(rows, least, top):
    """(lang, source, part, item, value, rank) by full loops over groups and kept terms; rows are (text, lang, source)."""
    seen, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        seen[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {x for x, _ in seen}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: c for (x, s), c in seen.items() if x == lang}
        own[None] = sum(own.values(), collections.Counter())
        total = {s: sum(c[t] for t in kept) for s, c in own.items()}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (total[s] + 2 * len(kept)) for t in kept} for s, c in own.items()}
        apart = lambda x, y: (x - y) ** 2 // (x + y)
        for s in own.keys() - {None}:
            pairs = [(o, sum(apart(p[s][t], p[o][t]) for t in kept)) for o in own.keys() - {None, s}]
            terms = [(t, apart(p[s][t], p[None][t])) for t in kept if own[s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return counted(out)


@pytest.mark.parametrize(("least", "top", "width"), [(10, 10, None), (2, 3, 256), (300, 5, None)])
def test_audit(spark, data, least, top, width):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = divergence.audit(docs, least, top, width)
    assert counted(got.collect()) == audited([tuple(r) for r in docs.select("text", "lang", "source").collect()], least, top)


def test_audit_of_odd_rows(odd, odd_rows, empty):
    clashing = odd.withColumns({c: F.lit(1) for c in ("term", "p", "item", "value", "docs", "total")})
    want = audited([(r[1], r[2], r[3]) for r in odd_rows], 2, 10)
    assert counted(divergence.audit(clashing, 2).collect()) == want and want
    assert divergence.audit(empty).collect() == []


def test_sketch_never_underestimates(spark):
    """However narrow, the merged sketch is at least each term's document frequency, up to the threshold."""
    rows = [(f"common w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} {'rare' * (i == 7)} common", "en", "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    for width in (64, 4096):
        found = {r.term: r.docs for r in divergence.counts(docs, divergence.sketch(docs, width, 10), 10).collect()}
        exact = collections.Counter(t for r in rows for t in set(r[0].split()))
        assert {t: n for t, n in exact.items() if n >= 10} == {t: n for t, n in found.items() if n >= 10}
        assert found["common"] == 400 and (width < 4096 or "rare" not in found)
