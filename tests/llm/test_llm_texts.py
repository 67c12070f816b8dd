"""Operators on texts against brute-force versions, on the small tables and on odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from helixframe.llm import language_id, licences, mixing, near_join, packing, piece_sampling, quality, suffix_dedup
from helixframe.llm._shared import components
from helixframe.llm.suffix_arrays import permuted_common_prefixes, suffix_array

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")


def counted(rows):
    return collections.Counter(map(tuple, rows))


# Scores


def baseline(rows):
    learn = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 != 2
    words = [(d, [*re.findall(WORD, (t or "").translate(LOWER)), None]) for d, t in rows]
    seen = collections.Counter(w for d, ws in words if learn(d) for w in ws)
    n, v = sum(seen.values()), len(seen)
    return counted(
        (d, not learn(d), len(ws), sum(seen[w] > 0 for w in ws), n, round(sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws), 5))
        for d, ws in words
    )


def test_scores(spark, data, odd, odd_rows, empty):
    docs = documents(spark, data)
    got = mixing.score(docs, batch_docs=40).collect()
    shown = lambda rows: counted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
    assert shown(got) == baseline([tuple(r) for r in docs.collect()])
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert sum(r.bits_per_byte < 4 for r in got) > 0.9 * len(got)
    again = mixing.score(docs.repartition(7), batch_docs=11).collect()
    assert {r.doc_id: round(r.score, 6) for r in got} == {r.doc_id: round(r.score, 6) for r in again}
    got = mixing.score(odd).collect()
    assert shown(got) == baseline([r[:2] for r in odd_rows])
    assert mixing.score(empty).collect() == []


def test_bits_are_a_distribution():
    """The probabilities of all bytes after one context add up to one."""
    rng = np.random.default_rng(1)
    table = rng.integers(0, 65536, int(mixing.BASE[-1])).astype(np.uint16)
    model = mixing.Model(table, mixing.Mixer())
    for context in (0, 0x6162636465):
        key = (np.uint64(context << 8) | np.arange(256, dtype=np.uint64))
        word = np.uint64(77 << 8) | np.arange(256, dtype=np.uint64)
        assert abs((10.0 ** model.log10(key, word)).sum() - 1) < 1e-6


def test_counts_of_contexts_are_exact():
    """Far more contexts than the hashed tables had slots: no context's counts hold another's."""
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 123, 60_000).astype(np.uint8).tobytes().decode() for _ in range(6)]
    train = np.array([True] * 5 + [False])
    parts = [mixing.contexts(pa.array([t]), train[i : i + 1]) for i, t in enumerate(texts)]
    raw = mixing._answers([mixing.pack_counts(p) for p in parts])[5]
    keys = [k for k, _ in parts[5]]
    found = mixing.Contexts(keys, 1, [{"bucket": 0, "levels": raw}])
    seen = collections.Counter()
    for t in texts[:5]:
        for i in range(5, len(t)):
            for k in range(8):
                seen[t[i - 5 : i], 1 << k | ord(t[i]) >> 8 - k, ord(t[i]) >> 7 - k & 1] += 1
    assert len({(c, n) for c, n, _ in seen}) > 1 << mixing.TABLE_BITS
    data = np.frombuffer(texts[5].encode(), np.uint8)
    key, word, _ = mixing.grams(data, np.array([0, len(data)]))
    pair = found.find(key[5:-1], word[5:-1])[mixing.LENGTHS.index(5)]
    for i in range(0, pair.shape[1], 7):
        c, b = texts[5][i : i + 5], ord(texts[5][i + 5])
        want = [tuple(mixing.to_level(np.array([seen[c, 1 << k | b >> 8 - k, x] for x in (0, 1)]))) for k in range(8)]
        assert [(p >> 8, p & 255) for p in pair[:, i].tolist()] == want


@pytest.mark.parametrize("bits", [4, 10, 22])
def test_batches_sort_contexts_once(monkeypatch, bits):
    """Contexts that earlier slices met are looked up, not sorted again; those that lost their slot are merged."""
    sorts = []
    monkeypatch.setattr(mixing, "SLICE", 2000)
    monkeypatch.setattr(mixing, "SLOT_BITS", bits)
    groups = mixing._groups
    monkeypatch.setattr(mixing, "_groups", lambda both: sorts.append(len(both)) or groups(both))
    texts = [f"lorem ipsum {'dolor sit amet ' * 60}{k % 7}\n" for k in range(60)] + ["", None, "é \x00\x00", "lorem" * 900]
    train = np.arange(len(texts)) % 3 > 0
    batch = mixing.Batch(pa.array(texts), train)
    want, number, lengths = {}, [], []
    for t, learn in zip(texts, train, strict=True):
        data = np.frombuffer((t or "").encode(), np.uint8)
        key, word, _ = mixing.grams(data, np.array([0, len(data)]))
        for c in zip(key.tolist(), word.tolist(), strict=True):
            number.append(list(want).index(c) if c in want else len(want))
            want[c] = want.get(c, 0) + int(learn)
        lengths.append(len(key))
    assert list(zip(batch.key.tolist(), batch.word.tolist(), strict=True)) == list(want) and batch.times.tolist() == list(want.values())
    value = np.random.default_rng(3).random(len(want))
    assert np.allclose(batch.sums(value), np.add.reduceat(value[number], np.cumsum(lengths) - lengths))
    if bits == 22:
        assert sum(sorts) < 0.25 * sum(lengths)


def test_levels_are_made_once(monkeypatch):
    """However many buckets answer, small answers' levels are made together; a mixer's inputs are those of its contexts' levels."""
    texts = [f"lorem ipsum {'dolor sit amet ' * k}{k % 7}\n" for k in range(60)] + ["", None, "é \x00\x00", "lorem" * 900]
    batch = mixing.Batch(pa.array(texts), np.arange(len(texts)) % 3 > 0)
    kinds, buckets, made, calls = batch.kinds(), 50, mixing.levels, []
    own = [mixing._buckets(key, k, buckets) for k, (key, _) in enumerate(kinds)]
    asked = [mixing.pack_counts([(key[x == b], n[x == b]) for x, (key, n) in zip(own, kinds, strict=True)]) for b in range(buckets)]
    rows = [{"bucket": b, "levels": mixing._answers([x])[0]} for b, x in enumerate(asked)]
    monkeypatch.setattr(mixing, "levels", lambda key, *more: calls.append(len(key)) or made(key, *more))
    found = mixing.Contexts([key for key, _ in kinds], buckets, rows)
    assert len(calls) == mixing.INPUTS
    for (key, n), level in zip(kinds, found.level, strict=True):
        seen = collections.Counter()
        for x, times in zip(key.tolist(), n.tolist(), strict=True):
            for i in range(8):
                seen[x >> 8, i, x >> 7 - i & (2 << i) - 1] += times
        for x, got in zip(key.tolist(), level.tolist(), strict=True):
            sides = [[seen[x >> 8, i, (x >> 7 - i & (2 << i) - 1) & ~1 | bit] for bit in (0, 1)] for i in range(8)]
            assert [[p >> 8, p & 255] for p in got] == mixing.to_level(np.array(sides).ravel()).reshape(8, 2).tolist()
    pair, bit = np.stack([x[at].T for x, at in zip(found.level, batch.at, strict=True)]), mixing._bits(batch.key)
    for less, p in [(False, pair), (True, mixing.LESS[pair + (bit << 16)])]:
        logit, gate = mixing.Inputs(found, batch.at, less).rows(np.arange(len(batch.key)))
        seen = mixing.SEEN[p]
        assert (logit == mixing.LOGIT[p]).all() and (gate == seen[4] * 16 + seen[3] * 4 + seen[2]).all()


def test_mixer_learns_from_whole_training_texts():
    """Every bit of every training text, beyond any window, moves weights and map; held-out texts move none."""
    texts = [f"lorem ipsum {i * i} dolor " * 300 for i in range(9)] + ["", None]
    docs = pa.table({"doc_id": list(range(11)), "text": texts, "held_out": [i % 3 == 2 for i in range(11)], "batch": [0] * 11})
    (row,) = [r for r in mixing._batch_counts(1, 1)(docs).to_pylist() if r["bucket"] == 1]
    start = mixing.Mixer()
    weights, visits, _, hits = np.split(mixing.unpack_lesson(row["grams"]), np.cumsum([512 * (mixing.INPUTS + 1), 512, 256 * 24]))
    bits = 8 * sum(len(t or "") + 1 for i, t in enumerate(texts) if i % 3 != 2)
    assert visits.sum() == bits and hits.sum() == bits
    used = visits > 0
    assert (weights.reshape(512, -1)[used] != (start.weights * visits[:, None])[used]).any(1).all()


# Packing


def check_packed(rows, docs):
    tokenizer = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json")).tokenizer
    want = collections.Counter()
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want[d, len(ids)] += 1
        pieces = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        for k, p in enumerate(pieces):
            want[d, k * 4096, len(p), zlib.crc32(p.tobytes()), len(ids)] += 1
    assert counted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == collections.Counter({k: v for k, v in want.items() if len(k) == 5})
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return sum(r.length for r in rows) / 4096 / max(1, len(sequences))


def test_packing(spark, data, odd, odd_rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark, data)
    assert check_packed(packing.pack_documents(docs, path).collect(), [tuple(r) for r in docs.collect()]) > 0.95
    check_packed(packing.pack_documents(odd, path).collect(), [r[:2] for r in odd_rows])
    assert packing.pack_documents(empty, path).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_patterns(seed):
    rng = np.random.default_rng(seed)
    histogram = {int(k): int(c) for k, c in zip(rng.integers(1, 101, 30), rng.integers(0, 500, 30), strict=True)}
    used = collections.Counter()
    patterns = packing.shortest_pack_first(histogram, 100)
    for count, items in patterns:
        assert sum(a * b for a, b in items) <= 100
        for length, times in items:
            used[length] += count * times
    assert +used == +collections.Counter(histogram)
    assert len(patterns) <= 2 * len(histogram)


# Sampled pieces


def test_pieces(spark, data, odd, odd_rows, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = documents(spark, data)
    rows = piece_sampling.round_trip(docs, path).collect()
    assert all(r.lossless for r in rows) and len(rows) == docs.count()
    assert {tuple(r) for r in piece_sampling.round_trip(docs.repartition(5), path).collect()} == {tuple(r) for r in rows}
    assert all(r.lossless for r in piece_sampling.round_trip(odd, path).collect())
    assert piece_sampling.round_trip(empty, path).collect() == []
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    sampled = piece_sampling.encode(docs, path, seed=4).limit(20).collect()
    assert all(model.decode(r.ids) == r.text for r in sampled)


def test_sampling_follows_weights():
    sampler = piece_sampling.Sampler(piece_sampling.Pieces(public_tokenizers.path("piece_bpe_32k.model")))
    pieces = sampler.pieces

    def segmentations(chunk):
        if not chunk:
            yield (), 0.0
        for k in range(1, len(chunk) + 1):
            if chunk[:k] in pieces.of:
                for rest, weight in segmentations(chunk[k:]):
                    yield (pieces.of[chunk[:k]], *rest), weight + pieces.weight[pieces.of[chunk[:k]]]

    every = dict(segmentations(b" there"))
    total = sum(math.exp(w) for w in every.values())
    n = 20000
    data, off = np.frombuffer(b"there" * n, np.uint8), np.arange(n + 1) * 5
    ids, borders, logs = sampler.sample(data, off, np.arange(n, dtype=np.uint64) * np.uint64(7919))
    seen = counted(ids[borders[i] : borders[i + 1]].tolist() for i in range(n))
    assert max(abs(seen[k] / n - math.exp(w) / total) for k, w in every.items()) < 0.015
    first = tuple(ids[: borders[1]].tolist())
    assert abs(logs[0] - (every[first] - math.log(total))) < 1e-5


# Similarity join


def linked(rows):
    sets = []
    for d, t in rows:
        w = re.findall(WORD, (t or "").translate(LOWER))
        sets.append((d, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    group = {d: d for d, _ in sets if d is not None}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                group[hi] = lo
    return counted((d, len(x), None if d is None else root(d)) for d, x in sets)


def test_links(spark, data, odd, odd_rows, empty):
    docs = documents(spark, data)
    want = linked([tuple(r) for r in docs.collect()])
    assert counted(near_join.link_documents(docs).collect()) == want
    assert counted(near_join.link_documents(docs, tile_rows=1).collect()) == want
    assert counted(near_join.link_documents(odd).collect()) == linked([r[:2] for r in odd_rows])
    assert near_join.link_documents(empty).collect() == []
    kept = near_join.keep_one(odd)
    assert kept.columns == odd.columns
    first = {d for d, _, c in linked([r[:2] for r in odd_rows]) if d == c and d is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(first)


def test_chain_of_near_texts(spark):
    """Texts that link only with their neighbours are one component; a shared passage alone links nothing."""
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(words[k * 5 : k * 5 + 60])) for k in range(20)]
    shared = " ".join(f"s{i}" for i in range(40))
    rows += [(100 + k, shared + " " + " ".join(f"o{k}_{i}" for i in range(12))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert counted(near_join.link_documents(docs).collect()) == linked(rows)


@pytest.mark.parametrize("task_links", [0, 1_000_000])
def test_components(spark, task_links):
    rng = np.random.default_rng(3)
    links = [tuple(map(int, x)) for x in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    group = {x: x for link in links for x in link}
    for _ in range(400):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    got = components(spark.createDataFrame(links, "a long, b long"), task_links=task_links)
    linked_nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in got.collect()} == {x: group[x] for x in linked_nodes}


# Repeats


def without_repeats(rows, length=400):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return counted(out)


@pytest.mark.parametrize("limits", [{}, {"shard_windows": 3, "shard_bytes": 20000}])
def test_repeats(spark, data, odd, odd_rows, empty, limits):
    shown = lambda docs: counted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, **limits).collect())
    docs = documents(spark, data)
    assert shown(docs) == without_repeats([tuple(r) for r in docs.collect()])
    assert shown(odd) == without_repeats([r[:2] for r in odd_rows])
    assert shown(empty) == collections.Counter()
    passage = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(450))
    rows = [(k, f"{k}" * (30 + k) + passage[: 390 + k] + "x" * k) for k in range(40)] + [(99, "ab" * 900)]
    assert shown(spark.createDataFrame(rows, "doc_id long, text string")) == without_repeats(rows)


@pytest.mark.parametrize("seed", range(40))
def test_suffix_arrays(seed):
    rng = np.random.default_rng(seed)
    symbols = int(rng.integers(1, 5))
    t = np.append(rng.integers(1, symbols + 1, rng.integers(0, 200)), 0)
    sa = suffix_array(t, symbols + 1)
    raw = bytes(t.astype(np.uint8))
    assert sa.tolist() == sorted(range(len(t)), key=lambda i: raw[i:])
    common = permuted_common_prefixes(t, sa)
    for i in range(1, len(t)):
        a, b = raw[sa[i - 1] :], raw[sa[i] :]
        n = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common[sa[i]] == n


# Licences


def test_licences(spark, data, odd, odd_rows, empty):
    def places(rows):
        out = []
        for d, t in rows:
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
            found = [(i, label) for p, label in licences.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
            at = [i for i, _ in found]
            out.append((d, len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))))
        return counted(out)

    docs = documents(spark, data)
    for given, rows in ((docs, [tuple(r) for r in docs.collect()]), (odd, [r[:2] for r in odd_rows])):
        got = licences.scan(given).collect()
        assert counted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == places(rows)
        assert all(0 <= r.score <= 1 and {*r.base_labels.split(",")} <= {*r.labels.split(","), ""} for r in got)
    assert licences.scan(empty).collect() == []


def test_matching_statistics():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 3, 12).tolist() for _ in range(4)]
    automaton = licences.SuffixAutomaton(texts)
    seq = rng.integers(0, 4, 300).tolist()
    for i, (state, n) in enumerate(automaton.stream(seq)):
        def inside(k, i=i):
            part = seq[i + 1 - k : i + 1]
            return [(t, j + k - 1) for t, x in enumerate(texts) for j in range(len(x) - k + 1) if x[j : j + k] == part]

        best = max(k for k in range(min(i + 1, 12) + 1) if k == 0 or inside(k))
        assert n == best
        if n:
            assert automaton.ends[state] == inside(n)


def test_changed_template_is_found():
    scanner = licences.Scanner()
    label, text = licences.TEMPLATES[2]
    words = licences.tokens(text)
    changed = words[:10] + words[11:25] + ["gnu"] + words[25:]
    spans = scanner.spans([scanner.ids[w] for w in changed])
    assert any(scanner.labels[t] == label and cover > 0.8 for t, _, _, cover in spans)


# Language


def test_language(spark, data, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs)
    shown = docs.select("doc_id", "lang", language_id.held_out().alias("held_out"), "text")
    rows = [r for r in language_id.predict(shown, model).collect() if r.held_out]
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows)
    got = language_id.predict(odd.select("doc_id", "text"), model).collect()
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {None, 4, 5, 6, 13} and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.predict(empty.select("doc_id", "text"), model).collect() == []
    repeated = spark.createDataFrame([(0, "zz", "one text"), (0, "yy", "another"), (0, "yy", "a third")] * 3, "doc_id long, lang string, text string")
    assert language_id.fit(repeated).labels == ["yy"]
    assert language_id.fit(empty) is None
    assert {r.lang_pred for r in language_id.predict(odd.select("doc_id", "text"), None).collect()} == {"und"}


def test_gradients():
    rng = np.random.default_rng(0)
    tagger = language_id.ByteTagger(["a", "b", "c"], hidden=4)
    for layer in (tagger.ahead, tagger.behind):
        layer.x, layer.u = layer.x.astype(float), layer.u.astype(float)
    tagger.out, tagger.bias = tagger.out.astype(float), tagger.bias.astype(float)
    byte, label = rng.integers(0, 5, (6, 4)).astype(np.uint8), rng.integers(0, 3, 4)
    _, grads = tagger.loss(byte, label)
    for p, g in zip(tagger.parameters(), grads, strict=True):
        for _ in range(4):
            i = tuple(rng.integers(0, min(s, 5)) for s in p.shape)
            kept, e = p[i], 1e-5
            p[i] = kept + e
            up = tagger.loss(byte, label)[0]
            p[i] = kept - e
            down = tagger.loss(byte, label)[0]
            p[i] = kept
            assert abs((up - down) / (2 * e) - g[i]) < 1e-5


# Quality


def test_quality(spark, data, odd, empty):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r for r in quality.select(docs, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    good = [got[d].selected for d, q in known.items() if q == 1]
    bad = [got[d].selected for d, q in known.items() if q == 0]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.1 * len(bad)
    keys = sorted((r.key for r in got.values()), reverse=True)
    assert min(r.key for r in got.values() if r.selected) >= keys[sum(r.selected for r in got.values()) - 1] - 1e-5
    kept = quality.keep_selected(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.selected}
    assert all(r.selected for r in quality.select(odd, labels.limit(0)).collect())
    assert len(quality.select(odd, labels).collect()) == odd.count()
    assert quality.select(empty, labels).collect() == []


def test_kth_largest(spark):
    rng = np.random.default_rng(4)
    x = [int(v) for v in rng.integers(-(10**12), 10**12, 500)] + [5, 5, 5]
    rows = spark.createDataFrame([(v,) for v in x], "v long")
    for k in (1, 17, 250, 503):
        assert quality.kth_largest(rows, "v", k) == sorted(x)[-k]
    assert quality.kth_largest(rows, "v", 504) is None and quality.kth_largest(rows, "v", 0) is None


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    """Null and repeated ids: a text's copies leave one row, and rows that share an id but not a text both stay."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(1)), (None, text(1)), (None, text(2)), (5, text(2)), (6, text(3)), (6, text(4)), (7, text(5)), (7, text(5)), (8, text(5) + " end"), (9, text(6)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = counted(near_join.keep_one(docs).collect())
    assert got == counted([(None, text(1)), (5, text(2)), (6, text(3)), (6, text(4)), (7, text(5)), (9, text(6)), (None, None)])
    plain = docs.where("doc_id in (5, 8, 9)")
    assert counted(near_join.keep_one(plain).collect()) == counted(plain.collect())


def test_settled_bands_go_into_no_turn(spark, monkeypatch):
    """After the first turn only bands whose documents are of several components are written and joined again."""
    from helixframe.llm import fingerprints

    words = lambda k, n: [f"w{k}x{i}" for i in range(n)]
    texts = [" ".join(words(k, 60)) for k in range(40)]
    texts += [" ".join([*words(100, 60)[:-1], f"end{k}"]) for k in range(4)]
    seen = []

    def kept(df):
        out = materialize(df)
        if "band" in out.columns:
            seen.append((set(out.columns), out.count(), out.select("rep").distinct().count()))
        return out

    materialize = fingerprints.materialize
    monkeypatch.setattr(fingerprints, "materialize", kept)
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {k: min(k, 40) for k in range(44)}
    assert seen[0][1] == 32 * 44 and len(seen) > 2
    # The forty texts that are like no other are in no later table, and those that are linked are in none after that.
    assert seen[1][2] == 4 and all(n == 0 for _, n, _ in seen[2:])


def test_repeated_windows_join_once_each(spark):
    """Windows of a passage that many texts share are looked up once a text: spans grow with the texts, not with their square."""
    from helixframe.llm import suffix_dedup

    rng = np.random.default_rng(4)
    words = lambda n: " ".join("".join(chr(97 + x) for x in rng.integers(0, 26, 7)) for _ in range(n))
    shared = words(400)
    texts = [(k, f"{words(120)} {shared} {words(120)}") for k in range(80)]
    spans = [suffix_dedup.repeated_spans(spark.createDataFrame(texts[:n], "doc_id long, text string")).count() for n in (20, 40, 80)]
    assert spans[1] <= 2.2 * spans[0] and spans[2] <= 2.2 * spans[1]


def test_equal_windows_of_a_text_are_one_row(spark):
    """A line over and over has equal windows, one a period: rows grow with the texts, not with the line's repeats."""
    line = "all rights reserved, see the notice at the end of this very page for what it says; "
    rows = lambda n: [(k, f"{k} begins here. " + line * n + f" and ends with {k}") for k in range(12)]
    docs = {n: spark.createDataFrame(rows(n), "doc_id long, text string") for n in (20, 200)}
    spans = {n: suffix_dedup.repeated_spans(x).count() for n, x in docs.items()}
    assert spans[200] == spans[20]
    got = counted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs[20]).collect())
    assert got == without_repeats(rows(20))
