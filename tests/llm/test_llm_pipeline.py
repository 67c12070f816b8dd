"""The pipeline's stages on a small table, and its registered queries."""

import hashlib

from test_llm_texts import check_packed, counted, linked, without_repeats

import __spark_entry__ as entry
import corpus_pipeline
from helixframe.llm._shared import materialize


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, data)
        rows = out.collect()
        if k < 4:
            assert out.columns == columns
            now = {r.doc_id for r in rows}
            assert now <= before and len(now) == len(rows)
            before = now
            docs = spark.createDataFrame(rows, docs.schema)
        else:
            assert {r.doc_id for r in rows} == before


def test_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert any(x.startswith(f"op{n}_") for x in names)


def test_run_against_brute_force(spark, data, monkeypatch):
    """What each stage of run() makes of what it is given: untouched rows, by brute force from the third stage on."""
    steps = []

    def watched(stage):
        def step(spark, docs, sf_dir):
            out = stage(spark, docs, sf_dir)
            steps.append((docs, materialize(out)))
            return steps[-1][1]

        return step

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(f)) for n, f in corpus_pipeline.STAGES])
    last = counted(corpus_pipeline.run(spark, data).collect())
    rows = [(given.collect(), made.collect()) for given, made in steps]
    assert len(rows) == 5 and last == counted(rows[4][1])
    assert all(counted(rows[k][1]) == counted(rows[k + 1][0]) for k in range(4))
    for given, made in rows[:3]:
        assert made and not counted(made) - counted(given)
    texts = lambda k: [(r.doc_id, r.text) for r in rows[k][0]]
    first = {d for d, _, c in linked(texts(2)) if d == c}
    assert counted(rows[2][1]) == counted(r for r in rows[2][0] if r.doc_id in first)
    made = {r.doc_id: r for r in rows[3][1]}
    for d, size, removed, _, sha in without_repeats(texts(3), corpus_pipeline.PASSAGE_BYTES):
        if d in made:
            assert hashlib.sha256(made[d].text.encode()).hexdigest() == sha and made[d].n_chars == len(made[d].text)
        else:  # only white space stayed
            assert removed and sha == hashlib.sha256(b" " * (size - removed)).hexdigest()
    check_packed(rows[4][1], texts(4))
