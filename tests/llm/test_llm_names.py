"""Further columns named like working or added ones, and odd or empty tables, through every operator and stage."""

import pytest
from pyspark.sql import functions as F
from test_llm_texts import without_repeats

import corpus_pipeline
import public_tokenizers
from helixframe.llm import language_id, near_join, piece_sampling, quality, suffix_dedup, vectors

#: Names that operators work with or add.
NAMES = ["th", "tm", "spans", "n_removed", "kept_text", "removed", "score", "lang_pred", "ids", "ids_crc32", "log_prob", "decoded", "_key", "_copy", "_log_weight", "_fixed", "quality", "row", "rid", "h"]


def named(docs):
    return docs.withColumns({c: F.lit(k) for k, c in enumerate(NAMES)})


@pytest.fixture(scope="module")
def clashing(spark, odd):
    return named(odd.drop("score", "n", "batch"))


def test_repeats(clashing, odd_rows):
    out = suffix_dedup.remove_repeats(clashing)
    rows = out.collect()
    want = {r[0]: r for r in without_repeats([r[:2] for r in odd_rows])}
    assert all((r.n_bytes, r.n_removed) == want[r.doc_id][1:3] for r in rows if r.doc_id in (1, 4, 7, 9))
    assert rows[0].th == 0 and rows[0].rid == NAMES.index("rid") and sum(c == "n_removed" for c in out.columns) == 1


def test_language(clashing):
    model = language_id.fit(clashing)
    rows = language_id.predict(clashing, model).collect()
    assert len(rows) == clashing.count() and all(isinstance(r.lang_pred, str) and r.th == 0 for r in rows)
    assert language_id.keep_known(clashing, model).columns == clashing.columns


def test_pieces(clashing):
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_sampling.encode(clashing, path)
    back = piece_sampling.decode(coded, path).collect()
    assert all(r.decoded == (r.text or "") and r._key == NAMES.index("_key") for r in back)


def test_quality(spark, clashing):
    labels = spark.createDataFrame([(1, 1), (7, 1), (8, 0), (9, 0)], "doc_id long, quality int")
    kept = quality.keep_selected(clashing, labels)
    assert kept.columns == clashing.columns and {r.quality for r in kept.collect()} == {NAMES.index("quality")}


def test_one_of_each_group(clashing):
    kept = near_join.keep_one(clashing)
    assert kept.columns == clashing.columns and 0 < kept.count() < clashing.count()


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages(spark, clashing, data, rows):
    """All stages but the last keep the columns; a table without rows stays one."""
    docs = clashing if rows == "odd" else clashing.limit(0)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns and (rows == "odd" or out.count() == 0)
        assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[4][1](spark, docs, data).count() >= (docs.count() if rows == "odd" else 0)


def test_very_long_unbroken_text(spark):
    """One run of letters without a space, far longer than a slice, goes through whole."""
    text = "".join(chr(97 + (i * i + i // 5) % 26) for i in range(1_300_000))
    docs = spark.createDataFrame([(1, text), (2, text[:500_000] + "x")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got[1].n_bytes == 1_300_000 and got[2].n_removed >= 500_000
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in near_join.link_documents(docs).collect()}
    assert rows == {1: (1, 1), 2: (1, 2)}


def test_vectors_with_repeated_ids(spark):
    """Rows that repeat an id are candidates of their own, whatever their further columns are called."""
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [1.0, 0.05]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (100, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "v", "key", "row", "list", "ok", "part", "score")})
    near = [(r.query_id, r.rank, r.vec_id) for r in vectors.nearest(df).where("query_id = 0").orderBy("rank").collect()]
    assert near == [(0, 1, 1), (0, 2, 1), (0, 3, 100), (0, 4, 2), (0, 5, 2)]
    top = [(r.rank, r.vec_id, r.score) for r in vectors.exact_top_k(df).where("query_id = 0").orderBy("rank").collect()]
    assert top == [(1, 1, 1024 * 1024), (2, 1, 1024 * 921), (3, 100, 1024 * 512), (4, 2, 0), (5, 2, 0)]
