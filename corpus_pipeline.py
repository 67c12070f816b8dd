"""A corpus pipeline of whole-table stages: STAGES, run(spark, sf_dir) and ORACLE_SQL.

Every stage reads what its predecessor wrote, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import language_id, near_join, packing, quality, suffix_dedup
from helixframe.llm._shared import shared_folder
from helixframe.llm.queries import WORD_TOKENIZER

#: Repeated strings of so many bytes (about fifty words) go.
PASSAGE_BYTES = suffix_dedup.PASSAGE


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects; the labels of ``sf_dir`` name the target."""
    return quality.keep_selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network has learned; those without a letter or with a near-even score go."""
    return language_id.keep_known(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by shingle similarity."""
    return near_join.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated byte strings; documents of which only white space stays go."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    # Further columns travel in one of their own, so that their names clash with none of the operator's.
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    cut = suffix_dedup.remove_repeats(docs.select("doc_id", "text", row), PASSAGE_BYTES)
    kept = cut.where((F.col("n_removed") == 0) | (F.trim("kept_text") != ""))
    columns = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[columns[c].alias(c) if c in columns else F.col("row")[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as pieces of token sequences."""
    return packing.pack_documents(docs, WORD_TOKENIZER)


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("packing", pack),
]

#: SQL cannot express trained models and tokenizers; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
