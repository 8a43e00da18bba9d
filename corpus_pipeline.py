"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before kept. All but the last return the
columns of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from martflow.llm import decontaminate, jaccard, packing, pii, quality
from martflow.llm.samples import remainder
from martflow.llm.shipping import ship_package
from martflow.llm.stored import stored
from martflow.sources.tables import read_parquet

MIN_QUALITY = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on part of the labels, accepts."""
    labels = read_parquet(spark, sf_dir, "labels")
    model = quality.learn_quality(docs, labels.where(remainder(labels["doc_id"], 3) != 1))
    names = [f"c{i}" for i in range(len(docs.columns))]
    scored = quality.score_quality(docs, model).toDF(*names, "score")
    return scored.where(F.col("score") >= MIN_QUALITY).drop("score").toDF(*docs.columns)


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that of smallest id."""
    return jaccard.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = read_parquet(spark, sf_dir, "benchmark")
    return decontaminate.without_leaks(docs, benchmark, short_items=True)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and lengths brought up to date."""
    return pii.mask_pii(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", first_of_near_copies),
    ("benchmark_decontamination", without_benchmarks),
    ("pii", without_personal_data),
    ("packing", packed),
]

# Training, automata and tokenizers have no counterpart in SQL; tests/llm compares
# the stages with plain searches.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the whole ``documents`` table."""
    ship_package(spark)
    docs = read_parquet(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
