"""A training corpus from raw documents: toxicity, quality rules, near duplicates, repeated passages, packing.

Each stage reads what the stage before it has written as Parquet and takes all of it; the last one returns the packed pieces. The toxicity model is fitted on
the labelled rows among the documents of ``sf_dir``. No stage drops documents but those it rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linegauge.llm import jaccard, packing, repetition, suffix_dedup, toxicity
from linegauge.llm.common import documents, stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a calibrated score below one half."""
    model = toxicity.fit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, model)


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, of the smallest doc_id; repeated rows and copies of null doc_id are members too."""
    return jaccard.one_row_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without byte strings that occur again, ``n_chars`` counted anew."""
    return suffix_dedup.without_repeats(docs).selectExpr(
        *("cast(char_length(text) AS bigint) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns)
    )


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in sequences of 2048 ids."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("quality_rules", of_good_quality),
    ("jaccard_join", without_near_copies),
    ("suffix_dedup", without_repeated_passages),
    ("packing", into_sequences),
]

#: Stages 1, 3, 4 and 5 have no SQL form on whole tables; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
