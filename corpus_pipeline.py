"""From raw documents to packed sequences: classify, deduplicate, mix, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last the columns of documents, the last
one the packed pieces. Each works on all rows that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelyx.llm import exact_dedup, mixing, near_dedup, packing, quality_classifier
from panelyx.llm.common import cut, read

#: Least Jaccard index, in percent, at which documents are near copies here (85 is the contract of the op3 query alone).
NEAR_PERCENT = 80
#: Shares of tokens by domain after mixing; the clean documents' own tokens set the total, so that they stay.
WEIGHTS = {"clean": 0.955, "toxic": 0.04, "low": 0.005}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every group of equal texts stays."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of every component of near copies stays."""
    return near_dedup.deduplicate(docs, percent=NEAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as their rates say."""
    return mixing.mix(docs, read(spark, sf_dir, "labels"), weights=WEIGHTS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, each with its sequence and its place there."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: Learned models, sketches and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
