"""A corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its result is written
as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orefold.llm import cotraining, fmindex, packing, rules, simhash
from orefold.llm.common import documents, materialise
from orefold.llm.queries import WORD_VOCABULARY


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the co-trained classifier takes for bad or toxic."""
    return cotraining.keep_good(docs, _labels(spark, sf_dir))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the learned decision list, or its base checks, reject."""
    return rules.keep_good(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of copies and near copies."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts words of passages that also stand in an earlier document."""
    return fmindex.rewrite(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into token sequences."""
    return packing.pack_documents(docs, WORD_VOCABULARY)


STAGES = [
    ("quality_classifier", classify),
    ("quality_rules", apply_rules),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

#: Learned models, fingerprints and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
