"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a frame; all but the last
return the columns of ``documents``. The stages share nothing but that frame, so any of them
can be run again from the written result of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelane.llm import line_dedup, packing, quality_rules, simhash, surrogates
from farelane.llm.common import land
from farelane.llm.queries import SURROGATE_KEY, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines too many documents of their host share."""
    return quality_rules.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines found on many sites."""
    return line_dedup.remove_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal entities."""
    return surrogates.replace_entities(docs, SURROGATE_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_dedup),
    ("PII surrogates", private),
    ("best-fit packing", packed),
]

#: Fingerprints, surrogates and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
