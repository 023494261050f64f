"""Quality rules, exact dedup, SimHash near-dedup, source mixing and piece encoding, one after the other.

Each stage takes the documents that its predecessor kept and returns documents, but for the last, which returns their
digests. A document that the mix takes twice is two rows from there on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import exact_dedup, mixing, pieces, quality, simhash_dedup
from corpusloom.llm.common import remove, saved, scratch, table

#: Names that measures and marks of the stages may not take from the documents.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(quality.keep(_documents(docs)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(exact_dedup.keep_first(_documents(docs)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(simhash_dedup.keep_first(_documents(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _documents(mixing.select(_documents(docs)))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digest(_documents(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written as Parquet and read again. What a stage has read goes when it has written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        else:
            docs = saved(docs)
        if before:
            remove(spark, before)
        before = path
    return docs


#: XXH64 shingles, bit majorities and piece encodings are beyond SQL.
ORACLE_SQL = None
