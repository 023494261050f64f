"""Readers and writers: URL and seed lists, stop lists, pages, CSV exports and sentence dumps."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(line, url) of a list with a URL on each line; lines that begin with # are comments."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.trim("value").alias("url"))
    return rows.filter((F.col("url") != "") & ~F.startswith("url", F.lit("#")))


def seed_list(spark: SparkSession, path: str) -> DataFrame:
    """(line, id) of a list with a seed on each line; lines that begin with a space are left out."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.col("value").alias("id"))
    return rows.filter((F.trim("id") != "") & ~F.startswith("id", F.lit(" "))).select("line", F.trim("id").alias("id"))


def lines(path: str) -> list[str]:
    return Path(path).read_text(encoding="utf-8").splitlines()


def word_list(path: str) -> list[str]:
    return [w for w in (line.strip() for line in lines(path)) if w]


def rules(path: str) -> list:
    """Sentence rules of a YAML or JSON file."""
    import yaml

    from corpusloom.functions.rules import from_config

    return from_config(yaml.safe_load("\n".join(lines(path))))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages as a table (page_id, url, html); fetching is not Spark's work."""
    return spark.read.parquet(path)


def search_results(spark: SparkSession, path: str) -> DataFrame:
    """Search results as a table (query, rank, url), whatever client got them."""
    return spark.read.parquet(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).csv(path)


def write_sentences(rows: DataFrame, path: str, sentence: str = "sentence") -> None:
    rows.select(F.col(sentence).alias("value")).write.text(path)


def tool(spark: SparkSession, source: str, target: str, column) -> None:
    """A text tool as a job: each line of ``source`` through a column function, lines with arrays as several."""
    out = spark.read.text(source).select(column(F.col("value")).alias("value"))
    out = out.select(F.explode("value").alias("value")) if out.dtypes[0][1].startswith("array") else out.filter("value") if out.dtypes[0][1] == "boolean" else out
    out.select(F.col("value").cast("string").alias("value")).write.text(target)
