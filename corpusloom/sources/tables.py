"""Schemas of the stored collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import password_hash

_DELETED = "struct<by: string, comment: string, date: timestamp>"
_SOURCE = "struct<type: string, extra: string>"

SCHEMAS = {
    "sentences": f"id string, text string, url string, date_added timestamp, crawl_proba double, validated_by array<string>, deleted {_DELETED}, dialect struct<label: string, count: bigint, confidence: double, labels: array<struct<user: string, label: string, date: timestamp>>, skipped_by: array<string>>",
    "urls": f"id string, url string, source {_SOURCE}, date_added timestamp, crawl_history array<struct<date: timestamp, count: bigint, hash: string, sents_count: bigint, sg_sents_count: bigint>>, count bigint, delta bigint, delta_date timestamp",
    "blacklist": f"id string, url string, date_added timestamp, source {_SOURCE}",
    "seeds": f"id string, source {_SOURCE}, date_added timestamp, count bigint, delta_date timestamp, search_history array<struct<date: timestamp, count: bigint, hash: string>>, deleted {_DELETED}",
    "texts": "id string, urls array<string>, text string, date_added timestamp",
    "users": "id string, password string, roles array<string>",
}


#: What is appended as it happens; states are aggregates over these facts.
FACTS = {
    "sentences": "id string, text string, url string, date_added timestamp, crawl_proba double",
    "crawls": "url string, source_type string, source_extra string, date timestamp, count bigint, hash string, sents_count bigint, sg_sents_count bigint",
    "texts": "id string, text string, url string, date_added timestamp",
    "blacklist": "url string, source_type string, source_extra string, date_added timestamp",
    "seed_uses": "id string, date timestamp, count bigint",
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A fact table, empty before anything was saved."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], FACTS[name])
    return spark.read.schema(FACTS[name]).parquet(f"{root}/{name}")


def append(rows: DataFrame, root: str, name: str) -> None:
    rows.to(rows.sparkSession.createDataFrame([], FACTS[name]).schema).write.mode("append").parquet(f"{root}/{name}")


def save_round(done, root: str, date: Column) -> None:
    """A crawl round's sentences, visits, raw texts and blacklisted URLs; pages that are blacklisted leave no visit.

    A URL is one visit; of several texts its hash is the smallest.
    """
    visited = done.counts.filter("error is null").join(done.blacklist.select("url"), "url", "left_anti")
    texts = done.texts.join(visited.select("url"), "url").select(F.md5("text").alias("id"), "text", "url", date.alias("date_added"))
    none = F.lit(None).cast("string")
    append(done.new_sentences.join(visited.select("url"), "url").select(F.md5("sentence").alias("id"), F.col("sentence").alias("text"), "url", date.alias("date_added"), F.col("proba").cast("double").alias("crawl_proba")), root, "sentences")
    append(visited.join(texts.groupBy("url").agg(F.min("id").alias("hash")), "url", "left").select("url", F.lit("auto").alias("source_type"), none.alias("source_extra"), date.alias("date"), F.col("new_count").alias("count"), "hash", F.col("sentence_count").alias("sents_count"), F.col("sg_count").alias("sg_sents_count")), root, "crawls")
    append(texts, root, "texts")
    append(done.blacklist.select("url", F.when(F.col("error").isNull(), "auto").otherwise("error").alias("source_type"), F.col("error").alias("source_extra"), date.alias("date_added")), root, "blacklist")


def url_state(spark: SparkSession, root: str) -> DataFrame:
    """URLs with their counters, those that were blacklisted since left out."""
    rows = load(spark, root, "crawls")
    last = F.struct("date", "hash")
    state = rows.groupBy("url").agg(F.sum("count").alias("count"), F.max_by("count", last).alias("delta"), F.max("date").alias("delta_date"), F.count(F.lit(1)).alias("crawls"), F.max_by("sents_count", last).alias("sents_count"))
    return state.join(load(spark, root, "blacklist").select("url").distinct(), "url", "left_anti")


def text_state(spark: SparkSession, root: str) -> DataFrame:
    """Raw texts with all their URLs."""
    return load(spark, root, "texts").groupBy("id").agg(F.any_value("text").alias("text"), F.array_sort(F.collect_set("url")).alias("urls"), F.min("date_added").alias("date_added"))


def get(rows: DataFrame, key: str, value) -> DataFrame:
    """The row of a key, or none."""
    return rows.filter(F.col(key) == value).limit(1)


def existing(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Of many keys, those that a table has."""
    return keys.select(key).distinct().join(rows.select(key), key, "left_semi")


def login(users: DataFrame, name: str, password: str) -> DataFrame:
    """The user of a name and password, or none."""
    return get(users.filter(F.col("password") == password_hash(F.lit(password))), "id", name)
