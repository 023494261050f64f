"""Tables of pages in which a URL comes more than once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom import catalog
from corpusloom.operators import crawl, review, seeds
from corpusloom.sources import tables

from .oracle import connect, rows_of, rows_of_sql

PAGES = [
    ("http://a.ch/", "one of all\ntwo of all\nthree"),
    ("http://a.ch/", "two of all\nfour of all"),
    ("http://a.ch/", "two of all\nfour of all"),
    ("http://b.ch/", "two of all\nfive"),
    ("http://b.ch/", None),
    ("http://c.ch/", None),
    ("http://c.ch/", None),
]


def _round(spark):
    """Texts as they stand, with their last line as a link."""
    error = F.when(F.col("html").isNull(), "EmptyDocumentError").alias("error")
    crawler = lambda rows: rows.select("url", F.col("html").alias("text"), F.array(F.concat("url", F.element_at(F.split("html", "\n"), -1))).alias("hrefs"), error)
    detector = lambda rows: rows.withColumn("proba", F.when(F.col("sentence").contains(" of "), 1.0).otherwise(0.0))
    pages = spark.createDataFrame(PAGES, "url string, html string").select("url", "html", F.lit(1).alias("depth"), F.lit(None).cast("timestamp").alias("delta_date"))
    none = spark.createDataFrame([], "text string, url string")
    return crawl.crawl_round(pages, none, none, crawl.Tools(crawler=crawler, sg_detector=detector))


def test_round_counts_a_url_once(spark):
    r = _round(spark)
    got = sorted((tuple(x) for x in r.counts.select("url", "error", "sentence_count", "sg_count", "new_count").collect()), key=str)
    assert got == [("http://a.ch/", None, 4, 3, 3), ("http://b.ch/", None, 2, 1, 0), ("http://c.ch/", "EmptyDocumentError", 0, 0, 0)]
    assert sorted(tuple(x) for x in r.new_sentences.select("url", "sentence").collect()) == [("http://a.ch/", s) for s in ("four of all", "one of all", "two of all")]
    assert [tuple(x) for x in r.blacklist.collect()] == [("http://c.ch/", "EmptyDocumentError")]
    assert sorted(x.url for x in r.children.collect()) == ["http://a.ch/four of all", "http://a.ch/three", "http://b.ch/five"]


def test_a_url_is_one_visit(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        tables.save_round(_round(spark), str(tmp_path), F.lit(day).cast("timestamp"))
    got = sorted(tuple(x) for x in tables.url_state(spark, str(tmp_path)).select("url", "count", "delta", "crawls", "sents_count").collect())
    assert got == [("http://a.ch/", 6, 3, 2, 4), ("http://b.ch/", 0, 0, 2, 2)]
    assert {(u, x.text) for x in tables.text_state(spark, str(tmp_path)).collect() for u in x.urls} == {x for x in PAGES if x[1]}
    assert tables.load(spark, str(tmp_path), "sentences").count() == 6


@pytest.fixture(scope="module")
def repeated(spark, data, tmp_path_factory):
    """A folder with pages, each second one twice: under another number and with the next one's contents."""
    at = tmp_path_factory.mktemp("repeated")
    pages = [tuple(r) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").orderBy("page_id").limit(60).collect()]
    pages += [(k + 1009, url, pages[i + 1][2]) for i, (k, url, _) in enumerate(pages) if i % 2 == 0]
    spark.createDataFrame(pages, "page_id long, url string, html string").toPandas().to_parquet(at / "pages.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["configured_turn", "blacklist_urls", "insert_absent", "delete_seeds", "delete_found"])
def test_query_on_repeated_urls(spark, repeated, name):
    assert rows_of(catalog.QUERIES[name](spark, repeated)) == rows_of_sql(connect(repeated), catalog.ORACLE_SQL[name])


def test_blacklisted_urls_leave_in_all_their_rows(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    left, gone = crawl.blacklist_urls(rows, spark.createDataFrame([("a", None)], "url string, error string"))
    assert [r.url for r in left.collect()] == ["b"] and [tuple(r) for r in gone.collect()] == [("a", "auto", None)]


def test_insert_keeps_keys_single(spark):
    new = spark.createDataFrame([("a", "new"), ("b", "new"), ("b", "new")], "url string, v string")
    out = crawl.insert_absent(spark.createDataFrame([("a", "old")], "url string, v string"), new, "url")
    assert sorted(tuple(r) for r in out.collect()) == [("a", "old"), ("b", "new")]


def test_seeds_go_in_all_their_rows(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 2), ("b", 0)], "id string, num_searches int")
    out = seeds.delete(rows, rows.filter("num_searches = 2"), F.lit("2024-01-01").cast("timestamp"))
    assert sorted((r.id, r.num_searches, r.deleted is None) for r in out.collect()) == [("a", 2, False), ("b", 0, True)]


def test_found_urls_go_in_all_their_rows(spark):
    rows = spark.createDataFrame([(1, "a", 3), (2, "a", 0), (3, "b", 0)], "k int, url string, count int").withColumn("crawls", F.lit(1))
    sents = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, url string")
    out = review.delete_found(rows, sents, True, url="A", min_count=2)
    assert [r.k for r in out["urls"].collect()] == [3] and [tuple(r) for r in out["deleted"].collect()] == [("a", 2)]
    out = review.delete_found(rows, sents, True, "k", url="A", min_count=2)
    assert sorted(r.k for r in out["urls"].collect()) == [2, 3] and [tuple(r) for r in out["deleted"].collect()] == [(1, 1)]
