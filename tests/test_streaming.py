"""Continuous ingestion finds what one batch finds, and each sentence once."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import crawl
from corpusloom.sources import files
from corpusloom.streaming import ingest


def test_ingest(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    for day in range(2):
        docs.filter(F.col("doc_id") % 2 == day).write.parquet(f"{tmp_path}/in/day{day}")
        ingest.start(spark, f"{tmp_path}/in/*", "doc_id long, text string", f"{tmp_path}/store", f"{tmp_path}/check").awaitTermination()
    store = spark.read.parquet(f"{tmp_path}/store/batch=*")
    whole = crawl.first_seen(crawl.valid_sentences(crawl.sentences(docs)), ["doc_id", "pos"])
    assert store.count() == store.select("id").distinct().count() == whole.count()


def test_lists(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("# no\nhttp://a.ch/\n\n  http://b.ch/  \n")
    (tmp_path / "seeds.txt").write_text("one seed\n left out\n")
    assert [r.url for r in files.url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["http://a.ch/", "http://b.ch/"]
    assert [r.id for r in files.seed_list(spark, str(tmp_path / "seeds.txt")).collect()] == ["one seed"]
