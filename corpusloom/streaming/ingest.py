"""Continuous ingestion: page files in, new sentences out, novelty kept in a table and not in operator state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.crawl import Options, first_seen, sentences, valid_sentences


def new_sentences(batch: DataFrame, store: DataFrame | None, key: str, text: str, opt: Options = Options()) -> DataFrame:
    """A batch's valid sentences that the store lacks, the first place of each."""
    found = first_seen(valid_sentences(sentences(batch, key, text, opt)), [key, "pos"]).withColumn("id", F.md5("sentence"))
    return found if store is None else found.join(store.select("id"), "id", "left_anti")


def start(spark: SparkSession, source: str, schema: str, store: str, checkpoint: str, key: str = "doc_id", text: str = "text", opt: Options = Options(), then: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Each micro-batch of files under ``source`` appends its new sentences to ``store``.

    A batch writes to a folder of its own number, so a batch that runs again after a failure replaces what it wrote and
    novelty is judged against the batches before it only.
    """

    def take(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        path = s.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
        fs = path.getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
        known = None
        if fs.exists(path):
            known = s.read.option("basePath", store).parquet(f"{store}/batch=*").filter(F.col("batch") < number)
        out = new_sentences(batch, known, key, text, opt)
        out.write.mode("overwrite").parquet(f"{store}/batch={number}")
        if then:
            then(s.read.parquet(f"{store}/batch={number}"))

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take).start()
