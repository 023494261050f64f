"""Exact deduplication as a stateful stream.

Texts are equal when identical after deleting white space. Every row is reduced to a record (SHA-256 digest, length,
id, content locator); a Structured Streaming aggregation on the digest keeps, in a RocksDB state store and without
expiry, the row that stays and the number of rows. Partial aggregation before the exchange means that a digest that a
third of all rows share still reaches its state as one record for each task. A locator is a row's file and its number
there, which is also the stable identifier of a row, in this batch and in those of other days.

On hits (digests with two rows or more) the rows are fetched by their locators, and their whole normalised bytes are
compared with those of the row that stays; no other text is read again or shuffled. Should bytes ever differ under one
digest, that digest's rows are grouped by their bytes instead.

:func:`decide` judges a table at once. :func:`add` and :func:`decisions` go on from day to day with a store of their
own: contents, records and state grow, and decisions are those of one batch of all days; :func:`compact` shortens the
log of the state's changes.

The row with the most code points in its original text stays; ties go to the smallest id (null ids last), then to the
first place.

Defined cases: a null text counts as empty, and all empty texts are one group; repeated rows (same id, same text) are
members of their group and only one of them stays; null ids are allowed; an empty table gives an empty result; other
columns don't matter, whatever their names.
"""

from __future__ import annotations

from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import AT, BROADCAST_BYTES, FILE, WS, at_places, located, remove, saved, scratch, small, whole, written

#: Rows of a group for each copy of the bytes that they are compared with.
SALT = 256

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised(text: Column) -> Column:
    return F.translate(whole(text), WS, "")


def sha256(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


_RECORD = f"doc_id long, digest string, n_points long, {FILE} string, {AT} long"
_RANK = f"struct<shorter: bigint, no_id: boolean, doc_id: bigint, {FILE}: string, {AT}: bigint>"


def records(content: DataFrame, text: str = "text", key: str = "doc_id", digest=sha256) -> DataFrame:
    """A record for each row of a located frame: what the state retains, and no text."""
    return content.select(content[key].cast("long").alias("doc_id"), digest(content[text]).alias("digest"), F.length(whole(content[text])).cast("long").alias("n_points"), FILE, AT)


def _rank() -> Column:
    return F.struct((-F.col("n_points")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", FILE, AT)


def _state(stream: DataFrame) -> DataFrame:
    """Keyed state: for each digest the best record and the number of records so far."""
    return stream.groupBy("digest").agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("n"))


@contextmanager
def _set(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def update_state(spark: SparkSession, stream: DataFrame, checkpoint: str, changes: str) -> None:
    """Run what is new in ``stream`` (a streaming frame of records) through the state; append changed keys to ``changes``.

    Called again with the same folders, it goes on from the state of the last run, so that the same deduplication can
    take day after day of input.
    """

    def put(batch: DataFrame, batch_id: int) -> None:  # a batch that runs again replaces what it wrote
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")

    with _set(spark, ROCKSDB):
        query = _state(stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
        query.awaitTermination()


def current_state(spark: SparkSession, changes: str) -> DataFrame:
    """The latest entry of each key: digest, best, n."""
    log = spark.read.option("basePath", changes).option("recursiveFileLookup", "true").schema(f"digest string, best {_RANK}, n bigint, batch int").parquet(changes)
    return log.groupBy("digest").agg(F.max_by(F.struct("best", "n"), "batch").alias("s")).select("digest", "s.best", "s.n")


def compact(spark: SparkSession, changes: str) -> None:
    """The log of changes as its latest entries. A run that stops midway leaves entries twice, which says the same."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(changes)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [x.getPath().toString() for x in fs.listStatus(path)]
    log = spark.read.option("recursiveFileLookup", "true").schema(f"digest string, best {_RANK}, n bigint, batch int").parquet(changes)
    log.groupBy("digest").agg(F.max_by(F.struct("best", "n", "batch"), "batch").alias("s")).select("digest", "s.*").write.parquet(f"{changes}/latest-{uuid4().hex}")
    for folder in old:
        remove(spark, folder)


def _run(spark: SparkSession, root: str, files_per_trigger: int) -> None:
    """Takes the records under ``root`` that are new through the state."""
    stream = spark.readStream.schema(_RECORD).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").parquet(f"{root}/records")
    update_state(spark, stream, f"{root}/state", f"{root}/changes")


def _members(landed: DataFrame, hits: DataFrame, n_hits: int) -> DataFrame:
    """Rows of the hits, with the place of the row that stays. A group's rows are dealt to a copy of its bytes for each SALT of them."""
    hit = small(hits.select("digest", F.col(f"best.{FILE}").alias("k_file"), F.col(f"best.{AT}").alias("k_at"), F.ceil(F.col("n") / SALT).cast("int").alias("copies")), n_hits, 300)
    rows = landed.join(hit, "digest")
    return rows.withColumns({"salt": F.pmod(F.xxhash64(FILE, AT), F.col("copies")).cast("int"), "stays": (F.col(FILE) == F.col("k_file")) & (F.col(AT) == F.col("k_at"))}).drop("k_file", "k_at")


def _fetched(content: DataFrame, members: DataFrame, text: str) -> DataFrame:
    """The members with their normalised bytes, read by their locators."""
    n = members.count()
    rows = content.select(FILE, AT, content[text].alias("text"))
    if n * 300 <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(members), [FILE, AT])
    else:
        rows = at_places(rows, members, n).join(members, [FILE, AT])
    rows = saved(rows.withColumn("bytes", normalised(F.col("text"))).drop("text"))
    if rows.count() != n:
        raise ValueError("contents are no longer where their records say")
    return rows


def _decisions(content: DataFrame, landed: DataFrame, state: DataFrame, text: str) -> DataFrame:
    hits = saved(state.filter("n > 1"))
    n_hits = hits.count()
    out, differ = hits, None
    if n_hits:
        rows = _fetched(content, saved(_members(landed, hits, n_hits)), text)
        kept = rows.filter("stays").select("digest", F.col("bytes").alias("kept_bytes"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
        differ = saved(rows.join(kept, ["digest", "salt"]).filter(F.col("bytes") != F.col("kept_bytes")).select("digest").distinct())
        if differ.isEmpty():
            differ = None
        else:
            out = hits.join(differ, "digest", "left_anti")
    shape = ["doc_id", F.col("best.doc_id").alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (F.struct(FILE, AT) == F.struct(f"best.{FILE}", f"best.{AT}")).alias("kept"), "digest", FILE, AT]
    decided = landed.join(small(out.withColumnRenamed("best", "b"), n_hits, 300), "digest", "left").withColumn("best", F.coalesce("b", _rank())).select(*shape)
    if differ is not None:  # the exact way for digests that clash: group by the bytes themselves
        rows = rows.join(differ, "digest")
        best = rows.groupBy("digest", "bytes").agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("n"))
        decided = decided.join(differ, "digest", "left_anti").unionByName(rows.join(best, ["digest", "bytes"]).select(*shape))
    return saved(decided)


def decide(docs: DataFrame, text: str = "text", key: str = "doc_id", digest=sha256, files_per_trigger: int = 10_000) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, and its locator."""
    spark = docs.sparkSession
    root = scratch(spark, "exact")
    content = docs if FILE in docs.columns else located(docs)
    records(content, text, key, digest).write.parquet(f"{root}/records")
    _run(spark, root, files_per_trigger)
    out = _decisions(content, spark.read.schema(_RECORD).parquet(f"{root}/records"), current_state(spark, f"{root}/changes"), text)
    remove(spark, root)
    return out


def add(docs: DataFrame, store: str, day: str, text: str = "text", key: str = "doc_id", digest=sha256, files_per_trigger: int = 10_000) -> None:
    """A day's documents into the store: their contents, their records, and what those change in the state. A day that runs again goes on where it stopped."""
    spark = docs.sparkSession
    written(docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")), f"{store}/content/{day}")
    content = located(spark.read.schema("doc_id long, text string").parquet(f"{store}/content/{day}"))
    written(records(content, "text", "doc_id", digest), f"{store}/records/{day}")
    _run(spark, store, files_per_trigger)


def decisions(spark: SparkSession, store: str) -> DataFrame:
    """:func:`decide`'s rows for all days that the store has, full bytes compared across days."""
    read = lambda shape, name: spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(f"{store}/{name}")
    return _decisions(located(read("doc_id long, text string", "content")), read(_RECORD, "records"), current_state(spark, f"{store}/changes"), "text")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that :func:`decide` drops, columns as they were."""
    content = located(docs)
    gone = saved(decide(content, text, key).filter("not kept").select(FILE, AT))
    return at_places(content, gone, gone.count(), inside=False).drop(FILE, AT)
