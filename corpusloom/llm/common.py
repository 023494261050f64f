"""Shared helpers: scratch space that all executors see, checkpoints, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The white space of every contract: space and U+0009 to U+000D.
WS = " \t\n\x0b\x0c\r"

#: A side is broadcast only when its rows, counted beforehand, take no more than this many bytes.
BROADCAST_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only where all run on one machine may it be unset."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="corpusloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system, wherever it is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(rows: DataFrame, path: str) -> None:
    """Rows as Parquet, unless a run before has finished the same: then its files, and places in them, stay."""
    spark = rows.sparkSession
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        rows.write.mode("overwrite").parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast if the counted rows fit BROADCAST_BYTES; else leave the join to Spark."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


#: A row's place: its file, and its number there.
FILE, AT = "__file", "__at"
_BITS, _BITMAP_BYTES, _PLACE_BYTES = 32768, 4300, 200


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with each row's place in its file.

    Rows that come straight from Parquet files have theirs; others are written to the shared folder first.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias") and plan.children().size() == 1:
        plan = plan.children().apply(0)
    straight = plan.nodeName().startswith(("LogicalRelation", "Relation")) and "parquet" in plan.toString().split("\n")[0].lower()
    if not straight:
        path = scratch(docs.sparkSession, "landed")
        docs.write.parquet(path)
        docs = docs.sparkSession.read.schema(docs.schema).parquet(path)
    return docs.withColumns({FILE: F.col("_metadata.file_path"), AT: F.col("_metadata.row_index")})


def at_places(rows: DataFrame, marks: DataFrame, n: int, inside: bool = True) -> DataFrame:
    """The located ``rows`` at the ``n`` places of ``marks``, or (``inside`` false) all others. No other row is shuffled.

    Few marks are broadcast as they are. More of them become bitmaps, a bit for each row of a file, which are broadcast
    for as many files at a time as BROADCAST_BYTES hold; each file is still read once.
    """
    marks = marks.select(F.col(FILE).alias("__f"), F.col(AT).alias("__a"))
    if n * _PLACE_BYTES <= BROADCAST_BYTES:
        return rows.join(F.broadcast(marks), (F.col(FILE) == F.col("__f")) & (F.col(AT) == F.col("__a")), "left_semi" if inside else "left_anti")
    number = F.col("__a") + 1
    maps = saved(marks.groupBy("__f", F.bitmap_bucket_number(number).alias("__b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("__bits")))
    groups, size = [[]], 0
    for f, k in sorted(maps.groupBy("__f").count().collect()):  # as many as there are files
        if groups[-1] and (size + k) * _BITMAP_BYTES > BROADCAST_BYTES:
            groups.append([])
            size = 0
        groups[-1].append(f)
        size += k
    # a byte of the bitmap as two hexadecimal digits, and a bit of it
    bit = F.expr(f"(conv(hex(substring(__bits, cast(({AT} % {_BITS}) div 8 as int) + 1, 1)), 16, 10) >> cast({AT} % 8 as int)) & 1")
    parts = []
    for files in groups:
        side = F.broadcast(maps.filter(F.col("__f").isin(files)))
        found = rows.filter(F.col(FILE).isin(files)).join(side, (F.col(FILE) == F.col("__f")) & (F.bitmap_bucket_number(F.col(AT) + 1) == F.col("__b")), "inner" if inside else "left")
        parts.append(found.filter((bit == 1) if inside else F.coalesce(bit == 0, F.lit(True))).drop("__f", "__b", "__bits"))
    if not inside:
        parts.append(rows.filter(~F.col(FILE).isin([f for files in groups for f in files])))
    return reduce(DataFrame.unionByName, parts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a small table has fewer partitions than there are cores; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores)


def boxed(docs: DataFrame) -> Column:
    """A row's columns in one struct, safe from whatever names an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def beside(docs: DataFrame, *names: str) -> list[Column]:
    """The columns of ``docs`` but those that a result's names take."""
    return [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {n.lower() for n in names}]


def whole(text: Column | str) -> Column:
    """A text, null counting as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """The maximal runs without white space, in order."""
    trimmed = F.btrim(text, F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+", -1))


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches, most: int = 1 << 20):
    """Arrow batches cut where the texts of their last column reach ``most`` bytes, to bound what a worker holds."""
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        first, n = 0, 0
        for k in range(batch.num_rows):
            n += len(texts[k].as_buffer() or b"") if texts[k].is_valid else 0
            if n >= most:
                yield batch.slice(first, k + 1 - first)
                first, n = k + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)


def through(docs: DataFrame, own: list[Column], text: Column, work, results: StructType) -> DataFrame:
    """Columns ``own`` of ``docs`` beside the ``results`` of Arrow work on a text of each: ``work`` takes slices' lists of texts and gives arrays.

    They pass through the workers untouched; nothing is held beyond a slice and the batch it is cut from.
    """

    def run(batches):
        import pyarrow as pa

        job = work()
        for part in slices(batches):
            kept = [part.column(k) for k in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *job(part.column(part.num_columns - 1).to_pylist())], names)

    rows = docs.select(*own, text.alias("__text"))
    schema = StructType([*rows.schema.fields[:-1], *results.fields])
    names = schema.names
    return rows.mapInArrow(run, schema)
