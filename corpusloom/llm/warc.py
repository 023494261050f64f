"""WARC archives (1.1, uncompressed, HTTP/1.1 responses): written with revisit records, read back by boundary-chain verification.

Writing: each row becomes one record; Spark's text writer puts the records of a task into one file, with the record
end as its line end. Equal payloads of MIN_REVISIT bytes or more are stored once; the least id of a digest is found by
a partial aggregate, so that a payload which a third of all pages share is one row for each task.

Reading: archives are split wherever a task's range falls. Spark's text reader cuts a range at every occurrence of the
magic, in payloads too. Each task emits, for every occurrence, the record that would begin there: its offset, relative
to the range, the offset of its successor (header and declared length), and, within the range, the occurrence at which
its chain leaves it. Ranges are placed in their files by a running sum of bytes. Pointer jumping over the exits, from
each file's start, doubles the length of the chains known in each round, and only records on that chain are kept: the
magic inside a payload is nobody's successor. A record's content is the text up to its successor, whatever occurrences
and ranges it spans.

Defined cases: a null html is an empty payload; a null URL gives no target header; control characters of a URL are
percent-encoded; null ids come last among equal payloads and are written as an empty id; rows that repeat an id and
a payload are all responses if they have the least id; an empty table gives an empty archive and an empty result;
other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import saved, small, whole

MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(url: Column) -> Column:
    out = url
    for code in [*range(32), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One column ``value``: each row's record, without its end."""
    rows = pages.select(pages[key].cast("long").alias("id"), pages[url].alias("url"), whole(pages[html]).alias("payload")).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    shared = saved(rows.filter(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first"))
    rows = rows.join(small(shared, shared.count(), 120), "digest", "left")
    again = F.col("first").isNotNull() & (F.coalesce(F.col("id") > F.col("first"), F.lit(True))) & (F.col("size") >= MIN_REVISIT)
    block = F.when(again, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "payload"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda field, value: F.concat(F.lit(field + ": "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", _uri(F.col("url")))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("first"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    records(pages, key, url, html).write.option("lineSep", END).text(path)


_HEADER = re.compile(rb"(?:[^\r\n]+\r\n)++\r\n")
_LENGTH = re.compile(rb"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]+)[ \t]*\r\n")
_FIELD = re.compile(rb"(?im)^(WARC-Type|WARC-Record-ID|WARC-Refers-To|WARC-Payload-Digest|WARC-Target-URI):[ \t]*([^\r\n]*)\r?$")


def fields(head: bytes) -> dict[str, str]:
    return {k.decode().lower(): v.decode("utf-8", "replace").strip() for k, v in _FIELD.findall(head)}


def _successor(content: bytes) -> int:
    """Bytes from the magic to the next record if a record begins here, else -1. ``content`` follows the magic."""
    head = _HEADER.match(content)
    length = head and _LENGTH.search(content[: head.end()])
    return len(MAGIC) + head.end() + int(length[1]) + len(END) if length else -1


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes, bool]]:
    """(file, block, place in the range, what follows the magic, whether it is what stands before a file's first magic)."""
    here, at = None, 0
    for batch in batches:
        for value, file, block in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            content, lead = value.as_py(), False
            if (file, block) != here:
                here, at, lead = (file, block), 0, block == 0
            if content or not lead:
                yield file, block, at, content, lead
            at += len(content) + (0 if lead else len(MAGIC))


_CANDIDATES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("next", pa.int64()), ("exit", pa.int64()), ("size", pa.int64()), ("type", pa.string()), ("id", pa.string()), ("refers", pa.string()), ("digest", pa.string()), ("url", pa.string()), ("bytes", pa.int64()), ("sha", pa.string())])
_CANDIDATE_SHAPE = "file string, block long, at long, next long, exit long, size long, type string, id string, refers string, digest string, url string, bytes long, sha string"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: each occurrence of the magic with its would-be successor and the exit of its chain, but no content."""
    here, rows = None, []

    def done() -> Iterator[pa.RecordBatch]:
        exits: dict[int, int] = {}
        for row in reversed(rows):  # chains only lead on, so one pass from the end resolves them
            if row["next"] >= 0:
                row["exit"] = exits[row["at"]] = exits.get(row["next"], row["next"])
        for k in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_pylist(rows[k : k + 1000], _CANDIDATES)

    for file, block, at, content, lead in _occurrences(batches):
        if (file, block) != here:
            yield from done()
            here, rows = (file, block), []
        row = {"file": file, "block": block, "at": at, "next": -1, "size": len(content) + (0 if lead else len(MAGIC))}
        n = -1 if lead else _successor(content)
        if n >= 0:
            row["next"] = at + n
            head = _HEADER.match(content).end()
            f = fields(content[:head])
            row |= {"type": f.get("warc-type"), "id": f.get("warc-record-id"), "refers": f.get("warc-refers-to"), "digest": f.get("warc-payload-digest"), "url": f.get("warc-target-uri")}
            if n <= row["size"]:  # the whole record lies before the next occurrence
                payload = content[head : n - len(MAGIC) - len(END)]
                payload = payload[payload.find(b"\r\n\r\n") + 4 :]
                row |= {"bytes": len(payload), "sha": hashlib.sha256(payload).hexdigest()}
        rows.append(row)
    yield from done()


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows each occurrence, one after the other."""
    for file, block, at, content, _ in _occurrences(batches):
        yield pa.RecordBatch.from_pydict({"file": pa.array([file]), "block": pa.array([block], pa.int64()), "at": pa.array([at], pa.int64()), "content": pa.array([content], pa.binary())})


def _reached(found: DataFrame) -> DataFrame:
    """(file, block, entry): where the chain from each file's start enters each range, by pointer jumping over exits."""
    jump = saved(found.filter("out is not null").select("file", F.col("start").alias("a"), F.col("out").alias("b")))
    known = saved(jump.filter("a = 0").select("file", "a"))
    n = known.count()
    while True:
        more = known.unionByName(known.join(jump, ["file", "a"]).select("file", F.col("b").alias("a"))).distinct().join(jump.select("file", "a").distinct(), ["file", "a"], "left_semi")
        more = saved(more)
        now = more.count()
        if now == n:
            return known
        known, n = more, now
        step = jump.select("file", F.col("a").alias("b"), F.col("b").alias("c"))
        jump = saved(jump.join(step, ["file", "b"], "left").select("file", "a", F.coalesce("c", "b").alias("b")))


def _chain(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one range's would-be records, those that its entry leads to."""
    to = dict(zip(rows["start"], rows["to"], strict=True))
    on, at = [], next(iter(rows.loc[rows["entry"], "start"]), None)
    while at in to:
        on.append(at)
        at = to[at]
    return pd.DataFrame({"file": pd.Series([str(rows["file"].iloc[0])] * len(on), dtype=object), "start": pd.Series(on, dtype="int64")})


@F.pandas_udf(BinaryType())
def _payload(contents: pd.Series, lengths: pd.Series) -> pd.Series:
    """The payload in what follows a record's magic, given the record's length."""
    out = []
    for content, n in zip(contents, lengths, strict=True):
        block = content[_HEADER.match(content).end() : n - len(MAGIC) - len(END)]
        out.append(block[block.find(b"\r\n\r\n") + 4 :])
    return pd.Series(out)


@F.pandas_udf(BinaryType())
def _rejoined(parts: pd.Series) -> pd.Series:
    return pd.Series([MAGIC.encode().join(p["content"] for p in ps) for ps in parts])


def read(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """The records under ``path``: file, start, type, id, refers, digest, url, bytes and sha (of the payload), and the payload if ``content``."""
    cut = spark.read.option("lineSep", MAGIC).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    found = saved(cut.mapInArrow(_candidates, _CANDIDATE_SHAPE))
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("size"))
    base = sizes.withColumn("base", F.sum("size").over(Window.partitionBy("file").orderBy("block")) - F.col("size")).drop("size")
    places = {"start": F.col("base") + F.col("at"), "out": F.col("base") + F.col("exit"), "to": F.col("base") + F.col("next")}
    placed = found.join(base, ["file", "block"]).withColumns(places).drop("base", "at", "next", "exit")
    contents = cut.mapInArrow(_contents, "file string, block long, at long, content binary").join(base, ["file", "block"]).select("file", (F.col("base") + F.col("at")).alias("start"), "content")
    slim = saved(placed.select("file", "block", "start", "out", "to", F.col("sha").isNull().alias("torn")))
    entries = _reached(slim).select("file", F.col("a").alias("start"), F.lit(True).alias("entry"))
    inner = slim.filter("to is not null").join(entries, ["file", "start"], "left").select("file", "block", "start", "to", F.coalesce("entry", F.lit(False)).alias("entry"))
    on = saved(inner.groupBy("file", "block").applyInPandas(_chain, "file string, start long"))
    kept = placed.join(on, ["file", "start"])
    shape = ["file", "start", "type", "id", "refers", "digest", "url"]
    out = kept.filter("sha is not null")
    if content:  # read once more, in the second place
        out = out.join(contents, ["file", "start"]).withColumn("payload", _payload("content", F.col("to") - F.col("start")))
    out = out.select(*shape, "bytes", "sha", *(["payload"] if content else []))
    # records that the magic in their payload cuts, few as a rule: put what lies up to the successor together, reading its content once more
    chain = slim.join(on.withColumn("on", F.lit(True)), ["file", "start"], "left")
    if chain.filter("on and torn").isEmpty():
        return out
    owner = F.last(F.when(F.col("on"), F.struct(F.col("start").alias("owner"), (F.col("to") - F.col("start")).alias("length"), "torn")), True).over(Window.partitionBy("file").orderBy("start"))
    parts = chain.withColumn("o", owner).filter("o.torn").select("file", "start", "o.owner", "o.length")
    parts = saved(parts)
    parts = contents.join(small(parts, parts.count(), 300), ["file", "start"])
    joined = parts.groupBy("file", F.col("owner").alias("start"), "length").agg(F.array_sort(F.collect_list(F.struct("start", "content"))).alias("parts"))
    body = joined.select("file", "start", _payload(_rejoined("parts"), F.col("length")).alias("payload"))
    mended = kept.filter("sha is null").select(*shape).join(body, ["file", "start"])
    mended = mended.select(*shape, F.length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("sha"), *(["payload"] if content else []))
    return out.unionByName(mended)


def _number(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, "<urn:page:(-?[0-9]*)>", 1), F.lit("")).cast("long")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record; a revisit's payload is its response's."""
    rows = read(spark, path).select(_number(F.col("id")).alias("page_id"), "type", _number(F.col("refers")).alias("refers_to"), "bytes", F.col("sha"), F.regexp_replace("digest", "^sha256:", "").alias("stated"))
    rows = saved(rows)
    again = rows.filter("type = 'revisit'")
    first = rows.filter("type = 'response'").groupBy(F.col("sha").alias("stated")).agg(F.max("bytes").alias("full"))
    whole_of = saved(again.select("stated").distinct().join(first, "stated"))
    again = again.join(small(whole_of, whole_of.count(), 120), "stated", "left").select("page_id", F.col("full").alias("payload_bytes"), F.col("stated").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    return rows.filter("type = 'response'").select("page_id", F.col("bytes").alias("payload_bytes"), F.col("sha").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to").unionByName(again)
