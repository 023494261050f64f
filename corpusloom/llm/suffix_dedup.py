"""Long repeats across documents, by run-length indexes over content-defined pieces.

A byte goes if a string of WINDOW bytes that covers it also starts in a document of a smaller id. The corpus is packed
into compressed slices of about SLICE bytes in a bucketed table, and what is learned about a slice travels:

1. Parsing: every window has its least gram; windows of the same anchor are consecutive and make a piece (about 63
   bytes). Equal windows have equal anchors, so an anchor that no other slice has needs no more. Each slice sends the
   leading bits of its anchors' hashes, as many as make chance meetings rare at the corpus's counted size, sorted and
   as differences; it gets back a bit for each.
2. Naming: of anchors with company, each slice sends its distinct pieces as rows of fixed width: 64 bits of the
   anchor's hash, twice 64 of the piece's own, and the least document. It gets back which of them a smaller document has
   elsewhere; their copies in the slice all go. Of the others it learns whether their anchor has other pieces:
   siblings, the edges of repeats, which may still share windows.
3. Indexing: the slice that holds the first document of a sibling sends its bytes, once, to the bucket of the anchor.
   A bucket builds a run-length index over pieces that may serve others, streams those that others may serve through
   it, and where the matching statistic reaches WINDOW, the interval of rows gives the least document that has the
   window. What goes back is a mask of windows.
4. Cutting: each slice removes what its pieces and masks cover.

Skew: a slice sends a piece once however often it occurs there, and as bytes only if it has the first document. An
anchor of more than MOST pieces (the edge of a passage found everywhere, with as many continuations) isn't indexed: its
pieces' windows are sent by two hashes of 64 bits of their own, and settled like pieces in step 2. Steps 2 and 3 are
Spark's shuffles of rows, which spill; of step 1, there are never more blobs than anchors, and a part holds those of
PART_BYTES of text.

Identity: pieces and single windows are told apart by two independent hashes of 64 bits over all their bytes, as in the
hashed parse from which such transforms are built; what the index compares are the bytes.

Defined cases: a null text counts as empty; a null id is larger than any id, and two null ids aren't smaller than each
other; rows that repeat an id are no smaller documents to each other; texts under WINDOW bytes stay whole; an empty
table gives an empty result; of the input only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import WINDOW, anchors, string_hashes, words_at
from .common import remove, saved, scratch, whole
from .rindex import RunLengthIndex

#: Bytes of a slice, of a bucket's pieces, and of the text for each part of the anchors; pieces of an anchor that are indexed.
SLICE, BUCKET, PART_BYTES, MOST = 2 << 20, 2 << 20, 128 << 20, 4096
NO_ID = np.iinfo(np.int64).max
GONE, SIBLING, WIDE = 0, 1, 2


def _zip(data: bytes | np.ndarray) -> bytes:
    return zstandard.compress(data if isinstance(data, bytes) else data.tobytes(), 1)


def _unzip(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _blobs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The strings of ``data`` that begin at ``starts``."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(data[at])])


_PACKED = pa.schema([("slice", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()), ("data", pa.binary()), ("bytes", pa.int64())])


def _pack(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (id, text bytes) into slices. A slice ends with the text that fills it."""
        task, k = TaskContext.get().partitionId(), 0
        ids, texts, filled = [], [], 0

        def slice_() -> pa.RecordBatch:
            return _batch(_PACKED, [(task << 32) | k], [_zip(np.array(ids, np.int64))], [_zip(np.array([len(t) for t in texts], np.int64))], [_zip(b"".join(texts))], [filled])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(NO_ID if i is None else i)
                texts.append(t.as_py())
                filled += len(texts[-1])
                if filled >= size:
                    yield slice_()
                    k, ids, texts, filled = k + 1, [], [], 0
        if ids:
            yield slice_()

    return pack


class _Texts:
    """The texts of a slice, end to end."""

    def __init__(self, ids: bytes, lengths: bytes, data: bytes):
        self.ids, self.lengths = _unzip(ids, np.int64), _unzip(lengths, np.int64)
        self.bytes = zstandard.decompress(data)
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The id of the text that holds each place."""
        return self.ids[np.searchsorted(self.starts, places, "right") - 1]


class _Slice(_Texts):
    """A slice's pieces, in the same order whenever they are made: for each distinct one an occurrence and the least id."""

    def __init__(self, *blobs: bytes):
        super().__init__(*blobs)
        anchor, self.first, self.last = anchors(self.data, self.starts)
        self.id = self.owner(self.first)
        self.words = words_at(self.data)
        hashes, checks = (string_hashes(self.words, self.first, self.last - self.first + WINDOW, lane) for lane in (0, 1))
        self.which, some, self.least = _distinct(hashes, checks, self.id)
        self.route, self.hash, self.check, self.some = anchor[some], hashes[some], checks[some], some


def _distinct(hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the distinct (hash, check), for each of them a place where it stands, and its least id."""
    order = np.argsort(hashes)
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
    first = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return which, order[first], np.minimum.reduceat(ids[order], first) if len(first) else ids


_BLOBS = pa.schema([("part", pa.int32()), ("slice", pa.int64()), ("blob", pa.binary())])


def _keys(route: np.ndarray, bits: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted hashes: the distinct leading ``bits``, the number of each one's, and where each part begins."""
    keys = route >> np.uint64(64 - bits)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    keys = keys[new]
    edges = [((p << bits) + parts - 1) // parts for p in range(1, parts)]  # parts are ranges of keys
    return keys, np.cumsum(new) - 1, np.concatenate(([0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]))


def _planes(keys: np.ndarray) -> bytes:
    """Sorted numbers as differences, their bytes by rank, so that the leading zeros lie together."""
    raw = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()
    return _zip(raw)


def _from_planes(blob: bytes) -> np.ndarray:
    raw = _unzip(blob, np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).reshape(-1), dtype=np.uint64)


def _ask(bits: int, parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = _Texts(row["ids"], row["lengths"], row["data"])
                keys, _, cut = _keys(np.sort(anchors(s.data, s.starts)[0]), bits, parts)
                some = np.flatnonzero(np.diff(cut)).tolist()
                if some:
                    yield _batch(_BLOBS, np.array(some, np.int32), np.full(len(some), row["slice"]), [_planes(keys[cut[p] : cut[p + 1]]) for p in some])

    return ask


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slice's keys of a part a bit, set if another slice has it too."""
    for t in _groups(batches):
        keys = [_from_planes(b.as_py()) for b in t.column(2)]
        sizes = np.array([len(k) for k in keys])
        every = np.concatenate(keys)
        order = np.argsort(every)
        ordered = every[order]
        alike = np.zeros(len(every), bool)
        alike[1:] = ordered[1:] == ordered[:-1]
        alike[:-1] |= alike[1:]
        shared = np.empty(len(every), bool)
        shared[order] = alike
        bits = [np.packbits(x).tobytes() for x in np.split(shared, np.cumsum(sizes)[:-1])]
        yield _batch(_BLOBS, t.column(0).to_numpy(), t.column(1).to_numpy(), bits)


_PIECES = pa.schema([("route", pa.int64()), ("hash", pa.int64()), ("check", pa.int64()), ("least", pa.int64()), ("slice", pa.int64()), ("k", pa.int32())])


def _pieces(bits: int, parts: int):
    def pieces(slices: pa.Table, answers: pa.Table) -> pa.Table:
        """The distinct pieces of a slice whose anchors have company, or that have siblings in the slice itself."""
        (row,) = slices.to_pylist()
        s = _Slice(row["ids"], row["lengths"], row["data"])
        order = np.argsort(s.route)
        route = s.route[order]
        keys, number, cut = _keys(route, bits, parts)
        shared = np.zeros(len(keys), bool)
        for p, blob in zip(answers.column("part").to_pylist(), answers.column("blob"), strict=True):
            shared[cut[p] : cut[p + 1]] = np.unpackbits(np.frombuffer(blob.as_buffer(), np.uint8), count=int(cut[p + 1] - cut[p]))
        company = np.zeros(len(route), bool)
        company[:-1] = route[1:] == route[:-1]
        company[1:] |= company[:-1]
        company |= shared[number]
        company[order] = company.copy()
        some = np.flatnonzero(company)
        return pa.Table.from_batches([_batch(_PIECES, s.route[some].view(np.int64), s.hash[some].view(np.int64), s.check[some].view(np.int64), s.least[some], np.full(len(some), row["slice"]), some.astype(np.int32))])

    return pieces


def _groups(batches: Iterator[pa.RecordBatch], least: int = 0) -> Iterator[pa.Table]:
    """Sorted rows in tables that hold whole groups of their first column, and ``least`` rows or more but for the last."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        begins = int(np.count_nonzero(keys != keys[-1]))  # where its last group does
        if held and not begins and held[-1].column(0)[-1].as_py() != keys[-1]:  # the batch is one group, another than the last
            if rows >= least:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
        elif begins and rows + begins >= least:
            yield pa.Table.from_batches([*held, batch.slice(0, begins)])
            held, rows, batch = [], 0, batch.slice(begins)
        held.append(batch)
        rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _begins(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by route, hash and check: where routes begin, and where pieces do."""
    route, hashes, checks = (t.column(k).to_numpy() for k in range(3))
    new_route = np.ones(len(route), bool)
    new_route[1:] = route[1:] != route[:-1]
    new = new_route.copy()
    new[1:] |= (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
    return new_route, new


_TOLD = pa.schema([("slice", pa.int64()), ("k", pa.int32()), ("what", pa.int32())])


def _name(most: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows by route, hash, check and least id: what a slice must know of its pieces."""
        for t in _groups(batches):
            route, least = t.column(0).to_numpy(), t.column(3).to_numpy()
            new_route, new = _begins(t)
            low = least[np.flatnonzero(new)[np.cumsum(new) - 1]]
            kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_route))[np.cumsum(new_route) - 1]
            what = np.where(low < least, GONE, np.where(kinds > most, WIDE, SIBLING)).astype(np.int32)
            some = np.flatnonzero((low < least) | (kinds > 1))
            if len(some):
                yield _batch(_TOLD, t.column(4).to_numpy()[some], t.column(5).to_numpy()[some], what[some])

    return name


_STATE, _EDGE, _WINDOW = 0, 1, 2
_SENT = pa.schema([("kind", pa.int32()), ("route", pa.int64()), ("hash", pa.int64()), ("check", pa.int64()), ("least", pa.int64()), ("slice", pa.int64()), ("k", pa.int32()), ("piece", pa.binary())])


def _send(slices: pa.Table, told: pa.Table) -> pa.Table:
    """What is sure of a slice and what is open, the bytes of its siblings, and the windows of its wide pieces."""
    (row,) = slices.to_pylist()
    s = _Slice(row["ids"], row["lengths"], row["data"])
    what = np.full(len(s.least), -1)
    what[told.column("k").to_numpy()] = told.column("what").to_numpy()
    sure = (what[s.which] == GONE) | (s.least[s.which] < s.id)
    open_ = np.flatnonzero(~sure & (what[s.which] == SIBLING))
    wide = np.flatnonzero(~sure & (what[s.which] == WIDE))
    siblings = np.flatnonzero(what == SIBLING)
    at = s.some[siblings]
    size = s.last[at] - s.first[at] + WINDOW
    # windows of wide pieces, each by itself: numbered after the pieces
    each = s.last[wide] - s.first[wide] + 1
    place = np.repeat(s.first[wide] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
    fifty = np.full(len(place), WINDOW)
    lanes = [string_hashes(s.words, place, fifty, lane) for lane in (0, 1)]
    owner = np.repeat(s.id[wide], each)
    which, some, least = _distinct(*lanes, owner)
    surely = least[which] < owner  # a smaller document of this very slice
    begin = np.sort(np.concatenate((s.first[sure], place[surely])))
    end = np.sort(np.concatenate((s.last[sure], place[surely]))) + WINDOW
    apart = np.ones(len(begin) + 1, bool)  # ranges that touch become one
    apart[1:-1] = begin[1:] > end[:-1]
    state = [begin[apart[:-1]], end[apart[1:]]]
    state += [np.concatenate((s.first[open_], place[~surely])), np.concatenate((s.which[open_], len(s.least) + which[~surely]))]
    blob = b"".join(np.array([len(x)], np.int64).tobytes() + x.astype(np.int64).tobytes() for x in state)
    n, none = row["slice"], lambda m: pa.nulls(m, pa.int64())
    out = [_batch(_SENT, [_STATE], none(1), none(1), none(1), none(1), [n], [-1], [_zip(blob)])]
    m = len(siblings)
    out.append(_batch(_SENT, np.full(m, _EDGE, np.int32), s.route[siblings].view(np.int64), s.hash[siblings].view(np.int64), s.check[siblings].view(np.int64), s.least[siblings], np.full(m, n), siblings.astype(np.int32), _blobs(s.data, s.first[at], size)))
    m = len(some)
    out.append(_batch(_SENT, np.full(m, _WINDOW, np.int32), lanes[0][some].view(np.int64), lanes[1][some].view(np.int64), np.zeros(m, np.int64), least, np.full(m, n), (len(s.least) + np.arange(m)).astype(np.int32), pa.nulls(m, pa.binary())))
    return pa.Table.from_batches(out)


_FOUND = pa.schema([("slice", pa.int64()), ("k", pa.int32()), ("mask", pa.int64())])


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From siblings by route, hash, check and least id: masks of the windows that a smaller document has."""
    for t in _groups(batches, BUCKET // WINDOW):
        least = t.column(3).to_numpy()
        pieces = t.column(6).combine_chunks()
        pieces = pieces.chunk(0) if isinstance(pieces, pa.ChunkedArray) else pieces
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        data = np.frombuffer(pieces.buffers()[2], np.uint8)
        new_route, new = _begins(t)
        group, at = np.cumsum(new_route) - 1, np.flatnonzero(new_route)
        low, high = np.minimum.reduceat(least, at)[group], np.maximum.reduceat(least, at)[group]
        piece = np.cumsum(new) - 1  # rows that repeat an id may send one piece twice
        single = np.flatnonzero(new)
        serves, asks = single[(least < high)[single]], single[(least > low)[single]]
        if not len(asks):
            continue
        strings = [(_strings(data, offsets, own), offsets[own + 1] - offsets[own]) for own in (serves, asks)]
        index = RunLengthIndex(*strings[0], least[serves], WINDOW)
        found = index.least_of_matches(*strings[1], least[asks])
        windows = strings[1][1] - WINDOW + 1
        first = np.cumsum(windows) - windows
        bit = np.arange(len(found)) - np.repeat(first, windows)
        smaller = found < np.repeat(least[asks], windows)
        mask = np.zeros(int(piece[-1]) + 1, np.int64)
        mask[piece[asks]] = np.add.reduceat(np.where(smaller, np.int64(1) << bit, np.int64(0)), first)
        some = np.flatnonzero(mask[piece])
        if len(some):
            yield _batch(_FOUND, t.column(4).to_numpy()[some], t.column(5).to_numpy()[some], mask[piece[some]])


def _strings(data: np.ndarray, offsets: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The strings ``own`` of ``data``, end to end."""
    lengths = offsets[own + 1] - offsets[own]
    return data[np.repeat(offsets[own] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))]


_CUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))])


def _covered(s: _Texts, state: bytes, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which bytes of a slice go."""
    raw, parts, at = _unzip(state, np.int64), [], 0
    for _ in range(4):
        parts.append(raw[at + 1 : at + 1 + raw[at]])
        at += 1 + int(raw[at])
    begin, end, first, number = parts
    marks = np.zeros(len(s.data) + 1, np.int32)
    np.add.at(marks, begin, 1)
    np.add.at(marks, end, -1)
    order = np.argsort(found[0])
    k, masks = found[0][order], found[1][order]
    if len(k):
        near = np.minimum(np.searchsorted(k, number), len(k) - 1)
        hit = np.flatnonzero(k[near] == number)
        mask = masks[near[hit]]
        for bit in range(int(mask.max()).bit_length() if len(mask) else 0):
            window = first[hit[(mask >> bit) & 1 == 1]] + bit
            np.add.at(marks, window, 1)
            np.add.at(marks, window + WINDOW, -1)
    return np.cumsum(marks[:-1]) > 0


def _cut(slices: pa.Table, told: pa.Table) -> pa.Table:
    (row,) = slices.to_pylist()
    s = _Texts(row["ids"], row["lengths"], row["data"])
    k, state = told.column("k").to_numpy(), told.column("piece")
    (own,) = np.flatnonzero(k == -1).tolist()
    others = np.flatnonzero(k >= 0)
    gone = _covered(s, state[own].as_py(), (k[others], told.column("mask").to_numpy()[others].astype(np.int64)))
    n, ends = len(s.data), s.starts + s.lengths
    before = np.concatenate(([0], np.cumsum(gone)))
    n_gone = before[ends] - before[s.starts]
    edge = np.zeros(n + 1, bool)  # where a text begins
    edge[s.starts] = True
    edge[n] = True
    last, next_ = np.concatenate(([False], gone[:-1])), np.concatenate((gone[1:], [False]))
    begin, end = np.flatnonzero(gone & (~last | edge[:-1])), np.flatnonzero(gone & (~next_ | edge[1:])) + 1
    text = np.searchsorted(s.starts, begin, "right") - 1
    spans = np.bincount(text, minlength=len(s.ids)).astype(np.int64)
    flat = np.stack((begin - s.starts[text], end - s.starts[text]), 1).reshape(-1)
    pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, 2), pa.int32()), pa.array(flat, pa.int64()))
    spans_ = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(spans))), pa.int32()), pairs)
    left = memoryview(s.data[~gone].tobytes())
    to = np.cumsum(s.lengths - n_gone).tolist()
    sums = [hashlib.sha256(left[a:b]).hexdigest() for a, b in zip([0, *to], to, strict=False)]
    ids = pa.array(s.ids, pa.int64(), mask=s.ids == NO_ID)
    return pa.Table.from_batches([_batch(_CUT, ids, s.lengths, n_gone, spans, sums, spans_)])


def _met(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt by the first column, sorted by all."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), by[0]).sortWithinPartitions(*by)


def _bucketed(rows: DataFrame, root: str, name: str) -> DataFrame:
    """The slices as a table bucketed by slice, so that they are shuffled in no join."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.format("parquet").bucketBy(n, "slice").option("compression", "none").option("path", f"{root}/slices").saveAsTable(name)
    return spark.table(name)


def repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", most: int = MOST, slice_bytes: int = SLICE) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed spans [first, end) in bytes."""
    spark = docs.sparkSession
    root = scratch(spark, "repeats")
    table = "slices_" + root.rsplit("-", 1)[1]
    rows = docs.select(docs[key].cast("long").alias("id"), F.encode(whole(docs[text]), "UTF-8").alias("text"))
    pieces, blobs = "route long, hash long, check long, least long, slice long, k int", "part int, slice long, blob binary"
    sent_shape, found_shape = f"kind int, {pieces}, piece binary", "slice long, k int, mask long"
    try:
        slices = _bucketed(rows.mapInArrow(_pack(slice_bytes), "slice long, ids binary, lengths binary, data binary, bytes long"), root, table)
        size = slices.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        slices = slices.drop("bytes")
        parts, bits = max(16, size // PART_BYTES), min(64, max(16, (size // 8).bit_length() + 8))

        def named(rows: DataFrame) -> DataFrame:
            return _met(rows, "route", "hash", "check", "least").mapInArrow(_name(most), "slice long, k int, what int")

        answers = _met(slices.mapInArrow(_ask(bits, parts), blobs), "part").mapInArrow(_answer, blobs)
        told = named(slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_pieces(bits, parts), pieces))
        sent = slices.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(_send, sent_shape)
        sent.write.partitionBy("kind").parquet(f"{root}/sent")
        sent = spark.read.schema(sent_shape).parquet(f"{root}/sent")
        state = sent.filter(F.col("kind") == _STATE).select("slice", "k", F.lit(0).cast("long").alias("mask"), "piece")
        edges = sent.filter(F.col("kind") == _EDGE).select("route", "hash", "check", "least", "slice", "k", "piece")
        windows = sent.filter(F.col("kind") == _WINDOW).select("route", "hash", "check", "least", "slice", "k")
        masks = _met(edges, "route", "hash", "check", "least").mapInArrow(_index, found_shape)
        masks = masks.unionByName(named(windows).filter(F.col("what") == GONE).select("slice", "k", F.lit(1).cast("long").alias("mask")))
        told = state.unionByName(masks.withColumn("piece", F.lit(None).cast("binary")))
        shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
        return saved(slices.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(_cut, shape))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, root)
