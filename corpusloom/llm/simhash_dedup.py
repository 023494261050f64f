"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's 64 bits are 32 segments of two; the bit counts of its segments are a point whose Manhattan distances
never exceed Hamming distances. In unary code (0, 1, 2 as 00, 01, 11) that distance is again a number of differing
bits. The 32 coordinates form blocks. Two points at a distance of four or less differ in at most four blocks, so they
share a cell of the grid over the others: each fingerprint goes to its cell in each grid, one for every choice of four
blocks left out. How many blocks there are, and so how wide a cell is, follows from the counted fingerprints: more of
them make narrower cells, so that the pairs that meet by chance stay in proportion to the rows (``blocks_for``).

Within a cell fingerprints are sorted by the sum of their coordinates, and each is compared with those that follow
while the sums differ by no more than four: a range join on the sum, which bounds the Manhattan distance, which bounds
the exact distance that is compared last.

Only distinct fingerprints are compared: exact copies, however many, are one row before any cell is made. Within a
cell the verified pairs are reduced to a spanning forest. Cells with more than MOST_IN_CELL fingerprints give no
pairs; their fingerprints go the other exact way: two lie within four bits if and only if some word lies within two
bits of both, so each is sent to the 2,081 words within two bits of it, and all that meet at a word are linked to the
least of them, which is linear in their number.

Defined cases: a null text counts as empty, empty texts have the fingerprint zero, which is linked like any other;
null ids never name a component unless no member has an id; repeated rows are rows, of which :func:`keep_first` keeps
one; an empty table gives an empty result; of the input only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import AT, FILE, at_places, located, saved, through, whole
from .components import components
from .fingerprint import simhash

DISTANCE, MOST_IN_CELL = 4, 4096
SEGMENTS, BLOCKS = 32, range(6, 17)
#: That two random segments have the same count; what a row of a cell costs, in pairs compared.
ALIKE, ROW_COST = 3 / 8, 60
LOW = 0x5555555555555555


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", *own: str) -> DataFrame:
    """(doc_id, own columns, fp) for each row, fp as a signed long."""

    def work():
        return lambda texts: [pa.array(np.frombuffer(b"".join([simhash(t) for t in texts]), ">i8").astype(np.int64))]

    return through(docs, [docs[key].alias("doc_id"), *own], whole(docs[text]), work, StructType([StructField("fp", LongType())]))


def embedding(fp: Column) -> Column:
    """The bit counts of the 32 segments in unary code, packed into a long."""
    high = F.shiftrightunsigned(fp, 1)
    both, any_ = high.bitwiseAND(fp).bitwiseAND(F.lit(LOW)), high.bitwiseOR(fp).bitwiseAND(F.lit(LOW))
    return F.shiftleft(both, 1).bitwiseOR(any_)


def _embedded(fp: np.ndarray) -> np.ndarray:
    x, low = fp.view(np.uint64), np.uint64(LOW)
    high = x >> np.uint64(1)
    return ((high & x & low) << np.uint64(1)) | ((high | x) & low)


def blocks_for(n: int, distance: int = DISTANCE) -> int:
    """The number of blocks at which ``n`` fingerprints cost least: rows of cells, and pairs that meet in them by chance."""

    def cost(blocks: int) -> float:
        agree = SEGMENTS * (blocks - distance) / blocks
        return comb(blocks, distance) * n * (ROW_COST + n * ALIKE**agree / 2)

    return min((b for b in BLOCKS if b > distance), key=cost)


def grids(distance: int = DISTANCE, blocks: int = 8) -> list[int]:
    """A mask for each choice of the blocks that must agree; blocks are runs of whole segments."""
    cut = [SEGMENTS * k // blocks * 2 for k in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cut, cut[1:], strict=False)]
    return [_signed(sum(c)) for c in combinations(masks, blocks - distance)]


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs: (node, least node of its tree)."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in list(up) if root(x) != x]


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (cell, fp), cut so that no run of a cell is split unless it is longer than ``most``."""
    cells, fps = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        cells = np.concatenate((cells, batch.column(0).to_numpy()))
        fps = np.concatenate((fps, batch.column(1).to_numpy()))
        if not len(cells):
            continue
        other = np.flatnonzero(cells != cells[-1])
        last = int(other[-1]) + 1 if len(other) else len(cells) if len(cells) > most else 0
        if last:
            yield cells[:last], fps[:last]
            cells, fps = cells[last:], fps[last:]
    if len(cells):
        yield cells, fps


def _links(distance: int, most: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = None  # a crowded cell of which more may follow
        for cells, fps in _runs(batches, most):
            cut = np.flatnonzero(np.diff(cells)) + 1
            sizes = np.diff(np.concatenate(([0], cut, [len(cells)])))
            size = np.repeat(sizes, sizes)
            large = size > most
            if full is not None:
                large |= cells == full
            if large[-1]:
                full = cells[-1]
            pairs = []
            points, total = _embedded(fps), np.bitwise_count(fps.view(np.uint64))
            at = np.flatnonzero((size > 1) & ~large)
            for step in range(1, min(int(sizes.max()), most)):
                at = at[at + step < len(cells)]
                at = at[(cells[at] == cells[at + step]) & (total[at + step] - total[at] <= distance)]  # the rest of a cell lies further off
                if not len(at):
                    break
                near = at[np.bitwise_count(points[at] ^ points[at + step]) <= distance]
                near = near[np.bitwise_count((fps[near] ^ fps[near + step]).view(np.uint64)) <= distance]
                if len(near):
                    pairs.append(np.stack((fps[near], fps[near + step]), 1))
            found = forest(np.concatenate(pairs).tolist()) if pairs else []
            crowded = np.unique(fps[large]).tolist()
            if found or crowded:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found] + crowded, pa.int64()), pa.array([b for _, b in found] + [None] * len(crowded), pa.int64())], ["a", "b"])

    return links


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words, fps in _runs(batches, MOST_IN_CELL):
        first = np.concatenate(([0], np.flatnonzero(np.diff(words)) + 1))
        least = np.repeat(np.minimum.reduceat(fps, first), np.diff(np.concatenate((first, [len(words)]))))
        keep = fps != least
        found = np.unique(np.stack((fps[keep], least[keep]), 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _met(rows: DataFrame, by: str, *order) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, by).sortWithinPartitions(by, *order)


def links(fps: DataFrame, distance: int = DISTANCE, most: int = MOST_IN_CELL, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps.fp`` that connect whatever lies within ``distance`` bits."""
    masks = F.array(*[F.lit(m) for m in grids(distance, blocks or blocks_for(fps.count(), distance))])
    cells = fps.select("fp", embedding(F.col("fp")).alias("p"), F.explode(masks).alias("mask")).select(F.xxhash64("mask", F.col("p").bitwiseAND(F.col("mask"))).alias("cell"), "fp")
    found = saved(_met(cells, "cell", F.bit_count("fp")).mapInArrow(_links(distance, most), "a long, b long").distinct())
    crowded = found.filter("b is null").select(F.col("a").alias("fp"))
    pairs = found.filter("b is not null")
    if crowded.isEmpty():
        return pairs
    near = [0] + [_signed(sum(1 << k for k in c)) for r in range(1, distance // 2 + 1) for c in combinations(range(64), r)]
    words = crowded.select("fp", F.explode(F.array(*[F.lit(x) for x in near])).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("word"), "fp")
    return pairs.unionByName(_met(words, "word").mapInArrow(_stars, "a long, b long"))


def _grouped(rows: DataFrame, distance: int) -> DataFrame:
    """Rows (doc_id, fp and others) with root, which tells their class, and least, the smallest id of their fingerprint."""
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = saved(components(links(distinct, distance)))
    named = saved(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    return rows.join(named, "fp")


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest id of its class)."""
    rows = _grouped(saved(fingerprints(docs, text, key)), distance)
    ids = saved(rows.groupBy("root").agg(F.min("least").alias("component_id")))
    return rows.join(ids, "root").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each class, columns as they were: that of the smallest id, null ids last, then the first place.

    Rows are told by their places, so that those which share an id are judged each by its own text.
    """
    content = located(docs)
    rows = _grouped(saved(fingerprints(content, text, key, FILE, AT)), distance)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", FILE, AT)
    best = rows.groupBy("root").agg(F.min(first).alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    gone = saved(rows.join(best, "root").filter(F.struct(FILE, AT) != F.struct(f"best.{FILE}", f"best.{AT}")).select(FILE, AT))
    return at_places(content, gone, gone.count(), inside=False).drop(FILE, AT)
