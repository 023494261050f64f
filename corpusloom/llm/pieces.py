"""SentencePiece encoding and decoding with offsets.

Text is normalised by longest prefixes of the model's compiled character map, and for each normalised byte the source
byte it came from is kept. The sentencepiece library gives the ids; their pieces tile the normalised text, so running
sums of piece lengths, looked up in the alignment, project every piece to a span of original bytes. With byte fallback
an id tells its piece's length; without it, an unknown piece has that of its surface, which the library gives too. A
model without a character map, as the query's, has the identity as its alignment.

The model is named or given by a path that workers have, and opened there.

Each row is encoded by itself in Arrow batches: no shuffle, and memory bounded by a batch. Defined cases: a null text
counts as empty and has the end id only; ids may be null and rows repeated; very long texts are not cut; other columns
pass through unless their names are those of the results; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import beside, through, whole

MARK = "▁"


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class CharacterMap:
    """A compiled character map: a double-array trie of source byte strings and the zero-ended strings they become."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest source string at ``at``, and what it becomes."""
        units = self.units
        if not units:
            return None

        def offset(u: int) -> int:
            return (u >> 10) << ((u & (1 << 9)) >> 6)

        found, node = None, offset(units[0])
        for n in range(at, len(data)):
            c = data[n]
            node ^= c
            if node >= len(units):
                break
            u = units[node]
            if u & (1 << 31 | 0xFF) != c:
                break
            node ^= offset(u)
            if (u >> 8) & 1:
                value = units[node] & 0x7FFFFFFF
                found = (n + 1 - at, self.strings[value : self.strings.index(b"\0", value)])
        return found


class Normaliser:
    """Longest-prefix normalisation with source alignment, under the switches of the model's normaliser."""

    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    @property
    def identity(self) -> bool:
        return not self.map.units and not self.trim and self.escape

    def source(self, text: str) -> np.ndarray:
        """The alignment alone; without rewriting it takes a few array operations."""
        if not self.identity:
            return np.array(self(text)[1], np.int64)
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        if not len(data):
            return np.zeros(1, np.int64)
        wide = len(MARK.encode())
        each = np.repeat(np.arange(len(data)), np.where(data == 32, wide, 1))
        return np.concatenate((np.zeros(wide * self.prefix, np.int64), each, [len(data)]))

    def __call__(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised UTF-8 and, for each of its bytes and its end, the source byte that it stands for."""
        data = text.encode("utf-8", "replace")
        space = MARK.encode() if self.escape else b" "
        parts: list[tuple[bytes, int, int]] = []
        at = 0
        while at < len(data):
            if hit := self.map.longest(data, at):
                n, put = hit
            else:
                n = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
                put = data[at : at + n]
            parts.append((put, at, at + n))
            at += n
        if self.trim:
            while parts and not parts[0][0].strip(b" "):
                parts.pop(0)
            while parts and not parts[-1][0].strip(b" "):
                parts.pop()
        out, source = bytearray(), []
        if self.prefix and parts:
            out += space
            source += [parts[0][1]] * len(space)
        in_space = self.trim
        end = parts[-1][2] if parts else len(data)
        for put, first, _ in parts:
            if self.trim and in_space:
                put = put.lstrip(b" ")
            for k in range(len(put)):
                b = put[k : k + 1]
                if b == b" ":
                    if not (self.trim and in_space):
                        out += space
                        source += [first] * len(space)
                    in_space = True
                else:
                    out += b
                    source.append(first + k if put == data[first : first + len(put)] else first)
                    in_space = False
        if self.trim:
            while out.endswith(space) and len(out) >= len(space):
                del out[-len(space) :]
                end = source[-len(space)]
                del source[-len(space) :]
        return bytes(out), [*source, end]


class Encoder:
    """Ids, spans and texts of a model, end id included."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.eos = self.sp.eos_id()
        self.normaliser = Normaliser(proto.normalizer_spec)
        byte = pb.ModelProto.SentencePiece.BYTE
        #: Normalised bytes that each id stands for; the end id stands for none.
        self.lengths = np.array([1 if p.type == byte else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.lengths[self.eos] = 0
        self.fallback = proto.trainer_spec.byte_fallback

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [[*x, self.eos] for x in self.sp.encode(texts, num_threads=1)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.sp.decode(ids, num_threads=1)

    def bounds(self, text: str, ids: list[int]) -> np.ndarray:
        """Original bytes at which the pieces begin, and the end: piece k is ``bounds[k]:bounds[k + 1]``."""
        source = self.normaliser.source(text)
        if self.fallback:
            lengths = self.lengths[ids]
        else:
            lengths = np.array([*(len(p.piece.encode()) for p in self.sp.encode(text, return_type="proto").pieces), 0], np.int64)
        ends = np.cumsum(lengths)
        if ends[-1] != len(source) - 1:
            raise ValueError("pieces don't tile the normalised text")
        return np.concatenate(([source[0]], source[ends]))


def encode(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, ``bounds`` (original byte at which each id's span begins, then the end) and ``decoded``."""

    def work():
        coder = Encoder(model or model_file())

        def job(texts: list[str]) -> list[pa.Array]:
            ids = coder.ids(texts)
            bounds = [coder.bounds(t, x) for t, x in zip(texts, ids, strict=True)]
            return [_lists([np.array(x, np.int32) for x in ids]), _lists(bounds), pa.array(coder.decode(ids), pa.string())]

        return job

    results = StructType([StructField("ids", ArrayType(IntegerType())), StructField("bounds", ArrayType(LongType())), StructField("decoded", StringType())])
    return through(docs, beside(docs, "ids", "bounds", "decoded"), whole(docs[text]), work, results)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts)))


def digest(docs: DataFrame, text: str = "text", key: str = "doc_id", model: str | None = None) -> DataFrame:
    """What the contract asks of :func:`encode`'s output, and the bytes that the spans cover."""
    coded = encode(docs.select(docs[key].alias("doc_id"), docs[text].alias("ids")), "ids", model)  # the text gives way to its ids
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.element_at("bounds", -1) - F.element_at("bounds", 1)).alias("covered_bytes"),
        F.sha2(F.array_join("bounds", " "), 256).alias("bounds_sha256"),
    )
