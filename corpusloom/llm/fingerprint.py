"""SimHash fingerprints of word shingles."""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_digest

SHINGLE, SEED = 4, 42


def simhash(text: str, shingle: int = SHINGLE, seed: int = SEED) -> bytes:
    """Eight bytes, most significant first: a bit is set if it is set in over half of the shingles' XXH64.

    A-Z is lower-cased, words are what lies between white space (bytes.split knows exactly that), repeats count, a
    text of fewer words is one shingle, and one of no words has the fingerprint zero.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return bytes(8)
    data = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_digest(data, seed)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps[shingle - 1 :].tolist(), len(data)]
    totals, n = np.zeros(64, np.int64), len(ends)
    for at in range(0, n, 65_280):
        block = b"".join([xxh64_digest(data[a:b], seed) for a, b in zip(starts[at : at + 65_280], ends[at : at + 65_280], strict=False)])
        lanes = np.unpackbits(np.frombuffer(block, np.uint8)).view(np.uint64).reshape(-1, 8)  # eight one-byte counters a lane
        for k in range(0, len(lanes), 255):
            totals += lanes[k : k + 255].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return np.packbits(2 * totals > n).tobytes()
