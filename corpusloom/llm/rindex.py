"""A run-length index: the run-compressed Burrows-Wheeler transform of short strings, sampled at run ends."""

from __future__ import annotations

import numpy as np


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    new = np.empty(len(keys), np.uint64)
    new[:1] = 0
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(new, dtype=np.uint64)
    return out


def _later(rank: np.ndarray, reach: int) -> np.ndarray:
    return np.concatenate((rank[reach:], np.zeros(min(reach, len(rank)), np.uint64)))[: len(rank)]


class RunLengthIndex:
    """Strings end to end in ``data`` with their ``lengths``, each closed by a mark that sorts before every byte.

    Kept are the text, and for each run of the transform its first row, its byte, how often the byte occurs before, and
    the places of its first and last row. Beside them stand the rows at which an interval of rows that share ``depth``
    bytes begins, and for each interval the least ``value`` of its strings. Suffix order and ranks are needed to build it
    only.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray, values: np.ndarray, depth: int):
        m = len(lengths)
        ends = np.cumsum(lengths + 1)
        n = int(ends[-1]) if m else 0
        marks = ends - 1
        letters = np.unique(data)
        self.code = np.full(256, len(letters) + 1, np.int64)  # what the index lacks is above all it has
        self.code[letters] = np.arange(1, len(letters) + 1)
        self.text = np.zeros(n + 8, np.uint8 if len(letters) < 255 else np.uint16)
        inner = np.ones(n, bool)
        inner[marks] = False
        self.text[:n][inner] = self.code[data]
        text = self.text[:n]
        order, shares = self._sorted(text, np.repeat(marks, lengths + 1) - np.arange(n), int(len(letters)).bit_length(), int(lengths.max()) + 1 if m else 0, depth)
        before = text[order - 1].astype(np.int64)
        head = np.zeros(n, bool)
        head[ends[:-1]] = True
        head[:1] = True
        before[head[order]] = 0  # what stands before a string is a mark
        change = np.ones(n, bool)
        change[1:] = before[1:] != before[:-1]
        self.rows, self.depth = n, depth
        self.run_row = np.flatnonzero(change)
        self.run_byte = before[self.run_row]
        self.run_end = np.concatenate((self.run_row[1:], [n])) - 1
        self.sample_first, self.sample_last = order[self.run_row], order[self.run_end]
        by = np.argsort(self.run_byte, kind="stable")
        size = (self.run_end - self.run_row + 1)[by]
        #: Of a run's first row, the row that its byte's extension leads to: counts over smaller bytes and earlier runs.
        self.run_to = np.empty(len(by), np.int64)
        self.run_to[by] = np.cumsum(size) - size
        #: Runs by byte, to find the nearest one with a byte above or below a row.
        self.by_byte, self.byte_key = by, self.run_byte[by] * (len(by) + 1) + by
        string = np.searchsorted(marks, order)
        fits = marks[string] - order >= depth
        new = np.ones(n, bool)
        new[1:] = ~shares[1:] | ~fits[1:] | ~fits[:-1]
        self.interval = np.flatnonzero(new)
        self.least = np.minimum.reduceat(values[string], self.interval) if n else values[:0]

    @staticmethod
    def _sorted(text: np.ndarray, to_mark: np.ndarray, bits: int, longest: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array, equal suffixes in the order of their strings; and whether a row shares ``depth`` codes with the one before."""
        n = len(text)
        reach = 63 // bits if bits else 1
        padded = np.concatenate((text, np.zeros(reach, text.dtype))).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for k in range(reach):
            key = (key << np.uint64(bits)) | np.where(to_mark >= k, padded[k : k + n], np.uint64(0))
        rank = _ranks(key)
        prefix = key >> np.uint64(bits * (reach - depth)) if depth < reach else None
        while reach < longest:
            if reach <= depth < 2 * reach:
                prefix = rank if reach == depth else (rank << np.uint64(32)) | _later(rank, depth - reach)
            rank = _ranks((rank << np.uint64(32)) | np.where(to_mark >= reach, _later(rank, reach) + np.uint64(1), np.uint64(0)))
            reach *= 2
        if prefix is None:
            prefix = rank  # then equal ranks are equal strings
        order = np.argsort((rank << np.uint64(32)) | np.arange(n, dtype=np.uint64))
        shares = np.zeros(n, bool)
        shares[1:] = prefix[order[1:]] == prefix[order[:-1]]
        return order, shares

    @property
    def runs(self) -> int:
        return len(self.run_row)

    def run_of(self, rows: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.run_row, rows, "right") - 1

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many codes the text shares at two places, up to ``most``."""
        out, going = np.zeros(len(a), np.int64), np.flatnonzero(most > 0)
        while len(going):
            k = out[going]
            same = self.text[a[going] + k] == self.text[b[going] + k]
            going = going[same]
            out[going] += 1
            going = going[out[going] < most[going]]
        return out

    def matching_statistics(self, data: np.ndarray, lengths: np.ndarray):
        """Streams patterns that lie end to end through the index, from right to left and side by side.

        Yields for each step the patterns that go on, the place in each, and the state there: a row of the index, and how
        many bytes of the pattern from there on it shares, which is the most that any row does. Where a row's run has
        another byte than the pattern, the nearest runs with that byte go on, from the samples at their ends.
        """
        codes = self.code[data]
        end = np.cumsum(lengths)
        which = np.arange(len(lengths))
        row, length = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        place = np.full(len(lengths), self.sample_first[0] if self.rows else 0)
        for step in range(1, int(lengths.max()) + 1 if len(lengths) else 0):
            alive = lengths[which] >= step
            if not alive.all():
                which, row, place, length = which[alive], row[alive], place[alive], length[alive]
            c = codes[end[which] - step]
            run = self.run_of(row)
            other = np.flatnonzero(self.run_byte[run] != c)
            if len(other):
                near = np.searchsorted(self.byte_key, c[other] * (len(self.by_byte) + 1) + run[other])
                up = self.by_byte[np.maximum(near - 1, 0)]
                down = self.by_byte[np.minimum(near, len(self.by_byte) - 1)]
                has_up, has_down = (near > 0) & (self.run_byte[up] == c[other]), self.run_byte[down] == c[other]
                common = [np.where(has, self._common(place[other], at, np.where(has, length[other], 0)), -1) for has, at in ((has_up, self.sample_last[up]), (has_down, self.sample_first[down]))]
                take_up = common[0] >= common[1]
                best = np.where(take_up, common[0], common[1])
                run[other] = np.where(take_up, up, down)
                row[other] = np.where(take_up, self.run_end[up], self.run_row[down])
                place[other] = np.where(take_up, self.sample_last[up], self.sample_first[down])
                length[other] = best
            row = self.run_to[run] + row - self.run_row[run]
            place, length = place - 1, length + 1
            if len(other):
                none = other[best < 0]  # no row has the byte: start anew
                row[none], place[none], length[none] = 0, self.sample_first[0], 0
            yield which, lengths[which] - step, row, place, length

    def least_of_matches(self, data: np.ndarray, lengths: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        """For each place of each pattern in turn at which ``depth`` bytes begin: the least value of the strings that have them.

        It is read where the matching statistic reaches the depth, from the interval of the row; elsewhere it is the
        pattern's value of ``otherwise``.
        """
        places = np.maximum(0, lengths - self.depth + 1)
        first = np.cumsum(places) - places
        out = np.repeat(otherwise, places)
        if not self.rows:
            return out
        for which, at, row, _, length in self.matching_statistics(data, lengths):
            long = np.flatnonzero(length >= self.depth)
            out[first[which[long]] + at[long]] = self.least[np.searchsorted(self.interval, row[long], "right") - 1]
        return out
