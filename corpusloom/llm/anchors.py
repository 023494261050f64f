"""Content-defined anchors of byte strings: the minimizers of all windows of a given length, and hashes of strings."""

from __future__ import annotations

import numpy as np

WINDOW, GRAM = 50, 24
#: Windows taken at once, so that all intermediate arrays stay in a core's cache.
BLOCK = 1 << 15
_A, _B, _C, _D = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.empty(len(data), np.uint64)
    for k in range(8):
        part = padded[k : k + (len(data) - k) // 8 * 8].view("<u8") if len(data) - k >= 8 else padded[:0].view("<u8")
        words[k : k + 8 * len(part) : 8][: len(part)] = part
    for k in range(max(0, len(data) - 7), len(data)):
        words[k] = int.from_bytes(padded[k : k + 8].tobytes(), "little")
    return words


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each place; ``gram`` is a multiple of eight."""
    n = len(data) - gram + 1
    words = words_at(data)
    h = np.zeros(n, np.uint64)
    for k in range(0, gram, 8):
        h = (h ^ words[k : k + n]) * _A
        h ^= h >> np.uint64(29)
        h *= _B
        h ^= h >> np.uint64(32)
    return h * _C


def string_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hashes of strings of eight bytes or more, given ``words_at`` their data; lanes are independent of each other."""
    a, b = ((_A, _B), (_C, _D))[lane]
    h = (lengths.astype(np.uint64) + np.uint64(lane + 1)) * b

    def mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
        h = (h ^ w) * a
        h ^= h >> np.uint64(31)
        h *= b
        return h ^ (h >> np.uint64(29))

    least, most = (int(lengths.min()), int(lengths.max())) if len(lengths) else (0, 0)
    for k in range(0, most - 7, 8):
        if k + 8 <= least:
            h = mixed(h, words[starts + k])
        else:
            own = np.flatnonzero(lengths >= k + 8)
            h[own] = mixed(h[own], words[starts[own] + k])
    return mixed(h, words[starts + lengths - 8])


def anchors(data: np.ndarray, starts: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts that lie end to end in ``data`` and begin at ``starts``.

    Returns each anchor's hash, and the first and last place of the windows of which it is the least gram (the leftmost
    of equal ones). All windows are covered once, and an anchor's windows are consecutive.
    """
    n = len(data) - window + 1
    if n <= 0:
        e = np.empty(0, np.int64)
        return e.astype(np.uint64), e, e
    ends = np.concatenate((starts[1:], [len(data)]))
    inside = np.ones(n + 1, bool)  # windows that lie within one text
    cut = ends[:, None] - np.arange(1, window)
    cut = cut[(cut >= starts[:, None]) & (cut <= n)]
    inside[cut] = False
    inside[n] = False
    grams, number = window - gram + 1, np.arange(BLOCK + window, dtype=np.uint64)
    hashes, firsts, before = [], [], -1  # before: the anchor of the window before, if that is inside
    for at in range(0, n, BLOCK):
        m = min(BLOCK, n - at)
        h = gram_hashes(data[at : at + m + window - 1], gram)
        wide, step = (h & _HIGH) | number[: len(h)], 1  # running minimum over so many grams, by doubling
        while 2 * step <= grams:
            wide = np.minimum(wide[:-step], wide[step:])
            step *= 2
        if step < grams:
            rest = grams - step
            wide = np.minimum(wide[: len(wide) - rest], wide[rest:])
        place = (wide & ~_HIGH).astype(np.int64)
        own = inside[at : at + m]
        change = own.copy()
        change[1:] &= (place[1:] != place[:-1]) | ~own[:-1]
        change[0] &= place[0] + at != before
        first = np.flatnonzero(change)
        hashes.append(h[place[first]])
        firsts.append(first + at)
        before = int(place[-1]) + at if own[-1] else -1
    first = np.concatenate(firsts)
    last = np.concatenate((first[1:], [n])) - 1  # up to the next anchor, or to the text's last window
    if len(first):
        text = np.searchsorted(starts, first, "right") - 1
        last = np.minimum(last, ends[text] - window)
    else:
        last = first
    h = np.concatenate(hashes)  # the least of many are small: spread them over all numbers again
    h = (h ^ (h >> np.uint64(32))) * _D
    h = (h ^ (h >> np.uint64(29))) * _C
    return h ^ (h >> np.uint64(32)), first, last
