"""Vectorised hashes of words and character n-grams over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

#: Bytes that are hashed together; a longer text is cut at white space, and its words stay whole.
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Letters, digits and all bytes of characters beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    k = 1
    while k < n:
        step = np.uint64(pow(base, k, 1 << 64))
        m = min(k, n - k)
        with np.errstate(over="ignore"):
            out[k : k + m] = out[:m] * step
        k += m
    return out


_TABLES: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(n, BLOCK + 1)
        _TABLES[:] = [_powers(_BASE, size), _powers(_INVERSE, size)]
    return _TABLES


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


class Bytes:
    """The hashes of any range of a run of bytes, from one pass over it."""

    def __init__(self, data: bytes):
        self.bytes = np.frombuffer(data, np.uint8)
        power, self.inverse = _tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def ranges(self, starts, ends) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def windows(self, n: int) -> np.ndarray:
        """Of every window of ``n`` bytes."""
        m = max(0, len(self.bytes) - n + 1)
        with np.errstate(over="ignore"):
            return mix((self.sums[n : n + m] - self.sums[:m]) * self.inverse[:m])

    def runs(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes of a kind."""
        inside = np.zeros(len(self.bytes) + 2, np.int8)
        inside[1:-1] = kind[self.bytes]
        edge = np.diff(inside)
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def blocks(texts: list[str | None], size: int = BLOCK):
    """Yields ``(data, owners, ends)``: bytes of several texts, which text each piece is of, and where it ends.

    A line end stands before and behind each piece. A text longer than ``size`` is cut behind white space
    (anywhere only if a single word is longer than that).
    """
    parts, owners, ends, total = [], [], [], 1
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while True:
            stop = len(data)
            if stop - at > size:
                cut = max(data.rfind(b" ", at, at + size), data.rfind(b"\n", at, at + size))
                stop = cut + 1 if cut > at else at + size
            if parts and total + stop - at > size:
                yield b"\n%b\n" % b"\n".join(parts), np.array(owners), np.array(ends)
                parts, owners, ends, total = [], [], [], 1
            parts.append(data[at:stop])
            owners.append(i)
            total += stop - at
            ends.append(total)
            total += 1
            at = stop
            if at >= len(data):
                break
    if parts:
        yield b"\n%b\n" % b"\n".join(parts), np.array(owners), np.array(ends)


def word_hashes(texts: list[str | None], kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, owners)`` of all words of the texts, in order."""
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for data, own, ends in blocks(texts):
        b = Bytes(data)
        start, end = b.runs(kind)
        hashes.append(b.ranges(start, end))
        owners.append(own[np.searchsorted(ends, start, "right")])
    return np.concatenate(hashes), np.concatenate(owners)


def slices(texts: list, chars: int = 1 << 21):
    """Ranges of a batch whose texts have about ``chars`` characters together, to bound the work arrays."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
