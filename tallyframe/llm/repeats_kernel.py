"""Byte-string hashing for the repeat search: prefix hashes, anchors and range hashes of one text."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .common import mix64

#: (base, modulus) of the polynomials. The first is fast but blind to some regular strings (sums of powers of two times
#: odd numbers vanish); the two primes are not.
_SERIES = ((0x9E3779B97F4A7C55, 1 << 64), (1_403_627_117, (1 << 31) - 1), (1_829_304_551, (1 << 31) - 19))
#: The polynomials of each hash.
_HASHES = ((0,), (1, 2))


@lru_cache(maxsize=12)
def _powers(series: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, for texts up to 2**bits bytes."""
    base, modulus = _SERIES[series]
    inverse = pow(base, -1, modulus)
    tables = []
    for x in (base, inverse):
        out = np.ones(1 << bits, np.uint64)
        filled = 1
        while filled < len(out):  # doubling: the next block is the last one times x**filled
            out[filled: 2 * filled] = _reduced(out[:filled] * np.uint64(pow(x, filled, modulus)), modulus)
            filled *= 2
        tables.append(out)
    return tuple(tables)


def _reduced(x: np.ndarray, modulus: int) -> np.ndarray:
    return x if modulus == 1 << 64 else x % np.uint64(modulus)


class Hashes:
    """Hashes of any substrings of ``data`` in a few vector steps."""

    def __init__(self, data: bytes):
        self.n = len(data)
        self.data = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        self.bits = max(12, self.n.bit_length())
        self.sums: dict[int, np.ndarray] = {}

    def of(self, at: np.ndarray, length: int | np.ndarray, salt: int | np.ndarray = 0, which: int = 0) -> np.ndarray:
        """64-bit hashes of the substrings at ``at``; equal substrings with equal salts have equal hashes."""
        raw = np.zeros(1, np.uint64)
        for series in _HASHES[which]:
            modulus = _SERIES[series][1]
            power, inverse = _powers(series, self.bits)
            if series not in self.sums:
                values = _reduced(self.data * power[: self.n], modulus)
                self.sums[series] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            sums = self.sums[series]
            part = _reduced(_reduced(sums[at + length] - sums[at], modulus) * inverse[at], modulus)
            raw = (raw << np.uint64(31)) ^ part
        return mix64(raw ^ mix64(np.atleast_1d(np.asarray(salt, np.uint64)) + np.uint64(1 + 7 * which)))


def sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every run of ``width`` neighbours, by doubling."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = op(out[: len(out) - step], out[step:])
        done += step
    return out


def anchors(hashes: Hashes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every window of ``window`` bytes belongs to its least gram, the leftmost of equals.

    Returns the grams' positions and the first and last start of the windows that belong to
    each (they are neighbours). Which gram it is depends on the window's bytes only, so equal
    windows belong to grams at the same place within them.
    """
    if hashes.n < window:
        return (np.zeros(0, np.int64),) * 3
    at = np.arange(hashes.n - gram + 1)
    order = hashes.of(at, gram) & np.uint64(0xFFFFFFFF00000000) | at.astype(np.uint64)
    owner = (sliding(np.minimum, order, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], first, last


#: Window starts hashed at once: bounds memory on very long texts.
CHUNK = 1 << 20


def text_anchors(data: bytes, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions, first and last window starts and gram hashes of a whole text, chunk by chunk."""
    parts = []
    for lo in range(0, max(len(data) - window + 1, 0), CHUNK):
        hashes = Hashes(data[lo: lo + CHUNK + window - 1])
        at, first, last = anchors(hashes, window, gram)
        parts.append((at + lo, first + lo, last + lo, hashes.of(at, gram)))
    if not parts:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*parts))


def range_hashes(
    data: bytes, at: np.ndarray, near: np.ndarray, far: np.ndarray, window: int, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ranges of windows: those that start ``near`` to ``far`` bytes before an anchor.

    Of each range: a hash of the bytes that every window of its aligned block of ``width`` shares
    (and whether the text has them all), and two hashes of all bytes that its windows cover.
    A ``width`` of 0 leaves out the first.
    """
    core = np.zeros(len(at), np.uint64)
    known = np.zeros(len(at), bool)
    whole = np.zeros((2, len(at)), np.uint64)
    start = at - far
    margin = 2 * window + 2 * max(width, 1) + int((far - near).max(initial=0))
    for chunk in np.unique(start // CHUNK):
        of = np.flatnonzero(start // CHUNK == chunk)
        lo = int(chunk) * CHUNK
        hashes = Hashes(data[lo: lo + CHUNK + margin])
        a, n, f = at[of], near[of], far[of]
        shape = n * (window + 1) + f
        for k in range(2):
            whole[k, of] = hashes.of(start[of] - lo, f - n + window, shape, k)
        if width:
            block = n // width
            first = a - block * width
            length = window - width + 1
            full = first + length <= len(data)
            known[of] = full
            core[of[full]] = hashes.of(first[full] - lo, length, block[full])
    return core, known, whole[0], whole[1]
