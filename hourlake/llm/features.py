"""Vectorised hashing of words and character n-grams over the UTF-8 bytes of many texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Bytes of a text's longest piece, and of pieces that are worked on together: what is kept per byte, in
#: every worker, is many times that.
PIECE, BUFFER = 1 << 20, 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

_SPACE = re.compile(rb"[\t-\r ]")
#: 1 for the bytes of ASCII white space: space and \x09-\x0d.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that any of their bits can serve as a hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class RangeHash:
    """Hashes of any byte ranges of a buffer from one pass of prefix sums, modulo 2**64."""

    _pow = powers(_BASE, 1 << 16)
    _inv = powers(_INVERSE, 1 << 16)

    def __init__(self, data: np.ndarray, table: np.ndarray = _BYTES) -> None:
        n = len(data)
        if n >= len(RangeHash._pow):
            RangeHash._pow, RangeHash._inv = powers(_BASE, 2 * n), powers(_INVERSE, 2 * n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * RangeHash._pow[:n], out=self.sums[1:])

    def __call__(self, first: np.ndarray | slice, last: np.ndarray | slice) -> np.ndarray:
        """Hashes of the ranges from ``first`` to before ``last``."""
        at = RangeHash._inv[first]
        return mix((self.sums[last] - self.sums[first]) * at)


def words_of(data: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~space[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes, cut before white space only: no word is cut."""
    start = 0
    while len(text) - start > size:
        cut = max(text.rfind(b" ", start + 1, start + size), text.rfind(b"\n", start + 1, start + size))
        if cut < 0:
            later = _SPACE.search(text, start + size)
            if not later:
                break
            cut = later.start()
        yield text[start:cut]
        start = cut
    yield text[start:]


def joined(texts: list[bytes], size: int = BUFFER) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of about ``size`` bytes, or one piece more, with whole pieces of texts, a newline after each:
    the bytes, the offsets of the pieces and one more, and the number of the text each piece is of."""
    held: list[bytes] = []
    owners: list[int] = []
    total = 0
    for i, text in enumerate(texts):
        for piece in pieces(text, max(size, PIECE)):
            held.append(piece)
            owners.append(i)
            total += len(piece) + 1
            if total >= size:
                yield _buffer(held, owners)
                held, owners, total = [], [], 0
    if held:
        yield _buffer(held, owners)


def _buffer(held: list[bytes], owners: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(x) + 1 for x in held])])
    return data, starts, np.array(owners)
