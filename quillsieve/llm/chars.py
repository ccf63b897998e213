"""Whole batches of texts as arrays of 10-bit character codes, for character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bits of a code. Letters and digits below 1024 keep their number; others are hashed; all else is ``EDGE``.
BITS, EDGE = 10, 1
#: Characters that are handled at once; a single longer text is taken whole.
SLICE_CHARS = 500_000


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    numbers = np.arange(0x110000, dtype=np.uint32)
    own = np.where(numbers < 1 << BITS, numbers, 2 + (numbers * np.uint32(2654435761) >> np.uint32(22)) % np.uint32((1 << BITS) - 2))
    word = np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)
    return np.where(word, own, EDGE).astype(np.int64)


def codes(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all lower-cased texts, each after ``pad`` edges; where each text starts, and its length."""
    texts = [t.lower() for t in texts]
    edge = " " * pad
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    flat = np.frombuffer((edge + edge.join(texts)).encode("utf-32-le"), dtype="<u4") if texts else np.zeros(0, dtype="<u4")
    return _codes()[flat], np.cumsum(sizes + pad) - sizes, sizes


def grams(code: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` codes at every place, packed; the first n - 1 places hold what there is."""
    out = code.copy()
    for i in range(1, n):
        out[i:] |= code[:-i] << np.int64(BITS * i)
    return out


def slices(texts: list[str | None], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def word_grams(code: np.ndarray, n: int) -> np.ndarray:
    """Like ``grams``, but a context ends at the last edge before it: what came before a word's start does not count."""
    out, alive = code.copy(), np.ones(len(code), dtype=bool)
    for i in range(1, min(n, len(code))):
        before = np.empty_like(code)
        before[:i], before[i:] = EDGE, code[:-i]
        out |= np.where(alive, before, 0) << np.int64(BITS * i)
        alive &= before != EDGE
    return out
