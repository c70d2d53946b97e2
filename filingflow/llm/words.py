"""Hashes of words and word windows for many texts at once, with numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Bytes of text that are hashed at the same time; it takes some forty times as much memory.
PORTION = 1 << 20

_MASK = (1 << 64) - 1


def _stream(label: str, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers."""
    drawn = hashlib.shake_128(label.encode()).digest(8 * n)
    return np.frombuffer(drawn, "<u8").copy()


_LETTERS = _stream("letters", 256)
_BASE = int(_stream("base", 1)[0]) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = int(_stream("step", 1)[0]) | 1
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MARKS = _BLANK.copy()
_MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


class Words:
    """Words of texts: ``hashes`` of all, ``doc`` the text of each, ``first`` the first word of each text.

    ``fold`` lower-cases A-Z; with ``punctuation`` ASCII punctuation separates words too.
    """

    def __init__(self, texts: Sequence[str | None], fold: bool = False, punctuation: bool = False) -> None:
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.raw = raw
        data = np.frombuffer(b"\n".join([*raw, b""]) + b"\n", np.uint8)
        if fold:
            data = _FOLD[data]
        blank = (_MARKS if punctuation else _BLANK)[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            edge = np.concatenate([[0], edge])
        start, end = edge[0::2], edge[1::2]
        prefix = np.zeros(len(data) + 1, np.uint64)
        each = _LETTERS[data]
        each *= _power(_BASE, len(data))
        np.cumsum(each, out=prefix[1:])
        del each
        self.prefix, self.start, self.end = prefix, start, end
        self.hashes = self.spans(start, end)
        sizes = np.array([len(r) + 1 for r in raw], np.int64)
        self.text_at = np.cumsum(sizes) - sizes
        self.first = np.searchsorted(start, np.append(self.text_at, len(data)))
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(raw)), self.counts)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from ``start`` to before ``end``; equal bytes have equal hashes."""
        plain = (self.prefix[end] - self.prefix[start]) * _power(_INVERSE, len(self.prefix))[start]
        return mix(plain + (end - start).astype(np.uint64))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``width`` words within a text, and the first word of each."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for j in range(width):
            total += self.hashes[j : j + n] * np.uint64(pow(_STEP, j, 1 << 64))
        inside = np.flatnonzero(self.doc[:n] == self.doc[width - 1 : width - 1 + n])
        return mix(total[inside]), inside


def portions(batch: pa.RecordBatch, column: str = "text", limit: int = PORTION) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``limit`` bytes of text, which bounds what ``Words`` needs; a longer text is a slice."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = min(max(int(np.searchsorted(ends, before + limit, "right")), first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def prefix_hashes(words: Words, n: int) -> np.ndarray:
    """Hashes of the first ``n`` bytes of each word, told apart from those of whole words."""
    return mix(words.spans(words.start, np.minimum(words.start + n, words.end)) + np.uint64(n))
