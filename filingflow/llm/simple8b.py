"""Simple-8b: unsigned integers in 64-bit words, encoded and decoded with numpy.

The low 4 bits of a word select how many values it holds and of how many bits; the
other 60 bits hold them, first value lowest.  A value of more than 60 bits is
escaped: a word with the escape selector, then the value as a word of its own.
Values are cut into blocks of ``BLOCK``; a word never crosses a block, and the index
of each block's first word is kept, so all blocks are decoded at the same time and
any of them alone.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
# The format's selectors, as (values in a word, bits of each).
SELECTORS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30),
    (1, 60),
]
ESCAPE = len(SELECTORS)
_HELD = np.array([n for n, _ in SELECTORS] + [1], np.int64)


def _selected(values: np.ndarray, block: int) -> np.ndarray:
    """For each place of each block the selector of a word that would start there."""
    rows, width = values.shape
    chosen = np.full(values.shape, ESCAPE, np.uint8)
    place = np.arange(width, dtype=np.int16)
    for selector in range(len(SELECTORS) - 1, -1, -1):
        held, bits = SELECTORS[selector]
        wide = values >= np.uint64(1 << bits)
        # next place at or after this one whose value is too wide
        stop = np.where(wide, place, np.int16(width))
        stop = np.minimum.accumulate(stop[:, ::-1], axis=1)[:, ::-1]
        fits = stop >= np.minimum(place + held, width)
        if selector < len(SELECTORS) - 1 and not fits.any():
            break  # narrower words fit nowhere either, except at the end of a block
        chosen[fits] = selector
    return chosen


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the index of the first word of each block."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, "<u8"), np.zeros(0, "<u4")
    rows = -(-n // block)
    padded = np.zeros(rows * block, np.uint64)
    padded[:n] = values
    chosen = _selected(padded.reshape(rows, block), block).ravel()
    ends = np.minimum((np.arange(rows) + 1) * block, n)
    at = np.arange(rows) * block
    live = np.arange(rows)
    starts, owners = [], []
    while len(live):  # one word of every block at a time
        starts.append(at)
        owners.append(live)
        at = at + _HELD[chosen[at]]
        more = at < ends[live]
        at, live = at[more], live[more]
    order = np.argsort(np.concatenate(owners), kind="stable")
    start = np.concatenate(starts)[order]
    owner = np.concatenate(owners)[order]
    selector = chosen[start]
    size = 1 + (selector == ESCAPE)
    index = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    ranges = np.concatenate([padded, np.zeros(64, np.uint64)])
    last = ends[owner]
    for s in np.unique(selector):
        mine = selector == s
        first = start[mine]
        if s == ESCAPE:
            words[index[mine]] = ESCAPE
            words[index[mine] + 1] = ranges[first]
            continue
        held, bits = SELECTORS[s]
        word = np.full(len(first), s, np.uint64)
        limit = last[mine]
        for k in range(held):
            part = np.where(first + k < limit, ranges[first + k], np.uint64(0))
            word |= part << np.uint64(4 + k * bits)
        words[index[mine]] = word
    offsets = index[np.searchsorted(owner, np.arange(rows))]
    return words.astype("<u8"), offsets.astype("<u4")


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values again."""
    words = np.asarray(words, np.uint64)
    if n == 0:
        return np.zeros(0, np.uint64)
    selector = (words & np.uint64(15)).astype(np.int64)
    # the word after an escape is a value, not a selector
    raw = np.zeros(len(words), bool)
    if (selector == ESCAPE).any():
        for i in np.flatnonzero(selector == ESCAPE):
            if not raw[i] and i + 1 < len(words):
                raw[i + 1] = True
        selector[raw] = -1
    held = np.where(raw, 0, _HELD[selector])
    offsets = np.asarray(offsets, np.int64)
    owner = np.repeat(np.arange(len(offsets)), np.diff(np.append(offsets, len(words))))
    before = np.cumsum(held) - held
    place = before - before[offsets][owner] + owner * block
    limit = np.minimum((owner + 1) * block, n)
    values = np.zeros(len(offsets) * block + 64, np.uint64)
    for s in np.unique(selector[~raw]):
        mine = np.flatnonzero((selector == s) & ~raw)
        if s == ESCAPE:
            values[place[mine]] = words[mine + 1]
            continue
        count, bits = SELECTORS[s]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            inside = place[mine] + k < limit[mine]
            chosen = mine[inside]
            values[place[chosen] + k] = (words[chosen] >> np.uint64(4 + k * bits)) & mask
    return values[:n]
