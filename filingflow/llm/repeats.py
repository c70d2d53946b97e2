"""Substring dedup with fixed-block anchors.

A repeat is a run of ``SPAN`` words or more that also stands in a document with a
smaller id; the words it covers are removed, the first document keeps them.  Every
document is cut into blocks of ``BLOCK`` words that do not overlap.  A window of
``SPAN`` = 13 words holds a whole block of 7 wherever it starts, so each window of
seven words (the rolling probe) is looked up among the blocks; a probe found in a
block of another document is an anchor.  Anchors are extended: all windows of
``SPAN`` words around one are compared by 64-bit hash, and neighbouring windows that
are found in a smaller document join to a maximal exact repeat.

Probes and windows are offered to buckets per chunk, distinct and compressed (see
``chunks``): the first exchange finds anchors by 48 leading bits of the hash, which
can only add candidates, the second one decides.  Memory per task is a chunk or a
bucket; a passage that a third of all documents share is offered once per chunk.

Defined cases: a null text has no words; a null id counts as larger than all others;
rows with the same id do not remove each other's words; texts of fewer than 13 words
are kept; an empty table gives an empty result; the input's columns are kept, a
computed column takes the place of one of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from ..session import written
from .chunks import Chunks, answered, unpack
from .words import Words

SPAN = 13
BLOCK = 7
_LAST = np.int64((1 << 63) - 1)
_KEPT_BITS = np.uint64(0xFFFFFFFFFFFF0000)

ADDED = ["n_words", "n_removed", "kept_sha256"]


def _texts(docs: pa.Table) -> list[str | None]:
    return docs.column("text").to_pylist()


def _ids(docs: pa.Table) -> np.ndarray:
    return np.array([_LAST if i is None else i for i in docs.column("doc_id").to_pylist()], np.int64)


def _probes(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All probes of a chunk: distinct keys, the key of each probe, where it starts, the flags of each key.

    Flag 1: a block of some document, flag 2: in two documents of the chunk or more.
    """
    found, at = words.windows(BLOCK)
    keys, group = np.unique(found & _KEPT_BITS, return_inverse=True)
    flags = np.zeros(len(keys), np.uint8)
    doc = words.doc[at]
    flags[group[(at - words.first[doc]) % BLOCK == 0]] |= 1
    lowest = np.full(len(keys), len(words.raw), np.int64)
    np.minimum.at(lowest, group, doc)
    flags[group[doc != lowest[group]]] |= 2
    return keys, group, at, flags


def _offer_probes(docs: pa.Table, row: dict) -> dict[str, np.ndarray]:
    keys, _, _, flags = _probes(Words(_texts(docs)))
    return {"keys": keys, "values": flags}


def _anchors(group: np.ndarray, flags: np.ndarray, n: int) -> np.ndarray:
    """1 for keys that are a block somewhere and stand in two documents or more."""
    block, shared = np.zeros(n, bool), np.bincount(group, minlength=n) > 1
    block[group[(flags & 1) > 0]] = True
    shared[group[(flags & 2) > 0]] = True
    return (block & shared)[group].astype(np.uint8)


def _candidates(words: Words, row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the windows of ``SPAN`` words that hold an anchor."""
    keys, group, at, _ = _probes(words)
    live = answered(row, "anchors", "u1", len(keys))[group] > 0
    near = np.zeros(len(words.hashes) + 1, np.int64)
    near[at[live] + 1] = 1
    near = np.cumsum(near)
    found, first = words.windows(SPAN)
    held = near[first + SPAN - BLOCK + 1] > near[first]
    return found[held], first[held]


def _smallest(words: Words, ids: np.ndarray, row: dict) -> tuple[np.ndarray, ...]:
    found, first = _candidates(words, row)
    keys, group = np.unique(found, return_inverse=True)
    least = np.full(len(keys), _LAST, np.int64)
    np.minimum.at(least, group, ids[words.doc[first]])
    return keys, group, first, least


def _offer_windows(docs: pa.Table, row: dict) -> dict[str, np.ndarray]:
    keys, _, _, least = _smallest(Words(_texts(docs)), _ids(docs), row)
    return {"keys": keys, "values": least}


def _earlier(group: np.ndarray, least: np.ndarray, n: int) -> np.ndarray:
    """1 for offers whose window starts in a document of another chunk with a smaller id."""
    lowest = np.full(n, _LAST, np.int64)
    np.minimum.at(lowest, group, least)
    return (lowest[group] < least).astype(np.uint8)


def _covered(words: Words, ids: np.ndarray, row: dict) -> np.ndarray:
    keys, group, first, least = _smallest(words, ids, row)
    earlier = answered(row, "earlier", "u1", len(keys))[group] > 0
    gone = first[earlier | (ids[words.doc[first]] > least[group])]
    change = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(change, gone, 1)
    np.add.at(change, gone + SPAN, -1)
    return np.cumsum(change)[:-1] > 0


def _cleaner(names: list[str], text_to_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                docs = unpack(row["packed"])
                words = Words(_texts(docs))
                covered = _covered(words, _ids(docs), row)
                removed = np.add.reduceat(np.append(covered, 0), words.first[:-1]) if docs.num_rows else covered
                removed = np.where(words.counts > 0, removed, 0)
                kept, digests = [], []
                for i, raw in enumerate(words.raw):
                    own = raw.split()
                    if removed[i]:
                        drop = covered[words.first[i] : words.first[i + 1]]
                        own = [w for w, gone in zip(own, drop, strict=True) if not gone]
                    joined = b" ".join(own)
                    digests.append(hashlib.sha256(joined).hexdigest())
                    if text_to_kept:
                        untouched = not removed[i]
                        kept.append(docs.column("text")[i].as_py() if untouched else joined.decode())
                columns = {n: docs.column(n).combine_chunks() for n in docs.column_names if n in names}
                columns = {n: c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for n, c in columns.items()}
                if text_to_kept:
                    columns["text"] = pa.array(kept, pa.string())
                columns |= {
                    "n_words": pa.array(words.counts, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string()),
                }
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return run


def remove_repeats(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_sha256``.

    ``keep`` names the input's columns to return, all by default.  If ``text`` is one
    of them it is the kept words joined by a space where any were removed.
    """
    keep = [c for c in (keep or docs.columns) if c.lower() not in ADDED]
    docs = docs.select(*dict.fromkeys([*keep, "doc_id", "text"]))
    chunks = Chunks(docs)
    anchors = chunks.answers(chunks.offers(_offer_probes), "u1", _anchors, "anchors")
    anchors = written(anchors, "anchors")
    earlier = chunks.answers(chunks.offers(_offer_windows, anchors), "<i8", _earlier, "earlier")
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    )
    return chunks.joined(anchors, earlier).mapInArrow(_cleaner([f.name for f in schema], "text" in keep), schema)
