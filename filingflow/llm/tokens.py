"""Ids of public byte-pair tokenizers, with each distinct piece of text encoded once per worker.

Tokenizers split a text into pieces and encode each by itself.  A space that stands
alone between other characters always begins a piece, so a text may be cut there and
its parts looked up in a table of parts met before.  Plain parts go through the
tokenizer's own merge table piece by piece, all others through the whole tokenizer.
The strings of special tokens are ordinary text.

``encode_all`` does so for many texts at a time and without a table: Arrow numbers their
distinct parts, these are cut into pieces as one array of bytes, and the distinct pieces go
through the merge table some dozens a call, with a byte between them that no text has and
no merge takes.
"""

from __future__ import annotations

import json
import os
import sys
import types
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Parts and pieces of a generation; a worker and tokenizer remember two generations.
REMEMBERED = 250_000

# How the two tokenizer files split a text into pieces.
SPACED = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
UNSPACED = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

#: Pieces that go through the merge table in one call, and parts whose ids are gathered together.
MERGED_TOGETHER, GATHERED_TOGETHER = 64, 1 << 16
#: A byte that UTF-8 never has.
DIVIDER = 0xC0

#: Bytes of text that are encoded together; a longer text is encoded alone.
PORTION_BYTES = 12 << 20

_LONE_SPACE = regex.compile(r"(?<=\S)(?= \S)")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The visible letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return table


# Kinds of Latin-1 characters, of which a piece has one; where it is special, ``SPACED`` decides.
_LETTER, _NUMBER, _MARK, _BLANK, _SPECIAL = range(5)


def _kind(character: str) -> int:
    blank = regex.match(r"\s", character) is not None
    if character == "'" or blank != character.isspace():
        return _SPECIAL
    if blank:
        return _BLANK
    return _LETTER if regex.match(r"\p{L}", character) else _NUMBER if regex.match(r"\p{N}", character) else _MARK


_KINDS = np.array([_kind(chr(c)) for c in range(256)], np.uint8)
_BYTE_KINDS = np.where(np.arange(256) < 128, _KINDS, _SPECIAL).astype(np.uint8)


class _OddSpace(Exception):
    """White space next to a space: the text may not be cut there."""


class Remembered:
    """A table of the last keys met: when a generation is full, the one before it is forgotten."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def again(self, key: str) -> bytes | None:
        """What the older generation knows; it moves to the newer one."""
        found = self.old.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key: str, value: bytes) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Encoder:
    """Encodes texts to little-endian ``uint16`` ids, as bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if max(spec["model"]["vocab"].values(), default=0) >= 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.folds = spec["normalizer"] is not None
        self.findall = (UNSPACED if self.folds else SPACED).findall
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = str.maketrans({chr(b): letter for b, letter in _byte_letters().items()})
        self.parts, self.pieces = Remembered(remembered), Remembered(remembered)
        self.divider = None if self.folds else self._divider(spec["model"])

    @staticmethod
    def _divider(model: dict) -> int | None:
        """The id of the byte that may stand between pieces, if nothing is merged with it."""
        letter = _byte_letters()[DIVIDER]
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if any(model.get(k) for k in odd) or any(letter in "".join(m) for m in model["merges"]):
            return None
        return model["vocab"].get(letter)

    def whole(self, text: str) -> bytes:
        """By the tokenizer itself, without any table."""
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.new.get(piece) or self.pieces.again(piece)
        if found is None:
            seen = piece.encode().decode("latin-1").translate(self.letters)
            found = array("H", [t.id for t in self.tokenize(seen)]).tobytes()
            self.pieces.keep(piece, found)
        return found

    def _cut(self, part: str) -> bytes:
        if part and max(part) >= "\u0100":  # outside Latin-1: composed forms, letter cases
            return self.whole(part)
        return b"".join(map(self._piece, self.findall(part.lower() if self.folds else part)))

    def _part(self, part: str) -> bytes:
        """A part that is not in the newer generation; a space stands before it in the text."""
        found = self.parts.again(part)
        if found is None:
            if self.folds:
                found = self._cut(part)
            elif not part or part[0].isspace() or part[-1].isspace():
                raise _OddSpace
            else:
                found = self._cut(" " + part)
            if len(part) < 200:
                self.parts.keep(part, found)
        return found

    def encode(self, text: str) -> bytes:
        cut = text.split(" ")
        known, part = self.parts.new.get, self._part
        if self.folds:  # white space is dropped, so any space will do
            return b"".join([known(p) or part(p) for p in cut])
        first = cut.pop(0)
        try:
            if cut and (not first or first[-1].isspace()):
                raise _OddSpace
            return b"".join([self._cut(first), *[known(p) or part(p) for p in cut]])
        except _OddSpace:
            return b"".join([self._cut(p) for p in _LONE_SPACE.split(text)])

    # many texts at a time

    def _merged(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each piece begin, how many they are, and the ids."""
        firsts = np.append(np.arange(0, len(pieces), MERGED_TOGETHER), len(pieces))
        lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pieces.cast(pa.binary()))
        ident, found = attrgetter("id"), [np.zeros(0, "<u2")]
        for joined in pc.binary_join(lists, bytes([DIVIDER])):
            letters = joined.as_py().decode("latin-1").translate(self.letters)
            found.append(np.array([*map(ident, self.tokenize(letters)), self.divider], "<u2"))
        ids = np.concatenate(found)
        ends = np.flatnonzero(ids == self.divider)
        lengths = np.diff(ends, prepend=-1) - 1
        return ends - lengths, lengths, ids

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """The same of parts with a space before each, the ids in several arrays; and where a text may not be cut."""
        if not len(parts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), [], np.zeros(0, bool)
        spaced = pc.binary_join_element_wise(" ", parts, "")
        bounds = np.frombuffer(spaced.buffers()[1], "<i4")[: len(parts) + 1]
        data = np.frombuffer(spaced.buffers()[2], np.uint8)[: bounds[-1]]
        kind = _BYTE_KINDS[data]
        pairs = np.flatnonzero((data == 0xC2) | (data == 0xC3))  # Latin-1 characters of two bytes
        kind[pairs] = kind[pairs + 1] = _KINDS[(data[pairs] & 3) << 6 | data[pairs + 1] & 63]
        # a blank before a blank: parts that are empty, begin or end with white space, or hold two in a row
        blank = kind == _BLANK
        special = np.flatnonzero((kind == _SPECIAL) | (blank & np.append(blank[1:], True)))
        plain = np.ones(len(parts), bool)
        plain[np.searchsorted(bounds, special, "right") - 1] = False
        begins = np.append(True, (kind[1:] != kind[:-1]) & (data[:-1] != 32))
        begins[bounds[:-1]] = True
        at = np.flatnonzero(begins)
        owner = np.searchsorted(bounds, at, "right") - 1
        pieces = pa.StringArray.from_buffers(
            len(at), pa.py_buffer(np.append(at, bounds[-1]).astype("<i4")), spaced.buffers()[2]
        )
        mine = plain[owner]
        coded = pieces.filter(pa.array(mine)).dictionary_encode()
        starts, lengths, ids = self._merged(coded.dictionary)
        codes = coded.indices.to_numpy()
        length = np.bincount(owner[mine], weights=lengths[codes], minlength=len(parts)).astype(np.int64)
        start = np.cumsum(length) - length
        found, odd, end = [_gathered(ids, starts[codes], lengths[codes])], np.zeros(len(parts), bool), int(length.sum())
        for i in np.flatnonzero(~plain).tolist():
            part = parts[i].as_py()
            if not part or part[0].isspace() or part[-1].isspace():
                odd[i] = True
                continue
            own = np.frombuffer(self._cut(" " + part), "<u2")
            start[i], length[i], end = end, len(own), end + len(own)
            found.append(own)
        return start, length, found, odd

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text, and all ids (``uint16``); a null is an empty text."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if self.divider is None or not n:
            each = [self.encode(t) for t in texts.to_pylist()]
            return np.array([len(e) // 2 for e in each], np.int64), np.frombuffer(b"".join(each), "<u2")
        split = pc.split_pattern(texts, " ")
        parts, sizes = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
        first = np.cumsum(sizes) - sizes
        later = np.ones(len(parts), bool)
        later[first] = False
        coded = parts.filter(pa.array(later)).dictionary_encode()
        begin = parts.take(pa.array(first)).to_pylist()
        del split, parts
        start, length, found, odd = self._parts(coded.dictionary)
        codes = coded.indices.to_numpy()
        # texts that may not be cut at each space count as their first part
        whole = np.array([m > 1 and (not b or b[-1].isspace()) for b, m in zip(begin, sizes.tolist(), strict=True)], bool)
        if odd.any():
            whole[np.repeat(np.arange(n), sizes - 1)[odd[codes]]] = True
        begun = [
            np.frombuffer(self.encode(texts[i].as_py()) if w else self._cut(b), "<u2")
            for i, (b, w) in enumerate(zip(begin, whole.tolist(), strict=True))
        ]
        length = np.concatenate([length, [len(b) for b in begun], [0]]).astype(np.int64)
        ends = sum(map(len, found)) + np.cumsum(length[len(odd) :])
        start = np.append(start, ends - length[len(odd) :])
        entry = np.empty(len(later), np.int32)
        entry[later] = codes
        entry[first] = len(odd) + np.arange(n)
        if whole.any():
            entry[later & np.repeat(whole, sizes)] = len(length) - 1
        ids = _gathered(np.concatenate([*found, *begun]).astype("<u2"), start[entry], length[entry])
        return np.add.reduceat(length[entry], first), ids


def _gathered(ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``length`` ids from each ``start``, one after another."""
    found = [ids[:0]]
    for i in range(0, len(start), GATHERED_TOGETHER):
        own = length[i : i + GATHERED_TOGETHER]
        ends = np.cumsum(own)
        found.append(ids[np.repeat(start[i : i + GATHERED_TOGETHER] - ends + own, own) + np.arange(ends[-1])])
    return np.concatenate(found)


def large_batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``PORTION_BYTES`` of the text in column ``text``."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        size = pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
        if held and n + size > PORTION_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
        if batch.num_rows:
            held.append(batch)
            n += size
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encoder(path: str) -> Encoder:
    """The worker's encoder; it outlives a task where Spark keeps its Python workers.

    Functions travel to workers by value, each with globals of its own, so what is to
    be kept lies in a module of the worker process.
    """
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
