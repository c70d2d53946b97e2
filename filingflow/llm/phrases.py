"""Phrases that belong together, mined as relations of occurrences (SETM).

The relation of length 1 holds every word at its place: documents are packed into chunks
of one language, pieces one after another with a gap between them, so a chunk's
occurrences are sorted by piece and position.  Each length is built from the one before:

1. *merge-join*: an occurrence at a position meets the one at the next position of the
   same piece, which overlaps it in all but one word; together they are an occurrence
   one word longer;
2. *group-count*: the distinct phrases of each chunk with their counts are rows, summed
   over all chunks; those of ``LEAST`` occurrences or more are frequent;
3. *semi-join*: only occurrences of frequent phrases stay in the relation that the next
   length is built from.  Words are joined with the frequent ones exactly, which numbers
   them.  Longer phrases are tested against a bit filter of the frequent ones, of
   ``BITS`` per phrase and ``MOST_BITS`` at most, so that nothing goes back from the
   counts to the chunks: what passes by chance is counted at the next length and, being
   rarer than a rare part, falls out there.  A fuller filter keeps more occurrences and
   changes no result.

The relations are written at every length, and removed once the next one is.  Words are
told apart by themselves and phrases by their words' numbers, so counts are exact.  A word
that all texts use is one row per chunk; no table of words or phrases is broadcast or
collected.  A task holds one chunk, about ``CHUNK_BYTES`` of text or one longer text, cut
into slices of ``SLICE`` while its words are read.

Defined cases: a null text is empty; a null language is ``und``; an empty language is one
of its own; rows with the same id are texts of their own; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import clear, fresh_dir, written
from .chunks import squeeze, unsqueeze
from .words import mix

LEAST, LONGEST, TOP = 30, 4, 2000
#: A candidate goes if a longer one around it has this share of its occurrences, in percent.
COVERED = 80
#: Bytes of text after which chunks are closed; the numbers of a chunk take some twenty times that while it is counted.
CHUNK_BYTES = 8 << 20
#: Occurrences tested against the filter at a time.
TESTED = 1 << 18
SLICE = 4 << 20
#: Parts of a language that are ranked by themselves first.
RANK_PARTS = 64
#: Size of the filter of frequent phrases, a power of two, and the hashes of a phrase in it.
BITS, MOST_BITS, HASHES = 16, 1 << 27, 4
#: Parts that a filter is gathered in, a row of each per task.
PAGES = 64

# A-Z folded; what ends a piece becomes a full stop, which no word holds
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
_GAP = b"."

WORDS = "chunk long, lang string, local int, word binary, n long, places binary"
RELATION = "chunk long, lang string, places binary, ids binary"


def _slices(data: bytes) -> Iterator[bytes]:
    first = 0
    while len(data) - first > SLICE:
        last = data.find(b" ", first + SLICE)
        if last < 0:
            break
        yield data[first:last]
        first = last
    yield data[first:]


class _Words:
    """Occurrences of one language in a chunk; word 0 is the gap between pieces."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[_GAP]
        self.places: list[np.ndarray] = []

    def add(self, text: bytes) -> None:
        number = self.numbers.__getitem__
        for part in _slices(text.translate(_FOLD).replace(_GAP, b" . ")):
            words = part.split()
            self.places.append(np.fromiter(map(number, words), np.int32, len(words)))
        self.places.append(np.zeros(1, np.int32))

    def rows(self, chunk: int, lang: str) -> pa.RecordBatch:
        """The distinct words of a chunk, and last, numbered -1, its relation of occurrences."""
        places = np.concatenate(self.places) - np.int32(1)
        words = list(self.numbers)[1:]
        n = len(words)
        counts = np.bincount(places + 1, minlength=n + 1)[1:]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, chunk)), pa.array([lang] * (n + 1), pa.string()),
                pa.array(np.append(np.arange(n), -1), pa.int32()), pa.array([*words, None], pa.binary()),
                pa.array(np.append(counts, counts.sum()), pa.int64()),
                pa.array([None] * n + [squeeze(places.astype("<i4"))], pa.binary()),
            ],
            ["chunk", "lang", "local", "word", "n", "places"],
        )


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Words] = defaultdict(_Words)
    size = made = part = 0

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal size, made
        for lang, words in held.items():
            yield words.rows((part << 24) | made, lang)
            made += 1
        held.clear()
        size = 0

    for batch in batches:
        for part, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            held[lang].add(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield from close()
    yield from close()


def _relation(chunk: int, lang: str, places: np.ndarray, ids: np.ndarray) -> pa.Table:
    return pa.table({
        "chunk": pa.array([chunk], pa.int64()), "lang": pa.array([lang], pa.string()),
        "places": pa.array([squeeze(places.astype("<i4"))], pa.binary()), "ids": pa.array([squeeze(ids.astype("<i8"))], pa.binary()),
    })


def _numbered_words(words: pa.Table, frequent: pa.Table) -> pa.Table:
    """A chunk's occurrences of frequent words, as places among their numbers; -1 elsewhere."""
    if not words.num_rows or not frequent.num_rows:
        return _relation(0, "", np.zeros(0), np.zeros(0)).slice(0, 0)
    places = unsqueeze(words.column("places")[0].as_py(), "<i4")
    ids = frequent.column("id").to_numpy()
    rank = np.full(int(places.max(initial=-1)) + 2, -1, np.int32)  # the last entry is for the gaps
    rank[frequent.column("local").to_numpy()] = np.arange(len(ids))
    return _relation(words.column("chunk")[0].as_py(), words.column("lang")[0].as_py(), rank[places], ids)


def _starts(places: np.ndarray, length: int) -> np.ndarray:
    """Where ``length`` places follow each other without a gap."""
    gaps = np.cumsum(np.concatenate([[False], places < 0]), dtype=np.int32)
    return np.flatnonzero(gaps[length:] == gaps[:-length]) if len(places) >= length else np.zeros(0, np.int64)


def _ids_of(name: int) -> str:
    return f"w{name + 1}"


def _counted(length: int):
    """Rows of the distinct phrases of ``length`` words of a chunk and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, packed_ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                places, ids = unsqueeze(packed, "<i4"), unsqueeze(packed_ids, "<i8")
                at = _starts(places, length)
                number = places[at].astype(np.int64)
                for j in range(1, length):  # numbers of ever longer phrases
                    _, first, number, counts = np.unique(
                        number * len(ids) + places[at + j], return_index=True, return_inverse=True, return_counts=True
                    )
                columns = [pa.array(ids[places[at[first] + j]]) for j in range(length)] if len(at) else [pa.array([], pa.int64())] * length
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64())], [*map(_ids_of, range(length)), "n"]
                )

    return run


def _places_in_filter(ids: list[np.ndarray], bits: int) -> Iterator[np.ndarray]:
    """The bits of phrases, given their words' numbers; one array per hash."""
    key = np.zeros(len(ids[0]), np.uint64)
    for column in ids:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    for turn in range(HASHES):
        yield mix(key + np.uint64(turn)) & np.uint64(bits - 1)


def filter_pages(frequent: DataFrame, length: int, bits: int) -> DataFrame:
    """(page, held): the pages of each task's own filter; there are ``PAGES`` a task at most, however many phrases."""
    names = [_ids_of(j) for j in range(length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits >> 6, np.uint64)
        for batch in batches:
            for at in _places_in_filter([batch.column(j).to_numpy() for j in range(length)], bits):
                np.bitwise_or.at(held, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        for page, words in enumerate(held.reshape(PAGES, -1)):
            if words.any():
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([words.tobytes()], pa.binary())], ["page", "held"])

    return frequent.select(*names).mapInArrow(run, "page int, held binary")


def _one_page(pages: pa.Table) -> pa.Table:
    held = np.bitwise_or.reduce([np.frombuffer(p, np.uint64) for p in pages.column("held").to_pylist()])
    return pa.table({"page": pages.column("page")[:1], "held": pa.array([held.tobytes()], pa.binary())})


def filter_of(frequent: DataFrame, length: int) -> np.ndarray:
    """The filter as 64-bit words, of bounded size; only its pages come to the driver."""
    bits = 1 << 12
    n = frequent.count()
    while bits < BITS * n and bits < MOST_BITS:
        bits *= 2
    rows = filter_pages(frequent, length, bits).groupBy("page").applyInArrow(_one_page, "page int, held binary").toArrow()
    found = np.zeros((PAGES, (bits >> 6) // PAGES), np.uint64)
    for page, held in zip(rows.column("page").to_pylist(), rows.column("held").to_pylist(), strict=True):
        found[page] = np.frombuffer(held, np.uint64)
    return found.ravel()


def _passing(at: np.ndarray, places: np.ndarray, ids: np.ndarray, length: int, held: np.ndarray) -> np.ndarray:
    """Those of the starts ``at`` whose phrase passes the filter."""
    for bit in _places_in_filter([ids[places[at + j]] for j in range(length)], len(held) << 6):
        hit = (held[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)
        at = np.where(hit == 1, at, -1)
    return at[at >= 0]


def _kept(length: int, held: np.ndarray):
    """The relation of occurrences that pass the filter: runs in which all ``length`` words are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, ids = unsqueeze(row["places"], "<i4"), unsqueeze(row["ids"], "<i8")
                at = _starts(places, length)
                at = np.concatenate([_passing(at[i : i + TESTED], places, ids, length, held) for i in range(0, len(at), TESTED)] or [at])
                # a run from its first start to the end of its last phrase, and a gap
                first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
                sizes = np.diff(np.append(first, len(at))) + length
                ends = np.cumsum(sizes)
                found = np.repeat(at[first] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
                kept = places[found] if len(found) else np.zeros(0, np.int32)
                kept[ends - 1] = -1
                yield from _relation(row["chunk"], row["lang"], kept, ids).to_batches()

    return run


def occurrences(docs: DataFrame, folder: str) -> DataFrame:
    """The words of each chunk, and the relation of length 1."""
    texts = docs.select(
        F.spark_partition_id().cast("long").alias("part"), F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return written(texts.mapInArrow(_words, WORDS), "words", folder)


def frequent_words(words: DataFrame, least: int) -> DataFrame:
    """(w1, lang, word, words, f, heads, tails): ``heads`` and ``tails`` are the counts of shorter first and last parts."""
    none = F.array().cast("array<long>")
    counted = words.filter("local >= 0").groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    return written(
        counted.select(
            F.monotonically_increasing_id().alias("w1"), "lang", "word", F.array("word").alias("words"), "f", none.alias("heads"), none.alias("tails")
        ),
        "frequent",
    )


def frequent_phrases(relation: DataFrame, shorter: DataFrame, length: int, least: int) -> DataFrame:
    """As ``frequent_words``, for phrases of the words numbered ``w1``, ``w2`` and so on."""
    names = [_ids_of(j) for j in range(length)]
    counted = relation.select("places", "ids").mapInArrow(_counted(length), ", ".join(f"{n} long" for n in [*names, "n"]))
    counted = counted.groupBy(*names).agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    first = shorter.select(*names[:-1], "lang", F.col("words").alias("head"), F.concat("heads", F.array("f")).alias("heads"))
    last = shorter.select(
        *[F.col(a).alias(b) for a, b in zip(names, names[1:])], F.slice("words", -1, 1).alias("tail"),
        F.concat("tails", F.array("f")).alias("tails"),
    )
    joined = written(counted, "counted").join(first, names[:-1]).join(last, names[1:])
    return written(joined.select(*names, "lang", F.concat("head", "tail").alias("words"), "f", "heads", "tails"), "frequent")


def numbered(words: DataFrame, frequent: DataFrame, folder: str) -> DataFrame:
    """The relation of frequent words, each by its number."""
    numbers = words.filter("local >= 0").select("chunk", "local", "lang", "word").join(
        frequent.select("lang", "word", F.col("w1").alias("id")).hint("shuffle_hash"), ["lang", "word"]
    ).select(F.col("chunk").alias("at"), "local", "id")
    places = words.filter("local = -1").select("chunk", "lang", "places")
    return written(places.groupBy("chunk").cogroup(numbers.groupBy("at")).applyInArrow(_numbered_words, RELATION), "places", folder)


def _uncovered(phrases: DataFrame, around: DataFrame | None, length: int) -> DataFrame:
    """Phrases that no phrase one word longer covers.

    A longer one that covers them holds one of these, with as many occurrences or more.
    """
    if around is None:
        return phrases
    names = [_ids_of(j) for j in range(length)]
    last = [F.col(_ids_of(j + 1)).alias(_ids_of(j)) for j in range(length)]
    most = around.select(*names, "f").unionByName(around.select(*last, "f"))
    most = most.groupBy(*names).agg(F.max("f").alias("most"))
    return phrases.join(most, names, "left").filter(F.coalesce(100 * F.col("most") < COVERED * F.col("f"), F.lit(True)))


def _scored(phrases: DataFrame, length: int) -> DataFrame:
    cuts = [
        F.struct(
            F.expr(f"CAST(2000000 AS DECIMAL(10,0)) * CAST(f AS DECIMAL(20,0)) DIV CAST(heads[{k - 1}] + tails[{length - k - 1}] AS DECIMAL(20,0))")
            .alias("score"),
            F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[length - k - 1].alias("r"),
        )
        for k in range(1, length)
    ]
    phrase = F.concat_ws(" ", F.transform("words", lambda w: w.cast("string")))
    cut = phrases.withColumn("cut", F.array_min(F.array(*cuts)))
    return cut.select("lang", phrase.alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words."""
    spark = docs.sparkSession
    folders = [fresh_dir(spark, "occurrences") for _ in range(longest)]
    words = occurrences(docs, folders[0])
    totals = written(words.filter("local = -1").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    levels = [frequent_words(words, least)]
    relation = numbered(words, levels[0], folders[1])
    clear(spark, folders[0])
    for length in range(2, longest + 1):
        levels.append(frequent_phrases(relation, levels[-1], length, least))
        if length < longest:
            held = filter_of(levels[-1], length)
            relation = written(relation.mapInArrow(_kept(length, held), RELATION), "places", folders[length])
        clear(spark, folders[length - 1])
    found = None
    for length in range(2, longest + 1):
        rows = _uncovered(levels[length - 1], levels[length] if length < longest else None, length)
        rows = _scored(rows, length)
        found = rows if found is None else found.unionByName(rows)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = found.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
