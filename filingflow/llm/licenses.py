"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

A text's words (A-Z folded, common punctuation dropped) give 3-word shingles.  They
are cut into blocks of four; a window is 2, 4, 8, ... neighbouring blocks and starts
at every block, so its MinHash is the least of its blocks' and each shingle is hashed
once per band.  A template is looked for in the smallest window that must hold it
wholly wherever it lies.  Its Jaccard similarity with that window is at least 3/8 if
it has three shingles or more; with ``BANDS`` bands of one row it is missed with a
probability of at most (5/8)^24, about 1 in 80,000.  A window that shares a band with
a template is a candidate; it counts if it holds ``MIN_CONTAINMENT`` of the
template's shingles.

A window can only share a value with a template if it holds that shingle of it, so the
minima are taken in documents that have a shingle of some template; others are left out before.
A window can only share a value if one of its blocks does.  A document none of whose
blocks shares a value with a template goes no further; of the others the blocks that do
are exploded, each with its surroundings, so a long text is never copied per window.  The templates
are a parameter; their bands are broadcast, so their number is limited.

Defined cases: a null or short text has no shingles and no license; repeated ids are
one document, each of its texts being verified by itself (texts are told apart by a
64-bit hash), and of repeated texts one counts; a template of fewer than three shingles is refused; of equal matches of
a template the first place counts; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.once import computed_once
from .text import fold_ascii, replaced, text_of, words_of

# Notices as licenses ask for them or as they are usual.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
PUNCTUATION = ".,;:()\"'"
SHINGLE, BLOCK = 3, 4
BANDS = 24
MIN_CONTAINMENT = 0.75
MAX_TEMPLATES = 10_000


def seeds(bands: int) -> list[int]:
    """A 64-bit number per band whose leading bits differ as evenly as they can."""
    golden, signed = 0x9E3779B97F4A7C15, 1 << 63
    return [((i * golden) % (1 << 64)) - signed for i in range(1, bands + 1)]


def shingles_of(words: Column) -> Column:
    """Hashes of all 3-word shingles in order; ``words`` must be a plain column."""
    found = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) >= SHINGLE, found).otherwise(F.expr("array()").cast("array<bigint>"))


def _hashed(docs: DataFrame, keep: list[str]) -> DataFrame:
    plain = replaced(fold_ascii(text_of(F.col("text"))), PUNCTUATION, " ")
    rows = computed_once(docs, keep, words=words_of(plain))
    return computed_once(rows, keep, shingles=shingles_of(F.col("words")))


def _block_minima(shingles: Column, bands: int) -> Column:
    """Per block of ``BLOCK`` shingles an array of ``bands`` minima."""
    marks = F.array(*[F.lit(s).cast("long") for s in seeds(bands)])
    starts = F.sequence(F.lit(1), F.size(shingles), F.lit(BLOCK))
    found = F.transform(
        starts,
        lambda at: F.transform(
            marks, lambda s: F.array_min(F.transform(F.slice(shingles, at, BLOCK), lambda x: x.bitwiseXOR(s)))
        ),
    )
    return F.when(F.size(shingles) > 0, found)


def template_bands(spark: SparkSession, templates: dict[str, str], bands: int) -> DataFrame:
    """(license, shingles, blocks, minima): ``blocks`` is the width of the windows a template is sought in."""
    if not 0 < len(templates) <= MAX_TEMPLATES:
        raise ValueError(f"1 to {MAX_TEMPLATES} templates, not {len(templates)}")
    if any(len(t.split()) < 2 * SHINGLE - 1 for t in templates.values()):
        raise ValueError(f"a template is too short for {SHINGLE} shingles")
    rows = _hashed(spark.createDataFrame(list(templates.items()), "license string, text string"), ["license"])
    n = F.size("shingles")
    # a template of n shingles lies within ceil((n - 1) / BLOCK) + 1 blocks; take the next power of two
    needed = F.ceil((n - 1) / BLOCK) + 1
    blocks = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(needed, F.lit(2)).cast("double")))).cast("int")
    marks = F.array(*[F.lit(s).cast("long") for s in seeds(bands)])
    minima = F.transform(marks, lambda s: F.array_min(F.transform("shingles", lambda x: x.bitwiseXOR(s))))
    return rows.select(
        "license", F.array_distinct("shingles").alias("wanted"), blocks.alias("blocks"), minima.alias("minima")
    )


def licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    bands: int = BANDS,
    min_containment: float = MIN_CONTAINMENT,
) -> DataFrame:
    """(doc_id, license, containment, n_windows, first_word) for each license found in a document."""
    spark = docs.sparkSession
    known = template_bands(spark, templates or TEMPLATES, bands)
    every = known.agg(F.array_distinct(F.flatten(F.collect_list("minima"))).alias("values"))
    widths = known.agg(F.sort_array(F.collect_set("blocks")).alias("widths"))
    sought = known.agg(F.array_distinct(F.flatten(F.collect_list("wanted"))).alias("sought"))
    rows = _hashed(docs.select("doc_id", F.xxhash64("text").alias("version"), "text"), ["doc_id", "version"])
    rows = rows.filter(F.arrays_overlap("shingles", sought.scalar()))
    rows = computed_once(rows, ["doc_id", "version", "shingles"], minima=_block_minima(F.col("shingles"), bands))
    hit = rows.filter(F.arrays_overlap(F.flatten("minima"), every.scalar()))
    hit = computed_once(hit, hit.columns, known=every.scalar(), widths=widths.scalar())
    zero = F.lit(0)
    # blocks that share a value with a template, each with what lies within the widest window of it
    block = F.filter(
        F.sequence(zero, F.size("minima") - 1), lambda b: F.arrays_overlap(F.get(F.col("minima"), b), F.col("known"))
    )
    widest = F.array_max("widths")

    def near(b: Column) -> Column:
        first = F.greatest(b - widest + 1, zero)
        return F.struct(
            b.alias("hit"), first.alias("first"),
            F.slice("minima", first + 1, b - first + widest).alias("near"),
            F.slice("shingles", first * BLOCK + 1, (b - first + widest) * BLOCK).alias("around"),
        )

    places = computed_once(hit, ["doc_id", "version", "shingles", "minima", "widths", "known"], blocks=block)
    places = places.select("doc_id", "version", "widths", F.inline(F.transform("blocks", near)))
    # all windows, of each width, that hold the block; the last ones are cut short by the text's end
    windows = places.withColumn("blocks", F.explode("widths"))
    windows = windows.withColumn(
        "block", F.explode(F.sequence(F.greatest(F.col("hit") - F.col("blocks") + 1, zero), F.col("hit")))
    )
    at = F.col("block") - F.col("first")
    windows = computed_once(
        windows,
        ["doc_id", "version", "blocks", "block"],
        signature=F.aggregate(
            F.slice("near", at + 1, F.col("blocks")),
            F.get("near", at),
            lambda a, b: F.zip_with(a, b, lambda x, y: F.least(x, y)),
        ),
        held=F.slice("around", at * BLOCK + 1, F.col("blocks") * BLOCK),
    )
    probes = windows.select(
        "doc_id", "version", "blocks", "block", "held", F.posexplode("signature").alias("band", "value")
    )
    index = known.select("license", "wanted", "blocks", F.posexplode("minima").alias("band", "value"))
    candidates = (
        probes.join(F.broadcast(index), ["blocks", "band", "value"])
        .groupBy("doc_id", "version", "license", "block")
        .agg(F.first("held").alias("held"), F.first("wanted").alias("wanted"))
    )
    shared = F.size(F.array_intersect("held", "wanted"))
    at = F.array_position(F.transform("held", lambda x: F.array_contains(F.col("wanted"), x)), True)
    verified = candidates.select(
        "doc_id", "license", (shared / F.size("wanted")).alias("containment"),
        (F.col("block") * BLOCK + at - 1).cast("long").alias("first_word"),
    ).filter(F.col("containment") >= min_containment)
    best = F.max(F.struct("containment", (-F.col("first_word")).alias("at")))
    return (
        verified.groupBy("doc_id", "license")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n_windows"))
        .select("doc_id", "license", F.col("best.containment").alias("containment"), "n_windows",
                (-F.col("best.at")).alias("first_word"))
    )
