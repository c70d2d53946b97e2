"""N-gram Jaccard join: documents whose sets of 5-word shingles overlap by 3/4 or more.

Equal sets are one class first.  Classes that share three MinHash values (one of
``BANDS`` bands) meet in a group; two sets of similarity 3/4 miss all bands with a
probability of (37/64)^48, about 4 in 10^12.  In each group

1. every class is compared with the group's hub, the member that shares most bands,
   so the work is linear and large groups of near copies become connected;
2. what is still apart, without the hub, whose pairs were all looked at, is put into
   signature trees (see ``signatures``), and a dual traversal finds the pairs whose
   greatest possible overlap suffices.

Every candidate is verified on the exact sets.  Components of the links give the
smallest document id that can be reached.  Groups are cut by size class (similar sets
differ by a third at most) and by hash into blocks of at most ``BLOCK`` members, each
pair of blocks being a task of its own.  No pair that may be similar is left out, and
none is made between classes known to be connected.

Defined cases: a text without words has an empty set and is linked with nothing; with
fewer than five words the whole sequence is the one shingle; a null id has its shingles
counted and no component; rows of the same id are told apart by their classes, but an
id that stands for a class is linked if any of its sets is; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import settled, written
from .chunks import squeeze_sorted, unsqueeze_sorted
from .components import components
from .signatures import DENOMINATOR, NUMERATOR, Tree, possible
from .words import Words, _stream, mix, portions

WIDTH = 5
BANDS, ROWS = 48, 3
BLOCK = 4096
#: Verified pairs per task and hub.
SALT_ROWS = 2000
#: Lists of ids up to this length are broadcast; longer ones are joined.
BROADCAST_IDS = 2_000_000
#: Least and greatest bitmap, in 64-bit words.
LEAST_WORDS, MOST_WORDS = 2, 4096
_FACTORS = _stream("minhash", BANDS * ROWS) | np.uint64(1)
_SHORT = np.uint64(0x5851F42D4C957F2D)

FEATURES = "doc_id long, n long, set_a long, set_b long, bands array<long>, bits binary"


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    words = Words(texts, fold=True)
    found, at = words.windows(WIDTH)
    cut = np.searchsorted(at, words.first)
    sets = []
    for i, count in enumerate(words.counts):
        if count >= WIDTH:
            sets.append(np.unique(found[cut[i] : cut[i + 1]]))
        elif count:
            whole = np.array([count], np.uint64)
            for at_word in range(words.first[i], words.first[i + 1]):
                whole = mix(whole * _SHORT + words.hashes[at_word])
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _bits(keys: np.ndarray) -> bytes:
    """A bitmap of sixteen bits per element or more, so that few elements hide each other; its length is a power of two."""
    words = LEAST_WORDS
    while words * 4 < len(keys) and words < MOST_WORDS:
        words *= 2
    at = (mix(keys) % np.uint64(words * 64)).astype(np.int64)
    flags = np.zeros(words * 64, np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _bitmaps(column: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, folded to the shortest length among them."""
    shortest = min(len(b) for b in column) // 8
    rows = np.zeros((len(column), shortest), np.uint64)
    for i, raw in enumerate(column):
        words = np.frombuffer(raw, "<u8").reshape(-1, shortest)
        rows[i] = np.bitwise_or.reduce(words, axis=0)
    return rows


def _bands(keys: np.ndarray) -> np.ndarray:
    least = np.full(len(_FACTORS), np.uint64((1 << 64) - 1))
    for part in np.array_split(keys, 1 + len(keys) // 4096):
        if len(part):
            least = np.minimum(least, (part[None, :] * _FACTORS[:, None]).min(1))
    least = least.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in range(ROWS):
        key = mix(key * _SHORT + least[:, row])
    return key.view(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in portions(whole)):
        sets = shingle_sets(batch.column("text").to_pylist())
        a = [int(mix(s ^ _SHORT).sum().view(np.int64)) for s in sets]
        b = [int(np.bitwise_xor.reduce(mix(s + _SHORT)).view(np.int64)) if len(s) else 0 for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(a, pa.int64()),
                pa.array(b, pa.int64()), pa.array([_bands(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                pa.array([_bits(s) if len(s) else None for s in sets], pa.binary()),
            ],
            ["doc_id", "n", "set_a", "set_b", "bands", "bits"],
        )


def features(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_features, FEATURES)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in portions(whole)):
        packed = [squeeze_sorted(s) for s in shingle_sets(batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], ["id", "keys"])


def _similar(pairs: pa.Table, hubs: pa.Table) -> pa.Table:
    packed = pairs.column("keys").to_pylist()
    found = np.zeros(len(packed), bool)
    for hub in set(hubs.column("hub_keys").to_pylist()):  # several where rows of the hub's id differ
        of_hub = unsqueeze_sorted(hub)
        for i in np.flatnonzero(~found) if len(of_hub) else []:
            own = unsqueeze_sorted(packed[i])
            at = np.searchsorted(of_hub, own)
            at[at == len(of_hub)] = 0
            shared = int((of_hub[at] == own).sum())
            found[i] = DENOMINATOR * shared >= NUMERATOR * (len(own) + len(of_hub) - shared)
    return pairs.filter(pa.array(found, pa.bool_())).select(["a", "b"])


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of document ids whose exact sets are similar.

    A document many pairs share is copied to as many tasks as its pairs need.
    """
    pairs = written(pairs, "pairs")
    ids = written(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(texts.join(wanted, F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(_sets, "id long, keys binary"), "sets")
    salts = written(
        pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("long").alias("salts")), "salts"
    )
    left = pairs.join(sets, F.col("a") == F.col("id")).join(salts, "b").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), "keys"
    )
    of_hubs = sets.select(F.col("id").alias("b"), F.col("keys").alias("hub_keys"))
    right = of_hubs.join(salts.withColumnRenamed("salts", "copies"), "b").select(
        "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"), "hub_keys"
    )
    return left.groupBy("b", "salt").cogroup(right.groupBy("b", "salt")).applyInArrow(_similar, "a long, b long")


def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("n", "bits", "hub_n", "hub_bits")), strict=True)
        for n, bits, m, other in rows:
            both = _bitmaps([bits, other])
            keep.append(bool(possible(np.array([n]), both[:1], np.array([m]), both[1:])[0]))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def _traversed(group: pa.Table) -> pa.Table:
    """Candidate pairs of one block, or of two blocks, of a group."""
    ids = group.column("id").to_numpy()
    block = group.column("block").to_numpy()
    sizes = group.column("n").to_numpy()
    labels = np.unique(group.column("component").to_numpy(), return_inverse=True)[1]
    bits = _bitmaps(group.column("bits").to_pylist())
    low = block == group.column("low")[0].as_py()
    if group.column("low")[0].as_py() == group.column("high")[0].as_py():
        own = np.flatnonzero(low)
        pairs = own[Tree(sizes[own], bits[own], labels[own]).pairs()]
    elif low.all() or not low.any():
        pairs = np.zeros((0, 2), np.int64)
    else:
        a, b = np.flatnonzero(low), np.flatnonzero(~low)
        found = Tree(sizes[a], bits[a], labels[a]).pairs(Tree(sizes[b], bits[b], labels[b]))
        pairs = np.column_stack([a[found[:, 0]], b[found[:, 1]]])
    one, two = ids[pairs[:, 0]], ids[pairs[:, 1]]
    return pa.table({"a": pa.array(np.maximum(one, two), pa.int64()), "b": pa.array(np.minimum(one, two), pa.int64())})


def _blocked(members: DataFrame) -> DataFrame:
    """Members dealt to (key, class, low, high): blocks of a size class, and its neighbour's, in pairs.

    Similar sizes differ by at most 4/3, one size class.  A class and the one above
    form a cell of two halves; only pairs within the lower half or across are looked at.
    """
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3)) + 1e-9).cast("long")
    rows = written(members.withColumn("class", size_class), "members")
    counts = rows.groupBy("key", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    above = counts.select("key", (F.col("class") - 1).alias("class"), F.col("blocks").alias("blocks_above"))
    cells = counts.join(above, ["key", "class"], "left").select("key", "class", "blocks", F.coalesce("blocks_above", F.lit(0)).alias("above"))
    cells = written(cells, "cells")
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    zero = F.lit(0).cast("long")
    home = rows.join(cells, ["key", "class"]).select("key", "class", "id", "n", "bits", "component", block.alias("block"), "blocks", "above")
    # lower half: blocks 0 .. blocks - 1, upper half: blocks .. blocks + above - 1
    low = home.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") + F.col("above") - 1)))
    up = rows.withColumn("class", F.col("class") - 1).join(cells, ["key", "class"]).select(
        "key", "class", "id", "n", "bits", "component",
        (F.col("blocks") + F.pmod(F.xxhash64("id"), F.col("above"))).alias("block"), "blocks", "above",
    )
    up = up.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    return low.unionByName(up).select(
        "key", "class", "id", "n", "bits", "component", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """Rows (key, id) of keys that two ids or more have."""
    def build() -> DataFrame:
        stored = written(rows, name)
        often = written(stored.groupBy("key").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("key"), name)
        return stored.join(often, "key")

    return settled(rows.sparkSession, name, build)


def links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) between classes' least ids: enough links to connect all that are similar.

    ``found``: ``features`` of the documents, one row per class.
    """
    sets = found.select(F.col("doc_id").alias("id"), "n", "bits")
    keys = _shared(found.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key")), "band-keys")
    degree = keys.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))

    def other_members() -> DataFrame:
        """(key, id, b): the members of each group besides its hub ``b``."""
        ranked = keys.join(degree, "id")
        hubs = written(
            ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("id"))).alias("top")).select(
                "key", (-F.col("top.id")).alias("b")
            ),
            "hubs",
        )
        return keys.join(hubs, "key").filter(F.col("id") != F.col("b"))

    spark = docs.sparkSession
    others = settled(spark, "members", other_members)
    pairs = settled(spark, "hub-pairs", lambda: others.select(F.col("id").alias("a"), "b").distinct())
    sized = pairs.join(sets.withColumnRenamed("id", "a"), "a").join(
        sets.select(F.col("id").alias("b"), F.col("n").alias("hub_n"), F.col("bits").alias("hub_bits")), "b"
    )
    first = settled(spark, "links", lambda: verified(sized.mapInArrow(_may_link, "a long, b long"), docs))
    parts = settled(spark, "parts", lambda: components(first))

    def still_apart() -> DataFrame:
        """Links found in groups that hold more than one component besides their hub."""
        labelled = others.join(parts, F.col("id") == F.col("node"), "left").select(
            "key", "id", F.coalesce("component", "id").alias("component")
        )
        labelled = written(labelled, "labelled")
        apart = labelled.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        apart = written(apart.filter("least <> most").select("key"), "apart")
        members = labelled.join(apart, "key").join(sets, "id")
        cells = _blocked(members)
        second = cells.groupBy("key", "class", "low", "high").applyInArrow(_traversed, "a long, b long").distinct()
        second = second.join(pairs, ["a", "b"], "left_anti")  # looked at before
        second = second.join(pairs.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
        return verified(second, docs)

    return first.unionByName(settled(spark, "links", still_apart))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every document."""
    return settled(docs.sparkSession, "placed", lambda: _placed(docs))


def _placed(docs: DataFrame) -> DataFrame:
    all_rows = written(features(docs), "features")
    classes = written(
        all_rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "set_a", "set_b").agg(F.min("doc_id").alias("class_id")),
        "classes",
    )
    same = ["n", "set_a", "set_b"]
    first = all_rows.join(classes, same).filter("doc_id = class_id").dropDuplicates(["doc_id", *same])
    linked = settled(docs.sparkSession, "links", lambda: links(docs, first))
    found = settled(docs.sparkSession, "components", lambda: components(linked))
    merged = classes.join(found, F.col("class_id") == F.col("node"), "left").select(
        *same, "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    joined = all_rows.select("doc_id", *same).join(written(merged, "classes"), same, "left")
    alone = F.col("class_id").isNull() | F.col("doc_id").isNull()
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
