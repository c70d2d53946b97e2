"""Near-duplicate join by chosen paths: sets of 4-word shingles that overlap by 4/5 or more.

Equal sets are one class.  A class is reduced to ``COORDINATES`` minwise tokens.  A tree
begins with the path of ``TRUNK`` tokens at coordinates of its own: texts that have little
in common seldom share three, so most nodes hold one class and end at once.  From there it
branches recursively: a node picks two coordinates by its own hash, and a class goes to the
child named by the token it has there, once per coordinate.  Two sets of similarity 4/5
share a token at a coordinate with probability 0.8, so a pair is lost below the trunk, at
any depth, with probability q = (1 - 0.8 (1 - q))^2 = 1/16 at most, by a tree with
1 - 0.8^3 (1 - q) = 0.52, and by all ``TREES`` with less than 1 in 10^9.  Nodes whose
classes are known to be connected end too.  In every other node

1. each class is compared with the node's first, and each class is verified with the one of
   those it agrees with most, so large groups of near copies become connected with a
   comparison per class;
2. nodes that are still apart are cut into blocks of ``SMALL`` classes, and all pairs of
   blocks are compared exhaustively, except for pairs known to be connected.  Nodes of more
   than ``BLOCKS`` blocks, which would copy a class as often as two levels do, branch again,
   and after ``LEVELS`` levels what is left is compared like the smaller ones.

A comparison takes two steps, each inside the node's task.  First the ids are found that
agree with one of another component on ``AGREE`` of the first ``SEEN`` coordinates or more
(similar sets agree on fewer with a probability below 1 in 10^8).  Only these, which are few
among texts that met by chance, get a bitmap of their elements and are compared again: a bit
that only one has stands for an element that only it has, which bounds the overlap exactly.
Few but similar pairs leave the task, also where thousands of texts are somewhat alike, and
these are verified on their whole sets.
Components of the links, over document ids, give the smallest id that is reached.

Defined cases: a text without words has an empty set and is linked with nothing; with
fewer than four words the whole sequence is the one shingle; a null id has its shingles
counted, no component, and is kept; rows of one id are one node of the graph, which all
their sets' links reach; repeated rows are alike; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.placed_join import likely
from ..session import settled, written
from .components import components
from .words import Words, _stream, mix, portions

WIDTH = 4
#: Similarity in percent.
SIMILAR = 80
TREES, TRUNK = 32, 3
#: Coordinates that a level after the first picks from.
SPAN, LEVELS = 8, 4
COORDINATES = TREES * TRUNK + SPAN * (LEVELS - 1)
SMALL, BLOCKS, SEEN, AGREE = 1024, 4, 64, 28
#: Bytes of a token.
TOKEN = 2
#: Bits of an element's bitmap at least, and its greatest length in 64-bit words.
SPARSE, MOST_WORDS = 8, 4096
#: Verified pairs per task and document.
SALT_ROWS = 500
_FACTORS = _stream("chosen path", COORDINATES) | np.uint64(1)
_SHORT = np.uint64(0x5851F42D4C957F2D)

FEATURES = "doc_id long, n long, set_a long, set_b long, tokens binary"


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
            for word in range(words.first[i], words.first[i + 1]):
                whole = mix(whole * _SHORT + words.hashes[word])
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minwise(keys: np.ndarray) -> np.ndarray:
    """The token of each coordinate: 16 bits of the least hash."""
    least = np.full(COORDINATES, np.uint64((1 << 64) - 1))
    for part in np.array_split(keys, 1 + len(keys) // 4096):
        least = np.minimum(least, (part[None, :] * _FACTORS[:, None]).min(1))
    return mix(least).astype("<u2")


def bitmap(keys: np.ndarray) -> bytes:
    """A bit for each element; the length is a power of two."""
    words = 1
    while words * 64 < SPARSE * len(keys) and words < MOST_WORDS:
        words *= 2
    flags = np.zeros(words * 64, np.uint8)
    flags[(mix(keys) % np.uint64(words * 64)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _features(marked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in portions(whole)):
            sets = shingle_sets(batch.column("text").to_pylist())
            a = [int(mix(s ^ _SHORT).sum().view(np.int64)) for s in sets]
            b = [int(np.bitwise_xor.reduce(mix(s + _SHORT)).view(np.int64)) if len(s) else 0 for s in sets]
            columns = {
                "doc_id": batch.column("doc_id"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "set_a": pa.array(a, pa.int64()), "set_b": pa.array(b, pa.int64()),
                "tokens": pa.array([minwise(s).tobytes() if len(s) >= WIDTH else None for s in sets], pa.binary()),
            }
            if marked:
                columns["bits"] = pa.array([bitmap(s) if len(s) >= WIDTH else None for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def features(docs: DataFrame, marked: bool = False) -> DataFrame:
    """Size, hashes and tokens of each text's set; ``marked`` adds its bitmap."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_features(marked), FEATURES + (", bits binary" if marked else ""))


# --- verification ----------------------------------------------------------------


def _similar(own: np.ndarray, other: np.ndarray) -> bool:
    if not len(own) or not len(other):
        return False
    at = np.searchsorted(other, own)
    at[at == len(other)] = 0
    shared = int((other[at] == own).sum())
    return 100 * shared >= SIMILAR * (len(own) + len(other) - shared)


def _verify(pairs: pa.Table, others: pa.Table) -> pa.Table:
    """Those of the pairs (a, b) whose texts' sets are similar; the group has one b."""
    found = np.zeros(pairs.num_rows, bool)
    of_b = shingle_sets(list(set(others.column("other_text").to_pylist())))  # several where rows of an id differ
    at = 0
    for batch in pairs.select(["text"]).combine_chunks().to_batches():
        for part in portions(batch):
            for own in shingle_sets(part.column("text").to_pylist()):
                found[at] = any(_similar(own, other) for other in of_b)
                at += 1
    return pairs.filter(pa.array(found)).select(["a", "b"])


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the written pairs (a, b) of ids that are similar on their whole sets.

    A Bloom filter next to the scan keeps other texts out of the joins.  The texts of the
    ids ``b``, of which some have many pairs, are copied to as many tasks as the pairs need.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    texts = likely(texts.filter("doc_id IS NOT NULL"), ids, "doc_id", ids.count())
    salts = written(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("long").alias("salts")), "salts")
    left = pairs.join(salts, "b").join(texts, F.col("a") == F.col("doc_id")).select(
        "a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), "text"
    )
    right = salts.withColumnRenamed("b", "other").join(texts, F.col("other") == F.col("doc_id")).select(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("other_salt"), F.col("text").alias("other_text")
    )
    return left.groupBy("b", "salt").cogroup(right.groupBy("other", "other_salt")).applyInArrow(_verify, "a long, b long").distinct()


# --- the trees -------------------------------------------------------------------


def roots(sets: DataFrame) -> DataFrame:
    """(node, id, component): the trunk of every tree."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    path = F.substring("tokens", F.col("tree") * (TRUNK * TOKEN) + 1, F.lit(TRUNK * TOKEN))
    return sets.select("id", "tokens", trees).select(F.xxhash64("tree", path).alias("node"), "id", F.col("id").alias("component"))


def children(members: DataFrame, level: int) -> DataFrame:
    """(node, id, component) of the next level; ``members`` have ``tokens``.  A node picks two of the level's coordinates."""
    first = TREES * TRUNK + SPAN * (level - 2)
    one = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(SPAN))
    two = F.pmod(one + 1 + F.pmod(F.xxhash64("node", F.lit(-level)), F.lit(SPAN - 1)), F.lit(SPAN))
    picked = members.select("node", "id", "component", "tokens", F.explode(F.array(one, two)).alias("pick"))
    token = F.substring("tokens", ((F.col("pick") + first) * TOKEN + 1).cast("int"), F.lit(TOKEN))
    return picked.select(F.xxhash64("node", "pick", token).alias("node"), "id", "component").distinct()


def _tokens(column: pa.Array) -> np.ndarray:
    """Tokens as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, first, agree) of the pairs that agree on ``AGREE`` coordinates or more."""
    for batch in batches:
        if batch.num_rows:
            agree = (_tokens(batch.column("seen")) == _tokens(batch.column("others"))).sum(1)
            rows = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("first"), pa.array(agree, pa.int64())], ["id", "first", "agree"])
            yield rows.filter(pa.array(agree >= AGREE))


def first_pairs(members: DataFrame, firsts: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): each id with the one, among the first ids of its nodes, that it agrees with most.

    Links make components, so one per class serves here; what stays apart is compared in full.
    """
    of_first = members.select("node", F.col("id").alias("first"), F.col("component").alias("known"))
    met = members.join(firsts.join(of_first, ["node", "first"]), "node").filter("component <> known").select("id", "first").distinct()
    own = sets.select("id", "n", "seen")
    other = sets.select(F.col("id").alias("first"), F.col("n").alias("m"), F.col("seen").alias("others"))
    sized = met.join(own, "id").join(other, "first").filter(F.least("n", "m") * 100 >= F.greatest("n", "m") * SIMILAR)
    best = sized.select("id", "first", "seen", "others").mapInArrow(_agreeing, "id long, first long, agree long").groupBy("id").agg(
        F.max(F.struct("agree", (-F.col("first")).alias("less"))).alias("best")
    )
    return best.select(F.col("id").alias("a"), (-F.col("best.less")).alias("b"))


class _Bitmaps:
    """Bitmaps of different lengths, which are folded where two are compared."""

    def __init__(self, column: list[bytes]) -> None:
        self.words = np.array([len(b) // 8 for b in column])
        self.place = np.zeros(len(column), np.int64)
        self.rows: dict[int, np.ndarray] = {}
        for words in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == words)
            self.place[at] = np.arange(len(at))
            self.rows[words] = np.frombuffer(b"".join(column[i] for i in at), "<u8").reshape(-1, words)

    def possible(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the sets of the rows ``i`` and ``j``, of sizes ``n``, may be similar."""
        found = np.zeros(len(i), bool)
        for one, two in np.unique(np.column_stack([self.words[i], self.words[j]]), axis=0).tolist():
            at = np.flatnonzero((self.words[i] == one) & (self.words[j] == two))
            for part in np.array_split(at, 1 + len(at) // 4096):
                x, y = self.rows[one][self.place[i[part]]], self.rows[two][self.place[j[part]]]
                short = min(one, two)
                x, y = (np.bitwise_or.reduce(z.reshape(len(part), -1, short), axis=1) for z in (x, y))
                only = [np.bitwise_count(z).sum(1, dtype=np.int64) for z in (x & ~y, y & ~x)]
                most = np.minimum(n[i[part]] - only[0], n[j[part]] - only[1])
                found[part] = 100 * most >= SIMILAR * (n[i[part]] + n[j[part]] - most)
        return found


def _close(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of a cell that are of different components, of like size, and agree."""
    cell, n, component, block, whole = (table.column(c).to_numpy() for c in ("cell", "n", "component", "block", "whole"))
    tokens = _tokens(table.column("seen"))
    for step in range(1, table.num_rows):
        i = np.flatnonzero(cell[:-step] == cell[step:])
        if not len(i):
            break
        j = i + step
        keep = (component[i] != component[j]) & (whole[i] | (block[i] != block[j]))
        keep &= 100 * np.minimum(n[i], n[j]) >= SIMILAR * np.maximum(n[i], n[j])
        i, j = i[keep], j[keep]
        same = (tokens[i] == tokens[j]).sum(1) >= AGREE
        yield i[same], j[same]


def _ids_close(table: pa.Table) -> pa.RecordBatch:
    """The ids that have another one close to them."""
    ids = table.column("id").to_numpy()
    found = np.zeros(len(ids), bool)
    for i, j in _close(table):
        found[i] = found[j] = True
    return pa.RecordBatch.from_arrays([pa.array(np.unique(ids[found]), pa.int64())], ["id"])


def _pairs_possible(table: pa.Table) -> pa.RecordBatch:
    """The close pairs that may be similar by their bitmaps."""
    ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
    bits = _Bitmaps(table.column("bits").to_pylist())
    found = [np.zeros((0, 2), np.int64)]
    for i, j in _close(table):
        same = bits.possible(i, j, n)
        found.append(np.column_stack([ids[i[same]], ids[j[same]]]))
    both = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(both.max(1, initial=-1 << 63)), pa.array(both.min(1, initial=(1 << 63) - 1))], ["a", "b"])


def _by_cells(make):
    """``make`` of whole cells; rows come sorted by cell, which has 2 x ``SMALL`` rows at most, or some more by chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not table.num_rows:
                continue
            cell = table.column("cell").to_numpy()
            last = int(np.searchsorted(cell, cell[-1]))
            held = table.slice(last)
            if last:
                yield make(table.slice(0, last))
        if held is not None and held.num_rows:
            yield make(held)

    return run


def _cells(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of whole nodes, sorted by cell: each block of ``SMALL`` classes with itself and each other.

    ``members``: node, id, component, n, seen, or more; ``sizes``: node, times.  A node of one block is one cell.
    """
    blocks = F.ceil(F.col("times") / SMALL).cast("long")
    zero = F.lit(0).cast("long")
    dealt = members.join(sizes.withColumn("blocks", blocks), "node").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    more = [c for c in members.columns if c != "node"]
    cells = dealt.select(F.xxhash64("node", low, high).alias("cell"), "block", (low == high).alias("whole"), *more)
    return cells.repartition("cell").sortWithinPartitions("cell")


def compared(labelled: DataFrame, sizes: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of whole nodes; ``labelled``: node, id, component; ``sizes``: node, times."""
    rows = labelled.join(sizes.select("node"), "node").join(sets.select("id", "n", "seen"), "id")
    close = _cells(rows, sizes).mapInArrow(_by_cells(_ids_close), "id long").distinct()
    close = written(close.withColumnRenamed("id", "doc_id"), "close")
    times = close.count()
    if not times:
        return close.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = features(likely(texts.filter("doc_id IS NOT NULL"), close, "doc_id", times).join(close, "doc_id", "left_semi"), marked=True)
    marked = marked.filter("tokens IS NOT NULL").dropDuplicates(["doc_id", "n", "set_a", "set_b"])
    marked = written(marked.select(F.col("doc_id").alias("id"), "n", F.substring("tokens", 1, SEEN * TOKEN).alias("seen"), "bits"), "marked")
    rows = labelled.join(sizes.select("node"), "node").join(marked, "id")
    return _cells(rows, sizes).mapInArrow(_by_cells(_pairs_possible), "a long, b long").distinct()


def links(docs: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """Links (a, b) between ids, enough to connect all that are similar.

    ``sets``: id, n and tokens of the classes; ``known``: links there are already.
    """
    spark = docs.sparkSession
    members = roots(sets)
    sets = sets.withColumn("seen", F.substring("tokens", 1, SEEN * TOKEN))
    found = written(known, "links")
    for level in range(1, LEVELS + 1):
        ends = [F.min("component").alias("one"), F.max("component").alias("two")]
        nodes = members.groupBy("node").agg(F.min("id").alias("first"), *ends).filter("one <> two")
        nodes = written(nodes.select("node", "first"), "nodes")
        if nodes.isEmpty():
            break
        members = written(members.join(nodes.select("node"), "node"), "members")
        hubs = written(first_pairs(members, nodes, sets), "first-pairs")
        if not hubs.isEmpty():
            found = settled(spark, "links", lambda found=found, hubs=hubs: found.unionByName(verified(hubs, docs)))
        parts = settled(spark, "parts", lambda found=found: components(found))
        labelled = members.select("node", "id").join(parts.select(F.col("node").alias("of"), "component"), F.col("id") == F.col("of"), "left")
        labelled = written(labelled.select("node", "id", F.coalesce("component", "id").alias("component")), "labelled")
        apart = labelled.groupBy("node").agg(F.count(F.lit(1)).alias("times"), *ends)
        apart = written(apart.filter("one <> two").select("node", "times"), "apart")
        small = apart if level == LEVELS else apart.filter(F.col("times") <= SMALL * BLOCKS)
        pairs = settled(spark, "pairs", lambda labelled=labelled, small=small: compared(labelled, small, sets, docs))
        if not pairs.isEmpty():
            found = settled(spark, "links", lambda found=found, pairs=pairs: found.unionByName(verified(pairs, docs)))
        large = apart.filter(F.col("times") > SMALL * BLOCKS)
        if level == LEVELS or large.isEmpty():
            break
        members = children(labelled.join(large.select("node"), "node").join(sets, "id"), level + 1)
        members = written(members, "members")
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, kept) of every document."""
    same = ["n", "set_a", "set_b"]
    rows = written(features(docs), "features")
    named = rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(named.groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.first("tokens").alias("tokens")), "classes")
    ids = named.select("doc_id", *same).distinct()
    several = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("doc_id")
    known = ids.join(several, "doc_id").join(classes.select(*same, "class_id"), same).filter("doc_id <> class_id").select(
        F.col("doc_id").alias("a"), F.col("class_id").alias("b")
    )
    sets = classes.filter("tokens IS NOT NULL").select(F.col("class_id").alias("id"), "n", "tokens")
    linked = settled(docs.sparkSession, "links", lambda: links(docs, sets, known))
    parts = settled(docs.sparkSession, "parts", lambda: components(linked))
    merged = classes.join(parts, F.col("class_id") == F.col("node"), "left").select(
        *same, "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    joined = rows.select("doc_id", *same).join(written(merged, "classes"), same, "left")
    alone = F.col("class_id").isNull() | F.col("doc_id").isNull()
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
