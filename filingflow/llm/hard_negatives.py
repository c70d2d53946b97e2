"""Hard negatives by inner product, found in cover trees over norm-augmented vectors.

A vector x of integers gets one more coordinate, sqrt(M^2 - |x|^2), M being the greatest
norm of all, so that all lie on one sphere and the order by inner product is that by
distance.  The top level of the tree is one set of centres for all vectors, picked
farthest first from a bounded sample; every vector belongs to its nearest centre's cell,
whose covering radius is the distance of its farthest member.  A cell is cut by hash into
parts of about ``PART`` vectors, so a cell that holds a third of all is many tasks, and
each part has a cover tree: under a node of radius r the children are more than r /
``SHRINK`` apart and each point is within that of its child, down to ``LEAF`` points; a
label has its own trees.

For a query q and a node with centre c and covering radius r, d = |q - c|, all inner
products below the node lie within q.c - min(|q| r, d r + r^2 / 2) and
q.c + min(|q| r, d m - m^2 / 2) with m = min(r, d).  A request asks for the k best scores in a window, among
rows of the anchor's label or of the others.  Cells outside all windows of an anchor get no
copy of it; in a part the node with the greatest bound is opened first, requests whose
window or k-th best score lies outside a node's bounds do not follow, and leaves are
verified with exact integer products.  Only the best k of a part go on.

1. Positives: the ``PILOT`` cells with the best bounds first; the k-th score found there
   is the lower end of the window for all other cells.
2. Negatives: a window per positive.

Defined cases: vectors that are null, empty or hold null or non-finite numbers take no
part, nor do rows with a null id or label or of another length than most vectors have;
zero vectors do; components are held within +-sqrt(2^63 / length), so that scores fit 64
bits; of rows with one id the anchor is the one with the smallest label and vector, and
each is a candidate, but not for an anchor of that id; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import written
from .chunks import squeeze, unsqueeze

POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score that a negative has at least and at most.
LOW, HIGH = 30, 90
#: Vectors the centres are picked from, at most about, and the most centres.
SAMPLE, MAX_CELLS = 20_000, 1024
PART, QUERY_PART = 4096, 1024
LEAF, SHRINK = 32, 1.5
PILOT = 4
SEED = 12
_FAR = (1 << 63) - 1

REQUEST = "anchor_id long, label long, wants array<struct<no:int,low:long,high:long>>, v array<double>"
FOUND = "anchor_id long, no int, vec_id long, score long"


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def augmented(x: np.ndarray, most: float) -> np.ndarray:
    """``x`` with the coordinate that brings every norm to ``most``."""
    return np.column_stack([x, np.sqrt(np.maximum(most**2 - (x * x).sum(1), 0))])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers."""
    if a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(s: np.ndarray, norms: np.ndarray, r: np.ndarray | float, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of queries with the points within ``r`` of centres, ``s`` being those with the centres."""
    d = np.sqrt(np.maximum(norms**2 + most**2 - 2 * s, 0))
    m = np.minimum(r, d)
    slack = 1e-9 * (np.abs(s) + norms * most) + 1
    return s - np.minimum(norms * r, d * r + r * r / 2) - slack, s + np.minimum(norms * r, d * m - m * m / 2) + slack


def farthest_first(points: np.ndarray, most: int, within: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres picked farthest first until all points are ``within`` reach of one: rows, nearest centre, distance."""
    rows = [0]
    distance = np.sqrt(((points - points[0]) ** 2).sum(1))
    nearest = np.zeros(len(points), np.int64)
    while len(rows) < most:
        far = int(distance.argmax())
        if distance[far] <= within:
            break
        reach = np.sqrt(((points - points[far]) ** 2).sum(1))
        closer = reach < distance
        distance[closer], nearest[closer] = reach[closer], len(rows)
        rows.append(far)
    return np.array(rows), nearest, distance


class CoverTree:
    """Nodes of trees over one part: each has a centre, a radius and a run of points or of children."""

    FIELDS = (("centre", "<i4"), ("radius", "<f8"), ("first", "<i4"), ("last", "<i4"), ("leaf", "<i1"), ("roots", "<i4"))

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, most: float) -> None:
        """Points are sorted by label; ``roots`` are the nodes that stand for a label's points."""
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.x, self.most = ids[order], labels[order], x[order], most
        self._nodes: list[list] = []
        points = augmented(self.x, most)
        edges = np.append(np.flatnonzero(np.diff(self.labels, prepend=self.labels[:1] - 1)), len(ids))
        self._order = np.arange(len(ids))
        heads = [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        work = []
        for a, b in heads:
            radius = np.sqrt(((points[a:b] - points[a]) ** 2).sum(1).max())
            work.append(self._node(a, radius, a, b))
        roots = list(range(len(work)))
        while work:
            node = work.pop()
            centre, radius, a, b, _ = self._nodes[node]
            if b - a <= LEAF or radius == 0:
                continue
            at = self._order[a:b]
            own = np.concatenate([[centre], at[at != centre]])
            rows, nearest, distance = farthest_first(points[own], len(own), radius / SHRINK)
            groups = np.argsort(nearest, kind="stable")
            self._order[a:b] = own[groups]
            ends = a + np.cumsum(np.bincount(nearest, minlength=len(rows)))
            first = len(self._nodes)
            for i, end in enumerate(ends):
                mine = nearest == i
                work.append(self._node(own[rows[i]], distance[mine].max(), end - int(mine.sum()), end))
            self._nodes[node][2:] = [first, len(self._nodes), 0]
        columns = list(zip(*self._nodes, strict=True))
        self.centre, self.radius = np.array(columns[0]), np.array(columns[1], float)
        self.first, self.last, self.leaf = (np.array(c) for c in columns[2:])
        self.roots = np.array(roots)

    def _node(self, centre: int, radius: float, a: int, b: int) -> int:
        self._nodes.append([centre, radius, a, b, 1])
        return len(self._nodes) - 1

    def packed(self) -> dict[str, bytes]:
        made = {n: squeeze(np.asarray(getattr(self, n)).astype(t)) for n, t in self.FIELDS}
        return made | {
            "order": squeeze(self._order.astype("<i4")), "ids": squeeze(self.ids.astype("<i8")),
            "labels": squeeze(self.labels.astype("<i8")), "x": squeeze(self.x.astype("<f8").ravel()),
        }

    @classmethod
    def unpacked(cls, row: dict, dim: int, most: float) -> CoverTree:
        tree = cls.__new__(cls)
        for name, kind in (*cls.FIELDS, ("ids", "<i8"), ("labels", "<i8")):
            setattr(tree, name, unsqueeze(row[name], kind))
        tree._order, tree.most = unsqueeze(row["order"], "<i4"), most
        tree.x = unsqueeze(row["x"], "<f8").reshape(-1, dim)
        return tree

    def bounds(self, node: int, q: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each query with the points below a node."""
        return bounds(q @ self.x[self.centre[node]], norms, self.radius[node], self.most)

    def search(
        self, q: np.ndarray, anchor: np.ndarray, label: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray,
        k: int, same: bool,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(request, id, score) of the k best of each request.

        ``q``: vectors; per request: ``own`` its row in ``q``, ``anchor`` its id, its label and window.
        """
        n = len(own)
        norms = np.sqrt((q * q).sum(1))
        best = np.full((n, k), -_FAR - 1, np.int64)
        names = np.full((n, k), _FAR, np.int64)
        heap: list[tuple] = []

        def enter(node: int, alive: np.ndarray) -> None:
            least, most = self.bounds(node, q[own[alive]], norms[own[alive]])
            keep = (most >= np.maximum(low[alive], best[alive, -1])) & (least <= high[alive])
            if keep.any():
                heapq.heappush(heap, (-most[keep].max(), node, alive[keep], most[keep]))

        for root in self.roots:
            mine = label == self.labels[self.centre[root]]
            alive = np.flatnonzero(mine if same else ~mine)
            if len(alive):
                enter(int(root), alive)
        while heap:
            _, node, alive, most = heapq.heappop(heap)
            alive = alive[most >= best[alive, -1]]
            if not len(alive):
                continue
            a, b = self.first[node], self.last[node]
            if not self.leaf[node]:
                for child in range(a, b):
                    enter(child, alive)
                continue
            at = self._order[a:b]
            rows, place = np.unique(own[alive], return_inverse=True)
            scores = products(q[rows], self.x[at])[place]
            fits = (scores >= low[alive][:, None]) & (scores <= high[alive][:, None]) & (self.ids[at] != anchor[alive][:, None])
            some = fits.any(1)
            alive, scores, fits = alive[some], scores[some], fits[some]
            every = np.concatenate([best[alive], np.where(fits, scores, -_FAR - 1)], axis=1)
            ids = np.concatenate([names[alive], np.where(fits, self.ids[at], _FAR)], axis=1)
            order = np.lexsort((ids, -np.maximum(every, -_FAR)), axis=-1)[:, :k]
            best[alive], names[alive] = np.take_along_axis(every, order, 1), np.take_along_axis(ids, order, 1)
        request, place = np.nonzero(best > -_FAR - 1)
        return request, names[request, place], best[request, place]


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd


def prepared(table: DataFrame) -> tuple[DataFrame, int] | None:
    """(vec_id, label, v) of the rows that take part, and the length of ``v``; none without such rows."""
    good = table.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("embedding")))
    size = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if size is None:
        return None
    dim = size["dim"]
    limit = float(int((2.0**63 / dim) ** 0.5) - 1)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))

    def whole(x: Column) -> Column:
        scaled = 256 * F.greatest(F.least(x.cast("double"), F.lit(limit / 256)), F.lit(-limit / 256))
        return F.floor(scaled).cast("double")

    rows = good.filter(F.size("embedding") == dim).select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"), F.transform("embedding", whole).alias("v")
    )
    return written(rows, "whole-vectors"), dim


class Index:
    """Cells with their radii, and the parts' trees as a table (cell, part, ...)."""

    def __init__(self, rows: DataFrame, dim: int) -> None:
        self.dim = dim
        norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
        total = rows.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(norm)).alias("most")).first()
        self.most = most = total["most"] * (1 + 1e-12)
        place = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1_000_003)) / F.lit(1_000_003)
        drawn = rows.filter(place <= min(1.0, SAMPLE / total["n"])).select("vec_id", "v").toArrow().sort_by("vec_id")
        if drawn.num_rows == 0:  # a handful of rows, none of them drawn
            drawn = rows.select("vec_id", "v").limit(1).toArrow()
        sample = _matrix(drawn.column("v"), dim)
        picked, _, _ = farthest_first(augmented(sample, most), max(1, min(MAX_CELLS, int(total["n"] ** 0.5))))
        self.centres = sample[picked]
        lifted = augmented(self.centres, most)
        square = (lifted * lifted).sum(1)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = augmented(_matrix(batch.column(2), dim), most)
                cell = (square - 2 * x @ lifted.T).argmin(1)
                distance = np.sqrt(((x - lifted[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell, pa.int32()), pa.array(distance)], [*batch.schema.names, "cell", "distance"]
                )

        placed = written(
            rows.select("vec_id", "label", "v").mapInArrow(assign, "vec_id long, label long, v array<double>, cell int, distance double"), "placed"
        )
        cells = written(
            placed.groupBy("cell").agg(F.max("distance").alias("radius"), F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")), "cells"
        )
        self.cells = F.broadcast(cells.select("cell", "parts"))  # MAX_CELLS rows at most
        self.radii = np.full(len(picked), -1.0)
        for row in cells.collect():
            self.radii[row["cell"]] = row["radius"]
        names = [n for n, _ in CoverTree.FIELDS] + ["order", "ids", "labels", "x"]

        def build(group: pa.Table) -> pa.Table:
            tree = CoverTree(
                group.column("vec_id").to_numpy(), group.column("label").to_numpy(), _matrix(group.column("v"), dim), most
            ).packed()
            where = {"cell": pa.array(group.column("cell")[:1].to_pylist(), pa.int32()), "part": pa.array(group.column("part")[:1].to_pylist(), pa.int64())}
            return pa.table(where | {n: pa.array([tree[n]], pa.binary()) for n in names})

        dealt = placed.join(self.cells, "cell").select(
            "cell", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part"), "vec_id", "label", "v"
        )
        schema = "cell int, part long, " + ", ".join(f"{n} binary" for n in names)
        self.trees = written(dealt.groupBy("cell", "part").applyInArrow(build, schema), "trees")

    def _route(self, kind: str):
        """Copies of a request for the cells that may hold what it asks for; ``kind``: all, pilot or rest."""
        centres, radii, most, dim = self.centres, self.radii, self.most, self.dim

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                q = _matrix(batch.column(3), dim)
                s, norms = q @ centres.T, np.sqrt((q * q).sum(1))[:, None]
                down, up = bounds(s, norms, np.maximum(radii, 0), most)
                up[:, radii < 0] = -np.inf
                first = np.argsort(-up, axis=1, kind="stable")[:, :PILOT]
                for i, wants in enumerate(batch.column(2).to_pylist()):
                    low, high = min(w["low"] for w in wants), max(w["high"] for w in wants)
                    may = (up[i] >= low) & (down[i] <= high)
                    if kind != "all":
                        chosen = np.zeros(len(may), bool)
                        chosen[first[i]] = True
                        may &= chosen if kind == "pilot" else ~chosen
                    cells = np.flatnonzero(may)
                    if len(cells):
                        copies = batch.take(pa.array(np.full(len(cells), i)))
                        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), *copies.columns], ["cell", *copies.schema.names])

        return run

    def find(self, requests: DataFrame, k: int, same: bool, kind: str = "all") -> DataFrame:
        """(anchor_id, no, vec_id, score): the k best of every part for each want of the requests."""
        routed = written(requests.mapInArrow(self._route(kind), f"cell int, {REQUEST}"), "routed")
        cuts = routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_PART).cast("int").alias("query_parts"))
        cuts = F.broadcast(written(cuts, "query-parts"))  # MAX_CELLS rows at most
        zero = F.lit(0).cast("long")
        asked = routed.join(self.cells, "cell").join(cuts, "cell").select(
            "cell", F.explode(F.sequence(zero, F.col("parts").cast("long") - 1)).alias("part"),
            F.pmod(F.xxhash64("anchor_id"), F.col("query_parts")).alias("query_part"), "anchor_id", "label", "wants", "v",
        )
        trees = self.trees.join(cuts, "cell").withColumn(
            "query_part", F.explode(F.sequence(zero, F.col("query_parts").cast("long") - 1))
        ).drop("query_parts")
        dim, most = self.dim, self.most

        def run(asked: pa.Table, trees: pa.Table) -> pa.Table:
            found = [[], [], [], []]
            if asked.num_rows:
                wants = asked.column("wants").to_pylist()
                own = np.repeat(np.arange(len(wants)), [len(w) for w in wants])
                each = [w for ws in wants for w in ws]
                low, high, no = (np.array([w[n] for w in each], np.int64) for n in ("low", "high", "no"))
                ids, labels = asked.column("anchor_id").to_numpy(), asked.column("label").to_numpy()
                q = _matrix(asked.column("v"), dim)
                for row in trees.to_pylist():
                    tree = CoverTree.unpacked(row, dim, most)
                    request, vec_id, score = tree.search(q, ids[own], labels[own], own, low, high, k, same)
                    for held, values in zip(found, (ids[own][request], no[request], vec_id, score), strict=True):
                        held.append(values)
            columns = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
            types = pa.int64(), pa.int32(), pa.int64(), pa.int64()
            names = "anchor_id", "no", "vec_id", "score"
            return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})

        keys = ["cell", "part", "query_part"]
        rows = asked.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(run, FOUND)
        return _best(rows, k)


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor_id", "no").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*rows.columns, "rank")


def hard_negatives(table: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows for which ``is_anchor`` holds."""
    spark = table.sparkSession
    found = prepared(table)
    if found is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    rows, dim = found
    index = Index(rows, dim)
    anchors = written(
        rows.filter(F.coalesce(is_anchor, F.lit(False))).groupBy(F.col("vec_id").alias("anchor_id"))
        .agg(F.min(F.struct("label", "v")).alias("own")).select("anchor_id", "own.label", "own.v"),
        "anchors",
    )
    columns = ["anchor_id", "label", "wants", "v"]

    def window(low: Column, high: Column, no: Column) -> Column:
        return F.struct(no.cast("int").alias("no"), low.cast("long").alias("low"), high.cast("long").alias("high"))

    ends = F.lit(-_FAR), F.lit(_FAR)
    first = anchors.withColumn("wants", F.array(window(*ends, F.lit(0)))).select(*columns)
    pilot = written(index.find(first, positives, True, "pilot").drop("rank"), "pilot")
    floor = pilot.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    least = F.when(F.col("n") >= positives, F.col("least")).otherwise(ends[0])
    rest = anchors.join(floor, "anchor_id", "left").withColumn("wants", F.array(window(least, ends[1], F.lit(0)))).select(*columns)
    near = _best(pilot.unionByName(index.find(rest, positives, True, "rest").drop("rank")), positives)
    near = written(near.select("anchor_id", F.col("rank").alias("no"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # the window in whole numbers
    exact = F.col("positive_score").cast("decimal(20,0)")
    low, high = (F.lit(share / 100).cast("decimal(3,2)") * exact for share in (LOW, HIGH))
    windows = near.withColumn("low", F.ceil(low).cast("long")).withColumn("high", F.floor(high).cast("long")).filter("low <= high")
    wants = windows.groupBy("anchor_id").agg(F.sort_array(F.collect_list(window(F.col("low"), F.col("high"), F.col("no")))).alias("wants"))
    asked = anchors.join(wants, "anchor_id").select(*columns)
    far = index.find(asked, negatives, False)
    return far.join(near, ["anchor_id", "no"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
