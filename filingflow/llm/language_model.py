"""Scores of a small causal self-attention model over subword ids, trained in numpy.

Texts (A-Z folded) are encoded by a public byte-level tokenizer, once, and the ids are
written.  The model gives each id the probability P(class of the id | context) x
P(id | class).  Counts over all training documents give P(id | class), the classes
(clusters of ids by what precedes them), the ids' embeddings (the leading directions
of the same counts) and a prior of the class given the class before.  One layer of
causal self-attention over the embeddings adds to the prior's logits.  Its weights,
some thousands whatever the corpus, are trained by every task on its share of the
windows and averaged over all tasks, for ``ROUNDS`` rounds.  A hash of document and place
deals the windows of the training documents to the rounds, so each of them is used once.

A text is scored in windows of ``CONTEXT + STEP`` ids that overlap by ``CONTEXT``; each id,
and the end id, is scored once, with at least ``CONTEXT`` ids before it where there are as
many.  Windows are batched; a mask keeps an id from seeing what follows and what lies
before the text.

The base score is a unigram model over words with one added to each count.  Word
counts go through the exchange of ``chunks``, so that no table of words is broadcast.

Defined cases: a null text is empty and has the end token alone; a null id counts as
empty text for the division into training and held-out; rows with the same id are
documents of their own; without training documents all counts are 0; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import written
from .chunks import Chunks, answered, squeeze, unpack, unsqueeze
from .neighbours import centres
from .tokens import PORTION_BYTES, encoder, public_path
from .words import Words, mix

CONTEXT, STEP = 8, 24
LENGTH = CONTEXT + STEP
WIDTH, CLASSES = 16, 48
#: Greatest length of an embedding, and of a step's gradient.
LONGEST, STEEPEST = 8.0, 1.0
#: Kinds of preceding ids that are told apart: ids are numbered by the tokenizer's own order of merges.
KINDS, KIND_IDS = 48, 24
ROUNDS, RATE = 2, 0.01
END = 50_256
IDS = 50_257
BATCH = 512
#: Logits below these in size are exponentiated as they are: neither sums nor products leave the range of a float.
SMALL, SMALL_CLASS = 60.0, 20.0
_DOCUMENT = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def _training(docs: pa.Table) -> np.ndarray:
    return np.array([not held_out(i) for i in docs.column("doc_id").to_pylist()], bool)


# --- base score -----------------------------------------------------------------


def _counted(words: Words, training: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, group = np.unique(words.hashes, return_inverse=True)
    counts = np.bincount(group[training[words.doc]], minlength=len(keys)) if len(keys) else np.zeros(0, np.int64)
    return keys, group, counts.astype(np.int64)


def _offer_words(docs: pa.Table, row: dict) -> dict[str, np.ndarray]:
    keys, _, counts = _counted(Words(docs.column("text").to_pylist(), fold=True), _training(docs))
    return {"keys": keys, "values": counts}


def _summed(group: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, np.int64)
    np.add.at(total, group, counts)
    return total[group]


def _training_totals(group: np.ndarray, counts: np.ndarray, n: int) -> tuple[int, int]:
    """Distinct training words of a bucket, and all of them."""
    return len(np.unique(group[counts > 0])), int(counts.sum())


def _base(n_train_words: int, n_train_docs: int, n_distinct: int):
    """Rows of the base score; N and V hold the end token too."""
    total, distinct = n_train_words + n_train_docs, n_distinct + (n_train_docs > 0)
    lost = np.log10(total + distinct + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                docs = unpack(row["packed"])
                words = Words(docs.column("text").to_pylist(), fold=True)
                keys, group = np.unique(words.hashes, return_inverse=True)
                counts = answered(row, "counts", "<i8", len(keys))[group]
                n = docs.num_rows
                each = np.log10(counts + 1.0) - lost
                score = np.bincount(words.doc, weights=each, minlength=n) + np.log10(n_train_docs + 1.0) - lost
                known = np.bincount(words.doc, weights=counts > 0, minlength=n).astype(np.int64) + (n_train_docs > 0)
                columns = {
                    "chunk": pa.array(np.full(n, row["chunk"])), "place": pa.array(np.arange(n)),
                    "doc_id": docs.column("doc_id").combine_chunks().cast(pa.int64()), "held_out": pa.array(~_training(docs)),
                    "n_tokens": pa.array(words.counts + 1, pa.int64()), "n_known": pa.array(known, pa.int64()),
                    "train_tokens": pa.array(np.full(n, total), pa.int64()), "base_score": pa.array(score, pa.float64()),
                }
                arrays = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns.values()]
                yield pa.RecordBatch.from_arrays(arrays, list(columns))

    return run


BASE = (
    "chunk long, place long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double"
)


# --- ids -------------------------------------------------------------------------


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(path).encode_all
        held: list[tuple[int, pa.Table]] = []
        held_bytes = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held_bytes
            texts = pa.chunked_array([c for _, docs in held for c in docs.column("text").chunks], pa.string())
            lengths, ids = encode_all(pc.ascii_lower(texts.combine_chunks()))
            first = start = 0
            for chunk, docs in held:
                last = first + docs.num_rows
                stop = start + int(lengths[first:last].sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk], pa.int64()),
                        pa.array([squeeze(lengths[first:last].astype("<u4"))], pa.binary()),
                        pa.array([np.packbits(_training(docs)).tobytes()], pa.binary()),
                        pa.array([squeeze(ids[start:stop])], pa.binary()),
                    ],
                    ["chunk", "lengths", "training", "ids"],
                )
                first, start = last, stop
            held.clear()
            held_bytes = 0

        for batch in batches:
            for row in batch.to_pylist():
                docs = unpack(row["packed"])
                n_bytes = docs.column("text").nbytes
                if held and held_bytes + n_bytes > PORTION_BYTES:
                    yield from close()
                held.append((row["chunk"], docs))
                held_bytes += n_bytes
        if held:
            yield from close()

    return run


class Sequences:
    """The documents of a chunk: per document a start id, its ids and the end id, one after another."""

    def __init__(self, row: dict) -> None:
        lengths = unsqueeze(row["lengths"], "<u4").astype(np.int64)
        ids = unsqueeze(row["ids"], "<u2")
        self.training = np.unpackbits(np.frombuffer(row["training"], np.uint8))[: len(lengths)].astype(bool)
        self.steps = lengths + 1  # ids to score
        self.first = np.cumsum(self.steps + 1) - (self.steps + 1)
        self.ids = np.full(int((self.steps + 1).sum()), END, np.int32)
        inside = np.ones(len(self.ids), bool)
        inside[self.first] = inside[self.first + self.steps] = False
        self.ids[inside] = ids

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(id before, id) of all training documents."""
        kept = np.repeat(self.training, self.steps + 1)
        kept[self.first] = False
        at = np.flatnonzero(kept)
        return self.ids[at - 1], self.ids[at]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, first id to score within it) of each window."""
        n = -(-self.steps // STEP)
        doc = np.repeat(np.arange(len(n)), n)
        return doc, (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * STEP

    def batch(self, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Inputs, targets, which targets count, and which inputs lie within the text."""
        place = at[:, None] + np.arange(-CONTEXT, STEP + 1)
        steps = self.steps[doc][:, None]
        within = place[:, :LENGTH] >= 0
        counts = place[:, CONTEXT:LENGTH] < steps
        np.minimum(place, steps, out=place)
        np.maximum(place, 0, out=place)
        place += self.first[doc][:, None]
        ids = self.ids.take(place)
        return ids[:, :LENGTH], ids[:, CONTEXT + 1 :], counts, within


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, n): how often each id follows each kind of id in the task's training documents."""
    total = np.zeros(IDS * KINDS, np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            before, ids = Sequences(row).pairs()
            np.add.at(total, ids * KINDS + np.minimum(before // KIND_IDS, KINDS - 1), 1)
    yield _sparse(total)


def _sparse(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["cell", "n"])


def _class_pairs(classes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                before, ids = Sequences(row).pairs()
                total += np.bincount(classes[before] * CLASSES + classes[ids], minlength=len(total))
        yield _sparse(total)

    return run


def _gathered(rows: DataFrame, size: int) -> np.ndarray:
    """Sums per cell over all tasks; ``size`` bounds what comes to the driver."""
    table = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size)
    total[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return total


# --- the model -------------------------------------------------------------------


class Model:
    """Tables from counts, and the trained weights as one vector."""

    SHAPES = {
        "place": (LENGTH, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH),
        "out": (WIDTH, WIDTH), "logits": (WIDTH, CLASSES), "bias": (CLASSES,),
    }

    def __init__(self, cells: np.ndarray) -> None:
        counts = cells.reshape(IDS, KINDS)
        each, kinds, total = counts.sum(1), counts.sum(0), max(counts.sum(), 1.0)
        expected = np.outer(each + 1.0, kinds + 1.0) / (total + IDS)
        lift = np.log1p(counts / expected) * np.minimum(1.0, each / 20)[:, None]
        lift -= lift.mean(0)
        values, directions = np.linalg.eigh(lift.T @ lift)
        embedded = lift @ directions[:, ::-1][:, :WIDTH]
        # of length LONGEST at most, so that no id alone saturates the attention
        embedded /= embedded.std() + 1e-9
        length = np.sqrt((embedded**2).sum(1, keepdims=True))
        self.embedded = (embedded * np.minimum(1, LONGEST / np.maximum(length, 1e-9))).astype(np.float32)
        often = np.argsort(-each, kind="stable")[:4096]
        middle = centres(self.embedded[often].astype(np.float64), CLASSES)
        spread = (self.embedded**2).sum(1)[:, None] - 2 * self.embedded @ middle.T + (middle**2).sum(1)
        self.classes = spread.argmin(1)
        mass = np.bincount(self.classes, weights=each + 0.5, minlength=CLASSES)
        self.inside = np.log((each + 0.5) / mass[self.classes]).astype(np.float32)
        self.used = np.bincount(self.classes, minlength=CLASSES) > 0
        self.prior = np.zeros((CLASSES, CLASSES), np.float32)
        self.likely = np.exp(self.prior)
        rng = np.random.default_rng(11)
        parts = [rng.standard_normal(s) * (0.3 / np.sqrt(WIDTH) if n not in ("bias", "logits") else 0) for n, s in self.SHAPES.items()]
        self.weights = np.concatenate([p.ravel() for p in parts])

    def set_prior(self, pairs: np.ndarray) -> None:
        pairs = pairs.reshape(CLASSES, CLASSES)
        overall = (pairs.sum(0) + 1.0) / (pairs.sum() + CLASSES)
        prior = np.log((pairs + 20 * overall) / (pairs.sum(1, keepdims=True) + 20))
        self.prior = np.where(self.used[None, :], prior, -60.0).astype(np.float32)
        self.likely = np.exp(self.prior)

    def parts(self, weights: np.ndarray) -> dict[str, np.ndarray]:
        found, at = {}, 0
        for name, shape in self.SHAPES.items():
            n = math.prod(shape)
            found[name] = weights[at : at + n].reshape(shape).astype(np.float32)
            at += n
        # query, key and value at once, and what multiplies a class after each class
        found["asked"] = np.hstack([found["query"] * np.float32(WIDTH**-0.5), found["key"], found["value"]])
        if self._small(found["bias"], SMALL_CLASS):
            found["likely"] = self.likely * np.exp(found["bias"])
        return found

    @staticmethod
    def _small(x: np.ndarray, limit: float) -> bool:
        return bool(-limit < x.min(initial=0) and x.max(initial=0) < limit)  # not with a NaN

    # what a scored place may not see: the places after it
    _HIDDEN = np.where(np.tri(LENGTH, dtype=bool), 0, -np.inf).astype(np.float32)[CONTEXT:]

    _SEEN = np.exp(_HIDDEN)

    def forward(self, w: dict, inputs: np.ndarray, within: np.ndarray) -> dict[str, np.ndarray]:
        """Unnormalised class probabilities of the scored places; only these ask, all places answer.

        A softmax is the same for any amount taken from a row's logits: its greatest is only
        taken where some logit is large.
        """
        x = self.embedded.take(inputs, axis=0)
        x += w["place"]
        qkv = (x.reshape(-1, WIDTH) @ w["asked"]).reshape(*inputs.shape, 3 * WIDTH)
        q, k, v = qkv[:, CONTEXT:, :WIDTH], qkv[..., WIDTH : 2 * WIDTH], qkv[..., 2 * WIDTH :]
        a = q @ k.transpose(0, 2, 1)
        begins = np.flatnonzero(~within[:, 0])
        if self._small(a, SMALL):
            np.exp(a, out=a)
            a *= self._SEEN
            a[begins] *= within[begins][:, None, :]
        else:
            a += self._HIDDEN
            a[begins] += np.where(within[begins], 0, -np.inf).astype(np.float32)[:, None, :]
            a -= a.max(-1, keepdims=True)  # a place always sees itself, so this is finite
            np.exp(a, out=a)
        weight = (a.reshape(-1, LENGTH) @ np.ones(LENGTH, np.float32)).reshape(*a.shape[:2], 1)
        o = a @ v
        o /= weight
        h = o.reshape(-1, WIDTH) @ w["out"]
        h += x[:, CONTEXT:].reshape(-1, WIDTH)
        z = h @ w["logits"]
        before = self.classes.take(inputs[:, CONTEXT:].ravel())
        if "likely" in w and self._small(z, SMALL_CLASS):
            np.exp(z, out=z)
            z *= w["likely"].take(before, axis=0)
        else:
            z += w["bias"]
            z += self.prior.take(before, axis=0)
            z -= z.max(-1, keepdims=True)
            np.exp(z, out=z)
        return {"x": x, "q": q, "k": k, "v": v, "a": a, "weight": weight, "o": o, "h": h, "p": z, "sum": z @ np.ones(CLASSES, np.float32)}

    def scores(self, w: dict, inputs: np.ndarray, targets: np.ndarray, counts: np.ndarray, within: np.ndarray) -> np.ndarray:
        """Natural log probability per window."""
        f = self.forward(w, inputs, within)
        ids = targets.ravel()
        got = f["p"][np.arange(len(ids)), self.classes[ids]]
        each = np.log(np.maximum(got, np.float32(1e-37))) - np.log(f["sum"]) + self.inside[ids]
        return np.where(counts, each.reshape(counts.shape), 0).sum(1, dtype=np.float64)

    def slope(self, weights: np.ndarray, inputs: np.ndarray, targets: np.ndarray, counts: np.ndarray, within: np.ndarray) -> np.ndarray:
        w = self.parts(weights)
        f = self.forward(w, inputs, within)
        ids = self.classes[targets.ravel()]
        share = (counts.ravel() / max(1, counts.sum())).astype(np.float32)
        d = f["p"]
        d *= (share / f["sum"])[:, None]
        d[np.arange(len(ids)), ids] -= share
        g = {"logits": (d.T @ f["h"]).T, "bias": np.ones(len(d), np.float32) @ d}
        flat = d @ w["logits"].T
        dh = flat.reshape(-1, STEP, WIDTH)
        g["out"] = f["o"].reshape(-1, WIDTH).T @ flat
        do = (flat @ w["out"].T).reshape(dh.shape)
        a = f["a"]
        a /= f["weight"]
        ds = do @ f["v"].transpose(0, 2, 1)
        ds -= np.einsum("bij,bij->bi", do, f["o"])[..., None]  # the mean of a row, weighted by a
        ds *= a
        dqkv = np.empty((*inputs.shape, 3 * WIDTH), np.float32)
        dqkv[:, :CONTEXT, :WIDTH] = 0
        np.matmul(ds, f["k"], out=dqkv[:, CONTEXT:, :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), f["q"], out=dqkv[..., WIDTH : 2 * WIDTH])
        np.matmul(a.transpose(0, 2, 1), do, out=dqkv[..., 2 * WIDTH :])
        both = (dqkv.reshape(-1, 3 * WIDTH).T @ f["x"].reshape(-1, WIDTH)).T
        g["query"], g["key"], g["value"] = both[:, :WIDTH] * np.float32(WIDTH**-0.5), both[:, WIDTH : 2 * WIDTH], both[:, 2 * WIDTH :]
        each = np.ones(len(inputs), np.float32)
        g["place"] = (each @ dqkv.reshape(len(inputs), -1)).reshape(LENGTH, 3 * WIDTH) @ w["asked"].T
        g["place"][CONTEXT:] += (each @ dh.reshape(len(inputs), -1)).reshape(STEP, WIDTH)
        return np.concatenate([g[n].ravel().astype(np.float64) for n in self.SHAPES])


def _drawn(own: Sequences, chunk: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, first id to score) of the training windows of a round, in the order of their hashes."""
    doc, at = own.windows()
    doc, at = doc[own.training[doc]], at[own.training[doc]]
    place = mix(mix(np.uint64(chunk) + doc.astype(np.uint64) * _DOCUMENT) + (at // STEP).astype(np.uint64))
    mine = np.flatnonzero(place % np.uint64(ROUNDS) == turn)
    mine = mine[np.argsort(place[mine], kind="stable")]
    return doc[mine], at[mine]


def _trained(model: Model, turn: int):
    """(cell, n, value): the task's weights after its windows of this round, times the number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights.copy()
        moment, square = np.zeros_like(weights), np.zeros_like(weights)
        step = seen = 0
        for batch in batches:
            for row in batch.to_pylist():
                own = Sequences(row)
                doc, at = _drawn(own, row["chunk"], turn)
                for i in range(0, len(doc), 256):
                    step, seen = step + 1, seen + len(doc[i : i + 256])
                    g = model.slope(weights, *own.batch(doc[i : i + 256], at[i : i + 256]))
                    g *= min(1.0, STEEPEST / max(float(np.sqrt(g @ g)), 1e-12))
                    moment = 0.9 * moment + 0.1 * g
                    square = 0.99 * square + 0.01 * g**2
                    rate = RATE / (1 + step / 200)
                    weights = weights - rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        at = np.arange(len(weights)) if seen else np.arange(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(np.full(len(at), seen), pa.int64()), pa.array(weights[at] * seen, pa.float64())],
            ["cell", "n", "value"],
        )

    return run


def train(ids: DataFrame) -> Model:
    sparse = "cell long, n long"
    model = Model(_gathered(ids.mapInArrow(_cells, sparse), IDS * KINDS))
    model.set_prior(_gathered(ids.mapInArrow(_class_pairs(model.classes), sparse), CLASSES * CLASSES))
    for turn in range(ROUNDS):
        mean = ids.mapInArrow(_trained(model, turn), "cell long, n long, value double").groupBy("cell").agg(
            (F.sum("value") / F.sum("n")).alias("value")
        )
        table = mean.toArrow()  # a row per weight
        if table.num_rows:
            model.weights[table.column("cell").to_numpy()] = table.column("value").to_numpy()
    if not np.isfinite(model.weights).all():
        raise ArithmeticError("the model's weights are not finite")
    return model


def _scored(model: Model):
    w = model.parts(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Sequences(row)
                doc, at = own.windows()
                order = np.argsort(at > 0, kind="stable")  # those with masked places first
                total = np.zeros(len(own.steps))
                for i in range(0, len(order), BATCH):
                    part = order[i : i + BATCH]
                    np.add.at(total, doc[part], model.scores(w, *own.batch(doc[part], at[part])))
                n = len(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["chunk"])), pa.array(np.arange(n)), pa.array(total / np.log(10))],
                    ["chunk", "place", "score"],
                )

    return run


def score(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    chunks = Chunks(docs.select("doc_id", "text"))
    offers = chunks.offers(_offer_words)
    counts = written(chunks.answers(offers, "<i8", _summed, "counts", _training_totals), "word-counts")
    distinct, n_words = (n or 0 for n in counts.filter("chunk = -1").agg(F.sum("total"), F.sum("second_total")).first())
    training = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2
    n_docs = docs.select("doc_id").filter(training).count()
    ids = written(chunks.table.mapInArrow(_encoded(path or public_path("byte_bpe_50k.json")), "chunk long, lengths binary, training binary, ids binary"), "ids")
    base = chunks.joined(counts.filter("chunk >= 0").drop("total", "second_total")).mapInArrow(_base(n_words, n_docs, distinct), BASE)
    scored = ids.mapInArrow(_scored(train(ids)), "chunk long, place long, score double")
    return base.join(scored, ["chunk", "place"]).drop("chunk", "place")
