"""LM scoring by masked pseudo-likelihood with a bidirectional window network.

Vocabulary: the commonest words of all documents, counted exactly (one aggregate over word hashes), have a class each;
all other words fall into BUCKETS classes by hash. The network predicts the class of every word from the SIDE words on
either side: embeddings, one hidden layer, and a softmax in two steps (group, then member of the group), in numpy.
A word without a class of its own has, below its bucket, the share of the bucket's occurrences that are that word, so
every word of the corpus has a probability of its own and they add up to 1. The counts are exact: those of about the HOT
commonest words are broadcast, the others are joined by word hash.

Training: ROUNDS passes over all documents. In a pass each task starts from the common weights, steps through every
STRIDE-th place of every document of its partition (other places each pass, so that all passes take every place once),
and returns its weights; the weights are averaged by the places seen, summed up in tasks, so the driver receives a few rows whatever the number of tasks.
A document's score is the sum of log P(word | both sides) over all its words (score_words; score stops at the classes).

Weights are averaged over tasks, so with other partitions of the documents the last digits of scores differ; counts and
vocabulary don't.

Defined results: null and blank texts have no words, score 0 and a null mean; texts of any length are scored whole;
repeated rows are scored alike, ids may repeat or be null; without any words the weights stay as they began; an empty
table gives an empty result; further columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pepweave.llm import words as W
from pepweave.llm.common import cut, text_bytes, total

#: Groups and members of a group: the classes are their product, with one for the edge of a text and BUCKETS for rare words.
GROUPS, MEMBERS, BUCKETS = 32, 32, 64
SIDE, EMBED, HIDDEN = 2, 12, 24
#: ROUNDS passes over every STRIDE-th place: as many rounds as the stride, so each place is a target once.
ROUNDS, STRIDE, BATCH, RATE = 2, 2, 2048, 0.2
#: Text bytes hashed at once, and places scored at once.
SLICE, CHUNK = 4 << 20, 1 << 15
EDGE = 0
#: Words whose counts are broadcast, at most.
HOT = 1 << 18


@dataclass
class Shape:
    """Sizes of the network."""

    groups: int = GROUPS
    members: int = MEMBERS
    side: int = SIDE
    embed: int = EMBED
    hidden: int = HIDDEN

    @property
    def classes(self) -> int:
        return self.groups * self.members

    def parts(self) -> list[tuple[int, ...]]:
        width = 2 * self.side * self.embed
        return [(self.classes, self.embed), (width, self.hidden), (self.hidden,), (self.hidden, self.groups), (self.groups,), (self.groups, self.hidden, self.members), (self.groups, self.members)]

    @property
    def size(self) -> int:
        return sum(int(np.prod(p)) for p in self.parts())

    def split(self, flat: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for p in self.parts():
            n = int(np.prod(p))
            out.append(flat[at : at + n].reshape(p))
            at += n
        return out

    def start(self) -> np.ndarray:
        rng = np.random.default_rng(7)
        flat = np.zeros(self.size, np.float32)
        emb, w1, _, wg, _, wm, _ = self.split(flat)
        for w, fan in ((emb, 4), (w1, w1.shape[0]), (wg, self.hidden), (wm, self.hidden)):
            w[...] = rng.normal(0, 1 / np.sqrt(fan), w.shape)
        return flat


def class_ids(vocabulary: np.ndarray, hashed: np.ndarray, buckets: int) -> np.ndarray:
    """Class of each word: 1 .. buckets for rare words, then the words of the sorted vocabulary; 0 is the edge."""
    rare = 1 + (hashed % np.uint64(buckets)).astype(np.int32)
    if not len(vocabulary):
        return rare
    at = np.minimum(np.searchsorted(vocabulary, hashed), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashed, at.astype(np.int32) + 1 + buckets, rare)


def word_counts(docs: DataFrame) -> DataFrame:
    """h, n: hash and number of occurrences of every word of docs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            found, counts = [], []
            for i, j in W.slices(offsets, 8 * SLICE):
                piece = raw[offsets[i] : offsets[j]]
                starts, ends, _ = W.bounds(piece, offsets[i : j + 1] - offsets[i], W.NOT_BLANK)
                h, c = np.unique(W.hashes(piece, starts, ends, lower=True), return_counts=True)
                found.append(h)
                counts.append(c)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(counts).astype(np.int64))], names=["h", "n"])

    return cut(docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")


def vocabulary(counts: DataFrame, n: int) -> np.ndarray:
    """Sorted hashes of the n commonest words (ties: lesser hash)."""
    top = counts.orderBy(F.col("n").desc(), "h").limit(n).select("h").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def padded(classes: np.ndarray, first: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes of several texts with edges before and after each, and where each word is in that array."""
    counts = np.diff(first)
    where = np.arange(len(classes)) + side * (np.repeat(np.arange(len(counts)), counts) + 1)
    out = np.full(len(classes) + side * (len(counts) + 1), EDGE, np.int32)
    out[where] = classes
    return out, where


def context(line: np.ndarray, where: np.ndarray, side: int) -> np.ndarray:
    return line[where[:, None] + np.array([*range(-side, 0), *range(1, side + 1)])]


def exponentials(logits: np.ndarray, weights: np.ndarray, constant: np.ndarray) -> np.ndarray:
    """exp of logits (in place less their greatest, where hidden units within -1..1 could make them too large)."""
    if float(np.abs(weights).sum(axis=0).max() + np.abs(constant).max()) > 60:
        logits -= logits.max(axis=1, keepdims=True)
    return np.exp(logits)


def forward(shape: Shape, flat: np.ndarray, around: np.ndarray, target: np.ndarray, backward: bool = False):
    """log P of each target, and the gradient of their mean if asked for."""
    emb, w1, b1, wg, bg, wm, bm = shape.split(flat)
    n = len(target)
    x = emb[around].reshape(n, -1)
    hidden = np.tanh(x @ w1 + b1)
    group, member = target // shape.members, target % shape.members
    lg = hidden @ wg + bg
    pg = exponentials(lg, wg, bg)
    sg = pg.sum(axis=1, keepdims=True)
    out = lg[np.arange(n), group] - np.log(sg[:, 0])
    order = np.argsort(group.astype(np.int16), kind="stable")
    cuts = np.searchsorted(group[order], np.arange(shape.groups + 1)).tolist()
    # rows of a group lie together from here on
    met = [(g, cuts[g], cuts[g + 1]) for g in range(shape.groups) if cuts[g] < cuts[g + 1]]
    h, of, at = hidden[order], member[order], np.arange(n)
    lm = np.empty((n, shape.members), hidden.dtype)
    for g, i, j in met:
        np.matmul(h[i:j], wm[g], out=lm[i:j])
        lm[i:j] += bm[g]
    pm = exponentials(lm, wm.transpose(1, 0, 2).reshape(shape.hidden, -1), bm)
    sm = pm.sum(axis=1, keepdims=True)
    out[order] += lm[at, of] - np.log(sm[:, 0])
    if not backward:
        return out
    grad = np.zeros_like(flat)
    demb, dw1, db1, dwg, dbg, dwm, dbm = shape.split(grad)
    pg *= 1 / (n * sg)
    pg[at, group] -= 1 / n
    dwg += hidden.T @ pg
    dbg += pg.sum(axis=0)
    pm *= 1 / (n * sm)
    pm[at, of] -= 1 / n
    dbm[[g for g, _, _ in met]] = np.add.reduceat(pm, [i for _, i, _ in met], axis=0)
    back = np.empty_like(h)
    for g, i, j in met:
        dwm[g] += h[i:j].T @ pm[i:j]
        np.matmul(pm[i:j], wm[g].T, out=back[i:j])
    dh = pg @ wg.T
    dh[order] += back
    dz = dh * (1 - hidden * hidden)
    dw1 += x.T @ dz
    db1 += dz.sum(axis=0)
    dx = (dz @ w1.T).reshape(-1, shape.embed)
    place = around.ravel().astype(np.int16 if shape.classes < 1 << 15 else np.int32)
    order = np.argsort(place, kind="stable")  # rows of a class lie together and are added up
    place = place[order]
    begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    demb[place[begins]] = np.add.reduceat(dx[order], begins, axis=0)
    return out, grad


def texts_as_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of the rows: first row, hashes of the words, index of each row's first word."""
    raw, offsets = text_bytes(column)
    for i, j in W.slices(offsets, SLICE):
        piece = raw[offsets[i] : offsets[j]]
        starts, ends, first = W.bounds(piece, offsets[i : j + 1] - offsets[i], W.NOT_BLANK)
        yield i, W.hashes(piece, starts, ends, lower=True), first


def texts_as_classes(column: pa.Array, known: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of the rows: first row, classes of the words, index of each row's first word."""
    for i, hashed, first in texts_as_hashes(column):
        yield i, class_ids(known, hashed, buckets), first


@dataclass
class Model:
    """A vocabulary and the weights of the network."""

    shape: Shape
    buckets: int
    known: np.ndarray
    flat: np.ndarray

    def logs(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For slices of the rows: first row, hashes and classes of the words, index of each row's first word, log P of each class."""
        for i, hashed, first in texts_as_hashes(column):
            classes = class_ids(self.known, hashed, self.buckets)
            line, where = padded(classes, first, self.shape.side)
            log = np.zeros(len(classes))
            for k in range(0, len(classes), CHUNK):
                part = where[k : k + CHUNK]
                log[k : k + len(part)] = forward(self.shape, self.flat, context(line, part, self.shape.side), classes[k : k + CHUNK])
            yield i, hashed, classes, first, log

    def scores(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words and summed log-probabilities of the classes of each text."""
        n, out = np.zeros(len(column), np.int64), np.zeros(len(column))
        for i, _, _, first, log in self.logs(column):
            rows = len(first) - 1
            n[i : i + rows], out[i : i + rows] = np.diff(first), row_sums(log, first)
        return n, out


def row_sums(log: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(log)])
    return sums[first[1:]] - sums[first[:-1]]


def targets(first: np.ndarray, stride: int, turn: int) -> np.ndarray:
    """Every stride-th place of each text, from another place each turn; stride turns take every place once (stride no multiple of 7)."""
    inside = np.arange(first[-1]) - np.repeat(first[:-1], np.diff(first))
    return np.flatnonzero(inside % stride == (turn * 7) % stride)


def train(docs: DataFrame, shape: Shape | None = None, buckets: int = BUCKETS, rounds: int = ROUNDS, stride: int = STRIDE, counts: DataFrame | None = None, batch: int = BATCH) -> Model:
    """A model of all documents. counts: their word_counts, if taken already; batch: places of a step."""
    shape = shape or Shape()
    model = Model(shape, buckets, vocabulary(word_counts(docs) if counts is None else counts, shape.classes - 1 - buckets), shape.start())
    spark = docs.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def work(batches: Iterator[pa.RecordBatch], turn=turn, shared=shared) -> Iterator[pa.RecordBatch]:
            begun = shared.value
            flat, squares, seen = begun.flat.copy(), np.full(shape.size, 1e-3, np.float32), 0
            rng = np.random.default_rng(TaskContext.get().partitionId() + 1_000_003 * turn)
            for texts in batches:
                for _, classes, first in texts_as_classes(texts.column(0), begun.known, buckets):
                    line, where = padded(classes, first, shape.side)
                    places = rng.permutation(targets(first, stride, turn))
                    for k in range(0, len(places), batch):
                        some = places[k : k + batch]
                        _, grad = forward(shape, flat, context(line, where[some], shape.side), classes[some], backward=True)
                        squares += grad * grad
                        flat -= RATE * grad / np.sqrt(squares)
                        seen += len(some)
            packed = np.concatenate([flat.astype(float) * seen, [seen]])
            yield pa.RecordBatch.from_arrays([pa.array([packed.tobytes()], pa.binary())], names=["v"])

        summed = total(docs.select("text").mapInArrow(work, "v binary"), shape.size + 1)
        if summed[-1]:
            model = Model(shape, buckets, model.known, (summed[:-1] / summed[-1]).astype(np.float32))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, n_words, score (sum of log-probabilities of the classes), mean."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s = shared.value.scores(batch.column(1))
            mean = pa.array(s / np.maximum(n, 1), mask=n == 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(s), mean], names=["doc_id", "n_words", "score", "mean"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, n_words long, score double, mean double")


@dataclass
class Shares:
    """What makes the share of a word in its bucket: logarithms of the buckets' counts, hashes and logarithms of common words' counts."""

    buckets: np.ndarray
    hot: np.ndarray
    logs: np.ndarray


def shares(counts: DataFrame, model: Model, hot: int = HOT) -> Shares:
    """Of at most hot words; the buckets' counts are of all words without a class of their own."""
    known, buckets = model.known, model.buckets

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(buckets + 1)
        for batch in batches:
            classes = class_ids(known, batch.column(0).to_numpy().view(np.uint64), buckets)
            rare = classes <= buckets
            out += np.bincount(classes[rare], batch.column(1).to_numpy()[rare], buckets + 1)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["v"])

    summed = total(counts.select("h", "n").mapInArrow(add, "v binary"), buckets + 1)
    step = F.floor(4 * F.log2("n"))  # some hundred values, however many words there are
    least, room = None, hot
    for at, size in sorted(counts.groupBy(step).count().collect(), reverse=True):
        room -= size
        if room < 0:
            break
        least = at
    top = counts.where(F.lit(False) if least is None else step >= least).select("h", "n").toArrow()
    h = top.column(0).to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    return Shares(np.log(np.maximum(summed, 1)), h[order], np.log(top.column(1).to_numpy().astype(float))[order])


def score_words(docs: DataFrame, model: Model, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """As score(), down to words: log of the share of its bucket is added for each word without a class of its own.

    counts: word_counts of the corpus; a word that isn't in it counts as met once.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, shares(counts, model, hot)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (model, share), at = shared.value, TaskContext.get().partitionId() << 40
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64()), ("h", pa.int64())])
        for batch in batches:
            n, out = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            rows, words = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for i, hashed, classes, first, log in model.logs(batch.column(1)):
                rare = np.flatnonzero(classes <= model.buckets)
                h = hashed[rare]
                log[rare] -= share.buckets[classes[rare]]
                where = np.searchsorted(share.hot, h)
                where[where == len(share.hot)] = 0
                met = share.hot[where] == h if len(share.hot) else np.zeros(len(h), bool)
                log[rare[met]] += share.logs[where[met]]
                k = len(first) - 1
                n[i : i + k], out[i : i + k] = np.diff(first), row_sums(log, first)
                rows.append(at + i + np.searchsorted(first, rare[~met], "right") - 1)
                words.append(h[~met])
            own = at + np.arange(batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(own), batch.column(0), pa.array(n), pa.array(out), pa.nulls(len(n), pa.int64())], schema=schema)
            row, h = np.concatenate(rows), np.concatenate(words).view(np.int64)
            for k in range(0, len(h), 1 << 16):
                some = row[k : k + (1 << 16)]
                none = [pa.nulls(len(some), t) for t in (pa.int64(), pa.int64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(some), *none, pa.array(h[k : k + (1 << 16)])], schema=schema)
            at += batch.num_rows

    # rows and their words by one pass that is written once: row numbers mean the same in both
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "row long, doc_id long, n_words long, score double, h long")
    found = cut(found, "scored")
    met = found.where(F.col("h").isNotNull()).select("row", "h").join(counts, "h", "left")
    more = met.groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(1)).cast("double"))).alias("more"))
    whole = found.where(F.col("h").isNull()).join(more, "row", "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0)))
    return whole.select("doc_id", "n_words", "score", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).alias("mean"))
