"""Toxicity by weak supervision.

1.  Voters. Words and word stems that toxic documents use far more often are mined from a bounded sample of the labelled
    training rows (MINED) and chosen greedily by the toxic documents that they add; with a general lexicon they make one
    voter each. Pattern voters judge how many hits a text has for its length, shouting and symbol noise. Voters say toxic
    (1), clean (-1) or nothing (0).
2.  Label model. Each voter's accuracy (its votes' probabilities given the class) and the class rate are estimated by EM
    over all documents. Labels give EM its first estimate and no more. Correlations of voters given the class, from the
    same pass, discount voters that repeat each other. A pass returns sums of a fixed size, added up in tasks.
3.  Classifier. A logistic regression is trained on the posterior labels, and on nothing else, of a bounded sample of rows
    (FITTED). Its output is then put on the scale of probabilities: two numbers, slope and constant of its logit, are
    fitted on at most FITTED labelled training rows.

Labels come from training rows only: rows whose crc32 of the doc_id as text leaves 1 modulo 3 are held out. Scores read
the text and nothing else.

Defined results: null and blank texts are scored as texts without hits; texts of any length are measured whole; a null
doc_id isn't held out and has no label; rows that repeat an id share its label, and equal texts have equal scores;
conflicting labels of an id count as toxic; labels other than 0 and 1 are ignored; without labels of both classes every
score is the class rate, 0 if there is none; an empty table gives an empty result; further columns, whatever their names,
are passed by in ``reject`` and left out by ``score``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pepweave.llm import words as W
from pepweave.llm.common import cut, portions, text_bytes, total

#: Labelled documents that terms are mined from, candidate terms, chosen terms; rows that the classifier is fitted on.
MINED, CANDIDATES, TERMS, FITTED = 8000, 3000, 48, 20_000
#: A term must be in so many toxic documents, and so many times as frequent in them.
SUPPORT, LIFT = 4, 8.0
STEMS = range(3, 13)
#: Letters of a word that may be a term as a whole; terms that a task holds at once.
WORD, HELD = 48, 20_000
#: Text bytes measured at once.
SLICE = 2 << 20
#: From this score on a document counts as toxic.
TOXIC = 0.7
ROUNDS = 6

#: General lexicon, fixed values: common insults of four languages.
LEXICON = {
    "en": "idiot idiots moron morons stupid loser losers scum trash clown pathetic worthless disgusting imbecile jerk bastard bitch asshole fool dumb dumbass retard freak vermin filth garbage pig",
    "de": "idiot idioten trottel depp dummkopf abschaum arschloch schlampe mistkerl vollidiot versager widerlich",
    "fr": "idiot idiote imbécile connard connasse salope crétin abruti ordure débile minable",
    "es": "idiota imbécil estúpido estúpida cabrón basura gilipollas payaso asqueroso inútil perdedor",
}
_LETTERS = re.compile(r"[^\W\d_]+")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def terms_of(text: str) -> Counter:
    """Full words ("=word") and proper stems ("word+") of a text, by number of occurrences."""
    out: Counter = Counter()
    for w, n in Counter(_LETTERS.findall(text.lower())).items():
        if len(w) <= WORD:
            out[f"={w}"] += n
        for k in STEMS:
            if k >= len(w):
                break
            out[f"{w[:k]}+"] += n
    return out


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id, y of the rows that may be learned from."""
    ok = labels.where(F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id")) != 1))
    return ok.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))


def mine(docs: DataFrame, train: DataFrame) -> list[str]:
    """Terms, chosen on a bounded sample of labelled documents."""
    chosen = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MINED)
    told = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *[pa.array([c[j] for c in seen.values()], pa.int64()) for j in range(4)]], names=["term", "d0", "d1", "n0", "n1"])

        for batch in batches:
            for text, y in zip(batch.column(0), batch.column(1).to_pylist()):
                for t, n in terms_of(text.as_py() or "").items():
                    c = seen.get(t)
                    if c is None:
                        c = seen[t] = [0, 0, 0, 0]
                    c[y] += 1
                    c[2 + y] += n
                if len(seen) > HELD:
                    yield out()
                    seen.clear()
        yield out()

    counts = told.select("text", "y").mapInArrow(count, "term string, d0 long, d1 long, n0 long, n1 long").groupBy("term").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "n0", "n1")])
    n_words = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    size = {r.y: r.n for r in told.groupBy("y").agg(F.sum(n_words).alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return []
    lift = ((F.col("n1") + 0.5) / size[1]) / ((F.col("n0") + 0.5) / size[0])
    good = counts.where((F.col("d1") >= SUPPORT) & (lift >= LIFT)).orderBy((F.col("d1") - F.col("d0") * 0.5).desc(), F.length("term").desc(), "term").limit(CANDIDATES)
    candidates = [r.term for r in good.select("term").collect()]
    at = {t: k for k, t in enumerate(candidates)}
    # at most MINED ids, though ids may repeat
    sample = told.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(MINED).select("text", "y")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [[at[t] for t in terms_of(text.as_py() or "") if t in at] for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(has, pa.list_(pa.int32()))], names=["y", "has"])

    rows = sample.mapInArrow(members, "y int, has array<int>").collect()  # at most MINED rows of at most CANDIDATES numbers
    member = np.zeros((len(rows), len(candidates)), bool)
    for k, r in enumerate(rows):
        member[k, r.has] = True
    y = np.array([r.y for r in rows], bool)
    return greedy(candidates, member[y], member[~y])


def greedy(candidates: list[str], toxic: np.ndarray, clean: np.ndarray) -> list[str]:
    """Terms that add toxic documents; rows of the masks are documents, columns candidates."""
    out: list[str] = []
    open_ = np.ones(len(candidates), bool)
    covered = np.zeros(len(toxic), int)
    cost = 0.5 * clean.sum(axis=0)
    while len(out) < TERMS and open_.any():
        # a document counts until three terms cover it: most toxic documents hold several
        gain = np.where(open_, toxic[covered < 3].sum(axis=0) - cost, -np.inf)
        best = max(range(len(candidates)), key=lambda k: (gain[k], len(candidates[k]), candidates[k]))
        if gain[best] < SUPPORT / 2:
            break
        out.append(candidates[best])
        covered += toxic[:, best]
        stem = candidates[best].strip("=+")
        for k, c in enumerate(candidates):  # a word is counted by one term
            other = c.strip("=+")
            if other.startswith(stem) or stem.startswith(other):
                open_[k] = False
    return out


def hit_finder(terms: list[str]) -> ahocorasick.Automaton | None:
    """Finds terms: "=word" as a whole word, "stem+" at the start of a longer one."""
    found: dict[str, list[tuple[int, bool]]] = {}
    for k, t in enumerate(terms):
        found.setdefault(t.strip("=+"), []).append((k, t[0] == "="))
    if not found:
        return None
    out = ahocorasick.Automaton()
    for w, which in found.items():
        out.add_word(w, (len(w), which))
    out.make_automaton()
    return out


def measure(finder: ahocorasick.Automaton | None, n_terms: int, column: pa.Array) -> np.ndarray:
    """For each text: occurrences of each term, words, share of A-Z among ASCII letters, share of symbols."""
    raw, offsets = text_bytes(column)
    out = np.zeros((len(offsets) - 1, n_terms + 3))
    for i, j in W.slices(offsets, SLICE):
        piece, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        _, _, first = W.bounds(piece, at, W.NOT_BLANK)
        upper, letters, symbols = (np.diff(np.concatenate([[0], np.cumsum(k[piece], dtype=np.int32)])[at]) for k in (_UPPER, _LETTER, _SYMBOL))
        out[i:j, n_terms] = np.diff(first)
        out[i:j, n_terms + 1] = upper / np.maximum(letters, 1)
        out[i:j, n_terms + 2] = symbols / np.maximum(np.diff(at), 1)
    if finder is not None:
        for r, value in enumerate(column):
            low = (value.as_py() or "").lower()
            if not low:
                continue
            n = len(low)
            for end, (size, which) in finder.iter(low):
                start, after = end - size, end + 1
                if start >= 0 and low[start].isalpha():
                    continue
                longer = after < n and low[after].isalpha()
                for k, whole in which:
                    if whole != longer:
                        out[r, k] += 1
    return out


_UPPER, _LETTER, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[0x41:0x5B] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_SYMBOL[[*range(0x21, 0x2C), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def votes(x: np.ndarray) -> np.ndarray:
    """Votes -1, 0, 1 of all voters, from measure()."""
    counts, n_words = x[:, :-3], np.maximum(x[:, -3], 1)
    hits, kinds = counts.sum(axis=1), (counts > 0).sum(axis=1)
    rate = hits / n_words
    said = [np.where((counts.T[k] >= 3) | (counts.T[k] / n_words >= 0.004), 1, 0) * (counts.T[k] > 0) for k in range(counts.shape[1])]
    for yes, no in (
        (hits >= 2, hits == 0), (kinds >= 2, kinds == 0), (rate >= 0.004, rate < 0.001), (rate >= 0.01, rate < 0.003), (rate >= 0.03, rate < 0.005), (hits >= 4, hits == 0),
    ):
        said.append(np.where(yes, 1, np.where(no, -1, 0)))
    said.append(np.where(x[:, -2] > 0.6, 1, 0))
    said.append(np.where(x[:, -1] > 0.1, 1, 0))
    return np.array(said, np.int8).T


def features(x: np.ndarray) -> np.ndarray:
    """What the classifier reads, from measure()."""
    counts, n_words = x[:, :-3], np.maximum(x[:, -3], 1)
    hits = counts.sum(axis=1)
    rate = hits / n_words
    rest = [np.log1p(hits), np.log1p(1000 * rate), np.minimum(rate, 0.2) * 20, hits > 0, hits >= 2, (counts > 0).sum(axis=1) >= 2, rate >= 0.004, rate >= 0.01, rate >= 0.02, np.log1p(n_words), x[:, -2], x[:, -1]]
    return np.column_stack([np.log1p(1000 * counts / n_words[:, None]), *rest]).astype(float)


@dataclass
class LabelModel:
    """P(vote | class) of each voter, class rate, and weights that discount correlated voters."""

    prior: float
    table: np.ndarray  # voter, class, vote + 1
    weight: np.ndarray

    def logit(self, v: np.ndarray) -> np.ndarray:
        ratio = np.log(self.table[:, 1]) - np.log(self.table[:, 0])
        return np.log(self.prior / (1 - self.prior)) + (ratio[np.arange(v.shape[1]), v + 1] * self.weight).sum(axis=1)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """P(toxic) of rows with votes v."""
        return 1 / (1 + np.exp(-np.clip(self.logit(v), -30, 30)))


def sums(v: np.ndarray, p: np.ndarray) -> np.ndarray:
    """What EM needs of votes v with P(toxic) p: for each class its size, votes by value, and products of votes."""
    out = []
    for q in (1 - p, p):
        f = v.astype(float)
        out += [[q.sum()], *[((v == s) * q[:, None]).sum(axis=0) for s in (-1, 0, 1)], ((f * q[:, None]).T @ f).ravel()]
    return np.concatenate(out)


def maximise(total: np.ndarray, n: int) -> LabelModel:
    """The label model of sums."""
    half = len(total) // 2
    table, size, rho = np.zeros((n, 2, 3)), np.zeros(2), np.zeros((n, n))
    for c in (0, 1):
        part = total[c * half : (c + 1) * half]
        size[c] = part[0]
        counts = part[1 : 1 + 3 * n].reshape(3, n).T
        table[:, c] = (counts + 0.5) / (part[0] + 1.5)
        mean = (counts[:, 2] - counts[:, 0]) / max(part[0], 1)
        cov = part[1 + 3 * n :].reshape(n, n) / max(part[0], 1) - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        rho += np.abs(cov / np.outer(sd, sd)) / 2
    rho[rho < 0.1] = 0
    np.fill_diagonal(rho, 1)
    return LabelModel(float(np.clip(size[1] / max(size.sum(), 1), 1e-4, 1 - 1e-4)), table, 1 / rho.sum(axis=1))


def logistic(x: np.ndarray, p: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (the last is the constant) for soft labels p, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q) + 1e-6)[:, None]).T @ x + np.diag(keep), x.T @ (q - p) + keep * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    """A fitted scorer of texts."""

    terms: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None
    scale: tuple[float, float] = (1.0, 0.0)
    rate: float = 0.0

    def score(self, column: pa.Array, finder: ahocorasick.Automaton | None) -> np.ndarray:
        if self.weights is None:
            return np.full(len(column), self.rate)
        return self.of(measure(finder, len(self.terms), column))

    def of(self, x: np.ndarray) -> np.ndarray:
        z = features(x) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * z + self.scale[1], -30, 30)))


def measured(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, x (packed measure()) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = hit_finder(terms)
        for batch in portions(batches, 1):
            x = measure(finder, len(terms), batch.column(1)).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, x binary")


def unpack(column: pa.Array, n_terms: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, n_terms + 3).astype(float)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame | None]:
    """The model, and the measured rows doc_id, x (None if there is nothing to learn from)."""
    train = cut(training_labels(labels), "train")
    known = {r.y: r.n for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rate = known.get(1, 0) / max(1, sum(known.values()))
    mined = mine(docs, train) if len(known) == 2 else []
    general = sorted({f"={w}" for ws in LEXICON.values() for w in ws.split()} - set(mined))
    if len(known) < 2:
        return Model(rate=rate), None
    terms = mined + general
    rows = cut(measured(docs, terms), "measured")
    joined = cut(rows.join(train, "doc_id", "left").select("doc_id", "x", "y"), "joined")
    n_terms = len(terms)
    n = votes(np.zeros((1, n_terms + 3))).shape[1]
    size = 2 * (1 + 3 * n + n * n)

    def expect(model: LabelModel | None) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = votes(unpack(batch.column(0), n_terms))
                if model is None:
                    y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                    v, p = v[~np.isnan(y)], y[~np.isnan(y)]
                else:
                    p = model.posterior(v)
                yield pa.RecordBatch.from_arrays([pa.array([sums(v, p).tobytes()], pa.binary())], names=["v"])

        return total(joined.select("x", "y").mapInArrow(work, "v binary"), size)

    model = maximise(expect(None), n)
    for _ in range(ROUNDS):
        model = maximise(expect(model), n)
    order = F.xxhash64("doc_id", "x")
    some = rows.orderBy(order).limit(FITTED).select("x").toArrow()
    x = unpack(some.column("x").combine_chunks(), n_terms)
    out = Model(terms, rate=rate)
    out.weights = logistic(features(x), model.posterior(votes(x)))
    sure = joined.where(F.col("y").isNotNull()).orderBy(order).limit(FITTED).select("x", "y").toArrow()
    x, y = unpack(sure.column("x").combine_chunks(), n_terms), sure.column("y").to_numpy().astype(float)
    out.scale = tuple(logistic((features(x) @ out.weights[:-1] + out.weights[-1])[:, None], y, ridge=1e-3))
    return out, rows


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model, rows = fit(docs, labels)
    if rows is None:
        out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(float(model.rate)).alias("score"))
    else:

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.of(unpack(batch.column(1), len(model.terms))))], names=["doc_id", "score"])

        out = rows.mapInArrow(work, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, with all their columns."""
    model, rows = fit(docs, labels)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = hit_finder(model.terms)
        for batch in portions(batches, at):
            yield batch.filter(pa.array(model.score(batch.column(at), finder) < TOXIC))

    return docs.mapInArrow(work, docs.schema)
