"""Benchmark decontamination by winnowing.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A benchmark window is 13 consecutive
words of an item, or the whole item if it has fewer. Of every 13 consecutive words, seven 7-grams are hashed and the
least hash is kept; 13 = 7 + 7 - 1, so each span of 13 shared words or more keeps a fingerprint that the benchmark keeps
too. Document and benchmark fingerprints are joined; each hit is extended over the neighbouring windows with the same
fingerprint, and the windows found are compared word for word, so neither a miss nor a false hit is left. Items of under
13 words have one fingerprint, of the whole item.

Two ways lead to the same result, by the benchmark's measured size, ids and repeated items included. Up to BLOCK_BYTES every
worker holds the windows of the distinct items, and documents aren't shuffled; occurrences of a window in a batch (equal
by two independent 64-bit hashes) are compared once. Beyond that nothing of the benchmark comes to the driver: documents'
fingerprints meet the benchmark's in a shuffle join, and the windows behind the hits meet the benchmark's windows in
another, by their words.

Defined results: null and wordless texts have n_words 0 and are not contaminated; null and wordless items match nothing;
a null item_id is reported as an empty string; repeated items count once per item_id; texts of any length are read whole;
rows that repeat an id or an id and a text each have their result; an empty benchmark hits nothing and empty documents
give an empty result; further columns, whatever their names, are passed by in ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pepweave.llm import words as W
from pepweave.llm.common import cut, fresh, keys, portions, text_bytes

WINDOW, GRAM = 13, 7
#: Bytes of benchmark text and ids that a worker may hold.
BLOCK_BYTES = 16 << 20
#: Contaminated: n_hit > 0 and SHARE * n_hit >= n_words.
SHARE = 20


class Index:
    """The windows of distinct items, by hash, with the words to compare. items: (item_ids, text)."""

    def __init__(self, items: list[tuple[list[str], str]]):
        texts = pa.array([t for _, t in items], pa.large_string())
        raw, offsets = text_bytes(texts)
        starts, ends, first = W.bounds(raw, offsets, W.WORDISH)
        hashed = W.hashes(raw, starts, ends, lower=True)
        self.names = [i for i, _ in items]
        low = W.LOWER[raw].tobytes()
        self.vocabulary: dict[bytes, int] = {}
        self.words = np.array([self.vocabulary.setdefault(low[s:e], len(self.vocabulary)) for s, e in zip(starts.tolist(), ends.tolist())], np.int64)
        counts = np.diff(first)
        item_of = np.repeat(np.arange(len(items)), counts)
        at = {WINDOW: np.flatnonzero(W.starts_within(first, WINDOW, len(hashed)))}
        for n in range(1, WINDOW):
            at[n] = first[:-1][counts == n]
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, places in at.items():
            if len(places):
                h = W.grams(hashed, n)[places]
                order = np.argsort(h, kind="stable")
                self.windows[n] = h[order], places[order], item_of[places[order]]
        kept = W.sliding_min(W.grams(hashed, GRAM), WINDOW - GRAM + 1)
        self.prints = np.unique(kept[at[WINDOW]]) if len(at[WINDOW]) else np.zeros(0, np.uint64)
        short = [first[:-1][counts == n] for n in self.windows if n < WINDOW]
        self.short_first = np.unique(hashed[np.concatenate(short)]) if short else np.zeros(0, np.uint64)

    def find(self, n: int, h: int, ids: np.ndarray) -> np.ndarray:
        """Items with a window of exactly these words."""
        keys, places, item_of = self.windows[n]
        lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
        if lo == hi:
            return item_of[:0]
        same = (self.words[places[lo:hi, None] + np.arange(n)] == ids).all(axis=1)
        return item_of[lo:hi][same]


def within(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Mask of the values that are among the keys."""
    if not len(sorted_keys):
        return np.zeros(len(values), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)] == values


def scan(index: Index, column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, set[int]]]]:
    """Words of each row; for rows with hits the mask of hit words and the items."""
    raw, offsets = text_bytes(column)
    starts, ends, first = W.bounds(raw, offsets, W.WORDISH)
    n_words = np.diff(first)
    hashed = W.hashes(raw, starts, ends, lower=True)
    total = len(hashed)
    found: list[tuple[int, np.ndarray]] = []
    if len(index.prints) and total >= WINDOW:
        least = W.sliding_min(W.grams(hashed, GRAM), WINDOW - GRAM + 1)
        turn = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))  # one lookup for a run of windows
        hit = np.repeat(within(index.prints, least[turn]), np.diff(np.append(turn, len(least))))
        found.append((WINDOW, np.flatnonzero(hit & W.starts_within(first, WINDOW, total))))
    if len(index.short_first):
        heads = np.flatnonzero(within(index.short_first, hashed))
        left = np.repeat(first[1:], n_words)[heads] - heads
        found += [(n, heads[left >= n]) for n in index.windows if n < WINDOW]
    found = [(n, p, h) for n, p in found if len(p) for h in [W.grams_at(hashed, p, n)]]
    found = [(n, p[real], h[real]) for n, p, h in found for real in [within(index.windows[n][0], h)] if real.any()]
    out: dict[int, tuple[np.ndarray, set[int]]] = {}
    if not found:
        return n_words, out
    again = W.hashes(raw, starts, ends, lower=True, seed=1)
    edges, told = np.zeros(total + 1, np.int32), []
    for n, p, h in found:
        second = W.grams_at(again, p, n)
        order = np.lexsort((second, h))
        new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (second[order][1:] != second[order][:-1])])
        of = np.empty(len(p), np.int64)
        of[order] = np.cumsum(new) - 1
        held = []
        for k in order[new].tolist():  # one occurrence of each window is compared
            ids = [index.vocabulary.get(W.LOWER[raw[s:e]].tobytes(), -1) for s, e in zip(starts[p[k] : p[k] + n].tolist(), ends[p[k] : p[k] + n].tolist())]
            held.append(np.unique(index.find(n, h[k], np.array(ids, np.int64))).tolist())
        real = np.array([bool(x) for x in held])[of]
        p, of = p[real], of[real]
        np.add.at(edges, p, 1)
        np.add.at(edges, p + n, -1)
        rows = np.searchsorted(first, p, "right") - 1
        pairs = np.unique(rows * len(held) + of)
        told += [(r, held[w]) for r, w in zip((pairs // len(held)).tolist(), (pairs % len(held)).tolist())]
    mask = np.cumsum(edges[:-1]) > 0
    for r, items in told:
        if r not in out:
            out[r] = mask[first[r] : first[r + 1]], set()
        out[r][1].update(items)
    return n_words, out


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id (as text), text of the items that have one."""
    return benchmark.where(F.col("text").isNotNull()).select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")


def held_index(items: DataFrame, block_bytes: int) -> Index | None:
    """The index of all items, or none if their text and ids are over block_bytes."""
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item_id"))).first()[0] or 0
    if size > block_bytes:
        return None
    return Index([(sorted(r.ids), r.text) for r in items.groupBy("text").agg(F.collect_set("item_id").alias("ids")).collect()])


KINDS = "k1 long, k2 long, doc_id long, n_words long, edges array<long>, items array<string>"
NAMES = [k.split()[0] for k in KINDS.split(", ")]


def runs_of(mask: np.ndarray) -> list[int]:
    """Starts and ends of the runs of a mask, in turn."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).tolist()


def annotate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs: k1, k2 (its key), doc_id, n_words, edges (starts and ends of hit runs of words), items."""
    items = items_of(benchmark)
    slim = docs.select(*keys(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    held = held_index(items, block_bytes)
    if held is None:
        return joined(slim, items)
    index = docs.sparkSession.sparkContext.broadcast(held)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, bool), set()
        for batch in portions(batches, 3):
            n_words, out = scan(index.value, batch.column(3))
            hits = [out.get(r, none) for r in range(len(n_words))]
            edges = [runs_of(mask) for mask, _ in hits]
            found = [sorted({name for i in which for name in index.value.names[i]}) for _, which in hits]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n_words, pa.int64()), pa.array(edges, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))], names=NAMES)

    return slim.mapInArrow(work, KINDS)


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of words, index of each row's first word, word hashes."""
    raw, offsets = text_bytes(column)
    starts, ends, first = W.bounds(raw, offsets, W.WORDISH)
    return raw, starts, ends, first, W.hashes(raw, starts, ends, lower=True)


def prints_of(hashed: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of whole windows of n words, and their fingerprints."""
    p = np.flatnonzero(W.starts_within(first, n, len(hashed)))
    if not len(p):
        return p, np.zeros(0, np.int64)
    h = W.sliding_min(W.grams(hashed, GRAM), WINDOW - GRAM + 1) if n == WINDOW else W.grams(hashed, n)
    return p, h[p].view(np.int64)


def spoken(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: int, n: int) -> bytes:
    """The words of a window, joined by spaces."""
    return b" ".join(W.LOWER[raw[s:e]].tobytes() for s, e in zip(starts[p : p + n].tolist(), ends[p : p + n].tolist()))


def joined(slim: DataFrame, items: DataFrame) -> DataFrame:
    """annotate() by joins: slim has k1, k2, doc_id, text."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                raw, starts, ends, first, hashed = hashed_words(batch.column(0))
                counts, names = np.diff(first), batch.column(1).to_pylist()
                rows = []
                for n in range(1, WINDOW + 1):
                    p, h = prints_of(hashed, first, n)
                    row = np.searchsorted(first, p, "right") - 1
                    own = counts[row] == n if n < WINDOW else np.ones(len(p), bool)
                    rows += [(n, x, spoken(raw, starts, ends, q, n).decode(), names[r]) for x, q, r in zip(h[own].tolist(), p[own].tolist(), row[own].tolist())]
                yield pa.RecordBatch.from_pylist([dict(zip(("n", "print", "words", "item"), r)) for r in rows], schema=pa.schema([("n", pa.int32()), ("print", pa.int64()), ("words", pa.string()), ("item", pa.string())]))

    kinds = "n int, print long, words string, item string"
    bench = cut(items.select("text", F.md5("text").alias("item")).distinct().mapInArrow(windows, kinds).distinct(), "windows")
    sizes = sorted(r.n for r in bench.select("n").distinct().collect())  # 1 .. WINDOW

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2):
            _, _, _, first, hashed = hashed_words(batch.column(2))
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for n in sizes:
                p, h = prints_of(hashed, first, n)
                row = np.searchsorted(first, p, "right") - 1
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])[: len(row)]
                row, h = row[new], h[new]
                for i in range(0, len(row), 1 << 16):
                    j = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(k1[row[j]]), pa.array(k2[row[j]]), pa.array(np.full(len(row[j]), n, np.int32)), pa.array(h[j])], names=["k1", "k2", "n", "print"])

    met = slim.select("k1", "k2", "text").mapInArrow(prints, "k1 long, k2 long, n int, print long").join(bench.select("n", "print").distinct(), ["n", "print"])
    # a document's own fingerprints, so as many as its words at most
    wanted = met.groupBy("k1", "k2").agg(F.collect_set(F.struct("n", "print")).alias("wanted"))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("print", pa.int64()), ("words", pa.string())])
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                raw, starts, ends, first, hashed = hashed_words(one.column(2))
                by: dict[int, list[int]] = {}
                for w in one.column(3)[0].as_py():
                    by.setdefault(w["n"], []).append(w["print"])
                for n, some in by.items():
                    p, h = prints_of(hashed, first, n)
                    hit = np.isin(h, np.array(some, np.int64))
                    p, h = p[hit], h[hit]
                    for i in range(0, len(p), 1 << 14):
                        q = p[i : i + (1 << 14)]
                        said = [spoken(raw, starts, ends, x, n).decode() for x in q.tolist()]
                        same = [pa.array(np.full(len(q), one.column(c)[0].as_py())) for c in (0, 1)]
                        yield pa.RecordBatch.from_arrays([*same, pa.array(q), pa.array(np.full(len(q), n, np.int32)), pa.array(h[i : i + (1 << 14)]), pa.array(said, pa.string())], schema=schema)

    texts = slim.select("k1", "k2", "text").join(wanted, ["k1", "k2"])
    found = texts.mapInArrow(extend, "k1 long, k2 long, start long, n int, print long, words string")
    hits = cut(found.join(bench, ["n", "print", "words"]).select("k1", "k2", "start", "n", "item").distinct(), "hits")
    names = items.select(F.md5("text").alias("item"), "item_id").distinct()
    places = hits.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("places"))
    told = hits.select("k1", "k2", "item").distinct().join(names, "item").groupBy("k1", "k2").agg(F.collect_set("item_id").alias("items"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 3):
            first = hashed_words(batch.column(3))[3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(first), pa.int64())], names=NAMES[:4])

    rows = slim.mapInArrow(count, ", ".join(KINDS.split(", ")[:4])).join(places.join(told, ["k1", "k2"]), ["k1", "k2"], "left").select("k1", "k2", "doc_id", "n_words", "places", "items")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for n_words, own in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                change = np.zeros(n_words + 1, np.int32)
                for x in own or ():
                    change[x["start"]] += 1
                    change[x["start"] + x["n"]] -= 1
                edges.append(runs_of(np.cumsum(change[:-1]) > 0))
            found = [sorted(x or ()) for x in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(edges, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))], names=NAMES)

    return rows.mapInArrow(fold, KINDS)


def verdicts(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: k1, k2, doc_id, n_words, n_hit, items, contaminated."""
    found = annotate(docs, benchmark, block_bytes)
    n_hit = F.expr("aggregate(transform(edges, (x, i) -> IF(i % 2 = 0, -x, x)), 0L, (a, x) -> a + x)")
    return found.select("k1", "k2", "doc_id", "n_words", n_hit.alias("n_hit"), F.array_sort("items").alias("items")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    held = held_index(items_of(benchmark), block_bytes)
    if held is not None:
        index = docs.sparkSession.sparkContext.broadcast(held)
        at = docs.columns.index("text")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in portions(batches, at):
                n_words, out = scan(index.value, batch.column(at))
                bad = [r for r, (mask, _) in out.items() if SHARE * int(mask.sum()) >= n_words[r]]
                keep = np.ones(len(n_words), bool)
                keep[bad] = False
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(work, docs.schema)
    i, j, x, y = fresh(docs, "key1", "key2", "bad1", "bad2")
    bad = verdicts(docs, benchmark, block_bytes).where("contaminated").select(F.col("k1").alias(x), F.col("k2").alias(y))
    own = [k.alias(c) for k, c in zip(keys(), (i, j))]
    keyed = docs.select(*own, *[F.col(f"`{c}`") for c in docs.columns])
    return keyed.join(bad, (F.col(i) == F.col(x)) & (F.col(j) == F.col(y)), "left_anti").drop(i, j)
