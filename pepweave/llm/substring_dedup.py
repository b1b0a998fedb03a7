"""Substring dedup with a count-min prefilter.

A window is WINDOW consecutive words. Words covered by a window that starts anywhere else too are removed.

1.  Sketch. Every window has an anchor, the least hash of its GRAM-word runs; equal windows have equal anchors at equal
    offsets, so the count of an anchor's places is never below that of any of its windows. Each batch counts its anchors
    into sparse cells of a count-min sketch of two rows, which the blocks of the sketch merge as streams. A block has
    2**32 cells and there are more blocks the more files are read, so a cell holds far less than one anchor at any size.
    Cells that were counted twice or more are then laid onto a bitmap of SPARE bits for each of them, which is broadcast:
    its size goes with what repeats, up to 2 x 2**WIDTH bits (128 MB). Beyond that the bitmap fills up and rules out fewer
    windows; it never loses one.
2.  Exact pass. Windows whose anchor may repeat are grouped exactly by a 128-bit hash. Within a batch equal windows are
    found at once and leave it as one row, so a window that a third of all documents share sends one row a batch; the
    rows are then sorted by hash and read as a stream that holds one row, whatever the size of a group.
3.  The repeated starts go back to their documents by a join on the document's key, and the words go.

Defined results: null and blank texts have no words; a text of under WINDOW words loses none; rows that repeat an id and
a text are two documents, whose windows repeat; a null doc_id is an id like any other; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pepweave.llm import words as W
from pepweave.llm.common import cut, keys, text_bytes

WINDOW, GRAM = 35, 8
#: Bits of each of the two rows of the bitmap at most, as a power of two, and bits for each cell that repeats.
WIDTH, SPARE = 29, 8
#: Input partitions for each block of the sketch; blocks at least; cells that the merging of a block holds before it adds them up.
PARTS, BLOCKS, HELD = 2, 64, 1 << 22
#: Text bytes hashed at once.
SLICE = 8 << 20
#: Buckets of documents in a shuffle partition; a worker holds the starts of one.
BUCKETS = 2
_SECOND = 0xC2B2AE3D27D4EB4F


def _hashed(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, Callable[[], np.ndarray]]]:
    """For slices of the rows: first row, index of each row's first word, word hashes, and a function for second ones."""
    raw, offsets = text_bytes(column)
    for i, j in W.slices(offsets, SLICE):
        piece, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = W.bounds(piece, at, W.NOT_BLANK)
        yield i, first, W.hashes(piece, starts, ends), partial(W.hashes, piece, starts, ends, seed=1)


def _anchors(hashed: np.ndarray, whole: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window (0 for those that cross rows), and the hash at each place that is an anchor."""
    runs = W.grams(hashed, gram)
    span = window - gram + 1
    least = np.where(whole, W.sliding_min(runs, span), np.uint64(0))
    # a place is an anchor if some whole window over it has its hash as the least
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    most = ~W.sliding_min(~padded, span)
    return least, runs[(runs == most) & (most > 0)]


def _rows(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in the two rows, as fractions of 2**64: independent, and even although anchors are least hashes."""
    even = W.mix(anchors)
    return even, (even << np.uint64(32)) | (even >> np.uint64(32))


def _added(cells: np.ndarray, counts: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells with their counts up to 2, after one more count of each cell in more."""
    cells, at = np.unique(np.concatenate([cells, *more]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([counts, np.ones(len(at) - len(counts))]), len(cells))
    return cells, np.minimum(counts, 2).astype(np.uint8)


def sketch(keyed: DataFrame, window: int, gram: int, width: int) -> np.ndarray:
    """The bitmap of cells that were counted twice or more, one row of bits after the other; keyed has a column text."""
    parts = max(BLOCKS, -(-keyed.rdd.getNumPartitions() // PARTS))
    power = min((parts - 1).bit_length(), width - 3)  # blocks of a row, as a power of two; each has whole bytes of the bitmap
    low = np.uint64(0xFFFFFFFF)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, first, hashed, _ in _hashed(batch.column(0)):
                whole = W.starts_within(first, window, len(hashed))
                if not whole.any():
                    continue
                values, counts = np.unique(_anchors(hashed, whole, window, gram)[1], return_counts=True)
                values = np.repeat(values, np.minimum(counts, 2))
                cells = np.sort(np.concatenate([(x >> np.uint64(32 - power)) + np.uint64(row << (32 + power)) for row, x in enumerate(_rows(values))]))
                blocks = (cells >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(blocks)) + 1
                cells = (cells & low).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array(blocks[np.concatenate([[0], cuts])], pa.int64()), pa.array([c.tobytes() for c in np.split(cells, cuts)], pa.binary())], names=["block", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, more, size = None, [], 0
        none = np.zeros(0, "<u4"), np.zeros(0, np.uint8)
        held = none

        def out() -> Iterator[pa.RecordBatch]:
            cells, counts = _added(*held, more)
            twice = cells[counts > 1]
            if len(twice):
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([len(twice)], pa.int64()), pa.array([twice.tobytes()], pa.binary())], names=["block", "n", "cells"])

        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now:
                    if now is not None:
                        yield from out()
                    now, more, size, held = block, [], 0, none
                more.append(np.frombuffer(cells.as_buffer(), "<u4"))
                size += len(more[-1])
                if size > HELD:
                    held, more, size = _added(*held, more), [], 0
        if now is not None:
            yield from out()

    merged = keyed.select("text").mapInArrow(count, "block long, cells binary").repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, n long, cells binary")
    merged = cut(merged, "sketch")
    repeated = (merged.agg(F.sum("n")).first()[0] or 0) / 2
    # bits of a row in one block: whole bytes
    bits = 8 * min(max(1, math.ceil(repeated * SPARE / 8 / (1 << power))), 1 << (width - power - 3))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(2)):
                # the first 32 bits of the place, as in _maybe
                inner = block & ((1 << power) - 1)
                place = (np.frombuffer(cells.as_buffer(), "<u4").astype(np.uint64) >> np.uint64(power)) + np.uint64(inner << (32 - power))
                set_ = np.zeros(bits, np.uint8)
                set_[(place * np.uint64(bits << power) >> np.uint64(32)) - np.uint64(inner * bits)] = 1
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(set_).tobytes()], pa.binary())], names=["block", "bits"])

    whole = np.zeros((2 * bits << power) // 8, np.uint8)
    for r in merged.mapInArrow(lay, "block long, bits binary").toLocalIterator():
        whole[r.block * bits // 8 : (r.block + 1) * bits // 8] = np.frombuffer(r.bits, np.uint8)
    return whole


def _maybe(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Mask of the anchors that may have two places."""
    out = np.ones(len(anchors), bool)
    size = 4 * len(bits)  # bits of a row
    for row, x in enumerate(_rows(anchors)):
        cells = ((x >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)) + np.uint64(row * size)
        out &= (bits[cells >> np.uint64(3)] >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return out


def repeated_starts(keyed: DataFrame, window: int = WINDOW, gram: int = GRAM, width: int = WIDTH) -> DataFrame:
    """keyed: k1, k2, text, the same batches each time. Rows k1, k2, starts (packed word positions); a document may have several."""
    bits = keyed.sparkSession.sparkContext.broadcast(sketch(keyed, window, gram, width))
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int32()), ("known", pa.bool_())])

    def candidates(batch: pa.RecordBatch) -> Iterator[tuple]:
        """For slices: 128-bit hashes, row and start of the windows that may repeat, whether each repeats here, whether each is the one to send."""
        for i, first, hashed, again in _hashed(batch.column(2)):
            whole = W.starts_within(first, window, len(hashed))
            if not whole.any():
                continue
            least, _ = _anchors(hashed, whole, window, gram)
            turn = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            maybe = np.repeat(_maybe(bits.value, least[turn]), np.diff(np.append(turn, len(least)))) & whole
            at = np.flatnonzero(maybe)
            if not len(at):
                continue
            h1, h2 = W.grams(hashed, window)[at], W.grams(again(), window, _SECOND)[at]
            order = np.lexsort((h2, h1))
            a, b = h1[order], h2[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            many = np.repeat(np.diff(np.append(np.flatnonzero(new), len(at))), np.diff(np.append(np.flatnonzero(new), len(at)))) > 1
            here, send = np.empty(len(at), bool), np.empty(len(at), bool)
            here[order], send[order] = many, new
            row = np.searchsorted(first, at, "right") - 1
            yield h1, h2, row + i, (at - first[row]).astype(np.int32), here, send

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for h1, h2, row, start, here, one in candidates(batch):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1[one].view(np.int64), h2[one].view(np.int64), k1[row[one]], k2[row[one]], start[one], here[one])], schema=schema)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for _, _, row, start, here, _ in candidates(batch):
                if here.any():
                    yield _packed(k1[row[here]], k2[row[here]], start[here])

    buckets = BUCKETS * int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row so far, and whether it was given out
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, k1, k2, start, resolved = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if last is not None:
                h1, h2, k1, k2, start, resolved = (np.concatenate([[x], y]) for x, y in zip(last, (h1, h2, k1, k2, start, resolved)))
            same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
            twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            out = twice & ~resolved
            # copies of a document lie together: a start that was just given out needn't go again
            copy = same & (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1]) & (start[1:] == start[:-1])
            out[1:] &= ~(copy & (resolved | twice)[:-1])
            held.append([k1[out], k2[out], start[out].astype(np.int32)])
            last = h1[-1], h2[-1], k1[-1], k2[-1], start[-1], bool(resolved[-1] or twice[-1])
            if sum(len(x[0]) for x in held) > 1_000_000:
                yield _bucketed(*(np.concatenate(x) for x in zip(*held)), buckets)
                held = []
        if held and sum(len(x[0]) for x in held):
            yield _bucketed(*(np.concatenate(x) for x in zip(*held)), buckets)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> pa.RecordBatch:
            k1, k2, n, start = (np.concatenate(x) for x in zip(*held))
            return _packed(np.repeat(k1, n), np.repeat(k2, n), start)

        for batch in batches:
            for bucket, *row in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                if bucket != now and held:
                    yield out()
                    held = []
                now = bucket
                held.append([np.frombuffer(c.as_buffer(), t) for c, t in zip(row, ("<i8", "<i8", "<i4", "<i4"))])
        if held:
            yield out()

    rows = "h1 long, h2 long, k1 long, k2 long, start int, known boolean"
    met = keyed.mapInArrow(send, rows).repartition("h1").sortWithinPartitions("h1", "h2", "k1", "k2", "start").mapInArrow(meet, "bucket int, k1 binary, k2 binary, n binary, starts binary")
    met = met.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sort, "k1 long, k2 long, starts binary")
    return met.unionByName(keyed.mapInArrow(known, "k1 long, k2 long, starts binary"))


def _packed(k1: np.ndarray, k2: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """One row for each document with its starts as little-endian 32-bit integers."""
    order = np.lexsort((start, k2, k1))
    k1, k2, start = k1[order], k2[order], start[order].astype("<i4")
    one = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (start[1:] != start[:-1])])
    k1, k2, start = k1[one], k2[one], start[one]
    at = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
    return pa.RecordBatch.from_arrays([pa.array(k1[at]), pa.array(k2[at]), pa.array([x.tobytes() for x in np.split(start, at[1:])], pa.binary())], names=["k1", "k2", "starts"])


def _bucketed(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row for each bucket of documents: their keys, how many starts each has, and the starts."""
    bucket = ((k1.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((start, k2, k1, bucket))
    bucket, k1, k2, start = bucket[order], k1[order], k2[order], start[order].astype("<i4")
    docs = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
    n = np.diff(np.append(docs, len(k1))).astype("<i4")
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    of_doc = np.searchsorted(docs, first)[1:]
    packed = [np.split(x, at) for x, at in ((k1[docs], of_doc), (k2[docs], of_doc), (n, of_doc), (start, first[1:]))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *[pa.array([x.tobytes() for x in xs], pa.binary()) for xs in packed]], names=["bucket", "k1", "k2", "n", "starts"])


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, width: int = WIDTH, as_files: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words that stay, joined by a space), kept_sha256.

    as_files: docs is read from files as they lie, so it gives the same batches whenever it is read.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keys())
    if not as_files:
        keyed = cut(keyed, "documents")
    # copies of a document give equal lists, batch by batch: they become one on the map side
    found = repeated_starts(keyed.select("k1", "k2", "text"), window, gram, width).distinct().groupBy("k1", "k2").agg(F.collect_list("starts").alias("starts"))
    joined = keyed.join(found, ["k1", "k2"], "left").select("doc_id", "text", "starts")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept, sha = [], [], [], []
            for text, lists in zip(batch.column(1), batch.column(2)):
                ws = (text.as_py() or "").encode().split()
                n.append(len(ws))
                if lists.is_valid and len(lists):
                    edges = np.zeros(len(ws) + 1, np.int32)
                    for x in lists.as_py():
                        starts = np.unique(np.frombuffer(x, "<i4"))
                        np.add.at(edges, starts, 1)
                        np.add.at(edges, starts + window, -1)
                    stay = np.cumsum(edges[:-1]) == 0
                    ws = [ws[k] for k in np.flatnonzero(stay).tolist()]
                gone.append(n[-1] - len(ws))
                kept.append(b" ".join(ws))
                sha.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(sha)], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return joined.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
