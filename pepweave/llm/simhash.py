"""SimHash near-dedup by tiled exact comparison.

1.  Fingerprint: XXH64 (seed 42) of every shingle of SHINGLE words, counted bit by bit; a bit is 1 if set in over half.
2.  Equal fingerprints become one (an aggregate that combines on the map side), whatever the size of their group.
3.  The distinct fingerprints are sorted by population count, first of all 64 bits, then of each byte, and cut into tiles.
    A tile keeps the least and greatest of each count. Two fingerprints that differ in r bits differ by at most r in
    their counts (and by at most r in the sum over bytes), so tile pairs further apart than the radius are skipped;
    inside a pair the same test skips blocks.
4.  What is left is compared exactly: exclusive-or and bit counts in numpy. Tiles go out by square of 2**SQUARE by
    2**SQUARE neighbours, so a tile is sent once for all its pairs in a square. A tile pair gives a spanning forest of
    its links (at most as many links as it has fingerprints), never all pairs of a group.
5.  Links become components by contraction (see components).

Only tile boundaries are matched against each other by a join; fingerprints and links never reach the driver.

Defined results: null and blank texts have fingerprint zero and are linked like any other; texts of any length are read
whole; a null doc_id takes part but is never the smallest id unless all ids of a component are null; rows that repeat a
doc_id are separate rows, and dedup() keeps one row of each component whatever their ids; an empty table gives an empty
result; further columns, whatever their names, are passed by in dedup() and left out by cluster().
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pepweave.llm import words as W
from pepweave.llm.common import cut, fresh, keys, text_bytes
from pepweave.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints in a tile, and in a block inside a tile.
TILE, BLOCK = 4096, 256
#: Neighbouring tiles of a square, as a power of two.
SQUARE = 3


def fingerprint(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of one lower-cased UTF-8 text, as eight bytes."""
    ws = text.split()  # bytes.split cuts at exactly [\x20\x09-\x0D]
    if not ws:
        return np.zeros(8, np.uint8)
    joined = b" ".join(ws)
    ends = list(accumulate([len(w) + 1 for w in ws]))
    n = max(1, len(ws) - shingle + 1)
    starts = [0, *ends[: n - 1]]
    ends = ends[-n:]
    h = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        hs = np.array([h(joined[s : e - 1], SEED) for s, e in zip(starts[k : k + (1 << 16)], ends[k : k + (1 << 16)])], np.uint64)
        counts += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > n, bitorder="little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of each row and, if asked for, its keys k1, k2."""
    more = list(keys()) if keyed else []
    names = ["doc_id", "fp", "k1", "k2"][: 2 + len(more)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            low = W.LOWER[raw].tobytes()
            fps = [fingerprint(low[s:e], shingle) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            fp = np.concatenate(fps).view(np.int64) if fps else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), *batch.columns[2:]], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more).mapInArrow(work, ", ".join(f"{n} long" for n in names))


def counts_of(fps: np.ndarray) -> np.ndarray:
    """Population counts of the eight bytes, one row per fingerprint."""
    return np.bitwise_count(fps.view(np.uint8).reshape(-1, 8)).astype(np.int16)


def box(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest counts: of all bits, then of each byte."""
    c = np.column_stack([c.sum(axis=1), c])
    return c.min(axis=0), c.max(axis=0)


def tiles(distinct: DataFrame, size: int = TILE) -> DataFrame:
    """distinct: fp. Rows of at most size fingerprints that are close in the order of counts: tile, lo, hi, fps."""
    byte = [F.bit_count(F.shiftright("fp", 8 * k).bitwiseAND(F.lit(255))) for k in range(3)]
    ordered = distinct.select("fp", F.bit_count("fp").alias("c"), *[b.alias(f"b{k}") for k, b in enumerate(byte)])
    ordered = ordered.repartitionByRange("c", "b0", "b1", "b2", "fp").sortWithinPartitions("c", "b0", "b1", "b2", "fp").select("fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, rest = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)

        def out(fps: np.ndarray, k: int) -> pa.RecordBatch:
            lo, hi = box(counts_of(fps))
            return pa.RecordBatch.from_pylist([{"tile": (part << 32) + k, "lo": lo.tolist(), "hi": hi.tolist(), "fps": fps.tobytes()}], schema=SCHEMA)

        for batch in batches:
            rest = np.concatenate([rest, batch.column(0).to_numpy()])
            while len(rest) >= size:
                yield out(rest[:size], k)
                rest, k = rest[size:], k + 1
        if len(rest):
            yield out(rest, k)

    return ordered.mapInArrow(work, "tile long, lo array<int>, hi array<int>, fps binary")


SCHEMA = pa.schema([("tile", pa.int64()), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())), ("fps", pa.binary())])


def tile_pairs(tiled: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: tiles (a <= b) whose counts allow a link.

    Tiles meet where a count of all bits and one of the first byte's bits are in reach, some 600 places over which the
    join is dealt, and each pair is kept at the least place that it meets at.
    """
    slim = tiled.select("tile", "lo", "hi")

    def spread(side: str, reach: int) -> DataFrame:
        at = lambda k: F.explode(F.sequence(F.col("lo")[k] - reach, F.col("hi")[k] + reach))
        own = slim.select(F.col("tile").alias(side), F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}"), "lo", "hi", at(0).alias("c"))
        return own.withColumn("d", at(1)).drop("lo", "hi")

    met = spread("a", 0).join(spread("b", radius), ["c", "d"]).where(F.col("a") <= F.col("b"))
    least = lambda k: F.greatest(F.col("lo_a")[k], F.col("lo_b")[k] - radius)
    met = met.where((F.col("c") == least(0)) & (F.col("d") == least(1)))
    gap = " + ".join(f"greatest(0, lo_a[{k}] - hi_b[{k}], lo_b[{k}] - hi_a[{k}])" for k in range(1, 9))
    return met.where(F.expr(gap) <= radius).select("a", "b")


def forest(x: np.ndarray, y: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among and between the fingerprints of two tiles (links within x or y only as far as x is y)."""
    same = x is y
    nodes = x if same else np.concatenate([x, y])
    shift = 0 if same else len(x)
    label = np.arange(len(nodes))

    def boxes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = counts_of(v)
        return tuple(np.array(z) for z in zip(*[box(c[k : k + BLOCK]) for k in range(0, len(v), BLOCK)]))

    (lo_x, hi_x), (lo_y, hi_y) = boxes(x), boxes(y)
    for bx in range(len(lo_x)):
        gap = np.maximum(0, np.maximum(lo_y - hi_x[bx], lo_x[bx] - hi_y))
        near = (gap[:, 0] <= radius) & (gap[:, 1:].sum(axis=1) <= radius)
        if same:
            near[:bx] = False
        if not near.any():
            continue
        where = np.flatnonzero(np.repeat(near, BLOCK)[: len(y)])
        other = y[where]
        for s in range(bx * BLOCK, min(len(x), (bx + 1) * BLOCK), 32):
            rows = x[s : min(s + 32, (bx + 1) * BLOCK)]
            # unsigned: of negative numbers, bitwise_count counts the absolute value's bits
            close = np.bitwise_count((rows[:, None] ^ other[None, :]).view(np.uint64)) <= radius
            flat = np.flatnonzero(close)
            if not len(flat):
                continue
            i, j = flat // len(where) + s, where[flat % len(where)] + shift
            while True:
                li, lj = label[i], label[j]
                apart = li != lj
                if not apart.any():
                    break
                i, j, li, lj = i[apart], j[apart], li[apart], lj[apart]
                np.minimum.at(label, np.maximum(li, lj), np.minimum(li, lj))
                while True:
                    up = label[label]
                    if (up == label).all():
                        break
                    label = up
    moved = np.flatnonzero(label != np.arange(len(label)))
    return nodes[label[moved]], nodes[moved]


def links(distinct: DataFrame, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """distinct: fp. Links a, b that connect the same fingerprints as all links within the radius do."""
    tiled = cut(tiles(distinct, size), "tiles")
    square = [F.shiftright(c, SQUARE).alias(f"s{c}") for c in ("a", "b")]
    pairs = cut(tile_pairs(tiled, radius).select(*square, "a", "b"), "pairs")
    asked = pairs.select("sa", "sb", F.explode(F.array("a", "b")).alias("tile")).distinct()
    sent = asked.join(tiled.select("tile", "fps"), "tile").select(F.col("sa").alias("ta"), F.col("sb").alias("tb"), "tile", "fps")

    def compare(held: pa.Table, wanted: pa.Table) -> pa.Table:
        fps = {t: np.frombuffer(v, np.int64) for t, v in zip(held.column("tile").to_pylist(), held.column("fps").to_pylist())}
        found = [forest(fps[a], fps[a] if a == b else fps[b], radius) for a, b in zip(wanted.column("a").to_pylist(), wanted.column("b").to_pylist())]
        return pa.table({"a": np.concatenate([x for x, _ in found]), "b": np.concatenate([y for _, y in found])})

    return sent.groupBy("ta", "tb").cogroup(pairs.groupBy("sa", "sb")).applyInArrow(compare, "a long, b long")


def components_of(prints: DataFrame, order: Column, radius: int, size: int) -> DataFrame:
    """fp, least (by order) of all rows of its component, found (true); components of one row are left out."""
    distinct = cut(prints.groupBy("fp").agg(F.min(order).alias("least"), F.count("*").alias("n")), "distinct")
    labels = components(links(distinct.select("fp"), radius, size))
    known = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").where((F.col("n") > 1) | F.col("label").isNotNull())
    known = known.select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = known.groupBy("label").agg(F.min("least").alias("component_least"))
    return known.join(least, "label").select("fp", F.col("component_least").alias("least"), F.lit(True).alias("found"))


def cluster(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """Per row: doc_id, fp (signed long), component_id."""
    prints = cut(fingerprints(docs, shingle), "prints")
    of_print = components_of(prints, F.col("doc_id"), radius, size)
    return prints.join(of_print, "fp", "left").select("doc_id", "fp", F.when(F.col("found"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """The rows of docs that stay: of each component the row with its smallest doc_id, with all columns.

    Rows are told apart by id and text, not by id alone. Where a component's smallest id is repeated, or all are null, the
    texts' hashes choose; rows that repeat id and text are one.
    """
    prints = cut(fingerprints(docs, shingle, keyed=True), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    rows = prints.join(components_of(prints, order, radius, size), "fp")
    stays = (F.col("k1") == F.col("least.k1")) & (F.col("k2") == F.col("least.k2"))
    k1, k2 = fresh(docs, "key_one", "key_two")
    groups = rows.groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.max(stays).alias("stays"), F.count("*").alias("n"))
    leave = cut(groups.where(~F.col("stays") | (F.col("n") > 1)), "gone")
    keyed = docs.select(*docs.columns, *[k.alias(name) for k, name in zip(keys(), (k1, k2))])
    out = keyed.join(leave.select(k1, k2), [k1, k2], "left_anti").select(*docs.columns)
    repeated = leave.where("stays").select(k1, k2)
    if repeated.isEmpty():
        return out
    again = keyed.join(repeated, [k1, k2], "left_semi").groupBy(k1, k2).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row"))
    return out.unionByName(again.select("row.*"))
