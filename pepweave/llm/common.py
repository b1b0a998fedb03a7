"""Shared helpers: table reading, the shared folder, and text columns out of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pepweave.llm.words import slices
from pepweave.operators.shared import cut, shared_dir, spread


#: Text bytes that a task works on at once.
PORTION = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; the path is opened by Spark alone, so any file system it knows works.

    Documents that are read in fewer parts than there are cores are spread over all of them.
    """
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(found) if name == "documents" else found


def documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """The documents, and whether they are read from files as they lie: fewer parts than cores are dealt anew."""
    found = spark.read.parquet(f"{sf_dir}/documents.parquet")
    dealt = spread(found)
    return dealt, dealt is found


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/pepweave/{what}-{uuid.uuid4().hex}"


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and the n + 1 offsets of its rows; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def portions(batches: Iterator[pa.RecordBatch], column: int, size: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The rows of batches in turn, at most size bytes of a string column at once, or one row that is longer."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        for i, j in slices(offsets, size):
            yield batch.slice(i, j - i)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df does not have yet, one for each name."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while any(c.startswith(name) for c in have):
            name = f"_{name}"
        out.append(name)
    return out


def keys() -> tuple[Column, Column]:
    """Two columns that tell documents apart: a hash of id and text, and the id."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text").alias("k1"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k2")


__all__ = ["cut", "documents", "fresh", "keys", "portions", "scratch", "shared_dir", "table", "text_bytes", "total"]

#: Rows that total() brings to the driver at most.
TOTAL_ROWS = 8


def total(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of packed float64 arrays of one size (column ``v``), added up in two rounds of tasks that each hold one sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            for v in batch.column(0):
                out += np.frombuffer(v.as_buffer(), "<f8")
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["v"])

    many = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if many > TOTAL_ROWS:
        parts = parts.repartition(many).mapInArrow(add, "v binary")
    rows = parts.repartition(TOTAL_ROWS).mapInArrow(add, "v binary").collect()
    return np.sum([np.frombuffer(bytes(r.v), "<f8") for r in rows], axis=0) if rows else np.zeros(size)
