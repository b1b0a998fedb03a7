"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Scopes that are open in this process, each a list of the folders that were written in it.
_scopes: list[list[str]] = []
_lock = threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where it is unset and all tasks run on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pepweave-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    """A new folder's path below the shared folder; open scopes remove it when they end."""
    path = f"{shared_dir(spark)}/pepweave/{what}-{uuid.uuid4().hex}"
    with _lock:
        for scope in _scopes:
            scope.append(path)
    return path


#: Intermediate tables are written once and read a few times, so what they take on disk counts.
CODEC = "zstd"


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write df and read it back: lineage ends there and survives lost executors."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_dealt(df: DataFrame, what: str, parts: int, dealt: bool = False) -> DataFrame:
    """cut() into buckets by graph_id: what is joined, grouped or windowed by graph afterwards isn't shuffled.

    dealt: df's tasks hold whole buckets already, though its plan can't tell (it comes from Python workers). The table is
    in the catalog only until its folder is known. Two settings stay set: scans keep their buckets whatever reads them, and
    joins by graph and more take rows that are dealt by graph.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    name = f"pepweave_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(parts, "graph_id")
    rows.write.format("parquet").option("compression", CODEC).bucketBy(parts, "graph_id").option("path", fresh_path(spark, what)).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


#: Rows of a part, for the number of parts that graphs are dealt to.
PART_ROWS = 250_000


def parts_for(spark: SparkSession, rows: int) -> int:
    """How many parts to deal tables of so many nodes to: the shuffle partitions, more if these would be large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """A scope for a result that is written inside it: intermediate tables that were written meanwhile are removed at its end.

    What is returned out of a scope must not read them. Scopes may lie in each other; jobs of other threads that run
    meanwhile count to all open scopes, so one scope is for all that runs side by side.
    """
    own: list[str] = []
    with _lock:
        _scopes.append(own)
    try:
        yield
    finally:
        with _lock:
            _scopes[:] = [s for s in _scopes if s is not own]
        for path in own:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame) -> DataFrame:
    """df on as many partitions as there are cores, if its scan gives fewer; larger tables stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
