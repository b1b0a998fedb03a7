"""Row numbers in a global order, and batches of rows, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pepweave.operators.shared import cut


def number_rows(df: DataFrame, *order: str, name: str = "row") -> DataFrame:
    """df with a number from 0 in the order of the columns.

    Rows are dealt by ranges, numbered inside their range, and shifted by the sizes of the ranges before: the driver sees
    one count per range.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = sorted(tuple(r) for r in dealt.groupBy("__part").count().collect())
    base, at = [], 0
    for part, n in sizes:
        base.append((part, at))
        at += n
    shift = df.sparkSession.createDataFrame(base, "__part int, __base long")
    inner = F.row_number().over(Window.partitionBy("__part").orderBy(*order)).cast("long") - 1
    return dealt.withColumn("__row", inner).join(F.broadcast(shift), "__part").withColumn(name, F.col("__row") + F.col("__base")).drop("__part", "__row", "__base")


def batches(df: DataFrame, column: str, size: int = 100, order: str | None = None) -> DataFrame:
    """batch, n, values (in order): fixed-size batches of a column."""
    numbered = number_rows(df.select(*{column, order or column}), order or column)
    pairs = numbered.groupBy(F.floor(F.col("row") / size).cast("long").alias("batch")).agg(F.sort_array(F.collect_list(F.struct("row", column))).alias("v"))
    return pairs.select("batch", F.size("v").cast("long").alias("n"), F.col("v")[column].alias("values"))


def any_of(batched: DataFrame, field: str = "accession") -> DataFrame:
    """batch, query: "field:(A OR B)" for each batch."""
    return batched.select("batch", F.concat(F.lit(f"{field}:("), F.array_join("values", " OR "), F.lit(")")).alias("query"))
