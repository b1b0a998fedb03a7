"""Variant budgets per accession and mass bin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: In files: no limit. Beyond a byte nothing can be stored.
UNLIMITED = 255


def bin_of(upper: Column, n_bins: int, max_query: int) -> Column:
    """Bin of a query: upper div (max_query div n_bins) - 1, held within the bins; below the first or without a width, the last."""
    width = max_query // n_bins
    x = F.expr("cast(null as bigint)") if width == 0 else F.floor(upper / F.lit(width)) - 1
    return F.when(x.isNull() | (x < 0), F.lit(n_bins - 1)).otherwise(F.least(x, F.lit(n_bins - 1))).cast("int")


def bin_by_edges(upper: Column, edges: list[int]) -> Column:
    """Bin of a query by explicit ascending upper edges; beyond the last edge, the last bin."""
    out = F.lit(len(edges) - 1)
    for k in reversed(range(len(edges) - 1)):
        out = F.when(upper <= edges[k], F.lit(k)).otherwise(out)
    return out


def budget(stored: Column) -> Column:
    """max_vars of a stored number: 255 is unlimited (null), others are themselves; outside 0..255 is an error."""
    n = stored.cast("int")
    fault = F.raise_error(F.concat(F.lit("budget outside 0..255: "), n.cast("string"))).cast("int")
    return F.when(n == UNLIMITED, F.lit(None).cast("int")).when((n >= 0) & (n < UNLIMITED), n).when(n.isNull(), F.lit(None).cast("int")).otherwise(fault)


def constant_limits(accessions: DataFrame, n_bins: int, max_vars: int) -> DataFrame:
    """acc, bin, max_vars: the same budget for every accession and bin."""
    return accessions.select("acc", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"), F.lit(max_vars).alias("max_vars"))


def with_budget(rows: DataFrame, limits: DataFrame, missing: str = "raise") -> DataFrame:
    """rows (acc, bin, ...) with max_vars of their accession and bin. missing: raise, unlimited or zero.

    An accession may be listed repeatedly with one budget; different ones are an error.
    """
    stored = F.coalesce("max_vars", F.lit(UNLIMITED))
    known = limits.groupBy("acc", "bin").agg(F.min(stored).alias("stored"), F.max(stored).alias("other"), F.lit(True).alias("known"))
    torn = F.raise_error(F.concat(F.lit("different budgets for "), F.col("acc"))).cast("int")
    fault = {"raise": F.raise_error(F.concat(F.lit("no budget for "), F.col("acc"))).cast("int"), "unlimited": F.lit(None).cast("int"), "zero": F.lit(0)}[missing]
    found = F.when(F.col("stored") != F.col("other"), torn).when(F.col("known"), budget(F.col("stored"))).otherwise(fault)
    return rows.join(known, ["acc", "bin"], "left").withColumn("max_vars", found).drop("stored", "other", "known")
