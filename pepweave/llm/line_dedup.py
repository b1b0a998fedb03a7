"""Line dedup by the spread of a line over sites.

A line is boilerplate if its trimmed form occurs on SITES distinct sources or more, however often on each. Sources of a
line are counted by a HyperLogLog sketch per line hash, merged by aggregation on the map side and after the exchange, so
a line that a third of all documents hold is one small sketch per task. A sketch that estimates more than BAND times the
threshold, or less than a BAND-th of it, decides; lines between get an exact distinct count. Only lines that are removed
go back to their documents, by a join on the document's key.

DataFrame functions only. Defined results: a null text has no lines; blank lines are never boilerplate; a null source is
no site; documents without lines keep an empty text; rows that repeat an id and a text are separate documents, ids may
be null; texts of any length are read whole; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pepweave.llm.common import cut, keys

SITES, BAND = 10, 2
#: Sketch size: 2**LG_K registers, a relative error of about 1.04 / sqrt(2**LG_K).
LG_K = 10


def _hashes(line: Column) -> list[Column]:
    """128 bits that stand for a trimmed line: two hashes of its bytes from different seeds (a column after it would only hash the first hash again)."""
    return [F.xxhash64(F.trim(line)).alias("l1"), F.xxhash64(F.lit(1), F.trim(line)).alias("l2")]


def lines(docs: DataFrame) -> DataFrame:
    """k1, k2, source and the hashes l1, l2 of each line that isn't blank."""
    split = docs.select(*keys(), "source", F.explode(F.split("text", "\n")).alias("line"))
    return split.where(F.trim("line") != "").select("k1", "k2", "source", *_hashes(F.col("line")))


def spread(found: DataFrame, sites: int = SITES, band: int = BAND) -> DataFrame:
    """l1, l2 of the lines on so many sites."""
    placed = found.where(F.col("source").isNotNull())
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("source", F.lit(LG_K)))
    guess = cut(placed.groupBy("l1", "l2").agg(estimate.alias("n")).where(F.col("n") * band >= sites), "spread")
    near = guess.where(F.col("n") <= sites * band).select("l1", "l2")
    exact = placed.join(near, ["l1", "l2"], "left_semi").groupBy("l1", "l2").agg(F.countDistinct("source").alias("n")).where(F.col("n") >= sites)
    return guess.where(F.col("n") > sites * band).select("l1", "l2").unionByName(exact.select("l1", "l2"))


def removals(docs: DataFrame, sites: int = SITES, band: int = BAND) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, kept (the text without boilerplate lines)."""
    found = lines(docs)
    gone = found.join(spread(found, sites, band), ["l1", "l2"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("l1", "l2")).alias("gone"))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keys())
    split = F.when(F.col("text").isNull(), F.array().cast("array<string>")).otherwise(F.split("text", "\n"))
    kept = F.filter("lines", lambda x: ~F.array_contains("gone", F.struct(*_hashes(x))))
    out = whole.join(gone, ["k1", "k2"], "left").select("doc_id", split.alias("lines"), "gone")
    out = out.withColumn("kept", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept))
    return out.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"), F.array_join("kept", "\n").alias("kept")
    )
