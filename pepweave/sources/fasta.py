"""FASTA files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """header (without >), seq (lines joined) and, if they lie in folders by query, query_id of each record; files are split between records."""
    raw = spark.read.option("lineSep", "\n>").text(path).where("trim(value) <> ''")
    return from_records(raw)


def from_records(raw: DataFrame) -> DataFrame:
    """The same of a column value with one record a row, with or without its >."""
    body = F.regexp_replace("value", "^>", "")
    lines = F.split(body, "\r?\n")
    return raw.select(*[c for c in raw.columns if c == "query_id"], lines[0].alias("header"), F.regexp_replace(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), ""), r"\s", "").alias("seq"))


def write_fasta(records: DataFrame, path: str) -> None:
    """Records (a column value each) as text files; where they have a query_id, each query's in a folder of its own."""
    if "query_id" in records.columns:
        records.select("query_id", "value").write.partitionBy("query_id").text(path)
    else:
        records.select("value").write.text(path)


def write_run(found: DataFrame, path: str, key: str = "run_prefix") -> None:
    """Result tables by run, each in a folder of its own."""
    found.write.mode("overwrite").partitionBy(key).parquet(path)
