"""Run sheets from reading to published tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pepweave.functions.peptides import SCALE
from pepweave.operators import batches, budgets, compare
from pepweave.operators.graph import Graphs
from pepweave.operators.shared import temporary
from pepweave.plans.runs import Run, read_peptides
from pepweave.sources import inputs
from pepweave.sources.fasta import write_run


def observed(found: DataFrame, name: str = "answered") -> tuple[DataFrame, Observation]:
    """Peptides that are counted while they are written: rows, graphs and weights that a job has gone through, without a job of their own."""
    seen = Observation(name)
    return found.observe(seen, F.count("*").alias("paths"), F.min("w").alias("least"), F.max("w").alias("most"), F.max("mssclvg").alias("missed")), seen


def progress_lines(queries: DataFrame) -> DataFrame:
    """value: a line for each query that was answered, in dalton."""
    whole = lambda c: (F.col(c) / SCALE).cast("long").cast("string")
    return queries.select(F.concat(F.lit("Processed Query "), F.col("query_id").cast("string"), F.lit(" with: "), whole("lower"), F.lit(":"), whole("upper")).alias("value"))


def build_input(spark: SparkSession, accessions: str, queries: str, flat: str, max_vars: int, out: str, column: int = 0, header: bool = False, batch: int = 100) -> dict[str, str]:
    """All that a run reads, from a list of accessions, mass queries and flat protein text: the paths of what is written.

    queries: whole dalton, one head line a file; limits: the same budget for every accession in one bin; entries: the flat
    entries of the listed accessions; asked: a text for each batch of accessions, as one would ask a service for them. An
    accession that is listed twice has one entry and one budget.
    """
    paths = {name: f"{out}/{name}" for name in ("queries", "limits", "entries", "asked")}
    listed = inputs.read_accessions(spark, accessions, column, header)
    unique = listed.distinct()
    inputs.write_queries(inputs.read_queries(spark, queries), paths["queries"])
    inputs.write_limits(budgets.constant_limits(unique, 1, max_vars), paths["limits"])
    found = inputs.read_flat(spark, flat).join(unique, "acc", "left_semi")
    found.select(F.concat("entry", F.lit("\n//")).alias("value")).write.text(paths["entries"])
    batches.any_of(batches.batches(listed, "acc", batch)).select(F.col("query").alias("value")).write.text(paths["asked"])
    return paths


def execute(spark: SparkSession, sheet: str, branches: Callable[[str], dict[str, Graphs]], pairs: list[tuple[str, str]], out: str) -> DataFrame:
    """Every run of a sheet: peptides of each branch and the differences of the pairs, published by run_prefix below out.

    branches gives the graphs for a run's input_file. The sheet is a list of runs that somebody typed; runs follow each
    other, and each is one distributed job. Returns run_prefix, left, right, n: how many sequences differ.
    """
    told = []
    for row in inputs.read_run_sheet(spark, sheet).collect():
        with temporary(spark):  # what a run writes on its way goes when its results are published
            told += _execute(spark, row, branches, pairs, out)
    return spark.createDataFrame(told, "run_prefix string, left string, right string, n long")


def _execute(spark: SparkSession, row, branches: Callable[[str], dict[str, Graphs]], pairs: list[tuple[str, str]], out: str) -> list[tuple]:
    run, told = Run(None if row.max_vars == 255 else row.max_vars, row.max_cleavages, row.run_prefix), []
    queries = inputs.read_queries(spark, row.query_file)
    found = {name: read_peptides(g, queries, run) for name, g in branches(row.input_file).items()}
    for name, df in found.items():
        sequences = df.select(F.lit(run.run_prefix).alias("run_prefix"), "seq", "header")
        write_run(sequences, f"{out}/peptides/{name}/{run.run_prefix}")
    for left, right in pairs:
        diff = compare.multiset_diff(found[left].select("seq").distinct(), found[right].select("seq").distinct())
        path = f"{out}/diff/{left}-{right}/{run.run_prefix}"
        write_run(diff.withColumn("run_prefix", F.lit(run.run_prefix)), path)
        told.append((run.run_prefix, left, right, spark.read.schema("side string, seq string, n long, run_prefix string").parquet(path).count()))
    return told
