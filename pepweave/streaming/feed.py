"""A stream of query files against standing graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pepweave.operators import render
from pepweave.operators.graph import Graphs
from pepweave.operators.shared import temporary
from pepweave.operators.traverse import traverse
from pepweave.sources import inputs


def answer_queries(spark: SparkSession, graphs: Graphs, source: str, sink: str, checkpoint: str, max_vars: int | None = None, max_missed: int | None = None) -> StreamingQuery:
    """Enumerate each new query file's peptides and append them to a Parquet table, by batch.

    A batch that is run again after a failure replaces its own folder, so every query is answered once.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        found = inputs.queries(batch).withColumn("query_id", F.monotonically_increasing_id()).withColumn("max_vars", F.lit(max_vars).cast("int"))
        if found.isEmpty():
            return
        with temporary(spark):
            paths = traverse(graphs, found, max_missed, carry=render.NEEDED).paths
            answers = render.headers(render.peptides(paths, graphs.graphs)).join(found.select("query_id", F.col("lower").alias("from"), F.col("upper").alias("to")), "query_id")
            answers.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    return spark.readStream.format("text").load(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
