"""A corpus pipeline over documents: toxicity, exact dedup, SimHash near-dedup, decontamination, SentencePiece.

Each stage reads all that its predecessor kept, as Parquet, and its decisions take effect. All but the last return the
columns of documents; the last adds the number of ids and digests of the ids and of the text that they decode to.

In every stage a null text counts as empty, texts of any length are read whole, an empty table gives an empty result, and
further columns are passed by (but for columns that the last stage's results replace by name). Rows are told apart by what
they hold, not by doc_id alone: ids may repeat or be null, and only copies of a row's text decide about it. Rows that are
equal in every column are copies of each other, of which one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pepweave.llm import decontaminate, exact_dedup, sentencepieces, simhash, toxicity
from pepweave.llm.common import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic; equal texts fare alike, without labels of both classes all stay."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest as written, then the smallest id; all blank texts are one group."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: the smallest id, null only where no row has one; blank texts are one component."""
    return simhash.dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate; texts without words stay, an empty benchmark rejects none."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the documents that are left, as digests; every row stays."""
    return sentencepieces.round_trip(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash", drop_near_copies), ("decontaminate", drop_contaminated), ("sentencepiece", encode)]

#: Classifier and tokenizer are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, name)
    return docs
