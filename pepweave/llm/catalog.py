"""Queries opN_<name> over the whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pepweave.llm import conversations, decontaminate, exact_dedup, line_dedup, masked_lm, packing, secret_scan, sentencepieces, simhash, spelling, substring_dedup, token_store, toxicity
from pepweave.llm.common import documents, scratch, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated passages from documents."""
    docs, as_files = documents(spark, sf_dir)
    return substring_dedup.removals(docs, as_files=as_files).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of documents, written to a store and read back from it."""
    path = scratch(spark, "tokens")
    token_store.write(table(spark, sf_dir, "documents"), path, literals=True)
    return token_store.checksums(token_store.read(spark, path))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents and the texts that they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return sentencepieces.round_trip(docs).drop("text")


def contamination(found: DataFrame) -> DataFrame:
    """The columns that op4 returns."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of each document by the benchmark."""
    return contamination(decontaminate.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def secret_digest(found: DataFrame) -> DataFrame:
    """The columns that op5 returns."""
    said = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.filter(said, lambda s: ~s.startswith("named:"))
    n = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint) as n_{k}") for k in secret_scan.KINDS[:3]]
    return found.select("doc_id", *n, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(said, ",").alias("spans"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in documents."""
    return secret_digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of lines that many sources share from documents."""
    found = line_dedup.removals(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of documents, one row per document."""
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of documents."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihoods of documents under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents")
    counts = masked_lm.word_counts(docs)
    return masked_lm.score_words(docs, masked_lm.train(docs, counts=counts), counts)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of documents by SimHash."""
    found = simhash.cluster(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of damaged conversations."""
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_store": op2_token_store,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontaminate": op4_decontaminate,
    "op5_secret_scan": op5_secret_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_masked_lm": op9_masked_lm,
    "op10_simhash": op10_simhash,
    "op11_packing": op11_packing,
    "op12_conversations": op12_conversations,
    "op13_spelling": op13_spelling,
}

ORACLES = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, k, list_slice(w, k, k + 34) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d WHERE len(w) >= 35)),
rep AS (SELECT g FROM (SELECT md5(array_to_string(g, ' ')) AS g FROM win) GROUP BY g HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(k, k + 35)) AS p FROM win WHERE md5(array_to_string(g, ' ')) IN (SELECT g FROM rep)) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ') ELSE coalesce(array_to_string([x[1] FOR x IN list_zip(w, range(1, len(w) + 1)) IF NOT list_contains(ps, x[2])], ' '), '') END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
""",
    "op4_decontaminate": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, w[k:k + 12] AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT len(g) AS n FROM iw),
dg AS (
  SELECT doc_id, k, n, w[k:k + n - 1] AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, k, n, item_id FROM dg JOIN iw USING (g)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op6_line_dedup": r"""
WITH l AS (SELECT doc_id, source, pos, ls[pos] AS line FROM (SELECT doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS pos FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents))),
many AS (SELECT trim(line) AS line FROM l WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 10),
marked AS (SELECT l.doc_id, l.pos, l.line, many.line IS NOT NULL AS gone FROM l LEFT JOIN many ON trim(l.line) = many.line),
per AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS n_gone, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS kept FROM marked GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN per USING (doc_id)
""",
    "op7_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_cp DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
""",
}
