"""Exact dedup: group by a 128-bit content hash, compare bytes inside groups, keep one row of each group.

Main path: DataFrame functions only, no Python workers.

1.  Every row gets its normalised text and the MD5 of it (128 bits).
2.  Rows are grouped by (hash, normalised text). The text in the key is the comparison of bytes: two texts that
    share a hash but not their bytes land in different groups. The grouping is combined on the map side, so a
    group that holds a third of all rows leaves each map task as one row; no task ever collects a group.
3.  Rows find their group again by the hash, SHA-256 and length of their text (slim rows, no text). Both sides of
    that join are plain exchanges, so Spark splits the partition of a large group.

Groups of one row are not joined at all: they are their own result.

Defined results: a null text counts as empty, so null, empty and all-blank texts are one group; a null doc_id
sorts after every other id; texts of any length are compared whole; an empty table gives an empty result. In ``mark``
rows that repeat a doc_id with an equal text count each in group_size and share ``kept``. ``dedup`` keeps exactly one row
of each group, whatever the ids: rows are told apart by id, length and text, and of rows that are equal in these the
hash of all columns chooses. It shuffles the rows whose hash repeats, and no others. Further columns, whatever their names, are passed by in ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pepweave.llm.common import cut, fresh

#: The characters [\\x20\\x09-\\x0D], which normalisation deletes.
BLANKS = " \t\n\x0b\x0c\r"
#: Bits of a part of a bitmap, as Spark's bitmap functions have it, and of the largest bitmap (16 MB).
BUCKET, MOST_BITS = 1 << 15, 1 << 27


def normalised(text: Column) -> Column:
    """The text without blanks; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for c in BLANKS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_cp (code points of the original text), norm, and h128, sha and size of norm for each row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_cp"), normalised(F.col("text")).alias("norm")
    ).withColumns({"h128": F.unhex(F.md5("norm")), "sha": F.unhex(F.sha2("norm", 256)), "size": F.octet_length("norm")})


def groups(docs: DataFrame) -> DataFrame:
    """One row per distinct normalised text with two or more rows: h128, sha, size, keep_id, group_size, keep_cp (code points of the row that stays)."""
    # one number orders rows by length first, then by smaller id; null ids come last
    order = F.expr("cast(n_cp as decimal(38,0)) * 18446744073709551616 - cast(coalesce(cast(doc_id as decimal(38,0)), 9223372036854775808) as decimal(38,0))").cast("decimal(38,0)")
    by_text = (
        fingerprints(docs).withColumn("best", order).groupBy("h128", "norm").agg(F.max_by("doc_id", "best").alias("keep_id"), F.count("*").alias("group_size"), F.max("n_cp").alias("keep_cp"))
    )
    return by_text.where(F.col("group_size") > 1).select("h128", F.unhex(F.sha2("norm", 256)).alias("sha"), F.octet_length("norm").alias("size"), "keep_id", "group_size", "keep_cp")


def mark(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = fingerprints(docs).select("doc_id", "h128", "sha", "size")
    joined = rows.join(groups(docs).withColumn("found", F.lit(True)), ["h128", "sha", "size"], "left")
    keep = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def _bit(h: Column, bits: int) -> Column:
    """A number below bits (a power of two, at most 2**28) from a hash's first digits; bitmap functions count from 1."""
    return F.conv(F.substring(F.hex(h), 1, 8), 16, 10).cast("long") % bits + 1


def _repeated(docs: DataFrame) -> tuple[DataFrame, int]:
    """A bitmap of the hashes that more than one row has (bucket, bitmap), and its number of bits.

    Some 64 bits a hash, so of rows that are alone about one in 64 finds its bit set; beyond MOST_BITS it is more of them,
    and what is broadcast stays as large as it is.
    """
    h = F.unhex(F.md5(normalised(F.col("text")))).alias("h")
    found = cut(docs.select(h).groupBy("h").count().where("count > 1").select("h"), "repeated")
    bits = min(MOST_BITS, max(BUCKET, 1 << (64 * found.count()).bit_length()))
    at = _bit(F.col("h"), bits)
    return cut(found.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")), "bitmap"), bits


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each group.

    Rows whose hash no other row has stay where they lie. The others, found by a bitmap of bounded size, meet under hash
    and text, and the best of a group leaves each task as one row: only their texts are shuffled.
    """
    row, h, norm, bucket, bitmap = fresh(docs, "own_row", "own_h", "own_norm", "own_bucket", "own_bitmap")
    repeated, bits = _repeated(docs)
    rows = docs.select(F.struct("*").alias(row), normalised(F.col("text")).alias(norm)).withColumn(h, F.unhex(F.md5(norm)))
    at = _bit(F.col(h), bits)
    rows = rows.withColumn(bucket, F.bitmap_bucket_number(at)).join(F.broadcast(repeated.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap))), bucket, "left")
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    met = F.coalesce(F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    whole, own = F.col(row), F.col(f"{row}.doc_id").cast("long")
    # the longest as written, then the smallest id, null ids last; of rows that are equal in these the hash of all columns chooses
    order = F.struct((-F.length(F.coalesce(F.col(f"{row}.text"), F.lit("")))).alias("n"), own.isNull().alias("none"), own.alias("id"), F.xxhash64(whole).alias("x"))
    best = rows.where(met).groupBy(h, norm).agg(F.min_by(whole, order).alias(row))
    return rows.where(~met).select(f"{row}.*").unionByName(best.select(f"{row}.*"))
