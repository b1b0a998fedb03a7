"""Flat protein text: entries with accessions, isoforms, features and a sequence, read into columns and written from tables.

An entry is what stands before a line "//". Files are split between entries by Spark's text reader, and everything is
parsed by column expressions. Of the lines these are read: AC (accessions), CC (isoforms: IsoId, Sequence), FT (features: a
key, a location, and qualifiers on lines of their own) and SQ with the blocks that follow it. What a variant does is told
by its note: "A -> T", with sequences of any length, or "Missing".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = "struct<key:string,isoform:string,begin:int,end:int,original:string,replacement:string,id:string,source:string>"
#: Columns of the FT lines, and the width of their text.
_KEY, _BODY, _BLOCK, _LINE = "FT   ", "FT                   ", 10, 60


def _lines(code: str) -> Column:
    """The lines of one code."""
    return F.filter("lines", lambda x: x.startswith(code))


def _qualifier(text: Column, name: str) -> Column:
    """The quoted value of a qualifier, null if there is none."""
    found = F.regexp_extract(text, rf'/{name}="([^"]*+(?:""[^"]*+)*+)"', 1)
    return F.when(text.contains(f'/{name}="'), found)


def _features(texts: Column) -> Column:
    """Features from their lines. Each step binds what the next ones read several times, as lambdas share nothing."""
    change = r"^([A-Z][A-Z ]*) -> ([A-Z](?:[A-Z]| (?=[A-Z]{2}))*)"
    place = r"^FT   (\S+) +(?:([A-Za-z0-9]+-[0-9]+):)?([0-9]+)(?:\.\.([0-9]+))?(?: |$).*"
    told = F.transform(texts, lambda t: F.regexp_replace(t, r"\r?\nFT +", " "))
    told = F.transform(told, lambda t: F.struct(t.alias("t"), _qualifier(t, "note").alias("note"), _qualifier(t, "id").alias("id"), _qualifier(t, "source").alias("source"),
        # a location that isn't known leaves the text without a part
        F.split(F.when(t.rlike(place), F.regexp_replace(t, "(?s)" + place, "$2\n$3\n$4")), "\n").alias("at"),
        F.regexp_extract(t, r"^FT   (\S+)", 1).alias("key")))
    part = lambda x, k: F.nullif(F.get(x["at"], k), F.lit(""))
    side = lambda x, k: F.nullif(F.replace(F.regexp_extract(x["note"], change, k), F.lit(" "), F.lit("")), F.lit(""))
    return F.transform(told, lambda x: F.struct(
        x["key"].alias("key"), part(x, 0).alias("isoform"), part(x, 1).try_cast("int").alias("begin"), F.coalesce(part(x, 2).try_cast("int"), part(x, 1).try_cast("int")).alias("end"), side(x, 1).alias("original"),
        F.when(x["note"].startswith("Missing"), F.lit("")).otherwise(side(x, 2)).alias("replacement"), x["id"].alias("id"),
        F.coalesce(x["source"], F.when(x["id"].startswith("VAR_"), F.lit("uniprot")), F.lit("unknown")).alias("source"),
    ))


def parse(raw: DataFrame) -> DataFrame:
    """acc, accessions, sequence, features (see FEATURE), isoforms (id, parts) of entries (value).

    acc is the first accession; an entry without one has null. A feature whose location isn't known has null bounds. An
    isoform's parts are the features that make it, none for the sequence as it is shown.
    """
    entry = F.col("value")
    # a plain line feed is split without a pattern
    raw = raw.select("value", F.split(F.when(entry.contains("\r"), F.replace(entry, F.lit("\r\n"), F.lit("\n"))).otherwise(entry), "\n").alias("lines"))
    named = F.regexp_extract_all(F.concat(F.lit("\n"), entry), F.lit(r"\nAC   ([^\n]*)"), F.lit(1))
    accessions = F.filter(F.transform(F.split(F.regexp_replace(F.array_join(named, " "), r"\r(?= |$)", ""), ";"), lambda y: F.trim(y)), lambda x: x != "")
    blocks = F.when(F.concat(F.lit("\n"), entry).contains("\nSQ   "), F.regexp_replace(F.substring_index(F.concat(F.lit("\n"), entry), "\nSQ   ", -1), r"^[^\n]*\n?", ""))
    features = F.filter(F.split(F.array_join(_lines("FT   "), "\n"), r"\r?\n(?=FT   \S)"), lambda x: x != "")
    comments = F.regexp_replace(F.array_join(F.transform(_lines("CC   "), lambda x: F.trim(F.substring(x, 6, 1 << 30))), " "), r" +", " ")
    isoform = r"IsoId=([^;,]+)[^;]*; Sequence=([^;]+);"
    zipped = F.arrays_zip(F.regexp_extract_all(comments, F.lit(isoform), F.lit(1)).alias("id"), F.regexp_extract_all(comments, F.lit(isoform), F.lit(2)).alias("made"))
    return raw.select(
        F.try_element_at(accessions, F.lit(1)).alias("acc"), accessions.alias("accessions"), F.upper(F.regexp_replace(F.coalesce(blocks, F.lit("")), "[^A-Za-z]", "")).alias("sequence"), _features(features).alias("features"),
        F.transform(zipped, lambda x: F.struct(F.trim(x["id"]).alias("id"), F.filter(F.transform(F.split(x["made"], ","), lambda y: F.trim(y)), lambda y: y.startswith("VSP_")).alias("parts"))).alias("isoforms"),
    )


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Parsed entries of flat text files (see parse)."""
    return parse(spark.read.option("lineSep", "\n//\n").text(path).where(r"trim(regexp_replace(value, '^//|[\\s]', '')) <> ''"))


def proteins(entries: DataFrame) -> DataFrame:
    """graph_id, acc, protein of entries that have an accession; graph_id is a hash of it."""
    return entries.where("acc is not null").select(F.xxhash64("acc").alias("graph_id"), "acc", F.col("sequence").alias("protein"))


def variants(entries: DataFrame, key: str = "VARIANT") -> DataFrame:
    """graph_id, acc, pos, until, original, replacement, source of the features of a key on the sequence as it is shown.

    Features that say nothing of what they replace, or name other residues than stand there, are left out.
    """
    # a sequence has ASCII letters alone, so a place in its bytes is found without a look at all before it
    # conditions stand inside the array: as filters before it they would parse the features once more
    told = F.filter("features", lambda f: (f["key"] == key) & f["isoform"].isNull() & f["replacement"].isNotNull())
    each = entries.select("acc", F.col("sequence").cast("binary").alias("residues"), F.explode(F.when(F.col("acc").isNotNull(), told)).alias("f"))
    there = F.expr("cast(substring(residues, f.begin, f.end - f.begin + 1) as string)")
    each = each.where((F.col("f.begin") >= 1) & (F.col("f.end") >= F.col("f.begin")) & (F.col("f.end") <= F.length("residues")) & (F.col("f.original").isNull() | (F.col("f.original") == there)))
    return each.select(F.xxhash64("acc").alias("graph_id"), "acc", F.col("f.begin").alias("pos"), F.col("f.end").alias("until"), there.alias("original"), "f.replacement", "f.source")


def isoform_sequences(entries: DataFrame) -> DataFrame:
    """acc, isoform, index (as listed), sequence: each isoform's features put in place, from the last to the first."""
    each = entries.select("acc", "sequence", "features", F.posexplode("isoforms").alias("index", "i"))
    parts = F.filter("features", lambda f: F.array_contains(F.col("i.parts"), f["id"]) & f["replacement"].isNotNull() & f["begin"].isNotNull())
    parts = F.reverse(F.array_sort(F.transform(parts, lambda f: F.struct(f["begin"].alias("begin"), f["end"].alias("end"), f["replacement"].alias("replacement")))))
    put = F.aggregate(parts, F.col("sequence"), lambda s, f: F.concat(F.substring(s, F.lit(1), f["begin"] - 1), f["replacement"], F.substring(s, f["end"] + 1, F.length(s))))
    return each.select("acc", F.col("i.id").alias("isoform"), "index", put.alias("sequence"))


def _folded(code: str, text: Column, width: int = 58) -> Column:
    """A text on lines of a width, each behind the code."""
    lines = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.length(text) - 1) / width), F.lit(0)).cast("int")), lambda k: F.concat(F.lit(code), F.substring(text, k * width + 1, F.lit(width))))
    return F.when(F.length(text) <= width, F.concat(F.lit(code), text)).otherwise(F.array_join(lines, "\n"))


def render(found: DataFrame, changes: DataFrame) -> DataFrame:
    """value: an entry without its last line for each protein (acc, protein) with its variants (acc, pos, until, original, replacement, source)."""

    def lines(x: Column) -> Column:
        at = F.when(x["pos"] == x["until"], x["pos"].cast("string")).otherwise(F.concat_ws("..", x["pos"].cast("string"), x["until"].cast("string")))
        note = F.when(x["replacement"] == "", F.lit("Missing")).otherwise(F.concat(x["original"], F.lit(" -> "), x["replacement"]))
        return F.concat(F.lit(f"{_KEY}{'VARIANT':<16}"), at, F.lit("\n"), _folded(_BODY, F.concat(F.lit('/note="'), note, F.lit('"'))), F.lit(f'\n{_BODY}/source="'), x["source"], F.lit('"'))

    # variants move as they are, and become text beside their protein; those with an unknown part have no line
    known = changes.dropna(subset=["source"]).where(F.col("pos").isNotNull() & F.col("until").isNotNull() & F.col("replacement").isNotNull() & ((F.col("replacement") == "") | F.col("original").isNotNull()))
    told = known.groupBy("acc").agg(F.sort_array(F.collect_list(F.struct("pos", "until", "replacement", "source", "original"))).alias("lines"))
    n = F.length("protein").cast("string")
    spaced = F.regexp_replace("protein", rf"(.{{{_BLOCK}}})", "$1 ")
    # one pass for all lines: each but the last is full, and ends in the space that the line feed takes
    rows = F.concat(F.lit("     "), F.rtrim(F.regexp_replace(spaced, rf"(?s)(.{{{_LINE + _LINE // _BLOCK - 1}}}) (?=.)", "$1\n     ")))
    head = F.concat(F.lit("ID   "), "acc", F.lit("   "), n, F.lit(" AA.\nAC   "), "acc", F.lit(";"))
    tail = F.concat(F.lit("SQ   SEQUENCE   "), n, F.lit(" AA;\n"), rows)
    return found.join(told, "acc", "left").select(F.concat_ws("\n", head, F.array_join(F.transform("lines", lines), "\n"), tail).alias("value"))


def write_entries(found: DataFrame, changes: DataFrame, path: str, compression: str | None = None) -> None:
    """Entries as text files, each ended by a line "//". Compressed files (gzip) are read by one task each."""
    render(found, changes).select(F.concat("value", F.lit("\n//")).alias("value")).write.text(path, compression=compression)


def of_sources(entries: DataFrame, sources: list[str]) -> DataFrame:
    """The entries with the variants of some sources alone."""
    return entries.withColumn("features", F.filter("features", lambda f: (f["key"] != "VARIANT") | f["source"].isin(sources)))
