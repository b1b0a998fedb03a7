"""Small text inputs: run sheet, accessions, mass queries, limits. Each reads text lines and parses them as columns.

Fields are those of a CSV reader: they may be quoted, rows may be ragged, and white space of any kind around a field goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pepweave.functions.numbers import fixed, strip, whole
from pepweave.functions.peptides import SCALE

RUN_SHEET = T.StructType(
    [T.StructField("input_file", T.StringType()), T.StructField("query_file", T.StringType()), T.StructField("max_vars", T.IntegerType()), T.StructField("max_cleavages", T.IntegerType()), T.StructField("run_prefix", T.StringType())]
)


def read_run_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Runs of a CSV with a header; a missing column or an unreadable number is an error that names it."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    missing = [f.name for f in RUN_SHEET if f.name not in raw.columns]
    if missing:
        raise ValueError(f"run sheet {path} lacks the columns {', '.join(missing)}")
    return run_sheet(raw)


def run_sheet(raw: DataFrame) -> DataFrame:
    """Typed runs from string columns."""

    def number(name: str) -> Column:
        n = whole(F.col(name)).cast("int")
        fault = F.raise_error(F.concat(F.lit(f"run sheet: {name} is no whole number: "), F.coalesce(F.col(name), F.lit("null")))).cast("int")
        return F.coalesce(n, fault).alias(name)

    return raw.select(*[number(f.name) if isinstance(f.dataType, T.IntegerType) else F.trim(F.col(f.name)).alias(f.name) for f in RUN_SHEET])


def _wide(n: int) -> str:
    return ", ".join(f"c{k} string" for k in range(n))


def fields(line: Column, n: int) -> list[Column]:
    """The first n fields of a CSV line, stripped; null beyond its last one."""
    row = F.from_csv(line, _wide(n), {"escape": '"'})
    return [strip(row[f"c{k}"]) for k in range(n)]


def accessions(lines: DataFrame, column: int = 0) -> DataFrame:
    """acc of CSV lines (value): one field, stripped; blanks go, repeats and order stay, rows without the field are left out."""
    return lines.select(fields(F.col("value"), column + 1)[column].alias("acc")).where("acc <> ''")


def read_accessions(spark: SparkSession, path: str, column: int = 0, header: bool = False) -> DataFrame:
    """Accessions of CSV files, by the place of their column; header: each file's first row is none of them."""
    raw = spark.read.csv(path, schema=_wide(column + 1), header=header, escape='"', mode="PERMISSIVE", enforceSchema=True)
    return raw.select(strip(F.col(f"c{column}")).alias("acc")).where("acc <> ''")


def queries(lines: DataFrame, mode: str = "int_skip_invalid") -> DataFrame:
    """lower, upper (1e-9 dalton) of text lines "lower,upper[,...]" in dalton.

    int_skip_invalid reads whole numbers and drops other lines; decimal_strict reads decimals, truncates beyond the ninth
    place, and stops at any line that is no query.
    """
    ends = fields(F.col("value"), 2)
    if mode == "int_skip_invalid":
        lower, upper = (whole(e) * F.lit(SCALE) for e in ends)
        return lines.select("value", lower.alias("lower"), upper.alias("upper")).where("lower is not null and upper is not null").drop("value")
    if mode != "decimal_strict":
        raise ValueError(f"unknown mode {mode}")
    fault = F.raise_error(F.concat(F.lit("not a query: "), F.col("value"))).cast("long")
    return lines.select(*[F.coalesce(fixed(e), fault).alias(n) for e, n in zip(ends, ("lower", "upper"))])


def read_queries(spark: SparkSession, path: str, mode: str = "int_skip_invalid") -> DataFrame:
    """Queries of text files with a query_id of their own, ascending within a part of a file."""
    lines = spark.read.text(path)
    if mode == "decimal_strict":
        lines = lines.where("trim(value) <> ''")
    return queries(lines, mode).withColumn("query_id", F.monotonically_increasing_id()).select("query_id", "lower", "upper")


def write_queries(found: DataFrame, path: str) -> None:
    """Queries in whole dalton, each file with the header lower,upper."""
    found.select((F.col("lower") / SCALE).cast("long").alias("lower"), (F.col("upper") / SCALE).cast("long").alias("upper")).write.csv(path, header=True)


def limits(lines: DataFrame) -> DataFrame:
    """acc, bin, max_vars of ragged tables: "#bins,n", "bins,...", then an accession and n budgets a line.

    Lines of several files are told apart by a column file; each may have its own head, and a file without one is part of
    the one table of its folder. A row with another number of budgets, or of a table without a head, is an error, but for
    one surplus repeat of the last, which some writers add.
    """
    rows = lines.select(F.col("file") if "file" in lines.columns else F.lit("").alias("file"), F.transform(F.split("value", ","), strip).alias("p"))
    rows = rows.withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
    heads = rows.where("p[0] = '#bins'").select("file", "folder", whole(F.try_element_at("p", F.lit(2))).cast("int").alias("n"))
    own = heads.groupBy("file").agg(F.max("n").alias("own"))
    shared = heads.groupBy("folder").agg(F.max("n").alias("most"), F.min("n").alias("least")).where("most = least").select("folder", "most")
    rows = rows.where("p[0] not in ('', '#bins', 'bins')").join(own, "file", "left").join(shared, "folder", "left").withColumn("n", F.coalesce("own", "most"))
    count = F.size("p") - 1
    surplus = (count == F.col("n") + 1) & (F.element_at("p", -1) == F.try_element_at("p", F.lit(-2)))
    fault = F.raise_error(F.concat(F.lit("limits: wrong number of budgets for "), F.col("p")[0])).cast("int")
    size = F.when((count == F.col("n")) | surplus, F.col("n")).otherwise(fault)
    return rows.select(F.col("p")[0].alias("acc"), F.posexplode(F.slice("p", F.lit(2), size)).alias("bin", "v")).select("acc", "bin", whole(F.col("v")).cast("int").alias("max_vars"))


def read_limits(spark: SparkSession, path: str) -> DataFrame:
    """Budgets of files, each with its own number of bins."""
    return limits(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")))


def limits_lines(table: DataFrame) -> DataFrame:
    """value: the accession lines of a limits file."""
    row = F.transform(F.sort_array(F.collect_list(F.struct("bin", "max_vars"))), lambda x: x["max_vars"].cast("string"))
    return table.groupBy("acc").agg(row.alias("v")).select(F.concat_ws(",", "acc", "v").alias("value"))


def write_limits(table: DataFrame, path: str) -> None:
    """Budgets (acc, bin, max_vars) as a ragged table: its two head lines, then a line for each accession."""
    n = table.agg(F.coalesce(F.max("bin") + 1, F.lit(0)).alias("n"))
    head = n.select(F.explode(F.array(F.format_string("#bins,%d", "n"), F.concat_ws(",", F.lit("bins"), F.sequence(F.lit(1), F.greatest("n", F.lit(1))).cast("array<string>")))).alias("value"))
    head.unionByName(limits_lines(table)).write.text(path)


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """acc, entry of flat protein text: entries end with a line "//"; the first accession of the AC line names them."""
    entries = spark.read.option("lineSep", "\n//\n").text(path).where("trim(value) <> ''")
    return entries.select(F.nullif(F.regexp_extract("value", r"(?m)^AC\s+([^;\s]+)", 1), F.lit("")).alias("acc"), F.col("value").alias("entry"))
