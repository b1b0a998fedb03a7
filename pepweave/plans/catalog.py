"""Registered queries and their SQL twins. Every query reads tables, whole."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pepweave.functions import fasta, peptides
from pepweave.operators import batches, branches, budgets, compare, graph, intervals, render
from pepweave.operators.ranges import interval_join, overlap_totals
from pepweave.operators.shared import cut, fresh_path
from pepweave.operators.traverse import count_paths, traverse
from pepweave.plans import runs, standins, workflow
from pepweave.plans.standins import LOWER, UPPER, table
from pepweave.sources import entries, graph_files, inputs
from pepweave.sources import fasta as fasta_files
from pepweave.streaming import feed

QUERIES: dict = {}
ORACLES: dict = {}
_RANGES = [(500, 600), (900, 1000), (4000, 5000)]
_BUDGET_LIST = [1, 0, 255]
#: Quantities, and a budget list that depends on the order, for orders as graphs.
_SUMS = [(30, 40), (60, 80), (120, 150)]


def query(sql: str | None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_both = peptides.LETTERS + peptides.LETTERS.lower()
_WATER, _L, _U = peptides.WATER, LOWER * peptides.SCALE, UPPER * peptides.SCALE
_DIGEST = rf"""
p AS (SELECT doc_id, source, lang, upper(regexp_replace(coalesce(text, ''), '[^{_both}]', '', 'g')) AS protein FROM documents),
fl AS (SELECT doc_id, source, lang, list_filter(string_split(replace(regexp_replace(protein, '([KR])', '\1|', 'g'), '|P', 'P'), '|'), lambda x: x <> '') AS frags FROM p),
fr AS (SELECT doc_id, source, lang, unnest(range(0, len(frags))) AS i, unnest(frags) AS f FROM fl),
fw AS (SELECT *, lead(f, 1) OVER w AS f1, lead(f, 2) OVER w AS f2, CAST(coalesce(sum(length(f)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS INTEGER) AS spos FROM fr WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
ru AS (
  SELECT doc_id, source, lang, i, spos, 0 AS mssclvg, f AS seq FROM fw
  UNION ALL SELECT doc_id, source, lang, i, spos, 1, f || f1 FROM fw WHERE f1 IS NOT NULL
  UNION ALL SELECT doc_id, source, lang, i, spos, 2, f || f1 || f2 FROM fw WHERE f2 IS NOT NULL
),
oc AS (
  SELECT *, spos + length(seq) - 1 AS epos, '>pg|TODO|D' || doc_id || '(' || spos || ':' || (spos + length(seq) - 1) || ',mssclvg:' || mssclvg || ',)' AS header
  FROM (SELECT *, CAST({peptides.mass_sql("seq")} AS BIGINT) + {_WATER} AS mass FROM ru WHERE length(seq) <= 11) WHERE mass BETWEEN {_L} AND {_U}
)"""
#: Graph forms of fragments: the plain one, and for every n-th a variant whose first residue is A (G if it was A).
_FORMS = """
fo{every} AS (
  SELECT doc_id, i, 0 AS v, f AS seq, spos FROM fw
  UNION ALL SELECT doc_id, i, 1, CASE WHEN f LIKE 'A%' THEN 'G' ELSE 'A' END || substr(f, 2), spos FROM fw WHERE i % {every} = 0
), fm{every} AS (SELECT *, CAST({mass} AS BIGINT) AS w FROM fo{every})"""


def _forms(every: int) -> str:
    return _FORMS.format(every=every, mass=peptides.mass_sql("seq"))


def _paths(every: int, most_vars: str, name: str = "pa") -> str:
    """Paths of up to three fragments, by joins."""
    fm = f"fm{every}"
    return f"""
{name} AS (
  SELECT doc_id, seq, w, v AS vc, 0 AS mssclvg, spos, repeat('VARIANT,', v) AS q FROM {fm}
  UNION ALL SELECT a.doc_id, a.seq || b.seq, a.w + b.w, a.v + b.v, 1, a.spos, repeat('VARIANT,', a.v + b.v) FROM {fm} a JOIN {fm} b ON a.doc_id = b.doc_id AND b.i = a.i + 1 WHERE a.w <= {_U}
  UNION ALL SELECT a.doc_id, a.seq || b.seq || c.seq, a.w + b.w + c.w, a.v + b.v + c.v, 2, a.spos, repeat('VARIANT,', a.v + b.v + c.v)
    FROM {fm} a JOIN {fm} b ON a.doc_id = b.doc_id AND b.i = a.i + 1 AND a.w + b.w <= {_U} JOIN {fm} c ON b.doc_id = c.doc_id AND c.i = b.i + 1
), {name}k AS (SELECT * FROM {name} WHERE w BETWEEN {_L} AND {_U} AND {most_vars})"""


@query(f"WITH {_DIGEST} SELECT seq, min(mass) AS mass, min(mssclvg) AS mssclvg, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM oc GROUP BY seq")
def peptide_mass_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: peptides of up to two missed cleavages in the mass range, with how often they occur."""
    found = standins.runs(spark, sf_dir)
    return found.groupBy("seq").agg(F.min("mass").alias("mass"), F.min("mssclvg").alias("mssclvg"), F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query(f"WITH {_DIGEST}, {_forms(5)}, {_paths(5, 'vc <= 1')} SELECT seq, w, vc, mssclvg, count(*) AS n FROM pak GROUP BY ALL")
def variant_budget_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the documents' variant graphs in the range, with at most one variant: a bag, counted."""
    g = standins.graphs(spark, sf_dir)
    found = traverse(g, standins.ranges(spark, (LOWER, UPPER), max_vars=1), max_missed=2, carry=("seq",)).paths
    return found.groupBy("seq", F.col("a").alias("w"), "vc", F.col("mc").alias("mssclvg")).agg(F.count("*").alias("n"))


@query(f"WITH {_DIGEST}, {_forms(5)}, {_paths(5, 'true')} SELECT '>pg|TODO|D' || doc_id || '(' || spos || ':' || (spos + length(seq) - 1) || ',mssclvg:' || mssclvg || ',' || rtrim(q, ',') || ')' AS header, seq, count(*) AS n FROM pak GROUP BY ALL")
def unlimited_budget_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a budget, rendered with headers (positions, cleavages, qualifiers)."""
    g = standins.graphs(spark, sf_dir)
    found = render.headers(render.peptides(traverse(g, standins.ranges(spark, (LOWER, UPPER)), max_missed=2, carry=render.NEEDED).paths, g.graphs))
    return found.groupBy("header", "seq").agg(F.count("*").alias("n"))


@query(f"""
WITH {_DIGEST}, {_forms(5)},
l0 AS (SELECT doc_id, i, w AS a, v AS vc, false AS fin, w <= {_U} AS ov FROM fm5),
k0 AS (SELECT * FROM l0 WHERE ov AND vc <= 1),
l1 AS (SELECT k.doc_id, f.i, k.a + f.w AS a, k.vc + f.v AS vc, false AS fin, k.a + f.w <= {_U} AS ov FROM k0 k JOIN fm5 f ON f.doc_id = k.doc_id AND f.i = k.i + 1 UNION ALL SELECT doc_id, i, a, vc, true, a BETWEEN {_L} AND {_U} FROM k0),
k1 AS (SELECT * FROM l1 WHERE ov AND vc <= 1 AND NOT fin),
l2 AS (SELECT k.doc_id, f.i, k.a + f.w AS a, k.vc + f.v AS vc, false AS fin, k.a + f.w <= {_U} AS ov FROM k1 k JOIN fm5 f ON f.doc_id = k.doc_id AND f.i = k.i + 1 UNION ALL SELECT doc_id, i, a, vc, true, a BETWEEN {_L} AND {_U} FROM k1),
k2 AS (SELECT * FROM l2 WHERE ov AND vc <= 1 AND NOT fin),
l3 AS (SELECT k.doc_id, f.i, k.a + f.w AS a, k.vc + f.v AS vc, false AS fin, k.a + f.w <= {_U} AS ov, false AS fit FROM k2 k JOIN fm5 f ON f.doc_id = k.doc_id AND f.i = k.i + 1 UNION ALL SELECT doc_id, i, a, vc, true, a BETWEEN {_L} AND {_U}, true FROM k2),
al AS (SELECT 0 AS level, doc_id, ov, vc, true AS fit FROM l0 UNION ALL SELECT 1, doc_id, ov, vc, true FROM l1 UNION ALL SELECT 2, doc_id, ov, vc, true FROM l2 UNION ALL SELECT 3, doc_id, ov, vc, fit FROM l3)
SELECT level, doc_id AS graph_id, count(*) AS attempted, count(*) FILTER (WHERE ov) AS overlapping, count(*) FILTER (WHERE ov AND vc <= 1 AND fit) AS accepted FROM al GROUP BY ALL
""")
def interval_prune_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the enumeration, per level and graph: attempted, overlapping and accepted steps."""
    g = standins.graphs(spark, sf_dir)
    trace = traverse(g, standins.ranges(spark, (LOWER, UPPER), max_vars=1), max_missed=2, trace=True, carry=()).trace
    count = lambda c: F.sum(F.col(c).cast("long")).alias
    return trace.groupBy("level", "graph_id").agg(F.count("*").alias("attempted"), count("overlap")("overlapping"), count("accepted")("accepted"))


@query(f"""
WITH q(query_id, lower, upper) AS (VALUES {", ".join(f"({k}, {a}, {b})" for k, (a, b) in enumerate(_RANGES))}),
b AS (SELECT query_id, upper, least(CASE WHEN upper // (5000 // 3) - 1 < 0 THEN 2 ELSE upper // (5000 // 3) - 1 END, 2) AS bin FROM q)
SELECT 'D' || doc_id AS acc, CAST(query_id AS BIGINT) AS query_id, CAST(bin AS INTEGER) AS bin, CAST(CASE bin WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE NULL END AS INTEGER) AS max_vars FROM documents, b
""")
def per_bin_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget of every document for every query, by mass bin."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("acc"))
    limits = docs.distinct().select("acc", F.posexplode(F.array(*map(F.lit, _BUDGET_LIST))).alias("bin", "max_vars"))
    found = standins.ranges(spark, *_RANGES).select("query_id", budgets.bin_of(F.col("upper"), 3, 5000 * peptides.SCALE).alias("bin"))
    return budgets.with_budget(docs.join(F.broadcast(found)), limits).select("acc", "query_id", "bin", "max_vars")


@query("""
WITH n AS (SELECT o_custkey AS graph_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS node_id, coalesce(k, 0) AS k FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS k FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
o AS (SELECT graph_id, node_id, sum(k) OVER (PARTITION BY graph_id ORDER BY node_id) AS e, k FROM n)
SELECT graph_id, CAST(node_id AS BIGINT) AS src, CAST(unnest(range(CAST(e - k AS BIGINT), CAST(e AS BIGINT))) AS BIGINT) AS edge_id FROM o WHERE k > 0
""")
def csr_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse rows decoded: customers are graphs, their orders nodes, the lines edges."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("k"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey").join(lines, "o_orderkey", "left")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    nodes = orders.select(F.col("o_custkey").alias("graph_id"), (F.row_number().over(w) - 1).cast("long").alias("node_id"), F.sum(F.coalesce("k", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("end_off"))
    return graph.expand_csr(nodes)


@query(f"WITH {_DIGEST} SELECT doc_id, header, seq FROM oc WHERE CAST(regexp_extract(header, 'mssclvg:(\\d+)', 1) AS INTEGER) <= 1")
def missed_cleavage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose header names at most one missed cleavage."""
    return compare.within_cleavages_text(standins.occurrences(spark, sf_dir), 1).select("doc_id", "header", "seq")


@query(rf"""WITH {_DIGEST} SELECT doc_id, '>pg|TODO|D' || doc_id || '(1:' || length(protein) || ',mssclvg:0,)' || chr(10) || rtrim(regexp_replace(protein, '(.{{60}})', '\1' || chr(10), 'g'), chr(10)) AS value FROM p WHERE protein <> ''""")
def fasta_render_wrap60(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole proteins as FASTA records, wrapped at 60 columns."""
    rows = standins.proteins(spark, sf_dir).where("protein <> ''").withColumnRenamed("protein", "seq")
    rows = rows.select("doc_id", F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("acc"), F.lit(1).alias("spos"), F.length("seq").alias("epos"), F.lit(0).alias("mssclvg"), F.array().cast("array<string>").alias("quals"), "seq")
    header = fasta.header(F.col("acc"), F.col("spos"), F.col("epos"), F.col("mssclvg"), F.col("quals"))
    return rows.select("doc_id", F.rtrim(F.concat(header, F.lit("\n"), fasta.wrap(F.col("seq"))), F.lit("\n")).alias("value"))


@query(f"WITH {_DIGEST} SELECT 'D' || doc_id AS acc, spos, CAST(epos AS INTEGER) AS epos, mssclvg, '' AS quals FROM oc")
def fasta_header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields read back from rendered headers."""
    return standins.occurrences(spark, sf_dir).select(*fasta.parsed(F.col("header"))).withColumn("quals", F.array_join("quals", ","))


@query(f"WITH {_DIGEST} SELECT seq, count(*) AS n, min(header) AS first_header FROM oc GROUP BY seq")
def dedup_by_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per peptide."""
    return compare.merge(standins.occurrences(spark, sf_dir), lists=False)


_DIFF = "SELECT CASE WHEN d > 0 THEN '<' ELSE '>' END AS side, seq, CAST(abs(d) AS BIGINT) AS n FROM (SELECT seq, sum(s) AS d FROM s GROUP BY seq) WHERE d <> 0"


@query(f"WITH {_DIGEST}, s AS (SELECT seq, CASE WHEN lang = 'en' THEN 1 ELSE -1 END AS s FROM oc WHERE lang IS NOT NULL) {_DIFF}")
def multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptides of English documents against those of the others, as multisets."""
    found = standins.runs(spark, sf_dir)
    return compare.multiset_diff(found.where("lang = 'en'"), found.where("lang <> 'en'"))


@query(f"WITH {_DIGEST}, s AS (SELECT seq, 1 AS s FROM oc WHERE source = 'src3') {_DIFF}")
def set_diff_equal_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All peptides against themselves (no row), and against all but one source's (that source's rows)."""
    found = cut(standins.runs(spark, sf_dir).select("seq", "source"), "compared")  # digested once, compared four times
    return compare.multiset_diff(found, found).unionByName(compare.multiset_diff(found, found.where("source <> 'src3' OR source IS NULL")))


@query("""
WITH q AS (SELECT p_brand, p_size - 3.0 AS lo, p_size + p_partkey % 7 AS hi FROM part)
SELECT p_brand, event_type, count(*) AS n FROM events JOIN q ON value <= hi AND value + 5.0 >= lo GROUP BY ALL
""")
def range_query_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as closed intervals [value, value + 5] that meet intervals of a table, by an interval join."""
    asked = table(spark, sf_dir, "part").select("p_brand", (F.col("p_size") - 3.0).alias("lo"), (F.col("p_size") + F.col("p_partkey") % 7).cast("double").alias("hi"))
    rows = table(spark, sf_dir, "events").select("event_type", F.col("value").alias("from"), (F.col("value") + 5.0).alias("to"))
    # equal events and equal ranges meet once, with their numbers
    rows, asked = rows.groupBy("event_type", "from", "to").agg(F.count("*").alias("k")), asked.groupBy("p_brand", "lo", "hi").agg(F.count("*").alias("m"))
    return interval_join(rows, asked, ("from", "to", "lo", "hi")).groupBy("p_brand", "event_type").agg(F.sum(F.col("k") * F.col("m")).alias("n"))


@query("""
WITH o AS (SELECT o_orderkey, (o_orderkey * 7919) % 10000000 AS a, (o_orderkey * 7919) % 10000000 + CAST(power(10, o_orderkey % 7) AS BIGINT) AS b FROM orders),
c AS (SELECT c_custkey, (c_custkey * 104729) % 10000000 AS lo, (c_custkey * 104729) % 10000000 + CAST(power(10, c_custkey % 7) AS BIGINT) AS hi FROM customer)
SELECT o_orderkey % 7 AS order_digits, c_custkey % 7 AS customer_digits, count(*) AS n, CAST(sum(least(b, hi) - greatest(a, lo)) AS BIGINT) AS shared FROM o JOIN c ON a <= hi AND lo <= b GROUP BY ALL
""")
def interval_join_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of lengths from 1 to a million on both sides: how many pairs meet, and how much they share, by lengths."""

    def spans(name: str, key: str, factor: int, lo: str, hi: str) -> DataFrame:
        begin = F.col(key) * factor % 10_000_000
        return table(spark, sf_dir, name).select((F.col(key) % 7).alias(f"{lo}_digits"), begin.alias(lo), (begin + F.pow(F.lit(10.0), F.col(key) % 7).cast("long")).alias(hi))

    sides = spans("orders", "o_orderkey", 7919, "a", "b"), spans("customer", "c_custkey", 104729, "lo", "hi")
    return overlap_totals(*sides, ("a", "b", "lo", "hi"), ("a_digits", "lo_digits")).withColumnsRenamed({"a_digits": "order_digits", "lo_digits": "customer_digits"})


@query(f"""
WITH q(query_id, lower, upper) AS (VALUES {", ".join(f"({k}, {a * peptides.SCALE}, {b * peptides.SCALE})" for k, (a, b) in enumerate(_RANGES))})
SELECT doc_id, CAST(query_id AS BIGINT) AS query_id, CAST(lower AS BIGINT) AS lower, CAST(upper AS BIGINT) AS upper FROM documents, q
""")
def query_graph_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query against every graph: the seeds of an enumeration."""
    found = standins.ranges(spark, *_RANGES).drop("max_vars")
    return table(spark, sf_dir, "documents").select("doc_id").join(F.broadcast(found))


@query("SELECT s_name AS acc, CAST(bin AS INTEGER) AS bin, 3 AS max_vars FROM supplier, (SELECT unnest(range(0, 4)) AS bin)")
def limits_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A constant budget for every accession and bin."""
    return budgets.constant_limits(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("acc")), 4, 3)


@query("""
SELECT CAST(r // 100 AS BIGINT) AS batch, count(*) AS n, 'accession:(' || string_agg(c_name, ' OR ' ORDER BY r) || ')' AS query
FROM (SELECT c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS r FROM customer) GROUP BY 1
""")
def batch_accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accessions in batches of 100, in order, and the text that asks for each batch."""
    grouped = batches.batches(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", 100, "c_custkey")
    return grouped.join(batches.any_of(grouped), "batch").select("batch", "n", "query")


@query("""
WITH c AS (SELECT source AS run_prefix, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL)
SELECT run_prefix, a.n AS n_en, a.chars AS chars_en, b.n AS n_de, b.chars AS chars_de, d.n AS n_fr, d.chars AS chars_fr
FROM (SELECT * FROM c WHERE lang = 'en') a JOIN (SELECT * FROM c WHERE lang = 'de') b USING (run_prefix) JOIN (SELECT * FROM c WHERE lang = 'fr') d USING (run_prefix)
""")
def branch_join_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three branches, joined where each has the run."""
    counted = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("run_prefix"), "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    names = ["en", "de", "fr"]
    joined = runs.join_branches({k: counted.where(F.col("lang") == k).drop("lang") for k in names})
    return joined.select("run_prefix", *[F.col(f"{k}.{c}").alias(f"{c}_{k}") for k in names for c in ("n", "chars")])


def _written(lines: DataFrame, what: str) -> str:
    """The path of text files in the shared folder with these lines (value)."""
    path = fresh_path(lines.sparkSession, what)
    lines.select("value").write.text(path)
    return path


@query("""
SELECT CAST(o_custkey AS BIGINT) * 1000000000 AS lower, (CAST(o_custkey AS BIGINT) + o_orderkey % 50) * 1000000000 AS upper FROM orders WHERE o_orderkey % 9 NOT IN (1, 2, 3, 8)
""")
def parse_query_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number queries read from files whose lines are good, padded, quoted, short, fractional, headings or blank."""
    low, high = F.col("o_custkey").cast("string"), (F.col("o_custkey") + F.col("o_orderkey") % 50).cast("string")
    forms = {
        1: F.concat(low, F.lit(".5,"), high), 2: F.lit("lower,upper"), 3: low, 4: F.concat(F.lit("  +"), low, F.lit(" , "), high, F.lit(" ,x")), 5: F.concat(F.lit('"'), low, F.lit('","'), high, F.lit('"')),
        6: F.concat(F.lit("\t"), low, F.lit(",\t"), high, F.lit("\t")), 7: F.concat(low, F.lit(',"'), high, F.lit('\t","a, b"')), 8: F.concat(F.lit('"'), low, F.lit(","), high, F.lit('"')),
    }
    line = F.concat_ws(",", low, high)
    for kind, form in forms.items():
        line = F.when(F.col("o_orderkey") % 9 == kind, form).otherwise(line)
    path = _written(table(spark, sf_dir, "orders").select(line.alias("value")), "queries")
    return inputs.read_queries(spark, path).select("lower", "upper")


@query("""
SELECT CAST(p_partkey AS BIGINT) * 1000000000 + p_size * 10000000 + 123456 AS lower, -(CAST(p_size AS BIGINT) * 1000000000 + 500000000) AS upper FROM part
""")
def parse_decimal_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal queries read from files, cut to fixed point."""
    lower = F.format_string("%d.%02d0123456789", "p_partkey", "p_size")
    path = _written(table(spark, sf_dir, "part").select(F.concat(lower, F.lit(", -"), F.col("p_size").cast("string"), F.lit(".5,extra")).alias("value")), "decimals")
    return inputs.read_queries(spark, path, "decimal_strict").select("lower", "upper")


@query("""
SELECT s_name AS acc, 'plain' AS kind FROM supplier WHERE s_nationkey % 5 <> 0 UNION ALL SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'a,' || s_name ELSE s_name END, 'headed' FROM supplier WHERE s_nationkey % 4 <> 0
UNION ALL SELECT CASE s_suppkey % 4 WHEN 2 THEN 'x "' || s_name || '", y' ELSE s_name END, 'ragged' FROM supplier WHERE s_suppkey % 4 <> 0
""")
def accession_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accessions read from files: stripped, blanks gone, repeats kept; by column from files with a header, nulls and quoted commas, and from ragged ones."""
    suppliers = table(spark, sf_dir, "supplier")
    plain = _written(suppliers.select(F.when(F.col("s_nationkey") % 5 == 0, "\t").otherwise(F.concat(F.lit(" \t"), F.col("s_name"), F.lit("\t ,x"))).alias("value")), "accessions")
    headed = fresh_path(spark, "headed")
    name = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("a,"), F.col("s_name"))).otherwise(F.col("s_name"))
    suppliers.select(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("first"), F.when(F.col("s_nationkey") % 4 != 0, name).alias("acc")).write.csv(headed, header=True)
    kind, name = F.col("s_suppkey") % 4, F.col("s_name")
    line = F.when(kind == 0, name).when(kind == 1, F.concat(F.lit("k,\t"), name)).when(kind == 2, F.concat(F.lit('"k","x ""'), name, F.lit('"", y"'))).otherwise(F.concat(F.lit("k,"), name, F.lit(",more,fields")))
    ragged = _written(suppliers.orderBy("s_suppkey").select(line.alias("value")), "ragged")
    found = {"plain": inputs.read_accessions(spark, plain), "headed": inputs.read_accessions(spark, headed, 1, header=True), "ragged": inputs.read_accessions(spark, ragged, 1)}
    one, two, three = (df.withColumn("kind", F.lit(k)) for k, df in found.items())
    return one.unionByName(two).unionByName(three)


@query("""
SELECT s_name AS acc, CAST(b AS INTEGER) AS bin, CAST(nullif((s_suppkey + 100 * b) % 256, 255) AS INTEGER) AS max_vars FROM supplier, (SELECT unnest(range(0, 3)) AS b) WHERE s_suppkey % 2 = 0 OR b < 2
""")
def limits_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budgets written as ragged tables of three and of two bins, one of which lists its accessions twice, read back together and looked up."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("acc"), F.explode(F.sequence(F.lit(0), F.when(F.col("s_suppkey") % 2 == 0, 2).otherwise(1))).alias("bin"), "s_suppkey")
    rows = rows.withColumn("max_vars", (F.col("s_suppkey") + 100 * F.col("bin")) % 256)
    path = fresh_path(spark, "limits")
    for n, part in (("three", rows.where("s_suppkey % 2 = 0")), ("two", rows.where("s_suppkey % 2 = 1"))):
        inputs.write_limits(part.select("acc", "bin", "max_vars").coalesce(1), f"{path}/{n}")
    found = inputs.read_limits(spark, f"{path}/*")
    return budgets.with_budget(rows.select("acc", "bin"), found.unionAll(found.where("max_vars % 2 = 0")))


@query("SELECT n_name || '.csv' AS input_file, 'q.csv' AS query_file, n_nationkey AS max_vars, n_regionkey AS max_cleavages, 'run' || n_nationkey AS run_prefix FROM nation")
def run_sheet_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed runs read from a sheet's file."""
    path = fresh_path(spark, "sheet")
    key = F.col("n_nationkey").cast("string")
    sheet = table(spark, sf_dir, "nation").select(F.concat("n_name", F.lit(".csv")).alias("input_file"), F.lit("q.csv").alias("query_file"), key.alias("max_vars"), F.col("n_regionkey").cast("string").alias("max_cleavages"), F.concat(F.lit("run"), key).alias("run_prefix"))
    sheet.write.csv(path, header=True)
    return inputs.read_run_sheet(spark, path)


@query(f"WITH {_DIGEST} SELECT 'pg|TODO|D' || doc_id || '(1:' || length(protein) || ',mssclvg:0,)' AS header, protein AS seq FROM p WHERE protein <> ''")
def fasta_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written to FASTA files and read back from them."""
    path = fresh_path(spark, "fasta")
    fasta_files.write_fasta(fasta_render_wrap60(spark, sf_dir), path)
    return fasta_files.read_fasta(spark, path)


def toy(spark: SparkSession) -> graph.Graphs:
    """A graph with a known answer."""
    iv = lambda *xs: [{"lo": a, "hi": b} for a, b in xs]
    nodes = [(1, 0, "", None, 0, None, 0, iv((0, 50))), (1, 1, "AK", 1, 0, None, 10, iv((0, 0), (20, 20))), (1, 2, "CR", 3, 0, None, 20, iv((0, 0))), (1, 3, "", None, 0, None, 0, iv((0, 0)))]
    edges = [(1, 0, 0, 1, False, "", 0), (1, 1, 0, 2, False, "v", 1), (1, 2, 1, 2, True, "", 0), (1, 3, 1, 3, False, "", 0), (1, 4, 2, 3, False, "", 0)]
    return graph.Graphs(spark.createDataFrame([(1, ["P1"], 4, 5, 2)], graph.GRAPHS), spark.createDataFrame(nodes, graph.NODES), spark.createDataFrame(edges, graph.EDGES))


@query("""
SELECT s_suppkey AS graph_id, CAST(q AS BIGINT) AS query_id, seq, CAST(w AS BIGINT) AS w, CAST(vc AS INTEGER) AS vc, CAST(mc AS INTEGER) AS mssclvg, '>pg|TODO|' || s_name || tail AS header
FROM supplier, (VALUES (0, 'AK', 10, 0, 0, '(1:2,mssclvg:0,)'), (0, 'AKCR', 30, 0, 1, '(1:4,mssclvg:1,)'), (0, 'CR', 20, 1, 0, '(3:4,mssclvg:0,v)'), (1, 'AK', 10, 0, 0, '(1:2,mssclvg:0,)'),
  (1, 'AKCR', 30, 0, 1, '(1:4,mssclvg:1,)'), (2, 'AKCR', 30, 0, 1, '(1:4,mssclvg:1,)')) v(q, seq, w, vc, mc, tail)
""")
def toy_graph_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toy graph with intervals for each supplier, under three queries and budgets."""
    own = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("graph_id"), "s_name")
    one = toy(spark)
    each = [own.join(F.broadcast(df.drop("graph_id"))).select("s_name", "graph_id", *df.drop("graph_id").columns) for df in (one.graphs, one.nodes, one.edges)]
    g = graph.Graphs(each[0].withColumn("accessions", F.array("s_name")).drop("s_name"), each[1].drop("s_name"), each[2].drop("s_name"))
    asked = spark.createDataFrame([(0, 10, 30, 1), (1, 10, 30, 0), (2, 30, 30, None)], "query_id long, lower long, upper long, max_vars int")
    return render.headers(render.peptides(traverse(g, asked).paths, g.graphs)).select("graph_id", "query_id", "seq", "w", "vc", "mssclvg", "header")


_ORDERS = """
nl AS (
  SELECT l_orderkey AS g, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) AS BIGINT) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n,
    CAST(l_quantity AS BIGINT) AS w, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS vc, l_returnflag || l_linestatus AS seq FROM lineitem
)"""
#: What may still come after a line: sums over the lines that can follow it.
_STILL = """
st AS (SELECT g, k, CAST(0 AS BIGINT) AS s FROM nl UNION SELECT nl.g, nl.k - d, st.s + nl.w FROM st JOIN nl ON nl.g = st.g AND nl.k = st.k, (VALUES (1), (2)) v(d) WHERE nl.k - d >= 1)"""


@query(f"""
WITH RECURSIVE {_ORDERS}, {_STILL},
nd AS (SELECT g, k, n + 1 AS e, w, vc, (SELECT list(s) FROM st WHERE st.g = nl.g AND st.k = nl.k) AS ss FROM nl UNION ALL SELECT DISTINCT g, n + 1, n + 1, 0, 0, [0] FROM nl),
tr AS (
  SELECT 0 AS level, g, k, e, w AS a, vc, len(list_filter(ss, lambda s: w + s >= 60 AND w + s <= 80)) > 0 AS ov FROM nd WHERE k < e
  UNION ALL SELECT tr.level + 1, nd.g, nd.k, nd.e, tr.a + nd.w, tr.vc + nd.vc, len(list_filter(nd.ss, lambda s: tr.a + nd.w + s >= 60 AND tr.a + nd.w + s <= 80)) > 0
  FROM tr JOIN nd ON nd.g = tr.g AND (nd.k = tr.e OR nd.k IN (tr.k + 1, tr.k + 2)) WHERE tr.ov AND tr.vc <= 1 AND tr.k < tr.e
)
SELECT level, g AS graph_id, count(*) AS attempted, count(*) FILTER (WHERE ov) AS overlapping, count(*) FILTER (WHERE ov AND vc <= 1) AS accepted FROM tr GROUP BY ALL
""")
def order_interval_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the enumeration with intervals of what is still to come, on orders as graphs: attempted, overlapping and accepted steps."""
    g = intervals.summarise(standins.order_graphs(spark, sf_dir), cap=1024)
    asked = spark.createDataFrame([(0, 60, 80, 1)], "query_id long, lower long, upper long, max_vars int")
    count = lambda c: F.sum(F.col(c).cast("long")).alias
    return traverse(g, asked, trace=True, carry=()).trace.groupBy("level", "graph_id").agg(F.count("*").alias("attempted"), count("overlap")("overlapping"), count("accepted")("accepted"))


@query(f"""
WITH RECURSIVE {_ORDERS},
q(query_id, lower, upper) AS (VALUES {", ".join(f"({k}, {a}, {b})" for k, (a, b) in enumerate(_SUMS))}),
qb AS (SELECT *, least(CASE WHEN upper // 50 - 1 < 0 THEN 2 ELSE upper // 50 - 1 END, 2) AS bin FROM q),
pt AS (
  SELECT g, k, n, w AS a, vc, 0 AS mc, seq FROM nl
  UNION ALL SELECT nl.g, nl.k, nl.n, pt.a + nl.w, pt.vc + nl.vc, pt.mc + CASE WHEN nl.k = pt.k + 1 THEN 1 ELSE 0 END, pt.seq || nl.seq FROM pt JOIN nl ON nl.g = pt.g AND nl.k IN (pt.k + 1, pt.k + 2) WHERE pt.a + nl.w <= 150
)
SELECT CAST(query_id AS BIGINT) AS query_id, g AS graph_id, count(*) AS n, CAST(sum(a) AS BIGINT) AS w, CAST(sum(vc) AS BIGINT) AS vc, CAST(sum(mc) AS BIGINT) AS mc, min(seq) AS seq
FROM pt JOIN qb ON a BETWEEN lower AND upper WHERE (g + bin) % 4 = 3 OR vc <= (g + bin) % 4 GROUP BY query_id, g
""")
def order_budget_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of orders as graphs, with intervals, under budgets that differ by order and by the mass bin of the query."""
    g = standins.order_graphs(spark, sf_dir)
    limits = g.graphs.select(F.col("accessions")[0].alias("acc"), "graph_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("bin"))
    stored = (F.col("graph_id") + F.col("bin")) % 4
    limits = limits.select("acc", "bin", F.when(stored == 3, budgets.UNLIMITED).otherwise(stored).cast("int").alias("max_vars"))
    asked = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(_SUMS)], "query_id long, lower long, upper long").withColumn("bin", budgets.bin_of(F.col("upper"), 3, 150))
    found = traverse(intervals.summarise(g), asked, limits=limits, carry=("seq",)).paths
    return found.groupBy("query_id", "graph_id").agg(F.count("*").alias("n"), F.sum("a").alias("w"), F.sum("vc").cast("long").alias("vc"), F.sum("mc").cast("long").alias("mc"), F.min("seq").alias("seq"))


@query(f"""
WITH RECURSIVE {_ORDERS}, {_STILL}
SELECT g AS graph_id, CAST(k AS BIGINT) AS node_id, 'node_' || k || ': ' || string_agg('[' || s || ',' || s || ']', ' | ' ORDER BY s) AS line FROM st GROUP BY g, k
UNION ALL SELECT DISTINCT g, CAST(n + 1 AS BIGINT), 'node_' || (n + 1) || ': [0,0]' FROM nl
UNION ALL SELECT g, CAST(0 AS BIGINT), 'node_0: ' || string_agg('[' || s || ',' || s || ']', ' | ' ORDER BY s) FROM (SELECT DISTINCT nl.g, nl.w + st.s AS s FROM nl JOIN st ON st.g = nl.g AND st.k = nl.k) GROUP BY g
""")
def interval_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of every node of orders as graphs, as text."""
    return intervals.dump(intervals.summarise(standins.order_graphs(spark, sf_dir), cap=1024).nodes)


@query(f"WITH {_DIGEST}, {_forms(5)}, {_paths(5, 'vc <= 1 AND mssclvg <= 1')} SELECT DISTINCT '=' AS side, seq, CAST(1 AS BIGINT) AS n FROM pak")
def compare_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enumeration with intervals against the one without, over all documents: what both found, and no difference."""
    return runs.compare_readers(standins.graphs(spark, sf_dir, most=_U), standins.ranges(spark, (LOWER, UPPER)).drop("max_vars"), runs.Run(1, 1, "readers"), agreed=True)


@query(f"""
WITH {_DIGEST}, {_forms(5)}, {_forms(7)}, {_paths(5, "vc <= 3", "pa")}, {_paths(7, "vc <= 3", "pb")},
c AS (SELECT DISTINCT seq FROM pak WHERE vc = 0), x AS (SELECT DISTINCT seq FROM pak), y AS (SELECT DISTINCT seq FROM pbk)
SELECT 'sources' AS run_prefix, 'canonical' AS "left", 'five' AS "right", '>' AS side, seq, CAST(1 AS BIGINT) AS n FROM (FROM x EXCEPT FROM c)
UNION ALL SELECT 'sources', 'five', 'seven', '<', seq, 1 FROM (FROM x EXCEPT FROM y) UNION ALL SELECT 'sources', 'five', 'seven', '>', seq, 1 FROM (FROM y EXCEPT FROM x)
""")
def compare_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptide sets of graphs without variants and with those of two sources of a variant table, compared in two pairs."""
    rows, variants, parts = standins.variant_table(spark, sf_dir, {"five": 5, "seven": 7})
    asked = {"most": _U, "parts": parts}
    branches = {"canonical": partial(graph.from_proteins, rows, variants=False, **asked), **{s: partial(graph.from_variants, rows, variants, s, **asked) for s in ("five", "seven")}}
    return runs.compare_sources(branches, standins.ranges(spark, (LOWER, UPPER)).drop("max_vars"), runs.Run(3, 2, "sources"), [("canonical", "five"), ("five", "seven")])


#: Variants that make and remove cut sites (see standins.site_variants), and what their graphs' edges are.
_SITES = f"""
re AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, substr(protein, pos, 1) AS aa, length(protein) AS n FROM (SELECT doc_id, protein, unnest(range(1, length(protein) + 1)) AS pos FROM p)),
sv AS (
  SELECT doc_id, pos, aa, CASE aa WHEN 'K' THEN 'T' ELSE 'K' END AS repl, 'ebi' AS source, n FROM re WHERE pos % 11 = 4
  UNION ALL SELECT doc_id, pos, aa, CASE aa WHEN 'P' THEN 'A' ELSE 'P' END, 'uniprot', n FROM re WHERE pos % 11 = 5 UNION ALL SELECT doc_id, pos, aa, '', 'uniprot', n FROM re WHERE pos % 23 = 9
)"""
_SITE_PATHS = f"""
nf AS (SELECT doc_id, pos, 0 AS v, aa, n FROM re UNION ALL SELECT doc_id, pos, 1, repl, n FROM sv WHERE repl <> ''),
nx AS (FROM nf UNION ALL SELECT doc_id, 0, 0, '', length(protein) FROM p UNION ALL SELECT doc_id, length(protein) + 1, 0, '', length(protein) FROM p),
dl AS (SELECT doc_id, pos FROM sv WHERE repl = ''),
me AS (
  SELECT a.doc_id, a.pos AS p1, a.v AS v1, a.aa AS la, b.pos AS p2, b.v AS v2, b.aa AS ra, b.v AS vc FROM nx a JOIN nx b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
  UNION ALL SELECT a.doc_id, a.pos, a.v, a.aa, b.pos, b.v, b.aa, b.v + 1 FROM nx a JOIN dl ON dl.doc_id = a.doc_id AND dl.pos = a.pos + 1 JOIN nx b ON b.doc_id = a.doc_id AND b.pos = a.pos + 2
), mt AS (SELECT *, la IN ('K', 'R') AND ra NOT IN ('P', '') AS site FROM me),
wt AS (SELECT aa, CAST({peptides.mass_sql("aa")} AS BIGINT) AS w FROM (SELECT unnest(string_split('{peptides.LETTERS}', '')) AS aa)),
be AS (SELECT doc_id, p2 AS pos, v2 AS v, any_value(ra) AS aa, min(vc + v1) AS vc FROM mt WHERE ra <> '' AND (la = '' OR site) GROUP BY 1, 2, 3),
fi AS (SELECT doc_id, p1 AS pos, v1 AS v, min(vc) AS vc FROM mt WHERE la <> '' AND (ra = '' OR site) GROUP BY 1, 2, 3),
sp AS (SELECT mt.*, w FROM mt JOIN wt ON wt.aa = ra WHERE la <> ''),
pt AS (
  SELECT doc_id, pos, v, w AS a, vc, 0 AS mc, aa AS seq FROM be JOIN wt USING (aa) WHERE vc <= 1
  UNION ALL SELECT sp.doc_id, sp.p2, sp.v2, pt.a + sp.w, pt.vc + sp.vc, pt.mc + CASE WHEN site THEN 1 ELSE 0 END, pt.seq || sp.ra
  FROM pt JOIN sp ON sp.doc_id = pt.doc_id AND sp.p1 = pt.pos AND sp.v1 = pt.v WHERE pt.a + sp.w <= {_U} AND pt.vc + sp.vc <= 1 AND pt.mc + CASE WHEN site THEN 1 ELSE 0 END <= 2
)"""


@query(f"""
WITH RECURSIVE {_DIGEST.split("fl AS")[0].rstrip().rstrip(",")}, {_SITES}, {_SITE_PATHS}
SELECT seq, a AS w, CAST(pt.vc + fi.vc AS INTEGER) AS vc, CAST(mc AS INTEGER) AS mssclvg, count(*) AS n FROM pt JOIN fi USING (doc_id, pos, v) WHERE a BETWEEN {_L} AND {_U} AND pt.vc + fi.vc <= 1 GROUP BY ALL
""")
def variant_site_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of graphs of single residues, in which variants make and remove cut sites, contracted to branches: a bag, counted."""
    g = branches.from_residues(*standins.site_variants(spark, sf_dir), most=_U, max_vars=1)
    found = traverse(g, standins.ranges(spark, (LOWER, UPPER), max_vars=1), max_missed=2, carry=("seq",)).paths
    return found.groupBy("seq", F.col("a").alias("w"), "vc", F.col("mc").alias("mssclvg")).agg(F.count("*").alias("n"))


@query(f"""
WITH {_DIGEST.split("fl AS")[0].rstrip().rstrip(",")}, {_SITES}
SELECT 'D' || doc_id AS acc, source, pos, pos AS until, aa AS original, repl AS replacement FROM sv UNION ALL SELECT 'D' || doc_id, 'sequence', 1, CAST(length(protein) AS INTEGER), protein, NULL FROM p
""")
def feature_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proteins and variants of the documents written as flat text entries and read back from their features and sequences."""
    path = fresh_path(spark, "entries")
    entries.write_entries(*standins.site_variants(spark, sf_dir), path, "gzip")
    found = entries.read_entries(spark, path)
    whole = entries.proteins(found).select("acc", F.lit("sequence").alias("source"), F.lit(1).alias("pos"), F.length("protein").alias("until"), F.col("protein").alias("original"), F.lit(None).cast("string").alias("replacement"))
    return entries.variants(found).select("acc", "source", "pos", "until", "original", "replacement").unionByName(whole)


@query(f"""
WITH RECURSIVE {_ORDERS},
st AS (
  SELECT g, k, 0 AS c, CAST(0 AS BIGINT) AS s FROM nl
  UNION SELECT nl.g, nl.k - d, st.c + CASE d WHEN 1 THEN 1 ELSE 0 END, st.s + nl.w FROM st JOIN nl ON nl.g = st.g AND nl.k = st.k, (VALUES (1), (2)) v(d) WHERE nl.k - d >= 1 AND st.c + CASE d WHEN 1 THEN 1 ELSE 0 END <= 1
),
nd AS (SELECT g, k, n + 1 AS e, w, vc, (SELECT list({{'c': c, 's': s}}) FROM st WHERE st.g = nl.g AND st.k = nl.k) AS ss FROM nl UNION ALL SELECT DISTINCT g, n + 1, n + 1, 0, 0, [{{'c': 0, 's': 0}}] FROM nl),
tr AS (
  SELECT 0 AS level, g, k, e, w AS a, vc, 0 AS mc, len(list_filter(ss, lambda x: x.c <= 1 AND w + x.s >= 60 AND w + x.s <= 80)) > 0 AS ov FROM nd WHERE k < e
  UNION ALL SELECT tr.level + 1, nd.g, nd.k, nd.e, tr.a + nd.w, tr.vc + nd.vc, tr.mc + CASE WHEN nd.k = tr.k + 1 AND nd.k < nd.e THEN 1 ELSE 0 END,
    len(list_filter(nd.ss, lambda x: x.c <= greatest(1 - tr.mc - CASE WHEN nd.k = tr.k + 1 AND nd.k < nd.e THEN 1 ELSE 0 END, 0) AND tr.a + nd.w + x.s >= 60 AND tr.a + nd.w + x.s <= 80)) > 0
  FROM tr JOIN nd ON nd.g = tr.g AND (nd.k = tr.e OR nd.k IN (tr.k + 1, tr.k + 2)) WHERE tr.ov AND tr.vc <= 1 AND tr.mc <= 1 AND tr.k < tr.e
)
SELECT level, g AS graph_id, count(*) AS attempted, count(*) FILTER (WHERE ov) AS overlapping, count(*) FILTER (WHERE ov AND vc <= 1 AND mc <= 1) AS accepted FROM tr GROUP BY ALL
""")
def order_cleavage_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the enumeration with intervals of what is still to come under the missed cleavages that are left."""
    g = intervals.summarise(standins.order_graphs(spark, sf_dir), cap=1024, missed=1)
    count = lambda c: F.sum(F.col(c).cast("long")).alias
    trace = traverse(g, standins.ranges(spark, (60, 80), max_vars=1, scale=1), max_missed=1, trace=True, carry=()).trace
    return trace.groupBy("level", "graph_id").agg(F.count("*").alias("attempted"), count("overlap")("overlapping"), count("accepted")("accepted"))


@query(f"""
WITH RECURSIVE {_ORDERS}, nd AS (SELECT g, k, n + 1 AS e, w, vc FROM nl UNION ALL SELECT DISTINCT g, n + 1, n + 1, 0, 0 FROM nl),
tr AS (
  SELECT 0 AS level, g, k, e, w AS a, vc, w <= 120 AS ov FROM nd WHERE k < e
  UNION ALL SELECT tr.level + 1, nd.g, nd.k, nd.e, tr.a + nd.w, tr.vc + nd.vc, tr.a + nd.w <= 120 AND (nd.k < nd.e OR tr.a + nd.w >= 60)
  FROM tr JOIN nd ON nd.g = tr.g AND (nd.k = tr.e OR nd.k IN (tr.k + 1, tr.k + 2)) WHERE tr.ov AND tr.vc <= 1 AND tr.k < tr.e
)
SELECT level, g AS graph_id, CAST(0 AS BIGINT) AS query_id, count(*) AS attempted, count(*) FILTER (WHERE ov AND vc <= 1) AS kept, count(*) FILTER (WHERE ov AND vc <= 1 AND k = e) AS ended FROM tr GROUP BY ALL
""")
def order_path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial paths of each level, graph and query, predicted without their enumeration."""
    return count_paths(standins.order_graphs(spark, sf_dir), standins.ranges(spark, (60, 120), max_vars=1, scale=1))


_ORDER_PATHS = f"""
WITH RECURSIVE {_ORDERS},
pt AS (
  SELECT g, k, n, w AS a, vc, 0 AS mc, seq FROM nl
  UNION ALL SELECT nl.g, nl.k, nl.n, pt.a + nl.w, pt.vc + nl.vc, pt.mc + CASE WHEN nl.k = pt.k + 1 THEN 1 ELSE 0 END, pt.seq || nl.seq FROM pt JOIN nl ON nl.g = pt.g AND nl.k IN (pt.k + 1, pt.k + 2) WHERE pt.a + nl.w <= 150
)"""


@query(f"{_ORDER_PATHS} SELECT 'O' || g AS acc, count(*) AS n, CAST(sum(a) AS BIGINT) AS w, CAST(sum(vc) AS BIGINT) AS vc, CAST(sum(mc) AS BIGINT) AS mc, min(seq) AS seq FROM pt WHERE a BETWEEN 60 AND 80 AND vc <= 1 GROUP BY g")
def graph_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as graphs, with intervals, written to indexed binary files, read back by block and enumerated."""
    path = fresh_path(spark, "graphs")
    graph_files.write_graphs(intervals.summarise(standins.order_graphs(spark, sf_dir)), path, narrow=True, compression="zstd")
    g = graph_files.read_indexed(spark, path)
    found = render.peptides(traverse(g, standins.ranges(spark, (60, 80), max_vars=1, scale=1), carry=render.NEEDED).paths, g.graphs)
    total = lambda c, name: F.sum(c).cast("long").alias(name)
    return found.groupBy("acc").agg(F.count("*").alias("n"), total("w", "w"), total("vc", "vc"), total("mssclvg", "mc"), F.min("seq").alias("seq"))


@query(f"{_ORDER_PATHS}, q(a0, b0) AS (VALUES {', '.join(f'({a}, {b})' for a, b in _SUMS)}) SELECT CAST(a0 AS BIGINT) AS lower, CAST(b0 AS BIGINT) AS upper, count(*) AS n, count(DISTINCT g) AS graphs, min(seq) AS seq FROM pt JOIN q ON a BETWEEN a0 AND b0 WHERE vc <= 1 GROUP BY ALL")
def streamed_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query files of a stream answered against orders as graphs, from the table that the stream appends to."""
    top = fresh_path(spark, "stream")
    g = standins.order_graphs(spark, sf_dir)
    g = graph.Graphs(g.graphs, g.nodes.withColumn("w", F.col("w") * peptides.SCALE), g.edges, parts=g.parts)
    lines = spark.range(1).select(F.explode(F.array(*[F.lit(f"{a},{b}") for a, b in _SUMS])).alias("value"))
    lines.coalesce(1).write.text(f"{top}/in")
    feed.answer_queries(spark, g, f"{top}/in", f"{top}/out", f"{top}/state", max_vars=1).awaitTermination()
    whole = lambda c: (F.col(c) / peptides.SCALE).cast("long")
    return spark.read.parquet(f"{top}/out").groupBy(whole("from").alias("lower"), whole("to").alias("upper")).agg(F.count("*").alias("n"), F.countDistinct("graph_id").alias("graphs"), F.min("seq").alias("seq"))


@query("""
SELECT 'limits' AS kind, s_name || ',3' AS value FROM supplier UNION ALL SELECT 'limits', '#bins,1' UNION ALL SELECT 'limits', 'bins,1' UNION ALL SELECT 'queries', n_nationkey || ',' || (n_nationkey + 100) FROM nation WHERE n_nationkey % 3 <> 0
UNION ALL SELECT 'entries', s_name FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT 'asked', 'accession:(' || string_agg(s_name, ' OR ' ORDER BY s_name) || ')' FROM (SELECT *, (row_number() OVER (ORDER BY s_name) - 1) // 100 AS b FROM supplier) GROUP BY b
""")
def build_input_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a run's input, built from accessions, queries and entries of files, and read again line by line."""
    top = fresh_path(spark, "input")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("acc"), F.lit("AK").alias("protein"), "s_suppkey")
    listed = _written(suppliers.select(F.concat(F.lit('"x",'), "acc").alias("value")), "listed")
    key = F.col("n_nationkey")
    asked = _written(table(spark, sf_dir, "nation").select(F.when(key % 3 == 0, "lower,upper").otherwise(F.concat_ws(",", key.cast("string"), (key + 100).cast("string"))).alias("value")), "asked")
    none = suppliers.limit(0).select("acc", F.lit(1).alias("pos"), F.lit(1).alias("until"), F.lit("").alias("original"), F.lit("").alias("replacement"), F.lit("").alias("source"))
    entries.write_entries(suppliers.where("s_suppkey % 2 = 0").unionByName(suppliers.limit(1).withColumn("acc", F.lit("other"))), none, f"{top}/flat")
    paths = workflow.build_input(spark, listed, asked, f"{top}/flat", 3, f"{top}/out", column=1)
    lines = {k: spark.read.text(paths[k]) for k in ("limits", "asked")} | {"queries": spark.read.text(paths["queries"]).where("value <> 'lower,upper'"), "entries": entries.read_entries(spark, paths["entries"]).select(F.col("acc").alias("value"))}
    out = [df.select(F.lit(k).alias("kind"), "value") for k, df in lines.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query(f"WITH {_DIGEST} SELECT CAST(doc_id % 3 AS INTEGER) AS query_id, substr(header, 2) AS header, seq, count(*) AS n FROM oc GROUP BY ALL")
def results_by_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written in folders by query and read back with the query that they answer."""
    path = fresh_path(spark, "results")
    found = standins.occurrences(spark, sf_dir).select((F.col("doc_id") % 3).alias("query_id"), F.rtrim(F.concat("header", F.lit("\n"), fasta.wrap(F.col("seq"))), F.lit("\n")).alias("value"))
    fasta_files.write_fasta(found, path)
    return fasta_files.read_fasta(spark, path).groupBy("query_id", "header", "seq").agg(F.count("*").alias("n"))


@query(f"WITH {_DIGEST}, s AS (SELECT seq, 1 AS s FROM oc WHERE source = 'src3') {_DIFF}")
def digest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same differences by digests: equal sides move digests only, and one source's absence is found."""
    found = cut(standins.runs(spark, sf_dir).select("seq", "source"), "compared")
    return compare.digest_diff(found, found).unionByName(compare.digest_diff(found, found.where("source <> 'src3' OR source IS NULL")))
