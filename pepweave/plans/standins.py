"""Driver tables as stand-ins for proteins, peptides and graphs: documents reduced to amino-acid letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pepweave.functions import fasta, peptides
from pepweave.operators import graph
from pepweave.operators.shared import cut, cut_dealt, parts_for, spread

#: The flagship's range in whole dalton, and missed cleavages allowed.
LOWER, UPPER, MISSED = 500, 600, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, protein."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    return docs.select("doc_id", "source", "lang", peptides.residues(F.col("text")).alias("protein"))


def runs(spark: SparkSession, sf_dir: str, lower: int = LOWER, upper: int = UPPER) -> DataFrame:
    """doc_id, source, lang, i, mssclvg, seq, mass of every run of up to MISSED + 1 fragments that weighs lower to upper dalton.

    Rows stay where they are: no shuffle. Fragments too long for the range aren't weighed.
    """
    longest = (upper * peptides.SCALE - peptides.WATER) // min(peptides.RESIDUES.values())
    cut = proteins(spark, sf_dir).select("doc_id", "source", "lang", peptides.digest(F.col("protein")).alias("frags")).where(F.size("frags") > 0)
    # each short fragment is weighed once, inside its row; runs only add up
    weighed = cut.withColumn("masses", F.transform("frags", lambda f: F.when(F.length(f) <= longest, peptides.mass(f))))
    steps = range(MISSED + 1)
    shifted = [F.slice(c, F.lit(k + 1), F.size("frags")).alias(f"{c[0]}{k}") for k in steps for c in ("frags", "masses")]
    rows = weighed.select("doc_id", "source", "lang", *shifted)
    rows = rows.select("doc_id", "source", "lang", F.posexplode(F.arrays_zip(*[f"{c}{k}" for k in steps for c in "fm"])).alias("i", "z")).where("z.m0 is not null")
    forms = F.array(*[
        F.struct(F.lit(k).alias("mssclvg"), sum([F.col(f"z.m{j}") for j in range(k + 1)], F.lit(peptides.WATER)).alias("mass")) for k in steps
    ])
    fits = F.filter(forms, lambda r: r["mass"].between(lower * peptides.SCALE, upper * peptides.SCALE))
    seqs = F.array(*[F.concat(*[F.col(f"z.f{j}") for j in range(k + 1)]) for k in steps])
    rows = rows.select("doc_id", "source", "lang", "i", "z", F.explode(fits).alias("r"))
    return rows.select("doc_id", "source", "lang", "i", "r.mssclvg", F.get(seqs, F.col("r.mssclvg")).alias("seq"), "r.mass")


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptides of the flagship's range with their place: doc_id, source, lang, spos, epos, mssclvg, seq, header.

    Each document is digested once; positions are a running sum, and the fragments that follow come by the same window.
    """
    longest = (UPPER * peptides.SCALE - peptides.WATER) // min(peptides.RESIDUES.values())
    cut = proteins(spark, sf_dir).select("doc_id", "source", "lang", F.posexplode(peptides.digest(F.col("protein"))).alias("i", "f"))
    cut = cut.withColumns({"size": F.length("f"), "m": F.when(F.length("f") <= longest, peptides.mass(F.col("f")))})
    by_doc = Window.partitionBy("doc_id").orderBy("i")
    ahead = by_doc.rowsBetween(Window.unboundedPreceding, -1)
    follow = [F.lead(F.when(F.col("m").isNotNull(), F.struct("f", "m")), k).over(by_doc).alias(f"z{k}") for k in range(1, MISSED + 1)]
    rows = cut.select("doc_id", "source", "lang", F.struct("f", "m").alias("z0"), (F.coalesce(F.sum("size").over(ahead), F.lit(0)) + 1).cast("int").alias("spos"), *follow).where("z0.m is not null")
    steps = range(MISSED + 1)
    forms = F.array(*[
        F.struct(F.lit(k).alias("mssclvg"), sum([F.col(f"z{j}.m") for j in range(k + 1)], F.lit(peptides.WATER)).alias("mass"), F.concat(*[F.col(f"z{j}.f") for j in range(k + 1)]).alias("seq")) for k in steps
    ])
    fits = F.filter(forms, lambda r: r["mass"].between(LOWER * peptides.SCALE, UPPER * peptides.SCALE))
    found = rows.select("doc_id", "source", "lang", "spos", F.explode(fits).alias("r")).select("doc_id", "source", "lang", "spos", "r.mssclvg", "r.seq")
    found = found.withColumn("epos", F.col("spos") + F.length("seq") - 1)
    acc = F.concat(F.lit("D"), F.col("doc_id").cast("string"))
    return found.select("doc_id", "source", "lang", "spos", "epos", "mssclvg", "seq", fasta.header(acc, F.col("spos"), F.col("epos"), F.col("mssclvg"), F.array().cast("array<string>")).alias("header"))


def graphs(spark: SparkSession, sf_dir: str, variants: bool = True, every: int = 5, most: int | None = None) -> graph.Graphs:
    """Variant graphs of the documents; most: see graph.from_proteins."""
    rows = proteins(spark, sf_dir).select(F.col("doc_id").alias("graph_id"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("acc"), "protein")
    # letters of the texts are as good as residues for the number of parts, and need no pattern
    letters = table(spark, sf_dir, "documents").agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    return graph.from_proteins(rows, variants, every, most, parts_for(spark, letters // graph.RESIDUES_A_FRAGMENT))


def variant_table(spark: SparkSession, sf_dir: str, sources: dict[str, int]) -> tuple[DataFrame, DataFrame, int]:
    """Proteins (graph_id, acc, protein) of the documents, and their variants: graph_id, pos, replacement, source; dealt by graph, with the number of parts.

    A source that names n has a variant at the first residue of every n-th fragment: A, or G where there was an A.
    """
    rows = proteins(spark, sf_dir).select(F.col("doc_id").alias("graph_id"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("acc"), "protein")
    letters = table(spark, sf_dir, "documents").agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = parts_for(spark, letters // graph.RESIDUES_A_FRAGMENT)
    rows = cut_dealt(rows, "proteins", parts)
    frags = rows.select("graph_id", F.posexplode(peptides.digest(F.col("protein"))).alias("i", "f")).select("graph_id", "i", F.length("f").alias("size"), F.col("f").startswith("A").alias("a"))
    ahead = Window.partitionBy("graph_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    places = frags.select("graph_id", "i", (F.coalesce(F.sum("size").over(ahead), F.lit(0)) + 1).cast("int").alias("pos"), F.when(F.col("a"), "G").otherwise("A").alias("replacement"))
    named = F.filter(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(n).alias("n")) for s, n in sources.items()]), lambda x: F.col("i") % x["n"] == 0)
    variants = places.select("graph_id", "pos", "replacement", F.explode(named).alias("s")).select("graph_id", "pos", "replacement", "s.source")
    return rows, cut_dealt(variants, "variants", parts), parts


def site_variants(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Proteins of the documents and variants of single residues that make and remove cut sites: graph_id, acc, pos, until, original, replacement, source.

    Of eleven places, the fourth is K (T where there was a K, source ebi) and the fifth P (A where there was a P, source
    uniprot); the ninth of 23 is removed (uniprot).
    """
    rows = proteins(spark, sf_dir).select(F.col("doc_id").alias("graph_id"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("acc"), "protein")
    rows = cut(rows, "proteins")
    # rows are made for places that have a variant alone; letters are ASCII, so a place in the bytes is found at once
    n, residue = F.length("protein"), F.expr("cast(substring(residues, pos, 1) as string)")
    places = lambda first, every, kind: F.when(n >= first, F.transform(F.sequence(F.lit(first), n, F.lit(every)), lambda p: F.struct(p.alias("pos"), F.lit(kind).alias("kind")))).otherwise(F.array().cast("array<struct<pos:int,kind:string>>"))
    each = rows.select("graph_id", "acc", F.col("protein").cast("binary").alias("residues"), F.explode(F.concat(places(4, 11, "K"), places(5, 11, "P"), places(9, 23, ""))).alias("f"))
    each = each.select("graph_id", "acc", F.col("f.pos").alias("pos"), "f.kind", "residues").select("graph_id", "acc", "pos", "kind", residue.alias("original"))
    other = F.when(F.col("kind") == "K", "T").otherwise("A")
    made = F.when((F.col("kind") != "") & (F.col("original") == F.col("kind")), other).otherwise(F.col("kind"))
    return rows, each.select("graph_id", "acc", "pos", F.col("pos").alias("until"), "original", made.alias("replacement"), F.when(F.col("kind") == "K", "ebi").otherwise("uniprot").alias("source"))


def order_graphs(spark: SparkSession, sf_dir: str) -> graph.Graphs:
    """Orders as small graphs: lines are nodes that weigh their quantity; a line leads to the next two lines and to the end.

    A step into a returned line counts one variant; a step to the very next line is a missed cleavage.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    parts = parts_for(spark, lineitem.count())
    by_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    # dealt by order once: all that follows stays in these parts
    lines = lineitem.repartition(parts, "l_orderkey").select(
        F.col("l_orderkey").alias("graph_id"), F.row_number().over(by_order).cast("long").alias("k"), F.count("*").over(Window.partitionBy("l_orderkey")).alias("n"),
        F.col("l_quantity").cast("long").alias("w"), F.concat("l_returnflag", "l_linestatus").alias("seq"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("vc"),
    )
    lines = cut_dealt(lines, "lines", parts)
    acc = F.concat(F.lit("O"), F.col("graph_id").cast("string"))
    graphs = lines.where("k = 1").select("graph_id", F.array(acc).alias("accessions"), (F.col("n") + 2).alias("n_nodes"), F.lit(None).cast("long").alias("n_edges"), F.lit(None).cast("int").alias("n_pdb"))
    none, zero = F.lit(None), F.lit(0).cast("long")
    node = lambda number, seq, pos, w: F.struct(number.alias("node_id"), seq.alias("seq"), pos.cast("int").alias("pos"), F.lit(0).alias("iso_idx"), none.cast("int").alias("iso_pos"), w.alias("w"))
    inner = node(F.col("k"), F.col("seq"), 2 * F.col("k") - 1, F.col("w"))
    ends = [node(x, F.lit(""), none, zero) for x in (zero, F.col("n") + 1)]
    nodes = lines.select("graph_id", F.explode(F.when(F.col("k") == 1, F.array(inner, *ends)).otherwise(F.array(inner))).alias("x")).select("graph_id", "x.*").withColumn("pdbs", none.cast(f"array<{graph.INTERVAL}>"))
    before = F.array_distinct(F.filter(F.array(zero, F.col("k") - 2, F.col("k") - 1), lambda x: x >= 0))
    edge = lambda src, dst, cleaved, qual, vc: F.struct((src * graph.MOST_NODES + dst).alias("edge_id"), src.alias("src"), dst.alias("dst"), cleaved.alias("cleaved"), qual.alias("qual"), vc.alias("vc"))
    into = F.transform(before, lambda b: edge(b, F.col("k"), (b > 0) & (F.col("k") - b == 1), F.when(F.col("vc") > 0, "R").otherwise(""), F.col("vc")))
    out = edge(F.col("k"), F.col("n") + 1, F.lit(False), F.lit(""), F.lit(0))
    # rows are made where their line lies: nothing is united, so nothing is dealt again
    edges = lines.select("graph_id", F.explode(F.concat(into, F.array(out))).alias("x")).select("graph_id", "x.*")
    return graph.Graphs(graphs, nodes, edges, parts=parts)


def ranges(spark: SparkSession, *bounds: tuple[int, int], max_vars: int | None = None, scale: int = peptides.SCALE) -> DataFrame:
    """query_id, lower, upper, max_vars of bounds in whole dalton (or of another scale)."""
    row = lambda k, a, b: F.struct(F.lit(k).cast("long").alias("query_id"), F.lit(a * scale).cast("long").alias("lower"), F.lit(b * scale).cast("long").alias("upper"), F.lit(max_vars).cast("int").alias("max_vars"))
    return spark.range(1).select(F.inline(F.array(*[row(k, a, b) for k, (a, b) in enumerate(bounds)])))
