"""Entries are parsed once, whatever is read from them, and site variants are made where they are."""

from pyspark.sql import functions as F

from pepweave.plans import standins
from pepweave.sources import entries


def test_a_feature_is_read_once(spark):
    raw = spark.createDataFrame([("AC   A;",)], "value string")
    plan = entries.variants(entries.parse(raw))._jdf.queryExecution().optimizedPlan().toString()
    # the lines of a feature are joined once, and no filter repeats the parsing
    assert plan.count("nFT +") == 1 and plan.count("change") == 0 and plan.count("/note=") <= 3


def test_text_of_both_line_ends_and_odd_places(spark):
    body = "FT                   "
    lines = ["ID   X", "AC   A1; A2;", "AC   A3;", "FT   VARIANT         2..3", f'{body}/note="AK -> WA', f'{body}CD"', f'{body}/id="VAR_1"', "FT   VARIANT         ?..9", f'{body}/note="Missing"', "FT   VARIANT         A1-2:4", f'{body}/note="Missing"', "FT   SITE            7", f"SQ   SEQUENCE   {70} AA;", "     MAKR"]
    for end in ("\n", "\r\n"):
        (row,) = entries.parse(spark.createDataFrame([(end.join(lines),)], "value string")).collect()
        assert row.accessions == ["A1", "A2", "A3"] and row.acc == "A1" and row.sequence == "MAKR"
        told = [(f.key, f.isoform, f.begin, f.end, f.original, f.replacement, f.id, f.source) for f in row.features]
        assert told == [("VARIANT", None, 2, 3, "AK", "WACD", "VAR_1", "uniprot"), ("VARIANT", None, None, None, None, "", None, "unknown"), ("VARIANT", "A1-2", 4, 4, None, "", None, "unknown"), ("SITE", None, 7, 7, None, None, None, "unknown")]


def test_long_proteins_are_laid_out_as_before(spark):
    rows = [(f"P{n}", ("ACDEFGHIKL" * 30)[:n]) for n in (0, 1, 9, 10, 59, 60, 61, 65, 66, 119, 120, 121, 299)]
    none = spark.createDataFrame([], "acc string, pos int, until int, original string, replacement string, source string")
    for r in entries.render(spark.createDataFrame(rows, "acc string, protein string"), none).withColumn("acc", F.regexp_extract("value", r"AC   (\w+);", 1)).collect():
        seq = dict(rows)[r.acc]
        want = [" ".join(seq[k : k + 60][j : j + 10] for j in range(0, len(seq[k : k + 60]), 10)) for k in range(0, max(len(seq), 1), 60)]
        assert r.value.split(" AA;\n")[1] == "\n".join(f"     {x}" for x in want)


def test_site_variants_make_no_row_without_a_variant(spark):
    rows, found = standins.site_variants(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "split(protein" not in plan
    proteins = {r.graph_id: r.protein for r in rows.collect()}
    want = []
    for g, p in proteins.items():
        for k, c in enumerate(p, 1):
            want += [(g, k, c, "T" if c == "K" else "K", "ebi")] if k % 11 == 4 else [(g, k, c, "A" if c == "P" else "P", "uniprot")] if k % 11 == 5 else []
            want += [(g, k, c, "", "uniprot")] if k % 23 == 9 else []
    assert sorted((r.graph_id, r.pos, r.original, r.replacement, r.source) for r in found.collect()) == sorted(want)
