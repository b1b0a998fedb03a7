from pyspark.sql import functions as F

from pepweave.sources import entries

TEXT = """ID   ONE_TEST                Reviewed;          24 AA.
AC   P12345; Q00001;
AC   Q00002;
DE   RecName: Full=Test;
CC   -!- ALTERNATIVE PRODUCTS:
CC       Event=Alternative splicing; Named isoforms=3;
CC       Name=1;
CC         IsoId=P12345-1; Sequence=Displayed;
CC       Name=2; Synonyms=B;
CC         IsoId=P12345-2, Q00001-2; Sequence=VSP_000001, VSP_000002;
CC       Name=3;
CC         IsoId=P12345-3; Sequence=External;
FT   CHAIN           1..24
FT                   /note="Test"
FT                   /id="PRO_1"
FT   VAR_SEQ         1..3
FT                   /note="Missing (in isoform 2)"
FT                   /id="VSP_000001"
FT   VAR_SEQ         10
FT                   /note="K -> WW (in isoform 2)"
FT                   /id="VSP_000002"
FT   VARIANT         5
FT                   /note="E -> T (in disease; with ""quotes"";
FT                   dbSNP:rs1)"
FT                   /evidence="ECO:1"
FT                   /id="VAR_000001"
FT   VARIANT         7..9
FT                   /note="GHI -> AC
FT                   DEF (in b)"
FT                   /source="ebi"
FT   VARIANT         11
FT                   /note="Missing"
FT   VARIANT         12
FT                   /note="A -> T"
FT   VARIANT         ?
FT                   /note="A -> T"
FT   VARIANT         P12345-2:4
FT                   /note="F -> T"
FT   VARIANT         99
FT                   /note="F -> T"
FT   VARIANT         6
FT                   /note="In reference"
SQ   SEQUENCE   24 AA;  2000 MW;  0000000000000000 CRC64;
     ACDEEFGHIK LMNPQRSTVW
     yacd
//
ID   TWO
AC   Q9
SQ   SEQUENCE   0 AA;
//
ID   THREE
//
"""


def read(spark, tmp_path, text):
    (tmp_path / "e.txt").write_text(text)
    return entries.read_entries(spark, str(tmp_path / "e.txt"))


def test_entries(spark, tmp_path):
    rows = {r.acc: r for r in read(spark, tmp_path, TEXT).collect()}
    assert set(rows) == {"P12345", "Q9", None}
    one = rows["P12345"]
    assert one.accessions == ["P12345", "Q00001", "Q00002"] and one.sequence == "ACDEEFGHIKLMNPQRSTVWYACD"
    assert [(f.key, f.begin, f.end) for f in one.features][:3] == [("CHAIN", 1, 24), ("VAR_SEQ", 1, 3), ("VAR_SEQ", 10, 10)]
    assert [(i.id, list(i.parts)) for i in one.isoforms] == [("P12345-1", []), ("P12345-2", ["VSP_000001", "VSP_000002"]), ("P12345-3", [])]
    assert rows["Q9"].sequence == "" and list(rows["Q9"].features) == []


def test_variants_of_entries(spark, tmp_path):
    found = read(spark, tmp_path, TEXT)
    got = {(r.acc, r.pos, r.until, r.original, r.replacement, r.source) for r in entries.variants(found).collect()}
    assert got == {("P12345", 5, 5, "E", "T", "uniprot"), ("P12345", 7, 9, "GHI", "ACDEF", "ebi"), ("P12345", 11, 11, "L", "", "unknown")}
    assert {r.source for r in entries.variants(entries.of_sources(found, ["ebi"])).collect()} == {"ebi"}


def test_isoforms(spark, tmp_path):
    got = {(r.isoform, r["index"]): r.sequence for r in entries.isoform_sequences(read(spark, tmp_path, TEXT)).collect()}
    assert got == {("P12345-1", 0): "ACDEEFGHIKLMNPQRSTVWYACD", ("P12345-2", 1): "EEFGHIWWLMNPQRSTVWYACD", ("P12345-3", 2): "ACDEEFGHIKLMNPQRSTVWYACD"}


def test_entries_that_are_written_are_read_back(spark, tmp_path):
    long = "ACDEFGHIKL" * 40
    proteins = spark.createDataFrame([("P1", long), ("P2", "AK"), ("P3", "")], "acc string, protein string")
    changes = spark.createDataFrame([("P1", 3, 3, "D", "", "ebi"), ("P1", 1, 300, long[:300], long[7:207], "uniprot"), ("P2", 2, 2, "K", "T", "x")], "acc string, pos int, until int, original string, replacement string, source string")
    entries.write_entries(proteins, changes, str(tmp_path / "out"))
    back = entries.read_entries(spark, str(tmp_path / "out"))
    assert sorted((r.acc, r.protein) for r in entries.proteins(back).collect()) == [("P1", long), ("P2", "AK"), ("P3", "")]
    assert sorted(tuple(r) for r in entries.variants(back).drop("graph_id").collect()) == sorted(tuple(r) for r in changes.collect())


def test_long_entries_in_split_files(spark, tmp_path):
    proteins = spark.range(300).select(F.concat(F.lit("P"), "id").alias("acc"), F.expr("repeat('ACDEFGHIKL', cast(id as int))").alias("protein"))
    changes = proteins.where("protein <> ''").select("acc", F.lit(1).alias("pos"), F.lit(1).alias("until"), F.lit("A").alias("original"), F.lit("C").alias("replacement"), F.lit("s").alias("source"))
    entries.write_entries(proteins.coalesce(1), changes, str(tmp_path / "out"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        back = entries.read_entries(spark, str(tmp_path / "out"))
        assert back.rdd.getNumPartitions() > 5
        assert back.count() == 300 and back.select(F.sum(F.length("sequence"))).first()[0] == sum(10 * k for k in range(300))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_compressed_entries_and_variants_without_a_line(spark, tmp_path):
    found = spark.createDataFrame([("A1", "ACDEF"), ("A2", "KR")], "acc string, protein string")
    rows = [("A1", 4, 5, "EF", "", "ebi"), ("A1", 2, 2, "C", "T", "uniprot"), ("A1", 2, 2, "C", None, "ebi"), ("A1", 3, 3, None, "T", "ebi"), ("A1", 1, 1, "A", "G", None)]
    changes = spark.createDataFrame(rows, "acc string, pos int, until int, original string, replacement string, source string")
    entries.write_entries(found, changes, str(tmp_path / "z"), "gzip")
    assert list((tmp_path / "z").glob("*.gz")) and not list((tmp_path / "z").glob("*.txt"))
    got = entries.read_entries(spark, str(tmp_path / "z"))
    assert sorted(tuple(r)[1:] for r in entries.variants(got).collect()) == sorted(rows[:2])
    assert {(r.acc, r.protein) for r in entries.proteins(got).collect()} == {("A1", "ACDEF"), ("A2", "KR")}
