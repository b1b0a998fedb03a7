import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pepweave.functions import fasta, numbers, peptides


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 120, 121])
def test_wrap(spark, n):
    seq = "ACDEFG" * 30
    want = "".join(seq[k : min(k + 60, n)] + "\n" for k in range(0, n, 60))
    assert one(spark, fasta.wrap(F.col("x")), seq[:n]) == want


def test_digest(spark):
    cut = lambda s: one(spark, peptides.digest(F.col("x")), s)
    assert cut("AKRPKPGKA") == ["AK", "RPKPGK", "A"]
    assert cut("KKR") == ["K", "K", "R"] and cut("") == [] and cut("AG") == ["AG"]


def test_residues_and_mass(spark):
    assert one(spark, peptides.residues(F.col("x")), "a\u00df1K \u017f\u212a\u00e9wz") == "AKW"
    assert one(spark, peptides.residues(F.col("x")), None) == ""
    assert one(spark, peptides.mass(F.col("x")), "GGX") == 2 * peptides.RESIDUES["G"]


def test_numbers(spark):
    whole = lambda s: one(spark, numbers.whole(F.col("x")), s)
    assert [whole(s) for s in (" 12 ", "+3", "-4", "1.5", "1_0", "", None, "9" * 30)] == [12, 3, -4, None, None, None, None, None]
    fixed = lambda s: one(spark, numbers.fixed(F.col("x")), s)
    assert [fixed(s) for s in ("1.9999999999", "-1.9999999999", "5", ".5", "x", "1e3")] == [1999999999, -1999999999, 5000000000, 500000000, None, None]
    assert one(spark, numbers.present(F.col("x"), 65535), 65535, "int") is None


def test_headers(spark):
    row = spark.createDataFrame([("P1", 3, None, 2, ["a", "", "b"])], "acc string, s int, e int, m int, q array<string>")
    text = row.select(fasta.header(F.col("acc"), F.col("s"), F.col("e"), F.col("m"), F.col("q")).alias("h"))
    assert text.first().h == ">pg|TODO|P1(3:?,mssclvg:2,a,b)"
    back = text.select(*fasta.parsed(F.col("h"))).first()
    assert (back.acc, back.spos, back.epos, back.mssclvg, back.quals) == ("P1", 3, None, 2, ["a", "b"])
    assert spark.createDataFrame([("junk",)], "h string").select(*fasta.parsed(F.col("h"))).first().acc is None


def test_missed_of(spark):
    h = "x mssclvg:3, y mssclvg:1"
    assert one(spark, fasta.missed_of(F.col("x")), h) == 3 and one(spark, fasta.missed_of(F.col("x"), "all"), h) == 1
    assert one(spark, fasta.missed_of(F.col("x")), "none") is None and one(spark, fasta.missed_of(F.col("x"), "all"), "none") is None


@given(st.text(alphabet="AKRPG", max_size=40))
@settings(max_examples=25, deadline=None)
def test_digest_joins_back(spark, text):
    found = one(spark, peptides.digest(F.col("x")), text)
    assert found == [x for x in re.split("(?<=[KR])(?!P)", text) if x]
