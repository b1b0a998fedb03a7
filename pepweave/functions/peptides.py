"""Protein text as column expressions: residues, digestion, masses. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Masses are whole numbers of 1e-9 dalton.
SCALE = 1_000_000_000
#: Monoisotopic residue masses in 1e-9 dalton, by one-letter code, and water.
RESIDUES = {
    "A": 71_037113790, "C": 103_009184480, "D": 115_026943030, "E": 129_042593090, "F": 147_068413910, "G": 57_021463720, "H": 137_058911860, "I": 113_084063980, "K": 128_094963020, "L": 113_084063980,
    "M": 131_040484610, "N": 114_042927450, "P": 97_052763850, "Q": 128_058577510, "R": 156_101111030, "S": 87_032028410, "T": 101_047678470, "V": 99_068413910, "W": 186_079312950, "Y": 163_063328530,
}
WATER = 18_010564680
LETTERS = "".join(RESIDUES)


def residues(text: Column) -> Column:
    """The amino-acid letters of a text, in upper case; null becomes empty.

    ASCII letters are picked before the case changes, as upper-casing beyond ASCII differs from engine to engine.
    """
    both = LETTERS + LETTERS.lower()
    return F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{both}]+", ""))


def digest(protein: Column) -> Column:
    """Fragments of a cut after each K or R that no P follows, as an array without empty strings."""
    marked = protein
    for letter in "KR":  # plain replacements are cheaper than a pattern
        marked = F.replace(marked, F.lit(letter), F.lit(f"{letter}|"))
    marked = F.replace(marked, F.lit("|P"), F.lit("P"))
    return F.filter(F.split(marked, r"\|"), lambda x: x != "")


def mass(seq: Column) -> Column:
    """Sum of the residue masses; other characters weigh nothing."""
    out = F.lit(0).cast("long")
    for letter, m in RESIDUES.items():
        out = out + (F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))).cast("long") * F.lit(m)
    return out


def mass_sql(seq: str) -> str:
    """The same sum as SQL."""
    return " + ".join(f"(length({seq}) - length(replace({seq}, '{c}', ''))) * {m}" for c, m in RESIDUES.items())
