from collections import Counter

import pytest

from pepweave.functions.peptides import RESIDUES, SCALE
from pepweave.operators import graph
from pepweave.operators.traverse import traverse
from pepweave.plans import workflow
from pepweave.sources import inputs


def mass(seq):
    return sum(RESIDUES[c] for c in seq)


def proteins(spark):
    return spark.createDataFrame([(1, "P1", "AKCRGG"), (2, "P2", ""), (3, "P3", "GG")], "graph_id long, acc string, protein string")


def table(spark):
    rows = [(1, 1, "G", "x"), (1, 1, "G", "x"), (1, 4, "", "x"), (1, 2, "A", "y"), (1, 99, "A", "x"), (3, 2, "W", "y")]
    return spark.createDataFrame(rows, "graph_id long, pos int, replacement string, source string")


@pytest.mark.parametrize("source,forms", [("x", [["AK", "GK"], ["CR", "C"], ["GG"]]), (None, [["AK", "GK", "AA"], ["CR", "C"], ["GG"]])])
def test_graphs_of_a_variant_table(spark, source, forms):
    g = graph.from_variants(proteins(spark), table(spark), source)
    g.check()
    asked = spark.createDataFrame([(0, 0, 10**15)], "query_id long, lower long, upper long")
    found = [r for r in traverse(g, asked).paths.collect() if r.graph_id == 1]
    want = Counter()
    for i in range(3):
        runs = [("", 0)]
        for j in range(i, 3):
            runs = [(s + f, v + (k > 0)) for s, v in runs for k, f in enumerate(forms[j])]
            want.update((s, mass(s), v) for s, v in runs)
    assert Counter((r.seq, r.a, r.vc) for r in found) == want
    assert {q for r in found for q in r.quals} >= {"VARIANT:A1G", "VARIANT:R4"}


def test_a_sheet_of_runs(spark, tmp_path):
    (tmp_path / "q.csv").write_text(f"lower,upper\n0,{mass('AKCRGG') // SCALE + 200}\n")
    (tmp_path / "sheet.csv").write_text(f"input_file,query_file,max_vars,max_cleavages,run_prefix\nin.csv,{tmp_path}/q.csv,1,0,r1\nin.csv,{tmp_path}/q.csv,0,2,r2\n")
    asked = []

    def branches(name):
        asked.append(name)
        return {"x": graph.from_variants(proteins(spark), table(spark), "x"), "none": graph.from_variants(proteins(spark), table(spark), "z")}

    told = {(r.run_prefix, r.left, r.right): r.n for r in workflow.execute(spark, str(tmp_path / "sheet.csv"), branches, [("x", "none")], str(tmp_path / "out")).collect()}
    assert told == {("r1", "x", "none"): 2, ("r2", "x", "none"): 0} and asked == ["in.csv", "in.csv"]
    seqs = {r.seq for r in spark.read.parquet(str(tmp_path / "out" / "peptides" / "x" / "r1")).collect()}
    assert seqs == {"AK", "GK", "CR", "C", "GG"}


def test_progress(spark):
    rows = workflow.progress_lines(spark.createDataFrame([(0, 500 * SCALE, 600 * SCALE)], "query_id long, lower long, upper long")).collect()
    assert [r.value for r in rows] == ["Processed Query 0 with: 500:600"]


def test_build_input(spark, tmp_path):
    (tmp_path / "acc.csv").write_text("id,acc\n1,Q9\n2,P1\n,P1\n3,\n4,X7\n")
    (tmp_path / "q.csv").write_text("500,600\nbad\n4000, 5000\n")
    (tmp_path / "f.txt").write_text("ID   A\nAC   P1; Z;\nSQ   AK\n//\nID   B\nAC   R2;\n//\nID   C\nAC   Q9;\n//\n")
    paths = workflow.build_input(spark, f"{tmp_path}/acc.csv", f"{tmp_path}/q.csv", f"{tmp_path}/f.txt", 3, f"{tmp_path}/out", 1, True, batch=3)
    assert sorted(tuple(r)[1:] for r in inputs.read_queries(spark, paths["queries"]).collect()) == [(500 * SCALE, 600 * SCALE), (4000 * SCALE, 5000 * SCALE)]
    assert sorted(tuple(r) for r in inputs.read_limits(spark, paths["limits"]).collect()) == [("P1", 0, 3), ("Q9", 0, 3), ("X7", 0, 3)]
    assert sorted(r.acc for r in inputs.read_flat(spark, paths["entries"]).collect()) == ["P1", "Q9"]
    assert sorted(r.value for r in spark.read.text(paths["asked"]).collect()) == ["accession:(P1 OR P1 OR Q9)", "accession:(X7)"]


def test_budgets_by_accession_steer_the_enumeration(spark):
    g = graph.from_variants(proteins(spark), table(spark))
    asked = spark.createDataFrame([(0, 0, 10**15, 0), (1, 0, 10**15, 1)], "query_id long, lower long, upper long, bin int")
    limits = spark.createDataFrame([("P1", 0, 0), ("P1", 1, 255), ("P2", 0, 1), ("P2", 1, 1), ("P3", 0, 0), ("P3", 1, 1)], "acc string, bin int, max_vars int")
    found = traverse(g, asked, limits=limits).paths.collect()
    most = {(q, i): max((r.vc for r in found if (r.query_id, r.graph_id) == (q, i)), default=None) for q in (0, 1) for i in (1, 2, 3)}
    assert most == {(0, 1): 0, (0, 2): None, (0, 3): 0, (1, 1): 2, (1, 2): None, (1, 3): 1}
    with pytest.raises(Exception, match="no budget for P3"):
        traverse(g, asked, limits=limits.where("acc <> 'P3'"))
    assert len(traverse(g, asked, limits=limits.where("acc <> 'P3'"), missing="unlimited").paths.collect()) >= len(found)
