import pytest
from brute import random_graphs

from pepweave.operators import budgets, intervals, render
from pepweave.operators.traverse import traverse
from pepweave.plans import catalog
from pepweave.sources import binary_graph, fasta, inputs
from pepweave.streaming.feed import answer_queries


def put(path, text):
    path.write_text(text) if isinstance(text, str) else path.write_bytes(text)
    return str(path)


def test_run_sheet(spark, tmp_path):
    good = put(tmp_path / "a.csv", "input_file,query_file,max_vars,max_cleavages,run_prefix\na.csv,q.csv,3,2,15\n")
    assert [tuple(r) for r in inputs.read_run_sheet(spark, good).collect()] == [("a.csv", "q.csv", 3, 2, "15")]
    with pytest.raises(ValueError, match="max_cleavages"):
        inputs.read_run_sheet(spark, put(tmp_path / "b.csv", "input_file,query_file,max_vars,run_prefix\na,q,3,x\n"))
    bad = put(tmp_path / "c.csv", "input_file,query_file,max_vars,max_cleavages,run_prefix\na,q,x,2,r\n")
    with pytest.raises(Exception, match="max_vars"):
        inputs.read_run_sheet(spark, bad).collect()


def test_accessions(spark, tmp_path):
    path = put(tmp_path / "acc.csv", "P1,x\n\n P2 \nP2")
    assert [r.acc for r in inputs.read_accessions(spark, path).collect()] == ["P1", "P2", "P2"]
    path = put(tmp_path / "head.csv", "id,acc\n1,P1\n2,P3\n")
    assert [r.acc for r in inputs.read_accessions(spark, path, 1, header=True).collect()] == ["P1", "P3"]


def test_queries(spark, tmp_path):
    path = put(tmp_path / "q.csv", "lower,upper\n4000,5000\n500, 600,x\nbad\n")
    got = inputs.read_queries(spark, path)
    assert [tuple(r)[1:] for r in got.orderBy("query_id").collect()] == [(4000 * 10**9, 5000 * 10**9), (500 * 10**9, 600 * 10**9)]
    inputs.write_queries(got, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).columns == ["lower", "upper"]
    with pytest.raises(Exception, match="not a query"):
        inputs.read_queries(spark, path, "decimal_strict").collect()
    with pytest.raises(ValueError):
        inputs.read_queries(spark, path, "other")


def test_limits(spark, tmp_path):
    path = put(tmp_path / "l.csv", "#bins,2\nbins,3,3,3\nP1,3,255,255\nP2,0,1\n")
    got = inputs.read_limits(spark, path)
    assert sorted(tuple(r) for r in got.collect()) == [("P1", 0, 3), ("P1", 1, 255), ("P2", 0, 0), ("P2", 1, 1)]
    assert sorted(r.value for r in inputs.limits_lines(got).collect()) == ["P1,3,255", "P2,0,1"]
    with pytest.raises(Exception, match="P9"):
        inputs.read_limits(spark, put(tmp_path / "m.csv", "#bins,2\nP9,1\n")).collect()
    accs = spark.createDataFrame([("A",)], "acc string")
    assert budgets.constant_limits(accs, 2, 5).count() == 2


def test_ragged_padded_and_quoted_rows(spark, tmp_path):
    path = put(tmp_path / "r.csv", 'P1\nP2,x\nP4,a,b\n\tP3\t,\u00a0y \n"Q ""1""","z, w"\n')
    read = lambda k: [r.acc for r in inputs.read_accessions(spark, path, k).collect()]
    assert read(0) == ["P1", "P2", "P4", "P3", 'Q "1"'] and read(1) == ["x", "a", "y", "z, w"] and read(2) == ["b"] and read(3) == []
    lines = spark.read.text(path)
    assert [r.acc for r in inputs.accessions(lines, 1).collect()] == ["x", "a", "y", "z, w"]
    path = put(tmp_path / "q.csv", '4000,\t5000\n"4001","5000"\n4002,5000\n"4003,5000"\n')
    assert [r.lower // 10**9 for r in inputs.read_queries(spark, path).orderBy("query_id").collect()] == [4000, 4001, 4002]


def test_limits_of_several_files(spark, tmp_path):
    (tmp_path / "l").mkdir()
    put(tmp_path / "l" / "a.csv", "#bins,1\nbins,3\nP1,3\nP1,3\n")
    put(tmp_path / "l" / "b.csv", "#bins,3\nbins,3,3,3\n\tP2 ,1,2,255\n")
    got = inputs.read_limits(spark, str(tmp_path / "l"))
    assert sorted(tuple(r) for r in got.collect()) == [("P1", 0, 3), ("P1", 0, 3), ("P2", 0, 1), ("P2", 1, 2), ("P2", 2, 255)]
    rows = spark.createDataFrame([("P1", 0), ("P2", 2)], "acc string, bin int")
    assert sorted(tuple(r) for r in budgets.with_budget(rows, got).collect()) == [("P1", 0, 3), ("P2", 2, None)]
    torn = got.unionAll(spark.createDataFrame([("P1", 0, 4)], "acc string, bin int, max_vars int"))
    with pytest.raises(Exception, match="different budgets for P1"):
        budgets.with_budget(rows, torn).collect()
    with pytest.raises(Exception, match="P7"):
        inputs.read_limits(spark, put(tmp_path / "c.csv", "P7,1\n")).collect()


def test_flat_text(spark, tmp_path):
    path = put(tmp_path / "f.txt", "ID   X\nAC   P12345; Q1;\nSQ\n//\nID   Y\nAC   Q9\n//\n")
    assert [r.acc for r in inputs.read_flat(spark, path).collect()] == ["P12345", "Q9"]


def test_fasta_round_trip(spark, tmp_path):
    found = render.peptides(traverse(catalog.toy(spark), spark.createDataFrame([(0, 10, 30, 1)], "query_id long, lower long, upper long, max_vars int")).paths, catalog.toy(spark).graphs)
    long = "ACDEFGHIKL" * 13
    found = found.unionByName(found.limit(1).withColumn("seq", found.seq).selectExpr("query_id", "graph_id", "acc", "spos", "epos", "mssclvg", "quals", "vc", "w", f"'{long}' as seq"))
    fasta.write_fasta(render.records(found), str(tmp_path / "out"))
    back = fasta.read_fasta(spark, str(tmp_path / "out"))
    want = sorted((r.header[1:], r.seq) for r in render.headers(found).collect())
    assert sorted((r.header, r.seq) for r in back.collect()) == want
    assert fasta.read_fasta(spark, put(tmp_path / "e.fasta", "")).count() == 0


def test_binary_round_trip(spark, tmp_path):
    g, made = random_graphs(spark, 11, 12)
    nodes = {}
    for r in intervals.summarise(g, 3).nodes.collect():
        nodes.setdefault(r.graph_id, []).append(r)
    records = []
    for (gid, accessions, n, _, _), _, edges in made:
        own = sorted(nodes[gid], key=lambda r: r.node_id)
        edges = sorted(edges, key=lambda e: (e[2], e[1]))
        out = [{**r.asDict(recursive=True), "end_off": sum(e[2] <= r.node_id for e in edges)} for r in own]
        records.append({"accessions": accessions, "n_pdb": 3, "nodes": out, "edges": [{"dst": e[3], "cleaved": e[4], "qual": e[5], "vc": e[6]} for e in edges]})
    path = put(tmp_path / "g.bpcsr", b"".join(map(binary_graph.encode, records)))
    got = binary_graph.read_graphs(spark, path)
    assert got.graphs.count() == 12 and got.edges.count() == sum(len(m[2]) for m in made)
    asked = spark.createDataFrame([(0, 5, 20, 1)], "query_id long, lower long, upper long, max_vars int")
    bag = lambda x: sorted((r.seq, r.a, r.vc, r.mc) for r in traverse(x, asked).paths.collect())
    assert bag(got) == bag(g)


def test_binary_sentinels_and_faults(spark, tmp_path):
    node = {"seq": "A", "pos": None, "iso_idx": 0, "iso_pos": 3, "w": -5, "end_off": 0, "pdbs": [{"lo": 1, "hi": 2**63 - 1}]}
    data = binary_graph.encode({"accessions": ["P"], "n_pdb": 2, "nodes": [node], "edges": []})
    got = next(binary_graph.decode(data))
    assert got["nodes"][0]["pdbs"] == [{"lo": 1, "hi": 2**63 - 1}] and got["nodes"][0]["pos"] == 65535 and got["nodes"][0]["w"] == -5
    assert list(binary_graph.decode(b"")) == []
    with pytest.raises(ValueError, match="ends within"):
        list(binary_graph.decode(data[:-3]))
    with pytest.raises(ValueError, match="no reader"):
        binary_graph.read_graphs(spark, "x.txt")
    row = binary_graph.read_graphs(spark, put(tmp_path / "one.bpcsr", data)).nodes.first()
    assert row.pos is None and row.iso_pos == 3


def test_stream_of_queries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    small = catalog.toy(spark)
    scaled = type(small)(small.graphs, small.nodes.drop("pdbs").selectExpr("graph_id", "node_id", "seq", "pos", "iso_idx", "iso_pos", "w * 1000000000 as w", "cast(null as array<struct<lo:bigint,hi:bigint>>) as pdbs"), small.edges)
    put(tmp_path / "in" / "a.csv", "lower,upper\n10,20\n")
    run = lambda: answer_queries(spark, scaled, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    run()
    put(tmp_path / "in" / "b.csv", "30,30\n")
    run()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.batch, r.seq) for r in got) == [(0, "AK"), (0, "CR"), (1, "AKCR")]


def test_accessions_by_place(spark, tmp_path):
    path = put(tmp_path / "h.csv", 'id,acc\n,P2\n1,"a,b"\n2,\n"x,y",P3\n')
    assert [r.acc for r in inputs.read_accessions(spark, path, 1, header=True).collect()] == ["P2", "a,b", "P3"]
    assert inputs.read_accessions(spark, path, 7, header=True).count() == 0


def test_results_by_query_and_other_formats(spark, tmp_path):
    rows = spark.createDataFrame([(0, ">a\nAK"), (1, ">b\nCR")], "query_id long, value string")
    fasta.write_fasta(rows, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in fasta.read_fasta(spark, str(tmp_path / "out")).select("query_id", "header", "seq").collect()) == [(0, "a", "AK"), (1, "b", "CR")]
    node = {"seq": "A", "pos": None, "iso_idx": 0, "iso_pos": 3, "w": 5, "end_off": 0, "pdbs": []}
    data = binary_graph.encode({"accessions": ["P"], "n_pdb": 0, "nodes": [node], "edges": []})
    (tmp_path / "graphs").mkdir()
    put(tmp_path / "graphs" / "a.bpcsr", data)
    put(tmp_path / "graphs" / "b.twice", data + data)
    with pytest.raises(Exception, match="no reader"):
        binary_graph.read_graphs(spark, str(tmp_path / "graphs"))
    with pytest.raises(Exception, match="no reader"):
        binary_graph.read_graphs(spark, f"{tmp_path}/graphs/*")
    binary_graph.FORMATS[".twice"] = binary_graph.decode
    try:
        assert binary_graph.read_graphs(spark, str(tmp_path / "graphs")).graphs.count() == 3
    finally:
        del binary_graph.FORMATS[".twice"]
