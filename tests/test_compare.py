import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pepweave.operators import batches, budgets, compare
from pepweave.operators.ranges import interval_join, overlap_join, overlap_totals
from pepweave.plans import catalog, runs


def seqs(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "seq string")


def test_multiset_diff_can_fail_and_counts(spark):
    a, b = seqs(spark, "A", "A", "A", "B", "C"), seqs(spark, "A", "B", "D", "D")
    assert {tuple(r) for r in compare.multiset_diff(a, b).collect()} == {("<", "A", 2), ("<", "C", 1), (">", "D", 2)}
    assert compare.equal(a, a) and not compare.equal(a, b)
    assert [r.value for r in compare.diff_lines(compare.multiset_diff(a, b)).collect()] == ["< A", "< A", "< C", "> D", "> D"]


def test_line_mode_compares_fragments(spark):
    long = "A" * 60 + "C"
    diff = compare.multiset_diff(seqs(spark, long), seqs(spark, "A" * 60), mode="lines")
    assert [tuple(r) for r in diff.collect()] == [("<", "C", 1)]
    assert compare.multiset_diff(seqs(spark, long), seqs(spark, "A" * 60)).count() == 2


def test_merge_and_filters(spark):
    rows = spark.createDataFrame([("S", ">b mssclvg:2"), ("S", ">a mssclvg:0"), ("T", ">c")], "seq string, header string")
    merged = {r.seq: r for r in compare.merge(rows).collect()}
    assert merged["S"].n == 2 and merged["S"].headers == [">a mssclvg:0", ">b mssclvg:2"] and merged["T"].first_header == ">c"
    assert [r.header for r in compare.within_cleavages_text(rows, 1).collect()] == [">a mssclvg:0"]
    assert compare.within_cleavages(spark.createDataFrame([(1,), (3,)], "mssclvg int"), 2).count() == 1


@pytest.mark.parametrize("upper,want", [(0, 2), (1665, 2), (1666, 0), (3332, 1), (4998, 2), (99999, 2)])
def test_bins(spark, upper, want):
    got = spark.createDataFrame([(upper,)], "u long").select(budgets.bin_of(F.col("u"), 3, 5000).alias("b")).first().b
    assert got == want


def test_bins_without_width_and_by_edges(spark):
    df = spark.createDataFrame([(5,), (11,), (99,)], "u long")
    assert [r.b for r in df.select(budgets.bin_of(F.col("u"), 10, 5).alias("b")).collect()] == [9, 9, 9]
    assert [r.b for r in df.select(budgets.bin_by_edges(F.col("u"), [10, 20, 30]).alias("b")).collect()] == [0, 1, 2]


def test_budgets(spark):
    limits = spark.createDataFrame([("P", 0, 255), ("P", 1, 0)], "acc string, bin int, max_vars int")
    rows = spark.createDataFrame([("P", 0), ("P", 1), ("Q", 0)], "acc string, bin int")
    got = {(r.acc, r.bin): r.max_vars for r in budgets.with_budget(rows, limits, "zero").collect()}
    assert got == {("P", 0): None, ("P", 1): 0, ("Q", 0): 0}
    with pytest.raises(Exception, match="no budget for Q"):
        budgets.with_budget(rows, limits).collect()
    with pytest.raises(Exception, match="outside"):
        budgets.with_budget(rows.where("acc = 'P'"), limits.withColumn("max_vars", F.lit(256))).collect()


def test_row_numbers_and_batches(spark):
    df = spark.createDataFrame([(f"n{k % 7}", k) for k in range(250)], "name string, k long").repartition(5)
    numbered = batches.number_rows(df, "k")
    assert sorted((r.row, r.k) for r in numbered.collect()) == [(k, k) for k in range(250)]
    got = {r.batch: r for r in batches.batches(df, "name", 100, "k").collect()}
    assert [got[b].n for b in range(3)] == [100, 100, 50] and got[1]["values"] == [f"n{k % 7}" for k in range(100, 200)]
    assert batches.any_of(batches.batches(df.limit(0), "name")).count() == 0


def test_branches_join_where_all_have_the_key(spark):
    a = spark.createDataFrame([("r1", 1), ("r2", 2)], "run_prefix string, v int")
    rows = runs.join_branches({"a": a, "b": a.where("v = 2")}).collect()
    assert [(r.run_prefix, r.a.v, r.b.v) for r in rows] == [("r2", 2, 2)]


def test_compared_runs(spark):
    g = catalog.toy(spark)
    asked = spark.createDataFrame([(0, 10, 30)], "query_id long, lower long, upper long")
    assert runs.compare_readers(g, asked, runs.Run(1, 1, "x")).count() == 0
    less = type(g)(g.graphs, g.nodes, g.edges.where("vc = 0"))
    rows = runs.compare_sources({"all": g, "less": less}, asked, runs.Run(None, 2, "x"), [("all", "less"), ("all", "all")]).collect()
    assert [(r.left, r.right, r.side, r.seq) for r in rows] == [("all", "less", "<", "CR")]
    assert Counter(r.seq for r in runs.read_peptides(g, asked, runs.Run(0, 0, "x")).collect()) == {"AK": 1}


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(4)
    some = lambda n: [(k, rng.choice("ab"), lo, None if rng.random() < 0.05 else lo + rng.randint(-2, 40)) for k in range(n) for lo in [rng.randint(-50, 50)]]
    left, right = some(80), some(60)
    want = sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and None not in (a[3], b[3]) and a[2] <= a[3] and b[2] <= b[3] and a[2] <= b[3] and b[2] <= a[3])
    one, two = spark.createDataFrame(left, "i int, k string, lo int, hi int"), spark.createDataFrame(right, "j int, k string, lower int, upper int")
    for width in (1, 7, 1000):
        got = overlap_join(one, two, ("lo", "hi", "lower", "upper"), width, ["k"])
        assert sorted((r.i, r.j) for r in got.collect()) == want


def test_interval_join_of_any_lengths(spark):
    rng = random.Random(6)

    def some(n):
        out = []
        for k in range(n):
            lo = rng.choice([rng.randint(-(10**6), 10**6), rng.uniform(-50, 50), 0.0])
            out.append((k, rng.choice("ab"), float(lo), None if rng.random() < 0.05 else float(lo + rng.choice([-1, 0, 0.25, 1, 7, 1000, 10**6]))))
        return out

    left, right = some(90), some(70)
    want = sorted((a[0], b[0]) for a in left for b in right if a[1] == b[1] and None not in (a[3], b[3]) and a[2] <= a[3] and b[2] <= b[3] and a[2] <= b[3] and b[2] <= a[3])
    one, two = spark.createDataFrame(left, "i int, k string, lo double, hi double"), spark.createDataFrame(right, "j int, k string, lower double, upper double")
    got = interval_join(one, two, ("lo", "hi", "lower", "upper"), ["k"])
    assert sorted((r.i, r.j) for r in got.collect()) == want
    assert interval_join(one, two.limit(0), ("lo", "hi", "lower", "upper"), ["k"]).count() == 0
    big = spark.createDataFrame([(1, 2**62, 2**63 - 1), (2, 5, 5)], "i int, lo long, hi long")
    assert sorted((r.i, r.j) for r in interval_join(big, big.selectExpr("i as j", "lo as a", "hi as b"), ("lo", "hi", "a", "b")).collect()) == [(1, 1), (2, 2)]


def test_an_interval_becomes_few_rows(spark):
    long = spark.createDataFrame([(k, 0, 10**6) for k in range(50)], "i int, lo long, hi long")
    short = spark.createDataFrame([(k, 10**7 + k, 10**7 + k) for k in range(50)], "j int, a long, b long")
    joined = interval_join(long, short, ("lo", "hi", "a", "b"))
    assert joined.count() == 0 and "1000001" not in joined._jdf.queryExecution().executedPlan().toString()


def test_differences_by_digests(spark):
    rows = [(rng_word,) for k in range(3000) for rng_word in [f"s{k % 700}"]] + [(None,)] * 3
    left = spark.createDataFrame(rows, "seq string")
    right = spark.createDataFrame(rows[5:-1] + [("new",)] * 4 + [("s9",)], "seq string")
    got = lambda x: sorted((r.side, r.seq or "", r.n) for r in x.collect())
    for ranges in (1, 16, compare.RANGES):
        assert got(compare.digest_diff(left, right, ranges=ranges)) == got(compare.multiset_diff(left, right)) != []
        assert got(compare.digest_diff(left, left.repartition(7), ranges=ranges)) == []
    assert got(compare.digest_diff(left, left.limit(0))) == got(compare.multiset_diff(left, left.limit(0)))
    # equal sides: no key is looked at again
    assert compare.digest_diff(left, left)._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 0


def test_totals_of_meeting_intervals_without_their_pairs(spark):
    rng = random.Random(5)

    def some(n, kinds):
        at = [rng.randrange(40) for _ in range(n)]
        return [(rng.choice(kinds), a, rng.choice([a, a + 1, a + rng.randrange(30), a - 1])) for a in at] + [(kinds[0], None, 3), (kinds[0], 3, None)]

    left, right = some(150, [0, 1, None]), some(120, ["p", "q"])
    want = {}
    for (g, a, b), (h, lo, hi) in ((x, y) for x in left for y in right):
        if None not in (a, b, lo, hi) and a <= b and lo <= hi and a <= hi and lo <= b:
            n, shared = want.get((g, h), (0, 0))
            want[g, h] = n + 1, shared + min(b, hi) - max(a, lo)
    one, two = spark.createDataFrame(left, "g int, a long, b long"), spark.createDataFrame(right, "h string, lo long, hi long")
    got = overlap_totals(one, two, ("a", "b", "lo", "hi"), ("g", "h"))
    assert {(r.g, r.h): (r.n, r.shared) for r in got.collect()} == want
    assert overlap_totals(one, two.limit(0), ("a", "b", "lo", "hi"), ("g", "h")).count() == 0


def test_totals_move_ends_and_no_pairs(spark):
    # 10**10 pairs meet
    long = spark.range(100_000).selectExpr("0 as g", "id as a", "1000000 + id as b")
    got = overlap_totals(long, long.toDF("h", "lo", "hi"), ("a", "b", "lo", "hi"), ("g", "h")).collect()
    assert [(r.n, r.shared) for r in got] == [(10**10, sum((2 * (100_000 - d) if d else 100_000) * (1_000_000 - d) for d in range(100_000)))]
