import hashlib
import re

from helpers import by_id, docs

from pepweave.llm import exact_dedup

ROWS = [(5, "a b c"), (3, "abc"), (9, "a b  c"), (1, "ab c\n"), (7, None), (8, ""), (2, " \t"), (4, "x" * 300_000), (6, "y\x00é"), (10, "y\x00 é"), (11, "alone")]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), min(g)[1] == i, hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, i in g}


def test_matches_brute_force(spark):
    got = by_id(exact_dedup.mark(docs(spark, ROWS, norm="clash", h128="clash", best=1)))
    assert {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in got.items()} == brute(ROWS)


def test_dedup_keeps_columns_and_rows(spark):
    df = docs(spark, ROWS, sha="clash", h128="clash")
    out = exact_dedup.dedup(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, x in brute(ROWS).items() if x[2])


def test_null_ids_ties_and_empty(spark):
    got = exact_dedup.mark(docs(spark, [(None, "q"), (None, "q"), (4, "q")])).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(None, 4, 3, False), (4, 4, 3, True)}
    assert exact_dedup.mark(docs(spark, [])).count() == 0
    assert [r.kept for r in exact_dedup.mark(docs(spark, [(1, "q"), (1, "q")])).collect()] == [True, True]


def test_dedup_keeps_one_row_of_each_group(spark):
    def kept(rows):
        df = docs(spark, rows, own_id="clash", n=1)
        out = exact_dedup.dedup(df)
        assert out.columns == df.columns
        return sorted((str(r.doc_id), r.text) for r in out.collect())

    assert kept([(1, "a b"), (1, "a  b"), (1, "a b")]) == [("1", "a  b")]
    assert kept([(5, "x y")] * 4 + [(6, "xy")]) == [("5", "x y")]
    assert len(kept([(5, "x y"), (5, "xy "), (5, " xy")])) == 1
    assert kept([(None, "q"), (None, "q"), (None, "r"), (7, "r")]) == [("7", "r"), ("None", "q")]
    assert kept([(1, "alone"), (1, "other"), (None, None), (2, ""), (3, " ")]) == [("1", "alone"), ("1", "other"), ("3", " ")]
    rows = ROWS + ROWS[::2] + [(None, t) for _, t in ROWS[::3]]
    best = {}
    for i, t in rows:
        best.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i is None, i))
    assert sorted(i for i, _ in kept(rows)) == sorted(str(min(g)[2]) for g in best.values())


def test_dedup_shuffles_only_texts_that_may_repeat(spark, monkeypatch):
    rows = [(k, f"text {k} " * 5) for k in range(2000)] + [(5000 + k, f"text  {k} " * 5) for k in range(40)] + [(None, "text 7 " * 5)]
    out = exact_dedup.dedup(docs(spark, rows))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Anti" not in plan and plan.count("Aggregate") == 1
    left = sorted(str(r.doc_id) for r in out.collect())
    assert left == sorted([str(k) for k in range(40, 2000)] + [str(5000 + k) for k in range(40)])
    # a bitmap that is too small sends more rows to be compared, with equal results
    monkeypatch.setattr(exact_dedup, "BUCKET", 1)
    monkeypatch.setattr(exact_dedup, "MOST_BITS", 2)
    assert sorted(str(r.doc_id) for r in exact_dedup.dedup(docs(spark, rows)).collect()) == left
