import math
import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import docs

from pepweave.llm import toxicity

BAD, STEM = ["zorgle", "blimf", "krat"], "vexo"
GOOD = [a + b for a in ("sun", "tal", "mer", "lo", "vi") for b in ("ra", "ten", "so", "ke", "mi", "nu")]


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(GOOD) for _ in range(rng.randint(3, 200))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(2 + len(w) // 25):
                w.insert(rng.randrange(len(w)), rng.choice([*BAD, STEM + rng.choice(GOOD)]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_awkward_rows(spark):
    rows, labels = corpus()
    truth = {i: t for i, _, t in labels}
    table = spark.createDataFrame([*labels, (5000, 1, 7), (0, None, None)], "doc_id long, quality int, toxic int")
    odd = [(5000, None), (5001, ""), (5002, "lora " * 60_000), (None, "lora zorgle blimf zorgle")]
    got = toxicity.score(docs(spark, [*rows, *odd], score=1, x="clash"), table).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    by = {r.doc_id: r for r in got}
    assert not by[5000].predicted and not by[5001].predicted and not by[5002].predicted
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert sum(a and b for a, b in held) / sum(a for a, _ in held) > 0.9
    df = docs(spark, [*rows, *odd], lang2="clash")
    kept = toxicity.reject(df, table)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)


def test_labels_that_teach_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.score(docs(spark, [(1, "a")]), none).collect()] == [(0.0, 0)]
    one = spark.createDataFrame([(k, 0, 0) for k in range(9)], "doc_id long, quality int, toxic int")
    assert toxicity.reject(docs(spark, [(1, "a"), (2, None)]), one).count() == 2
    assert toxicity.score(docs(spark, []), one).count() == 0


def test_hits_are_whole_words_and_proper_stems():
    terms = ["=bad", "ba+"]
    x = toxicity.measure(toxicity.hit_finder(terms), 2, pa.array(["Bad bads, ba xbad BAD-", None]))
    assert x[:, :3].tolist() == [[2, 3, 5], [0, 0, 0]]


def test_label_model_discounts_copies():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    voter = lambda hit: np.where(rng.random(4000) < hit, np.where(y, 1, -1), np.where(y, -1, 1))
    a, b = voter(0.8), voter(0.8)
    v = np.column_stack([a, a, a, b]).astype(np.int8)
    model = toxicity.maximise(toxicity.sums(v, y.astype(float)), 4)
    assert model.weight[0] < 0.4 < 0.9 < model.weight[3]
    assert abs(model.table[3, 1, 2] - 0.8) < 0.05


def test_a_pass_of_em_equals_plain_loops():
    rng = np.random.default_rng(5)
    v = rng.integers(-1, 2, (300, 5)).astype(np.int8)
    p = rng.random(300)
    model = toxicity.maximise(toxicity.sums(v[:120], p[:120]) + toxicity.sums(v[120:], p[120:]), 5)
    for c, q in ((0, 1 - p), (1, p)):
        for k in range(5):
            for s in (-1, 0, 1):
                want = (sum(q[r] for r in range(300) if v[r, k] == s) + 0.5) / (sum(q) + 1.5)
                assert abs(model.table[k, c, s + 1] - want) < 1e-12
    assert abs(model.prior - sum(p) / 300) < 1e-12
    rho = np.zeros((5, 5))
    for q in (1 - p, p):
        for a in range(5):
            for b in range(5):
                mean = lambda f: sum(w * f(r) for w, r in zip(q, v.astype(float))) / sum(q)
                cov = lambda i, j: mean(lambda r: r[i] * r[j]) - mean(lambda r: r[i]) * mean(lambda r: r[j])
                rho[a, b] += abs(cov(a, b) / (cov(a, a) * cov(b, b)) ** 0.5) / 2
    rho[rho < 0.1] = 0
    np.fill_diagonal(rho, 1)
    assert np.allclose(model.weight, 1 / rho.sum(axis=1))
    for r in range(20):
        odds = math.log(model.prior / (1 - model.prior)) + sum(model.weight[k] * math.log(model.table[k, 1, v[r, k] + 1] / model.table[k, 0, v[r, k] + 1]) for k in range(5))
        assert abs(model.posterior(v[r : r + 1])[0] - 1 / (1 + math.exp(-odds))) < 1e-12


def test_terms_of_long_words():
    long = "q" * 30
    assert toxicity.terms_of(f"{long} x")[f"={long}"] == 1
    assert f"={'q' * 49}" not in toxicity.terms_of("q" * 49) and toxicity.terms_of("q" * 49)["qqqqqqqqqqqq+"] == 1


def test_rows_that_repeat(spark):
    rows, labels = corpus(300)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs(spark, [*rows, *rows[:50]]), table).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert len(got) == 350 and all(len(by[i]) == 2 and by[i][0] == by[i][1] for i, _ in rows[:50])
