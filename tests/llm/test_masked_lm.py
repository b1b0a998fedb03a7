import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import by_id, docs

from pepweave.llm import catalog
from pepweave.llm import masked_lm as M
from pepweave.llm import words as W
from pepweave.llm.common import text_bytes

SMALL = M.Shape(groups=4, members=4, side=2, embed=3, hidden=5)


def one_hash(word):
    raw, offsets = text_bytes(pa.array([word]))
    starts, ends, _ = W.bounds(raw, offsets, W.NOT_BLANK)
    return int(W.hashes(raw, starts, ends, lower=True)[0])


def brute(model, text):
    """Word by word, in plain loops and double precision."""
    s = model.shape
    emb, w1, b1, wg, bg, wm, bm = [np.asarray(p, float) for p in s.split(model.flat)]
    known = model.known.tolist()
    classes = []
    for w in re.findall("[^\x20\x09-\x0d]+", text or ""):
        h = one_hash(w)
        classes.append(known.index(h) + 1 + model.buckets if h in known else 1 + h % model.buckets)
    total = 0.0
    for i, c in enumerate(classes):
        x = []
        for d in [*range(-s.side, 0), *range(1, s.side + 1)]:
            x += emb[classes[i + d] if 0 <= i + d < len(classes) else 0].tolist()
        h = [math.tanh(sum(a * w1[k][j] for k, a in enumerate(x)) + b1[j]) for j in range(s.hidden)]
        g, m = divmod(c, s.members)
        lg = [sum(a * wg[k][j] for k, a in enumerate(h)) + bg[j] for j in range(s.groups)]
        lm = [sum(a * wm[g][k][j] for k, a in enumerate(h)) + bm[g][j] for j in range(s.members)]
        total += lg[g] - math.log(sum(map(math.exp, lg))) + lm[m] - math.log(sum(map(math.exp, lm)))
    return len(classes), total


def corpus(n=200, seed=1):
    rng = random.Random(seed)
    cycle = ["one", "two", "three", "four", "five", "six", "seven"]
    rows = []
    for i in range(n):
        at = rng.randrange(7)
        rows.append((i, " ".join(cycle[(at + k) % 7] if rng.random() < 0.95 else f"r{rng.randint(0, 999)}" for k in range(rng.randint(1, 60)))))
    return rows


def test_scores_equal_brute_force_and_training_helps(spark):
    rows = [*corpus(), (900, None), (901, " \n"), (902, "One TWO\tthree " * 30_000), (903, "é")]
    df = docs(spark, rows, score="clash", n_words="clash")
    model = M.train(df, SMALL, buckets=4, rounds=2, stride=2, batch=256)
    words = Counter(w.lower() for _, t in rows for w in (t or "").split())
    top = {w for w, _ in words.most_common(7)}
    assert {one_hash(w) for w in top} <= set(model.known.tolist())
    got = by_id(M.score(df, model))
    for i, t in rows:
        if i != 902:
            n, s = brute(model, t)
            assert got[i].n_words == n and abs(got[i].score - s) < 1e-3 * max(1, n) and (got[i]["mean"] is None) == (n == 0)
    assert got[902].n_words == 90_000
    fresh = M.Model(SMALL, 4, model.known, SMALL.start())
    held_out = pa.array([t for _, t in corpus(50, seed=2)])
    before, after = (m.scores(held_out)[1].sum() for m in (fresh, model))
    classes = np.concatenate([c for _, c, _ in M.texts_as_classes(held_out, model.known, 4)])
    share = np.bincount(classes) / len(classes)
    unigram = sum(math.log(share[c]) for c in classes)
    assert after > before and after > unigram


def test_gradient():
    rng = np.random.default_rng(0)
    flat = SMALL.start().astype(float)
    around, target = rng.integers(0, 16, (9, 4)), rng.integers(0, 16, 9)
    _, grad = M.forward(SMALL, flat, around, target, backward=True)
    for k in rng.integers(0, SMALL.size, 60):
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        slope = -(M.forward(SMALL, up, around, target).mean() - M.forward(SMALL, down, around, target).mean()) / 2e-5
        assert abs(slope - grad[k]) < 1e-6


def test_empty(spark):
    df = docs(spark, [])
    model = M.train(df, SMALL, buckets=4, rounds=1)
    assert M.score(df, model).count() == 0
    df = docs(spark, [(1, None), (1, None)])
    assert [(r.n_words, r.score) for r in M.score(df, M.train(df, SMALL, buckets=4, rounds=1)).collect()] == [(0, 0.0)] * 2


def test_words_below_their_buckets_equal_brute_force(spark):
    rows = [*corpus(40), (900, None), (901, " \n"), (902, "r1 R1 r2 " * 500), (None, "r1 q"), (904, "r1 q")]
    df = docs(spark, rows)
    counts = M.word_counts(df)
    model = M.train(df, SMALL, buckets=4, rounds=1, counts=counts)
    met = Counter(one_hash(w) for _, t in rows for w in re.findall("[^\x20\x09-\x0d]+", t or ""))
    known = set(model.known.tolist())
    sizes = Counter()
    for h, n in met.items():
        sizes[h % 4] += n * (h not in known)
    for hot in (0, 20, M.HOT):
        got = M.score_words(df, model, counts, hot=hot).collect()
        assert len(got) == len(rows)
        by = {r.doc_id: r for r in got}
        for i, t in rows:
            n, s = brute(model, t)
            rare = [h for h in map(one_hash, re.findall("[^\x20\x09-\x0d]+", t or "")) if h not in known]
            s += sum(math.log(met[h] / sizes[h % 4]) for h in rare)
            assert by[i].n_words == n and abs(by[i].score - s) < 1e-3 * max(1, n)
            assert (by[i]["mean"] is None) == (n == 0)


def test_query_tells_words_of_one_bucket_apart(spark, tmp_path):
    often, other = next((f"a{k}", "b") for k in range(10_000) if one_hash(f"a{k}") % M.BUCKETS == one_hash("b") % M.BUCKETS)
    rows = [(k, " ".join(f"w{k}_{j}" for j in range(100)) + " ") for k in range(10)]
    rows = [(i, t * 5) for i, t in rows] + [(20, f"w0_0 {often} w1_1"), (21, f"w0_0 {other} w1_1"), (22, f"{often} {often} {often}")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(catalog.op9_masked_lm(spark, str(tmp_path)))
    assert abs(got[20].score - got[21].score - math.log(4)) < 1e-4


def test_training_takes_every_place_once():
    texts = pa.array(["a", "a b c", None, " ".join(f"w{k}" for k in range(40))])
    ((_, _, first),) = M.texts_as_classes(texts, np.zeros(0, np.uint64), 4)
    taken = [k for turn in range(M.ROUNDS) for k in M.targets(first, M.STRIDE, turn).tolist()]
    assert sorted(taken) == list(range(44))
