import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs

from pepweave.llm import substring_dedup
from pepweave.llm import words as W
from pepweave.llm.common import text_bytes


def brute(rows, n=35):
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[k : k + n]) for w in split for k in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = {p for k in range(len(w) - n + 1) if seen[tuple(w[k : k + n])] > 1 for p in range(k, k + n)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def rows_of(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "é", "the", "日", "Q" * 90]) + str(rng.randint(0, 40))
    shared = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 200)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts += [word() for _ in range(rng.randint(0, 80))] + rng.choice(shared)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    return [*rows, (50, None), (51, ""), (52, "z " * 34), (53, "z " * 36), (54, "ab " * 40_000), (55, "p q r " * 30), (56, rows[3][1]), (57, rows[3][1])]


@pytest.mark.parametrize("width", [6, 20])
def test_matches_brute_force(spark, width):
    rows = rows_of(width)
    got = substring_dedup.removals(docs(spark, rows, k1=1, starts="clash"), width=width).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_awkward_tables(spark):
    assert substring_dedup.removals(docs(spark, []), width=10).count() == 0
    text = " ".join(f"w{k}" for k in range(40))
    got = substring_dedup.removals(docs(spark, [(None, text), (1, text), (1, text), (2, text[:90])]), width=10).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 40), ("1", 40), ("2", 0), ("None", 40)]


def test_words_of_one_weak_hash_stay_apart(spark):
    # both words agree in every polynomial of their bytes modulo 2**64 with one common multiplier
    one, other = "fbeaabaacaaabgdaababaaaaaa", "aaacbabdaaacaaafcabaaaaaaa"
    rest = [f"w{k}" for k in range(40)]
    got = substring_dedup.removals(docs(spark, [(k, " ".join([*rest[:20], w, *rest[20:]])) for k, w in enumerate((one, other))]), width=10).collect()
    assert [(r.n_words, r.n_removed) for r in got] == [(41, 0)] * 2


@pytest.mark.parametrize("identity", [7, None])
def test_many_copies_of_one_row(spark, identity):
    text = " ".join(f"w{k}" for k in range(100))
    n = 30_000
    df = spark.range(0, n, 1, 16).selectExpr(f"cast({'null' if identity is None else identity} as long) as doc_id", f"'{text}' as text")
    began = time.time()
    got = substring_dedup.removals(df, width=16)
    assert [(r.n_words, r.n_removed, r["count"]) for r in got.groupBy("n_words", "n_removed").count().collect()] == [(100, 100, n)]
    assert time.time() - began < 60


def test_seeds_and_lengths():
    rng = random.Random(3)
    words = list({"".join(rng.choice("ab\u00e9\u65e5") for _ in range(rng.randint(1, 60))) for _ in range(5000)})
    raw, offsets = text_bytes(pa.array([" ".join(words)]))
    starts, ends, _ = W.bounds(raw, offsets, W.NOT_BLANK)
    a, b = W.hashes(raw, starts, ends), W.hashes(raw, starts, ends, seed=1)
    assert len(set(a.tolist())) == len(set(b.tolist())) == len(words) and not (a == b).any()
    alone = [W.hashes(*W_one(w))[0] for w in words[:50]]
    assert alone == a[:50].tolist()


def W_one(word):
    raw, offsets = text_bytes(pa.array([word]))
    starts, ends, _ = W.bounds(raw, offsets, W.NOT_BLANK)
    return raw, starts, ends


def test_grams_and_sliding_min():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 200).astype(np.uint64)
    for k in (1, 2, 3, 7, 8, 13, 35):
        want = []
        for i in range(200 - k + 1):
            h = 0
            for v in x[i : i + k].tolist():
                h = (h * 0xD6E8FEB86659FD93 + v) % 2**64
            want.append(h)
        assert (W.grams(x, k) == W.mix(np.array(want, np.uint64))).all()
        assert (W.sliding_min(x, k) == [x[i : i + k].min() for i in range(200 - k + 1)]).all()
