import hashlib
import random
import re
import time

import pyarrow as pa
import pytest
from helpers import by_id, docs

from pepweave.llm import catalog, decontaminate
from pepweave.llm import words as W
from pepweave.llm.common import portions, text_bytes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items):
    windows = {}
    for i, t in items:
        w = low(t)
        for k in range(max(len(w) - 12, 1) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = {}
    for d, t in rows:
        w, hit, names = low(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    names |= got
        out[d] = len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)
    return out


def case(seed=1, n=60):
    rng = random.Random(seed)
    vocab = ["ab", "Cd", "é", "x9", "ÀB", "the", "of", "q" * 80, "日本"]
    text = lambda k: rng.choice(["", "  ", "-"]).join([""]) + " ".join(rng.choice(vocab) + rng.choice(["", ",", ".-"]) for _ in range(k))
    items = [(i, text(rng.choice([0, 1, 3, 12, 13, 14, 40]))) for i in range(25)] + [(30, None), (31, ""), (2, "the of the of zz"), (None, "zz zz zz")]
    rows = []
    for d in range(n):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            parts.append((items[rng.randrange(25)][1] or "").upper().replace("É", "é"))
            parts.append(text(rng.randint(0, 30)))
        rows.append((d, " ".join(parts)))
    return [*rows, (100, None), (101, ""), (102, "zz zz zz"), (103, "zz " * 50_000)], items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_matches_brute_force(spark, block_bytes):
    rows, items = case()
    got = by_id(catalog.contamination(decontaminate.verdicts(docs(spark, rows, items="clash", row=3), bench(spark, items), block_bytes)))
    assert {d: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for d, r in got.items()} == brute(rows, items)


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_decontaminate_keeps_columns(spark, block_bytes):
    rows, items = case(2)
    df = docs(spark, rows, bad_id=1)
    out = decontaminate.decontaminate(df, bench(spark, items), block_bytes)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, x in brute(rows, items).items() if not x[-1])


def test_repeated_rows_stay_rows(spark):
    rows, items = case(3, 5)
    twice = docs(spark, [*rows, rows[2], (None, rows[2][1])])
    for block_bytes in (1 << 20, 400):
        got = decontaminate.verdicts(twice, bench(spark, items), block_bytes).collect()
        assert len(got) == len(rows) + 2
        assert len({(r.n_words, r.n_hit) for r in got if r.doc_id in (2, None)}) == 1


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_repeated_items_and_short_items_that_occur_often(spark, block_bytes):
    rows = [(1, "the cat " * 400_000), (2, "no such words"), (3, None), (4, "The"), (None, "a the")]
    items = [(k, "the") for k in range(30)] + [(7, "the"), (40, "cat the cat"), (41, None)]
    got = decontaminate.verdicts(docs(spark, rows), bench(spark, items), block_bytes)
    began = time.time()
    by = by_id(catalog.contamination(got))
    assert {d: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for d, r in by.items()} == brute(rows, items)
    assert block_bytes == 1 or time.time() - began < 10


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_empty_tables(spark, block_bytes):
    got = decontaminate.verdicts(docs(spark, [(1, "a b")]), bench(spark, []), block_bytes).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]
    assert decontaminate.verdicts(docs(spark, []), bench(spark, [(1, "a")]), block_bytes).count() == 0


def test_word_hashes():
    texts = ["a bb\tccc", "", None, "bb é", "z" * 10_000_000 + " bb", "é"]
    raw, offsets = text_bytes(pa.array(texts))
    s, e, first = W.bounds(raw, offsets, W.NOT_BLANK)
    h = W.hashes(raw, s, e)
    assert first.tolist() == [0, 3, 3, 3, 5, 7, 8]
    assert h[1] == h[3] == h[6] and h[4] == h[7] and len(set(h.tolist())) == 5


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_portions_hold_every_row_in_turn(size):
    texts = [None, "", "é" * 5, "abc", "", "x" * 40, None, "yy"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    got = list(portions(iter([batch.slice(3), batch.slice(0, 3), batch.slice(0, 0)]), 1, size))
    assert [r for b in got for r in b.column(0).to_pylist()] == [3, 4, 5, 6, 7, 0, 1, 2]
    assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column(1).to_pylist()) <= size for b in got)
