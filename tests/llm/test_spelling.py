import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import docs

from pepweave.llm import spelling as S


def brute_words(rows):
    """word: n, as the contract says."""
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(found):
    near = {w: [v for v in found if one_edit(w, v)] for w in found}
    form = {}
    for w, vs in near.items():
        v = min(vs, key=lambda v: (-found[v], v), default=None)
        form[w] = v if v is not None and found[v] >= 10 * found[w] else None
    out = {}
    for w, n in found.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, n, len(near[w]), found[form[w]] if form[w] else None)
    return out


def vocabulary(rng, letters, n, longest):
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(7, longest)))
        words.add(w)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(w))
            words.add(rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :], w + w[-1], w[:1] + w]))
    return sorted(w for w in words if len(w) >= 7)


@pytest.mark.parametrize("letters,part", [("ab", 5), ("ab", 10_000), ("abc\u00e9\u00ff", 40), ("a", 3)])
def test_neighbours_against_all_pairs(spark, letters, part):
    rng = random.Random(part)
    ws = vocabulary(rng, letters, 12 if letters == "a" else 400, 40 if letters == "a" else 12)
    found = {w: rng.choice([2, 3, 3, 40, 500]) for w in ws}
    df = spark.createDataFrame(list(found.items()), "word string, n long")
    got = {r.word: (r.near, r.other, r.other_n) for r in S.neighbours(df, part).collect()}
    for w in found:
        vs = [v for v in found if one_edit(w, v)]
        best = min(vs, key=lambda v: (-found[v], v), default=None)
        assert got.get(w) == ((len(vs), best, found[best]) if vs else None), w


def test_variants_against_brute_force(spark):
    rng = random.Random(11)
    ws = vocabulary(rng, "aeln\u00e9", 120, 10)
    weights = [rng.choice([1, 1, 4, 60, 900]) for _ in ws]
    rows = [(rng.choice([None, *range(50)]), rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(ws, weights, k=60))) for _ in range(300)]
    rows += [(1, None), (2, ""), (3, "\u00d7\u00f7\u00c9\u00c9\u00c9\u00c9\u00c9\u00c9 \u0100letters \u0100letters"), (3, "\u00d7\u00f7\u00c9\u00c9\u00c9\u00c9\u00c9\u00c9")]
    want = brute(brute_words(rows))
    assert any(len({w, f, r}) == 3 for w, f, r, *_ in want.values() if f)
    for part in (20, S.PART):
        got = {r.word: tuple(r) for r in S.variants(docs(spark, rows, word="x", n=1, root="y", part=1), part).collect()}
        assert got == want


def test_long_words_and_long_prefixes(spark):
    base = "x" * 100_000
    ws = [base, base + "y", base[:50_000] + "z" + base[50_000:], base[:-1] + "w", "q" * 70 + "abcdefg", "q" * 70 + "abcdefh", "q" * 70 + "abcdeg", "r" * 64, "r" * 65, "r" * 63 + "s"]
    found = {w: 2 + k for k, w in enumerate(ws)}
    got = {r.word: r.near for r in S.neighbours(spark.createDataFrame(list(found.items()), "word string, n long"), 2).collect()}
    want = defaultdict(int)
    for a, b in [(0, 1), (0, 2), (0, 3), (1, 3), (4, 5), (4, 6), (5, 6), (7, 8), (7, 9), (8, 9)]:
        want[ws[a]] += 1
        want[ws[b]] += 1
    assert not one_edit("abcdefh", "abcdeg") and one_edit("r" * 65, "r" * 64)
    for a, b in [(1, 3), (5, 6), (8, 9)]:
        if not one_edit(ws[a], ws[b]):
            want[ws[a]] -= 1
            want[ws[b]] -= 1
    assert got == {w: n for w, n in want.items() if n}


def test_chains_of_forms(spark):
    ws = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "abcdefghijkl"]
    forms = spark.createDataFrame(list(zip(ws, ws[1:])), "word string, form string")
    assert {r.word: r.root for r in S.roots(forms).collect()} == dict.fromkeys(ws[:-1], ws[-1])


def test_empty(spark):
    assert S.variants(docs(spark, [])).collect() == []
    assert S.variants(docs(spark, [(1, "single1 words2")])).collect() == []


def test_light_edges_are_few():
    rng = random.Random(2)
    ws = vocabulary(rng, "abcdefghij", 5000, 12)
    part = S.Part(ws, [2] * len(ws))
    asked = 0
    part.at = type("Counting", (dict,), {"get": lambda self, k: None})(part.at)
    for (d, low), begins in part.nodes().items():
        sizes = [b - a for a, b in zip(begins, begins[1:])]
        asked += sum(sizes) - max(sizes)
    assert asked <= len(ws) * len(ws).bit_length()
