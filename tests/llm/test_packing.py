import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import docs

from pepweave.llm import packing

AWKWARD = ["", " ", "don't  I'LL x's", "a <|endoftext|> b<|startoftext|>c", "café ÉCOLE é ́x", "İ ΑΣ ß ﬁ", "日本語 １２３", "a b c\x1cd\x85e", "x" * 5000, "'s 't ''re", "12 3a4 !!?.", "\U0001f600 ok"]


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def ids_of(texts):
    return [[*e.ids, 2] for e in library().encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_the_library():
    import pyarrow as pa

    rng = random.Random(1)
    texts = AWKWARD + ["".join(rng.choice(["a", "B", "é", " ", "\n", "'", "s", "1", ".", "́", "<|endoftext|>", "ß", "日", " ", "the"]) for _ in range(rng.randrange(40))) for _ in range(3000)]
    flat, ends = packing.WordEncoder().encode(pa.array(texts))
    for t, want, a, b in zip(texts, ids_of(texts), ends, ends[1:]):
        assert flat[a:b].tolist() == want, t


def check(rows, texts, size):
    """Every id in one piece, sequences without gaps or overlaps, no padding."""
    ids = ids_of(texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for d, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[d])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[d][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[d])
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding == 0
    return by_sequence


@pytest.mark.parametrize("size", [16, 64, 4096])
def test_packs_every_id_once_without_padding(spark, size):
    rng = random.Random(size)
    texts = [None, "", *AWKWARD, *[" ".join(["word"] * rng.choice([3, 3, 3, 7, 20, 100, 500])) for _ in range(300)]]
    check(packing.pack(docs(spark, list(enumerate(texts))).repartition(5), size=size).collect(), texts, size)


def test_few_documents_are_cut(spark):
    texts = [" ".join(["word"] * (1 + k % 60)) for k in range(400)]
    by_sequence = check(packing.pack(docs(spark, list(enumerate(texts))), size=64).collect(), texts, 64)
    assert sum(map(len, by_sequence.values())) < 1.1 * len(texts)


def test_any_histogram():
    rng = random.Random(5)
    for _ in range(400):
        size = rng.choice([8, 16, 32, 128])
        counts = {rng.randrange(1, size): rng.choice([1, 2, 5, 1000]) for _ in range(rng.randrange(0, 9))} | rng.choice([{}, {size: 3}])
        lines, cuts = packing.plan(counts, size)
        got, held = defaultdict(list), defaultdict(list)
        for k in range(counts.get(size, 0)):
            held[k].append((0, size))
        for length, low, high, per, offset, sequence in lines:
            for r in range(low, high):
                got[length, r].append((0, length))
                held[sequence + (r - low) // per].append((offset + (r - low) % per * length, length))
        for length, low, high, start, piece, per, offset, sequence in cuts:
            for r in range(low, high):
                for j in range(per):
                    got[length, r].append((start + j * piece, piece))
                    held[sequence + (r - low) * per + j].append((offset, piece))
        assert set(got) == {(n, r) for n, c in counts.items() if n < size for r in range(c)}
        for (length, _), own in got.items():
            assert sum(n for _, n in own) == length and all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) and min(own)[0] == 0
        for own in held.values():
            own.sort()
            total = sum(n for _, n in own)
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and (total == size or total & (total - 1) == 0)


def test_shortest_pack_first():
    lines, _ = packing.place({7: 1, 6: 1, 3: 2, 2: 1}, 10, 0)
    assert lines == [(7, 0, 1, 1, 0, 0), (6, 0, 1, 1, 0, 1), (3, 0, 1, 1, 6, 1), (3, 1, 2, 1, 7, 0), (2, 0, 1, 1, 0, 2)]


def test_sequences_hold_the_ids(spark):
    texts = [" ".join(["word", "other"] * (k % 50)) for k in range(60)]
    found = packing.tokens(docs(spark, list(enumerate(texts))), size=64)
    packed = packing.pieces(found, 64)
    held = {r.sequence_id: list(r.ids) for r in packing.assemble(packed, found).collect()}
    ids = ids_of(texts)
    for r in packed.collect():
        assert held[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]


def test_empty_repeated_and_null_rows(spark):
    assert packing.pack(docs(spark, [])).collect() == []
    rows = packing.pack(docs(spark, [(None, "a b"), (1, "a b"), (1, "a b"), (1, None)], part=7, row="x", whole=1, ids="y")).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in {(r.doc_id, r.doc_tokens, r.sequence_id, r.offset): r for r in rows}.values() if r.start == 0) == [(0, 3), (1, 1), (1, 3), (1, 3)]
    assert sum(r.length for r in rows) == 10
