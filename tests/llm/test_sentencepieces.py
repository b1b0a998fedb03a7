import hashlib

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from helpers import by_id, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from pepweave.llm import sentencepieces

TEXTS = [
    None, "", " ", "  ", "   a", "a  b   c ", "\n", " \n x", "\na", "▁a ▁ ▁▁b", "naïve 日本語 🎉🎉 x", "\x00 \x01", "<s> </s> <unk> <0x41>", "x" * 3000, "the " * 20_000, "𝕏y 'tis it's", "a\t\tb",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def own():
    return sentencepieces.Pieces(remembered=5000)


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(library, own, text):
    ids = library.encode(text or "")
    assert own.encode(text).tolist() == ids
    assert own.decode(ids) == library.decode(ids)


@given(st.text(alphabet="abtheinorgs ▁\n.,é日🎉0\x00", max_size=60))
@settings(max_examples=600, deadline=None)
def test_random_texts(library, own, text):
    ids = library.encode(text)
    assert own.encode(text).tolist() == ids
    assert own.decode(ids) == library.decode(ids)


def test_real_texts(library, own):
    for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist():
        ids = library.encode(t or "")
        assert own.encode(t).tolist() == ids and own.decode(ids) == library.decode(ids)


def test_what_is_remembered_is_bounded(library):
    own = sentencepieces.Pieces(remembered=200_000)
    for k in range(300):
        text = " ".join(f"w{k}x{j}" for j in range(40)) + " " + "\u65e5\u672c" * 500 + "\n" + "z" * k
        assert own.encode(text).tolist() == library.encode(text)
        assert own.known.size <= 200_000 and max(map(len, own.known), default=0) <= sentencepieces.LONG
    assert len(own.known) + len(own.known.older) < 2000


def test_rows_that_repeat(spark, library):
    rows = [(1, "a b"), (1, "a b"), (None, "a b")]
    got = sentencepieces.round_trip(docs(spark, rows)).collect()
    assert len(got) == 3 and {r.n_tokens for r in got} == {len(library.encode("a b"))}


def test_frames(spark, library):
    rows = list(enumerate(TEXTS))
    df = docs(spark, rows, n_tokens="clash", ids="clash")
    got = by_id(sentencepieces.round_trip(df))
    coded = by_id(sentencepieces.encode(df))
    back = by_id(sentencepieces.decode(sentencepieces.encode(df)))
    for i, t in rows:
        ids = library.encode(t or "")
        assert coded[i].ids == ids and back[i].text == library.decode(ids)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert sentencepieces.round_trip(docs(spark, [])).count() == 0
