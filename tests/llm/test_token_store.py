import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pepweave.llm import catalog, token_store
from pepweave.llm.common import scratch

ROWS = [
    (5, "The cat  sat\n on the mat. "), (1, None), (9, ""), (3, " lead"), (4, "it's 'quoted' 　wide \x1c odd\t  x"), (2, "naïve 日本語 🎉🎉 <|endoftext|> end"), (8, "x" * 5000 + " y" * 20_000), (7, "  "), (6, "a\n \n b"),
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_round_trip(spark, library):
    path = scratch(spark, "store")
    token_store.write(docs(spark, ROWS, part=1, ids="clash"), path)
    stored = token_store.read(spark, path)
    got = {r.doc_id: r for r in stored.collect()}
    sums = {r.doc_id: r for r in token_store.checksums(stored).collect()}
    start = 0
    for i, text in sorted(ROWS):
        want = ids_of(library, text)
        assert got[i].ids == want and got[i].start == start and got[i].n_tokens == len(want)
        assert sums[i].ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    assert set(token_store.read(spark, path, ids=False).columns) == {"doc_id", "start", "n_tokens"}


def test_files_have_indexes_and_encodings(spark):
    import glob

    import pyarrow.parquet as pq

    path = scratch(spark, "store")
    token_store.write(docs(spark, ROWS), path)
    for f in glob.glob(path.removeprefix("file://") + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        if meta.num_rows:
            for c in range(meta.num_columns):
                column = meta.row_group(0).column(c)
                assert column.has_offset_index and column.has_column_index
                if column.path_in_schema.startswith("ids"):
                    assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(column.encodings)


def test_empty_repeated_and_null_ids(spark):
    path = scratch(spark, "store")
    token_store.write(docs(spark, []), path)
    assert token_store.checksums(token_store.read(spark, path)).count() == 0
    path = scratch(spark, "store")
    token_store.write(docs(spark, [(1, "b"), (None, "q"), (1, "a a")]), path)
    assert sorted((str(r.doc_id), r.start, r.n_tokens) for r in token_store.read(spark, path).collect()) == [("1", 2, 3), ("1", 5, 2), ("None", 0, 2)]


@given(st.lists(st.text(alphabet="abé×' \n\t　 \x1c\x85é日1.!", max_size=30), max_size=8))
@settings(max_examples=150, deadline=None)
def test_chunks_equal_the_library(library, texts):
    encoder = token_store.Encoder(remembered=5)
    for _ in range(2):
        ids, at = encoder.encode(pa.array(texts, pa.string()))
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == [ids_of(library, t) for t in texts]


def test_real_texts_equal_the_library(library):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text")
    ids, at = token_store.Encoder().encode(texts)
    for text, i, j in zip(texts.to_pylist(), at[:-1], at[1:]):
        assert ids[i:j].tolist() == ids_of(library, text)


@pytest.fixture(scope="module")
def plain_library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


END = "<|endoftext|>"
ENCODER = token_store.Encoder(remembered=5, literals=True)
LITERALS = [
    f"a {END} b", END, f" {END}", f"{END} ", f"{END}{END}", f"{END} {END}  {END}\n{END}", f"x  {END}  y", f"x\n{END}\nabc", f"x\n {END}\n\n z", f"<{END}>", f"it{END}'s", "<|endof", "text|>", "a <|endof text|>", f"<|endof{END}", " ", f"{END}b", "",
]


def test_added_tokens_in_texts_equal_the_library(plain_library):
    assert ids_of(plain_library, f"a {END} b") == [64, 220, 50256, 275, 2]
    encoder = token_store.Encoder(literals=True)
    ids, at = encoder.encode(pa.array(LITERALS))
    for text, i, j in zip(LITERALS, at[:-1], at[1:]):
        assert ids[i:j].tolist() == ids_of(plain_library, text), text


@given(st.lists(st.lists(st.sampled_from([END, "<|endof", "text|>", " ", "  ", "\n", "a", "é", "'s", "|>", "<", "1", "\t", "\u3000"]), max_size=9).map("".join), max_size=6))
@settings(max_examples=300, deadline=None)
def test_chunks_about_added_tokens_equal_the_library(plain_library, texts):
    ids, at = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == [ids_of(plain_library, t) for t in texts]


def test_query_takes_added_tokens_as_the_library_does(spark, plain_library, tmp_path):
    rows = list(enumerate(LITERALS))
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for got, (i, text) in zip(sorted(catalog.op2_token_store(spark, str(tmp_path)).collect()), rows, strict=True):
        want = ids_of(plain_library, text)
        assert tuple(got) == (i, start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)


def test_long_chunks_are_not_remembered():
    own = token_store.Encoder()
    library = own.library
    text = "\u65e5\u672c\u8a9e" * 20_000 + " " + "x" * 500
    ids, _ = own.encode(pa.array([text]), end=False)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, own.known), default=0) <= token_store.LONG


def test_write_leaves_the_session_as_it_was(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    token_store.write(docs(spark, [(1, "a"), (1, "a"), (None, None)], ids="clash", part="clash"), f"{tmp_path}/store")
    assert spark.conf.get(key) == before
    assert token_store.read(spark, f"{tmp_path}/store").count() == 3
