"""Token ids in Parquet: one list column per document, with what selective reads need.

write(): documents are dealt by ranges of doc_id (one shuffle of the texts), encoded part by part, and written as
Parquet: ``ids`` is dictionary-encoded, or delta-encoded where a dictionary grows too large (format version 2); row groups
and pages have set sizes and carry column and offset indexes. ``doc_id`` is sorted, so a lookup reads a few pages.
index(): the number of tokens of each part, read from the narrow columns only, gives every part's first position.
read(): the documents of a store with their global start.

Encoding is that of the tokenizers library. Its pre-tokenizer surely cuts at certain places (see cuts), so a text's ids
are those of its chunks between them in a row; distinct chunks are encoded by the library once per worker and kept in a
bounded table. With literals=True, as the library does by default, an added token that stands in a text (<|endoftext|>) is
that token: it is a chunk of its own, and the text ends before it and begins after it. Without, it is plain text.

Defined results: a null text is empty and holds the end id alone; null doc_ids come first; rows that repeat a doc_id are
ordered by their text (by its first 64 characters, where
they are so many that parts divide them), and rows that repeat both are stored each; texts of any length are encoded whole; an empty table
gives an empty store; further columns, whatever their names, are left out.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pepweave.llm import words as W
from pepweave.llm.common import text_bytes

TOKENIZER, END_ID = "byte_bpe_50k.json", 2
#: Chunks that a worker remembers at most, for as long as it lives, and the bytes of the longest of them.
REMEMBERED, LONG = 500_000, 64
#: More parts than this are joined by a shuffle; fewer are broadcast (40 bytes each).
PARTS_TO_BROADCAST = 1_000_000
#: Writer settings: bytes of a row group and of a page, rows of a page.
ROW_GROUP, PAGE, PAGE_ROWS = 16 << 20, 1 << 18, 1000
#: Bytes of an Arrow batch, either way between Spark and the workers.
BATCH = 8 << 20
SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"

#: Bytes after a space at which a chunk may begin: any but ASCII white space and the lead bytes of other white space.
_CUTS = np.ones(256, bool)
_CUTS[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0xC2, 0xE1, 0xE2, 0xE3]] = False
_LETTER, _SIGN, _SOLID = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_SOLID[0x21:0x7F] = True
#: Text bytes encoded at once.
SLICE = 3 << 20


def tokenizer_path(path: str | None) -> str:
    """The given path, or the installed vocabulary."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """Ids of texts, chunk by chunk.

    A chunk begins where the pre-tokenizer surely cuts (see cuts). Equal chunks of a batch are found in numpy: up to 24
    bytes, three machine words and the length are the chunk.
    """

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED, literals: bool = False):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_path(path))
        self.library.encode_special_tokens = not literals
        self.literals = literal_pattern(self.library) if literals else None
        starts = [0] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab().items():
            starts[i] = token.startswith("\u0120")  # the byte-level alphabet's space
        self.starts_with_space = np.array(starts, bool)
        self.remembered = remembered
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks; those with one space, in front, many in one text, as only their first token begins with a space."""
        out: dict[bytes, bytes] = {}
        plain = [c for c in chunks if c[:1] == b" " and c.count(b" ") == 1]
        for k in range(0, len(plain), 4096):
            some = plain[k : k + 4096]
            ids = np.frombuffer(self._library([b"".join(some).decode()])[0], "<u4")
            at = np.flatnonzero(self.starts_with_space[ids])
            if len(at) == len(some):
                raw, ends = ids.tobytes(), [*at[1:].tolist(), len(ids)]
                out.update((c, raw[4 * i : 4 * j]) for c, i, j in zip(some, at.tolist(), ends))
        rest = [c for c in chunks if c not in out]
        out.update(zip(rest, self._library([c.decode() for c in rest])))
        return list(map(out.__getitem__, chunks))

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of distinct chunks, remembered or new."""
        known, older = self.known, self.older
        out = list(map(known.get, chunks))
        new = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            ids = older.get(chunks[k])
            if ids is None:
                new.append(k)
            else:
                known[chunks[k]] = out[k] = ids
        for k, ids in zip(new, self._learn([chunks[k] for k in new])):
            out[k] = ids
            if len(chunks[k]) <= LONG:
                known[chunks[k]] = ids
        if len(known) > self.remembered // 2:  # what isn't met again goes with the older half
            self.older, self.known = known, {}
        return out

    def encode(self, column: pa.Array, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column in a row, and the n + 1 offsets of its texts."""
        raw, offsets = text_bytes(column)
        parts = [self._slice(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], end) for i, j in W.slices(offsets, SLICE)]
        if not parts:
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])

    def literal_spans(self, whole: bytes, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Start and end of each added token that stands in a text, from left to right."""
        out, at = [], 0
        while m := self.literals.search(whole, at):
            s, e = m.span()
            row_end = int(offsets[np.searchsorted(offsets, s, "right")])
            if e > row_end:  # over the end of its text: a shorter one may still fit
                m = self.literals.search(whole, s, row_end)
                s, e = m.span() if m else (row_end, row_end)
            if e > s:
                out.append((s, e))
            at = e
        return out

    def _slice(self, raw: np.ndarray, offsets: np.ndarray, end: bool) -> tuple[np.ndarray, np.ndarray]:
        begins = cuts(raw)
        begins[offsets[1:-1][offsets[1:-1] > 0] - 1] &= raw[offsets[1:-1][offsets[1:-1] > 0] - 1] != 0x20  # a space that ends its text
        whole = raw.tobytes()
        if self.literals is not None:
            apart(begins, raw, self.literal_spans(whole, offsets))
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        first = np.searchsorted(starts, offsets)
        ends = np.append(starts[1:], len(raw)) if len(starts) else starts
        return self._gather(whole, raw, starts, ends, first, end)

    def _gather(self, whole: bytes, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, end: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunks in a row and how many each text has; first: the first chunk of each text, and one more."""
        n_rows = len(first) - 1
        group, sample = _groups(raw, starts, ends)
        found = self._ids([whole[i:j] for i, j in zip(starts[sample].tolist(), ends[sample].tolist())])
        lens = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found) + np.array([END_ID], "<u4").tobytes(), "<u4")
        at = np.concatenate([[0], np.cumsum(lens)])
        lens = np.append(lens, 1)
        if end:
            group = np.insert(group, first[1:], len(found))
            first = first + np.arange(n_rows + 1)
        n = lens[group]
        stop = np.cumsum(n)
        # a slice's tokens are far below 2**31
        ids = flat[np.repeat((at[group] - (stop - n)).astype(np.int32), n) + np.arange(int(stop[-1]) if len(stop) else 0, dtype=np.int32)]
        sums = np.concatenate([[0], stop])
        return ids, np.diff(sums[first])


def literal_pattern(library) -> re.Pattern | None:
    """Matches the added tokens, the longest at each place; those that take white space or look around aren't handled."""
    added = library.get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word for t in added):
        raise ValueError("added tokens with lstrip, rstrip or single_word are not supported")
    found = sorted((t.content.encode() for t in added), key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, found))) if found else None


def apart(begins: np.ndarray, raw: np.ndarray, spans: list[tuple[int, int]]) -> None:
    """Make each span a chunk of its own, with an end of text before it: a space there belongs to what came before."""
    for s, e in spans:
        begins[s + 1 : e] = False
        if s and raw[s - 1] == 0x20:
            begins[s - 1] = False
        begins[s] = True
        begins[e : e + 1] = True


def cuts(raw: np.ndarray) -> np.ndarray:
    """Mask of bytes at which the pre-tokenizer surely begins a piece, whatever came before the byte before.

    A space before what is no white space; a sign (no apostrophe) after a letter; a line end after what is no white space,
    and a letter after such a line end. Each chunk between cuts is pre-tokenized alone as it is in the text: only runs of
    white space look ahead, and they are cut only in front, or are one line end.
    """
    out = np.zeros(len(raw), bool)
    if len(raw) < 2:
        return out
    letter = _LETTER[raw]
    ends = letter.copy()  # a letter of one byte, or of two after 0xC3
    ends[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    out[:-1] = (raw[:-1] == 0x20) & _CUTS[raw[1:]]
    out[1:] |= _SIGN[raw[1:]] & ends[:-1]
    line = (raw[1:] == 0x0A) & (ends[:-1] | _SOLID[raw[:-1]])
    out[1:] |= line
    out[2:] |= line[:-1] & (letter[2:] | (raw[2:] == 0xC3))
    return out


def _groups(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each chunk the number of its group of equal chunks, and for each group one of its chunks."""
    if not len(starts):
        return starts, starts
    lens = ends - starts
    room = np.concatenate([np.zeros(32, np.uint8), raw, np.zeros(32, np.uint8)])
    words = np.ndarray((len(room) - 7,), "<u8", room.data, strides=(1,))
    low = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    keep = lambda k: low[np.clip(lens - k, 0, 8)]
    key = [words[starts + 32] & keep(0), words[starts + 40] & keep(8), words[starts + 48] & keep(16)]
    mixed = W.mix(key[0])
    for k in key[1:]:
        mixed = W.mix(mixed ^ k)
    mixed ^= lens.astype(np.uint64)
    long = np.flatnonzero(lens > 24)
    mixed[long] = np.uint64(2**64 - 1)
    order = np.argsort(mixed)
    new = np.ones(len(order), bool)
    same = lens[order[1:]] == lens[order[:-1]]
    for k in key:
        same &= k[order[1:]] == k[order[:-1]]
    new[1:] = ~(same & (lens[order[1:]] <= 24))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, order[new]


@lru_cache(maxsize=1)
def encoder(path: str | None, literals: bool) -> Encoder:
    """The worker's own encoder, kept from task to task."""
    return Encoder(path, literals=literals)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, compression: str = "snappy", literals: bool = False) -> None:
    """Encode docs and write the store. literals: added tokens in texts are tokens, as the library has it. Ids are bit-packed already; zstd makes files smaller for more CPU time."""
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # an id may be that of many rows: these are dealt by how their texts begin and, if that is equal, by where they were read
    dealt = dealt.withColumns({"begin": F.substring("text", 1, 64), "read": F.monotonically_increasing_id()})
    dealt = dealt.repartitionByRange("doc_id", "begin", "read").sortWithinPartitions("doc_id", "begin", "text", "read").select("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes cycles, and millions of strings are slow to visit
        own, part, at = encoder(tokenizer, literals), TaskContext.get().partitionId(), 0
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                flat, ends = own.encode(batch.column(1))
                n = np.diff(ends)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view("<i4")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(n), part), pa.int32()), pa.array(at + ends[:-1]), pa.array(n), ids], names=["doc_id", "part", "local_start", "n_tokens", "ids"]
                )
                at += int(ends[-1])

    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(key)
    conf.set(key, str(BATCH))  # for this write alone
    try:
        (
            dealt.mapInArrow(work, SCHEMA)
            .write.option("compression", compression)
            .option("parquet.writer.version", "PARQUET_2_0")
            .option("parquet.enable.dictionary", "true")
            .option("parquet.block.size", str(ROW_GROUP))
            .option("parquet.page.size", str(PAGE))
            .option("parquet.page.row.count.limit", str(PAGE_ROWS))
            .parquet(path)
        )
    finally:
        conf.set(key, before)


def part_bases(spark: SparkSession, path: str) -> list[tuple]:
    """(part, base, first_id, last_id, n_docs, n_tokens) in order; base counts the tokens before the part.

    Reads only the narrow columns. There is one part for each tens of MB of text: the prefix sum is taken on the driver.
    """
    parts = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.min("doc_id"), F.max("doc_id"), F.count("*"), F.sum("n_tokens"))
    rows, base = [], 0
    for part, first, last, n_docs, n_tokens in sorted(parts.collect(), key=lambda r: r[0]):
        rows.append((part, base, first, last, n_docs, n_tokens))
        base += n_tokens
    return rows


def index(spark: SparkSession, path: str) -> DataFrame:
    """The parts of a store as a table."""
    return spark.createDataFrame(part_bases(spark, path), "part int, base long, first_id long, last_id long, n_docs long, n_tokens long")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and, if asked for, ids."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    found = part_bases(spark, path)
    bases = spark.createDataFrame([r[:2] for r in found], "part int, base long")
    if len(found) <= PARTS_TO_BROADCAST:
        bases = F.broadcast(bases)
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", *["ids"] * ids)


def checksums(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what read() gives."""
    import zlib

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8)
            at = ids.offsets.to_numpy().astype(np.int64) * 4
            crc = [zlib.crc32(values[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.select("doc_id", "start", "n_tokens", "ids").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")
