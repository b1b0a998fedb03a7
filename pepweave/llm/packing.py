"""Packing documents into sequences of one size: shortest-pack-first over the histogram of lengths.

tokens(): documents are encoded once and written with, for each, its place among those of equal length in its part.
plan(): lengths are placed longest first, each into the shortest packs that it fits, a whole class of equal packs at once;
a pack class is an interval of sequence numbers, so a placement is a line of a small table: documents of a length, from one
rank to another, go to these sequences at that offset. Then the emptiest packs, as many as the gaps add up to, are taken
apart, and what they hold is cut to fill the gaps of the others; what is left over forms sequences whose sizes are powers
of two. So no sequence is padded, and few documents are cut. The driver sees the histogram alone: at most as many rows as
a sequence has tokens.
pieces(): ranks are counts of earlier parts plus the place within the part; each document meets its line of the table by
length and rank. Only documents of lengths that are cut have their ids read again.

Defined results: a null text is empty and holds the end id alone; documents longer than a sequence fill whole sequences
first; documents of equal length are ranked as they were read, so rows that repeat an id or a text are pieces of their own;
ids may be null; texts of any length are encoded whole; an empty table gives no piece; further columns, whatever their
names, are left out.
"""

from __future__ import annotations

import gc
import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pepweave.llm import words as W
from pepweave.llm.common import cut, text_bytes
from pepweave.llm.token_store import SLICE, Encoder

TOKENIZER, SEQUENCE = "word_bpe_49k.json", 4096
#: Texts of a batch that leaves a worker, at most.
ROWS = 2048
TOKENS = "part int, row long, doc_id long, n long, whole long, rest int, whole_at long, rest_at long, crcs array<long>, ids array<int>"
PIECES = "part int, row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_COLUMNS = pa.schema([(n, pa.int32() if n == "part" else pa.int64()) for n in _NAMES])
#: Kinds of bytes (other, letter, digit, sign, apostrophe), and pairs of kinds that are cut apart.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 3
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[*range(0x30, 0x3A)]] = 2
_KIND[0x27] = 4
_CUT = np.array([[0, 0, 0, 0, 0], [0, 0, 1, 1, 1], [0, 1, 1, 1, 1], [0, 1, 1, 0, 0], [0, 0, 1, 0, 0]], bool)
#: Ranks stay below this.
_RANKS = 1 << 44


class WordEncoder(Encoder):
    """Ids of texts, word by word: the pre-tokenizer drops white space and never reaches over it."""

    def __init__(self, path: str | None = None):
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        super().__init__(path, literals=True)
        ends = [False] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab().items():
            ends[i] = token.endswith("</w>")
        self.ends_word = np.array(ends, bool)

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of words; those of ASCII letters alone, many in one text, as only their last token ends a word."""
        out: dict[bytes, bytes] = {}
        plain = [c for c in chunks if c.isalpha()]
        for k in range(0, len(plain), 4096):
            some = plain[k : k + 4096]
            ids = np.frombuffer(self._library([b" ".join(some).decode()])[0], "<u4")
            at = np.flatnonzero(self.ends_word[ids]) + 1
            if len(at) == len(some):
                raw, ends = ids.tobytes(), at.tolist()
                out.update((c, raw[4 * i : 4 * j]) for c, i, j in zip(some, [0, *ends], ends))
        rest = [c for c in chunks if c not in out]
        out.update(zip(rest, self._library([c.decode() for c in rest])))
        return list(map(out.__getitem__, chunks))

    def _slice(self, raw: np.ndarray, offsets: np.ndarray, end: bool) -> tuple[np.ndarray, np.ndarray]:
        whole, inside = raw.tobytes(), W.NOT_BLANK[raw]
        begins = cuts(raw)
        begins[1:] |= ~inside[:-1]
        begins[offsets[:-1][offsets[:-1] < len(raw)]] = True
        if self.literals is not None:
            for s, e in self.literal_spans(whole, offsets):
                begins[s + 1 : e] = False
                begins[s] = True
                begins[e : e + 1] = True
        begins &= inside
        starts = np.flatnonzero(begins)
        ends = np.flatnonzero(inside & np.append((begins | ~inside)[1:], True)) + 1 if len(raw) else starts
        lower = W.LOWER[raw]  # the library lower-cases, too; a literal has no capitals
        return self._gather(lower.tobytes(), lower, starts, ends, np.searchsorted(starts, offsets), end)


def cuts(raw: np.ndarray) -> np.ndarray:
    """Mask of bytes at which the pre-tokenizer surely begins a piece within a word: around digits, and between letters and signs.

    All in ASCII; a letter after an apostrophe may belong to it.
    """
    kind = _KIND[raw]
    out = np.zeros(len(raw), bool)
    if len(raw):
        out[1:] = _CUT[kind[:-1], kind[1:]]
    return out


@lru_cache(maxsize=1)
def encoder(path: str | None) -> WordEncoder:
    """The worker's own encoder, kept from task to task."""
    return WordEncoder(path)


def tokens(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """Encoded documents, written and read back: see TOKENS.

    whole: full sequences of a document; rest: tokens beyond them; whole_at, rest_at: its place among its part's full
    sequences and among its part's rests of equal length; crcs: of its full sequences and of its rest.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # nothing here makes cycles, and millions of words are slow to visit
        own, part, row, full, seen = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0, [0] * size
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for i, j in W.slices(offsets, SLICE):
                for a in range(i, j, ROWS):
                    some = batch.slice(a, min(ROWS, j - a))
                    flat, ends = own.encode(some.column(1))
                    n = np.diff(ends)
                    whole, rest = n // size, (n % size).astype(np.int32)
                    at = []
                    for r in rest.tolist():
                        at.append(seen[r])
                        seen[r] += 1
                    before = full + np.cumsum(whole) - whole
                    full += int(whole.sum())
                    raw, crcs = memoryview(np.ascontiguousarray(flat, "<u4").view(np.uint8)), []
                    for s, e in zip(ends[:-1].tolist(), ends[1:].tolist()):
                        crcs.append([zlib.crc32(raw[4 * k : 4 * min(k + size, e)]) for k in range(s, e, size)])
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.ascontiguousarray(flat, "<u4").view("<i4")))
                    m = len(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, part, np.int32)), pa.array(np.arange(row, row + m)), some.column(0), pa.array(n), pa.array(whole), pa.array(rest), pa.array(before), pa.array(at, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), ids],
                        names=[c.split()[0] for c in TOKENS.split(", ")],
                    )
                    row += m

    return cut(rows.mapInArrow(work, TOKENS), "packed-tokens")


def place(counts: dict[int, int], size: int, first: int) -> tuple[list[tuple], list[tuple]]:
    """Lengths, longest first, into the shortest packs that they fit.

    Lines (length, from, to, per, offset, sequence): rank r of a length is the ((r - from) mod per)-th of its kind from the
    offset on in sequence + (r - from) div per. Packs (space, sequence, count): equal packs in a row and what is free in each.
    """
    lines, packs, new = [], [], first
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def put(sequence: int, many: int, per: int, space: int) -> None:
            nonlocal left, rank
            lines.append((length, rank, rank + many * per, per, size - space, sequence))
            rank, left = rank + many * per, left - many * per
            heapq.heappush(packs, (-(space - per * length), sequence, many))

        while left and packs and -packs[0][0] >= length:
            space, sequence, many = -packs[0][0], packs[0][1], packs[0][2]
            heapq.heappop(packs)
            below = -packs[0][0] if packs else 0
            per = min(space // length, (space - below) // length + 1, max(1, left // many))
            used = min(many, left // per)
            if used < many:
                heapq.heappush(packs, (-space, sequence + used, many - used))
            put(sequence, used, per, space)
        fits = size // length
        for many, per in ((left // fits, fits), (1, left % fits)):
            if many and per:
                put(new, many, per, size)
                new += many
    return lines, [(-space, sequence, many) for space, sequence, many in packs]


def take_apart(lines: list[tuple], spans: list[tuple[int, int]]) -> tuple[list[tuple], list[tuple]]:
    """Lines less the sequences of some spans, and (length, from, to) of what these held."""
    spans = sorted(spans)
    ends = list(accumulate((b for _, b in spans), max))
    kept, freed = [], []
    for length, low, high, per, offset, sequence in lines:
        last, at = sequence + (high - low) // per, sequence
        rank = lambda s: low + (s - sequence) * per
        k = bisect_left(ends, sequence + 1)
        while k < len(spans) and spans[k][0] < last:
            a, b = max(at, spans[k][0]), min(last, spans[k][1])
            if a > at:
                kept.append((length, rank(at), rank(a), per, offset, at))
            freed.append((length, rank(a), rank(b)))
            at, k = b, k + 1
        if at < last:
            kept.append((length, rank(at), rank(last), per, offset, at))
    return kept, freed


def fill(lines: list[tuple], packs: list[tuple], size: int, new: int) -> tuple[list[tuple], list[tuple]]:
    """Lines of documents that stay whole, and cuts.

    A cut (length, from, to, start, piece, per, offset, sequence): rank r gives per pieces from start on, the j-th to
    sequence + (r - from) * per + j at the offset.
    """
    packs = sorted(packs, reverse=True)
    short = -(-sum(space * many for space, _, many in packs) // size)
    spans, gaps = [], []
    for space, sequence, many in packs:
        gone = min(short, many)
        short -= gone
        if gone:
            spans.append((sequence, sequence + gone))
        if many > gone and space:
            gaps.append((-space, sequence + gone, many - gone, size - space))
    lines, freed = take_apart(lines, spans)
    pool = [(-length, low, high, length, 0) for length, low, high in freed]
    heapq.heapify(pool)
    heapq.heapify(gaps)
    cuts = []
    while gaps and pool:
        gap, sequence, many, offset = heapq.heappop(gaps)
        have, low, high, length, start = heapq.heappop(pool)
        gap, have = -gap, -have
        if have >= gap:
            per = have // gap
            used = min(high - low, many // per)
            if not used:
                per, used = many, 1
            cuts.append((length, low, low + used, start, gap, per, offset, sequence))
            if have > per * gap:
                heapq.heappush(pool, (per * gap - have, low, low + used, length, start + per * gap))
            done = used * per
        else:
            used = done = min(high - low, many)
            cuts.append((length, low, low + used, start, have, 1, offset, sequence))
            heapq.heappush(gaps, (have - gap, sequence, used, offset + have))
        if low + used < high:
            heapq.heappush(pool, (-have, low + used, high, length, start))
        if done < many:
            heapq.heappush(gaps, (-gap, sequence + done, many - done, offset))
    rest = sum(-have * (high - low) for have, low, high, _, _ in pool)  # less than a sequence
    rooms = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    used = 0
    for have, low, high, length, start in sorted(pool):
        for rank in range(low, high):
            at, stop = start, start - have
            while at < stop:
                n = min(stop - at, rooms[0] - used)
                cuts.append((length, rank, rank + 1, at, n, 1, used, new))
                at, used = at + n, used + n
                if used == rooms[0]:
                    rooms.pop(0)
                    new, used = new + 1, 0
    return lines, cuts


def plan(counts: dict[int, int], size: int = SEQUENCE) -> tuple[list[tuple], list[tuple]]:
    """Lines and cuts (see place, fill) for so many rests of each length; counts[size] full sequences come first."""
    first = counts.get(size, 0)
    lines, packs = place({n: c for n, c in counts.items() if n < size and c}, size, first)
    return fill(lines, packs, size, max([first, *(sequence + many for _, sequence, many in packs)]))


def pieces(found: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """The pieces of encoded documents (see tokens, PIECES), packed."""
    full = found.groupBy("part").agg(F.sum("whole").alias("n")).where("n > 0").select("part", F.lit(size).alias("rest"), "n")
    each = found.where("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut(each.unionByName(full).withColumn("base", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "packed-bases")
    lines, cuts = plan({r.rest: r.n for r in bases.groupBy("rest").agg(F.sum("n").alias("n")).collect()}, size)
    keys = ["part", "row", "doc_id", "n", "whole"]

    whole = found.where("whole > 0").select(*keys, "whole_at", F.slice("crcs", F.lit(1), F.col("whole").cast("int")).alias("crcs"))
    whole = whole.join(bases.where(F.col("rest") == size).select("part", "base"), "part").select(*keys, (F.col("base") + F.col("whole_at")).alias("at"), F.posexplode("crcs").alias("k", "crc"))
    k, zero = F.col("k").cast("long"), F.lit(0).cast("long")
    whole = whole.select("part", "row", "doc_id", (k * size).alias("start"), F.lit(size).cast("long").alias("length"), F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), (F.col("at") + k).alias("sequence_id"), zero.alias("offset"))

    rests = found.where("rest > 0").select(*keys, "rest", "rest_at", F.element_at("crcs", -1).alias("crc"))
    rests = rests.join(bases.select("part", "rest", "base"), ["part", "rest"]).select(*keys, "rest", (F.col("base") + F.col("rest_at")).alias("rank"), "crc")
    rests = rests.mapInArrow(_whole_rests(lines, size), PIECES)
    out = whole.unionByName(rests)
    if cuts:
        cut_up = found.where(F.col("rest").isin(sorted({c[0] for c in cuts}))).select(*keys, "rest", "rest_at", F.slice("ids", (F.col("whole") * size + 1).cast("int"), F.col("rest")).alias("ids"))
        cut_up = cut_up.join(bases.select("part", "rest", "base"), ["part", "rest"]).select(*keys, "rest", (F.col("base") + F.col("rest_at")).alias("rank"), "ids")
        out = out.unionByName(cut_up.mapInArrow(_cut_rests(cuts, size), PIECES))
    return out


def _whole_rests(lines: list[tuple], size: int):
    table = np.array(sorted(lines), np.int64).reshape(-1, 6)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, low, high, per, offset, sequence = table.T
        begins = length * _RANKS + low
        for batch in batches:
            part, row, doc, n, whole, rest, rank, crc = batch.columns
            rest, rank = rest.to_numpy().astype(np.int64), rank.to_numpy()
            at = np.searchsorted(begins, rest * _RANKS + rank, "right") - 1
            hit = np.flatnonzero((at >= 0) & (length[at] == rest) & (rank < high[at])) if len(table) else np.zeros(0, np.int64)
            at, rest, rank = at[hit], rest[hit], rank[hit]
            step = rank - low[at]
            kept = [c.take(pa.array(hit)) for c in (part, row, doc)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(whole.to_numpy()[hit] * size), pa.array(rest), crc.take(pa.array(hit)), n.take(pa.array(hit)), pa.array(sequence[at] + step // per[at]), pa.array(offset[at] + step % per[at] * rest)],
                schema=_COLUMNS,
            )

    return work


def _cut_rests(cuts: list[tuple], size: int):
    by_length: dict[int, list[tuple]] = {}
    for c in cuts:
        by_length.setdefault(c[0], []).append(c[1:])
    tables = {length: np.array(rows, np.int64).T for length, rows in by_length.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, row, doc, n, whole, rest, rank, ids in zip(*batch.columns):
                low, high, start, piece, per, offset, sequence = tables[rest.as_py()]
                rank = rank.as_py()
                mine = np.flatnonzero((low <= rank) & (rank < high))
                if not len(mine):
                    continue
                raw = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4").tobytes()
                begin = whole.as_py() * size
                for k in mine.tolist():
                    p = int(piece[k])
                    for j in range(int(per[k])):
                        s = int(start[k]) + j * p
                        out.append((part.as_py(), row.as_py(), doc.as_py(), begin + s, p, zlib.crc32(raw[4 * s : 4 * (s + p)]), n.as_py(), int(sequence[k] + (rank - low[k]) * per[k]) + j, int(offset[k])))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(_COLUMNS), _COLUMNS)], schema=_COLUMNS)

    return work


def assemble(packed: DataFrame, found: DataFrame) -> DataFrame:
    """sequence_id, ids of packed pieces and the encoded documents that they are of; a sequence is what one row holds."""
    rows = packed.join(found.select("part", "row", "ids"), ["part", "row"]).select("sequence_id", "offset", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids"))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece."""
    return pieces(tokens(docs, tokenizer, size), size).drop("part", "row")
