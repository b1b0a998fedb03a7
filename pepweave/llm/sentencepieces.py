"""SentencePiece (merge type) encoding by a prefix table, and decoding.

For every prefix of a segment the table stores the one last token of the prefix's encoding. Candidates for a prefix are
the pieces that end there, as an Aho-Corasick automaton lists them; a candidate is right if it is compatible with the
stored last token of the prefix before it, that is, if merging the two tokens' characters gives just these two tokens.
Compatibility of a pair is worked out once, by undoing the merges of both, and remembered. Ids are then recovered from the last prefix
backwards. Characters that no piece covers stand for themselves and become byte pieces.

Texts are cut where no piece reaches across: before a space mark that follows another character, and around line feeds
(both checked against the vocabulary when the model is read). Segments are encoded once per worker and kept in a table
whose bytes are bounded; long segments are not kept.

Defined results: a null, like an empty text, has no ids and decodes to an empty text; decoding gives back any text whose
normal form is itself (the space mark U+2581 in a text becomes a space, as in the library); texts of any length are
encoded whole; rows are independent, so repeated rows have equal results and ids may repeat or be null; an empty table
gives an empty result; nothing is shuffled; further columns stay, but for those that a result column replaces by name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of segments and number of pairs that a worker remembers at most; longer segments (in code points) are not kept.
REMEMBERED, PAIRS, LONG = 112 << 20, 500_000, 64
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def model_path(path: str | None) -> str:
    """The given path, or the installed model."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Segments(dict):
    """Ids by segment, made at first sight; older holds the generation before."""

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.make, self.older, self.size = make, older, 0

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            ids = self.make(segment)
        if len(segment) <= LONG:
            self[segment] = ids
            self.size += 250 + len(ids) + len(segment)  # objects, their places in the table, and their bytes
        return ids


class Pieces:
    """A merge-type model: ids of texts, texts of ids."""

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_path(path), "rb") as f:
            model.ParseFromString(f.read())
        spec, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.escape_whitespaces or not model.trainer_spec.byte_fallback:
            raise ValueError("only models with byte fallback and without normalisation are read")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.surface: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == kinds.NORMAL:
                self.score[p.piece], self.id[p.piece] = p.score, i
                self.surface.append(p.piece.replace(MARK, " ").encode())
            elif p.type == kinds.BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
                self.surface.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type in (kinds.CONTROL, kinds.UNKNOWN):
                self.surface.append(" ⁇ ".encode() if p.type == kinds.UNKNOWN else b"")
            else:
                raise ValueError(f"piece {p.piece!r} is of a kind that isn't read")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id):
            raise ValueError("a piece reaches across a space mark")
        self.decimal = [str(i).encode() for i in range(len(self.surface))]
        self.automaton = ahocorasick.Automaton()
        for p in self.id:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.remembered = remembered
        self.pairs: dict[tuple[str, str], bool] = {}
        self.last_merge: dict[str, tuple[str, str] | None] = {}
        #: Segments begin with a mark where the model adds one, so a word without any can stand for the mark and itself.
        self.known = Segments(self._made, {})
        self.by_line = not any("\n" in p for p in self.id)

    def merged(self, text: str, until: int = 1) -> list[str]:
        """The tokens that merging leaves: best score first, then leftmost; it stops where until tokens are left."""
        tokens, score = list(text), self.score.get
        while len(tokens) > until:
            best, at = max((score(a + b, -np.inf), -k) for k, (a, b) in enumerate(zip(tokens, tokens[1:])))
            if best == -np.inf:
                break
            tokens[-at : 2 - at] = [tokens[-at] + tokens[1 - at]]
        return tokens

    def _halves(self, token: str) -> tuple[str, str] | None:
        """The two tokens that the last merge of a piece joins; none for one character or a piece that merging never gives."""
        if token not in self.last_merge:
            two = self.merged(token, 2) if len(token) > 1 else []
            self.last_merge[token] = (two[0], two[1]) if len(two) == 2 and token in self.score else None
        return self.last_merge[token]

    def _whole(self, token: str) -> bool:
        return len(token) == 1 or self._halves(token) is not None

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Whether merging the characters of both tokens gives just these two.

        The later one of the last merges on either side is undone, again and again. Nothing may ever join what then
        meets at the border: a join goes before a merge undone on the right if its score is as good, on the left if it
        is better.
        """
        if (got := self.pairs.get(pair)) is not None:
            return got
        left, right = pair
        score, got = self.score, self._whole(left) and self._whole(right)
        limit, ties = -np.inf, True
        while got:
            joined = score.get(left + right)
            if joined is not None and (joined > limit or joined == limit and ties):
                got = False
            elif len(left) > 1 and (len(right) == 1 or score[left] < score[right]):
                limit, ties = score[left], False
                left = self._halves(left)[1]
            elif len(right) > 1:
                limit, ties = score[right], True
                right = self._halves(right)[0]
            else:
                break
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[pair] = got
        return got

    def tokens(self, segment: str) -> list[str]:
        """The tokens of a segment, by its prefix table."""
        last: list[str | None] = [None] * (len(segment) + 1)
        pairs = self.pairs.get
        for at, token in self.automaton.iter(segment):
            end = at + 1
            if last[end] is None:
                start = end - len(token)
                if start == 0:
                    if self._whole(token):
                        last[end] = token
                else:
                    before = last[start]
                    if before is None:  # no piece ends there: an uncovered character does
                        before = last[start] = segment[start - 1]
                    ok = pairs((before, token))
                    if ok if ok is not None else self._compatible((before, token)):
                        last[end] = token
        out, end = [], len(segment)
        while end:
            token = last[end] or segment[end - 1]
            out.append(token)
            end -= len(token)
        return out[::-1]

    def _made(self, segment: str) -> bytes:
        """Ids of a segment, or of a word and the mark before it."""
        if self.prefix and segment[:1] != MARK:
            segment = MARK + segment
        if self.by_line and "\n" in segment:
            out = []
            for k, line in enumerate(segment.split("\n")):
                out.append(self.byte[10] if k else None)
                out += self._ids(line)
            return np.array(out[1:], "<u4").tobytes()
        return np.array(self._ids(segment), "<u4").tobytes()

    def _ids(self, segment: str) -> list[int]:
        ids: list[int] = []
        for token in self.tokens(segment):
            i = self.id.get(token)
            if i is not None:
                ids.append(i)
            else:
                ids += [self.byte[b] for b in token.encode()]
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text."""
        if not text:
            return np.zeros(0, "<u4")
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " " or not self.prefix:
            segments = _SEGMENT.findall(self.prefix + text.replace(" ", MARK))
        else:
            segments = text.split(" ")
        ids = np.frombuffer(b"".join(map(self.known.__getitem__, segments)), "<u4")
        if self.known.size > self.remembered // 2:  # what isn't met again goes with the older half
            self.known.older = {}
            self.known = Segments(self._made, self.known)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; broken byte sequences become U+FFFD."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def decimals(self, ids: list[int]) -> bytes:
        """Decimal ids, joined by commas."""
        return b",".join(map(self.decimal.__getitem__, ids))


@lru_cache(maxsize=1)
def pieces(path: str | None = None) -> Pieces:
    """The worker's own model, kept from task to task."""
    return Pieces(path)


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per row: doc_id, ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([own.encode(t).astype(np.int32) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """Per row of doc_id, ids: doc_id, text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """All columns of docs and n_tokens, ids_sha256, decoded_sha256 of each row's ids and of the text they decode to.

    Columns of docs with these names are replaced.
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    base = docs.drop(*added)
    at = base.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            n, coded, decoded = [], [], []
            for value in batch.column(at):
                ids = own.encode(value.as_py()).tolist()
                n.append(len(ids))
                coded.append(hashlib.sha256(own.decimals(ids)).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=[*batch.schema.names, *added])

    from pyspark.sql.types import LongType, StringType, StructType

    schema = StructType([*base.schema.fields]).add("n_tokens", LongType()).add("ids_sha256", StringType()).add("decoded_sha256", StringType())
    return base.mapInArrow(work, schema)
