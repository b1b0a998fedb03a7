"""Secret scans by assignment-aware lexing.

Base patterns (kinds assign, access, hex) are found exactly as stated in BASE. Beyond them the lexer reads source and
configuration syntax around every ``=``, ``:``, ``:=`` and ``=>`` into pairs of a name and an expression (quoted or bare
literals, names, and sums of these; type annotations are skipped). Pairs are taken in the order of the text: a name stands
for the literals that it was last given, or, if it is used before, that it is first given later. Each literal that reaches
a target is scored by how sensitive the target's name is and how much the literal looks like a key; literals over
THRESHOLD that no base span covers are reported as kind ``named``.

Operands are read once: the chain of a sum that begins at an operand is one value, whichever names it belongs to, and
names in its further operands stand for what they were when it was first read. Values point to the values that they are
made of, and carry counts of their characters; a value's score goes down to all literals below it at the end. So time is
in proportion to the text, and neither sums nor literals have a longest size.

Defined results: null and empty texts have no spans; offsets are code points, ends exclusive; equal spans of a kind are
reported once; texts of any length are read whole; rows are independent, so repeated rows have equal results and ids may
repeat or be null; an empty table gives an empty result; nothing is shuffled; further columns, whatever their names, are
left out of the result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "named")
#: Fixed patterns of the base kinds. Matches that are too short are dropped after they were consumed.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
#: A text without any of these, lower-cased, has no assign match.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Parts of names, and how surely such a name holds a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "pass": 0.8, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "auth": 0.7, "authorization": 0.8, "bearer": 0.9, "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "signingkey": 0.9, "encryptionkey": 0.9, "connectionstring": 0.9, "dsn": 0.7, "webhook": 0.6,
}
#: Words before "key" that make it a secret.
KEY_PREFIXES = {"api", "access", "private", "secret", "signing", "encryption", "master", "service", "account", "storage"}
#: Names that end so hold something about a secret, not the secret.
HARMLESS_ENDS = {"id", "name", "type", "count", "length", "size", "url", "uri", "path", "file", "field", "policy", "expiry", "ttl", "hint", "limit"}
PLACEHOLDER = re.compile(r"^(?:change_?me|example.*|your.*|my_?.*|xxx+.*|none|null|true|false|todo|test|dummy|placeholder|redacted|\*+|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|\$[A-Za-z_]\w*)$", re.I)
THRESHOLD = 0.5
#: Code points between places of a run of text at which character counts are kept; characters of a value's ends that are kept.
STEP, ENDS = 512, 64
#: Type names; behind a colon and before ``=`` they are no names of their own.
TYPES = {"str", "string", "bytes", "bytearray", "char", "text", "any", "object", "auto", "var", "optional", "final", "const", "int", "float", "bool", "number"}

_PAIR = re.compile(r"""(?<![A-Za-z0-9_.\-])([A-Za-z0-9_.\-]++)(["']?+)\]?+[ \t]*+(?:=>|:=|=(?!=)|(:(?![:/=])))""")
_HEAD = re.compile(r"[^A-Za-z_]*+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.\-]*+")
_TYPE = r"[&*]?+([A-Za-z_][A-Za-z0-9_.]*+)(?:\[[^\[\]\n=]*+\])?+"
_ANNOTATION = re.compile(rf"[ \t]*+{_TYPE}(?:[ \t]*+\|[ \t]*+{_TYPE})*+\??+[ \t]*+=(?![=>])")
_QUOTED = re.compile(r"""(?:[rRbBuUfFL]{1,2}|u8)?+(?:"([^"\\\n]*+(?:\\.[^"\\\n]*+)*+)"|'([^'\\\n]*+(?:\\.[^'\\\n]*+)*+)'|`([^`\n]*+)`)""")
#: Up to white space, a quote, a sum's sign or the next field of a query string.
_BARE = re.compile(r"""(?:[^\s"'`+&]|\+(?![ \t"'`])|&(?!\w++=))++""")
_BLANKS = re.compile(r"[ \t]*+")
#: What blanks, quoted literals and a sum's sign may begin with.
_GAPS, _OPENERS, _BEFORE_PLUS = frozenset(" \t"), frozenset("\"'`rRbBuUfFL"), frozenset(" \t+")
_PLUS = re.compile(r"[ \t]*+\+(?![+=])")
_CALL = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*+[(\[]")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Every sensitive name holds one of these, lower-cased.
_STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "string", "dsn", "webhook")


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base kinds; low is the text in lower case."""
    out = []
    for k, kind in enumerate(KINDS[:3]):
        pattern, group, least = BASE[kind]
        if kind == "assign" and not any(w in low for w in KEYWORDS) or kind == "access" and "AKIA" not in text:
            continue
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return out


def name_score(name: str) -> float:
    """How surely a name's value is a secret, 0 to 1."""
    parts = [w.lower() for w in _WORDS.findall(name)]
    if not parts or parts[-1] in HARMLESS_ENDS:
        return 0.0
    best = max([SENSITIVE.get(p, 0.0) for p in parts])
    for a, b in zip(parts, parts[1:]):
        best = max(best, SENSITIVE.get(a + b, 0.0), 0.9 if b == "key" and a in KEY_PREFIXES else 0.0)
    return best


#: Characters are counted in 192 classes: ASCII as it is, all white space beyond it as a space, others by their last bits.
_CLASSES = 192
_SPACES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32]
_WIDE_SPACES = np.array([c for c in range(128, 0x3001) if chr(c).isspace()])
#: Lower-case letters, capitals, digits, all else.
_KINDS = [np.isin(np.arange(_CLASSES), [*map(ord, own)]) for own in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")]
_KINDS.append(~np.any(_KINDS, axis=0))


def classes_of(text: str) -> np.ndarray:
    """The class of each character."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(np.isin(code, _WIDE_SPACES), 32, np.where(code > 127, 128 + (code & 63), code)).astype(np.uint8)


def counts_scores(counts: np.ndarray, ends: list[str]) -> list[float]:
    """How much values look like secrets, 0 to 1: length, entropy, kinds of characters. A row of counts and the first and last characters of each."""
    n = counts.sum(axis=1)
    share = counts / np.maximum(n, 1)[:, None]
    entropy = -(share * np.log2(share, out=np.zeros_like(share), where=share > 0)).sum(axis=1)
    kinds = sum((counts[:, own] > 0).any(axis=1) for own in _KINDS)
    out = np.minimum(1, entropy / 3.5) * np.minimum(1, 0.55 + 0.15 * kinds) * np.minimum(1, 0.7 + n / 50)
    out[(kinds < 2) & (n < 20)] = 0.2
    out[(n < 8) | (counts[:, _SPACES] > 0).any(axis=1)] = 0
    for k in np.flatnonzero(out).tolist():
        if PLACEHOLDER.match(ends[k]):
            # a long name behind $ may be none in its middle
            plain = ends[k][0] != "$" or ends[k][1] == "{" or all(c == 36 or c == 95 or chr(c).isalnum() for c in np.flatnonzero(counts[k]).tolist())
            out[k] *= not plain
    return out.tolist()


class Values:
    """What names of one text stand for: literals (a span of the text), and sums of earlier values."""

    def __init__(self, text: str):
        self.text, self.classes = text, classes_of(text)
        self.spans: list[tuple[int, int] | None] = []
        self.below: list[tuple[int, ...]] = []
        self.known: dict[int, tuple[np.ndarray, str, str]] = {}
        self.literals: dict[tuple[int, int], int] = {}
        #: Most sensitive name that a value reaches.
        self.asked: dict[int, tuple[float, str]] = {}
        #: By the end of a long literal: places STEP apart back from it, and the counts from there on.
        self.tails: dict[int, tuple[int, list[np.ndarray]]] = {}

    def literal(self, start: int, end: int) -> int:
        if (start, end) not in self.literals:
            self.literals[start, end] = self._new((start, end), ())
        return self.literals[start, end]

    def sum(self, parts: list[int]) -> int | None:
        """The value of parts in a row; None if there are none."""
        parts = list(dict.fromkeys(parts))
        return None if not parts else parts[0] if len(parts) == 1 else self._new(None, tuple(parts))

    def _new(self, span: tuple[int, int] | None, below: tuple[int, ...]) -> int:
        self.spans.append(span)
        self.below.append(below)
        return len(self.spans) - 1

    def _counts(self, spans: list[tuple[int, int]]) -> np.ndarray:
        """Counts of the classes in literals, a row each. Literals with one end, as in a=b=c, share what is counted back from it."""
        pieces, more = [], []
        for row, (start, end) in enumerate(spans):
            if end - start > STEP:
                at, kept = self.tails.setdefault(end, (end, [np.zeros(_CLASSES, np.int64)]))
                while at - STEP >= start:
                    at -= STEP
                    kept.append(kept[-1] + np.bincount(self.classes[at : at + STEP], minlength=_CLASSES))
                self.tails[end] = at, kept
                k = (end - start) // STEP
                more.append((row, kept[k]))
                end -= k * STEP
            pieces.append(self.classes[start:end])
        at = np.repeat(np.arange(len(spans)) * _CLASSES, [len(p) for p in pieces]) + np.concatenate(pieces)
        out = np.bincount(at, minlength=len(spans) * _CLASSES).reshape(-1, _CLASSES)
        for row, kept in more:
            out[row] += kept
        return out

    def _ends(self, start: int, end: int) -> tuple[str, str]:
        return self.text[start : min(end, start + ENDS)], self.text[max(start, end - ENDS) : end]

    def facts(self, value: int) -> tuple[np.ndarray, str, str]:
        """Counts, first and last characters of a sum."""
        todo = [value]
        while todo:
            v = todo[-1]
            if v in self.known:
                todo.pop()
            elif missing := [b for b in self.below[v] if self.spans[b] is None and b not in self.known]:
                todo += missing
            else:
                todo.pop()
                counts, first, last = np.zeros(_CLASSES), "", ""
                for b in self.below[v]:
                    c, f, x = self.known[b] if self.spans[b] is None else (self._counts([self.spans[b]])[0], *self._ends(*self.spans[b]))
                    first = first if len(first) >= ENDS else (first + f)[:ENDS]
                    counts, last = counts + c, (last + x)[-ENDS:]
                if counts.sum() > 1 << 22:  # shares are what counts, and names may double without end
                    counts = counts / 2
                self.known[v] = counts.astype(np.float32), first, last
        return self.known[value]

    def judge(self, name: str, sensitive: float, value: int | None) -> None:
        """A value reaches a sensitive name."""
        if value is not None and sensitive > self.asked.get(value, (0.0, ""))[0]:
            self.asked[value] = sensitive, name

    def found(self) -> list[tuple[int, int, str, float]]:
        """(start, end, name, score) of all literals below values that look like keys."""
        marks: dict[int, tuple[float, str]] = {}
        asked = list(self.asked)
        for k in range(0, len(asked), 512):
            some = asked[k : k + 512]
            literals = [v for v in some if self.spans[v] is not None]
            facts = [self.facts(v) for v in some if self.spans[v] is None]
            counts = [self._counts([self.spans[v] for v in literals])] if literals else []
            ends = [(a, b, e - s) for v in literals for s, e in [self.spans[v]] for a, b in [self._ends(s, e)]] + [(f, x, int(c.sum())) for c, f, x in facts]
            if facts:
                counts.append(np.array([c for c, _, _ in facts]))
            looks = counts_scores(np.concatenate(counts), [a if n <= ENDS else a + b[-min(ENDS, n - ENDS) :] for a, b, n in ends])
            for v, look in zip([*literals, *(v for v in some if self.spans[v] is None)], looks):
                sensitive, name = self.asked[v]
                if sensitive * look >= THRESHOLD:
                    marks[v] = sensitive * look, name
        out = []
        for v in range(max(marks, default=-1), -1, -1):  # what a value is made of comes before it
            if (mark := marks.get(v)) is None:
                continue
            if (span := self.spans[v]) is not None and span[1] > span[0]:
                out.append((*span, mark[1], mark[0]))
            for b in self.below[v]:
                if mark[0] > marks.get(b, (0.0, ""))[0]:
                    marks[b] = mark
        return out


class Operands:
    """The operands of a text's expressions, each read once."""

    def __init__(self, text: str):
        self.text = text
        self.begin, self.stop, self.solid, self.calls = 0, 0, 0, False  # the last bare run: every place in it has its end
        self.read: dict[int, tuple[str, int, int, int] | None] = {}

    def at(self, place: int) -> tuple[str, int, int, int] | None:
        """kind ("literal", "bare" or "code"), start, end, and where the sum's next operand begins (-1: none) of the operand there."""
        text = self.text
        if text[place : place + 1] in _GAPS:
            place = _BLANKS.match(text, place).end()
        if place in self.read:
            return self.read[place]
        if text[place : place + 1] in _OPENERS and (quoted := _QUOTED.match(text, place)):
            kind, (start, end), after = "literal", quoted.span(quoted.lastindex), quoted.end()
        else:
            if not self.begin <= place < self.stop:
                if not (bare := _BARE.match(text, place)):
                    self.read[place] = None
                    return None
                self.begin, self.stop = bare.span()
                self.solid = self.begin + len(bare[0].rstrip(",;:)]}"))
                self.calls = "(" in bare[0] or "[" in bare[0]
            start, end, after = place, max(place, self.solid), self.stop
            kind = "code" if self.calls and _CALL.match(text, place, end) else "bare"
        plus = _PLUS.match(text, after) if text[after : after + 1] in _BEFORE_PLUS else None
        self.read[place] = kind, start, end, plus.end() if plus else -1
        return self.read[place]


def pairs(text: str) -> Iterator[tuple[str, int]]:
    """(name, where its expression begins) of each assignment in order."""
    skip = -1
    for m in _PAIR.finditer(text):
        name = m[1][_HEAD.match(m[1]).end() :]
        quote = m[2]
        if not name or m.start() == skip or (quote and (m.start() == 0 or text[m.start() - 1] != quote)):
            continue
        at = m.end()
        if m[3] and (typed := _ANNOTATION.match(text, at)):
            at = typed.end()
            if typed[1].rpartition(".")[2].lower() in TYPES:
                skip = typed.start(1)
        yield name, at


def named_spans(text: str, low: str) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of literals that reach sensitive names; low is the text in lower case."""
    if "=" not in text and ":" not in text or not any(s in low for s in _STEMS):
        return []
    values, operands = Values(text), Operands(text)
    now: dict[str, int | None] = {}
    first: dict[str, int | None] = {}
    later: list[tuple[str, float, str]] = []
    #: Values of sums by where they begin.
    rests: dict[int, int | None] = {}

    def word_of(operand: tuple[str, int, int, int]) -> str | None:
        kind, start, end, _ = operand
        return m[0] if kind == "bare" and (m := _NAME.match(text, start, end)) and m.end() == end else None

    def value_of(operand: tuple[str, int, int, int]) -> int | None:
        """Of an operand in a sum: unknown names and code give nothing."""
        word = word_of(operand)
        return now[word] if word in now else values.literal(*operand[1:3]) if operand[0] == "literal" else None

    def rest_of(place: int) -> int | None:
        """The value of a sum's operands from a place on."""
        chain = []
        while place >= 0 and place not in rests and (operand := operands.at(place)):
            chain.append((place, operand))
            place = operand[3]
        value = rests.get(place)
        for at, operand in reversed(chain):
            own = value_of(operand)
            value = rests[at] = values.sum([v for v in (own, value) if v is not None])
        return value

    scores: dict[str, float] = {}
    for name, place in pairs(text):
        if (sensitive := scores.get(name)) is None:
            sensitive = scores[name] = name_score(name)
        if operand := operands.at(place):
            word = word_of(operand)
            value = now.get(word)
            if operand[3] < 0 and word in now:
                pass
            elif operand[3] < 0 and operand[0] == "bare":  # alone, it is a literal, or a name that is given later
                value = values.literal(*operand[1:3])
                if word is not None and sensitive > 0:
                    later.append((name, sensitive, word))
            else:
                value = values.sum([v for v in (value_of(operand), rest_of(operand[3])) if v is not None])
            if sensitive > 0:
                values.judge(name, sensitive, value)
            now[name] = value
            first.setdefault(name, value)
    for name, sensitive, word in later:
        values.judge(name, sensitive, first.get(word))
    return values.found()


def find(text: str | None) -> list[dict]:
    """All spans by start, then kind as listed: kind, start, end, name (of the target), score."""
    if not text:
        return []
    low = text.lower()
    base = base_spans(text, low)
    spans = [{"kind": KINDS[k], "start": a, "end": b, "name": None, "score": 1.0} for a, k, b in base]
    base.sort()
    starts, reach = [a for a, _, _ in base], list(accumulate([b for _, _, b in base], max))
    for a, b, name, score in named_spans(text, low):
        before = bisect_left(starts, b)  # base spans that begin before b
        if not before or reach[before - 1] <= a:
            spans.append({"kind": "named", "start": a, "end": b, "name": name, "score": score})
    return sorted(spans, key=lambda x: (x["start"], KINDS.index(x["kind"]), x["end"]))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, spans (array of kind, start, end, name, score)."""
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([find(t) for t in batch.column(1).to_pylist()], spans)], names=["doc_id", "spans"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(work, "doc_id long, spans array<struct<kind:string,start:long,end:long,name:string,score:double>>")
