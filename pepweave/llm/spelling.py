"""Spelling variants: words one edit apart, found by merging the light subtrees of a trie of all words.

In the trie of the words, each node has a heavy child, the one with the most words below it; other children are light. A
word leaves the heavy path at most log2(words) times. Two words one edit apart part ways at one node, and at least one of
them goes to a light child there or ends there. So each light subtree is merged, word by word, with its node's other
subtrees, one character of it

- replaced by the heavy character: meets words of the heavy subtree that differ there;
- replaced by a wildcard: meets words of the other light subtrees that differ there;
- skipped: meets words of the node's tree that lack it (only the last of equal characters is skipped);
- preceded by the heavy character: meets words of the heavy subtree that have one more. A word that ends at the node is
  merged like this, too.

Words at which two copies end are one edit apart, and each pair is met at exactly one node, so counts are sums.

Words are dealt by ranges of their first PREFIX characters, sorted, and a part of the trie is built from its sorted words.
A node inside a part meets all its words there. Nodes that reach over a part's ends (prefixes that the last word of one
part and the first of the next share, below PREFIX characters) are the same in all parts, as their heavy characters are told to all:
the driver sees the first and last words' prefixes and the size of each part. What is merged at them goes to a join on the
word that would result, or on the word with its wildcard, where a group has as many words as there are characters at most.
Which child is taken as heavy decides the amount of work, never the result.

Defined results: a null text has no words, a null doc_id is written as nothing in the checksum; repeated rows count each;
words of any length are compared whole; an empty table gives no word; further columns, whatever their names, are left out.
Words that share their first PREFIX characters are in one part.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pepweave.llm.common import cut

#: Fixed values of the contract: one run in so many is damaged; fewest code points and occurrences; how many times more common a form is.
DAMAGED, LEAST, TWICE, RATIO = 31, 7, 2, 10
#: Words of a part of the trie, and characters that ranges are cut by.
PART, PREFIX = 200_000, 64
#: Distinct words that a worker counts before it hands them on.
HELD = 300_000
#: Beyond every character of a word.
_ABOVE = "Ā"
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: For texts in ASCII: letters in lower case, anything else a space.
_SPACED = bytes(b | 32 if 0x41 <= b & 0xDF <= 0x5A and b < 128 else 32 for b in range(256))
#: Letters of one byte, or U+00C0 to U+00FF, in UTF-8.
_RUN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++")
MERGED = "kind int, key string, word string, n long, near long, other string, other_n long"
_MERGED = pa.schema([("kind", pa.int32()), ("key", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("near", pa.int64()), ("other", pa.string()), ("other_n", pa.int64())])
_FOUND, _LOOKUP, _WILDCARD = range(3)


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters with A-Z in lower case, as UTF-8."""
    raw = text.encode()
    return raw.translate(_SPACED).split() if raw.isascii() else _RUN.findall(raw.translate(_LOWER))


def counted(doc_id: int | None, text: str | None) -> Iterator[tuple[bytes, int]]:
    """(word, times) of a text after damage, of at least LEAST code points."""
    if not text:
        return
    seed = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    for run, n in Counter(w for w in runs(text) if len(w) >= LEAST).items():
        h = zlib.crc32(run, seed)
        if h % DAMAGED == 0:
            word = run.decode()
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) >= LEAST:
                yield word.encode(), n
        elif run.isascii() or len(run.decode()) >= LEAST:
            yield run, n


def words(docs: DataFrame) -> DataFrame:
    """word, n of every word that occurs at least twice."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in counted(doc_id, text.as_py()):
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield told()
                    held = {}
        yield told()

    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= TWICE)


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n, k = min(len(a), len(b)), 0
    while k < n and a[k] == b[k]:
        k += 1
        if k % 64 == 0:  # long words: by doubling
            step = 64
            while a[k : k + step] == b[k : k + step] and k + step <= n:
                k, step = k + step, 2 * step
    return k


def tops(ends: list[tuple[str, str, int]]) -> tuple[dict[str, str], list[tuple[int, int]]]:
    """Of parts in order (first word, last word, size; the words' prefixes): heavy characters of the nodes that reach over ends, and how far the ends of each part are shared."""
    meets = [shared(a[1], b[0]) for a, b in zip(ends, ends[1:])]
    reach = list(zip([-1, *meets], [*meets, -1]))
    weight: dict[str, Counter] = {}
    for (first, last, size), (left, right) in zip(ends, reach):
        for word, far in ((first, left), (last, right)):
            for d in range(far + 1):
                if d < len(word):
                    weight.setdefault(word[:d], Counter())[word[d]] += size
                else:
                    weight.setdefault(word[:d], Counter())
    return {p: min(c, key=lambda x: (-c[x], x)) if c else "" for p, c in weight.items()}, reach


class Part:
    """A sorted run of words, and what the merges at its nodes find."""

    def __init__(self, ws: list[str], ns: list[int]):
        self.ws, self.ns = ws, ns
        self.at = {w: k for k, w in enumerate(ws)}
        self.near = [0] * len(ws)
        self.best: list[tuple[int, str] | None] = [None] * len(ws)
        self.sent: list[tuple] = []

    def meet(self, i: int, j: int) -> None:
        """Two words one edit apart."""
        for a, b in ((i, j), (j, i)):
            self.near[a] += 1
            key = -self.ns[b], self.ws[b]
            if self.best[a] is None or key < self.best[a]:
                self.best[a] = key

    def nodes(self) -> dict[tuple[int, int], list[int]]:
        """(depth, first word): where each child begins, and the end, of every node with several children."""
        found: dict[tuple[int, int], list[int]] = {}
        stack: list[list] = []  # depth, children's begins
        for k in range(1, len(self.ws) + 1):
            depth = shared(self.ws[k - 1], self.ws[k]) if k < len(self.ws) else -1
            begin = k - 1
            while stack and stack[-1][0] > depth:
                d, begins = stack.pop()
                found[d, begins[0]] = [*begins, k]
                begin = begins[0]
            if depth >= 0:
                if stack and stack[-1][0] == depth:
                    stack[-1][1].append(k)
                else:
                    stack.append([depth, [begin, k]])
        return found

    def merge(self, heavy_of: dict[str, str], left: int, right: int) -> None:
        """Merge at every node. heavy_of, left, right: what tops() says of nodes over the ends."""
        ws = self.ws
        nodes = self.nodes()
        over: dict[tuple[int, int], str] = {}
        for word, far in ((ws[0], left), (ws[-1], right)):
            for d in range(far + 1):
                p = word[:d]
                low = bisect_left(ws, p)
                over[d, low] = heavy_of[p]
                if (d, low) not in nodes:  # one child here, others elsewhere
                    nodes[d, low] = [low, bisect_left(ws, p + _ABOVE)]
        for (d, low), begins in nodes.items():
            ends_here = len(ws[low]) == d
            children = list(zip(begins, begins[1:]))[ends_here:]
            prefix = ws[low][:d]
            if (d, low) in over:
                self.send(prefix, d, low if ends_here else None, children, over[d, low])
            else:
                self.join(prefix, d, low if ends_here else None, children)

    def join(self, prefix: str, d: int, own: int | None, children: list[tuple[int, int]]) -> None:
        """Merge at a node whose words are all here."""
        ws, at = self.ws, self.at
        a, b = max(children, key=lambda c: (c[1] - c[0], -c[0]))
        heavy = ws[a][d]
        if own is not None and (j := at.get(prefix + heavy)) is not None:
            self.meet(own, j)
        several, wild = len(children) > 2, {}
        for begin, end in children:
            if begin == a:
                continue
            for k in range(begin, end):
                w = ws[k]
                rest = w[d + 1 :]
                if (j := at.get(prefix + heavy + rest)) is not None:
                    self.meet(k, j)
                if (j := at.get(prefix + heavy + w[d:])) is not None:
                    self.meet(k, j)
                if (not rest or rest[0] != w[d]) and (j := at.get(prefix + rest)) is not None:
                    self.meet(k, j)
                if several:
                    for j in wild.setdefault(rest, []):  # as many as there are characters at most
                        self.meet(k, j)
                    wild[rest].append(k)

    def send(self, prefix: str, d: int, own: int | None, children: list[tuple[int, int]], heavy: str) -> None:
        """The same at a node with words elsewhere: what would be met is asked for."""
        ws, ns, out = self.ws, self.ns, self.sent

        def ask(word: str, k: int) -> None:
            if len(word) >= LEAST:
                out.append((_LOOKUP, word, ws[k], ns[k], None, None, None))

        if own is not None and heavy:
            ask(prefix + heavy, own)
        for begin, end in children:
            if ws[begin][d] == heavy:
                continue
            for k in range(begin, end):
                w = ws[k]
                rest = w[d + 1 :]
                if heavy:
                    ask(prefix + heavy + rest, k)
                    ask(prefix + heavy + w[d:], k)
                if not rest or rest[0] != w[d]:
                    ask(prefix + rest, k)
                out.append((_WILDCARD, prefix + "*" + rest, w, ns[k], None, None, None))

    def rows(self) -> Iterator[tuple]:
        for w, n, near, best in zip(self.ws, self.ns, self.near, self.best):
            if near:
                yield _FOUND, None, w, n, near, best[1], -best[0]
        yield from self.sent


def merged(found: DataFrame, part: int = PART) -> DataFrame:
    """What the parts of the trie found (word: near words and the most common of them), and what they ask for."""
    spark = found.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found.count() // part))
    prefix = F.substring("word", 1, PREFIX)
    dealt = cut(found.repartitionByRange(parts, prefix).select(F.spark_partition_id().alias("part"), "word", "n"), "words-dealt")
    ends = sorted(dealt.groupBy("part").agg(F.min(prefix), F.max(prefix), F.count("*")).collect())
    heavy_of, reach = tops([tuple(r[1:]) for r in ends])
    over = {r[0]: far for r, far in zip(ends, reach)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for k, rows in groupby(stream(), key=lambda r: r[0]):
            _, ws, ns = zip(*rows)
            own = Part(list(ws), list(ns))
            own.merge(heavy_of, *over[k])
            out = []
            for row in own.rows():
                out.append(row)
                if len(out) == 20_000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    rows = dealt.repartition(len(ends) or 1, "part").sortWithinPartitions("part", "word")
    return cut(rows.mapInArrow(work, MERGED), "words-merged")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_MERGED), _MERGED)], schema=_MERGED)


def neighbours(found: DataFrame, part: int = PART) -> DataFrame:
    """word, near (words one edit apart), other, other_n (the most common of them, then the least)."""
    told = merged(found, part)
    local = told.where(F.col("kind") == _FOUND).select("word", "near", "other", "other_n")
    asked = told.where(F.col("kind") == _LOOKUP).select("key", "word", "n")
    hit = asked.join(found.select(F.col("word").alias("key"), F.col("n").alias("key_n")), "key")
    one = F.lit(1).cast("long")
    both = F.array(F.struct("word", one.alias("near"), F.col("key").alias("other"), F.col("key_n").alias("other_n")), F.struct(F.col("key").alias("word"), one.alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    hits = hit.select(F.explode(both).alias("x")).select("x.*")
    # of a wildcard's words, each is near all others; only the two most common are looked at
    group = told.where(F.col("kind") == _WILDCARD).groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word"))).alias("g")).where(F.size("g") > 1)
    wild = group.select("g", F.explode("g").alias("x")).withColumn("y", F.when(F.col("g")[0]["word"] == F.col("x.word"), F.col("g")[1]).otherwise(F.col("g")[0]))
    wild = wild.select("x.word", (F.size("g") - 1).cast("long").alias("near"), F.col("y.word").alias("other"), (-F.col("y.m")).alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("m"), "other"))
    return local.unionByName(hits).unionByName(wild).groupBy("word").agg(F.sum("near").alias("near"), best.alias("b")).select("word", "near", "b.other", (-F.col("b.m")).alias("other_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of words with a form: the form of the form and so on. Each step multiplies the count by RATIO, so a few doublings end every chain."""
    at = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(at.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, part: int = PART) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    found = cut(words(docs), "words")
    near = neighbours(found, part).withColumnRenamed("word", "w")
    has = F.col("other_n") >= RATIO * F.col("n")
    out = found.join(near, F.col("word") == F.col("w"), "left").select("word", F.when(has, F.col("other")).alias("form"), "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("other_n")).alias("form_n"))
    out = cut(out, "forms")
    last = roots(out.where("form is not null")).withColumnRenamed("word", "w")
    return out.join(last, F.col("word") == F.col("w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
