"""Repair of conversations: cheapest edits that give turns of user and assistant in pairs, by A* on the edit lattice.

Rows of a conversation are read in order of turn (nulls first), then role and text. A row is blank, a duplicate (role and
text seen earlier) or truncated (its last character that is no white space ends no sentence), whichever comes first. Keep
costs nothing, Rerole to user or assistant 2, Delete 3 (blank rows and duplicates must go), Insert of an empty user or
assistant turn 2; a truncated row that stays costs 1 more. Role initials of the result are ``(s?(ua)+)?``. Of the cheapest
edits, those whose initials are least in ASCII order are taken.

search(): a state is the number of rows read and what the result ends with (nothing, s, u or a). What must still be paid
is never less than the deletions that the rest demands and a charge of 1 for each truncated row, so the frontier is taken
in order of (cost plus that, edits), and the first goal has the least cost and, of those, the least edits.

Conversations are dealt by conv_id and each is searched whole, but for those of over LONG rows or LONG_CHARS characters: a
conversation may hold any share of all rows. These are dealt by ranges of their order, duplicates are found by grouping,
blocks of BLOCK rows are searched from each state to each state, and the blocks' answers are joined up in order. Only two
streams run through such a conversation in one task: its blocks' answers, and its repaired lines, as SHA-256 takes them in
order; one block and one line are held at a time, beside the edits, which are part of the result.

Defined results: a null role or text is one space, so a null text is blank; a null conv_id is a conversation of its own;
rows that share a turn are ordered by role, then text; roles other than s..., u... and a... can't be kept as they are;
texts of any length are read whole; an empty table gives no conversation; further columns, whatever their names, are left
out.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pepweave.llm.common import cut

#: Conversations beyond these are searched in blocks of so many rows.
LONG, LONG_CHARS, BLOCK = 1000, 16 << 20, 500
#: More long conversations than this are joined by a shuffle; fewer are broadcast.
LONG_TO_BROADCAST = 1_000_000
#: Costs of edits, and white space.
REROLE, DELETE, INSERT, TRUNCATED, BLANKS = 2, 3, 2, 1, " \t\n\x0b\x0c\r"
GOOD, CUT_OFF, BLANK, DUPLICATE = range(4)
#: What the result ends with (0 nothing, 1 s, 2 u, 3 a), and what may follow.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_TURN = ("user", "user", "assistant", "user")
_GOALS = (0, 3)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in RESULT.split(", ")]
_COLUMNS = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in _NAMES])


def search(rows: list[tuple[str, int]], entry: int = 0, goals: tuple[int, ...] = _GOALS, every: bool = False) -> dict[int, tuple[int, str]]:
    """state: (cost, edits) of the first goal reached from the entry state, or of every goal. rows: role initial and fault."""
    n = len(rows)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        fault = rows[i][1]
        ahead[i] = ahead[i + 1] + (DELETE if fault >= BLANK else TRUNCATED if fault == CUT_OFF else 0)
    frontier, done, found = [(ahead[0], "", 0, entry)], set(), {}
    while frontier:
        rank, audit, i, state = heapq.heappop(frontier)
        if (i, state) in done:
            continue
        done.add((i, state))
        cost = rank - ahead[i]
        if i == n and state in goals:
            found[state] = cost, audit
            if not every or len(found) == len(goals):
                break
        moves = [(INSERT, "I", i, 3 if state == 2 else 2)]
        if i < n:
            initial, fault = rows[i]
            moves.append((DELETE, "D", i + 1, state))
            if fault < BLANK:
                charge = TRUNCATED if fault == CUT_OFF else 0
                moves.append((REROLE + charge, "R", i + 1, 3 if state == 2 else 2))
                if initial in _NEXT[state]:
                    moves.append((charge, "K", i + 1, _NEXT[state][initial]))
        for price, letter, j, then in moves:
            if (j, then) not in done:
                heapq.heappush(frontier, (cost + price + ahead[j], audit + letter, j, then))
    return found


def edited(rows: list[tuple[str, ...]], audit: str, state: int = 0) -> Iterator[tuple[int, str | None]]:
    """(row, role) of each edit in order: the role of its turn, or None for a deleted row; an insert has the number of the next row."""
    i = 0
    for letter in audit:
        if letter == "D":
            yield i, None
        else:
            role = rows[i][0] if letter == "K" else _TURN[state]
            state = _NEXT[state][role[:1]]
            yield i, role
        i += letter != "I"


def faults(rows: list[tuple[str, str, str]]) -> list[tuple[str, int]]:
    """Role initial and fault of each (role, text, last character that is no white space)."""
    seen, out = set(), []
    for role, text, last in rows:
        again = (role, text) in seen
        seen.add((role, text))
        out.append((role[:1], BLANK if not last else DUPLICATE if again else CUT_OFF if last not in ".!?" else GOOD))
    return out


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0 to 2) of each row after damage chosen by the checksum of conv_id:turn."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return _damaged(rows, F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20)


def plain(rows: DataFrame) -> DataFrame:
    """The same without damage."""
    return _damaged(rows, F.lit(19))


def _damaged(rows: DataFrame, kind: Column) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repair(rows: DataFrame, long: int = LONG, long_chars: int = LONG_CHARS, block: int = BLOCK) -> DataFrame:
    """One row for each conversation (see RESULT) of rows with copies (see damage, plain)."""
    size = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    heavy = cut(size.where((F.col("n") > long) | (F.col("chars") > long_chars)).select(F.col("conv_id").alias("heavy")), "long-conversations")
    many = heavy.count()
    if not many:
        return short(rows)
    if many <= LONG_TO_BROADCAST:
        heavy = F.broadcast(heavy)
    same = F.col("conv_id").eqNullSafe(F.col("heavy"))
    return short(rows.join(heavy, same, "left_anti")).unionByName(in_blocks(rows.join(heavy, same, "left_semi"), block))


def _last(text: str = "text") -> Column:
    return F.substring(F.rtrim(F.col(text), F.lit(BLANKS)), -1, 1)


def short(rows: DataFrame) -> DataFrame:
    """Conversations that a task searches whole, one after the other."""
    dealt = rows.withColumn("last", _last()).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def one(conv: int | None, found: list[tuple]) -> tuple:
        kept = [r for r in found for _ in range(r[4])]
        turns = [r[0] for r in kept if r[0] is not None]
        marks = faults([r[1:4] for r in kept])
        (cost, audit), *_ = search(marks).values()
        lines = [f"{role}:{kept[i][2] if letter != 'I' else ''}" for letter, (i, role) in zip(audit, edited([r[1:2] for r in kept], audit)) if role is not None]
        count = [sum(f == k for _, f in marks) for k in (BLANK, DUPLICATE, CUT_OFF)]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        return conv, gaps, *count, illegal([x for x, _ in marks]), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, found in groupby(stream(batches), key=lambda r: r[0]):
            out.append(one(conv, [r[1:] for r in found]))
            if len(out) == 1000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return dealt.select("conv_id", "turn", "role", "text", "last", "copies").mapInArrow(work, RESULT)


def _batch(rows: list[tuple], schema: pa.Schema = _COLUMNS) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def in_blocks(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Conversations of any length, in blocks of rows that different tasks search."""
    order = ["conv_id", "turn", "role", "text"]
    whole = cut(rows.withColumn("last", _last()).withColumn("salt", F.monotonically_increasing_id()), "long-rows")
    copies = whole.select("*", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy"))
    dealt = copies.repartitionByRange(*order, "salt").sortWithinPartitions(*order, "salt").drop("copies", "copy", "salt")
    placed = cut(dealt.withColumn("row", F.monotonically_increasing_id()), "long-order")  # row ascends with the order

    text = (F.xxhash64("text"), F.xxhash64(F.lit(7), "text", F.lit(11)))
    fresh = placed.select("conv_id", "role", text[0].alias("h1"), text[1].alias("h2"), "row").groupBy("conv_id", "role", "h1", "h2").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("fresh"))
    fault = F.when(F.col("last") == "", BLANK).when(F.col("fresh").isNull(), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), CUT_OFF).otherwise(GOOD)
    marks = placed.select("conv_id", "row", "role", "last").join(fresh, "row", "left")
    marks = marks.select("conv_id", "row", F.expr(f"row div {block}").alias("block"), F.struct("row", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")).alias("m"))
    blocks = cut(marks.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("m")).alias("rows")), "long-marks")
    told = cut(blocks.mapInArrow(_search_blocks, f"conv_id long, block long, {_TOLD}"), "long-blocks")
    summary = cut(told.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_join_blocks, _JOINED), "long-answers")
    totals = summary.where("audit is not null").select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    # each row's own edit, told by the edits before its block
    steps = summary.where("audit is null").select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "edits", "state")
    lists = blocks.join(steps, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select("rows", "edits", "state")
    edits = lists.mapInArrow(_spell_out, "row long, before string, letter string, turn string, after string")
    said = placed.select("conv_id", "row", "role", "text").join(edits, "row")
    own = F.when(F.col("letter") == "K", F.col("role")).when(F.col("letter") == "R", F.col("turn"))
    lines = said.select("conv_id", "row", F.concat_ws("\n", F.nullif("before", F.lit("")), F.concat(own, F.lit(":"), F.col("text")), F.nullif("after", F.lit(""))).alias("lines"), (F.col("letter").isin("K", "R") | (F.col("before") != "") | (F.col("after") != "")).alias("any"))
    hashed = lines.where("any").repartition("conv_id").sortWithinPartitions("conv_id", "row").select("conv_id", "lines").mapInArrow(_hash_lines, "conv_id long, repaired_sha256 string")

    turns = placed.groupBy("conv_id", "turn").agg(F.lit(1).alias("x")).groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    out = whole.groupBy("conv_id").agg(F.lit(1).alias("x")).select("conv_id")
    for other in (turns, totals, hashed):
        other = other.withColumnRenamed("conv_id", "c")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    zeros = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in _NAMES[1:7]]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


_TOLD = "n long, first string, last string, blank long, duplicate long, truncated long, illegal long, answers array<struct<entry:int,exit:int,cost:long,audit:string>>"
_TOLD_COLUMNS = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("first", pa.string()), ("last", pa.string()), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")],
     ("answers", pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
)
_JOINED = "conv_id long, block long, edits string, state int, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_JOINED_COLUMNS = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("edits", pa.string()), ("state", pa.int32()), *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())]
)


def _search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, block, rows in zip(*(c.to_pylist() for c in batch.columns)):
            marks = [(r["initial"], r["fault"]) for r in rows]
            answers = [{"entry": p, "exit": q, "cost": c, "audit": a} for p in range(4) for q, (c, a) in search(marks, p, (0, 1, 2, 3) if p == 0 else (1, 2, 3) if p == 1 else (2, 3), True).items()]
            count = [sum(f == k for _, f in marks) for k in (BLANK, DUPLICATE, CUT_OFF)]
            out.append((conv, block, len(marks), marks[0][0], marks[-1][0], *count, illegal([x for x, _ in marks]), answers))
        yield _batch(out, _TOLD_COLUMNS)


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order: the cheapest edits to each state, then each block's share of those that were taken, and the totals."""

    def stream() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    for conv, found in groupby(stream(), key=lambda r: r[0]):
        best: dict[int, tuple[int, str, tuple]] = {0: (0, "", ())}
        counts, before, sizes = [0, 0, 0, 0], None, []
        for _, block, n, first, last, blank, duplicate, truncated, wrong, answers in found:
            new: dict[int, tuple[int, str, tuple]] = {}
            for a in answers:
                if a["entry"] in best:
                    cost, audit, states = best[a["entry"]]
                    key = cost + a["cost"], audit + a["audit"]
                    if a["exit"] not in new or key < new[a["exit"]][:2]:
                        new[a["exit"]] = *key, (states, a["entry"], len(a["audit"]))
            best = new
            sizes.append(block)
            wrong += before is not None and before + first not in ("su", "ua", "au")
            counts, before = [a + b for a, b in zip(counts, (blank, duplicate, truncated, wrong))], last
        cost, audit, states = min((best[q] for q in _GOALS if q in best), key=lambda x: x[:2])
        out, end = [(conv, None, None, None, *counts, cost, audit)], len(audit)
        for block in reversed(sizes):
            states, entry, n = states
            out.append((conv, block, audit[end - n : end], entry, *[None] * 6))
            end -= n
        for k in range(0, len(out), 1000):
            yield _batch(out[k : k + 1000], _JOINED_COLUMNS)


def _spell_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, lines inserted before it, its letter and new role, lines inserted after it (at a block's end)."""
    names = ["row", "before", "letter", "turn", "after"]
    for batch in batches:
        out = []
        for rows, audit, state in zip(*(c.to_pylist() for c in batch.columns)):
            before: list[str] = []
            for letter, (i, role) in zip(audit, edited([(r["initial"],) for r in rows], audit, state)):
                if letter == "I":
                    before.append(f"{role}:")
                else:
                    out.append([rows[i]["row"], "\n".join(before), letter, role, ""])
                    before = []
            if before:
                out[-1][4] = "\n".join(before)
        yield _batch([tuple(r) for r in out], pa.schema([(n, pa.int64() if n == "row" else pa.string()) for n in names]))


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest, out = None, None, []
    for batch in batches:
        for conv, lines in zip(batch.column(0).to_pylist(), batch.column(1)):
            if digest is None or conv != now:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(lines.as_py().encode())
    if digest is not None:
        out.append((now, digest.hexdigest()))
    yield _batch(out, pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))
