import hashlib
import itertools
import random
import re
import zlib

import pytest

from pepweave.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def ladder(marks):
    """The least (cost, edits), by a table of the best edits up to each row and last turn."""
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "")}
    for k in range(len(marks) + 1):
        for _ in range(3):  # inserts
            for q, (c, a) in list(best.items()):
                for x, t in follow[q].items():
                    if x != "s" and (t not in best or (c + 2, a + "I") < best[t]):
                        best[t] = c + 2, a + "I"
        if k == len(marks):
            break
        initial, fault = marks[k]
        new = {}
        for q, (c, a) in best.items():
            ways = [(q, c + 3, a + "D")]
            if fault in (C.GOOD, C.CUT_OFF):
                ways += [(t, c + 2 + fault, a + "R") for x, t in follow[q].items() if x != "s"]
                ways += [(t, c + fault, a + "K") for x, t in follow[q].items() if x == initial]
            for t, cost, audit in ways:
                if t not in new or (cost, audit) < new[t]:
                    new[t] = cost, audit
        best = new
    return min(best[q] for q in ("", "a") if q in best)


def everything(marks, most):
    """The same by writing out all edits of up to so many letters."""
    found = []
    for n in range(len(marks), most + 1):
        for letters in itertools.product("DIKR", repeat=n):
            if sum(x != "I" for x in letters) != len(marks):
                continue
            for turns in itertools.product("ua", repeat=sum(x in "IR" for x in letters)):
                out, cost, i, t = "", 0, 0, iter(turns)
                for x in letters:
                    if x == "I":
                        out, cost = out + next(t), cost + 2
                        continue
                    initial, fault = marks[i]
                    i += 1
                    if x == "D":
                        cost += 3
                    elif fault > C.CUT_OFF:
                        cost = 99
                        break
                    else:
                        out, cost = out + (initial if x == "K" else next(t)), cost + fault + 2 * (x == "R")
                if cost < 99 and GRAMMAR.fullmatch(out):
                    found.append((cost, "".join(letters)))
    return min(found)


def brute(rows, damaged=True):
    """conv_id: the contract's columns."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 19
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 4:
                role = "user"
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        kept.sort()
        marks, seen = [], []
        for _, _, role, text in kept:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            marks.append((role[:1], C.BLANK if not solid else C.DUPLICATE if (role, text) in seen else C.GOOD if solid[-1] in ".!?" else C.CUT_OFF))
            seen.append((role, text))
        cost, audit = ladder(marks)
        i, lines = 0, []
        for x in audit:
            turn = "user" if not lines or lines[-1][0] != "u" else "assistant"
            if x != "D":
                lines.append((kept[i][2] if x == "K" else turn) + ":" + ("" if x == "I" else kept[i][3]))
            i += x != "I"
        turns = {t for known, t, _, _ in kept if known}
        pairs = [a + b for (a, _), (b, _) in zip(marks, marks[1:])]
        n = [sum(f == k for _, f in marks) for k in (C.BLANK, C.DUPLICATE, C.CUT_OFF)]
        out[conv] = (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *n, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_search_against_all_edits():
    for n in range(4):
        for marks in itertools.product([("s", 0), ("u", 0), ("u", 1), ("a", 0), ("a", 2), ("t", 1)], repeat=n):
            (found, *_) = C.search(list(marks)).values()
            assert found == everything(marks, n + (2 if n < 3 else 1)) or n == 3 and found[0] <= everything(marks, n + 1)[0]
            assert found == ladder(marks)


def test_search_against_a_table():
    rng = random.Random(3)
    for _ in range(3000):
        marks = [(rng.choice("suaaut"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(30))]
        (found, *_) = C.search(marks).values()
        assert found == ladder(marks)


def awkward(rng, n, convs):
    texts = ["Hi.", "Hi", "", None, " \n", "Yes! ", "No?\t", "Well", "x\u00a0", "\u3000", "a.\u2003"]
    return [(rng.choice(convs), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", None, "tool", "", "a"]), rng.choice(texts)) for _ in range(n)]


def test_conversations_against_brute_force(spark):
    rng = random.Random(7)
    rows = awkward(rng, 1200, [None, *range(150)]) + [(999, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(60)]
    got = {r[0]: tuple(r) for r in C.repair(C.damage(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("block", [1, 3, 50])
def test_long_conversations_in_blocks(spark, block):
    rng = random.Random(block)
    rows = awkward(rng, 500, [None, 1, 2, 3]) + awkward(rng, 60, range(10, 40)) + [(50, 0, "user", "Hi.")] * 40
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r[0]: tuple(r) for r in C.repair(C.damage(df), long=5, block=block).collect()}
    assert got == brute(rows)
    got = {r[0]: tuple(r) for r in C.repair(C.plain(df), long_chars=2, block=block).collect()}
    assert got == brute(rows, False)


def test_nothing_left_of_a_conversation(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    for long in (1000, 0):
        (row,) = C.repair(C.damage(df), long=long).collect()
        assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert C.repair(C.damage(df.limit(0))).collect() == []


def test_very_long_text_and_further_columns(spark):
    from pyspark.sql import functions as F

    rows = [(1, 0, "user", "word " * 200_000 + "end."), (1, 1, "assistant", "Yes."), (1, 2, "user", "word " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"copies": F.lit(9), "last": F.lit("x"), "row": F.lit(None), "heavy": F.lit(1), "audit": F.lit("")})
    for most in (C.LONG_CHARS, 1000):
        (row,) = C.repair(C.plain(df), long_chars=most).collect()
        assert tuple(row) == brute(rows, False)[1]
