import hashlib
import re
import time

import pytest
from helpers import by_id, docs

from pepweave.llm import catalog, secret_scan

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEY = "AKIA" + "Z9" * 6
ROWS = [
    (1, None), (2, ""), (3, 'é token = "abcdefgh12" and PASSWORD:short'), (4, f"{KEY} AKIASHORT {KEY}x a{'0f' * 16} {'0f' * 15}"), (5, "token:token:abcdefgh secret=token=abcdefghij"),
    (6, "ſecret=abcdefghij toKen=abcdefghij"), (7, ("word " * 40_000) + "api_key='" + "k1" * 8 + "'"), (8, "api" + "key: " + "f" * 40),
]


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    named = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out)]
    return [sum(k == j for _, k, _ in out) for j in range(3)], hashlib.sha256(",".join(named).encode()).hexdigest()


def test_base_matches_brute_force(spark):
    got = by_id(catalog.secret_digest(secret_scan.scan(docs(spark, ROWS, spans="clash"))))
    for i, text in ROWS:
        counts, sha = brute(text)
        assert ([got[i].n_assign, got[i].n_access, got[i].n_hex], got[i].base_sha256) == (counts, sha), i
        assert (got[i].spans == "") == (sum(counts) == 0)
    assert secret_scan.scan(docs(spark, [])).count() == 0


def named(text):
    return [text[s["start"] : s["end"]] for s in secret_scan.find(text) if s["kind"] == "named"]


def test_literals_reach_sensitive_names():
    value = "q7Rt" + "9xWz" + "Lm2P" + "vB4n"
    assert named(f'db_pwd = "{value}"') == [value]
    assert named(f"export SERVICE_CREDENTIALS={value}") == [value]
    assert named(f'{{"clientPassphrase": "{value}"}}') == [value]
    assert named(f'K = "{value}"\nx = 1\ndb_pwd = K\n') == [value]
    assert named(f'A = "{value[:8]}"\nB = A\ndb_pwd = B + "{value[8:]}"') == [value[:8], value[8:]]
    assert named(f"signing_key: '{value}'") == [value]


def test_shapes_of_assignments():
    value = "q7Rt" + "9xWz" + "Lm2P" + "vB4n"
    blanks = " " * 300
    assert named(f'db_pwd{blanks}={blanks}"{value}"') == [value]
    assert named(f'{"n" * 200}_pwd = "{value}"') == [value]
    assert secret_scan.find(f'{"n" * 200}_pwd = "{value}"')[0]["name"] == "n" * 200 + "_pwd"
    assert named(f'db_pwd: str = "{value}"') == [value]
    assert named(f'db_pwd: Optional[str] = "{value}"') == [value]
    assert named(f'db_pwd: str | None = b"{value}"') == [value]
    assert named(f'note: db_pwd = "{value}"') == [value]
    assert named(f'd["db_pwd"] = r\'{value}\';') == [value]
    assert named("DB_PWD=q7Rt!9x#Wz@Lm:2P, x") == ["q7Rt!9x#Wz@Lm:2P"]
    assert named(f'build: str = "{value}"\ndb_pwd: str\n') == []
    assert named("db_pwd = load_settings(q7Rt9xWz)[0]") == []


def test_names_are_followed_in_the_order_of_the_text():
    value = "q7Rt" + "9xWz" + "Lm2P" + "vB4n"
    assert named(f'K = "{value}"\ndb_pwd = K\nK = "changeme"') == [value]
    assert named(f'K = "changeme"\ndb_pwd = K\nK = "{value}"') == []
    assert named(f'db_pwd = K\nK = "{value}"\nK = "changeme"') == [value]
    assert named(f'a = "{value}"\nb = a\na = b\nb = a\ndb_pwd = b') == [value]


@pytest.mark.parametrize("line", ["a{0} = a{1}", "a{0} = a{1} + a{1}", 'a{0} = a{1} + "x{0}"', "a{0}=a{1}=", "pwd=p{0}=", "a:b[", "pwd = a0; ", "p=p+ ", 'pwd="b=" + '])
def test_long_chains_take_time_in_proportion(line):
    text = 'a0 = "q7Rt9xWzLm2PvB4n"' + "\n" + ("" if line[-1] in "=[ " else "\n").join(line.format(k, k - 1) + ("" if line[-1] in "=[ " else "\n") for k in range(1, 100_001)) + "\npwd = a60\n"
    began = time.process_time()
    found = secret_scan.find(text)
    assert time.process_time() - began < 10
    if line in ("a{0} = a{1}", "a{0} = a{1} + a{1}"):
        assert [text[s["start"] : s["end"]] for s in found] == ["q7Rt9xWzLm2PvB4n"]


def test_literals_and_sums_of_any_size():
    long = "Zq7" * 2000 + "aB3$x" * 400
    assert named(f'db_pwd = "{long}"') == [long]
    assert named(f'K = "{long}"\nL = K\ndb_pwd = L + "x"') == [long, "x"]
    parts = [f"q{k}Rz" for k in range(70)]
    assert named("db_pwd = " + " + ".join(f'"{p}"' for p in parts)) == parts
    assert named("db_pwd = " + " + ".join(f"k{k}" for k in range(70)) + "\n") == []
    assert named("\n".join(f'k{k} = "{p}"' for k, p in enumerate(parts)) + "\ndb_pwd = " + " + ".join(f"k{k}" for k in range(70))) == parts
    assert named(f'db_pwd: dict[{"a, " * 200}b] = "{parts[0] + long[-20:]}"') == [parts[0] + long[-20:]]
    name = "aB3cD5eF7gH9" * 10
    assert named(f'db_pwd = "${name}{name}"') == [] and named(f'db_pwd = "${name}-{name}"') == [f"${name}-{name}"]


def test_a_sum_is_read_when_it_is_first_met():
    value = "q7Rt" + "9xWz" + "Lm2P" + "vB4n"
    assert named(f'K = "{value}"\ndb_pwd = K + ""\nK = "changeme"') == [value]
    assert named(f'if connect(pwd=K):\n  K = "{value}"') == [value]
    assert named(f'a = "{value}" + a\nb = a + a\nc = b + b + a\ndb_pwd = c + c') == [value]


@pytest.mark.parametrize("line", ["p=p+ ", "a=", 'pwd="b=" + ', "pwd = k + "])
def test_a_hundred_kilobytes_take_no_second(line):
    began = time.process_time()
    secret_scan.find('k = "q7Rt9xWzLm2PvB4n"\n' + line * (100_000 // len(line)))
    assert time.process_time() - began < 2


def test_repeated_rows(spark):
    rows = [(1, ROWS[2][1]), (1, ROWS[2][1]), (None, ROWS[2][1])]
    got = secret_scan.scan(docs(spark, rows)).collect()
    assert len(got) == 3 and len({str(r.spans) for r in got}) == 1


def test_clean_text_stays_clean():
    value = "q7Rt9xWz" + "Lm2PvB4n"
    for text in ('db_pwd = "changeme"', f'build_id = "{value}"', "see http://example.org/a: b", "pwd: short", f'pwd_path = "{value}"', 'pwd = "${DB_PWD}"', "note: the password field is blank", "a = b\nb = a\npwd = a"):
        assert not [s for s in secret_scan.find(text) if s["kind"] == "named"], text
