"""Column rules on random strings: Spark == plain-Python model == DuckDB oracle text.

One Spark job and one DuckDB query per rule over a few thousand generated
values (digits, letters, spaces, NULL), so the oracle SQL used by the
correctness gate is checked against the same model.
"""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from deltarecon.functions import rules
from deltarecon.harness import oracles

ALPHABET = ["0", "0", "1", "7", "A", "b", "Z", " ", " ", "D"]


def values(seed: int, n: int = 3000):
    rnd = random.Random(seed)
    out = [None, "", " ", "  ", "0", "00", " 0 "]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 6))))
    return out


def py_trim(s):
    return None if s is None else s.strip(" ")


def m_suffix_key(s):
    if s is None:
        return None
    return s + "D" if py_trim(s) != "" else py_trim(s)


def m_suffix_nonzero(s):
    if s is None:
        return ""
    return s + "D" if py_trim(s) != "" and py_trim(s.replace("0", "")) != "" else ""


def m_zero_to_blank(s):
    if s is None:
        return None
    return "" if py_trim(s.replace("0", "")) == "" else py_trim(s)


def m_strip_letters(s):
    if s is None:
        return None
    if py_trim(s) == "":
        return py_trim(s)
    return "".join(ch for ch in s if not ("A" <= ch <= "Z" or "a" <= ch <= "z"))


def m_trim_keep_ws(s):
    if s is None:
        return None
    return py_trim(s) if py_trim(s) != "" else s


def m_remove_first(f, s):
    if f is None or s is None:
        return None
    i = f.find(s)
    return "" if i < 0 else f[:i] + f[i + 1:]


CASES = [
    (rules.suffix_key, m_suffix_key, oracles.suffix_key),
    (rules.suffix_nonzero, m_suffix_nonzero, oracles.suffix_nonzero),
    (rules.zero_to_blank, m_zero_to_blank, oracles.zero_to_blank),
    (rules.strip_letters, m_strip_letters, oracles.strip_letters),
    (rules.trim_keep_ws, m_trim_keep_ws, oracles.trim_keep_ws),
]


@pytest.mark.parametrize("rule,model,sql", CASES, ids=[c[1].__name__ for c in CASES])
def test_rule_matches_model_and_oracle(spark, rule, model, sql):
    vals = values(hash(model.__name__) % 1000)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = dict(df.select("i", rule(F.col("v")).alias("r")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    duck = dict(con.execute(f"SELECT i, {sql('v')} FROM t").fetchall())
    for i, v in enumerate(vals):
        assert got[i] == model(v) == duck[i], (v, got[i], model(v), duck[i])


def test_remove_first_matches_model_and_oracle(spark):
    rnd = random.Random(7)
    pairs = [(f, s) for f, s in zip(values(1), values(2))]
    pairs += [(f, rnd.choice(["0", "", "00", "7A"])) for f in values(3, 500)]
    df = spark.createDataFrame([(i, f, s) for i, (f, s) in enumerate(pairs)], "i int, f string, s string")
    got = dict(df.select("i", rules.remove_first("f", "s")).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, f VARCHAR, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, f, s) for i, (f, s) in enumerate(pairs)])
    duck = dict(con.execute(f"SELECT i, {oracles.remove_first('f', 's')} FROM t").fetchall())
    for i, (f, s) in enumerate(pairs):
        assert got[i] == m_remove_first(f, s) == duck[i], (f, s)
