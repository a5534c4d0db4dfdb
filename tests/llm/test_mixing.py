"""Temperature mixing against the SQL version and its own promises."""

import math

import duckdb
import pytest

from deltarecon.llm import mixing
from deltarecon.llm.oracles import ORACLES


def skewed(n=900):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 else (None if i % 30 == 0 else f"s{i % 7}")
        rows.append((i if i % 50 else None, " ".join(["w"] * (i * 37 % 211)) if i % 41 else None, "en", source))
    return rows + rows[:5]


def test_skewed_nulls_and_repeats_match_sql(make_docs, monkeypatch):
    df = make_docs(skewed())
    documents = df.toPandas()
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    cols = ["doc_id", "source", "n_tokens", "epoch", "start_token", "weight", "mix_at"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES['op1_temperature_mixing']})").fetchall()
    got = [tuple(r) for r in mixing.mix(df).select(*cols).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=str), sorted(want, key=str)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], abs=2e-9)


def test_entropy_target_and_repetition_limit(make_docs):
    rows = [(i, "w " * 50, "en", "big" if i % 50 else "small") for i in range(2000)]
    rows += [(3000 + i, "w " * 50, "en", f"mid{i % 3}") for i in range(300)]
    tokens = [(r[3], 50) for r in rows]
    df = make_docs(rows).sparkSession.createDataFrame(tokens, "key string, n_tokens long")

    def entropy(ws):
        return -sum(w * math.log(w) for w in ws)

    free = mixing.source_weights(df, 0.9, 1e9).collect()
    assert entropy([r["weight"] for r in free]) == pytest.approx(0.9 * math.log(5), abs=1e-6)
    held = mixing.source_weights(df, 0.9, 2.0).collect()
    assert max(r["weight"] * 2300 * 50 / r["tokens"] for r in held) <= 2.0 + 1e-6
    assert sum(r["weight"] for r in held) == pytest.approx(1)


def test_epochs_are_whole_and_budgets_met(make_docs):
    rows = [(i, "w " * (1 + i % 90), "en", "a" if i < 1500 else "b") for i in range(1600)]
    draws = mixing.mix(make_docs(rows), target_entropy=1.0, max_repeats=100, block_tokens=512).collect()
    total = {s: sum(1 + r[0] % 90 for r in rows if r[3] == s) for s in "ab"}
    for s in "ab":
        mine = sorted((r["start_token"], r["n_tokens"], r["epoch"], r["doc_id"]) for r in draws if r["source"] == s)
        budget = sum(total.values()) / 2
        at = 0
        for start, n, epoch, _ in mine:  # the stream has no gap
            assert start == at and epoch == start // total[s]
            at += n
        assert budget <= at < budget + 90
    first = [r["doc_id"] for r in sorted(draws, key=lambda r: r["start_token"]) if r["source"] == "b" and r["epoch"] == 0]
    second = [r["doc_id"] for r in sorted(draws, key=lambda r: r["start_token"]) if r["source"] == "b" and r["epoch"] == 1]
    assert sorted(first) == sorted(second) and first != second


def test_edges(make_docs):
    assert mixing.mix(make_docs([])).collect() == []
    assert mixing.mix(make_docs([(1, None), (2, "")])).collect() == []  # nothing to draw tokens from
    one = mixing.mix(make_docs([(1, "a b", "en", None), (None, "c", "en", None)])).collect()
    assert sorted((r["doc_id"] or 0, r["weight"]) for r in one) == [(0, 1.0), (1, 1.0)]


def test_a_budget_beyond_the_limit_is_refused(make_docs):
    df = make_docs([(i, "w " * 10, "en", f"s{i % 2}") for i in range(20)])
    assert mixing.mix(df, max_repeats=2, budget_tokens=400).count() == 40
    for budget, rows in ((401, df), (4000, df), (401, df.filter("source = 's0'"))):
        with pytest.raises(ValueError, match="times"):
            mixing.mix(rows, max_repeats=2, budget_tokens=budget)
