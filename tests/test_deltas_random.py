"""Delta counts on random rows: Spark == Python model == oracle SQL text."""

import datetime as dt
import random

import duckdb
import pytest

from deltarecon.harness import oracles
from deltarecon.operators.deltas import delta_counts

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def rows(seed, n=2000):
    rnd = random.Random(seed)

    def stamp():
        if rnd.random() < 0.1:
            return None
        return rnd.choice(DAYS) + rnd.choice(["", " 01:02:03", " 23:59:59"])

    return [(stamp(), stamp(), rnd.choice(["Y", "N", "N", None])) for _ in range(n)]


def model(data, d, mode, with_del=True):
    day = lambda s: None if s is None else s[:10]
    hit = (lambda x: x is not None and x >= d) if mode == "since" else (lambda x: x is not None and x == d)
    ins = upd = dele = act = inact = 0
    for c, u, f in data:
        cd, ud = day(c), day(u)
        if mode == "since":
            ins += hit(cd) and hit(ud)
        else:
            ins += hit(cd)
        changed = hit(ud) and cd is not None and ud != cd
        if with_del:
            upd += changed and f == "N"
            dele += changed and f == "Y"
        else:
            upd += changed
        act += f == "N"
        inact += f == "Y"
    return {"inserts": ins, "updates": upd, "deletes": dele if with_del else None, "total": len(data),
            "active": act if with_del else None, "inactive": inact if with_del else None}


@pytest.mark.parametrize("mode", ["since", "on"])
@pytest.mark.parametrize("typed", [False, True])
def test_counts_match_model_and_oracle(spark, mode, typed):
    data = rows(11 if typed else 5)
    if typed:
        data = [(None if c is None else dt.datetime.fromisoformat(c), None if u is None else dt.datetime.fromisoformat(u), f)
                for c, u, f in data]
        schema = "created timestamp_ntz, updated timestamp_ntz, deleted string"
        as_text = [(None if c is None else c.isoformat(" "), None if u is None else u.isoformat(" "), f) for c, u, f in data]
    else:
        schema = "created string, updated string, deleted string"
        as_text = data
    df = spark.createDataFrame(data, schema)
    got = delta_counts(df, "2024-01-03", "created", "updated", "deleted", mode=mode, job_time="t").first().asDict()
    expected = model(as_text, "2024-01-03", mode)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({'created TIMESTAMP, updated TIMESTAMP' if typed else 'created VARCHAR, updated VARCHAR'}, deleted VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", data)
    cur = con.execute(oracles.count_select("t", "e", "p", "2024-01-03", "created", "updated", "deleted", typed=typed, mode=mode))
    duck = dict(zip([c[0] for c in cur.description], cur.fetchone()))
    for k, v in expected.items():
        assert got[k] == v == duck[k], (k, got[k], v, duck[k])


def test_no_delete_column_matches_model(spark):
    data = rows(3)
    df = spark.createDataFrame([(c, u) for c, u, _ in data], "created string, updated string")
    got = delta_counts(df, "2024-01-02", "created", "updated", None, job_time="t").first().asDict()
    expected = model(data, "2024-01-02", "since", with_del=False)
    assert {k: got[k] for k in expected} == expected
