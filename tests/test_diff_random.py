"""record_diff on random tables with duplicate groups and NULL keys:
split strategy == single full outer join == DuckDB FULL OUTER JOIN."""

import random
from collections import Counter

import duckdb
import pytest

from deltarecon.operators.reconcile import record_diff


def table(rnd, n, tag):
    vals = ["a", "b", None]
    return [(f"{tag}{i}", rnd.choice(vals), rnd.choice([1, 2, None])) for i in range(n)]


def norm(rows):
    return Counter(tuple("<null>" if v is None else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_equals_full_outer(spark, null_safe, seed):
    rnd = random.Random(seed)
    lrows, rrows = table(rnd, 40, "l"), table(rnd, 60, "r")
    schema = "id string, k1 string, k2 int"
    left, right = spark.createDataFrame(lrows, schema), spark.createDataFrame(rrows, schema)
    split = record_diff(left, right, ["k1", "k2"], null_safe=null_safe, side_col="side").collect()
    single = record_diff(left, right, ["k1", "k2"], null_safe=null_safe, side_col="side", strategy="full_outer").collect()
    assert norm(split) == norm(single)

    con = duckdb.connect()
    con.execute("CREATE TABLE l (id VARCHAR, k1 VARCHAR, k2 INTEGER)")
    con.execute("CREATE TABLE r (id VARCHAR, k1 VARCHAR, k2 INTEGER)")
    con.executemany("INSERT INTO l VALUES (?, ?, ?)", lrows)
    con.executemany("INSERT INTO r VALUES (?, ?, ?)", rrows)
    op = "IS NOT DISTINCT FROM" if null_safe else "="
    duck = con.execute(f"""
        SELECT l.id, l.k1, l.k2, r.id, r.k1, r.k2,
               CASE WHEN l.id IS NOT NULL AND r.id IS NOT NULL THEN 'both'
                    WHEN l.id IS NOT NULL THEN 'left_only' ELSE 'right_only' END
        FROM l FULL OUTER JOIN r ON l.k1 {op} r.k1 AND l.k2 {op} r.k2""").fetchall()
    assert norm(split) == norm(duck)
    assert len(split) > len(lrows)  # duplicate groups produce pairs, as the join semantics say
