"""record_diff where keys are NULL, of other types, or shared by very many rows."""

import time

import pytest
from pyspark.sql import functions as F

from deltarecon.operators.reconcile import compared_type, record_diff
from deltarecon.session import ensure_checkpoint_dir, path_exists, scratch_scope

from .conftest import plan_text
from .test_diff_random import norm, table
from .test_skew import skew_conf


def both_ways(left, right, keys, **how):
    got = record_diff(left, right, keys, side_col="side", **how).collect()
    want = record_diff(left, right, keys, side_col="side", strategy="full_outer",
                       null_safe=how.get("null_safe", False)).collect()
    assert norm(got) == norm(want)
    return got


def timed(df):
    begun = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - begun


@pytest.mark.parametrize("strategy", ["split", "measured"])
def test_a_third_of_the_keys_null_isnt_quadratic(spark, tmp_path, strategy):
    rows = spark.range(240_000).selectExpr("if(id % 3 = 0, null, id) AS k", "'same' AS k2", "id % 7 AS v")
    paths = [str(tmp_path / side) for side in "lr"]
    for p in paths:
        rows.write.parquet(p)
    left, right = map(spark.read.parquet, paths)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        single = record_diff(left, right, ["k", "k2"], strategy="full_outer", side_col="side")
        other = record_diff(left, right, ["k", "k2"], strategy=strategy, side_col="side")
        timed(single), timed(other)
        assert min(timed(other) for _ in range(2)) <= 2 * min(timed(single) for _ in range(2)) + 1
        assert sorted(map(tuple, other.groupBy("side").count().collect())) == [
            ("both", 160_000), ("left_only", 80_000), ("right_only", 80_000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("strategy", ["split", "measured"])
@pytest.mark.parametrize("ltype,rtype,lvals,rvals", [
    ("string", "int", ["01", "2", None], [1, 2, 3, None]),
    ("int", "bigint", [1, 2, None], [1, 3_000_000_000, None]),
    ("decimal(9,2)", "decimal(12,4)", ["1.50", "2.25"], ["1.5000", "2.2501"]),
    ("decimal(9,2)", "double", ["1.50", "2.25"], [1.5, 7.0]),
    ("date", "string", ["2024-01-05"], ["2024-01-05", "2024-01-06"]),
    ("date", "timestamp", ["2024-01-05"], ["2024-01-05 00:00:00", "2024-01-05 00:00:01"]),
    ("double", "double", ["0.0", "NaN", "1"], ["-0.0", "NaN", "2"]),
    ("boolean", "string", ["true", "false"], ["true", "t"]),
])
def test_keys_of_two_types_compare_as_equals_does(spark, strategy, ltype, rtype, lvals, rvals):
    def side(values, kind):
        return spark.createDataFrame([(None if v is None else str(v),) for v in values], "t string").select(
            F.col("t").cast(kind).alias("k"), F.col("t").alias("as_text"))
    got = both_ways(side(lvals, ltype), side(rvals, rtype), ["k"], strategy=strategy)
    assert any(r["side"] == "both" for r in got) and any(r["side"] != "both" for r in got)


def test_common_type_is_the_analysers(spark):
    assert compared_type(spark, "int", "int") == "int"
    assert compared_type(spark, "int", "bigint") == "bigint"
    assert compared_type(spark, "decimal(9,2)", "decimal(12,4)") == "decimal(12,4)"


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("hot_rows", [0, 1, 4, 1000])
@pytest.mark.parametrize("null_safe", [False, True])
def test_hot_keys_apart_give_the_same_rows(spark, null_safe, hot_rows, unique):
    import random
    rnd = random.Random(hot_rows)
    schema = "id string, k1 string, k2 int"
    left = spark.createDataFrame(table(rnd, 40, "l"), schema)
    right = spark.createDataFrame(table(rnd, 60, "r"), schema)
    both_ways(left, right, ["k1", "k2"], null_safe=null_safe, strategy="measured", hot_rows=hot_rows, left_is_unique=unique)


def test_too_many_hot_keys_go_the_split_way(spark, monkeypatch):
    from deltarecon.operators import reconcile
    monkeypatch.setattr(reconcile, "MAX_HOT_KEYS", 3)
    left = spark.range(30).selectExpr("id AS k", "id AS v")
    right = spark.range(60).selectExpr("id % 20 AS k", "id AS v")
    diff = record_diff(left, right, ["k"], strategy="measured", hot_rows=1, side_col="side")
    assert "LeftAnti" in plan_text(diff)
    both_ways(left, right, ["k"], strategy="measured", hot_rows=1)


def test_without_hot_keys_each_side_is_read_once(spark, tmp_path):
    for side in "lr":
        spark.range(500).selectExpr("id AS k", "id * 2 AS v").write.parquet(str(tmp_path / side))
    left, right = (spark.read.parquet(str(tmp_path / side)) for side in "lr")
    with scratch_scope(spark) as copies:
        plan = plan_text(record_diff(left, right, ["k"], strategy="measured", left_is_unique=True))
        assert not copies
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2 and tree.count("Exchange") == 2 and "FullOuter" in plan


def test_hot_master_copies_are_split(spark):
    """Half of the master has one key: its partition is cut up."""
    left = spark.range(3000).selectExpr("id AS k", "repeat('x', 50) AS v")
    right = spark.range(6000).selectExpr("if(id % 2 = 0, 7, id) AS k", "sha2(string(id), 256) AS v")
    with skew_conf(spark):
        diff = record_diff(left, right, ["k"], strategy="measured", left_is_unique=True, hot_rows=500, side_col="side")
        rows = diff.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(diff)
    assert sum(r["side"] != "left_only" for r in rows) == 6000


@pytest.mark.parametrize("fails", [False, True])
def test_scratch_scope_leaves_nothing(spark, fails):
    left = spark.range(10).selectExpr("id AS k")
    try:
        with scratch_scope(spark) as paths:
            assert record_diff(left, left, ["k"]).count() == 10
            kept = list(paths)
            assert len(kept) == 1 and path_exists(spark, kept[0])
            if fails:
                raise ValueError
    except ValueError:
        pass
    assert not path_exists(spark, kept[0]) and path_exists(spark, ensure_checkpoint_dir(spark))


def test_buckets_of_keys_find_the_same_hot_keys(spark):
    from deltarecon.operators.reconcile import _Diff

    rows = [(i % 50 if i < 900 else i,) for i in range(1500)] + [(None,)] * 40 + [(7,)] * 200
    df = spark.createDataFrame(rows, "k int")
    diff = _Diff(df, df, ["k"], False, "l_", "r_")
    want = {r["h"] for r in df.select(F.when(F.col("k").isNotNull(), diff.key_hash(df)).alias("h")).groupBy("h").count()
            .filter("count > 30").collect()}
    assert len(want) == 2 and None in want  # the key 7 and the rows without a partner
    for buckets in (1, 3, 64, 1 << 20):
        assert {h for h, in diff.hot_keys(df, 30, buckets)} == want
    assert diff.hot_keys(df, 300) == []
