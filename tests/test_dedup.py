"""Latest version per key and its plan."""

from pyspark.sql import functions as F

from deltarecon.harness.queries import _valid
from deltarecon.operators import dedup

from .conftest import SF_SMALL, plan_text


def test_edge_rows(spark):
    df = spark.createDataFrame(
        [("k", None, 1), ("k", 2, 2), ("n", None, 3), (None, 5, 4), (None, 4, 5)],
        "k string, ts int, v int",
    )
    got = {(r.k, r.ts) for r in dedup.latest_per_key(df, "k", "ts", "v").collect()}
    assert got == {("k", 2), (None, 5)}


def test_ties_broken_by_tiebreak(spark):
    df = spark.createDataFrame([("k", 1, 10), ("k", 1, 30), ("k", 1, 20)], "k string, ts int, v int")
    assert dedup.latest_per_key(df, "k", "ts", "v").first().v == 30


def test_window_and_agg_forms_agree(spark):
    v = _valid(spark, SF_SMALL)
    a = dedup.latest_per_key(v, "reg_no", "ts_last_update", "version_id")
    b = dedup.latest_per_key_agg(v, "reg_no", "ts_last_update", "version_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_refshape_matches_exact_dedup_on_key_and_ts(spark):
    v = _valid(spark, SF_SMALL)
    exact = dedup.latest_per_key(v, "reg_no", "ts_last_update", "version_id").select("reg_no", "ts_last_update")
    ref = dedup.latest_keys_with_ts(v, "reg_no", "ts_last_update")
    assert exact.exceptAll(ref).count() == 0 and ref.exceptAll(exact).count() == 0


def test_with_latest_ts_equals_window_first(spark):
    from pyspark.sql import Window

    v = _valid(spark, SF_SMALL)
    w = Window.partitionBy("reg_no").orderBy(F.col("ts_last_update").desc())
    ref = v.withColumn("max_ts", F.first("ts_last_update").over(w)).select("version_id", "max_ts")
    got = dedup.with_latest_ts(v, "reg_no", "ts_last_update").select("version_id", "max_ts")
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_partial_group_limit_before_shuffle(spark):
    plan = plan_text(dedup.latest_per_key(_valid(spark, SF_SMALL), "reg_no", "ts_last_update", "version_id"))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_bucketed_feed_dedups_without_shuffle(spark):
    import re

    from deltarecon.harness import fixtures as fx
    from deltarecon.sinks import write_bucketed

    write_bucketed(fx.feed(spark, SF_SMALL), "feed_bucketed_test", "reg_no", 4)
    valid = spark.table("feed_bucketed_test").filter(F.col("reg_name") != "")
    d = dedup.latest_per_key(valid, "reg_no", "ts_last_update", "version_id")
    assert not re.search(r"\(\d+\) Exchange", plan_text(d))
    ref = dedup.latest_per_key(_valid(spark, SF_SMALL), "reg_no", "ts_last_update", "version_id")
    assert d.exceptAll(ref).count() == 0 and ref.exceptAll(d).count() == 0
    spark.sql("DROP TABLE IF EXISTS feed_bucketed_test")
