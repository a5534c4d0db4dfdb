"""Hot keys: AQE must be able to split them, results must stay whole.

Thresholds are lowered so that the small test tables count as skewed, and
partition coalescing is off so each stage has several map outputs to split
(as on a cluster).
"""

import contextlib

import pytest
from pyspark.sql import functions as F

from deltarecon.harness import fixtures as fx
from deltarecon.harness.queries import _lookup, _master
from deltarecon.operators import dedup, reconcile
from deltarecon.plans import feed_reconciliation as fr

from .conftest import SF_SMALL, plan_text

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture
def hot_feed(spark):
    f = fx.feed(spark, SF_SMALL)
    # half of all versions name one head office
    return f.withColumn("hq_no", F.when(F.col("version_id") % 2 == 0, F.lit("000000020")).otherwise(F.col("hq_no")))


def test_parent_flag_splits_hot_parent(spark, hot_feed):
    with skew_conf(spark):
        out = fr.accepted_and_rejected(fr.feed_flow(hot_feed, _lookup(spark)))
        rows = out.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(out)
    union = fr.accepted_rejected_union(fr.feed_flow(hot_feed, _lookup(spark)))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, union.collect()))


def test_diff_splits_group_of_master_copies(spark):
    acc = fr.accepted_and_rejected(fr.feed_flow(fx.feed(spark, SF_SMALL), _lookup(spark)))
    m = _master(spark, SF_SMALL)
    m = m.withColumns({c: F.when(F.col("cir_key") % 2 == 0, F.lit("X")).otherwise(F.col(c)) for c in fx.DIFF_KEYS})
    with skew_conf(spark):
        split = reconcile.record_diff(acc, m, fx.DIFF_KEYS, side_col="side")
        rows = split.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(split)
    full = reconcile.record_diff(acc, m, fx.DIFF_KEYS, side_col="side", strategy="full_outer").collect()
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(rows, key=key) == sorted(full, key=key)


def test_latest_stamp_join_splits_hot_key(spark):
    f = fx.feed(spark, SF_SMALL).withColumn(
        "reg_no", F.when(F.col("version_id") % 2 == 0, F.lit("000000020")).otherwise(F.col("reg_no")))
    with skew_conf(spark):
        out = dedup.with_latest_ts(f, "reg_no", "ts_last_update")
        n = out.count()
        out.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(out)
    assert n == f.count()


def test_semi_and_anti_split_hot_parent(spark, hot_feed):
    flow = fr.feed_flow(hot_feed, _lookup(spark))
    with skew_conf(spark):
        for op in (reconcile.match_parent, reconcile.orphans):
            out = op(flow["std"], flow["keys"], "hq_no", "reg_no")
            out.collect()
            assert "SortMergeJoin(skew=true)" in plan_text(out)
