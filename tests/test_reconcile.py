"""Joins of the reconciliation: diff semantics, parent flag forms, plans."""

import pytest
from pyspark.sql import functions as F

from deltarecon.harness import fixtures as fx
from deltarecon.harness.queries import _flow, _lookup, _master
from deltarecon.operators import reconcile
from deltarecon.plans import feed_reconciliation as fr

from .conftest import SF_SMALL, plan_text


def _sides(spark):
    left = spark.createDataFrame([(1, "a", "k"), (2, None, "k"), (3, "z", "k")], "i int, x string, y string")
    right = spark.createDataFrame([(1, "a", "k"), (2, None, "k"), (4, "q", "k")], "i int, x string, y string")
    return left, right


def test_full_outer_plain_equality(spark):
    left, right = _sides(spark)
    d = reconcile.record_diff(left, right, ["i", "x", "y"], side_col="side")
    sides = [(r.l_i, r.r_i, r.side) for r in d.collect()]
    assert len(sides) == 5
    assert set(sides) == {(1, 1, "both"), (2, None, "left_only"), (3, None, "left_only"),
                          (None, 2, "right_only"), (None, 4, "right_only")}


def test_full_outer_null_safe(spark):
    left, right = _sides(spark)
    d = reconcile.record_diff(left, right, ["i", "x", "y"], null_safe=True, side_col="side")
    sides = sorted((r.l_i or 0, r.r_i or 0, r.side) for r in d.collect())
    assert sides == [(0, 4, "right_only"), (1, 1, "both"), (2, 2, "both"), (3, 0, "left_only")]


def test_flag_one_pass_equals_union_form(spark):
    flow = _flow(spark, SF_SMALL)
    one = fr.accepted_and_rejected(flow)
    union = fr.accepted_rejected_union(flow)
    assert one.exceptAll(union).count() == 0 and union.exceptAll(one).count() == 0


def test_flag_generic_keys_with_duplicates(spark):
    rows = spark.createDataFrame([("a", ""), ("b", "x"), ("c", "y")], "id string, parent string")
    keys = spark.createDataFrame([("x",), ("x",), ("",)], "k string")
    got = {r.id: r.flag for r in reconcile.flag_missing_parent(rows, keys, "parent", "k", "flag").collect()}
    assert got == {"a": "N", "b": "N", "c": "Y"}  # no fan-out on duplicate keys


def test_semi_and_anti_plans(spark):
    flow = _flow(spark, SF_SMALL)
    assert "LeftAnti" in plan_text(reconcile.orphans(flow["std"], flow["keys"], "hq_no", "reg_no"))
    assert "LeftSemi" in plan_text(reconcile.match_parent(flow["std"], flow["keys"], "hq_no", "reg_no"))


def test_lookup_is_broadcast_and_fans_out(spark):
    df = spark.createDataFrame([("1P", 1), ("3O", 2)], "status_code string, v int")
    lk = spark.createDataFrame([("1P", "a"), ("1P", "b")], "status_key string, status_description string")
    j = reconcile.lookup_join(df, lk, "status_code", "status_key", keep=["status_description"])
    assert sorted(r.status_description for r in j.collect()) == ["a", "b"]
    assert "BroadcastHashJoin" in plan_text(j)


def test_master_filter_pushed_to_scan(spark):
    hub = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    f = fr.scan_filtered(hub, o_orderstatus="F", o_orderpriority="1-URGENT")
    plan = plan_text(f)
    assert "PushedFilters" in plan and "EqualTo(o_orderstatus,F)" in plan


def test_master_view_one_row_per_customer(spark):
    m = _master(spark, SF_SMALL)
    assert m.count() == m.select("cir_key").distinct().count()


def test_reconciliation_sides_add_up(spark):
    from deltarecon.harness.queries import reconciliation

    rec = reconciliation(spark, SF_SMALL)
    by_side = {r.diff_side: r["count"] for r in rec.diff.groupBy("diff_side").count().collect()}
    assert by_side.get("both", 0) + by_side.get("feed_only", 0) == rec.accepted.count()
    assert by_side.get("both", 0) + by_side.get("master_only", 0) == rec.master.count()
    assert rec.rejects.filter(F.col("reg_name") != "").count() == 0


def test_lookup_fixture_parse(spark):
    assert sorted(tuple(r) for r in _lookup(spark).collect()) == [("1P", "Partial"), ("2F", "Fulfilled")]
    assert fx.STATUS_LOOKUP_LINES == ("1PPartial", "2FFulfilled")


def test_flag_null_parent_rejected_and_blank_spread(spark):
    rows = spark.createDataFrame([("a", ""), ("b", None), ("c", "x"), ("d", "")], "id string, parent string")
    keys = spark.createDataFrame([("x",)], "k string")
    out = reconcile.flag_missing_parent(rows, keys, "parent", "k", "flag")
    assert {r.id: r.flag for r in out.collect()} == {"a": "N", "b": "Y", "c": "N", "d": "N"}


def test_broadcast_bound_checks_rows_and_bytes(spark):
    from deltarecon.operators.broadcast import has_at_most

    df = spark.createDataFrame([("k", "x" * 1000)] * 10, "a string, b string")
    assert has_at_most(df, 10) and not has_at_most(df, 9)
    assert has_at_most(df, 10, max_bytes=20_000) and not has_at_most(df, 10, max_bytes=5_000)


def test_lookup_join_beyond_bound_is_a_shuffle_join_with_same_rows(spark):
    from deltarecon.harness.queries import _valid

    d = _valid(spark, SF_SMALL)
    small = reconcile.lookup_join(d, _lookup(spark), "status_code", "status_key")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = reconcile.lookup_join(d, _lookup(spark), "status_code", "status_key", max_broadcast_rows=1)
        assert "BroadcastHashJoin" not in plan_text(big)
        assert big.exceptAll(small).count() == 0 and small.exceptAll(big).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_failed_diff_write_leaves_no_reject_folder(spark):
    import pytest

    from deltarecon.harness.queries import reconciliation
    from deltarecon.session import scratch_path

    rec = reconciliation(spark, SF_SMALL)
    result, rejects = scratch_path(spark, "result"), scratch_path(spark, "rejects")
    spark.createDataFrame([("x",)], "value string").write.text(result)  # result path already taken
    with pytest.raises(Exception):
        fr.write_reconciliation(rec, result, rejects)
    with pytest.raises(Exception):
        spark.read.text(rejects).count()  # rejects were never written


def test_diff_computes_the_left_side_once(spark):
    """Two branches, one dedup; a tie can't give different records to them."""
    from deltarecon.operators.dedup import latest_per_key
    from deltarecon.operators.reconcile import record_diff

    left = spark.range(400).selectExpr("id % 100 AS k", "cast(id % 2 AS string) AS v", "1 AS ts")
    right = spark.range(120).selectExpr("id AS k", "cast(id % 2 AS string) AS v")
    one = latest_per_key(left.repartition(7), "k", "ts", ())
    diff = record_diff(one, right, ("k", "v"), side_col="side")
    assert "Window" not in plan_text(diff)  # it ran once, before both branches
    rows = diff.collect()
    kept = [r.l_k for r in rows if r.l_k is not None]
    assert sorted(kept) == list(range(100))
    assert sorted(r.r_k for r in rows if r.r_k is not None) == list(range(120))


def test_diff_joins_on_one_hash(spark):
    from deltarecon.operators.reconcile import record_diff

    cols = [f"cast(id % {i + 2} AS string) AS c{i}" for i in range(27)]
    keys = [f"c{i}" for i in range(27)]
    plan = plan_text(record_diff(spark.range(50).selectExpr(*cols), spark.range(60).selectExpr(*cols), keys))
    joins = [x for x in plan.splitlines() if x.startswith("Left keys")]
    assert joins and all(x.count("_h") == 1 and "c26" not in x for x in joins)


def test_parent_check_uses_the_specs_key_rule(spark):
    feed = spark.createDataFrame(
        [("A", "", "1", "n", "2024-01-01", 1), ("B", "A", "1", "n", "2024-01-01", 2), ("C", "X", "1", "n", "2024-01-01", 3),
         (" A", "", "1", "n", "2024-01-01", 4)], "reg_no string, hq_no string, status_code string, reg_name string, ts_last_update string, version_id int")
    lookup = spark.createDataFrame([("1", "x")], "status_key string, status_description string")
    spec = fr.FeedSpec(columns=("reg_no", "hq_no", "status_code", "reg_name", "ts_last_update"), rules={}, trading_status=None)
    out = fr.accepted_and_rejected(fr.feed_flow(feed, lookup, spec), spec).collect()
    assert sorted((r.reg_no, r.rejected_branch_record) for r in out) == [("A", "N"), ("A", "N"), ("B", "N"), ("C", "Y")]


def test_named_master_mapping(spark):
    detail = spark.createDataFrame([(1, " n ", "x0y")], "id int, name string, code string")
    hub = spark.createDataFrame([(1, "SC123", "123")], "id int, a string, b string")
    mapping = fr.named_master_mapping({"id": "detail.id", "name": "detail.name", "pre": "remove_first(hub.a, hub.b)",
                                       "code": "remove_first(detail.code, '0')", "owner": "''"})
    assert tuple(fr.build_master(detail, hub, {}, "id", mapping).first()) == ("1", "n", "SC23", "xy", "")
    with pytest.raises(ValueError):
        fr.build_master(detail, hub, {}, "id", fr.named_master_mapping({"x": "other.id"}))


@pytest.mark.parametrize("fails", [False, True])
def test_scratch_is_deleted_after_the_write(spark, fails):
    from deltarecon.session import path_exists, scratch_path

    rec = fr.feed_reconciliation(fx.feed(spark, SF_SMALL), _lookup(spark), fx.master_detail(spark, SF_SMALL),
                                 fx.master_hub(spark, SF_SMALL), {"cir_src": fx.HUB_SOURCE}, fx.DIFF_KEYS)
    assert rec.scratch and all(path_exists(spark, p) for p in rec.scratch)
    out = scratch_path(spark, "diff")
    if fails:
        spark.range(1).write.parquet(out)
        with pytest.raises(Exception):
            fr.write_reconciliation(rec, out)
    else:
        fr.write_reconciliation(rec, out)
    assert not any(path_exists(spark, p) for p in rec.scratch)
