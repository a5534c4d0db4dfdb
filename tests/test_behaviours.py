"""Reference behaviours that decide results, kept or fixed."""

from deltarecon.operators import filters
from deltarecon.plans import feed_reconciliation as fr

FEED_SCHEMA = ("reg_no string, hq_no string, parent_no string, status_code string, reg_name string, "
               "country string, trading_status string, cro_number string, ts_last_update string, version_id bigint")


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


def lookup(spark):
    return spark.createDataFrame([("1P", "Partial")], "status_key string, status_description string")


def test_b8_null_names_dropped_or_rejected(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), ("  ",)], "n string")
    valid, reject = filters.split_valid_reject(df, "n")
    assert sorted(r.n for r in valid.collect()) == ["  ", "a"] and [r.n for r in reject.collect()] == [""]
    _, reject2 = filters.split_valid_reject(df, "n", null_to="reject")
    assert sorted("<null>" if r.n is None else r.n for r in reject2.collect()) == ["", "<null>"]


def test_b10_unknown_status_still_counts_as_parent(spark):
    rows = [
        ("100", "", "", "9X", " Head ", "01", "5", "00000100", "2024-01-01", 1),  # status not in lookup
        ("101", "100", "", "1P", " Branch ", "01", "5", "00000101", "2024-01-01", 2),
    ]
    out = fr.accepted_and_rejected(fr.feed_flow(feed(spark, rows), lookup(spark))).collect()
    assert [(r.reg_no, r.rejected_branch_record) for r in out] == [("101D", "N")]


def test_b13_trim_then_remove_vs_remove_then_trim(spark):
    rows = [("200", "", "", "1P", "X", "01", "0 A", "1", "2024-01-01", 1)]
    feed_side = fr.accepted_and_rejected(fr.feed_flow(feed(spark, rows), lookup(spark))).first()
    assert feed_side.trading_status == " A"  # trim first ("0 A"), then drop the "0"
    detail = spark.createDataFrame([(1, "X", "01", "0 A")], "cir_key bigint, reg_name string, country string, trading_status string")
    hub = spark.createDataFrame([(1, "S", "A", "1D", "1", "1", "", "S1")],
                                "cir_key bigint, cir_src string, status string, src_key1 string, src_key2 string, "
                                "src_key3 string, src_key4 string, src_key5 string")
    master_side = fr.build_master(detail, hub, {"cir_src": "S"}).first()
    assert master_side.trading_status == "A"  # drop first, then trim


def test_b14_padded_ids_keep_padding(spark):
    rows = [(" 300", "", "", "1P", "X", "01", "5", "1", "2024-01-01", 1)]
    std = fr.feed_flow(feed(spark, rows), lookup(spark))["std"].first()
    assert std.reg_no == " 300D"


def test_b16_timestamps_render_without_fraction(spark):
    from deltarecon.functions.formatting import delimited_line

    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05' AS t, CAST(NULL AS STRING) AS s")
    assert df.select(delimited_line(["t", "s"])).first()[0] == "2024-01-02 03:04:05\u0001null"


def test_all_null_stamp_key_vanishes_from_feed_and_parents(spark):
    rows = [
        ("400", "", "", "1P", "H", "01", "5", "1", None, 1),  # stamp NULL: key vanishes
        ("401", "400", "", "1P", "B", "01", "5", "1", "2024-01-01", 2),
    ]
    out = fr.accepted_and_rejected(fr.feed_flow(feed(spark, rows), lookup(spark))).collect()
    assert [(r.reg_no, r.rejected_branch_record) for r in out] == [("401D", "Y")]


def test_zero_head_office_is_blank_and_accepted(spark):
    rows = [("500", "000000000", "", "1P", "H", "01", "5", "1", "2024-01-01", 1)]
    out = fr.accepted_and_rejected(fr.feed_flow(feed(spark, rows), lookup(spark))).first()
    assert (out.hq_no, out.rejected_branch_record) == ("", "N")


def test_custom_feed_spec_with_renamed_columns(spark):
    from pyspark.sql import functions as F

    from deltarecon.functions import strip_letters, suffix_key, suffix_nonzero, trim_keep_ws, zero_to_blank
    from deltarecon.harness import fixtures as fx
    from deltarecon.harness.queries import _lookup

    from .conftest import SF_SMALL

    names = {"reg_no": "record_id", "hq_no": "head_office_id", "parent_no": "parent_id", "status_code": "status",
             "reg_name": "name", "country": "country", "trading_status": "trading", "cro_number": "registration_no",
             "ts_last_update": "last_update", "version_id": "load_seq"}
    feed = fx.feed(spark, SF_SMALL)
    renamed = feed.select(*[F.col(k).alias(v) for k, v in names.items()])
    spec = fr.FeedSpec(
        key="record_id", ts="last_update", tiebreak=("load_seq",), name="name", status="status",
        parent="head_office_id", trading_status="trading",
        columns=tuple(names[c] for c in fr.FEED_COLUMNS),
        rules={"record_id": suffix_key, "head_office_id": suffix_nonzero, "parent_id": suffix_key,
               "status": strip_letters, "name": trim_keep_ws, "registration_no": zero_to_blank},
    )
    custom = fr.accepted_and_rejected(fr.feed_flow(renamed, _lookup(spark), spec), spec)
    default = fr.accepted_and_rejected(fr.feed_flow(feed, _lookup(spark)))
    back = custom.select(*[F.col(names.get(c, c)).alias(c) for c in default.columns])
    assert back.exceptAll(default).count() == 0 and default.exceptAll(back).count() == 0
