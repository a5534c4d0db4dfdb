"""Text sources, sinks, report and the streaming history."""

import pytest
from pyspark.sql import functions as F

from deltarecon.plans import report
from deltarecon.session import scratch_path
from deltarecon.sinks import append_history, write_count_rows, write_delimited
from deltarecon.sources import parse_fixed_width, parse_registry, preview, read_count_rows, read_count_tree
from deltarecon.streaming import append_new_counts, read_history

from .conftest import plan_text


def lines(spark, *xs):
    return spark.createDataFrame([(x,) for x in xs], "value string")


def test_registry_lines(spark):
    got = [tuple(r) for r in parse_registry(lines(spark, "q,E,p,c,u,d", "q,E,p,c,u,d,extra", "q,E,p,NA,NA,NA")).collect()]
    assert got == [("q", "E", "p", "c", "u", "d")] * 2 + [("q", "E", "p", None, None, None)]


@pytest.mark.parametrize("bad", ["q,E,p,c,u", ""])
def test_registry_short_line_fails(spark, bad):
    with pytest.raises(Exception):
        parse_registry(lines(spark, bad)).collect()


def test_fixed_width(spark):
    got = [tuple(r) for r in parse_fixed_width(lines(spark, "A1Active", "B2 Closed ", "1\tPartial\t", "\x01Z\x00 x", "  ")).collect()]
    assert got == [("A1", "Active"), ("B2", "Closed"), ("1", "Partial"), ("Z", "x"), ("", "")]


@pytest.mark.parametrize("short", ["Z", ""])
def test_fixed_width_short_line_fails(spark, short):
    with pytest.raises(Exception, match="shorter than 2"):
        parse_fixed_width(lines(spark, "A1Active", short)).collect()


def test_preview_orders_only_when_asked(spark):
    df = lines(spark, *[f"line{i:03d}" for i in range(50, 0, -1)])
    assert [r.value for r in preview(df, 3, order_by="value").collect()] == ["line001", "line002", "line003"]
    assert preview(df, 3).count() == 3
    path = scratch_path(spark, "preview")
    df.write.text(path)
    plan = plan_text(preview(spark.read.text(path), 3))
    assert "Limit" in plan and "Sort" not in plan and "TakeOrdered" not in plan


def _count_rows(spark):
    return spark.createDataFrame(
        [("E1", "p", 1, 2, 3, 4, 5, 6, "t"), ("E2", "q", None, 2, None, 4, None, None, "t")],
        "entity string, process string, inserts bigint, updates bigint, deletes bigint, "
        "total bigint, active bigint, inactive bigint, job_time string",
    )


def test_count_files_roundtrip_with_na(spark):
    base = scratch_path(spark, "runs")
    rows = _count_rows(spark)
    write_count_rows(rows.filter("entity = 'E1'"), f"{base}/a")
    write_count_rows(rows.filter("entity = 'E2'"), f"{base}/b")
    raw = spark.read.text(f"{base}/b").first().value
    assert raw == "E2,q,NA,2,NA,4,NA,NA,t"
    back = read_count_tree(spark, base)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_names_are_written_verbatim(spark):
    names = [" padded ", "NA", 'p"q', "back\\slash", ""]
    rows = spark.createDataFrame([(n, "NA", None, 1, 2, 3, 4, 5, "t") for n in names], _count_rows(spark).schema)
    path = scratch_path(spark, "names")
    write_count_rows(rows, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(f"{n},NA,NA,1,2,3,4,5,t" for n in names)
    assert sorted(read_count_rows(spark, path).collect()) == sorted(rows.collect())


@pytest.mark.parametrize("bad", ["E,p,xx,1,2,3,4,5,t", "E,p", "E,p,1,2,3,4,5,6,t,more"])
def test_malformed_count_lines_fail(spark, bad):
    landing = scratch_path(spark, "landing")
    lines(spark, bad).write.text(f"{landing}/run1")
    with pytest.raises(Exception):
        read_count_tree(spark, landing).collect()
    with pytest.raises(Exception):
        append_new_counts(spark, landing, scratch_path(spark, "h"), scratch_path(spark, "c"))


def test_stream_reads_two_levels_only(spark):
    landing = scratch_path(spark, "landing")
    hist, ckpt = scratch_path(spark, "h"), scratch_path(spark, "c")
    write_count_rows(_count_rows(spark), f"{landing}/run1")
    lines(spark, "no count line").coalesce(1).write.text(f"{landing}/run1/deep/deeper")
    assert append_new_counts(spark, landing, hist, ckpt) == 2


def test_history_forms_dont_mix(spark):
    landing, hist = scratch_path(spark, "landing"), scratch_path(spark, "h")
    write_count_rows(_count_rows(spark), f"{landing}/run1")
    append_new_counts(spark, landing, hist, scratch_path(spark, "c"))
    with pytest.raises(ValueError, match="stream"):
        append_history(_count_rows(spark), hist)
    batch = scratch_path(spark, "h2")
    append_history(_count_rows(spark), batch)
    with pytest.raises(ValueError, match="batch"):
        append_new_counts(spark, landing, batch, scratch_path(spark, "c2"))


def test_history_append_keeps_every_run(spark):
    path = scratch_path(spark, "hist")
    append_history(_count_rows(spark), path)
    append_history(_count_rows(spark), path)
    assert read_count_rows(spark, path).count() == 4


def test_report_rows(spark):
    base = scratch_path(spark, "runs")
    write_count_rows(_count_rows(spark), f"{base}/a")
    out = report.consolidate_and_publish(spark, base, scratch_path(spark, "cur"), scratch_path(spark, "hist"))
    r = {x.entity: x for x in out.collect()}
    assert r["E2"].inserts == "NA" and r["E2"].html_row.startswith("<tr>") and r["E2"].html_row.endswith("</tr>")


def test_delimited_sink_fails_if_exists(spark):
    path = scratch_path(spark, "rej")
    df = spark.createDataFrame([("a", None)], "x string, y string")
    write_delimited(df, path)
    assert spark.read.text(path).first().value == "a\u0001null"
    with pytest.raises(Exception):
        write_delimited(df, path)


def test_stream_history_appends_each_file_once(spark):
    landing = scratch_path(spark, "landing")
    hist, ckpt = scratch_path(spark, "shist"), scratch_path(spark, "sckpt")
    write_count_rows(_count_rows(spark), f"{landing}/run1")
    assert append_new_counts(spark, landing, hist, ckpt) == 2
    assert append_new_counts(spark, landing, hist, ckpt) == 0
    write_count_rows(_count_rows(spark).filter(F.col("entity") == "E1"), f"{landing}/run2")
    assert append_new_counts(spark, landing, hist, ckpt) == 1
    assert read_history(spark, hist).count() == 3


def test_registry_short_line_fails_without_ansi(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="fewer than six fields"):
            parse_registry(lines(spark, "q,E,p,c,u,d", "q,E,p")).select("deleted").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_history_by_day_is_idempotent(spark):
    from deltarecon.operators.deltas import COUNT_ROW_SCHEMA
    from deltarecon.sinks import replace_history_day
    from deltarecon.sources import read_history_by_day

    path = scratch_path(spark, "hist_day")
    day1 = _count_rows(spark).withColumn("job_time", F.lit("2024-01-01 06:00:00"))
    day2 = _count_rows(spark).withColumn("job_time", F.lit("2024-01-02 06:00:00"))
    replace_history_day(day1, path)
    replace_history_day(day2, path)
    replace_history_day(day1, path)
    back = read_history_by_day(spark, path)
    assert sorted(r.job_date for r in back.collect()) == ["2024-01-01"] * 2 + ["2024-01-02"] * 2
    assert "job_date" not in COUNT_ROW_SCHEMA.fieldNames()


def test_stream_history_bounded_batches(spark):
    landing = scratch_path(spark, "landing")
    hist, ckpt = scratch_path(spark, "shist"), scratch_path(spark, "sckpt")
    for i in range(3):
        write_count_rows(_count_rows(spark), f"{landing}/run{i}")
    assert append_new_counts(spark, landing, hist, ckpt, max_files_per_trigger=1) == 6
    assert append_new_counts(spark, landing, hist, ckpt, max_files_per_trigger=1) == 0
    assert read_history(spark, hist).count() == 6
