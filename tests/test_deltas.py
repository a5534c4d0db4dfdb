"""Delta counts: edge rows, metric availability, one scan, exact-day mode."""

import pytest
from pyspark.sql import functions as F

from deltarecon.harness import fixtures as fx
from deltarecon.operators.deltas import COUNT_ROW_COLUMNS, day_count_row, delta_counts, delta_counts_separate

from .conftest import SF_SMALL, plan_text

EDGE = [
    ("2024-01-01 01", "2024-01-03 01", "N"),  # update
    ("2024-01-03", "2024-01-04", "N"),  # insert and update
    ("2024-01-03", "2024-01-03", "Y"),  # insert (same-day delete)
    (None, "2024-01-03", "N"),  # none
    ("2024-01-03", None, "N"),  # none
    ("2024-01-01", "2024-01-03", "Y"),  # delete
    ("2024-01-01", "2024-01-03", None),  # none
]


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(EDGE, "created string, updated string, deleted string")


def counts(df):
    r = df.first()
    return {c: r[c] for c in ("inserts", "updates", "deletes", "total", "active", "inactive")}


def test_edge_rows_since(edge):
    got = counts(delta_counts(edge, "2024-01-03", "created", "updated", "deleted", job_time="t"))
    assert got == {"inserts": 2, "updates": 2, "deletes": 1, "total": 7, "active": 4, "inactive": 2}


def test_edge_rows_on_day(edge):
    got = counts(delta_counts(edge, "2024-01-03", "created", "updated", "deleted", mode="on", job_time="t"))
    # exact-day inserts test only the created day; the NULL-updated row now counts
    assert got["inserts"] == 3
    assert got["updates"] == 1 and got["deletes"] == 1


def test_metric_availability(edge):
    no_del = counts(delta_counts(edge, "2024-01-03", "created", "updated", None))
    assert no_del["deletes"] is None and no_del["active"] is None and no_del["updates"] == 4
    only_del = counts(delta_counts(edge, "2024-01-03", None, None, "deleted"))
    assert only_del["inserts"] is None and only_del["updates"] is None and only_del["deletes"] is None
    assert only_del["active"] == 4 and only_del["total"] == 7
    none = counts(delta_counts(edge, "2024-01-03"))
    assert none == {"inserts": None, "updates": None, "deletes": None, "total": 7, "active": None, "inactive": None}


def test_schema_and_job_time(edge):
    df = delta_counts(edge, "2024-01-03", "created", "updated", "deleted", entity="E", process="p", job_time="2024-01-03 06:00:00")
    assert tuple(df.columns) == COUNT_ROW_COLUMNS
    assert dict(df.dtypes)["inserts"] == "bigint"
    r = df.first()
    assert (r.entity, r.process, r.job_time) == ("E", "p", "2024-01-03 06:00:00")


def test_one_scan_equals_six_jobs(spark):
    od = fx.orders_delta(spark, SF_SMALL)
    one = counts(delta_counts(od, fx.AS_OF_SINCE, "created", "updated", "deleted"))
    assert one == delta_counts_separate(od, fx.AS_OF_SINCE, "created", "updated", "deleted")


def test_one_scan_in_plan(spark):
    od = fx.orders_delta(spark, SF_SMALL)
    plan = plan_text(delta_counts(od, fx.AS_OF_SINCE, "created", "updated", "deleted"))
    import re

    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1


def test_typed_stamps_match_text_stamps(spark):
    ev = fx.events_delta(spark, SF_SMALL)
    typed = counts(delta_counts(ev, fx.AS_OF_EVENTS, "created", "updated", "deleted"))
    as_text = ev.selectExpr("cast(created as string) created", "cast(updated as string) updated", "deleted")
    assert typed == counts(delta_counts(as_text, fx.AS_OF_EVENTS, "created", "updated", "deleted"))


def test_missing_column_fails_at_analysis(edge):
    with pytest.raises(Exception):
        delta_counts(edge, "2024-01-03", "nope", "updated", "deleted").columns


def test_column_names_with_dots(spark):
    df = spark.createDataFrame(EDGE, "`c.at` string, `u at` string, `d.x` string")
    got = counts(delta_counts(df, "2024-01-03", "c.at", "u at", "d.x", job_time="t"))
    assert got == {"inserts": 2, "updates": 2, "deletes": 1, "total": 7, "active": 4, "inactive": 2}


def test_inserts_of_a_day_need_created_only(spark):
    df = spark.createDataFrame([("2024-01-15 10:00:00",), ("2024-01-14",), (None,)], "c string")
    on = delta_counts(df, "2024-01-15", "c", mode="on", job_time="t").first()
    assert (on.inserts, on.updates, on.deletes) == (1, None, None)
    assert delta_counts(df, "2024-01-15", "c", job_time="t").first().inserts is None
    row = day_count_row(delta_counts(df, "2024-01-15", "c", mode="on", entity="e", process="p"), "2024-01-15").first()
    assert tuple(row) == ("e", "p", 1, None, None, "2024-01-15")


@pytest.mark.parametrize("day", ["2024-01-15garbage", "2024-1-5", ""])
def test_as_of_must_be_a_day(spark, day):
    df = spark.createDataFrame([("2024-01-15",)], "c string")
    with pytest.raises(ValueError):
        delta_counts(df, day, "c", mode="on")


@pytest.mark.parametrize("mode", ["since", "on"])
@pytest.mark.parametrize("known", [("created", "updated", "deleted"), ("created", "updated", None), ("created", None, "deleted"),
                                   (None, "updated", "deleted"), (None, None, None)])
@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "mixed"])
def test_two_scans_count_alike(edge, mode, known, kind):
    if kind != "string":
        edge = edge.withColumn("created", F.col("created").substr(1, 10).cast("date" if kind == "mixed" else kind))
    if kind in ("date", "timestamp"):
        edge = edge.withColumn("updated", F.col("updated").substr(1, 10).cast(kind))
    one, two = (delta_counts(edge, "2024-01-03", *known, mode=mode, entity="e", process="p", job_time="t", pruned=p)
                for p in (False, True))
    assert one.collect() == two.collect() and one.dtypes == two.dtypes


def test_two_scans_on_odd_stamps_and_an_empty_table(spark):
    odd = ["", "2", "2024-01-0", "2024-01-03", "2024-01-03x", "2024-01-031", "2024-01-04", "\u00e9", " 2024-01-03", "NA", None]
    df = spark.createDataFrame([(c, u, f) for c in odd for u in odd for f in ("N", "Y", None)],
                               "created string, updated string, deleted string")
    for frame in (df, df.limit(0)):
        for mode in ("since", "on"):
            one, two = (counts(delta_counts(frame, "2024-01-03", "created", "updated", "deleted", mode=mode, pruned=p))
                        for p in (False, True))
            assert one == two


@pytest.mark.parametrize("kind, pushed", [("string", "GreaterThanOrEqual(updated,2024-01-03)"),
                                          ("timestamp", "GreaterThanOrEqual(updated,2024-01-03")])
def test_changes_are_read_behind_a_pushed_filter(edge, tmp_path, spark, kind, pushed):
    for c in ("created", "updated"):
        edge = edge.withColumn(c, F.col(c).substr(1, 10).cast(kind))
    edge.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_text(delta_counts(table, "2024-01-03", "created", "updated", "deleted", pruned=True))
    assert pushed in plan and "ReadSchema: struct<deleted:string>" in plan  # the other scan


def test_totals_read_no_column(edge, tmp_path, spark):
    edge.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert "ReadSchema: struct<>" in plan_text(delta_counts(table, "2024-01-03"))
    assert "ReadSchema: struct<>" in plan_text(delta_counts(table, "2024-01-03", "created", "updated", pruned=True))
