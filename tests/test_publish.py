"""Publishing, provenance, compaction, typed records, table resolution, narrow parent check."""

import re
import time

import pytest
from pyspark.sql import functions as F

from deltarecon.harness import fixtures as fx
from deltarecon.harness.queries import QUERIES, WIDE_SPEC, _lookup
from deltarecon.operators import deltas
from deltarecon.plans import delta_sweep, feed_reconciliation as fr
from deltarecon.session import path_exists, publish
from deltarecon.sinks import counts as sinks, delimited
from deltarecon.sources import counts as sources, records, tables

from .conftest import SF_SMALL, plan_text


def count_rows(spark, n=1, name="t"):
    return spark.createDataFrame(
        [("e", f"{name}{i}", 1, 2, None, 4, 5, 6, "2024-01-01 00:00:00") for i in range(n)],
        "entity string, process string, inserts long, updates long, deletes long, total long, active long, inactive long, "
        "job_time string")


def test_failed_publish_keeps_the_old_result(spark, tmp_path):
    path = str(tmp_path / "current")
    sinks.replace_current(count_rows(spark), path)
    broken = count_rows(spark).withColumn("total", F.raise_error(F.lit("no")).cast("bigint"))
    for write in (sinks.replace_current, sinks.write_count_rows):
        with pytest.raises(Exception, match="no"):
            write(broken, path)
    assert [r.process for r in sources.read_count_rows(spark, path).collect()] == ["t0"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["current"]  # nothing left beside it


def test_publish_replaces_and_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "current")
    sinks.replace_current(count_rows(spark), path)
    sinks.replace_current(sources.read_count_rows(spark, path).union(count_rows(spark, name="u")), path)
    assert sorted(r.process for r in sources.read_count_rows(spark, path).collect()) == ["t0", "u0"]


def test_interrupted_switch_is_mended(spark, tmp_path):
    path = str(tmp_path / "current")
    sinks.replace_current(count_rows(spark), path)
    (tmp_path / "current").rename(tmp_path / "current.before")  # killed between the two renames
    with pytest.raises(RuntimeError):
        publish(spark, path, lambda fresh: (_ for _ in ()).throw(RuntimeError))
    assert sources.read_count_rows(spark, path).count() == 1 and not path_exists(spark, path + ".before")


def test_errors_and_rows_name_their_file(spark, tmp_path):
    sinks.write_count_rows(count_rows(spark, 3), str(tmp_path / "a" / "run"))
    files = {r.count_file for r in sources.read_count_tree(spark, str(tmp_path), with_file=True).collect()}
    assert len(files) == 1 and "/a/run/part-" in files.pop()
    (tmp_path / "a" / "run2").mkdir()
    (tmp_path / "a" / "run2" / "bad.txt").write_text("only,three,fields\n")
    with pytest.raises(Exception, match="run2/bad.txt"):
        sources.read_count_tree(spark, str(tmp_path)).collect()


def test_compacted_history_keeps_its_lines(spark, tmp_path):
    path = str(tmp_path / "history")
    for i in range(5):
        sinks.append_history(count_rows(spark, name=f"run{i}_"), path)
    before = sorted(spark.read.text(path).collect())
    assert len(list((tmp_path / "history").glob("part-*"))) == 5
    sinks.compact_history(spark, path)
    assert len(list((tmp_path / "history").glob("part-*"))) == 1
    assert sorted(spark.read.text(path).collect()) == before
    sinks.append_history(count_rows(spark), path)
    assert spark.read.text(path).count() == 6


def test_records_come_back_typed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", None, 2.5), (2, "", "x", None), (None, "\u0001", "y", 1.0), (3, "two\nlines", "z", 0.0)],
                               "i int, s string, t string, d double")
    delimited.write_delimited(df, str(tmp_path / "out"))
    got = records.read_records(spark, str(tmp_path / "out"), df.schema)
    assert got.rows.dtypes == df.dtypes
    assert sorted(map(tuple, got.rows.collect())) == [(1, "a b", None, 2.5), (2, "", "x", None)]
    bad = {r.value: r.reason for r in got.malformed.collect()}
    assert bad == {"null\u0001\u0001\u0001y\u00011.0": "5 fields in place of 4", "3\u0001two": "2 fields in place of 4",
                   "lines\u0001z\u00010.0": "3 fields in place of 4"}
    assert all("/out/part-" in r.record_file for r in got.malformed.collect())


def test_fields_that_their_type_cant_read_go_aside(spark):
    lines = spark.createDataFrame([("1|2024-01-05",), ("x|2024-01-05",), ("2|no day",), ("null|null",), ("",)], "value string")
    got = records.parse_records(lines, "i int, day date", sep="|")
    assert sorted((r.i or 0, str(r.day)) for r in got.rows.collect()) == [(0, "None"), (1, "2024-01-05")]
    assert {r.value: r.reason for r in got.malformed.collect()} == {
        "x|2024-01-05": "i is no int", "2|no day": "day is no date", "": "1 fields in place of 2"}
    one = records.parse_records(lines, ["all"], sep="\u0001")
    assert one.rows.count() == 5 and one.malformed.count() == 0


def test_many_parquet_tables_are_planned_at_a_thousand_a_minute(spark, tmp_path):
    base = tmp_path / "base" / "q"
    spark.range(3).selectExpr("string(id) AS created", "string(id) AS updated", "0 AS deleted").coalesce(1).write.parquet(str(base / "t"))
    resolve = tables.parquet_resolver(spark, str(tmp_path / "base"))
    entries = [dict(queue="q", process="t", entity=f"e{i}", created="created", updated="updated", deleted="deleted") for i in range(300)]
    begun = time.time()
    rows = delta_sweep._count_rows(entries, resolve, "2024-01-01", "x", "since")
    assert len(rows) == 300 and time.time() - begun < 25


def test_all_failing_tables_are_named(spark, tmp_path):
    spark.range(1).selectExpr("string(id) AS c").write.parquet(str(tmp_path / "q" / "good"))
    registry = spark.createDataFrame([("q", "e", p, "c", "c", None) for p in ("good", "bad1", "bad2")],
                                     "queue string, entity string, process string, created string, updated string, deleted string")
    resolve = tables.parquet_resolver(spark, str(tmp_path))
    with pytest.raises(ExceptionGroup, match="2 of 3 tables.*q.bad1, q.bad2"):
        delta_sweep.run_delta_counts(registry, resolve, "2024-01-01", str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_totals_read_no_column(spark):
    """The total alone needs the row counts of the Parquet footers."""
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plan = plan_text(deltas.delta_counts(df, "2024-01-01", job_time="x"))
    assert re.findall(r"ReadSchema: (.*)", plan) == ["struct<>"]


def test_narrow_parent_check_gives_the_same_rows(spark):
    feed = fx.feed(spark, SF_SMALL)
    feed = feed.withColumn("reg_no", F.when(F.col("version_id") % 50 != 7, F.col("reg_no")))  # some keys NULL
    flow = fr.feed_flow(feed, _lookup(spark))
    wide = fr.accepted_and_rejected(flow, fr.FeedSpec(narrow_parent_check=False))
    narrow = fr.accepted_and_rejected(flow, fr.FeedSpec(narrow_parent_check=True))
    assert wide.exceptAll(narrow).count() == 0 and narrow.exceptAll(wide).count() == 0
    assert narrow.groupBy("rejected_branch_record").count().count() == 2


def test_narrow_parent_check_doesnt_shuffle_rows_by_parent(spark):
    """Of wide rows only the dedup's exchange is wide; all others carry keys and parents."""
    feed = fx.feed_wide(spark, SF_SMALL)
    flow = fr.feed_flow(feed, _lookup(spark), WIDE_SPEC)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(fr.accepted_and_rejected(flow, WIDE_SPEC))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[(\d+)\][^\n]*\nArguments: hashpartitioning\(([^\n]*)", plan)
    wide = [by for width, by in exchanges if int(width) > 5]
    assert len(exchanges) > 3 and wide and all(by.startswith("reg_no#") or "_jk" in by for by in wide), wide
    # The one by _jk is of the rows without a key, of which the filter leaves one at most.
    assert sum("_jk" in by for by in wide) <= 1


def test_new_queries_are_registered():
    assert {"diff_records_typed", "reject_records_malformed", "diff_single_nullable_key", "diff_mixed_key_types"} <= set(QUERIES)
