"""The command-line jobs, end to end on Parquet copies of the fixtures."""

from deltarecon import cli
from deltarecon.harness import fixtures as fx
from deltarecon.harness.queries import reconciliation, sweep
from deltarecon.session import scratch_path
from deltarecon.sources import read_count_rows

from .conftest import SF_SMALL


def _text(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_counts_job(spark):
    base = scratch_path(spark, "tables")
    for line in fx.REGISTRY_LINES:
        queue, _, process = line.split(",")[:3]
        fx.DELTA_TABLES[process](spark, SF_SMALL).write.parquet(f"{base}/{queue}/{process}")
    out = scratch_path(spark, "counts")
    cli.main(["counts", _text(spark, fx.REGISTRY_LINES, "registry"), out, "--as-of", fx.AS_OF_SINCE,
              "--job-time", fx.JOB_TIME, "--parquet-base", base], spark=spark)
    assert sorted(read_count_rows(spark, out).collect()) == sorted(sweep(spark, SF_SMALL).collect())


def test_reconcile_and_report_jobs(spark):
    paths = {}
    for name, f in (("feed", fx.feed), ("detail", fx.master_detail), ("hub", fx.master_hub)):
        paths[name] = scratch_path(spark, name)
        f(spark, SF_SMALL).write.parquet(paths[name])
    result, rejects = scratch_path(spark, "result"), scratch_path(spark, "rejects")
    cli.main(["reconcile", "--feed", paths["feed"], "--lookup", _text(spark, fx.STATUS_LOOKUP_LINES, "lookup"),
              "--detail", paths["detail"], "--hub", paths["hub"],
              "--hub-filter", f"cir_src={fx.HUB_SOURCE}", "--hub-filter", f"status={fx.HUB_ACTIVE}",
              "--diff-keys", ",".join(fx.DIFF_KEYS), "--result", result, "--rejects", rejects], spark=spark)
    rec = reconciliation(spark, SF_SMALL)
    assert spark.read.text(result).count() == rec.diff.count()
    assert spark.read.text(rejects).count() == rec.rejects.count()

    runs = scratch_path(spark, "runs")
    sweep(spark, SF_SMALL).coalesce(1).write.option("nullValue", "NA").csv(f"{runs}/run1")
    report = scratch_path(spark, "report")
    cli.main(["report", runs, scratch_path(spark, "current"), scratch_path(spark, "history"), report], spark=spark)
    rows = [r.value for r in spark.read.text(report).collect()]
    assert len(rows) == len(fx.REGISTRY_LINES) and all(r.startswith("<tr>") for r in rows)


def test_preview_job(spark, capsys):
    path = _text(spark, [f"line{i:02d}" for i in range(30)], "lines")
    cli.main(["preview", path, "-n", "3"], spark=spark)
    assert capsys.readouterr().out.split() == ["line00", "line01", "line02"]


def test_spec_from_json():
    import pytest

    from deltarecon.functions import rules

    spec = cli.spec_from_json('{"key": "rid", "ts": "t", "tiebreak": ["seq"], "columns": ["rid", "t"], '
                              '"rules": {"rid": "suffix_key"}}')
    assert spec.key == "rid" and spec.tiebreak == ("seq",) and spec.rules == {"rid": rules.suffix_key}
    with pytest.raises(ValueError):
        cli.spec_from_json('{"rules": {"x": "eval"}}')
