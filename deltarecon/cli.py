"""Command-line jobs (run with spark-submit or ``python -m deltarecon.cli``).

``counts``     registry file -> one count file (one row per registered table)
``reconcile``  feed + status lookup + master tables -> delimited diff and rejects
``report``     per-run count folders -> current snapshot, history, report rows
``preview``    first lines of a text file

Tables are catalog names (``db.table``) or Parquet paths (anything with a
``/``). The session comes from the launcher, so cluster settings and
``spark.checkpoint.dir`` are whatever spark-submit provides.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from .plans.delta_sweep import run_delta_counts
from .functions import rules as rule_functions
from .plans.feed_reconciliation import (
    FeedSpec, feed_reconciliation, named_master_mapping, write_reconciliation)
from .plans.report import consolidate_and_publish
from .sources.fixed_width import read_fixed_width
from .sources.registry import read_registry
from .sources.tables import catalog_resolver, parquet_resolver
from .sources.text import preview, read_lines


def _table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def _pairs(items: list[str]) -> dict[str, str]:
    out = {}
    for it in items or []:
        k, _, v = it.partition("=")
        out[k] = v
    return out


def cmd_counts(spark: SparkSession, a: argparse.Namespace) -> None:
    resolve = parquet_resolver(spark, a.parquet_base) if a.parquet_base else catalog_resolver(spark)
    as_of = a.as_of or dt.date.today().isoformat()
    run_delta_counts(read_registry(spark, a.registry), resolve, as_of, a.output, job_time=a.job_time,
                     mode=a.mode, pruned=a.pruned)


RULE_NAMES = ("suffix_key", "suffix_nonzero", "zero_to_blank", "strip_letters", "trim_keep_ws", "trim_text")


def spec_from_json(text: str) -> FeedSpec:
    """FeedSpec from JSON: the FeedSpec fields, with ``rules`` as
    ``{column: rule name}`` (names from ``deltarecon.functions.rules``)."""
    raw = json.loads(text)
    rules = {}
    for col, name in raw.pop("rules", {}).items():
        if name not in RULE_NAMES:
            raise ValueError(f"unknown rule {name!r} for {col!r}; choose from {RULE_NAMES}")
        rules[col] = getattr(rule_functions, name)
    for k in ("tiebreak", "columns"):
        if k in raw:
            raw[k] = tuple(raw[k])
    return FeedSpec(**raw, **({"rules": rules} if rules else {}))


def _text_or_file(text: str) -> str:
    if text.lstrip().startswith("{"):
        return text
    with open(text) as f:
        return f.read()


def cmd_reconcile(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.spec_json:
        spec = spec_from_json(_text_or_file(a.spec_json))
    else:
        spec = FeedSpec(tiebreak=tuple(a.tiebreak.split(",")) if a.tiebreak else ())
    master = {"master_key": a.master_key}
    if a.master_json:
        master["master_mapping"] = named_master_mapping(json.loads(_text_or_file(a.master_json)))
    rec = feed_reconciliation(
        _table(spark, a.feed), read_fixed_width(spark, a.lookup),
        _table(spark, a.detail), _table(spark, a.hub), _pairs(a.hub_filter),
        a.diff_keys.split(","), spec, **master,
    )
    write_reconciliation(rec, a.result, a.rejects, mode=a.mode)


def cmd_report(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = consolidate_and_publish(spark, a.runs, a.current, a.history)
    rows.select("html_row").write.mode("overwrite").text(a.report)


def cmd_preview(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = read_lines(spark, a.path)
    rows = preview(lines, a.n).collect() if a.ordered else lines.take(a.n)  # at most n rows
    for r in rows:
        print(r.value)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="deltarecon")
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("counts", help="count changes of every registered table")
    c.add_argument("registry")
    c.add_argument("output")
    c.add_argument("--as-of", help="day yyyy-MM-dd (default: today)")
    c.add_argument("--job-time", help="text for the job_time column (default: now)")
    c.add_argument("--mode", choices=["since", "on"], default="since")
    c.add_argument("--pruned", action="store_true", help="two scans a table, the changes behind a filter")
    c.add_argument("--parquet-base", help="read base/queue/process Parquet folders instead of catalog tables")
    c.set_defaults(run=cmd_counts)

    r = sub.add_parser("reconcile", help="clean the feed and diff it against the master")
    r.add_argument("--feed", required=True)
    r.add_argument("--lookup", required=True, help="fixed-width status lookup text file")
    r.add_argument("--detail", required=True)
    r.add_argument("--hub", required=True)
    r.add_argument("--hub-filter", action="append", metavar="COL=VALUE")
    r.add_argument("--diff-keys", required=True, help="comma-separated compare columns")
    r.add_argument("--tiebreak", default="version_id", help="comma-separated tie-break columns ('' for none)")
    r.add_argument("--spec-json", help="FeedSpec as JSON text or a JSON file path (column roles, columns, rules)")
    r.add_argument("--master-key", default="cir_key", help="key column of the detail and hub tables")
    r.add_argument("--master-json", help="master columns as JSON text or a JSON file path: output column -> "
                                         "'detail.col', 'hub.col', a quoted constant, or remove_first(side.col, ...)")
    r.add_argument("--result", required=True)
    r.add_argument("--rejects")
    r.add_argument("--mode", default="errorifexists")
    r.set_defaults(run=cmd_reconcile)

    rp = sub.add_parser("report", help="consolidate count files and render report rows")
    rp.add_argument("runs", help="folder with one sub-folder of count files per run")
    rp.add_argument("current")
    rp.add_argument("history")
    rp.add_argument("report", help="output folder for the HTML table rows")
    rp.set_defaults(run=cmd_report)

    pv = sub.add_parser("preview", help="print the first lines of a text file")
    pv.add_argument("path")
    pv.add_argument("-n", type=int, default=10)
    pv.add_argument("--ordered", action="store_true", help="first n in value order instead of file order")
    pv.set_defaults(run=cmd_preview)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"deltarecon-{a.cmd}").getOrCreate()
    a.run(spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
