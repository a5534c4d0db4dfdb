"""Daily count report: consolidate per-run count files, keep a current
snapshot and an append-only history, and render report rows.

Kerberos, mail delivery and the HTML page frame are outside the library;
it produces the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formatting import html_row, na_text
from ..sinks.counts import append_history, replace_current
from ..sources.counts import read_count_rows, read_count_tree

REPORT_COLUMNS = ("entity", "process", "inserts", "updates", "deletes")


def report_current(counts: DataFrame) -> DataFrame:
    """The five report fields as text, ``NA`` where a metric is not available."""
    return counts.select(
        F.col("entity"), F.col("process"),
        *[na_text(c).alias(c) for c in ("inserts", "updates", "deletes")],
    )


def report_html_rows(current: DataFrame) -> DataFrame:
    """One HTML table row per count row (``html_row`` column)."""
    return current.select(*REPORT_COLUMNS, html_row(list(REPORT_COLUMNS)).alias("html_row"))


def consolidate_and_publish(spark: SparkSession, runs_base: str, current_path: str, history_path: str) -> DataFrame:
    """Replace the current snapshot with every run's rows, append it to the
    history, and return the report rows read from the new snapshot."""
    replace_current(read_count_tree(spark, runs_base), current_path)
    current = read_count_rows(spark, current_path)
    append_history(current, history_path)
    return report_html_rows(report_current(current))
