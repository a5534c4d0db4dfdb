"""Count-row sinks: per-run output, current snapshot and history.

Count rows are one per registry table, so a single output file is cheap
(``coalesce(1)`` without a shuffle); record-level outputs never do this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, publish
from ..sources.counts import count_line


def _text(df: DataFrame, path: str, mode: str) -> None:
    df.select(count_line().alias("value")).coalesce(1).write.mode(mode).text(path)


def write_count_rows(df: DataFrame, path: str) -> None:
    """Replace ``path`` with one comma file of count rows (``NA`` for NULL).

    The old file stays until the new one is whole (``session.publish``)."""
    publish(df.sparkSession, path, lambda fresh: _text(df, fresh, "errorifexists"))


def replace_current(df: DataFrame, current_path: str) -> None:
    """Current snapshot = exactly these rows; ``df`` may read the old snapshot."""
    publish(df.sparkSession, current_path, lambda fresh: _text(df, fresh, "errorifexists"))


def compact_history(spark: SparkSession, history_path: str, max_files: int = 1) -> None:
    """Rewrites an ``append_history`` folder, which gains a file a run, as at most
    ``max_files`` files. Lines stay as they are; the old files stay until the new
    ones are whole. Not for a folder that a stream writes, nor while a run appends."""
    _no_stream(spark, history_path)
    publish(spark, history_path, lambda fresh: spark.read.text(history_path).coalesce(max_files).write.text(fresh))


def _no_stream(spark: SparkSession, path: str) -> None:
    if path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} was written by a stream, whose log would hide these rows; "
                         "append with append_new_counts or use another folder")


def append_history(df: DataFrame, history_path: str) -> None:
    """Append to the history; re-running a day appends it again (no dedup).

    For exactly-once appends of newly landed count files use
    ``deltarecon.streaming.history.append_new_counts``; for a re-runnable
    daily batch use ``replace_history_day``.
    """
    _no_stream(df.sparkSession, history_path)
    _text(df, history_path, "append")


def replace_history_day(df: DataFrame, history_path: str) -> None:
    """Idempotent history: one partition per job day (first ten characters
    of ``job_time``), written with dynamic partition overwrite, so running a
    day again replaces that day's rows and leaves every other day alone."""
    out = df.select(count_line().alias("value"), F.substring("job_time", 1, 10).alias("job_date"))
    (
        out.coalesce(1).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("job_date")
        .text(history_path)
    )
