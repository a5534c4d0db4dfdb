"""Exactly-once history appends with Structured Streaming.

The batch history append adds whatever is in the current snapshot, so a
re-run appends the same day twice. Here the landing folder of per-run count
files is a file stream: each ``availableNow`` run appends only files not yet
recorded in the checkpoint, and the file sink's commit log makes the append
atomic. Re-running with nothing new appends nothing.

A history folder belongs to one of the two forms: the sink's log hides files
that a batch append adds, so each form refuses a folder of the other.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..session import path_exists
from ..sources.counts import count_line, parse_count_lines, read_count_rows


def count_file_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming count rows from ``landing/<run>/<files>``, two levels like the
    batch reader; a malformed line fails the query.

    ``max_files_per_trigger`` bounds each micro-batch; an ``availableNow``
    run then drains a large backlog in several bounded batches.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_count_lines(reader.text(f"{landing.rstrip('/')}/*/*"))


class _RowCount(StreamingQueryListener):
    """Input rows of one query over all its micro-batches (the query itself
    remembers only the last ones)."""

    def __init__(self) -> None:
        self.query_run = None
        self.rows: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.changed:
            run = str(event.progress.runId)
            self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def total(self, run: str, timeout: float) -> int:
        with self.changed:
            if not self.changed.wait_for(lambda: run in self.ended, timeout):
                raise TimeoutError("the query's end was not reported")
            return self.rows.get(run, 0)


def append_new_counts(spark: SparkSession, landing: str, history_path: str, checkpoint_path: str,
                      max_files_per_trigger: int | None = None) -> int:
    """Append count files that arrived since the last run; returns rows appended."""
    if path_exists(spark, history_path) and not path_exists(spark, f"{history_path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{history_path} was written by batch appends, which the stream's log would hide")
    counted = _RowCount()
    spark.streams.addListener(counted)
    try:
        q = (
            count_file_stream(spark, landing, max_files_per_trigger)
            .select(count_line().alias("value"))
            .writeStream.format("text")
            .option("checkpointLocation", checkpoint_path)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(history_path)
        )
        q.awaitTermination()
        return counted.total(str(q.runId), 60)
    finally:
        spark.streams.removeListener(counted)


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """Committed history rows (the sink's log hides partial writes)."""
    return read_count_rows(spark, history_path)
