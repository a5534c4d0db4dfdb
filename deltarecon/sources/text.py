"""Plain text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def preview(lines: DataFrame, n: int = 10, order_by: str | None = None) -> DataFrame:
    """First ``n`` lines as read (a limit, which stops after the first
    partitions). With ``order_by`` the first ``n`` in that order: a top-k that
    reads every line, for a stable answer."""
    if order_by:
        lines = lines.orderBy(F.col(order_by))
    return lines.limit(n)
