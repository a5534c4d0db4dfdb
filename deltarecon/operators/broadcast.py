"""Broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds under which a lookup side is shipped to every task.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (and, if given, at most
    ``max_bytes`` of field text).

    One job of partial sums per partition; no rows move. Bytes are the UTF-8
    length of every field rendered as text, a close measure of what a broadcast
    ships.
    """
    if max_bytes is None:
        return df.count() <= max_rows
    size = F.coalesce(F.sum(F.octet_length(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in df.columns]))),
                      F.lit(0))
    n, nbytes = df.agg(F.count(F.lit(1)), size).first()
    return n <= max_rows and nbytes <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df``.

    Beyond the bounds the join stays a shuffle join, which AQE may still turn
    into a broadcast from runtime sizes or split where skewed.
    """
    return F.broadcast(df) if has_at_most(df, max_rows, max_bytes) else df
