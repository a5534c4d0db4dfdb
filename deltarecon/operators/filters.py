"""Blank / non-blank record filters and the valid-reject split.

SQL three-valued logic decides where NULL goes: ``c != ''`` and ``c = ''``
are both NULL for a NULL value, so by default a NULL name is in neither
output (it is dropped, as in the reference job). ``null_to='reject'`` sends
it to the reject side instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_not_blank(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c != F.lit("")


def is_blank(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c == F.lit("")


def filter_not_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is not the empty string (NULL removed, spaces kept)."""
    return df.filter(is_not_blank(col))


def filter_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is exactly the empty string (NULL not included)."""
    return df.filter(is_blank(col))


def split_valid_reject(df: DataFrame, col: str, null_to: str = "drop") -> tuple[DataFrame, DataFrame]:
    """``(valid, reject)`` views of one input.

    Both are lazy filters of the same plan: Spark pushes each predicate into
    its own scan. ``null_to``: ``'drop'`` (default) or ``'reject'``.
    """
    if null_to not in ("drop", "reject"):
        raise ValueError("null_to must be 'drop' or 'reject'")
    valid = filter_not_blank(df, col)
    reject_pred = is_blank(col)
    if null_to == "reject":
        reject_pred = reject_pred | F.col(col).isNull()
    return valid, df.filter(reject_pred)


def split_counts(df: DataFrame, col: str) -> DataFrame:
    """One row: how many values are non-blank, blank and NULL (single pass)."""
    return df.agg(
        F.count_if(is_not_blank(col)).alias("valid"),
        F.count_if(is_blank(col)).alias("rejected"),
        F.count_if(F.col(col).isNull()).alias("dropped_null"),
        F.count(F.lit(1)).alias("total"),
    )
