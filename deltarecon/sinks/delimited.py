"""Delimited record sink (reject records, diff results).

Each row becomes one text line: every field as text, NULL printed as
``null``, fields joined by U+0001. Delimiters inside values are not escaped
(kept from the reference). Writing stays parallel: one file per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.formatting import NULL_TEXT, RECORD_DELIMITER, delimited_line


def to_delimited(df: DataFrame, sep: str = RECORD_DELIMITER, null_text: str = NULL_TEXT,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """One ``value`` string column per row."""
    cols = list(columns) if columns is not None else df.columns
    return df.select(delimited_line(cols, sep, null_text).alias("value"))


def write_delimited(df: DataFrame, path: str, mode: str = "errorifexists", sep: str = RECORD_DELIMITER,
                    null_text: str = NULL_TEXT) -> None:
    """Write delimited lines; by default fail when ``path`` already exists."""
    to_delimited(df, sep, null_text).write.mode(mode).text(path)
