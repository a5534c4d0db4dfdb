"""Count rows written by the delta-count job: comma text, ``NA`` for an unavailable count.

Names are text as they are in the registry (a name may be padded, quoted or the
word ``NA``); only the six count columns know ``NA``. A line with another
number of fields, or with a count that is no number, fails the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formatting import NA_TEXT
from ..operators.deltas import COUNT_COLUMNS, COUNT_ROW_COLUMNS


FILE = "count_file"  # the file that a row was read from


def count_line() -> Column:
    """One count row as a line of text."""
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit(NA_TEXT)) for c in COUNT_ROW_COLUMNS])


def parse_count_lines(lines: DataFrame, *keep: str) -> DataFrame:
    """Typed count rows of text lines (column ``value``); ``keep`` columns are passed on."""
    fields = F.split("value", ",", -1)

    file = F.concat(F.lit(" in "), F.col(FILE)) if FILE in lines.columns else F.lit("")

    def bad(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(what), file, F.lit(": "), F.col("value")))

    def count(text: Column) -> Column:
        number = text.rlike("^-?[0-9]+$")
        return F.when(text == NA_TEXT, F.lit(None).cast("bigint")).when(number, text.cast("bigint")).otherwise(
            bad("count is no number").cast("bigint"))

    rows = lines.filter("value <> ''").select(
        F.when(F.size(fields) == len(COUNT_ROW_COLUMNS), fields).otherwise(
            bad("count line without nine fields").cast("array<string>")).alias("_f"), "value",
        *[c for c in (FILE,) if c in lines.columns and c not in keep], *keep)
    cols = [count(F.col("_f")[i]) if c in COUNT_COLUMNS else F.col("_f")[i] for i, c in enumerate(COUNT_ROW_COLUMNS)]
    return rows.select(*[c.alias(n) for c, n in zip(cols, COUNT_ROW_COLUMNS)], *keep)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias(FILE))


def read_count_rows(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """Typed count rows from one folder, file or glob (``_SUCCESS`` skipped). Errors name
    the file; ``with_file`` adds it to the rows as ``count_file``."""
    return parse_count_lines(_lines(spark, path), *([FILE] if with_file else []))


def read_count_tree(spark: SparkSession, base: str, with_file: bool = False) -> DataFrame:
    """Every count file two levels below ``base`` (one folder per process run)."""
    return read_count_rows(spark, f"{base.rstrip('/')}/*/*", with_file)


def read_history_by_day(spark: SparkSession, path: str) -> DataFrame:
    """History written by ``replace_history_day`` (``job_date`` partitions as text)."""
    return parse_count_lines(spark.read.schema("value string, job_date string").text(path), "job_date")
