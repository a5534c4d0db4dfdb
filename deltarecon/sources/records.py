"""Typed reader of the delimited record files (diff results, reject records).

The lines are those of ``sinks.delimited``: fields as text, joined by U+0001, NULL as
``null``. Delimiters inside values aren't escaped by the writer, so a line can have
another number of fields than the record; such lines go to a side output and are
never cut or padded. A field that reads ``null`` is NULL: the text 'null' can't be told
from it, in any column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.formatting import NULL_TEXT, RECORD_DELIMITER

FILE, LINE = "record_file", "value"


@dataclass(frozen=True)
class Records:
    """``rows``: typed records. ``malformed``: the other lines, with what is wrong
    (``reason``) and the file they are in."""

    rows: DataFrame
    malformed: DataFrame


def _schema(spark: SparkSession, schema: StructType | str | Sequence[str]) -> StructType:
    if isinstance(schema, StructType):
        return schema
    if isinstance(schema, str):
        return StructType.fromDDL(schema)
    return StructType.fromDDL(", ".join(f"`{c}` string" for c in schema))


def parse_records(lines: DataFrame, schema: StructType | str | Sequence[str], sep: str = RECORD_DELIMITER,
                  null_text: str = NULL_TEXT) -> Records:
    """Splits text ``lines`` (column ``value``, optionally ``record_file``) into records.

    ``schema``: fields in file order, as a struct, DDL text, or names (all text). A line
    is malformed if it has another number of fields, or a field that its type can't
    read. Both outputs are lazy and read the same lines; nothing is shuffled.
    """
    fields = _schema(lines.sparkSession, schema).fields
    parts = F.split(F.col(LINE), "\\Q" + sep + "\\E", -1)
    file = F.col(FILE) if FILE in lines.columns else F.lit(None).cast("string")
    split = lines.select(F.col(LINE), file.alias(FILE), parts.alias("_parts"))

    def text(i: int) -> Column:
        return F.nullif(F.get("_parts", F.lit(i)), F.lit(null_text))

    read = [text(i).try_cast(f.dataType) for i, f in enumerate(fields)]
    arity = F.when(F.size("_parts") != len(fields), F.concat(
        F.size("_parts").cast("string"), F.lit(f" fields in place of {len(fields)}")))
    unread = [F.when(text(i).isNotNull() & c.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
              for i, (f, c) in enumerate(zip(fields, read))]
    reason = F.coalesce(arity, *unread)
    return Records(
        rows=split.filter(reason.isNull()).select(*[c.alias(f.name) for c, f in zip(read, fields)]),
        malformed=split.select(LINE, FILE, reason.alias("reason")).filter("reason is not null"))


def read_records(spark: SparkSession, path: str, schema: StructType | str | Sequence[str], sep: str = RECORD_DELIMITER,
                 null_text: str = NULL_TEXT) -> Records:
    """``parse_records`` of the files under ``path``, each line with its file's name."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias(FILE))
    return parse_records(lines, schema, sep, null_text)
