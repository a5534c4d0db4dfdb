"""Entity registry: which tables to count and which columns hold the stamps.

Each line is ``queue,entity,process,created,updated,deleted``: positional,
no header, no quoting, no trimming. Fields after the sixth are ignored; a
line with fewer than six fields fails the read, as the reference job did. ``NA`` means "column not available" and becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_COLUMNS = ("queue", "entity", "process", "created", "updated", "deleted")

# Fixed value: registry text for "column not available".
NOT_AVAILABLE = "NA"


def parse_registry(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Split comma lines into the six registry columns.

    A line with fewer than six fields raises an error whatever the session's
    ANSI setting. The check sits in every output column, so it holds even
    when only some columns are selected.
    """
    parts = F.split(F.col(value_col), ",", -1)
    short = F.size(parts) < len(REGISTRY_COLUMNS)
    error = F.raise_error(F.concat(F.lit("registry line has fewer than six fields: "), F.col(value_col)))
    cols = []
    for i, name in enumerate(REGISTRY_COLUMNS):
        v = F.when(short, error).otherwise(parts[i])
        if name in ("created", "updated", "deleted"):
            v = F.nullif(v, F.lit(NOT_AVAILABLE))
        cols.append(v.cast("string").alias(name))
    return lines.select(*cols)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return parse_registry(spark.read.text(path))
