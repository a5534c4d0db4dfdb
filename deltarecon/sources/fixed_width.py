"""Fixed-width code lookup: the first ``key_width`` characters are the key,
the rest of the line the description.

Both are stripped of every character up to the space at both ends (tabs and
control characters too). A line shorter than the key fails the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what is stripped from both ends.
_EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def parse_fixed_width(
    lines: DataFrame,
    key_width: int = 2,
    key_col: str = "status_key",
    desc_col: str = "status_description",
    value_col: str = "value",
) -> DataFrame:
    v = F.col(value_col)
    short = F.raise_error(F.concat(F.lit(f"lookup line shorter than {key_width} characters: "), v)).cast("string")
    return lines.select(
        F.when(F.length(v) >= key_width, _strip(F.substring(v, 1, key_width))).otherwise(short).alias(key_col),
        _strip(v.substr(F.lit(key_width + 1), F.length(v))).alias(desc_col),
    )


def read_fixed_width(spark: SparkSession, path: str, key_width: int = 2, **names: str) -> DataFrame:
    return parse_fixed_width(spark.read.text(path), key_width, **names)
