"""Column helpers shared by the operators of this folder."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Inside a lambda an outer expression would be evaluated again for every
    element; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` alone also folds other letters)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column, between: str = SPACE) -> Column:
    """What lies between the matches of ``between``, in order; empty for null.

    Splitting is several times faster here than extracting every match.
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def run_lengths(spans: Column) -> Column:
    """How many positions a set of half-open ``(s, e)`` spans covers."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, x: Column) -> Column:
        new = F.greatest(F.lit(0), x["e"] - F.greatest(acc["upto"], x["s"]))
        return F.struct(F.greatest(acc["upto"], x["e"]).alias("upto"), (acc["n"] + new).alias("n"))

    return F.aggregate(F.sort_array(spans), zero, step, lambda acc: acc["n"])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2``, ... that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out, i = name, 0
    while out.lower() in taken:
        i += 1
        out = f"{name}_{i}"
    return out
