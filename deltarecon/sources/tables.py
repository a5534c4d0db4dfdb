"""Table scans and the registry's table resolver.

``TableResolver`` turns a registry row's ``(queue, process)`` into a
DataFrame. The default reads the catalog table ``queue.process`` with quoted
identifiers (never by splicing text into SQL); tests and the harness pass a
mapping of derived DataFrames instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TableResolver = Callable[[str, str], DataFrame]


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def catalog_resolver(spark: SparkSession) -> TableResolver:
    def resolve(queue: str, process: str) -> DataFrame:
        return spark.table(f"{_quote(queue)}.{_quote(process)}")

    return resolve


def mapping_resolver(tables: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> TableResolver:
    """Resolve by process name (``queue.process`` also accepted as a key)."""

    def resolve(queue: str, process: str) -> DataFrame:
        t = tables.get(f"{queue}.{process}", tables.get(process))
        if t is None:
            raise KeyError(f"no table for {queue}.{process}")
        return t() if callable(t) else t

    return resolve


def parquet_resolver(spark: SparkSession, base: str) -> TableResolver:
    """``base/queue/process`` Parquet folders."""

    def resolve(queue: str, process: str) -> DataFrame:
        return spark.read.parquet(f"{base.rstrip('/')}/{queue}/{process}")

    return resolve


def scan_filtered(df: DataFrame, **equalities: object) -> DataFrame:
    """``df`` where every ``column = value`` holds (pushed into Parquet scans)."""
    for c, v in equalities.items():
        df = df.filter(F.col(c) == F.lit(v))
    return df
