"""Local stand-in for the driver's correctness gate: run a harness query and
its oracle at one scale and compare row count, column names and the
order-insensitive multiset of values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


# Spark simple type -> DuckDB type of the same values.
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def compare(spark: SparkSession, con, name: str, q, sql: str, sf_dir: str) -> dict:
    sdf = q(spark, sf_dir)
    scols = sdf.columns
    duck_types = dict(con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    type_diffs = [(c, t, duck_types.get(c)) for c, t in sdf.dtypes if DUCK_TYPES.get(t, t) != duck_types.get(c)]
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols), "types_match": not type_diffs}
    if type_diffs:
        res["type_diffs"] = type_diffs
    res["values_match"] = res["cols_match"] and Counter(_rows(scols, srows)) == Counter(_rows(dcols, drows))
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = scols, dcols
    elif not res["values_match"]:
        a, b = Counter(_rows(scols, srows)), Counter(_rows(dcols, drows))
        res["only_spark"] = list((a - b).items())[:3]
        res["only_oracle"] = list((b - a).items())[:3]
    return res
