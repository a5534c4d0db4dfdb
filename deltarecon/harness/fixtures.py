"""Test inputs derived from the driver tables (``/root/testdata/sf*/``).

Each fixture exists twice: as a Spark derivation (``(spark, sf_dir) ->
DataFrame``) and as the same derivation in SQL text, used as a CTE by the
DuckDB oracles. Keep both in step; the rules are written out in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values used by the harness queries.
AS_OF_SINCE = "1998-06-15"
AS_OF_ON_DAY = "2001-07-30"
AS_OF_EVENTS = "2024-01-15"
JOB_TIME = "2024-01-15 06:00:00"
JOB_TIME_NEXT_DAY = "2024-01-16 06:00:00"
STATUS_LOOKUP_LINES = ("1PPartial", "2FFulfilled")
HUB_SOURCE = "SRC_A"
HUB_ACTIVE = "A"

# Registry rows: queue, entity, process, created, updated, deleted (NA = none).
REGISTRY_LINES = (
    "sales,orders,orders_delta,created,updated,deleted",
    "sales,lines,lineitem_delta,created,updated,NA",
    "web,events,events_delta,created,updated,deleted",
    "crm,customer,customer_totals,NA,NA,NA",
)

# Diff keys of the harness (the columns both sides carry).
DIFF_KEYS = ("reg_no", "hq_no", "status_code", "reg_name", "country")


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read once per process and passed on
    later reads, which skips Spark's footer-reading schema job (the test
    tables are read-only)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _lpad(c, n: int):
    return F.lpad(c.cast("string"), n, "0")


def _add_days(ts, n):
    return F.timestamp_add("DAY", n, ts)


# --- delta-count tables -----------------------------------------------------

def orders_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("string").alias("created"),
        _add_days(F.col("o_orderdate"), F.col("o_orderkey") % 4).cast("string").alias("updated"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("deleted"),
    )


def lineitem_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").cast("string").alias("created"),
        _add_days(F.col("l_shipdate"), F.col("l_linenumber") % 3).cast("string").alias("updated"),
    )


def events_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created"),
        _add_days(F.col("ts"), F.col("event_id") % 3).alias("updated"),
        F.when(F.col("event_type") == "error", "Y").otherwise("N").alias("deleted"),
    )


def customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))


DELTA_TABLES = {
    "orders_delta": orders_delta,
    "lineitem_delta": lineitem_delta,
    "events_delta": events_delta,
    "customer_totals": customer_totals,
}


# --- feed / master ----------------------------------------------------------

def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company-register feed: every order is one version of its customer's record."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k = F.col("o_custkey")
    hq = (
        F.when(k % 10 == 0, F.lit("000000000"))
        .when(k % 10 == 1, F.lit(""))
        .when(k % 10 == 2, _lpad(k + 100000, 9))
        .otherwise(_lpad(F.expr("o_custkey div 10") * 10, 9))
    )
    name = (
        F.when(k % 50 == 7, F.lit(""))
        .when(k % 50 == 9, F.lit(None).cast("string"))
        .when(k % 50 == 11, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
    )
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        _lpad(k, 9).alias("reg_no"),
        hq.alias("hq_no"),
        F.when(k % 3 == 0, F.lit("")).otherwise(_lpad(F.expr("o_custkey div 100") * 100, 9)).alias("parent_no"),
        F.when(F.col("o_orderstatus") == "P", "1P")
        .when(F.col("o_orderstatus") == "F", "2F")
        .when(F.col("o_orderstatus") == "O", "3O")
        .alias("status_code"),
        name.alias("reg_name"),
        _lpad(F.col("c_nationkey"), 2).alias("country"),
        (F.col("o_orderkey") % 20).cast("string").alias("trading_status"),
        F.when(k % 7 == 0, F.lit("00000000")).otherwise(_lpad(k, 8)).alias("cro_number"),
        F.col("o_orderdate").alias("ts_last_update"),
        F.col("o_orderkey").alias("version_id"),
    )


def _master_ids(k):
    reg_no = F.concat(_lpad(k, 9), F.lit("D"))
    hq_no = (
        F.when((k % 10 == 0) | (k % 10 == 1), F.lit(""))
        .when(k % 10 == 2, F.concat(_lpad(k + 100000, 9), F.lit("D")))
        .when(k % 100 == 3, F.lit("999999999D"))
        .otherwise(F.concat(_lpad(F.expr("c_custkey div 10") * 10, 9), F.lit("D")))
    )
    status = F.when(k % 2 == 0, F.lit("1")).otherwise(F.lit("2"))
    return reg_no, hq_no, status


def master_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("cir_key"),
        F.col("c_name").alias("reg_name"),
        _lpad(F.col("c_nationkey"), 2).alias("country"),
        (k % 20).cast("string").alias("trading_status"),
    )


def master_hub(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    reg_no, hq_no, status = _master_ids(k)
    src_key3 = _lpad(k, 8)
    return c.select(
        k.alias("cir_key"),
        F.when(k % 5 == 4, F.lit("SRC_B")).otherwise(F.lit("SRC_A")).alias("cir_src"),
        F.when(k % 11 == 0, F.lit("I")).otherwise(F.lit("A")).alias("status"),
        reg_no.alias("src_key1"),
        status.alias("src_key2"),
        src_key3.alias("src_key3"),
        hq_no.alias("src_key4"),
        F.concat(F.lit("SC"), src_key3).alias("src_key5"),
    )


# --- wide register: 37 feed columns, 31 master columns, 27 diff keys -----------

EXTRAS = tuple(f"a{i:02d}" for i in range(1, 29))
WIDE_MASTER_EXTRAS = EXTRAS[:20]
WIDE_DIFF_KEYS = (*DIFF_KEYS, "trading_status", "cro_number", *WIDE_MASTER_EXTRAS)


def _extra_number(i: int, k):
    return (k * (i + 3)) % (50 + i)


def feed_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with 28 more raw columns, of four kinds in turn: with an id suffix to
    come, zeros to blank, with letters to strip, padded."""
    k = F.col("reg_no").cast("long")

    def raw(i: int):
        v = _extra_number(i, k)
        text = _lpad(v, 4)
        return (
            F.when(v % 5 == 0, F.lit("")).otherwise(text) if i % 4 == 1
            else F.when(v % 7 == 0, F.lit("0000")).otherwise(text) if i % 4 == 2
            else F.concat(F.lit("X"), text) if i % 4 == 3
            else F.concat(F.lit("  "), text, F.lit(" "))
        )

    return feed(spark, sf_dir).withColumns(
        {"trading_status": (k % 20).cast("string"), **{c: raw(i) for i, c in enumerate(EXTRAS, 1)}})


def master_detail_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table with 20 clean columns; one in thirteen records differs in one."""
    k = F.col("cir_key")

    def clean(i: int):
        v = _extra_number(i, k)
        text = _lpad(v, 4)
        out = (F.when(v % 5 == 0, F.lit("")).otherwise(F.concat(text, F.lit("D"))) if i % 4 == 1
               else F.when(v % 7 == 0, F.lit("")).otherwise(text) if i % 4 == 2 else text)
        return F.when(k % 13 == i % 13, F.lit("other")).otherwise(out) if i == 5 else out

    return master_detail(spark, sf_dir).withColumns({c: clean(i) for i, c in enumerate(WIDE_MASTER_EXTRAS, 1)})


# --- the same derivations as SQL (DuckDB dialect) ---------------------------

SQL_FIXTURES = {
    "orders_delta": """
        SELECT o_orderkey AS id,
               CAST(o_orderdate AS VARCHAR) AS created,
               CAST(o_orderdate + to_days(CAST(o_orderkey % 4 AS INTEGER)) AS VARCHAR) AS updated,
               CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS deleted
        FROM orders""",
    "lineitem_delta": """
        SELECT l_orderkey AS id, l_linenumber AS line,
               CAST(l_shipdate AS VARCHAR) AS created,
               CAST(l_shipdate + to_days(CAST(l_linenumber % 3 AS INTEGER)) AS VARCHAR) AS updated
        FROM lineitem""",
    "events_delta": """
        SELECT event_id AS id, ts AS created,
               ts + to_days(CAST(event_id % 3 AS INTEGER)) AS updated,
               CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS deleted
        FROM events""",
    "customer_totals": "SELECT c_custkey AS id FROM customer",
    "feed": """
        SELECT lpad(CAST(o.o_custkey AS VARCHAR), 9, '0') AS reg_no,
               CASE WHEN o.o_custkey % 10 = 0 THEN '000000000'
                    WHEN o.o_custkey % 10 = 1 THEN ''
                    WHEN o.o_custkey % 10 = 2 THEN lpad(CAST(o.o_custkey + 100000 AS VARCHAR), 9, '0')
                    ELSE lpad(CAST(o.o_custkey // 10 * 10 AS VARCHAR), 9, '0') END AS hq_no,
               CASE WHEN o.o_custkey % 3 = 0 THEN ''
                    ELSE lpad(CAST(o.o_custkey // 100 * 100 AS VARCHAR), 9, '0') END AS parent_no,
               CASE o.o_orderstatus WHEN 'P' THEN '1P' WHEN 'F' THEN '2F' WHEN 'O' THEN '3O' END AS status_code,
               CASE WHEN o.o_custkey % 50 = 7 THEN ''
                    WHEN o.o_custkey % 50 = 9 THEN NULL
                    WHEN o.o_custkey % 50 = 11 THEN '  '
                    ELSE ' ' || c.c_name || ' ' END AS reg_name,
               lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS country,
               CAST(o.o_orderkey % 20 AS VARCHAR) AS trading_status,
               CASE WHEN o.o_custkey % 7 = 0 THEN '00000000'
                    ELSE lpad(CAST(o.o_custkey AS VARCHAR), 8, '0') END AS cro_number,
               o.o_orderdate AS ts_last_update,
               o.o_orderkey AS version_id
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "master_detail": """
        SELECT c_custkey AS cir_key, c_name AS reg_name,
               lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country,
               CAST(c_custkey % 20 AS VARCHAR) AS trading_status
        FROM customer""",
    "master_hub": """
        SELECT c_custkey AS cir_key,
               CASE WHEN c_custkey % 5 = 4 THEN 'SRC_B' ELSE 'SRC_A' END AS cir_src,
               CASE WHEN c_custkey % 11 = 0 THEN 'I' ELSE 'A' END AS status,
               lpad(CAST(c_custkey AS VARCHAR), 9, '0') || 'D' AS src_key1,
               CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END AS src_key2,
               lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS src_key3,
               CASE WHEN c_custkey % 10 IN (0, 1) THEN ''
                    WHEN c_custkey % 10 = 2 THEN lpad(CAST(c_custkey + 100000 AS VARCHAR), 9, '0') || 'D'
                    WHEN c_custkey % 100 = 3 THEN '999999999D'
                    ELSE lpad(CAST(c_custkey // 10 * 10 AS VARCHAR), 9, '0') || 'D' END AS src_key4,
               'SC' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS src_key5
        FROM customer""",
    "status_lookup": """
        SELECT trim(substr(line, 1, 2)) AS status_key, trim(substr(line, 3)) AS status_description
        FROM (VALUES """ + ", ".join(f"('{x}')" for x in STATUS_LOOKUP_LINES) + """) AS t(line)""",
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named fixture CTEs (in the given order)."""
    ctes = ",\n".join(f"{n} AS ({SQL_FIXTURES[n]}\n)" for n in names)
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{sql.lstrip()[5:]}"
    return f"WITH {ctes}\n{sql}"
