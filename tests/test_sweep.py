"""Registry sweep: catalog resolution, validation, chunked runs."""

import pytest
from pyspark.sql import functions as F

from deltarecon.harness import fixtures as fx
from deltarecon.plans.delta_sweep import delta_counts_for_registry, run_delta_counts
from deltarecon.session import scratch_path
from deltarecon.sources import catalog_resolver, mapping_resolver, parse_registry, read_count_rows

from .conftest import SF_SMALL


def reg(spark, *lines):
    return parse_registry(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_catalog_resolver_with_two_part_names(spark):
    fx.orders_delta(spark, SF_SMALL).createOrReplaceGlobalTempView("orders_delta")
    fx.customer_totals(spark, SF_SMALL).createOrReplaceGlobalTempView("customer_totals")
    r = reg(spark, "global_temp,orders,orders_delta,created,updated,deleted",
            "global_temp,customer,customer_totals,NA,NA,NA")
    out = {x.entity: x for x in delta_counts_for_registry(r, catalog_resolver(spark), fx.AS_OF_SINCE, "t").collect()}
    assert out["orders"].total == 1500 and out["customer"].inserts is None and out["customer"].total == 150


def test_blank_column_name_fails(spark):
    r = reg(spark, "sales,orders,orders_delta,created,updated,")
    with pytest.raises(ValueError):
        delta_counts_for_registry(r, mapping_resolver({"orders_delta": fx.orders_delta(spark, SF_SMALL)}), "2024-01-01")


def test_missing_table_fails_before_output(spark):
    r = reg(spark, "sales,orders,orders_delta,created,updated,deleted", "sales,x,no_such_table,NA,NA,NA")
    path = scratch_path(spark, "counts")
    with pytest.raises(KeyError):
        run_delta_counts(r, mapping_resolver({"orders_delta": fx.orders_delta(spark, SF_SMALL)}), "2024-01-01", path)
    with pytest.raises(Exception):
        spark.read.text(path).count()  # nothing was written


def test_run_in_batches_writes_every_table(spark):
    tables = {k: f(spark, SF_SMALL) for k, f in fx.DELTA_TABLES.items()}
    r = reg(spark, *fx.REGISTRY_LINES)
    path = scratch_path(spark, "counts")
    run_delta_counts(r, mapping_resolver(tables), fx.AS_OF_SINCE, path, job_time="t", batch_tables=3)
    whole = delta_counts_for_registry(r, mapping_resolver(tables), fx.AS_OF_SINCE, "t")
    assert sorted(read_count_rows(spark, path).collect()) == sorted(whole.collect())
    files = [f for f in spark.read.text(path).inputFiles()]
    assert len(files) == 1
    assert [r.entity for r in read_count_rows(spark, path).collect()] == [x.split(",")[1] for x in fx.REGISTRY_LINES]


def test_failure_while_counting_keeps_the_old_output(spark):
    good = fx.orders_delta(spark, SF_SMALL)
    path = scratch_path(spark, "counts")
    run_delta_counts(reg(spark, "q,old,a,NA,NA,NA"), mapping_resolver({"a": good}), "2024-01-01", path, job_time="t")
    bad = good.withColumn("deleted", F.raise_error(F.lit("broken block")).cast("string"))
    r = reg(spark, "q,A,a,created,updated,deleted", "q,B,a,NA,NA,NA", "q,C,a,NA,NA,NA", "q,D,bad,created,updated,deleted")
    with pytest.raises(Exception, match="broken block"):
        run_delta_counts(r, mapping_resolver({"a": good, "bad": bad}), "2024-01-01", path, job_time="t", batch_tables=2)
    assert [x.entity for x in read_count_rows(spark, path).collect()] == ["old"]


def test_a_long_registry_is_planned_in_time(spark):
    import time

    table = spark.createDataFrame([("2024-01-01", "2024-01-02", "N")], "c string, u string, d string")
    r = reg(spark, *[f"q,e{i},t,c,u,d" for i in range(400)])
    began = time.monotonic()
    df = delta_counts_for_registry(r, mapping_resolver({"t": table}), "2024-01-01", "t")
    assert len(df.columns) == 9 and time.monotonic() - began < 60


def test_scale_conf_sizes_partitions():
    from deltarecon.session import scale_conf

    c = scale_conf(100 << 40)  # 100 TiB through the largest shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == 50_000  # not one per quarter GB: blocks grow with their square
    assert int(scale_conf(10 << 40)["spark.sql.shuffle.partitions"]) == 10 << 10
    assert c["spark.sql.adaptive.enabled"] == "true"
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_materialize_keeps_rows_and_untyped_nulls(spark):
    from deltarecon.session import materialize

    df = spark.range(5).withColumn("n", F.lit(None))
    back = materialize(df, "probe")
    assert back.count() == 5 and dict(back.dtypes)["n"] == "string"
