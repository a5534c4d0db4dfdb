"""Harness queries: one ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the fixtures in
``fixtures.py``) over their full size. Queries that exercise text sources or
sinks first write data Spark derives from those tables into a fresh folder
under the session's checkpoint folder, then read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import formatting, rules
from ..operators import dedup, deltas, filters, reconcile
from ..plans import delta_sweep, feed_reconciliation as fr, report
from ..session import _app_id, scratch_path
from ..sinks import counts as count_sinks
from ..sinks import delimited
from ..sources import counts as count_sources
from ..sources import fixed_width, records, registry, tables, text
from ..streaming import history as stream_history
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn_: Query) -> Query:
    QUERIES[fn_.__name__] = fn_
    return fn_


def _write_lines(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    lines.select(F.col("value").cast("string")).write.text(path)
    return path


_FIXED_FILES: dict[tuple[str, str], str] = {}


def _fixed_file(spark: SparkSession, name: str, lines: tuple[str, ...]) -> str:
    """Write a small fixed text input once per application and reuse it."""
    key = (_app_id(spark), name)
    if key not in _FIXED_FILES:
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        _FIXED_FILES[key] = _write_lines(spark, df, name)
    return _FIXED_FILES[key]


def _lookup(spark: SparkSession) -> DataFrame:
    return fixed_width.read_fixed_width(spark, _fixed_file(spark, "status_lookup", fx.STATUS_LOOKUP_LINES))


def _flow(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fr.feed_flow(fx.feed(spark, sf_dir), _lookup(spark))


def _ts_text(df: DataFrame, col: str = "ts_last_update") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("string"))


# --- sources ----------------------------------------------------------------

def registry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry-format lines built from every ``orders_delta`` row."""
    od = fx.orders_delta(spark, sf_dir)
    i = F.col("id")

    def na_if(cond, c):
        return F.when(cond, F.lit("NA")).otherwise(F.col(c))

    body = F.concat_ws(
        ",",
        F.concat(F.lit("q"), (i % 3).cast("string")),
        F.concat(F.lit("E"), i.cast("string")),
        F.concat(F.lit("p"), (i % 7).cast("string")),
        na_if(i % 5 == 0, "created"),
        na_if(i % 4 == 0, "updated"),
        na_if(i % 6 == 0, "deleted"),
    )
    value = F.when(i % 2 == 0, F.concat(body, F.lit(",extra"))).otherwise(body)
    return od.select(value.alias("value"))


@query
def src_registry(spark, sf_dir):
    return registry.read_registry(spark, _write_lines(spark, registry_lines(spark, sf_dir), "registry"))


@query
def src_fixed_width(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    code = F.when(F.col("o_orderstatus") == "P", "1P").when(F.col("o_orderstatus") == "F", "2F").otherwise("3O")
    value = (
        F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.substring(code, 1, 1), F.lit("\t")))
        .when(F.col("o_orderkey") % 9 == 1, F.concat(code, F.lit("\t"), F.col("o_orderpriority"), F.lit(" \t ")))
        .otherwise(F.concat(code, F.lit(" "), F.col("o_orderpriority"), F.lit("  ")))
    )
    path = _write_lines(spark, o.select(value.alias("value")), "fixed_width")
    return fixed_width.read_fixed_width(spark, path)


@query
def scan_table(spark, sf_dir):
    return fx.table(spark, sf_dir, "customer").select("*")


@query
def scan_filtered(spark, sf_dir):
    return tables.scan_filtered(fx.master_hub(spark, sf_dir), cir_src=fx.HUB_SOURCE, status=fx.HUB_ACTIVE)


@query
def preview_limit(spark, sf_dir):
    path = _write_lines(spark, registry_lines(spark, sf_dir), "preview")
    return text.preview(text.read_lines(spark, path), 10, order_by="value")


# --- filters ----------------------------------------------------------------

@query
def filter_not_blank(spark, sf_dir):
    return filters.filter_not_blank(fx.feed(spark, sf_dir), "reg_name").select("reg_no", "reg_name", "version_id")


@query
def filter_blank_reject(spark, sf_dir):
    return filters.filter_blank(fx.feed(spark, sf_dir), "reg_name").select("reg_no", "hq_no", "status_code", "version_id")


@query
def split_valid_reject_counts(spark, sf_dir):
    return filters.split_counts(fx.feed(spark, sf_dir), "reg_name")


@query
def hq_split_counts(spark, sf_dir):
    std = _flow(spark, sf_dir)["std"]
    return std.agg(
        F.count_if(filters.is_blank("hq_no")).alias("blank_hq"),
        F.count_if(filters.is_not_blank("hq_no")).alias("nonblank_hq"),
    )


# --- delta counts -----------------------------------------------------------

def _orders_counts(spark, sf_dir, mode="since", as_of=fx.AS_OF_SINCE, pruned=False):
    return deltas.delta_counts(
        fx.orders_delta(spark, sf_dir), as_of, "created", "updated", "deleted",
        mode=mode, entity="orders", process="orders_delta", job_time=fx.JOB_TIME, pruned=pruned,
    )


def _one_metric(name):
    def q(spark, sf_dir):
        return _orders_counts(spark, sf_dir).select("entity", "process", name)

    return q


for _metric, _key in (
    ("inserts", "delta_inserts_since"),
    ("updates", "delta_updates_since"),
    ("deletes", "delta_deletes_since"),
    ("active", "delta_active"),
    ("inactive", "delta_inactive"),
):
    _q = _one_metric(_metric)
    _q.__name__ = _key
    query(_q)


@query
def delta_counts_since(spark, sf_dir):
    return _orders_counts(spark, sf_dir)


@query
def delta_counts_pruned(spark, sf_dir):
    """The same row from two scans, the changes behind a filter on the stamp."""
    return _orders_counts(spark, sf_dir, pruned=True)


@query
def delta_counts_on_day_pruned(spark, sf_dir):
    return _orders_counts(spark, sf_dir, mode="on", as_of=fx.AS_OF_ON_DAY, pruned=True)


@query
def delta_counts_typed_pruned(spark, sf_dir):
    return deltas.delta_counts(
        fx.events_delta(spark, sf_dir), fx.AS_OF_EVENTS, "created", "updated", "deleted",
        entity="events", process="events_delta", job_time=fx.JOB_TIME, pruned=True,
    )


@query
def delta_counts_on_day(spark, sf_dir):
    return _orders_counts(spark, sf_dir, mode="on", as_of=fx.AS_OF_ON_DAY)


@query
def delta_on_day_created_only(spark, sf_dir):
    """Inserts of a day need the created column alone; the six fields of a day's row."""
    counts = deltas.delta_counts(fx.orders_delta(spark, sf_dir), "1998-06-15", "created", mode="on",
                                 entity="orders", process="orders_delta", job_time=fx.JOB_TIME)
    return deltas.day_count_row(counts, "1998-06-15")


@query
def delta_counts_typed(spark, sf_dir):
    return deltas.delta_counts(
        fx.events_delta(spark, sf_dir), fx.AS_OF_EVENTS, "created", "updated", "deleted",
        entity="events", process="events_delta", job_time=fx.JOB_TIME,
    )


@query
def delta_counts_typed_on_day(spark, sf_dir):
    return deltas.delta_counts(
        fx.events_delta(spark, sf_dir), fx.AS_OF_EVENTS, "created", "updated", "deleted",
        mode="on", entity="events", process="events_delta", job_time=fx.JOB_TIME,
    )


@query
def delta_no_delete_col(spark, sf_dir):
    return deltas.delta_counts(
        fx.lineitem_delta(spark, sf_dir), fx.AS_OF_SINCE, "created", "updated", None,
        entity="lines", process="lineitem_delta", job_time=fx.JOB_TIME,
    )


@query
def delta_totals_only(spark, sf_dir):
    return deltas.delta_counts(
        fx.customer_totals(spark, sf_dir), fx.AS_OF_SINCE,
        entity="customer", process="customer_totals", job_time=fx.JOB_TIME,
    )


def registry_frame(spark: SparkSession) -> DataFrame:
    return registry.read_registry(spark, _fixed_file(spark, "registry", fx.REGISTRY_LINES))


def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolve = tables.mapping_resolver({k: (lambda f=f: f(spark, sf_dir)) for k, f in fx.DELTA_TABLES.items()})
    return delta_sweep.delta_counts_for_registry(registry_frame(spark), resolve, fx.AS_OF_SINCE, job_time=fx.JOB_TIME)


@query
def delta_registry_all(spark, sf_dir):
    return sweep(spark, sf_dir)


@query
def delta_registry_on_day(spark, sf_dir):
    """The exact-day variant over the whole registry."""
    resolve = tables.mapping_resolver({k: (lambda f=f: f(spark, sf_dir)) for k, f in fx.DELTA_TABLES.items()})
    return delta_sweep.delta_counts_for_registry(registry_frame(spark), resolve, fx.AS_OF_ON_DAY,
                                                 job_time=fx.JOB_TIME, mode="on")


# --- scalar rules -----------------------------------------------------------

@query
def sc_day_prefix(spark, sf_dir):
    od = fx.orders_delta(spark, sf_dir)
    return od.select("id", rules.day_prefix("created").alias("created_day"), rules.day_prefix("updated").alias("updated_day"))


@query
def sc_trim(spark, sf_dir):
    return fx.feed(spark, sf_dir).select("version_id", F.trim("reg_name").alias("reg_name"))


@query
def sc_suffix_key(spark, sf_dir):
    f = fx.feed(spark, sf_dir)
    return f.select("version_id", rules.suffix_key("reg_no").alias("reg_no"), rules.suffix_key("parent_no").alias("parent_no"))


@query
def sc_suffix_nonzero(spark, sf_dir):
    return fx.feed(spark, sf_dir).select("version_id", rules.suffix_nonzero("hq_no").alias("hq_no"))


@query
def sc_zero_to_blank(spark, sf_dir):
    return fx.feed(spark, sf_dir).select("version_id", rules.zero_to_blank("cro_number").alias("cro_number"))


@query
def sc_strip_letters(spark, sf_dir):
    return fx.feed(spark, sf_dir).select("version_id", rules.strip_letters("status_code").alias("status_code"))


@query
def sc_trim_keep_ws(spark, sf_dir):
    return fx.feed(spark, sf_dir).select("version_id", rules.trim_keep_ws("reg_name").alias("reg_name"))


@query
def sc_remove_first_const(spark, sf_dir):
    f = fx.feed(spark, sf_dir)
    return f.select("version_id", rules.remove_first("trading_status", literal="0").alias("trading_status"))


@query
def sc_remove_first_col(spark, sf_dir):
    h = fx.master_hub(spark, sf_dir)
    return h.select("cir_key", rules.remove_first("src_key5", "src_key3").alias("cro_prefix"))


@query
def sc_format_job_time(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    return e.select("event_id", formatting.format_job_time("ts").alias("job_time"))


@query
def sc_row_to_delimited(spark, sf_dir):
    f = fx.feed(spark, sf_dir)
    return f.select("version_id", formatting.delimited_line(f.columns).alias("line"))


# --- dedup ------------------------------------------------------------------

def _valid(spark, sf_dir):
    return filters.filter_not_blank(fx.feed(spark, sf_dir), "reg_name")


@query
def window_first_ts(spark, sf_dir):
    w = dedup.with_latest_ts(_valid(spark, sf_dir), "reg_no", "ts_last_update")
    return w.select("reg_no", "version_id", F.col("max_ts").cast("string").alias("max_ts"))


@query
def dedup_latest(spark, sf_dir):
    return _ts_text(dedup.latest_per_key(_valid(spark, sf_dir), "reg_no", "ts_last_update", "version_id"))


@query
def dedup_latest_agg(spark, sf_dir):
    """Same rows through the max_by aggregation form."""
    return _ts_text(dedup.latest_per_key_agg(_valid(spark, sf_dir), "reg_no", "ts_last_update", "version_id"))


@query
def dedup_latest_refshape(spark, sf_dir):
    return _ts_text(dedup.latest_keys_with_ts(_valid(spark, sf_dir), "reg_no", "ts_last_update"))


@query
def dedup_keys(spark, sf_dir):
    return dedup.dedup_keys(_valid(spark, sf_dir), "reg_no")


# --- reconciliation ---------------------------------------------------------

@query
def join_lookup_inner(spark, sf_dir):
    d = dedup.latest_per_key(_valid(spark, sf_dir), "reg_no", "ts_last_update", "version_id")
    j = reconcile.lookup_join(d, _lookup(spark), "status_code", "status_key", keep=["status_description"])
    return j.select("reg_no", "status_code", "status_description", "version_id")


@query
def std_feed(spark, sf_dir):
    return _flow(spark, sf_dir)["std"]


@query
def hq_universe(spark, sf_dir):
    return _flow(spark, sf_dir)["keys"]


@query
def hq_match_semi(spark, sf_dir):
    fl = _flow(spark, sf_dir)
    return reconcile.match_parent(fl["std"], fl["keys"], "hq_no", "reg_no")


@query
def hq_unmatched_anti(spark, sf_dir):
    fl = _flow(spark, sf_dir)
    return reconcile.orphans(fl["std"], fl["keys"], "hq_no", "reg_no")


@query
def union_accepted(spark, sf_dir):
    return fr.accepted_union(_flow(spark, sf_dir))


@query
def union_accepted_rejected(spark, sf_dir):
    return fr.accepted_rejected_union(_flow(spark, sf_dir))


@query
def branch_flag(spark, sf_dir):
    return fr.accepted_and_rejected(_flow(spark, sf_dir))


@query
def branch_flag_custom_rules(spark, sf_dir):
    """Parent check under the spec's own key rules (letters stripped, blanks kept)."""
    spec = fr.FeedSpec(rules={**fr.DEFAULT_RULES, "reg_no": rules.trim_text, "hq_no": rules.zero_to_blank})
    flow = fr.feed_flow(fx.feed(spark, sf_dir), _lookup(spark), spec)
    return fr.accepted_and_rejected(flow, spec)


_EXTRA_RULES = {1: rules.suffix_key, 2: rules.zero_to_blank, 3: rules.strip_letters, 0: rules.trim_text}
WIDE_SPEC = fr.FeedSpec(
    columns=(*fr.FEED_COLUMNS, *fx.EXTRAS),
    rules={**fr.DEFAULT_RULES, **{c: _EXTRA_RULES[i % 4] for i, c in enumerate(fx.EXTRAS, 1)}},
)


def _wide_mapping(detail, hub):
    return {**fr.default_master_mapping(detail, hub), **{c: F.trim(detail[c]) for c in fx.WIDE_MASTER_EXTRAS}}


def _wide_master(spark, sf_dir):
    return fr.build_master(fx.master_detail_wide(spark, sf_dir), fx.master_hub(spark, sf_dir),
                           {"cir_src": fx.HUB_SOURCE, "status": fx.HUB_ACTIVE}, mapping=_wide_mapping)


@query
def std_feed_wide(spark, sf_dir):
    """37 columns, each through its rule."""
    return fr.feed_flow(fx.feed_wide(spark, sf_dir), _lookup(spark), WIDE_SPEC)["std"]


@query
def master_view_wide(spark, sf_dir):
    """31 columns."""
    return _wide_master(spark, sf_dir)


@query
def diff_27_keys(spark, sf_dir):
    flow = fr.feed_flow(fx.feed_wide(spark, sf_dir), _lookup(spark), WIDE_SPEC)
    return reconcile.record_diff(fr.accepted_and_rejected(flow, WIDE_SPEC), _wide_master(spark, sf_dir), fx.WIDE_DIFF_KEYS)


@query
def feed_reconciliation_wide(spark, sf_dir):
    """The whole job on the wide register."""
    return fr.feed_reconciliation(
        fx.feed_wide(spark, sf_dir), _lookup(spark), fx.master_detail_wide(spark, sf_dir), fx.master_hub(spark, sf_dir),
        {"cir_src": fx.HUB_SOURCE, "status": fx.HUB_ACTIVE}, fx.WIDE_DIFF_KEYS, WIDE_SPEC, master_mapping=_wide_mapping,
    ).diff


def _master(spark, sf_dir):
    hub_filter = {"cir_src": fx.HUB_SOURCE, "status": fx.HUB_ACTIVE}
    return fr.build_master(fx.master_detail(spark, sf_dir), fx.master_hub(spark, sf_dir), hub_filter)


@query
def master_view(spark, sf_dir):
    return _master(spark, sf_dir)


@query
def diff_full_outer(spark, sf_dir):
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir))
    return reconcile.record_diff(acc, _master(spark, sf_dir), fx.DIFF_KEYS)


@query
def diff_full_outer_measured(spark, sf_dir):
    """Same rows with the master's keys counted first (strategy="measured")."""
    # Unique: one record a key after the dedup.
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir))
    return reconcile.record_diff(acc, _master(spark, sf_dir), fx.DIFF_KEYS, strategy="measured", left_is_unique=True)


@query
def diff_full_outer_hot_keys(spark, sf_dir):
    """A key that several records share; most are hot by the limit given, and go through joins that can be split."""
    key = F.concat_ws("-", "country", F.substring("reg_no", 6, 4)).alias("key")
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir)).select(key, "reg_no")
    return reconcile.record_diff(acc, _master(spark, sf_dir).select(key, "reg_no"), ["key"], side_col="diff_side",
                                 side_names=("both", "feed_only", "master_only"), strategy="measured", hot_rows=1)


@query
def diff_single_nullable_key(spark, sf_dir):
    """One key, NULL for every head office: such records pair with nothing."""
    key = F.expr("if(hq_no = '', null, reg_no)").alias("key")
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir)).select(key, "reg_no", "reg_name")
    return reconcile.record_diff(acc, _master(spark, sf_dir).select(key, "reg_no", "reg_name"), ["key"], side_col="diff_side",
                                 side_names=("both", "feed_only", "master_only"))


@query
def diff_mixed_key_types(spark, sf_dir):
    """Text against number, int against long: compared as ``=`` does."""
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir)).selectExpr(
        "left(reg_no, 9) AS reg_no", "length(reg_name) AS name_chars")
    m = _master(spark, sf_dir).selectExpr(
        "cast(left(reg_no, 9) AS bigint) AS reg_no", "cast(length(reg_name) AS bigint) AS name_chars")
    return reconcile.record_diff(acc, m, ["reg_no", "name_chars"], side_col="diff_side",
                                 side_names=("both", "feed_only", "master_only"))


@query
def diff_full_outer_single(spark, sf_dir):
    """Same rows through one full outer join (strategy="full_outer")."""
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir))
    return reconcile.record_diff(acc, _master(spark, sf_dir), fx.DIFF_KEYS, strategy="full_outer")


@query
def diff_full_outer_nullsafe(spark, sf_dir):
    # Blank head-office ids become NULL on both sides, so only the null-safe
    # comparison can pair those records.
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir)).withColumn("hq_no", F.expr("nullif(hq_no, '')"))
    m = _master(spark, sf_dir).withColumn("hq_no", F.expr("nullif(hq_no, '')"))
    return reconcile.record_diff(acc, m, fx.DIFF_KEYS, null_safe=True, side_col="diff_side",
                                 side_names=("both", "feed_only", "master_only"))


@query
def diff_full_outer_null_keys(spark, sf_dir):
    """Same NULL-ed inputs with plain equality: NULL keys never pair, both sides surface."""
    acc = fr.accepted_and_rejected(_flow(spark, sf_dir)).withColumn("hq_no", F.expr("nullif(hq_no, '')"))
    m = _master(spark, sf_dir).withColumn("hq_no", F.expr("nullif(hq_no, '')"))
    return reconcile.record_diff(acc, m, fx.DIFF_KEYS, side_col="diff_side",
                                 side_names=("both", "feed_only", "master_only"))


@query
def diff_summary(spark, sf_dir):
    fl = _flow(spark, sf_dir)
    acc = fr.accepted_and_rejected(fl)
    d = reconcile.record_diff(acc, _master(spark, sf_dir), fx.DIFF_KEYS, side_col="diff_side",
                              side_names=("both", "feed_only", "master_only"))
    return d.groupBy("diff_side").agg(F.count(F.lit(1)).alias("records"))


def reconciliation(spark: SparkSession, sf_dir: str) -> fr.Reconciliation:
    return fr.feed_reconciliation(
        fx.feed(spark, sf_dir), _lookup(spark),
        fx.master_detail(spark, sf_dir), fx.master_hub(spark, sf_dir),
        {"cir_src": fx.HUB_SOURCE, "status": fx.HUB_ACTIVE}, fx.DIFF_KEYS,
    )


@query
def feed_reconciliation(spark, sf_dir):
    return reconciliation(spark, sf_dir).diff


# --- sinks and report -------------------------------------------------------

@query
def sink_delimited_roundtrip(spark, sf_dir):
    rejects = filters.filter_blank(fx.feed(spark, sf_dir), "reg_name")
    path = scratch_path(spark, "rejects")
    delimited.write_delimited(rejects, path)
    return spark.read.text(path)


@query
def sink_diff_roundtrip(spark, sf_dir):
    """Diff and rejects written as delimited records, the diff read back."""
    rec = reconciliation(spark, sf_dir)
    result, rejects = scratch_path(spark, "final_result"), scratch_path(spark, "rejects")
    fr.write_reconciliation(rec, result, rejects)
    return spark.read.text(result)


@query
def diff_records_typed(spark, sf_dir):
    """The diff written as delimited records and read back as typed columns."""
    rec = reconciliation(spark, sf_dir)
    result = scratch_path(spark, "final_result")
    schema = rec.diff.drop("diff_side").schema
    fr.write_reconciliation(rec, result)
    return records.read_records(spark, result, schema).rows


@query
def reject_records_malformed(spark, sf_dir):
    """Names that hold the delimiter break their lines; these come out aside."""
    rejects = fx.feed(spark, sf_dir).select("reg_no", "country", F.expr(
        "if(version_id % 5 = 0, concat(reg_no, '\u0001', country), reg_no)").alias("reg_name"))
    path = scratch_path(spark, "records")
    delimited.write_delimited(rejects, path)
    return records.read_records(spark, path, rejects.schema).malformed.select("value", "reason")


@query
def sink_overwrite_counts(spark, sf_dir):
    resolve = tables.mapping_resolver({k: (lambda f=f: f(spark, sf_dir)) for k, f in fx.DELTA_TABLES.items()})
    path = scratch_path(spark, "counts")
    for _ in range(2):  # the second run replaces the first; two tables per chunk
        delta_sweep.run_delta_counts(registry_frame(spark), resolve, fx.AS_OF_SINCE, path,
                                     job_time=fx.JOB_TIME, batch_tables=2)
    return count_sources.read_count_rows(spark, path)


@query
def sink_history_append(spark, sf_dir):
    rows = sweep(spark, sf_dir)
    path = scratch_path(spark, "history")
    count_sinks.append_history(rows, path)
    count_sinks.append_history(rows, path)  # history keeps both runs
    return count_sources.read_count_rows(spark, path)


@query
def sink_history_by_day(spark, sf_dir):
    """Two runs of the same day, one of another day: each day kept once."""
    rows = sweep(spark, sf_dir)
    path = scratch_path(spark, "history_by_day")
    other_day = rows.withColumn("job_time", F.lit(fx.JOB_TIME_NEXT_DAY))
    count_sinks.replace_history_day(rows, path)
    count_sinks.replace_history_day(other_day, path)
    count_sinks.replace_history_day(rows, path)  # re-run of the first day replaces it
    return count_sources.read_history_by_day(spark, path)


def _count_runs(spark, sf_dir) -> str:
    """Two runs' count files under one base folder, as the daily jobs leave them."""
    rows = sweep(spark, sf_dir)
    base = scratch_path(spark, "delta_ind_entity")
    count_sinks.write_count_rows(rows.filter(F.col("entity").isin("orders", "lines")), f"{base}/run_sales")
    count_sinks.write_count_rows(rows.filter(~F.col("entity").isin("orders", "lines")), f"{base}/run_other")
    return base


@query
def report_consolidate(spark, sf_dir):
    return count_sources.read_count_tree(spark, _count_runs(spark, sf_dir))


@query
def report_current(spark, sf_dir):
    return report.report_current(count_sources.read_count_tree(spark, _count_runs(spark, sf_dir)))


@query
def report_html_rows(spark, sf_dir):
    base = _count_runs(spark, sf_dir)
    current = scratch_path(spark, "current")
    hist = scratch_path(spark, "history")
    return report.consolidate_and_publish(spark, base, current, hist)


@query
def stream_history_once(spark, sf_dir):
    """Two availableNow runs over the same landing folder append it once."""
    landing = scratch_path(spark, "landing")
    count_sinks.write_count_rows(sweep(spark, sf_dir), f"{landing}/run_1")
    hist = scratch_path(spark, "stream_history")
    ckpt = scratch_path(spark, "stream_checkpoint")
    stream_history.append_new_counts(spark, landing, hist, ckpt)
    stream_history.append_new_counts(spark, landing, hist, ckpt)
    return stream_history.read_history(spark, hist)

