"""DuckDB oracle SQL for every harness query.

Each statement repeats the fixture derivation as CTEs over the driver's
pre-registered table views and computes the expected result independently
of the Spark formulation (window ``row_number`` for the dedup, ``IN`` /
``EXISTS`` for the parent check, ``FILTER`` counts for the metrics).
"""

from __future__ import annotations

from . import fixtures as fx
from .fixtures import with_fixtures

ORACLES: dict[str, str] = {}


# --- rule text ---------------------------------------------------------------

def suffix_key(c: str) -> str:
    return f"CASE WHEN trim({c}) <> '' THEN {c} || 'D' ELSE trim({c}) END"


def suffix_nonzero(c: str) -> str:
    return (f"CASE WHEN trim({c}) <> '' AND length(trim(regexp_replace({c}, '0', '', 'g'))) <> 0 "
            f"THEN {c} || 'D' ELSE '' END")


def zero_to_blank(c: str) -> str:
    return f"CASE WHEN length(trim(regexp_replace({c}, '0', '', 'g'))) = 0 THEN '' ELSE trim({c}) END"


def strip_letters(c: str) -> str:
    return f"CASE WHEN trim({c}) <> '' THEN regexp_replace({c}, '[A-Za-z]', '', 'g') ELSE trim({c}) END"


def trim_keep_ws(c: str) -> str:
    return f"CASE WHEN length(trim({c})) <> 0 THEN trim({c}) ELSE {c} END"


def remove_first(f: str, s: str) -> str:
    return (f"CASE WHEN instr({f}, {s}) = 0 THEN '' "
            f"ELSE substr({f}, 1, instr({f}, {s}) - 1) || substr({f}, instr({f}, {s}) + 1) END")


def delimited(cols: list[str], sep: str = "chr(1)") -> str:
    return f"concat_ws({sep}, " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in cols) + ")"


FEED_COLS = ["reg_no", "hq_no", "parent_no", "status_code", "reg_name", "country",
             "trading_status", "cro_number", "ts_last_update", "version_id"]
STD_COLS = ["reg_no", "hq_no", "parent_no", "status_code", "reg_name", "country",
            "trading_status", "cro_number", "ts_last_update"]
ACCEPTED_COLS = ["rejected_branch_record", "reg_no", "hq_no", "parent_no", "status_code", "reg_name",
                 "country", "trading_status", "cro_number"]
MASTER_COLS = ["cir_key", "status", "reg_no", "hq_no", "status_code", "reg_name", "country",
               "trading_status", "cro_prefix", "cro_number", "data_owner"]


# --- shared CTE chain ----------------------------------------------------------

FLOW_CTES = f"""
valid AS (SELECT * FROM feed WHERE reg_name <> ''),
dedup AS (
  SELECT {', '.join(FEED_COLS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY ts_last_update DESC, version_id DESC) AS rn
    FROM valid WHERE ts_last_update IS NOT NULL) t
  WHERE rn = 1),
looked_up AS (SELECT d.* FROM dedup d JOIN status_lookup l ON d.status_code = l.status_key),
std AS (
  SELECT {suffix_key('reg_no')} AS reg_no,
         {suffix_nonzero('hq_no')} AS hq_no,
         {suffix_key('parent_no')} AS parent_no,
         {strip_letters('status_code')} AS status_code,
         {trim_keep_ws('reg_name')} AS reg_name,
         trim(country) AS country,
         trim(trading_status) AS trading_status,
         {zero_to_blank('cro_number')} AS cro_number,
         trim(CAST(ts_last_update AS VARCHAR)) AS ts_last_update
  FROM looked_up),
keys AS (SELECT DISTINCT {suffix_key('reg_no')} AS reg_no FROM valid WHERE ts_last_update IS NOT NULL),
flagged AS (
  SELECT CASE WHEN hq_no = '' OR hq_no IN (SELECT reg_no FROM keys WHERE reg_no <> '') THEN 'N' ELSE 'Y' END
           AS rejected_branch_record, *
  FROM std),
accepted AS (
  SELECT rejected_branch_record, reg_no, hq_no, parent_no, status_code, reg_name, country,
         {remove_first('trading_status', "'0'")} AS trading_status, cro_number
  FROM flagged),
master AS (
  SELECT trim(CAST(d.cir_key AS VARCHAR)) AS cir_key, trim(h.status) AS status,
         trim(h.src_key1) AS reg_no, trim(h.src_key4) AS hq_no, trim(h.src_key2) AS status_code,
         trim(d.reg_name) AS reg_name, trim(d.country) AS country,
         trim({remove_first('d.trading_status', "'0'")}) AS trading_status,
         trim({remove_first('h.src_key5', 'h.src_key3')}) AS cro_prefix,
         trim(h.src_key3) AS cro_number, '' AS data_owner
  FROM master_detail d JOIN master_hub h ON d.cir_key = h.cir_key
  WHERE h.cir_src = '{fx.HUB_SOURCE}' AND h.status = '{fx.HUB_ACTIVE}')"""

FLOW_FIXTURES = ("feed", "status_lookup", "master_detail", "master_hub")


def flow_sql(select: str) -> str:
    return with_fixtures(f"WITH {FLOW_CTES}\n{select}", *FLOW_FIXTURES)


def diff_select(null_safe: bool = False, side: bool = False, hq_null: bool = False) -> str:
    op = "IS NOT DISTINCT FROM" if null_safe else "="
    lsrc = "accepted"
    rsrc = "master"
    if hq_null:
        lsrc = "(SELECT * REPLACE (nullif(hq_no, '') AS hq_no) FROM accepted)"
        rsrc = "(SELECT * REPLACE (nullif(hq_no, '') AS hq_no) FROM master)"
    cols = [f"a.{c} AS l_{c}" for c in ACCEPTED_COLS] + [f"m.{c} AS r_{c}" for c in MASTER_COLS]
    if side:
        cols.append("CASE WHEN a._l IS NOT NULL AND m._r IS NOT NULL THEN 'both' "
                    "WHEN a._l IS NOT NULL THEN 'feed_only' ELSE 'master_only' END AS diff_side")
    cond = " AND ".join(f"a.{k} {op} m.{k}" for k in fx.DIFF_KEYS)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, 1 AS _l FROM {lsrc}) a "
            f"FULL OUTER JOIN (SELECT *, 1 AS _r FROM {rsrc}) m ON {cond}")


# --- wide register: the standardised values, written out -------------------------

def _wide_value(i: int, k: str) -> str:
    v = f"(({k} * {i + 3}) % {50 + i})"
    text = f"lpad(CAST({v} AS VARCHAR), 4, '0')"
    if i % 4 == 1:
        return f"CASE WHEN {v} % 5 = 0 THEN '' ELSE {text} || 'D' END"
    if i % 4 == 2:
        return f"CASE WHEN {v} % 7 = 0 THEN '' ELSE {text} END"
    return text


_WIDE_K = "CAST(left(reg_no, 9) AS BIGINT)"
_WIDE_TRADING = f"CAST({_WIDE_K} % 20 AS VARCHAR)"
_WIDE_EXTRAS = ", ".join(f"{_wide_value(i, _WIDE_K)} AS {c}" for i, c in enumerate(fx.EXTRAS, 1))
_WIDE_CLEAN = ", ".join(
    f"CASE WHEN CAST(cir_key AS BIGINT) % 13 = 5 THEN 'other' ELSE {_wide_value(i, 'CAST(cir_key AS BIGINT)')} END AS {c}"
    if i == 5 else f"{_wide_value(i, 'CAST(cir_key AS BIGINT)')} AS {c}" for i, c in enumerate(fx.WIDE_MASTER_EXTRAS, 1))


def wide_sql(select: str) -> str:
    return with_fixtures(f"""WITH {FLOW_CTES},
std_wide AS (SELECT * REPLACE ({_WIDE_TRADING} AS trading_status), {_WIDE_EXTRAS} FROM std),
accepted_wide AS (
  SELECT * REPLACE ({remove_first(_WIDE_TRADING, "'0'")} AS trading_status), {_WIDE_EXTRAS} FROM accepted),
master_wide AS (SELECT *, {_WIDE_CLEAN} FROM master)
{select}""", *FLOW_FIXTURES)


def wide_diff(side: bool) -> str:
    cols = [f"a.{c} AS l_{c}" for c in (*ACCEPTED_COLS, *fx.EXTRAS)]
    cols += [f"m.{c} AS r_{c}" for c in (*MASTER_COLS, *fx.WIDE_MASTER_EXTRAS)]
    if side:
        cols.append("CASE WHEN a._l IS NOT NULL AND m._r IS NOT NULL THEN 'both' "
                    "WHEN a._l IS NOT NULL THEN 'feed_only' ELSE 'master_only' END AS diff_side")
    cond = " AND ".join(f"a.{k} = m.{k}" for k in fx.WIDE_DIFF_KEYS)
    return wide_sql(f"SELECT {', '.join(cols)} FROM (SELECT *, 1 AS _l FROM accepted_wide) a "
                    f"FULL OUTER JOIN (SELECT *, 1 AS _r FROM master_wide) m ON {cond}")


ORACLES["std_feed_wide"] = wide_sql("SELECT * FROM std_wide")
ORACLES["master_view_wide"] = wide_sql("SELECT * FROM master_wide")
ORACLES["diff_27_keys"] = wide_diff(side=False)
ORACLES["feed_reconciliation_wide"] = wide_diff(side=True)

# --- delta counts ---------------------------------------------------------------

def count_select(src: str, entity: str, process: str, as_of: str, created: str | None,
                 updated: str | None, deleted: str | None, typed: bool = False, mode: str = "since") -> str:
    def day(c: str) -> str:
        return f"CAST({c} AS DATE)" if typed else f"left(CAST({c} AS VARCHAR), 10)"

    d = f"DATE '{as_of}'" if typed else f"'{as_of}'"
    cmp = ">=" if mode == "since" else "="
    na = "CAST(NULL AS BIGINT)"
    if created and updated:
        crt, upd = day(created), day(updated)
        ins_pred = f"{crt} {cmp} {d} AND {upd} {cmp} {d}" if mode == "since" else f"{crt} {cmp} {d}"
        ins = f"count(*) FILTER (WHERE {ins_pred})"
        changed = f"{upd} {cmp} {d} AND {upd} <> {crt}"
        if deleted:
            upd_m = f"count(*) FILTER (WHERE {changed} AND {deleted} = 'N')"
            del_m = f"count(*) FILTER (WHERE {changed} AND {deleted} = 'Y')"
        else:
            upd_m = f"count(*) FILTER (WHERE {changed})"
            del_m = na
    else:
        ins = upd_m = del_m = na
    act = f"count(*) FILTER (WHERE {deleted} = 'N')" if deleted else na
    inact = f"count(*) FILTER (WHERE {deleted} = 'Y')" if deleted else na
    return (f"SELECT '{entity}' AS entity, '{process}' AS process, {ins} AS inserts, {upd_m} AS updates, "
            f"{del_m} AS deletes, count(*) AS total, {act} AS active, {inact} AS inactive, "
            f"'{fx.JOB_TIME}' AS job_time FROM {src}")


ORDERS_SINCE = count_select("orders_delta", "orders", "orders_delta", fx.AS_OF_SINCE, "created", "updated", "deleted")

SWEEP_PARTS = [
    count_select("orders_delta", "orders", "orders_delta", fx.AS_OF_SINCE, "created", "updated", "deleted"),
    count_select("lineitem_delta", "lines", "lineitem_delta", fx.AS_OF_SINCE, "created", "updated", None),
    count_select("events_delta", "events", "events_delta", fx.AS_OF_SINCE, "created", "updated", "deleted", typed=True),
    count_select("customer_totals", "customer", "customer_totals", fx.AS_OF_SINCE, None, None, None),
]
SWEEP_FIXTURES = ("orders_delta", "lineitem_delta", "events_delta", "customer_totals")


def sweep_sql(copies: int = 1, outer: str | None = None) -> str:
    body = "\nUNION ALL\n".join(SWEEP_PARTS * copies)
    if outer:
        body = outer.format(rows=f"({body})")
    return with_fixtures(body, *SWEEP_FIXTURES)


# --- registry / text lines ---------------------------------------------------------

REGISTRY_LINE = """
  concat_ws(',', 'q' || CAST(id % 3 AS VARCHAR), 'E' || CAST(id AS VARCHAR), 'p' || CAST(id % 7 AS VARCHAR),
            CASE WHEN id % 5 = 0 THEN 'NA' ELSE created END,
            CASE WHEN id % 4 = 0 THEN 'NA' ELSE updated END,
            CASE WHEN id % 6 = 0 THEN 'NA' ELSE deleted END)
  || CASE WHEN id % 2 = 0 THEN ',extra' ELSE '' END"""

ORACLES["src_registry"] = with_fixtures("""
SELECT 'q' || CAST(id % 3 AS VARCHAR) AS queue, 'E' || CAST(id AS VARCHAR) AS entity,
       'p' || CAST(id % 7 AS VARCHAR) AS process,
       CASE WHEN id % 5 = 0 THEN NULL ELSE created END AS created,
       CASE WHEN id % 4 = 0 THEN NULL ELSE updated END AS updated,
       CASE WHEN id % 6 = 0 THEN NULL ELSE deleted END AS deleted
FROM orders_delta""", "orders_delta")

ORACLES["src_fixed_width"] = """
SELECT CASE WHEN o_orderkey % 9 = 0 THEN left(code, 1) ELSE code END AS status_key,
       CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE trim(o_orderpriority) END AS status_description
FROM (SELECT o_orderkey, o_orderpriority,
             CASE o_orderstatus WHEN 'P' THEN '1P' WHEN 'F' THEN '2F' ELSE '3O' END AS code FROM orders) t"""

ORACLES["scan_table"] = "SELECT * FROM customer"

ORACLES["scan_filtered"] = with_fixtures(
    f"SELECT * FROM master_hub WHERE cir_src = '{fx.HUB_SOURCE}' AND status = '{fx.HUB_ACTIVE}'", "master_hub")

ORACLES["preview_limit"] = with_fixtures(
    f"SELECT {REGISTRY_LINE} AS value FROM orders_delta ORDER BY value LIMIT 10", "orders_delta")

ORACLES["delta_on_day_created_only"] = with_fixtures("""
SELECT 'orders' AS entity, 'orders_delta' AS process, count(*) FILTER (WHERE left(created, 10) = '1998-06-15') AS inserts,
       CAST(NULL AS BIGINT) AS updates, CAST(NULL AS BIGINT) AS deletes, '1998-06-15' AS as_of
FROM orders_delta""", "orders_delta")

# --- filters -------------------------------------------------------------------------

ORACLES["filter_not_blank"] = with_fixtures(
    "SELECT reg_no, reg_name, version_id FROM feed WHERE reg_name <> ''", "feed")
ORACLES["filter_blank_reject"] = with_fixtures(
    "SELECT reg_no, hq_no, status_code, version_id FROM feed WHERE reg_name = ''", "feed")
ORACLES["split_valid_reject_counts"] = with_fixtures("""
SELECT count(*) FILTER (WHERE reg_name <> '') AS valid, count(*) FILTER (WHERE reg_name = '') AS rejected,
       count(*) FILTER (WHERE reg_name IS NULL) AS dropped_null, count(*) AS total FROM feed""", "feed")
ORACLES["hq_split_counts"] = flow_sql(
    "SELECT count(*) FILTER (WHERE hq_no = '') AS blank_hq, count(*) FILTER (WHERE hq_no <> '') AS nonblank_hq FROM std")

# --- delta counts -----------------------------------------------------------------------

for _metric, _key in (("inserts", "delta_inserts_since"), ("updates", "delta_updates_since"),
                      ("deletes", "delta_deletes_since"), ("active", "delta_active"),
                      ("inactive", "delta_inactive")):
    ORACLES[_key] = with_fixtures(f"SELECT entity, process, {_metric} FROM ({ORDERS_SINCE}) t", "orders_delta")

ORACLES["delta_counts_since"] = with_fixtures(ORDERS_SINCE, "orders_delta")
ORACLES["delta_counts_on_day"] = with_fixtures(
    count_select("orders_delta", "orders", "orders_delta", fx.AS_OF_ON_DAY, "created", "updated", "deleted", mode="on"),
    "orders_delta")
ORACLES["delta_counts_typed"] = with_fixtures(
    count_select("events_delta", "events", "events_delta", fx.AS_OF_EVENTS, "created", "updated", "deleted", typed=True),
    "events_delta")
ORACLES["delta_counts_typed_on_day"] = with_fixtures(
    count_select("events_delta", "events", "events_delta", fx.AS_OF_EVENTS, "created", "updated", "deleted",
                 typed=True, mode="on"),
    "events_delta")
for _key in ("delta_counts", "delta_counts_on_day", "delta_counts_typed"):
    ORACLES[f"{_key}_pruned"] = ORACLES["delta_counts_since" if _key == "delta_counts" else _key]
ORACLES["delta_no_delete_col"] = with_fixtures(
    count_select("lineitem_delta", "lines", "lineitem_delta", fx.AS_OF_SINCE, "created", "updated", None),
    "lineitem_delta")
ORACLES["delta_totals_only"] = with_fixtures(
    count_select("customer_totals", "customer", "customer_totals", fx.AS_OF_SINCE, None, None, None),
    "customer_totals")
ORACLES["delta_registry_all"] = sweep_sql()
ORACLES["delta_registry_on_day"] = with_fixtures("\nUNION ALL\n".join([
    count_select("orders_delta", "orders", "orders_delta", fx.AS_OF_ON_DAY, "created", "updated", "deleted", mode="on"),
    count_select("lineitem_delta", "lines", "lineitem_delta", fx.AS_OF_ON_DAY, "created", "updated", None, mode="on"),
    count_select("events_delta", "events", "events_delta", fx.AS_OF_ON_DAY, "created", "updated", "deleted",
                 typed=True, mode="on"),
    count_select("customer_totals", "customer", "customer_totals", fx.AS_OF_ON_DAY, None, None, None, mode="on"),
]), *SWEEP_FIXTURES)

# --- scalar rules -------------------------------------------------------------------------

ORACLES["sc_day_prefix"] = with_fixtures(
    "SELECT id, left(created, 10) AS created_day, left(updated, 10) AS updated_day FROM orders_delta", "orders_delta")
ORACLES["sc_trim"] = with_fixtures("SELECT version_id, trim(reg_name) AS reg_name FROM feed", "feed")
ORACLES["sc_suffix_key"] = with_fixtures(
    f"SELECT version_id, {suffix_key('reg_no')} AS reg_no, {suffix_key('parent_no')} AS parent_no FROM feed", "feed")
ORACLES["sc_suffix_nonzero"] = with_fixtures(f"SELECT version_id, {suffix_nonzero('hq_no')} AS hq_no FROM feed", "feed")
ORACLES["sc_zero_to_blank"] = with_fixtures(
    f"SELECT version_id, {zero_to_blank('cro_number')} AS cro_number FROM feed", "feed")
ORACLES["sc_strip_letters"] = with_fixtures(
    f"SELECT version_id, {strip_letters('status_code')} AS status_code FROM feed", "feed")
ORACLES["sc_trim_keep_ws"] = with_fixtures(f"SELECT version_id, {trim_keep_ws('reg_name')} AS reg_name FROM feed", "feed")
ORACLES["sc_remove_first_const"] = with_fixtures(
    f"SELECT version_id, {remove_first('trading_status', chr(39) + '0' + chr(39))} AS trading_status FROM feed", "feed")
ORACLES["sc_remove_first_col"] = with_fixtures(
    f"SELECT cir_key, {remove_first('src_key5', 'src_key3')} AS cro_prefix FROM master_hub", "master_hub")
ORACLES["sc_format_job_time"] = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS job_time FROM events"
ORACLES["sc_row_to_delimited"] = with_fixtures(f"SELECT version_id, {delimited(FEED_COLS)} AS line FROM feed", "feed")

# --- dedup -----------------------------------------------------------------------------------

ORACLES["window_first_ts"] = with_fixtures("""
SELECT reg_no, version_id,
       CAST(max(ts_last_update) OVER (PARTITION BY reg_no) AS VARCHAR) AS max_ts
FROM feed WHERE reg_name <> ''""", "feed")
ORACLES["dedup_latest"] = flow_sql(
    "SELECT * REPLACE (CAST(ts_last_update AS VARCHAR) AS ts_last_update) FROM dedup")
ORACLES["dedup_latest_agg"] = ORACLES["dedup_latest"]
ORACLES["dedup_latest_refshape"] = with_fixtures("""
SELECT reg_no, CAST(max(ts_last_update) AS VARCHAR) AS ts_last_update
FROM feed WHERE reg_name <> '' AND ts_last_update IS NOT NULL GROUP BY reg_no""", "feed")
ORACLES["dedup_keys"] = with_fixtures("SELECT DISTINCT reg_no FROM feed WHERE reg_name <> ''", "feed")

# --- reconciliation --------------------------------------------------------------------------

ORACLES["join_lookup_inner"] = flow_sql("""
SELECT d.reg_no, d.status_code, l.status_description, d.version_id
FROM dedup d JOIN status_lookup l ON d.status_code = l.status_key""")
ORACLES["std_feed"] = flow_sql("SELECT * FROM std")
ORACLES["hq_universe"] = flow_sql("SELECT reg_no FROM keys")
ORACLES["hq_match_semi"] = flow_sql(
    "SELECT * FROM std WHERE hq_no <> '' AND EXISTS (SELECT 1 FROM keys k WHERE k.reg_no = std.hq_no)")
ORACLES["hq_unmatched_anti"] = flow_sql(
    "SELECT * FROM std WHERE hq_no <> '' AND NOT EXISTS (SELECT 1 FROM keys k WHERE k.reg_no = std.hq_no)")
ORACLES["union_accepted"] = flow_sql("SELECT * FROM accepted WHERE rejected_branch_record = 'N'")
ORACLES["union_accepted_rejected"] = flow_sql("SELECT * FROM accepted")
ORACLES["branch_flag"] = flow_sql("SELECT * FROM accepted")
ORACLES["branch_flag_custom_rules"] = flow_sql("""
SELECT CASE WHEN hq = '' OR hq IN (SELECT trim(reg_no) FROM valid WHERE ts_last_update IS NOT NULL AND trim(reg_no) <> '')
         THEN 'N' ELSE 'Y' END AS rejected_branch_record,
       trim(u.reg_no) AS reg_no, hq AS hq_no, s.parent_no, s.status_code, s.reg_name, s.country,
       CASE WHEN strpos(s.trading_status, '0') = 0 THEN ''
            ELSE left(s.trading_status, strpos(s.trading_status, '0') - 1)
                 || substr(s.trading_status, strpos(s.trading_status, '0') + 1) END AS trading_status, s.cro_number
FROM (SELECT *, CASE WHEN trim(replace(hq_no, '0', '')) = '' THEN '' ELSE trim(hq_no) END AS hq FROM looked_up) u
JOIN std s ON s.reg_no = u.reg_no || 'D'""")
ORACLES["master_view"] = flow_sql("SELECT * FROM master")
ORACLES["diff_full_outer"] = flow_sql(diff_select())
ORACLES["diff_full_outer_single"] = ORACLES["diff_full_outer"]
ORACLES["diff_full_outer_nullsafe"] = flow_sql(diff_select(null_safe=True, side=True, hq_null=True))
ORACLES["diff_full_outer_null_keys"] = flow_sql(diff_select(side=True, hq_null=True))
ORACLES["diff_full_outer_measured"] = ORACLES["diff_full_outer"]


def keyed_diff(left: str, right: str, cols: list[str], cond: str) -> str:
    """A full outer join of two selects with one row's side named."""
    shown = [f"a.{c} AS l_{c}" for c in cols] + [f"m.{c} AS r_{c}" for c in cols]
    return (f"SELECT {', '.join(shown)}, CASE WHEN a._l IS NOT NULL AND m._r IS NOT NULL THEN 'both' "
            "WHEN a._l IS NOT NULL THEN 'feed_only' ELSE 'master_only' END AS diff_side "
            f"FROM (SELECT {left}, 1 AS _l FROM accepted) a FULL OUTER JOIN (SELECT {right}, 1 AS _r FROM master) m ON {cond}")


_SHARED = "country || '-' || substr(reg_no, 6, 4) AS key, reg_no"
ORACLES["diff_full_outer_hot_keys"] = flow_sql(keyed_diff(_SHARED, _SHARED, ["key", "reg_no"], "a.key = m.key"))
_NULLABLE = "CASE WHEN hq_no <> '' THEN reg_no END AS key, reg_no, reg_name"
ORACLES["diff_single_nullable_key"] = flow_sql(
    keyed_diff(_NULLABLE, _NULLABLE, ["key", "reg_no", "reg_name"], "a.key = m.key"))
ORACLES["diff_mixed_key_types"] = flow_sql(keyed_diff(
    "left(reg_no, 9) AS reg_no, CAST(length(reg_name) AS INTEGER) AS name_chars",
    "CAST(left(reg_no, 9) AS BIGINT) AS reg_no, CAST(length(reg_name) AS BIGINT) AS name_chars",
    ["reg_no", "name_chars"], "CAST(a.reg_no AS BIGINT) = m.reg_no AND a.name_chars = m.name_chars"))
ORACLES["diff_summary"] = flow_sql(
    f"SELECT diff_side, count(*) AS records FROM ({diff_select(side=True)}) d GROUP BY diff_side")
ORACLES["feed_reconciliation"] = flow_sql(diff_select(side=True))

# --- sinks and report -------------------------------------------------------------------------

ORACLES["sink_delimited_roundtrip"] = with_fixtures(
    f"SELECT {delimited(FEED_COLS)} AS value FROM feed WHERE reg_name = ''", "feed")
_DIFF_COLS = [f"l_{c}" for c in ACCEPTED_COLS] + [f"r_{c}" for c in MASTER_COLS]
ORACLES["sink_diff_roundtrip"] = flow_sql(f"SELECT {delimited(_DIFF_COLS)} AS value FROM ({diff_select()}) d")
ORACLES["diff_records_typed"] = flow_sql(diff_select())
ORACLES["reject_records_malformed"] = with_fixtures(
    f"SELECT {delimited(['reg_no', 'country', 'reg_no', 'country'])} AS value, '4 fields in place of 3' AS reason "
    "FROM feed WHERE version_id % 5 = 0 AND reg_no IS NOT NULL AND country IS NOT NULL", "feed")
ORACLES["sink_overwrite_counts"] = sweep_sql()
ORACLES["sink_history_append"] = sweep_sql(copies=2)
ORACLES["sink_history_by_day"] = sweep_sql(outer=f"""
SELECT *, left(job_time, 10) AS job_date FROM {{rows}} t0
UNION ALL
SELECT * REPLACE ('{fx.JOB_TIME_NEXT_DAY}' AS job_time), left('{fx.JOB_TIME_NEXT_DAY}', 10) AS job_date FROM {{rows}} t1""")
ORACLES["report_consolidate"] = sweep_sql()
ORACLES["report_current"] = sweep_sql(outer="""
SELECT entity, process, coalesce(CAST(inserts AS VARCHAR), 'NA') AS inserts,
       coalesce(CAST(updates AS VARCHAR), 'NA') AS updates,
       coalesce(CAST(deletes AS VARCHAR), 'NA') AS deletes FROM {rows} t""")

_TD = "<td style=''text-align:center'';''color:DarkBlue'';''background-color:white''>"
ORACLES["report_html_rows"] = sweep_sql(outer=f"""
SELECT entity, process, inserts, updates, deletes,
       '<tr>' || '{_TD}' || entity || '</td>' || '{_TD}' || process || '</td>'
       || '{_TD}' || inserts || '</td>' || '{_TD}' || updates || '</td>'
       || '{_TD}' || deletes || '</td>' || '</tr>' AS html_row
FROM (SELECT entity, process, coalesce(CAST(inserts AS VARCHAR), 'NA') AS inserts,
             coalesce(CAST(updates AS VARCHAR), 'NA') AS updates,
             coalesce(CAST(deletes AS VARCHAR), 'NA') AS deletes FROM {{rows}} t0) t""")
ORACLES["stream_history_once"] = sweep_sql()
