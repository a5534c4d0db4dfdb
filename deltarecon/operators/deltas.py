"""Change counts of one table: inserts, updates, deletes, total, active, inactive.

All six metrics are conditional counts over the same rows, so they are
computed in **one** aggregation (one scan, map-side partial counts, a single
tiny final merge) instead of one query and one job per metric.

Day semantics: a stamp counts by its day ``yyyy-MM-dd``. For text columns
that is the first ten characters compared as text; when every stamp column
involved is a ``date`` / ``timestamp`` the same comparison is done on
``to_date`` values, which avoids building strings per row.

A metric is only defined when every column it needs is known (``None`` =
"not available", ``NA`` in a registry):

========  ==========================================  =====================
metric    ``since`` (on or after day)                  needs
========  ==========================================  =====================
inserts   created >= d AND updated >= d                created, updated
updates   updated >= d AND updated != created          created, updated
          [AND deleted = 'N' when deleted is known]
deletes   updated >= d AND updated != created          created, updated,
          AND deleted = 'Y'                            deleted
total     every row                                    -
active    deleted = 'N'                                deleted
inactive  deleted = 'Y'                                deleted
========  ==========================================  =====================

``mode='on'`` replaces ``>= d`` by ``= d``; inserts test only the created day
and need only that column. A row whose stamp or flag is NULL never satisfies a predicate, so it is
in ``total`` only; ``active + inactive`` may be below ``total``.

``pruned=True`` counts in two scans instead of one. The changes are counted behind a
filter that Parquet can skip row groups and pages by (``updated >= d``); ``total``,
``active`` and ``inactive`` need the flag column alone, or no column at all. On a large
table that is written in the order of its stamps, neither scan reads the stamps of old
rows. Where old and new rows lie mixed, one scan is the better plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import MutableMapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.formatting import format_job_time
from ..functions.rules import day_prefix

# Soft-delete flag values.
DELETED_FLAG = "Y"
LIVE_FLAG = "N"

COUNT_COLUMNS = ("inserts", "updates", "deletes", "total", "active", "inactive")
COUNT_ROW_COLUMNS = ("entity", "process", *COUNT_COLUMNS, "job_time")

COUNT_ROW_SCHEMA = T.StructType(
    [T.StructField("entity", T.StringType()), T.StructField("process", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNT_COLUMNS]
    + [T.StructField("job_time", T.StringType())]
)

_TYPED_DAY = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _c(name: str) -> Column:
    """Column by its exact name (registry names may contain dots or spaces)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def _day_exprs(df: DataFrame, cols: list[str], as_of: str | dt.date) -> tuple[dict[str, Column], Column]:
    """Day expression per stamp column plus the as-of literal to compare with."""
    types = {f.name: f.dataType for f in df.schema.fields}
    typed = bool(cols) and all(isinstance(types[c], _TYPED_DAY) for c in cols)
    d = _as_date(as_of)
    if typed:
        return {c: F.to_date(_c(c)) for c in cols}, F.lit(d)
    return {c: day_prefix(_c(c)) for c in cols}, F.lit(d.isoformat())


def delta_metric_columns(
    df: DataFrame,
    as_of: str | dt.date,
    created: str | None = None,
    updated: str | None = None,
    deleted: str | None = None,
    mode: str = "since",
) -> list[Column]:
    """The six aggregate expressions (bigint, NULL when not available)."""
    if mode not in ("since", "on"):
        raise ValueError(f"mode must be 'since' or 'on', not {mode!r}")
    stamps = [c for c in (created, updated) if c is not None]
    day, d = _day_exprs(df, stamps, as_of)
    na = F.lit(None).cast("bigint")

    def reached(c: Column) -> Column:
        return c >= d if mode == "since" else c == d

    live = _c(deleted) == F.lit(LIVE_FLAG) if deleted else None
    gone = _c(deleted) == F.lit(DELETED_FLAG) if deleted else None

    inserts = updates = deletes = na
    if created and mode == "on":
        inserts = F.count_if(reached(day[created]))
    if created and updated:
        crt, upd = day[created], day[updated]
        if mode == "since":
            inserts = F.count_if(reached(crt) & reached(upd))
        changed = reached(upd) & (upd != crt)
        updates = F.count_if(changed & live) if deleted else F.count_if(changed)
        deletes = F.count_if(changed & gone) if deleted else na

    return [
        inserts.alias("inserts"),
        updates.alias("updates"),
        deletes.alias("deletes"),
        F.count(F.lit(1)).alias("total"),
        (F.count_if(live) if deleted else na).alias("active"),
        (F.count_if(gone) if deleted else na).alias("inactive"),
    ]


def delta_counts(
    df: DataFrame,
    as_of: str | dt.date,
    created: str | None = None,
    updated: str | None = None,
    deleted: str | None = None,
    *,
    mode: str = "since",
    entity: str | None = None,
    process: str | None = None,
    job_time: str | dt.datetime | None = None,
    known: MutableMapping[tuple, list[Column]] | None = None,
    pruned: bool = False,
) -> DataFrame:
    """One count row for ``df``: entity, process, six counts, job_time.

    ``job_time`` defaults to the query's current timestamp; pass a value for
    reproducible output. ``known`` keeps the aggregate expressions between calls: they
    name columns only, so tables whose columns are called alike share them. ``pruned``
    reads the changes through a filter, in a scan of their own; the counts are the same.
    """
    known = {} if known is None else known
    kinds = tuple(df.schema[c].dataType.typeName() for c in (created, updated) if c is not None)
    asked = (str(as_of), created, updated, deleted, mode, kinds)
    if asked not in known:
        known[asked] = delta_metric_columns(df, as_of, created, updated, deleted, mode)
    aggs = known[asked]
    if job_time is None:
        jt = format_job_time(F.current_timestamp())
    elif isinstance(job_time, dt.datetime):
        jt = F.lit(job_time.strftime("%Y-%m-%d %H:%M:%S"))
    else:
        jt = F.lit(str(job_time))
    reached = _may_have_changed(df, as_of, created, updated, mode) if pruned else None
    counts = df.agg(*aggs) if reached is None else _two_scans(df, aggs, reached)
    return counts.select(
        F.lit(entity).cast("string").alias("entity"),
        F.lit(process).cast("string").alias("process"),
        *COUNT_COLUMNS,
        jt.alias("job_time"),
    )


def _may_have_changed(df: DataFrame, as_of: str | dt.date, created: str | None, updated: str | None,
                      mode: str) -> Column | None:
    """True for every row that a change metric counts, as a test that scans can prune by;
    None where no such metric is available."""
    if not created or not updated and mode == "since":
        return None
    days, d = _day_exprs(df, [c for c in (created, updated) if c], as_of)
    types = {f.name: f.dataType for f in df.schema.fields}
    text = _as_date(as_of).isoformat()

    def reached(c: str) -> Column:
        if types[c] == T.StringType():
            # Of text with this prefix and text above it the same holds as of the first ten characters.
            return _c(c) >= F.lit(text) if mode == "since" else _c(c).startswith(text)
        return days[c] >= d if mode == "since" else days[c] == d

    if mode == "since":
        return reached(updated)
    return reached(created) | reached(updated) if updated else reached(created)


def _two_scans(df: DataFrame, aggs: list[Column], reached: Column) -> DataFrame:
    """The six counts, changes from the rows that may hold any, the others from all rows."""
    changes, states = COUNT_COLUMNS[:3], COUNT_COLUMNS[3:]
    na = F.lit(None).cast("bigint")
    parts = [df.filter(reached).agg(*aggs[:3]).select(*changes, *[na.alias(c) for c in states]),
             df.agg(*aggs[3:]).select(*[na.alias(c) for c in changes], *states)]
    return parts[0].unionAll(parts[1]).agg(*[F.max(c).alias(c) for c in COUNT_COLUMNS])


def day_count_row(counts: DataFrame, as_of: str | dt.date) -> DataFrame:
    """The six fields of an exact-day row: entity, process, the three changes, the day."""
    return counts.select("entity", "process", "inserts", "updates", "deletes",
                         F.lit(_as_date(as_of).isoformat()).alias("as_of"))


def delta_counts_separate(
    df: DataFrame,
    as_of: str | dt.date,
    created: str | None = None,
    updated: str | None = None,
    deleted: str | None = None,
    *,
    mode: str = "since",
) -> dict[str, int | None]:
    """Same numbers the old way: one filtered count job per metric.

    Kept only as the comparison point for the benchmark and the equivalence
    test; it rescans the table for every metric.
    """
    exprs = delta_metric_columns(df, as_of, created, updated, deleted, mode)
    return {name: df.agg(expr).first()[0] for name, expr in zip(COUNT_COLUMNS, exprs)}
