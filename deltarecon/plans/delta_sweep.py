"""Count changes for every table of a registry.

The registry is configuration (one short row per table), so it is read to
the driver to build one plan per table; the tables themselves are never
brought to the driver. Each table contributes one single-scan aggregation.

``delta_counts_for_registry`` returns one lazy plan (a balanced union).
``run_delta_counts`` plans a registry of any length in batches: every batch is
built, and so analysed, before anything runs; the batches are then counted, several
at a time, into staging folders under the checkpoint folder; and only when all have
succeeded is the output replaced, by one write of one file. A table that fails, at
whatever point, leaves the previous output as it was.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.deltas import COUNT_ROW_COLUMNS, delta_counts
from ..session import materialize_to, remove_path, scratch_path
from ..sinks.counts import write_count_rows
from ..sources.tables import TableResolver

# Tables planned together, and batches that run at a time.
BATCH_TABLES = 50
BATCHES_AT_ONCE = 4
RESOLVED_AT_ONCE = 16


def registry_entries(registry: DataFrame) -> list[dict]:
    """Registry rows as dicts, checked: every name present, no blank field.

    A blank field (e.g. a trailing comma) names no column; it fails the run
    like a short line does, instead of silently counting something else.
    """
    rows = registry.collect()
    entries = [r.asDict() for r in rows]
    for e in entries:
        if any(e[k] in (None, "") for k in ("queue", "entity", "process")):
            raise ValueError(f"registry row without queue, entity or process: {e}")
        if any(e[k] == "" for k in ("created", "updated", "deleted")):
            raise ValueError(f"registry row with a blank column name: {e}")
    return entries


def _union(parts: list[DataFrame]) -> DataFrame:
    """A balanced union (all parts have the count row's columns): no step holds more
    than twice what it adds, where a chain would analyse everything again each time."""
    while len(parts) > 1:
        parts = [a.union(b) for a, b in zip(parts[::2], parts[1::2])] + (parts[-1:] if len(parts) % 2 else [])
    return parts[0]


def _count_rows(entries: list[dict], resolve: TableResolver, as_of: str | dt.date,
                job_time: str | dt.datetime | None, mode: str, pruned: bool) -> list[DataFrame]:
    if not entries:
        raise ValueError("empty registry")

    known: dict = {}

    def one(e: dict) -> DataFrame | Exception:
        try:
            return delta_counts(resolve(e["queue"], e["process"]), as_of, e["created"], e["updated"], e["deleted"],
                                mode=mode, entity=e["entity"], process=e["process"], job_time=job_time,
                                known=known, pruned=pruned)
        except Exception as error:  # reported with the others
            return error

    # Resolving a table lists its files and reads a footer: many at a time.
    with ThreadPoolExecutor(RESOLVED_AT_ONCE) as pool:
        rows = list(pool.map(one, entries))
    failed = [(e, r) for e, r in zip(entries, rows) if isinstance(r, Exception)]
    if len(failed) == 1:
        raise failed[0][1]
    if failed:
        raise ExceptionGroup(f"{len(failed)} of {len(entries)} tables can't be counted: "
                             + ", ".join(f"{e['queue']}.{e['process']}" for e, _ in failed), [r for _, r in failed])
    return rows


def delta_counts_for_registry(
    registry: DataFrame,
    resolve: TableResolver,
    as_of: str | dt.date,
    job_time: str | dt.datetime | None = None,
    mode: str = "since",
    pruned: bool = False,
) -> DataFrame:
    """Count rows (entity, process, six counts, job_time) for every registry row;
    ``pruned`` as in ``delta_counts``."""
    return _union(_count_rows(registry_entries(registry), resolve, as_of, job_time, mode, pruned))


def run_delta_counts(
    registry: DataFrame,
    resolve: TableResolver,
    as_of: str | dt.date,
    output_path: str,
    job_time: str | dt.datetime | None = None,
    mode: str = "since",
    batch_tables: int = BATCH_TABLES,
    pruned: bool = False,
) -> None:
    """Replace ``output_path`` with one comma file of count rows, in registry order;
    ``pruned`` as in ``delta_counts``."""
    spark = registry.sparkSession
    rows = _count_rows(registry_entries(registry), resolve, as_of, job_time, mode, pruned)
    rows = [r.withColumn("_nth", F.lit(i)) for i, r in enumerate(rows)]
    batches = [_union(rows[i:i + batch_tables]) for i in range(0, len(rows), batch_tables)]
    stage = scratch_path(spark, "delta_counts")
    try:
        with ThreadPoolExecutor(BATCHES_AT_ONCE) as pool:
            done = list(pool.map(lambda b: materialize_to(b[1], f"{stage}/{b[0]}"), enumerate(batches)))
        write_count_rows(_union(done).orderBy("_nth").select(*COUNT_ROW_COLUMNS), output_path)
    finally:
        remove_path(spark, stage)
