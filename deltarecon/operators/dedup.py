"""Latest version per key.

Semantics (kept from the reference job): only rows whose stamp equals the
key's newest stamp survive; a key whose stamps are all NULL disappears (NULL
never equals anything); a NULL key forms one group like any other. The
reference then kept an arbitrary row among ties; here ties are broken by
``tiebreak`` columns (newest first), so the result is deterministic.

Scale: rows with a NULL stamp can never win, so they are filtered before any
shuffle. The winner is ``row_number() = 1`` over the key ordered by stamp and
tie-break; Spark plans this as a *partial* ``WindowGroupLimit`` before the
shuffle and a final one after it, so a key holding a third of all rows still
sends at most one row per input partition through the shuffle and never
becomes one huge task. ``latest_per_key_agg`` gives the same rows with a
``max_by`` aggregation (also partial), measured slower in ``bench.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def latest_per_key_agg(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    tiebreak: str | Sequence[str] = (),
) -> DataFrame:
    """``latest_per_key`` as a ``max_by`` aggregation over a row struct."""
    keys = _as_list(key)
    order = [ts, *_as_list(tiebreak)]
    rest = [c for c in df.columns if c not in keys]
    winner = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys)
        .agg(winner.alias("_w"))
        .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    ts: str,
    tiebreak: str | Sequence[str] = (),
) -> DataFrame:
    """One row per key: greatest ``ts``, then greatest ``tiebreak`` values."""
    keys = _as_list(key)
    order = [F.col(c).desc_nulls_last() for c in [ts, *_as_list(tiebreak)]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.filter(F.col(ts).isNotNull())
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def latest_stamp_per_key(df: DataFrame, key: str | Sequence[str], ts: str, out: str = "max_ts") -> DataFrame:
    """Key and its newest stamp (partial aggregation, skew safe)."""
    keys = _as_list(key)
    return df.groupBy(*keys).agg(F.max(ts).alias(out))


def with_latest_ts(df: DataFrame, key: str | Sequence[str], ts: str, out: str = "max_ts") -> DataFrame:
    """Every row with the newest stamp of its key attached.

    Equal to ``first(ts) over (partition by key order by ts desc)``. Written
    as aggregate-then-join instead of a window: the aggregate is partial, and
    the join of all rows to one row per key is an equi-join whose skewed
    partitions AQE can split, whereas a window must hold a hot key's whole
    group in a single task.
    """
    keys = _as_list(key)
    renamed = {k: f"_latest_key_{i}" for i, k in enumerate(keys)}
    latest = latest_stamp_per_key(df, keys, ts, out).select(
        *[F.col(k).alias(renamed[k]) for k in keys], F.col(out)
    )
    cond = [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys]
    return df.join(latest, on=cond, how="left").select(*df.columns, out)


def latest_keys_with_ts(df: DataFrame, key: str | Sequence[str], ts: str) -> DataFrame:
    """Key and newest stamp of every key that survives the dedup.

    Exactly what the reference pipeline's dedup keeps on key and stamp, which
    does not depend on how ties are broken.
    """
    keys = _as_list(key)
    return df.filter(F.col(ts).isNotNull()).groupBy(*keys).agg(F.max(ts).alias(ts))


def dedup_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Distinct keys (``dropDuplicates`` on the key, survivor irrelevant)."""
    return df.select(*_as_list(key)).distinct()
