"""Catalog tables laid out for the jobs that read them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, keys: str | Sequence[str], buckets: int,
                   mode: str = "overwrite") -> None:
    """Save ``df`` as a catalog table bucketed and sorted by ``keys``.

    A feed stored bucketed by its record key is deduplicated without a
    shuffle: the window's partitioning is already satisfied by the buckets.
    Pick ``buckets`` so one bucket file is a few hundred MB.
    """
    cols = [keys] if isinstance(keys, str) else list(keys)
    df.write.mode(mode).bucketBy(buckets, *cols).sortBy(*cols).saveAsTable(table)
