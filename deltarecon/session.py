"""Session settings and the shared scratch folder.

The library never builds its own cluster session; callers pass ``spark``.
``local_session`` exists for tests, the benchmark and the examples.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the operators rely on at scale: AQE re-plans joins from runtime
# sizes (broadcast when a side turns out small, splits skewed partitions of
# joins, coalesces small shuffle partitions).
AQE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Local sessions (tests, bench) also pin the time zone for reproducible output.
RECOMMENDED_CONF = {**AQE_CONF, "spark.sql.session.timeZone": "UTC"}


def scale_conf(largest_shuffle_bytes: int, partition_bytes: int = 1 << 30,
               min_partitions: int = 200, max_partitions: int = 50_000) -> dict[str, str]:
    """SQL settings for a run whose largest shuffle moves ``largest_shuffle_bytes``.

    A shuffle has map tasks times reducers blocks, so both are kept in the tens of
    thousands: beyond ``max_partitions`` partitions grow instead, and spill.
    Shuffle partitions are sized so each holds about ``partition_bytes``
    (they fit in executor memory and spill gracefully); AQE then coalesces
    the small shuffles (count merges, key sets) down to the same target.
    For the feed job the largest shuffle is the dedup's, roughly the feed's
    size after the valid-name filter.
    """
    parts = min(max_partitions, max(min_partitions, -(-largest_shuffle_bytes // partition_bytes)))
    return {
        **AQE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def local_session(cores: int | str = "*", app: str = "deltarecon", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("DELTARECON_DRIVER_MEMORY", "8g"))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or spark.conf.get("spark.app.name", "app")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that folder must be set (a shared file system / object
    store path); it is read from the session. Only a local-mode session with
    nothing configured (tests) gets a fresh temporary folder.
    """
    app = _app_id(spark)
    d = spark.conf.get(CHECKPOINT_CONF, None) or _LOCAL_DIRS.get(app)
    if not d:
        # One machine: local, local[n] or local[n,m]. local-cluster stands for a cluster.
        if not re.match(r"local(\[.*\])?$", spark.conf.get("spark.master", "")):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="deltarecon-ckpt-")
        _LOCAL_DIRS[app] = d
    try:  # classic sessions: also register it for RDD checkpoints
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
    except Exception:  # Spark Connect has no SparkContext; the folder is only used for writes
        pass
    return d


# Local-mode fallback folders, per application (core confs cannot be set at run time).
_LOCAL_DIRS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder. The innermost open
    ``scratch_scope`` owns it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/deltarecon-scratch/{uuid.uuid4().hex}/{name}"
    if _SCOPES[-1] is not None:
        _SCOPES[-1].append(path)
    return path


# Paths of the open scopes, innermost last. Without a scope nobody deletes.
_SCOPES: list[list[str] | None] = [None]


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end, also on failure, all scratch copies made within it.

    A lazy DataFrame that reads such a copy can't be read after that: run its last
    action inside. Yields the paths; one taken out of the list stays, and becomes the
    caller's to delete.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.pop()
        for path in paths:
            remove_path(spark, os.path.dirname(path))


def hand_over(path: str) -> None:
    """Gives a path to the innermost open scope, as after its own scope has ended."""
    if _SCOPES[-1] is not None:
        _SCOPES[-1].append(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote (scratch copies after their last use)."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replaces the folder ``path`` by what ``write`` puts into a folder beside it.

    The old result stays in place until the new one is whole, so a failing write loses
    neither. The switch is two renames within one folder; if the second fails, the first
    is undone. A run that was killed between them leaves the old result as
    ``<path>.before``, which the next run puts back before it starts.
    """
    fs, target = _file_system(spark, path)
    fresh, before = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}", f"{path.rstrip('/')}.before"
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if fs.exists(as_path(before)):
        if fs.exists(target):
            fs.delete(as_path(before), True)
        else:
            fs.rename(as_path(before), target)
    try:
        write(fresh)
        had = fs.exists(target)
        if had and not fs.rename(target, as_path(before)):
            raise OSError(f"{path} can't be moved aside")
        if not fs.rename(as_path(fresh), target):
            if had:
                fs.rename(as_path(before), target)
            raise OSError(f"{fresh} can't be moved to {path}")
        fs.delete(as_path(before), True)
    finally:
        fs.delete(as_path(fresh), True)


def materialize(df, name: str = "materialized"):
    """``materialize_to`` a fresh path under the shared checkpoint folder."""
    return materialize_to(df, scratch_path(df.sparkSession, name))


def materialize_to(df, path: str):
    """Write ``df`` once as Parquet at ``path`` (a shared folder, normally
    under the checkpoint folder) and return a DataFrame reading that copy.

    Used where one intermediate feeds several branches of a plan: later
    branches read the written copy instead of recomputing its lineage (and
    can read only the columns they need), and a lost executor does not send
    the job back to the raw inputs. Never a local checkpoint: the copy must
    survive the loss of the executor that wrote it.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.types import NullType

    spark = df.sparkSession
    # Parquet cannot store an untyped NULL column (an uncast lit(None)).
    cols = [F.col(f.name).cast("string") if isinstance(f.dataType, NullType) else F.col(f.name)
            for f in df.schema.fields]
    out = df.select(*cols)
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)  # known schema: no inference job
