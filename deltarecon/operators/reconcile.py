"""Joins of the feed reconciliation: lookup, parent check, master build, diff."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .broadcast import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    df_col: str,
    lookup_col: str,
    keep: Sequence[str] = (),
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Inner equi-join to a code lookup; rows with an unknown code are dropped.

    Duplicate lookup keys fan out (inner-join semantics). Only the columns
    of ``df`` plus ``keep`` lookup columns are returned. Codes have few
    distinct values, so a shuffle join would put each code in one task; the
    lookup is broadcast when its size is proven small.
    """
    lk = broadcast_if_small(lookup, max_broadcast_rows)
    joined = df.join(lk, df[df_col] == lk[lookup_col], "inner")
    return joined.select(*[df[c] for c in df.columns], *[lk[c] for c in keep])


def parent_keys(keys: DataFrame, key_col: str, deduplicate: bool = True) -> DataFrame:
    """Non-blank parent candidates, as a single ``_parent_key`` column.

    ``deduplicate=False`` skips the aggregation: for keys already free of
    duplicates, or for semi / anti joins, which do not fan out. It also
    leaves the join with a plain shuffle on this side, the shape AQE needs to
    split a skewed partition of the other side (one parent owning a large
    share of the rows).
    """
    pk = keys.select(F.col(key_col).alias("_parent_key")).filter(F.col("_parent_key") != "")
    return pk.distinct() if deduplicate else pk


def match_parent(rows: DataFrame, keys: DataFrame, parent_col: str, key_col: str) -> DataFrame:
    """Rows with a non-blank parent that exists among ``keys`` (left semi join).

    Semi and anti joins never fan out on duplicate keys, so the key side is
    not deduplicated: both inputs stay plain shuffles and AQE can split a
    hot parent's partition.
    """
    pk = parent_keys(keys, key_col, deduplicate=False)
    nb = rows.filter(F.col(parent_col) != "")
    return nb.join(pk, nb[parent_col] == pk["_parent_key"], "left_semi")


def orphans(rows: DataFrame, keys: DataFrame, parent_col: str, key_col: str) -> DataFrame:
    """Rows with a non-blank parent missing from ``keys`` (left anti join)."""
    pk = parent_keys(keys, key_col, deduplicate=False)
    nb = rows.filter(F.col(parent_col) != "")
    return nb.join(pk, nb[parent_col] == pk["_parent_key"], "left_anti")


def flag_missing_parent(
    rows: DataFrame,
    keys: DataFrame,
    parent_col: str,
    key_col: str,
    flag_col: str = "rejected_branch_record",
    rejected: str = "Y",
    accepted: str = "N",
    keys_distinct: bool = False,
) -> DataFrame:
    """All rows, flagged ``rejected`` when their non-blank parent is unknown.

    One left join to the distinct keys replaces the split / semi / anti /
    union of the reference.

    Rows with a blank parent never need a partner. A NULL join key would send
    all of them (every head office: easily a third of the rows) to the one
    partition NULL hashes to, so their join key is a hash of the row
    instead (spread evenly), and a residual condition keeps them from ever
    matching. A NULL parent (the standardised parent never is) is spread the
    same way and flagged rejected.

    Skew: a parent shared by a large share of rows lands in one partition of
    the left side; with ``keys_distinct=True`` both join inputs are plain
    shuffles and AQE's skew-join handling splits it (left outer joins split
    the left side).
    """
    pk = parent_keys(keys, key_col, deduplicate=not keys_distinct)
    parent = F.col(parent_col)
    no_partner = parent.isNull() | (parent == "")
    left = rows.withColumns({
        "_has_parent": ~no_partner,
        "_jk": F.when(no_partner, F.xxhash64(*[F.col(c) for c in rows.columns]).cast("string")).otherwise(parent),
    })
    cond = (left["_jk"] == pk["_parent_key"]) & left["_has_parent"]
    joined = left.join(pk, cond, "left")
    # blank parent: accepted; known parent: accepted; unknown or NULL parent: rejected
    flag = (
        F.when(parent == "", F.lit(accepted))
        .when(pk["_parent_key"].isNotNull(), F.lit(accepted))
        .otherwise(F.lit(rejected))
    )
    return joined.select(flag.alias(flag_col), *[left[c] for c in rows.columns])


# Rows that share one key from which on "measured" takes a key apart.
HOT_ROWS = 1_000_000
# Hot keys that "measured" sends to every task; with more it does what "split" does.
MAX_HOT_KEYS = 10_000
# Buckets of keys that "measured" counts before keys: no key has more rows than its bucket.
KEY_BUCKETS = 1 << 20


def compared_type(spark: SparkSession, left_type: str, right_type: str, null_safe: bool = False) -> str | None:
    """The type that ``left = right`` is compared as, by the analyser's own rules; None
    where it isn't a comparison of two values of one type."""
    if left_type == right_type:
        return left_type
    probe = spark.createDataFrame([], f"l {left_type}, r {right_type}")
    equal = F.col("l").eqNullSafe(F.col("r")) if null_safe else F.col("l") == F.col("r")
    test = probe.select(equal.alias("e"))._jdf.queryExecution().analyzed().expressions().head().child()
    if test.nodeName() not in ("EqualTo", "EqualNullSafe"):
        return None
    types = {side.dataType().simpleString() for side in (test.left(), test.right())}
    return types.pop() if len(types) == 1 else None


class _Diff:
    """Both sides of a record diff, keyed alike, and the joins between parts of them."""

    def __init__(self, left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool, left_prefix: str,
                 right_prefix: str) -> None:
        self.keys, self.null_safe = list(keys), null_safe
        self.prefixes = left_prefix, right_prefix
        ltypes, rtypes = dict(left.dtypes), dict(right.dtypes)
        common = {k: compared_type(left.sparkSession, ltypes[k], rtypes[k], null_safe) for k in keys}
        # A pair without a common type is left to the residual test.
        self.hashed = {k: t for k, t in common.items() if t is not None}
        self.left, self.right = self._keyed(left, 0), self._keyed(right, 1)
        self.out_cols = [f"{p}{c}" for p, df in zip(self.prefixes, (left, right)) for c in df.columns]
        self.types = dict(self.left.dtypes) | dict(self.right.dtypes)

    def key_hash(self, df: DataFrame) -> Column:
        values = [F.col(k).cast(t) for k, t in self.hashed.items()]
        # Hashing skips NULLs: where they are is part of the key.
        return F.xxhash64(*values, *[v.isNull() for v in values if self.null_safe])

    def matchable(self) -> Column:
        """Whether a row can have a partner: a NULL equals nothing, unless compared so."""
        return F.lit(True) if self.null_safe else reduce(and_, [F.col(k).isNotNull() for k in self.keys])

    def _keyed(self, df: DataFrame, side: int) -> DataFrame:
        # Rows without a partner meet none: their hash is the row's and the side's, so that
        # they are spread, and the other side has nothing under it.
        row = [F.col(c) for c, t in df.dtypes if "map<" not in t and "variant" not in t]
        h = F.when(self.matchable(), self.key_hash(df)).otherwise(F.xxhash64(F.lit(side), *row))
        return df.select(*[F.col(c).alias(f"{self.prefixes[side]}{c}") for c in df.columns],
                         F.lit(True).alias(("_in_left", "_in_right")[side]), h.alias("_h"), self.matchable().alias("_m"))

    def _on(self, left: DataFrame, right: DataFrame, right_names: Sequence[str] | None = None) -> Column:
        names = right_names or [f"{self.prefixes[1]}{k}" for k in self.keys]
        pairs = [(left[f"{self.prefixes[0]}{k}"], right[n]) for k, n in zip(self.keys, names)]
        equal = [a.eqNullSafe(b) if self.null_safe else a == b for a, b in pairs]
        # In a coalesce the test stays a residual and doesn't become a join key.
        return (left["_h"] == right["_h"]) & F.coalesce(reduce(and_, equal), F.lit(False))

    def _shown(self, df: DataFrame) -> DataFrame:
        """All columns of the result; those of an absent side are NULL."""
        names = [*self.out_cols, "_in_left", "_in_right"]
        return df.select(*[df[c] if c in df.columns else F.lit(None).cast(self.types[c]).alias(c) for c in names])

    def full_outer(self, left: DataFrame, right: DataFrame) -> DataFrame:
        return self._shown(left.drop("_m").join(right.drop("_m"), self._on(left, right), "full_outer"))

    def split(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """``full_outer`` as two joins whose streamed sides AQE can split."""
        partners = left.filter("_m")
        matched_and_right = right.join(partners, self._on(partners, right), "left")
        names = [f"{self.prefixes[1]}{k}" for k in self.keys]
        rkeys = right.filter("_m").select(*[F.col(c).alias(f"_rk_{i}") for i, c in enumerate(names)], "_h").distinct()
        left_only = left.join(rkeys, self._on(left, rkeys, [f"_rk_{i}" for i in range(len(names))]), "left_anti")
        return self._shown(matched_and_right).unionByName(self._shown(left_only))

    def hot_keys(self, df: DataFrame, hot_rows: int, buckets: int = KEY_BUCKETS) -> list[tuple[int | None]] | None:
        """Hashes with more than ``hot_rows`` rows (None stands for the rows without a
        partner); None if there are more than ``MAX_HOT_KEYS``. Reads the key columns
        alone. Buckets of keys are counted first, in part before the shuffle, which so
        carries at most ``buckets`` rows a task however many keys there are; keys only
        within buckets of more than ``hot_rows`` rows, if there are any."""
        rows = df.select(F.when(self.matchable(), self.key_hash(df)).alias("h"))
        rows = rows.withColumn("b", F.coalesce(F.pmod("h", F.lit(buckets)), F.lit(-1)))

        def above(by: str) -> list[int | None] | None:
            counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
            found = [r[0] for r in counts.select(by).limit(MAX_HOT_KEYS + 1).collect()]
            return found if len(found) <= MAX_HOT_KEYS else None

        full = above("b")
        if full == []:
            return []
        if full is not None:
            rows = rows.filter(F.col("b").isin(full))
        found = above("h")
        return None if found is None else [(h,) for h in found]


def record_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    left_prefix: str = "l_",
    right_prefix: str = "r_",
    side_col: str | None = None,
    side_names: tuple[str, str, str] = ("both", "left_only", "right_only"),
    strategy: str = "split",
    left_is_copy: bool = False,
    left_is_unique: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Full outer join on ``keys``: matched pairs plus each side's leftovers.

    With plain equality (default) a NULL in any key column never matches, so
    such a record shows up once per side. ``null_safe=True`` compares with
    ``<=>``. Output columns are prefixed per side (no ambiguous names); with
    ``side_col`` a label column tells ``both`` / left only / right only.

    Joins are on one hash of the key columns, with the columns themselves as a
    residual test: rows are shuffled and sorted by eight bytes instead of by
    every key. Key columns of different types are hashed as the type that ``=``
    compares them in. Rows with a NULL key can't have a partner: they are
    spread by a hash of the row and meet no row of the other side.

    ``strategy``:

    * ``"split"`` (default) computes the same rows as
      ``right LEFT JOIN left`` (every right record, with its matches)
      ``UNION ALL left ANTI JOIN distinct(right keys)`` (left records without
      a match). AQE can split a skewed partition of the streamed side of a
      left outer or anti join, but not of a full outer join; here a group of
      copies on the right (a third of all rows with equal keys) is streamed
      and split, and the anti join probes right keys that a partial
      aggregation has already reduced to one row each. Put the side that is
      unique on its keys (the deduplicated feed) on the left.
      Both branches read the left side, so it is written once to
      the shared checkpoint folder first (``left_is_copy=True``: it already is a
      written copy): it is computed once, and a record whose dedup had a tie is
      the same record in both branches.
    * ``"measured"`` first counts the rows of each key, from the key columns
      alone. Keys with more than ``hot_rows`` rows (few: at most rows / hot_rows)
      go the way of ``"split"``, all others through one full outer join, which
      reads each side once. Without hot keys that is the whole plan. Pass
      ``left_is_unique=True`` where no two left rows share all keys: the left
      side then isn't counted, nor written unless there are hot keys.
    * ``"full_outer"``: one sort-merge full outer join on the key columns (one task
      per hot key).

    Copies belong to the innermost ``session.scratch_scope``.

    Output size is ``pairs + unmatched``; with the left side unique on its
    keys that is at most ``|left| + |right|`` rows.
    """
    if strategy not in ("split", "measured", "full_outer"):
        raise ValueError("strategy must be 'split', 'measured' or 'full_outer'")

    def copied(df: DataFrame) -> DataFrame:
        return df if left_is_copy else materialize(df, "diff_left")

    if strategy == "split" or strategy == "measured" and not left_is_unique:
        left, left_is_copy = copied(left), True
    diff = _Diff(left, right, keys, null_safe, left_prefix, right_prefix)
    if strategy == "full_outer" or not diff.hashed:
        lk, rk = [f"{left_prefix}{k}" for k in keys], [f"{right_prefix}{k}" for k in keys]
        lsel, rsel = diff.left.drop("_h", "_m"), diff.right.drop("_h", "_m")
        eqs = [lsel[x].eqNullSafe(rsel[y]) if null_safe else lsel[x] == rsel[y] for x, y in zip(lk, rk)]
        joined = lsel.join(rsel, reduce(and_, eqs), "full_outer")
    elif strategy == "split":
        joined = diff.split(diff.left, diff.right)
    else:
        found = [diff.hot_keys(right, hot_rows), [] if left_is_unique else diff.hot_keys(left, hot_rows)]
        hot = None if None in found else {h for part in found for h, in part}
        if hot == set():
            joined = diff.full_outer(diff.left, diff.right)
        else:
            diff = _Diff(copied(left), right, keys, null_safe, left_prefix, right_prefix)
            joined = diff.split(diff.left, diff.right) if hot is None else _hot_apart(diff, hot)
    if side_col:
        both, lonly, ronly = side_names
        side = (
            F.when(F.col("_in_left").isNotNull() & F.col("_in_right").isNotNull(), F.lit(both))
            .when(F.col("_in_left").isNotNull(), F.lit(lonly))
            .otherwise(F.lit(ronly))
        )
        return joined.select(*diff.out_cols, side.alias(side_col))
    return joined.select(*diff.out_cols)


def _hot_apart(diff: _Diff, hot: set[int | None]) -> DataFrame:
    """The diff with the rows of hot keys in joins that AQE can split. A key's rows are all
    hot or all not, so the parts add up; rows without a partner need no join if hot."""
    spark = diff.left.sparkSession
    # At most MAX_HOT_KEYS numbers a side: small enough for every task.
    keys = F.broadcast(spark.createDataFrame([(h,) for h in hot if h is not None], "hot long"))
    parts, cold, warm = [], [], []
    for df in (diff.left, diff.right):
        if None in hot:
            parts.append(diff._shown(df.filter("not _m")))
            df = df.filter("_m")
        is_hot = (df["_h"] == keys["hot"]) & df["_m"]
        cold.append(df.join(keys, is_hot, "left_anti"))
        warm.append(df.join(keys, is_hot, "left_semi"))
    return reduce(DataFrame.unionByName, [diff.full_outer(*cold), diff.split(*warm), *parts])
