"""Feed reconciliation: clean a record feed and diff it against the master.

Steps (the size probe of the lookup and the written copy of the accepted feed run when
the plan is built; the rest is lazy):

1. split on a blank name: valid rows go on, blank ones to the reject sink;
2. latest version per record key (deterministic tie-break);
3. keep rows whose status code is in the lookup (broadcast join);
4. standardise every column with native column rules;
5. flag rows whose non-blank parent key is not a known record key
   (one left join to the distinct keys instead of split + semi + anti + union);
6. build the master view (record detail joined to the key hub);
7. full outer diff on the chosen columns.

Column names, rules and filters are parameters (``FeedSpec``); the defaults
describe the harness feed (see FIXTURES.md).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import (
    remove_first,
    strip_letters,
    suffix_key,
    suffix_nonzero,
    trim_keep_ws,
    trim_text,
    zero_to_blank,
)
from ..operators.dedup import dedup_keys, latest_per_key
from ..operators.filters import split_valid_reject
from ..operators.reconcile import (
    flag_missing_parent,
    lookup_join,
    match_parent,
    orphans,
    record_diff,
)
from ..session import materialize_to, remove_path, scratch_path
from ..sinks.delimited import write_delimited
from ..sources.tables import scan_filtered

Rule = Callable[[Column], Column]

# Rules of the harness feed; every other column is trimmed.
DEFAULT_RULES: dict[str, Rule] = {
    "reg_no": suffix_key,
    "hq_no": suffix_nonzero,
    "parent_no": suffix_key,
    "status_code": strip_letters,
    "reg_name": trim_keep_ws,
    "cro_number": zero_to_blank,
}

FEED_COLUMNS = (
    "reg_no", "hq_no", "parent_no", "status_code", "reg_name",
    "country", "trading_status", "cro_number", "ts_last_update",
)

# Fixed value: the character removed once from the trading status.
TRADING_STATUS_DROP = "0"


@dataclass(frozen=True)
class FeedSpec:
    key: str = "reg_no"
    ts: str = "ts_last_update"
    tiebreak: tuple[str, ...] = ("version_id",)
    name: str = "reg_name"
    status: str = "status_code"
    parent: str = "hq_no"
    lookup_key: str = "status_key"
    columns: tuple[str, ...] = FEED_COLUMNS
    rules: Mapping[str, Rule] = field(default_factory=lambda: dict(DEFAULT_RULES))
    flag_col: str = "rejected_branch_record"  # fixed value
    trading_status: str | None = "trading_status"
    null_names: str = "drop"
    # Whether the parent check shuffles keys and parents alone; None: if rows are wide.
    narrow_parent_check: bool | None = None


# Columns from which on rows count as wide.
WIDE_COLUMNS = 16


def standardize(df: DataFrame, columns: Sequence[str], rules: Mapping[str, Rule]) -> DataFrame:
    """Project ``columns``, each through its rule (default: ``trim_text``)."""
    return df.select(*[rules.get(c, trim_text)(F.col(c)).alias(c) for c in columns])


def _injective(spec: FeedSpec) -> bool:
    """Whether distinct raw keys stay distinct (non-blank ones, which alone can match)."""
    return spec.rules.get(spec.key, trim_text) is suffix_key


def feed_flow(feed: DataFrame, lookup: DataFrame, spec: FeedSpec = FeedSpec()) -> dict[str, DataFrame]:
    """The named intermediate results of steps 1-5 (all lazy)."""
    valid, reject = split_valid_reject(feed, spec.name, spec.null_names)
    dedup = latest_per_key(valid, spec.key, spec.ts, spec.tiebreak)
    looked_up = lookup_join(dedup, lookup, spec.status, spec.lookup_key)
    std = standardize(looked_up, spec.columns, spec.rules)
    # Record keys that survive the dedup, in standardised form. Computed from
    # the key and stamp columns alone (a narrow partial aggregation), not from
    # the deduplicated rows, so the wide dedup is not evaluated twice.
    keys = dedup_keys(valid.filter(F.col(spec.ts).isNotNull()), spec.key).select(
        spec.rules.get(spec.key, trim_text)(F.col(spec.key)).alias(spec.key)
    )
    if not _injective(spec):  # several raw keys may have become one
        keys = keys.distinct()
    return {"valid": valid, "reject": reject, "dedup": dedup, "lookup_joined": looked_up, "std": std, "keys": keys}


def _finish(flagged: DataFrame, spec: FeedSpec) -> DataFrame:
    out = [c for c in spec.columns if c != spec.ts]
    cols = []
    for c in out:
        if c == spec.trading_status:
            cols.append(remove_first(F.col(c), literal=TRADING_STATUS_DROP).alias(c))
        else:
            cols.append(F.col(c))
    return flagged.select(spec.flag_col, *cols)


def _flagged_by_key(flow: Mapping[str, DataFrame], spec: FeedSpec) -> DataFrame:
    """``flag_missing_parent`` without shuffling rows by their parent.

    The rows are partitioned by record key after the dedup. The pairs of key and parent
    of all versions are checked instead (two columns, distinct, by parent), and those
    with a known parent are joined back by key, to the rows where they are. Which
    version won a tie doesn't matter: every version's pair is there. A NULL key (one
    record at most) equals nothing in a join, and goes the wide way.
    """
    key = "_record_key"
    parent = spec.rules.get(spec.parent, trim_text)
    std = [spec.rules.get(c, trim_text)(F.col(c)).alias(c) for c in spec.columns]
    rows = flow["lookup_joined"].filter(F.col(spec.key).isNotNull()).select(F.col(spec.key).alias(key), *std)
    versions = flow["valid"].filter(F.col(spec.ts).isNotNull() & F.col(spec.key).isNotNull())
    pairs = versions.select(F.col(spec.key).alias("_pair_key"), parent(F.col(spec.parent)).alias("_pair_parent"))
    known = match_parent(pairs.distinct(), flow["keys"], "_pair_parent", spec.key)
    # In a coalesce the parent stays a residual, and the key alone is the join key.
    same = (rows[key] == known["_pair_key"]) & F.coalesce(rows[spec.parent] == known["_pair_parent"], F.lit(False))
    accepted = (rows[spec.parent] == "") | known["_pair_key"].isNotNull()
    flag = F.when(accepted, F.lit("N")).otherwise(F.lit("Y")).alias(spec.flag_col)
    flagged = rows.join(known, same, "left").select(flag, *[rows[c] for c in spec.columns])
    unkeyed = flow["lookup_joined"].filter(F.col(spec.key).isNull()).select(*std)
    return flagged.unionByName(
        flag_missing_parent(unkeyed, flow["keys"], spec.parent, spec.key, spec.flag_col, keys_distinct=True))


def accepted_and_rejected(flow: Mapping[str, DataFrame], spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Step 5, one pass: every standardised row with its parent flag."""
    narrow = spec.narrow_parent_check
    if narrow or narrow is None and len(spec.columns) > WIDE_COLUMNS:
        return _finish(_flagged_by_key(flow, spec), spec)
    # keys are distinct: see feed_flow
    flagged = flag_missing_parent(flow["std"], flow["keys"], spec.parent, spec.key, spec.flag_col, keys_distinct=True)
    return _finish(flagged, spec)


def accepted_union(flow: Mapping[str, DataFrame], spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Accepted rows the reference way: parent found UNION ALL blank parent."""
    std = flow["std"]
    matched = match_parent(std, flow["keys"], spec.parent, spec.key)
    blank = std.filter(F.col(spec.parent) == "")
    acc = matched.unionByName(blank).withColumn(spec.flag_col, F.lit("N"))
    return _finish(acc, spec)


def accepted_rejected_union(flow: Mapping[str, DataFrame], spec: FeedSpec = FeedSpec()) -> DataFrame:
    """Accepted UNION ALL orphans (flag ``Y``), the reference's three-branch shape."""
    rej = orphans(flow["std"], flow["keys"], spec.parent, spec.key).withColumn(spec.flag_col, F.lit("Y"))
    return accepted_union(flow, spec).unionByName(_finish(rej, spec))


# --- master view -------------------------------------------------------------

def default_master_mapping(detail: DataFrame, hub: DataFrame) -> dict[str, Column]:
    """Output column -> expression over the detail and hub sides. The names are fixed values."""
    return {
        "cir_key": trim_text(detail["cir_key"]),
        "status": F.trim(hub["status"]),
        "reg_no": F.trim(hub["src_key1"]),
        "hq_no": F.trim(hub["src_key4"]),
        "status_code": F.trim(hub["src_key2"]),
        "reg_name": F.trim(detail["reg_name"]),
        "country": F.trim(detail["country"]),
        "trading_status": F.trim(remove_first(detail["trading_status"], literal=TRADING_STATUS_DROP)),
        "cro_prefix": F.trim(remove_first(hub["src_key5"], hub["src_key3"])),
        "cro_number": F.trim(hub["src_key3"]),
        "data_owner": F.lit(""),
    }


MasterMapping = Callable[[DataFrame, DataFrame], Mapping[str, Column]]


def named_master_mapping(columns: Mapping[str, str]) -> MasterMapping:
    """A mapping from text: output column -> ``detail.col``, ``hub.col`` (both trimmed as
    text), ``'constant'`` in single quotes, ``remove_first(side.col, side.col)``, or
    ``remove_first(side.col, 'text')``."""

    def column(text: str, sides: Mapping[str, DataFrame]) -> Column:
        side, dot, name = text.strip().partition(".")
        if not dot or side not in sides:
            raise ValueError(f"{text!r} names no column of {sorted(sides)}")
        return sides[side][name].cast("string")

    def one(text: str, sides: Mapping[str, DataFrame]) -> Column:
        text = text.strip()
        if text.startswith("'") and text.endswith("'") and len(text) > 1:
            return F.lit(text[1:-1])
        if text.startswith("remove_first(") and text.endswith(")"):
            value, _, search = text[len("remove_first("):-1].partition(",")
            search = search.strip()
            if search.startswith("'"):
                return F.trim(remove_first(column(value, sides), literal=search.strip("'")))
            return F.trim(remove_first(column(value, sides), column(search, sides)))
        return F.trim(column(text, sides))

    return lambda detail, hub: {n: one(t, {"detail": detail, "hub": hub}) for n, t in columns.items()}


def build_master(
    detail: DataFrame,
    hub: DataFrame,
    hub_filter: Mapping[str, object],
    key: str = "cir_key",
    mapping: MasterMapping = default_master_mapping,
) -> DataFrame:
    """Master view: detail joined to the filtered hub on the surrogate key."""
    h = scan_filtered(hub, **hub_filter)
    joined = detail.join(h, detail[key] == h[key], "inner")
    return joined.select(*[e.alias(n) for n, e in mapping(detail, h).items()])


# --- whole job ---------------------------------------------------------------

@dataclass
class Reconciliation:
    diff: DataFrame
    rejects: DataFrame
    accepted: DataFrame
    master: DataFrame
    # Intermediate copies under the checkpoint folder.
    scratch: tuple[str, ...] = ()

    def drop_scratch(self) -> None:
        """Deletes the intermediate copies; ``write_reconciliation`` does so at its end."""
        for path in self.scratch:
            remove_path(self.diff.sparkSession, path)


def feed_reconciliation(
    feed: DataFrame,
    lookup: DataFrame,
    detail: DataFrame,
    hub: DataFrame,
    hub_filter: Mapping[str, object],
    diff_keys: Sequence[str],
    spec: FeedSpec = FeedSpec(),
    side_names: tuple[str, str, str] = ("both", "feed_only", "master_only"),
    diff_strategy: str = "measured",
    checkpoint_inputs: bool = True,
    master_key: str = "cir_key",
    master_mapping: MasterMapping = default_master_mapping,
) -> Reconciliation:
    """Steps 1-7 as lazy DataFrames.

    The default ``measured`` diff counts the master's rows by key first (its key
    columns alone), and needs joins that read a side twice for keys with very many
    rows only. With ``checkpoint_inputs`` the accepted feed (the expensive side: feed
    scan, dedup shuffle, parent join) is written once as Parquet to the shared
    checkpoint folder here, so the dedup never runs twice and a lost
    executor does not restart it. The master side is a 1:1 key join whose second use reads
    only the key columns, so recomputing it is cheaper than writing it.
    """
    flow = feed_flow(feed, lookup, spec)
    accepted = accepted_and_rejected(flow, spec)
    master = build_master(detail, hub, hub_filter, master_key, master_mapping)
    scratch: tuple[str, ...] = ()
    if checkpoint_inputs and diff_strategy != "full_outer":
        copy = scratch_path(accepted.sparkSession, "accepted_feed")
        accepted, scratch = materialize_to(accepted, copy), (copy,)
    diff = record_diff(accepted, master, diff_keys, side_col="diff_side", side_names=side_names,
                       strategy=diff_strategy, left_is_copy=bool(scratch),
                       left_is_unique=spec.key in diff_keys and _injective(spec))
    return Reconciliation(diff=diff, rejects=flow["reject"], accepted=accepted, master=master, scratch=scratch)


def write_reconciliation(rec: Reconciliation, result_path: str, reject_path: str | None = None,
                         mode: str = "errorifexists", label_sides: bool = False) -> None:
    """Write the diff as delimited records (both sides' columns) and the rejects.

    The diff is written first and the rejects last, so a failed run never
    leaves a reject folder behind that would block the re-run. The copies that
    the plan made are deleted at the end, also of a failed run; ``rec`` can't be
    read after that.
    """
    diff = rec.diff if label_sides else rec.diff.drop("diff_side")
    try:
        write_delimited(diff, result_path, mode=mode)
        if reject_path is not None:
            write_delimited(rec.rejects, reject_path, mode=mode)
    finally:
        rec.drop_scratch()
