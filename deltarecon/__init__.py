"""deltarecon: table deltas and record reconciliation as Spark DataFrame operators.

Most used entry points::

    from deltarecon import delta_counts, delta_counts_for_registry, run_delta_counts
    from deltarecon import latest_per_key, flag_missing_parent, record_diff
    from deltarecon import FeedSpec, feed_reconciliation, write_reconciliation
"""

from .operators.dedup import dedup_keys, latest_per_key, with_latest_ts
from .operators.deltas import delta_counts
from .operators.filters import split_counts, split_valid_reject
from .operators.reconcile import flag_missing_parent, lookup_join, match_parent, orphans, record_diff
from .plans.delta_sweep import delta_counts_for_registry, run_delta_counts
from .plans.feed_reconciliation import FeedSpec, build_master, feed_reconciliation, standardize, write_reconciliation
from .plans.report import consolidate_and_publish, report_current, report_html_rows
from .session import local_session, materialize

__all__ = [
    "FeedSpec", "build_master", "consolidate_and_publish", "dedup_keys", "delta_counts",
    "delta_counts_for_registry", "feed_reconciliation", "flag_missing_parent", "latest_per_key",
    "local_session", "lookup_join", "match_parent", "materialize", "orphans", "record_diff",
    "report_current", "report_html_rows", "run_delta_counts", "split_counts", "split_valid_reject",
    "standardize", "with_latest_ts", "write_reconciliation",
]
