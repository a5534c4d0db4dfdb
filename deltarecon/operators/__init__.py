"""DataFrame -> DataFrame operators: change counts, filters, dedup, joins."""

from .broadcast import broadcast_if_small, has_at_most
from .dedup import dedup_keys, latest_keys_with_ts, latest_per_key, latest_per_key_agg, with_latest_ts
from .deltas import delta_counts
from .filters import filter_blank, filter_not_blank, split_counts, split_valid_reject
from .reconcile import flag_missing_parent, lookup_join, match_parent, orphans, record_diff
