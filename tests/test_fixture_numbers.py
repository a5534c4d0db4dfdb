"""The expected numbers written in FIXTURES.md (sf0.01), as golden values."""

import pytest

from deltarecon.harness import fixtures as fx
from deltarecon.harness.queries import QUERIES, reconciliation
from deltarecon.operators.deltas import delta_counts

from .conftest import SF_CHECK

COLS = ("inserts", "updates", "deletes", "total", "active", "inactive")


def counts(df):
    r = df.first()
    return tuple(r[c] for c in COLS)


@pytest.mark.parametrize("table,as_of,cols,mode,expected", [
    ("orders_delta", "1998-06-15", ("created", "updated", "deleted"), "since", (7201, 3598, 1836, 15000, 10067, 4933)),
    ("orders_delta", "2001-07-30", ("created", "updated", "deleted"), "since", (13, 17, 10, 15000, 10067, 4933)),
    ("orders_delta", "2001-07-30", ("created", "updated", "deleted"), "on", (3, 5, 4, 15000, 10067, 4933)),
    ("lineitem_delta", "1998-06-15", ("created", "updated", None), "since", (29506, 21127, None, 60000, None, None)),
    ("events_delta", "2024-01-15", ("created", "updated", "deleted"), "since", (5332, 3112, 775, 10000, 7986, 2014)),
    ("events_delta", "2024-01-15", ("created", "updated", "deleted"), "on", (317, 172, 51, 10000, 7986, 2014)),
    ("customer_totals", "2024-01-15", (None, None, None), "since", (None, None, None, 1500, None, None)),
])
def test_delta_numbers(spark, table, as_of, cols, mode, expected):
    df = fx.DELTA_TABLES[table](spark, SF_CHECK)
    assert counts(delta_counts(df, as_of, *cols, mode=mode)) == expected


def test_feed_and_reconciliation_numbers(spark):
    split = QUERIES["split_valid_reject_counts"](spark, SF_CHECK).first()
    assert (split.valid, split.rejected, split.dropped_null, split.total) == (14433, 272, 295, 15000)
    assert QUERIES["dedup_keys"](spark, SF_CHECK).count() == 1440
    hq = QUERIES["hq_split_counts"](spark, SF_CHECK).first()
    assert (hq.blank_hq, hq.nonblank_hq) == (212, 758)
    assert QUERIES["hq_match_semi"](spark, SF_CHECK).count() == 656
    assert QUERIES["hq_unmatched_anti"](spark, SF_CHECK).count() == 102
    rec = reconciliation(spark, SF_CHECK)
    assert rec.accepted.count() == 970 and rec.master.count() == 1090
    sides = {r.diff_side: r["count"] for r in rec.diff.groupBy("diff_side").count().collect()}
    assert sides == {"both": 319, "feed_only": 651, "master_only": 771}
