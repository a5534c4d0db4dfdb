"""Write the physical plans of the headline queries to docs/plans.md.

python tools_plans.py [sf_dir]   (default /root/testdata/sf0.1)

For each query: the operator tree of ``explain("formatted")`` plus the
scan lines (ReadSchema, PushedFilters), taken before execution, so AQE's
runtime changes (broadcast conversion, coalescing, skew splits) are not
shown; tests/test_skew.py checks those.
"""

import contextlib
import io
import re
import sys

from deltarecon.harness.queries import QUERIES
from deltarecon.session import local_session

NAMES = ["delta_counts_since", "delta_registry_all", "dedup_latest", "window_first_ts", "branch_flag",
         "master_view", "diff_full_outer", "feed_reconciliation"]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
    scans = [m.group(0) for m in re.finditer(r"\(\d+\) Scan [^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]*", text)]
    keep = []
    for s in scans:
        lines = [ln for ln in s.split("\n") if ln.startswith(("(", "PushedFilters", "ReadSchema"))]
        keep.append("\n".join(lines))
    return tree.rstrip() + "\n\n" + "\n".join(keep)


def skew_section(spark, sf):
    """Executed (AQE final) join lines with forced hot keys, thresholds lowered
    so the small tables count as skewed, coalescing off (several map outputs)."""
    from pyspark.sql import functions as F

    from deltarecon.harness import fixtures as fx
    from deltarecon.harness.queries import _lookup, _master
    from deltarecon.operators import reconcile
    from deltarecon.plans import feed_reconciliation as fr

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    feed = fx.feed(spark, sf)
    hot_parent = feed.withColumn("hq_no", F.when(F.col("version_id") % 2 == 0, F.lit("000000020")).otherwise(F.col("hq_no")))
    flag = fr.accepted_and_rejected(fr.feed_flow(hot_parent, _lookup(spark)))
    acc = fr.accepted_and_rejected(fr.feed_flow(feed, _lookup(spark)))
    copies = _master(spark, sf).withColumns(
        {c: F.when(F.col("cir_key") % 2 == 0, F.lit("X")).otherwise(F.col(c)) for c in fx.DIFF_KEYS})
    diff = reconcile.record_diff(acc, copies, fx.DIFF_KEYS, side_col="side")
    out = ["## AQE under forced hot keys", "",
           "Half the feed versions name one head office (parent flag); half the master rows are copies with "
           "equal diff keys (record diff). Executed plans, join and shuffle-read lines only:", ""]
    for title, df in (("parent flag", flag), ("record diff (split)", diff)):
        df.collect()
        final = formatted_final(df)
        lines = [ln.rstrip() for ln in final.split("\n") if "SortMergeJoin" in ln or "AQEShuffleRead" in ln]
        out += [f"### {title}", "", "```", *lines, "```", ""]
    for k in conf:
        spark.conf.unset(k)
    return out


def formatted_final(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools_plans.py` at `{sf}` (local[8], before execution: AQE may still turn "
           "shuffle joins into broadcasts, coalesce partitions and split skewed ones at run time).", ""]
    for n in NAMES:
        out += [f"## `{n}`", "", "```", summary(formatted(QUERIES[n](spark, sf))), "```", ""]
    out += skew_section(spark, "/root/testdata/sf0.01")
    with open("docs/plans.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
