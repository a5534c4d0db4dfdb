"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8): two warm-up passes over every query,
then three interleaved timed rounds; each time is the median of its rounds.
A run builds the DataFrame and executes it in full into Spark's ``noop``
sink (nothing is collected to the driver). Prints one JSON line.

``value`` is the sum of the headline medians; ``spark_jobs`` counts the
Spark jobs of one run of each query. ``comparisons`` times the
reference-shaped plans (one count job per metric, the three-branch union,
the ``max_by`` dedup, the single full outer join) next to the ones this
library uses.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deltarecon.harness import fixtures as fx  # noqa: E402
from deltarecon.harness.queries import QUERIES, _flow, _master, _valid  # noqa: E402
from deltarecon.operators import dedup, deltas, reconcile  # noqa: E402
from deltarecon.plans import feed_reconciliation as fr  # noqa: E402
from deltarecon.session import local_session  # noqa: E402

HEADLINE = [
    "delta_registry_all",
    "delta_counts_since",
    "dedup_latest",
    "window_first_ts",
    "branch_flag",
    "master_view",
    "diff_full_outer",
    "feed_reconciliation",
]


def run_df(build):
    t = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def run_call(fn):
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, app="deltarecon-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    runners = {name: (run_df, lambda n=name: QUERIES[n](spark, sf_dir)) for name in HEADLINE}
    od = lambda: fx.orders_delta(spark, sf_dir)
    extra = {
        "delta_counts_six_jobs": (run_call, lambda: deltas.delta_counts_separate(
            od(), fx.AS_OF_SINCE, "created", "updated", "deleted")),
        "branch_flag_three_branch_union": (run_df, lambda: QUERIES["union_accepted_rejected"](spark, sf_dir)),
        "dedup_max_by": (run_df, lambda: dedup.latest_per_key_agg(
            _valid(spark, sf_dir), "reg_no", "ts_last_update", "version_id")),
        "diff_single_full_outer": (run_df, lambda: reconcile.record_diff(
            fr.accepted_and_rejected(_flow(spark, sf_dir)), _master(spark, sf_dir), fx.DIFF_KEYS,
            strategy="full_outer")),
    }
    runners.update(extra)

    # Warm-up passes over everything (the JVM keeps speeding up for a few
    # rounds), then interleaved timed rounds, so no query profits from
    # running after the others have warmed the JIT.
    for _ in range(int(os.environ.get("BENCH_WARMUP", "2"))):
        for runner, arg in runners.values():
            runner(arg)
    samples = {k: [] for k in runners}
    sc = spark.sparkContext
    for rnd in range(repeats):
        for k, (runner, arg) in runners.items():
            sc.setJobGroup(f"bench-{rnd}-{k}", k)
            samples[k].append(runner(arg))
    med = {k: round(statistics.median(v), 3) for k, v in samples.items()}
    # Spark jobs per run (AQE submits each query stage as a job), last round.
    jobs = {k: len(sc.statusTracker().getJobIdsForGroup(f"bench-{repeats - 1}-{k}")) for k in runners}

    times = {k: med[k] for k in HEADLINE}
    comparisons = {
        "delta_counts_one_scan": med["delta_counts_since"],
        "delta_counts_six_jobs": med["delta_counts_six_jobs"],
        "branch_flag_one_join": med["branch_flag"],
        "branch_flag_three_branch_union": med["branch_flag_three_branch_union"],
        "dedup_row_number_window": med["dedup_latest"],
        "dedup_max_by": med["dedup_max_by"],
        "diff_split_skew_safe": med["diff_full_outer"],
        "diff_single_full_outer": med["diff_single_full_outer"],
    }
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "comparisons": comparisons,
        "spark_jobs": jobs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
