"""Headline queries, timed one after the other.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the
local cores; names on the command line choose other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skylattice.plans import registry  # noqa: E402
from skylattice.session import build_session  # noqa: E402

HEADLINE = [
    "src_constraint",
    "dedup_key",
    "join_inner",
    "join_natural",
    "join_outer_reduce",
    "join_knn",
    "join_interp_grid",
    "agg_group_mean",
    "agg_describe",
    "agg_level_stats",
    "agg_block_moments",
    "agg_first_index",
    "agg_percentile_band",
    "agg_hist",
    "pivot_mean",
    "ts_resample",
    "ts_shift_return",
    "ts_rolling_std",
    "ts_fill_both",
    "ts_interpolate",
    "ts_zscore_group",
    "grid_gradient",
    "grid_advection",
    "fn_rle_decode",
    "ft_bow_pad",
    "ft_standardise_level",
    "sm_stratified",
    "tile_pure",
    "mt_threshold_sweep",
    "mt_level_contingency",
    "ml_linreg_ci",
    "ml_partial_pool",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", str(cpus), cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    # start the session's code paths before anything is timed
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
