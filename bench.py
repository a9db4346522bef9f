"""Time the headline queries and print one JSON line.

Each query runs once to warm up the JVM (not counted) and is then timed; its rows are written to a
sink that discards them, so the whole result is computed and nothing is collected."""

import json
import os
import sys
import time

from airloom import workload
from airloom.session import local_session

HEADLINE = [
    "e1_p2_feature_plan", "a15_persistence_by_station", "w3_pollutant_lags", "w7_aqi_rolling_means_long",
    "w8_pm_rolling_means_long", "w15_interpolation", "w16_deduplicate_keep_first", "j1_weather_air_quality_join",
    "j2_spatial_points_wide", "j8_u3_missing_steps", "a1_a2_summary_per_station",
    "a3_j9_daily_mean_with_empty_days", "a6_f18_monthly_distribution", "a8_correlation_ranking",
    "a16_scaler_statistics", "f9_upwind_blend", "f11_j6_classify", "i7_hourly_tumbling_means",
    "m1_ridge_cross_validated", "m7_batch_scoring", "m9_linear_contributions", "s2_date_chunks", "t2_latest_row",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = workload.queries(), {}
    for name in names:
        for counted in (False, True):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            if not counted:
                print(f"{name:40s} first {seconds[name]:.2f}", end=" ", file=sys.stderr)
        print(f"then {seconds[name]:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
