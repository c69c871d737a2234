"""Benchmark: run the headline queries on one scale and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is executed in full through the ``noop`` sink (nothing is
collected), after one warm-up query that is not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scenecast.plans import catalog  # noqa: E402
from scenecast.session import get_session  # noqa: E402

HEADLINE = [
    "series_hourly", "series_daily", "feature_table", "feature_table_daily", "lag_two_level",
    "file_timestamp_s", "nearest_hour_files", "day_report", "scene_stats", "scene_stats_long",
    "scene_rejects", "split_counts", "persistence_scores", "residual_histogram",
    "feature_correlation", "top_errors_per_model", "model_overlay", "standardized",
    "feature_table_by_series", "scores_by_series", "linreg_by_series",
    "linreg_nine", "tree", "forest", "boosted", "backtest_saved",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", "scenecast-bench", conf={
        "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["series_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    # series, 8 features + lags, train before 2024-01-24): the training frame
    # is built and cached once, then each estimator is fitted on it.
    from scenecast.operators import models as mdl
    train, _ = catalog.h_frames(spark, sf_dir)
    train = train.cache()
    train.count()
    fits = {
        "fit_linear_regression": lambda: mdl.linear_pipeline(catalog._H9),
        "fit_decision_tree": lambda: mdl.tree_pipeline(catalog._H9),
        "fit_random_forest": lambda: mdl.forest_pipeline(catalog._H9),
        "fit_boosted_50_rounds": lambda: mdl.boosted_pipeline(catalog._H9, maxIter=50),
    }
    for name, make in fits.items():
        t0 = time.perf_counter()
        make().fit(train)
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
