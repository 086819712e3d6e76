"""Time the headline queries; prints one JSON line.

Each query is planned and collected through a noop sink, so that reading,
fitting and writing the result count, and moving it to the driver does not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricewright.plans.registry import QUERIES  # noqa: E402
from pricewright.session import local_session  # noqa: E402

HEADLINE = (
    "q_feature_sql", "q_describe", "q_count_year_type", "q_box_stats", "q_letter_values",
    "q_histogram", "q_kde", "q_dummies", "q_standardize_pop", "q_features", "q_lr_flagship",
    "q_cv_avg", "q_dt", "q_rf", "q_gbt", "q_rff_regression", "q_knn", "q_leaderboard_fixed",
    "q_score_saved", "q_telemetry",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's and the Python workers' machinery outside the clock
    QUERIES["q_count_year_type"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        begun = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - begun, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
