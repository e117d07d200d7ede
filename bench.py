"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs twice in one session and writes
its whole result to the no-op sink; the second, warm run is reported, the first is given beside it.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame

from tallywind.session import local_session
from tallywind.suite import QUERIES

HEADLINE = [
    "dedupe_rows",
    "baseline_features",
    "history_rate_item_id",
    "daily_history_rate",
    "history_hour_std",
    "history_user_lifetime",
    "previous_day_count",
    "cumulative_before_count",
    "same_period_count",
    "point_in_time_features",
    "bin_level2",
    "label_encode",
    "item_cross",
    "user_cross",
    "user_item_cross",
    "user_shop_cross",
    "shop_item_cross",
    "cross_features",
    "log_loss",
    "roc_auc",
    "kfold",
    "fit_gbt",
    "fit_lr",
    "leaf_lr",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cores, shuffle_partitions=int(cores), memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, list[float]] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            consume(QUERIES[name](spark, folder))
            times.setdefault(name, []).append(round(time.perf_counter() - start, 3))
    warm = {name: runs[-1] for name, runs in times.items()}
    scale = re.search(r"sf([0-9.]+)", folder)
    report = {
        "metric": "warm seconds, sum of headline queries",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": {name: runs[0] for name, runs in times.items()},
        "sf": float(scale.group(1)) if scale else folder,
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
