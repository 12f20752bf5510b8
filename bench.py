"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from panelyx.plans import QUERIES

HEADLINE = [
    "factor_groups_forward_return", "calendar_flags", "universe_interval", "universe_masks", "weekly_bar", "rolling_features", "ewm_trend", "rolling_beta", "winsor_mad", "zscores",
    "bucket_returns", "xsec_residual", "information_coefficient", "portfolio_return", "portfolio_turnover", "performance_by_year", "minute_moments", "minute_corr", "long_short_game",
    "pit_ttm", "pit_yoy", "pit_mean", "asof_fundamental", "analyst_consensus", "label_simple",
    "net_performance", "portfolio_return_vwap", "factor_roe_ttm", "label_similar", "factor_test", "consensus_whole", "exposure_graph",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run(HEADLINE[0])  # the first run starts the JVM's compilers
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
