"""Times the headline queries and prints one JSON line.

Each query is run to its end into a sink that discards the rows: once untimed, then ``BENCH_RUNS``
times (once by default), of which the median counts.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from tidemark import build_session
from workload import registry

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

HEADLINE = (
    "feature_table_suppliers", "feature_table_60", "moving_averages", "ema", "macd", "rsi_simple",
    "bollinger", "atr", "stochastic", "macd_cut", "lexicon_sentiment", "daily_sentiment", "news_top_n",
    "news_phrase_match", "sentiment_join", "sentiment_windows", "scan_csv_dir", "pivot_wide",
    "dashboard_series", "direction_label", "chrono_split", "minmax_scale", "sequences",
    "classification_metrics", "feature_importance", "logistic_baseline", "sequence_regressor",
    "sequence_classifier", "timeframe_filter", "score_latest", "news_extract", "ema_long_cut", "drawdown_cut",
    "sequence_store_digest", "phrase_sentiment", "wide_blocks", "publish_replace", "profile_grown",
)


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def timed(name: str) -> float:
        run(name)
        return round(median(run(name) for _ in range(RUNS)), 3)

    seconds = {name: timed(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS)}))


if __name__ == "__main__":
    main()
