"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query writes all its columns to a no-op sink. It runs once to warm up and then
``BENCH_RUNS`` times; the median is reported. Deriving the stored panel tables is timed on
its own, and so is each query's own work.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.plans import QUERIES  # noqa: E402
from tickloom.session import build_session  # noqa: E402
from tickloom.sources import fixtures  # noqa: E402

HEADLINE = [
    "q1_high_volatility", "q2_price_trends", "q3_sentiment_correlation", "q4_macro_correlation", "q5_sentiment_momentum",
    "q6_price_breakouts", "q7_reconciliation", "w4_rolling_mean", "w8_running", "w9_ewm", "w9_wide_panel", "w4_rolling_ticks", "w8_running_ticks",
    "w9_ewm_ticks", "p7_forward_fill_ticks", "w12_sequences",
    "t1_sma", "t2_ema", "t3_rsi", "t5_bollinger", "t6_macd", "t8_adx", "t10_obv", "t11_cci", "t14_volume", "p9_fill_all",
    "p11_interpolate", "j6_as_of_macro", "j6_as_of_ticks", "j9_keyword_tags", "a3_time_buckets", "a4_resample_week",
    "a13_quantiles", "f1_lag_features", "f10_sentiment_features", "f15_full_features", "f16_combine_sources",
    "x1_clean_text", "x2_lexicon_score", "x4_sentiment_table", "s8_page_paragraphs", "k6_upsert", "m4_ranking_metrics",
    "m7_backtest", "m13_arima", "m14_grid_search", "m16_recursive_forecast", "m3_linear_regression",
    "m1_random_forest_regression", "m2_gradient_boosted_regression", "r3_last_rows", "r7_tick_bars",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in ("bars", "bars_ev", "macro", "predictions", "bars_li", "ticks_panel"):
        start = time.perf_counter()
        getattr(fixtures, name)(spark, sf_dir)
        seconds[f"derive_{name}"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(took[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
