"""Aggregations A1-A14."""

from pyspark.sql import functions as F

from tickloom.operators import aggregates as A
from tickloom.operators import panel as P
from tickloom.operators import patterns as Q
from tickloom.plans import sql as S
from tickloom.plans.joins import WIDE
from tickloom.plans.registry import query, rounded
from tickloom.sources import fixtures as X

BASE = ("ticker", "date")


@query("a1_daily_sentiment", f"""WITH {S.SENTIMENT} SELECT ticker, date, round(avg(polarity), 8) AS avg_polarity,
 round(avg(subjectivity), 8) AS avg_subjectivity FROM sentiment GROUP BY 1, 2""")
def a1(spark, sf):
    return A.daily_mean_sentiment(X.sentiment(spark, sf)).select(*BASE, *rounded(8, "avg_polarity", "avg_subjectivity"))


@query("a2_sentiment_profile", f"""WITH {S.SENTIMENT} SELECT ticker, date, round(avg(polarity), 8) AS polarity_mean,
 round(stddev_samp(polarity), 8) AS polarity_std, count(polarity) AS polarity_count, round(avg(subjectivity), 8) AS subjectivity_mean,
 round(stddev_samp(subjectivity), 8) AS subjectivity_std FROM sentiment GROUP BY 1, 2""")
def a2(spark, sf):
    df = A.daily_sentiment_profile(X.sentiment(spark, sf))
    return df.select(*BASE, *rounded(8, "polarity_mean", "polarity_std"), "polarity_count",
                     *rounded(8, "subjectivity_mean", "subjectivity_std"))


@query("a3_time_buckets", f"""WITH {S.TICKS},
 b AS (SELECT ticker, time_bucket(INTERVAL 10 MINUTE, ts) AS bucket, avg(price) AS m, count(price) AS n FROM ticks GROUP BY 1, 2),
 s AS (SELECT ticker, unnest(generate_series(min(bucket), max(bucket), INTERVAL 10 MINUTE)) AS bucket FROM b GROUP BY ticker)
 SELECT ticker, bucket, round(m, 6) AS mean_value, coalesce(n, 0) AS n FROM s LEFT JOIN b USING (ticker, bucket)""")
def a3(spark, sf):
    return A.time_buckets(X.ticks(spark, sf), "ts", "price", "10 minutes").select("ticker", "bucket", *rounded(6, "mean_value"), "n")


_AGG = """arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume"""


def _resampled(label, spine):
    return f"""WITH {S.BARS},
 r AS (SELECT ticker, {label} AS period_end, {_AGG} FROM bars GROUP BY 1, 2), s AS ({spine})
 SELECT ticker, period_end, open, high, low, close, coalesce(volume, 0) AS volume FROM s LEFT JOIN r USING (ticker, period_end)"""


@query("a4_resample_week", _resampled("CAST(CAST(date_trunc('week', date) AS DATE) + 6 AS DATE)", """SELECT ticker, CAST(unnest(generate_series(min(period_end), max(period_end), INTERVAL 7 DAY)) AS DATE) AS period_end
 FROM r GROUP BY ticker"""))
def a4_week(spark, sf):
    return A.resample(X.bars(spark, sf), "W")


@query("a4_resample_month", _resampled("last_day(date)", """SELECT ticker, last_day(CAST(unnest(generate_series(date_trunc('month', min(period_end)), date_trunc('month', max(period_end)), INTERVAL 1 MONTH)) AS DATE)) AS period_end
 FROM r GROUP BY ticker"""))
def a4_month(spark, sf):
    return A.resample(X.bars(spark, sf), "M")


@query("a4_resample_day", _resampled("date", """SELECT ticker, CAST(unnest(generate_series(min(period_end), max(period_end), INTERVAL 1 DAY)) AS DATE) AS period_end
 FROM r GROUP BY ticker"""))
def a4_day(spark, sf):
    return A.resample(X.bars(spark, sf), "D")


@query("a4_resample_custom", f"""WITH {S.BARS} SELECT ticker, CAST(CAST(date_trunc('week', date) AS DATE) + 6 AS DATE) AS period_end, round(avg(close), 4) AS mean_close,
 max(volume) AS peak_volume FROM bars GROUP BY 1, 2""")
def a4_custom(spark, sf):
    df = A.resample(X.bars(spark, sf), "W", {"mean_close": F.avg("close"), "peak_volume": F.max("volume")}, fill_empty=False)
    return df.select("ticker", "period_end", *rounded(4, "mean_close"), "peak_volume")


@query("a5_monthly_range", f"""WITH {S.BARS} SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS month,
 round((max(close) - min(close)) / nullif(min(close), 0), 8) AS monthly_range_return FROM bars GROUP BY 1, 2""")
def a5(spark, sf):
    return A.monthly_range(X.bars(spark, sf)).select("ticker", "month", *rounded(8, "monthly_range_return"))


@query("a6_monthly_mean", f"""WITH {S.MACRO} SELECT series_id, CAST(date_trunc('month', date) AS DATE) AS month, round(avg(value), 6) AS indicator_value
 FROM macro GROUP BY 1, 2""")
def a6(spark, sf):
    return A.monthly_mean(X.macro(spark, sf)).select("series_id", "month", *rounded(6, "indicator_value"))


@query("a7_volatility", f"""WITH {S.BARS}, r AS (SELECT ticker, close / nullif(lag(close) OVER {S.W}, 0) - 1 AS r FROM bars)
 SELECT ticker, round(stddev_samp(r), 6) AS volatility FROM r GROUP BY ticker""")
def a7(spark, sf):
    return A.volatility(Q.with_return(X.bars(spark, sf), P.BARS), ("ticker",), "daily_return").select("ticker", *rounded(6, "volatility"))


@query("a8_correlation", f"""WITH {S.BARS} SELECT ticker, round(corr(close, volume), 8) AS correlation,
 CASE WHEN corr(close, volume) > 0.7 THEN 'Strong Positive' WHEN corr(close, volume) >= 0.3 THEN 'Positive'
 WHEN corr(close, volume) >= -0.3 THEN 'Weak' WHEN corr(close, volume) >= -0.7 THEN 'Negative' ELSE 'Strong Negative' END AS correlation_strength
 FROM bars GROUP BY ticker""")
def a8(spark, sf):
    df = A.correlation(X.bars(spark, sf), ("ticker",), "close", "volume", "correlation")
    return df.select("ticker", *rounded(8, "correlation"), Q.correlation_strength(F.col("correlation")).alias("correlation_strength"))


@query("a9_pivot_series", f"WITH {S.MACRO}, {WIDE} SELECT * FROM wide")
def a9(spark, sf):
    return A.pivot_series(X.macro(spark, sf), X.MACRO_IDS)


@query("a10_difference_stats", f"""WITH {S.BARS_B}, j AS (SELECT ticker, a.close - b.close AS diff, 100 * (a.close - b.close) / a.close AS pct
 FROM bars a JOIN bars_b b USING (ticker, date)) SELECT ticker, round(avg(diff), 4) AS mean_diff, round(max(diff), 4) AS max_diff,
 round(min(diff), 4) AS min_diff, round(stddev_samp(diff), 4) AS std_diff, round(avg(pct), 6) AS mean_diff_pct FROM j GROUP BY ticker""")
def a10(spark, sf):
    return Q.reconciliation(X.bars(spark, sf), X.bars_b(spark, sf)).select(
        "ticker", *rounded(4, "mean_diff", "max_diff", "min_diff", "std_diff"), *rounded(6, "mean_diff_pct"))


_NORM = "n AS (SELECT ticker, avg(close) AS m, coalesce(nullif(stddev_pop(close), 0), 1) AS s FROM bars GROUP BY ticker)"


@query("a11_normalise", f"WITH {S.BARS}, {_NORM} SELECT ticker, date, round((close - m) / s, 6) AS close FROM bars JOIN n USING (ticker)")
def a11(spark, sf):
    df = X.bars(spark, sf).select(*BASE, "close")
    return A.normalise(df, A.normalisation(df, ["close"]), ["close"]).select(*BASE, *rounded(6, "close"))


@query("a11_denormalise", f"WITH {S.BARS} SELECT ticker, date, round(close, 4) AS close FROM bars")
def a11_inverse(spark, sf):
    df = X.bars(spark, sf).select(*BASE, "close")
    fitted = A.normalisation(df, ["close"])
    return A.denormalise(A.normalise(df, fitted, ["close"]), fitted, ["close"]).select(*BASE, *rounded(4, "close"))


@query("a12_zscore_outliers", f"""WITH {S.BARS}, n AS (SELECT ticker, avg(volume) AS m, stddev_samp(volume) AS s FROM bars GROUP BY ticker)
 SELECT ticker, date, round(abs((volume - m) / nullif(s, 0)), 6) AS zscore, coalesce(CAST(abs((volume - m) / nullif(s, 0)) > 2 AS INTEGER), 0) AS is_outlier
 FROM bars JOIN n USING (ticker)""")
def a12(spark, sf):
    return A.zscore_outliers(X.bars(spark, sf), "volume", 2.0).select(*BASE, *rounded(6, "zscore"), "is_outlier")


@query("a13_iqr_outliers", f"""WITH {S.BARS}, q AS (SELECT ticker, quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.75) AS q3 FROM bars GROUP BY ticker)
 SELECT ticker, date, close, coalesce(CAST(close < q1 - 0.5 * (q3 - q1) OR close > q3 + 0.5 * (q3 - q1) AS INTEGER), 0) AS is_outlier
 FROM bars JOIN q USING (ticker)""")
def a13(spark, sf):
    return A.iqr_outliers(X.bars(spark, sf), "close", 0.5).select(*BASE, "close", "is_outlier")


@query("a13_quantiles", """SELECT event_type AS ticker, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50,
 round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""")
def a13_quantiles(spark, sf):
    df = A.exact_quantiles(X.ticks(spark, sf), "price", {"p05": 0.05, "p50": 0.5, "p95": 0.95})
    return df.select("ticker", *rounded(6, "p05", "p50", "p95"))


@query("a14_first_last_price", f"""WITH {S.BARS} SELECT ticker, min(date) AS start_date, max(date) AS end_date, arg_min(close, date) AS start_price,
 arg_max(close, date) AS end_price FROM bars GROUP BY ticker""")
def a14(spark, sf):
    return A.first_last(X.bars(spark, sf))
