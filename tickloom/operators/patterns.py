"""Pattern queries over bars, sentiment and macro panels.

``as_of`` anchors the lookback; it defaults to the current date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import panel as P
from tickloom.operators.aggregates import (
    correlation, correlation_moments, correlation_of, daily_mean_sentiment, first_last, monthly_range, volatility,
)
from tickloom.operators.frames import latest_record
from tickloom.operators.joins import matched_difference


def since(as_of, period: int) -> Column:
    anchor = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return F.date_sub(anchor, period)


def with_return(df: DataFrame, panel: P.Panel, out: str = "daily_return") -> DataFrame:
    level = lambda w: [F.lag("close", 1).over(w).alias("__prev")]
    step = P.windowed(df, panel, [level], before=1)
    return step.withColumn(out, P.pct_change(F.col("close"), F.col("__prev"))).drop("__prev")


def with_predecessor(bars: DataFrame, cut: Column, panel: P.Panel) -> DataFrame:
    """The rows from ``cut`` on and each key's last row before it.

    The older rows are reduced to one per key on the map side, so only the lookback is
    shuffled, however long the history is.
    """
    bars = P.ensure_numbered(bars, panel).select(*panel.keys, *panel.order, panel.pos, "close")
    last = latest_record(bars.where(F.col("date") < cut), panel.keys, panel.pos)
    return bars.where(F.col("date") >= cut).unionByName(last)


def high_volatility(bars: DataFrame, period: int = 30, threshold: float = 0.02, as_of=None,
                    panel: P.Panel = P.BARS) -> DataFrame:
    """The lookback applies after the lag, so its first day keeps the predecessor outside it."""
    cut = since(as_of, period)
    recent = with_return(with_predecessor(bars, cut, panel), panel).where(F.col("date") >= cut)
    return (volatility(recent, panel.keys, "daily_return").where(F.col("volatility") > threshold)
            .orderBy(F.col("volatility").desc()))


def price_trends(bars: DataFrame, period: int = 30, threshold: float = 0.1, as_of=None) -> DataFrame:
    trends = first_last(bars.where(F.col("date") >= since(as_of, period))).withColumn(
        "price_change", F.try_divide(F.col("end_price") - F.col("start_price"), F.col("start_price")))
    change = F.col("price_change")
    # The labels.
    direction = (F.when(change > threshold, "Uptrend").when(change < -threshold, "Downtrend")
                 .otherwise("Sideways"))
    return (trends.withColumn("trend_direction", direction).where(F.abs(change) > threshold)
            .orderBy(F.abs(change).desc()))


def correlation_strength(r: Column) -> Column:
    """The first bucket that matches wins; a boundary belongs to the bucket listed first."""
    # The labels and their bounds.
    return (F.when(r > 0.7, "Strong Positive").when(r.between(0.3, 0.7), "Positive")
            .when(r.between(-0.3, 0.3), "Weak").when(r.between(-0.7, -0.3), "Negative")
            .when(r < -0.7, "Strong Negative"))


def _ranked_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return (correlation(df, ("ticker",), x, y, "correlation")
            .withColumn("correlation_strength", correlation_strength(F.col("correlation")))
            .orderBy(F.abs("correlation").desc()))


def sentiment_correlation(bars: DataFrame, sentiment: DataFrame, period: int = 30, as_of=None,
                          panel: P.Panel = P.BARS) -> DataFrame:
    """The lookback applies before the lag, so the first return in it is NULL."""
    cut = since(as_of, period)
    recent = with_return(bars.where(F.col("date") >= cut), panel, "price_change")
    scores = daily_mean_sentiment(sentiment.where(F.col("date") >= cut))
    return _ranked_correlation(recent.join(scores, ["ticker", "date"]), "price_change", "avg_polarity")


def macro_correlation(bars: DataFrame, macro: DataFrame, indicator: str = "value", period: int = 365,
                      as_of=None) -> DataFrame:
    cut = since(as_of, period)
    monthly = monthly_range(bars.where(F.col("date") >= cut))
    values = (macro.where(F.col("date") >= cut).groupBy(F.trunc("date", "MM").alias("month"))
              .agg(F.avg(indicator).alias("indicator_value")))
    return _ranked_correlation(monthly.join(values, "month"), "monthly_range_return", "indicator_value")


def positive_sentiment_momentum(sentiment: DataFrame, period: int = 30, window: int = 7, as_of=None,
                                panel: P.Panel = P.BARS) -> DataFrame:
    daily = daily_mean_sentiment(sentiment.where(F.col("date") >= since(as_of, period)))
    smooth = P.windowed(daily.select("ticker", "date", "avg_polarity"), panel, [
        lambda w: [P.rolling(F.avg("avg_polarity"), "avg_polarity", window, w, 1).alias("sentiment_ma")],
        lambda w: [(F.col("sentiment_ma") - F.lag("sentiment_ma", window).over(w)).alias("momentum")],
    ], before=2 * window)
    return (smooth.where(F.col("momentum") > 0).groupBy("ticker")
            .agg(F.max("date").alias("latest_date"), F.avg("sentiment_ma").alias("avg_sentiment"),
                 F.avg("momentum").alias("avg_momentum"))
            .orderBy(F.col("avg_momentum").desc()))


def price_breakouts(bars: DataFrame, period: int = 90, threshold: float = 0.05, as_of=None,
                    panel: P.Panel = P.BARS) -> DataFrame:
    recent = bars.where(F.col("date") >= since(as_of, period))
    marked = P.sliding(recent, panel, {"prev_max": P.Slide("max", "close", period, gap=1), "prev_min": P.Slide("min", "close", period, gap=1)})
    kind = (F.when(F.col("close") > F.col("prev_max") * (1 + threshold), "Upside Breakout")
            .when(F.col("close") < F.col("prev_min") * (1 - threshold), "Downside Breakout"))
    return (marked.withColumn("breakout_type", kind).where(F.col("breakout_type").isNotNull())
            .select("ticker", "date", "close", "prev_max", "prev_min", "breakout_type")
            .orderBy(F.col("date").desc()))


def reconciliation(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per ticker statistics of the difference of two vendors' closes on common days."""
    stats = matched_difference(a, b).groupBy("ticker").agg(
        F.avg("diff").alias("mean_diff"), F.avg("diff_pct").alias("mean_diff_pct"),
        F.max("diff").alias("max_diff"), F.min("diff").alias("min_diff"),
        F.stddev_samp("diff").alias("std_diff"), F.count(F.lit(1)).alias("n_days"),
        *correlation_moments("close_a", "close_b"))
    return P.drop_work_columns(stats.withColumn("correlation", correlation_of()))
