"""Event-time aggregates: bars from ticks and daily sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# How late a row may be.
TICK_DELAY, SENTIMENT_DELAY = "10 minutes", "1 day"


def tick_bars(ticks: DataFrame, width: str = "1 hour", delay: str = TICK_DELAY, time: str = "ts",
              price: str = "price", size: str = "size", seq: str = "event_id") -> DataFrame:
    """OHLCV per ticker and tumbling window; the same plan for a stream and for a table.

    Every aggregate combines partially before the shuffle, so a hot ticker sends one row per
    task and window. ``seq`` is a number that grows with time within a ticker; open and close
    follow it, since a single fixed-width order keeps the aggregate on hashing.
    """
    source = ticks.withColumn(time, F.col(time).cast("timestamp"))
    if source.isStreaming:
        source = source.withWatermark(time, delay)
    bars = source.groupBy("ticker", F.window(time, width)).agg(
        F.min_by(price, seq).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, seq).alias("close"), F.sum(size).alias("volume"), F.count(F.lit(1)).alias("n_ticks"))
    return bars.select("ticker", F.col("window.start").alias("bar_start"), F.col("window.end").alias("bar_end"),
                       "open", "high", "low", "close", "volume", "n_ticks")


def daily_sentiment(records: DataFrame, delay: str = SENTIMENT_DELAY, time: str = "ts") -> DataFrame:
    source = records.withWatermark(time, delay) if records.isStreaming else records
    daily = source.groupBy("ticker", F.window(time, "1 day")).agg(
        F.avg("polarity").alias("polarity_mean"), F.avg("subjectivity").alias("subjectivity_mean"),
        F.count("polarity").alias("polarity_count"))
    return daily.select("ticker", F.to_date(F.col("window.start")).alias("date"), "polarity_mean",
                        "subjectivity_mean", "polarity_count")


def bars_with_sentiment(bars: DataFrame, daily: DataFrame) -> DataFrame:
    """Every bar with the drained daily scores of its ticker and day, 0 where there are none.

    A bounded run writes only the windows that the watermark has closed, so its last days count as missing.
    """
    scores = ("polarity_mean", "subjectivity_mean", "polarity_count")
    return bars.select("ticker", "date", "close").join(daily.select("ticker", "date", *scores), ["ticker", "date"], "left").fillna(0, list(scores))


def bars_left_sentiment(bars: DataFrame, records: DataFrame, bar_delay: str = SENTIMENT_DELAY, delay: str = SENTIMENT_DELAY) -> DataFrame:
    """A stream of bars left-joined with the daily scores of a stream of sentiment records (ticker, ts, scores).

    Both sides wait in join state, keyed by ticker and day. A bar leaves with its scores once the day of its records is closed by
    the watermark, or with 0 once the watermark has passed it and nothing came; records that come later than ``delay`` after the
    newest of both streams are dropped, so state holds no more than the days that are still open.
    """
    timed = bars.withColumn("__at", F.col("date").cast("timestamp")).withWatermark("__at", bar_delay)
    left = timed.select("ticker", "date", "close", F.window("__at", "1 day").alias("window"))
    daily = records.withWatermark("ts", delay).groupBy("ticker", F.window("ts", "1 day").alias("window")).agg(
        F.avg("polarity").alias("polarity_mean"), F.avg("subjectivity").alias("subjectivity_mean"), F.count("polarity").alias("polarity_count"))
    scores = ("polarity_mean", "subjectivity_mean", "polarity_count")
    return left.join(daily, ["ticker", "window"], "left_outer").select(
        "ticker", "date", "close", *(F.coalesce(c, F.lit(0)).alias(c) for c in scores))


_BAR_PARTS = ("open", "high", "low", "close", "volume", "n_ticks")


def bars_and_late_ticks(ticks: DataFrame, path: str, checkpoint: str, trigger: dict, width: str = "1 hour", delay: str = TICK_DELAY,
                        time: str = "ts", seq: str = "event_id") -> StreamingQuery:
    """Bars of the ticks in time and, in a table of their own, the ticks that came too late for theirs.

    A tick is late if its window ended ``delay`` or more before the newest time of the batches before its own. Every batch writes
    three folders: ``late``, whole rows; ``bars``, what its other ticks add to each bar; ``newest``, the newest time so far.
    A batch that runs again reads the same earlier time and replaces its own folders, so every tick is in exactly one table, once.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        spark, kept = batch.sparkSession, batch.persist()
        try:
            before = spark.read.parquet(f"{path}/newest/batch_id={batch_id - 1}").first()["newest"] if batch_id else None
            limit = None if before is None else F.lit(before) - F.expr(f"INTERVAL {delay}")
            at = F.col(time).cast("timestamp")
            late = F.lit(False) if limit is None else F.coalesce(F.window(at, width)["end"] <= limit, F.lit(False))
            kept.where(late).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
            rows = kept.where(~late & at.isNotNull()).withColumn("__window", F.window(at, width))
            bars = rows.groupBy("ticker", F.col("__window.start").alias("bar_start")).agg(
                F.min_by("price", seq).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", seq).alias("close"),
                F.sum("size").alias("volume"), F.count(F.lit(1)).alias("n_ticks"), F.min(seq).alias("first"), F.max(seq).alias("last"))
            bars.write.mode("overwrite").parquet(f"{path}/bars/batch_id={batch_id}")
            kept.agg(F.greatest(F.max(at), F.lit(before).cast("timestamp")).alias("newest")).coalesce(1).write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")
        finally:
            kept.unpersist()
    return (ticks.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(save).start())


def merged_bars(parts: DataFrame) -> DataFrame:
    """One row per ticker and window from what the batches added to it."""
    whole = parts.groupBy("ticker", "bar_start").agg(
        F.min_by("open", "first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "last").alias("close"),
        F.sum("volume").alias("volume"), F.sum("n_ticks").alias("n_ticks"))
    return whole.select("ticker", "bar_start", *_BAR_PARTS)


def with_bars(daily: DataFrame, bars: DataFrame) -> DataFrame:
    """A stream of daily scores joined to the stored bars of the same ticker and day."""
    return daily.join(bars.select("ticker", "date", "close"), ["ticker", "date"])
