"""Panels, ticks, sentiment and macro series derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import panel as P
from tickloom.sources.catalogue import small_table
from tickloom.session import publish, publish_once

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_bars(raw: DataFrame, ticker: str, time: str, price: str, seq: str) -> DataFrame:
    """OHLCV per (ticker, day); open and close belong to the lowest and highest ``seq``.

    All five are partial aggregates, so a hot ticker is reduced before the shuffle.
    """
    return raw.groupBy(F.col(ticker).alias("ticker"), F.to_date(time).alias("date")).agg(
        F.min_by(price, seq).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, seq).alias("close"), F.count(F.lit(1)).alias("volume"))


def numbered(spark: SparkSession, sf_dir: str, name: str, raw) -> DataFrame:
    """The stored panel table: written once, with each row's position in its ticker."""
    return publish_once(spark, sf_dir, name,
                        lambda: P.number_rows(publish(raw(), f"{name}-raw"), P.BARS))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(spark, sf_dir, "bars", lambda: daily_bars(
        table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey"))


def bars_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(spark, sf_dir, "bars_ev", lambda: daily_bars(
        table(spark, sf_dir, "events"), "event_type", "ts", "value", "event_id"))


def bars_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide panel: one ticker per supplier."""
    def raw() -> DataFrame:
        return table(spark, sf_dir, "lineitem").groupBy(
            F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date")).agg(
            F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)), 4).alias("close"),
            F.max("l_extendedprice").alias("high"), F.min("l_extendedprice").alias("low"),
            F.sum("l_quantity").cast("long").alias("volume"))
    return numbered(spark, sf_dir, "bars_li", raw)


def ticks_of(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_type").alias("ticker"), "ts", "event_id", F.col("value").alias("price"),
                         F.get_json_object("props", "$.k").cast("long").alias("size"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


TICKS = P.Panel(order=("ts", "event_id"))


def ticks_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ticks with their positions: a panel that grows with the data in every ticker."""
    def build() -> DataFrame:
        raw = publish(ticks(spark, sf_dir), "ticks-raw")
        return P.number_rows(raw, TICKS, P.time_bucket(raw, "ts", P.bucket_seconds(raw, TICKS)))

    return publish_once(spark, sf_dir, "ticks", build)


def bars_gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars without closes and volumes at weekends."""
    known = F.weekday("date") < 5
    return bars(spark, sf_dir).withColumns(
        {"close": F.when(known, F.col("close")), "volume": F.when(known, F.col("volume"))})


def bars_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second vendor's view of the bars: weekdays only, slightly different closes."""
    return (bars(spark, sf_dir).where(F.weekday("date") < 5)
            .select("ticker", "date",
                    (F.col("close") * (1 + (F.dayofmonth("date") - 15) / F.lit(1000.0))).alias("close")))


def sentiment_records(documents: DataFrame) -> DataFrame:
    """One record per document with fixed scores, spread over tickers and days of 2024-01."""
    names = F.array(*[F.lit(t) for t in EVENT_TYPES])
    d = F.col("doc_id")
    return documents.select(
        "doc_id", F.element_at(names, (d % 5 + 1).cast("int")).alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.floor(d / 5) % 30).cast("int")).alias("date"),
        (((d * 37) % 201 - 100) / 100).alias("polarity"), (((d * 53) % 101) / 100).alias("subjectivity"),
        "source", "text")


def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_records(table(spark, sf_dir, "documents")).drop("text")


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three monthly series; the sum runs on decimals so that it does not depend on row order."""
    return publish_once(spark, sf_dir, "macro", lambda: table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_returnflag").alias("series_id"),
                     F.trunc(F.to_date("l_shipdate"), "MM").alias("date"))
            .agg(F.sum(F.col("l_discount").cast("decimal(18,2)")).alias("s"), F.count(F.lit(1)).alias("n"))
            .select("series_id", "date", F.round(100 * F.col("s").cast("double") / F.col("n"), 6).alias("value")))


MACRO_IDS = ("A", "N", "R")


SERIES = P.Panel(keys=("model", "ticker"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two naive models' next closes: the previous close (a) and the mean of the last five (b)."""
    def level(w):
        five = w.rowsBetween(-5, -1)
        return [F.lag("close", 1).over(w).alias("__a"),
                F.when(F.count("close").over(five) == 5, F.avg("close").over(five)).alias("__b")]

    def build() -> DataFrame:
        wide = P.windowed(bars(spark, sf_dir), P.BARS, [level], before=5)
        model = F.expr("stack(2, 'a', __a, 'b', __b) AS (model, predicted)")
        known = wide.select("ticker", "date", F.col("close").alias("actual"), model).where("predicted IS NOT NULL")
        return P.number_rows(known, SERIES)

    return publish_once(spark, sf_dir, "predictions", build)


def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed binary classification: label = quality, prediction = not toxic, score from the id."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"),
        (((F.col("doc_id") * 29) % 97) / 97).alias("score"))


# A small test lexicon (word, polarity, subjectivity).
LEXICON = [
    ("the", 0.1, 0.2), ("and", 0.05, 0.1), ("of", -0.05, 0.1), ("to", 0.2, 0.3), ("in", -0.1, 0.2),
    ("la", 0.3, 0.5), ("le", -0.2, 0.4), ("les", 0.15, 0.35), ("de", -0.3, 0.6), ("que", 0.4, 0.7),
    ("der", 0.25, 0.45), ("die", -0.6, 0.8), ("und", 0.05, 0.15), ("nicht", -0.5, 0.75),
    ("el", 0.35, 0.3), ("los", -0.15, 0.25), ("un", 0.1, 0.1), ("en", -0.25, 0.5), ("thanks", 0.8, 0.9),
    ("error", -0.7, 0.6),
]


def lexicon(spark: SparkSession) -> DataFrame:
    return small_table(spark, LEXICON, "word string, polarity double, subjectivity double")
