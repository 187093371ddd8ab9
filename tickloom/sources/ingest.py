"""Readers for files, table layouts and landed vendor payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.text import html_paragraphs
from tickloom.operators.frames import date_range, to_number
from tickloom.sources import schemas

TICKER_BUCKETS = 64


def load(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", schema: T.StructType | None = None,
         header: bool = True, infer_schema: bool = False) -> DataFrame:
    """Read CSV, Parquet or JSON. A declared schema always wins over inference."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header)
        if schema is None:
            reader = reader.option("inferSchema", infer_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def ticker_bucket(ticker: Column, buckets: int = TICKER_BUCKETS) -> Column:
    """The partition folder of a ticker: a bounded number of folders for any number of tickers."""
    return F.pmod(F.xxhash64(ticker), F.lit(buckets)).cast("int")


def stored_buckets(bars: DataFrame) -> int | None:
    """The number of ticker folders, as ``save_bars`` notes it with the ticker column."""
    return bars.schema["ticker"].metadata.get("buckets") if "bucket" in bars.columns else None


def load_bars(spark: SparkSession, path: str, ticker: str | None = None, start=None, end=None) -> DataFrame:
    """One ticker's (or all) bars from the stored table.

    Only the ticker's folder is read where the table tells how many it has, else all of them.
    """
    df = spark.read.parquet(path)
    if ticker is not None:
        if buckets := stored_buckets(df):
            df = df.where(F.col("bucket") == ticker_bucket(F.lit(ticker), buckets))
        df = df.where(F.col("ticker") == ticker)
    return date_range(df, start, end).drop("bucket")


def load_macro(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Macro CSV files: text that is not a number becomes NULL and times of day are dropped."""
    return date_range(schemas.conform(load(spark, path, "csv"), schemas.MACRO), start, end)


def load_sentiment(spark: SparkSession, path: str, ticker: str | None = None, fmt: str = "csv", start=None, end=None) -> DataFrame:
    """Sentiment files with ``published_at`` or ``date``; files of one ticker may lack the column."""
    raw = load(spark, path, fmt)
    if "published_at" in raw.columns and "date" not in raw.columns:
        raw = raw.withColumnRenamed("published_at", "date")
    if ticker is not None and "ticker" not in raw.columns:
        raw = raw.withColumn("ticker", F.lit(ticker))
    out = schemas.conform(raw, schemas.SENTIMENT)
    if ticker is not None:
        out = out.where(F.col("ticker") == ticker)
    return date_range(out.withColumn("day", F.to_date("date")), start, end, "day")


def read_snapshots(spark: SparkSession, pattern: str | Sequence[str], fmt: str = "parquet",
                   schema: T.StructType | None = None) -> DataFrame:
    """All snapshot files as one table; columns that a file lacks are NULL."""
    if fmt in ("parquet", "orc"):
        return spark.read.option("mergeSchema", True).format(fmt).load(pattern)
    return load(spark, pattern, fmt, schema)


# Field names in the vendor's daily payload.
VENDOR_SERIES = "Time Series (Daily)"
VENDOR_FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close",
                 "adj_close": "5. adjusted close", "volume": "6. volume"}


def flatten_vendor_bars(payloads: DataFrame, payload: str = "payload", start=None, end=None) -> DataFrame:
    """(ticker, JSON payload) to typed bars."""
    parsed = F.from_json(payload, "map<string,map<string,map<string,string>>>")
    days = payloads.select("ticker", F.explode(parsed[VENDOR_SERIES]).alias("day", "fields"))
    fields = F.col("fields")
    typed = days.select(
        "ticker", F.col("day").try_cast("date").alias("date"),
        *[to_number(F.try_element_at(fields, F.lit(key)), "double").alias(name)
          for name, key in VENDOR_FIELDS.items() if name != "volume"],
        to_number(F.try_element_at(fields, F.lit(VENDOR_FIELDS["volume"])), "bigint").alias("volume"))
    return date_range(typed, start, end)


def flatten_observations(payloads: DataFrame, catalogue: DataFrame | None = None, payload: str = "payload") -> DataFrame:
    """(series_id, JSON with ``observations``) to the macro table; ``.`` is NULL."""
    parsed = F.from_json(payload, "struct<observations:array<struct<date:string,value:string>>>")
    rows = payloads.select("series_id", F.inline(parsed["observations"]).alias("day", "text"))
    typed = rows.select("series_id", F.col("day").try_cast("date").alias("date"), to_number("text").alias("value"))
    if catalogue is None:
        return typed
    return typed.join(catalogue.select("series_id", "indicator_name"), "series_id", "left")


def flatten_articles(payloads: DataFrame, keys: Sequence[str] = ("ticker",), payload: str = "payload") -> DataFrame:
    """News articles: the nested source name, ISO or epoch-second time, and the joined text."""
    parsed = F.from_json(payload, """array<struct<title:string,description:string,content:string,url:string,
        publishedAt:string,epoch:bigint,source:struct<name:string>>>""")
    rows = payloads.select(*keys, F.inline(parsed))
    return rows.select(
        *keys, "title", F.col("source.name").alias("source"), "url",
        F.coalesce(F.col("publishedAt").try_cast("timestamp"), F.timestamp_seconds("epoch")).alias("published_at"),
        F.concat_ws(" ", "title", "description", "content").alias("text"))


def flatten_posts(payloads: DataFrame, keys: Sequence[str] = ("ticker",), payload: str = "payload") -> DataFrame:
    """Social posts: user, reach counters and text."""
    parsed = F.from_json(payload, """struct<text:string,created_at:string,retweet_count:int,favorite_count:int,
        user:struct<screen_name:string,followers_count:int>>""")
    rows = payloads.select(*keys, parsed.alias("p"))
    return rows.select(*keys, F.col("p.text").alias("text"), F.col("p.created_at").try_cast("timestamp").alias("created_at"),
                       F.col("p.user.screen_name").alias("user"), F.col("p.user.followers_count").alias("followers"),
                       F.col("p.retweet_count").alias("retweet_count"), F.col("p.favorite_count").alias("favorite_count"))


def page_text(pages: DataFrame, limit: int = 10) -> DataFrame:
    return pages.select("page_id", "url", html_paragraphs("html", limit).alias("text"))


def find(docs: DataFrame, predicate: Column | None = None, projection: Sequence[str] | None = None,
         sort: Sequence[tuple[str, int]] = (), limit: int = 0) -> DataFrame:
    """Filter, project, sort and limit documents; ``_id`` is dropped. A sorted limit is a top-k."""
    out = docs if predicate is None else docs.where(predicate)
    if sort:
        out = out.orderBy(*[F.col(c).asc() if direction > 0 else F.col(c).desc() for c, direction in sort])
    if limit:
        out = out.limit(limit)
    return (out if projection is None else out.select(*projection)).drop("_id")


def known_tickers(df: DataFrame) -> DataFrame:
    return df.select("ticker").distinct()
