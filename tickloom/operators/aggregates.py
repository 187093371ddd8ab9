"""Grouped aggregates. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickloom.operators import panel as P


def daily_mean_sentiment(records: DataFrame) -> DataFrame:
    return records.groupBy("ticker", "date").agg(
        F.avg("polarity").alias("avg_polarity"), F.avg("subjectivity").alias("avg_subjectivity"))


def daily_sentiment_profile(records: DataFrame, time: str = "date") -> DataFrame:
    return records.groupBy("ticker", F.to_date(time).alias("date")).agg(
        F.avg("polarity").alias("polarity_mean"), F.stddev_samp("polarity").alias("polarity_std"),
        F.count("polarity").alias("polarity_count"), F.avg("subjectivity").alias("subjectivity_mean"),
        F.stddev_samp("subjectivity").alias("subjectivity_std"))


PERIOD_END = {
    "D": lambda d: F.to_date(d),
    "W": lambda d: F.date_sub(F.next_day(d, "MON"), 1),
    "M": lambda d: F.last_day(d),
}
_PERIOD_DAYS = {"D": 1, "W": 7}

OHLCV = {
    "open": lambda t: F.min_by("open", t), "high": lambda t: F.max("high"), "low": lambda t: F.min("low"),
    "close": lambda t: F.max_by("close", t), "volume": lambda t: F.sum("volume"),
}


#: Labels that one row of a spine is exploded from; a key of any span is that many rows at a time.
SPINE_CHUNK = 10_000


def _spine(ends: DataFrame, keys: Sequence[str], n: Column, label: Callable[[Column], Column], name: str, chunk: int) -> DataFrame:
    """``n`` labels per row of ``ends``, made chunk by chunk, the chunks of a key spread over tasks."""
    chunks = ends.withColumn("__n", n.cast("long"))
    chunks = chunks.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / chunk))))
    first = F.col("__chunk") * chunk
    inside = F.sequence(first, F.least(F.col("__n"), first + chunk) - 1)
    return chunks.repartition(*keys, "__chunk").withColumn("__i", F.explode(inside)).select(*keys, label(F.col("__i")).alias(name))


def period_spine(df: DataFrame, freq: str, keys: Sequence[str], time: str, chunk: int = SPINE_CHUNK) -> DataFrame:
    """Every period label from each key's first to its last row."""
    ends = df.groupBy(*keys).agg(F.min(time).alias("a"), F.max(time).alias("b"))
    if freq == "M":
        months = F.months_between(F.trunc("b", "MM"), F.trunc("a", "MM")) + 1
        return _spine(ends, keys, months, lambda i: F.last_day(F.add_months(F.trunc("a", "MM"), i.cast("int"))), "period_end", chunk)
    label, days = PERIOD_END[freq], _PERIOD_DAYS[freq]
    n = F.datediff(label("b"), label("a")) / days + 1
    return _spine(ends, keys, n, lambda i: F.date_add(label("a"), (i * days).cast("int")), "period_end", chunk)


def resample(df: DataFrame, freq: str = "W", aggs: dict[str, Column] | None = None, fill_empty: bool = True,
             keys: Sequence[str] = ("ticker",), time: str = "date") -> DataFrame:
    """Bars per day, week (labelled by its Sunday) or month (by its last day).

    Empty periods are emitted with NULL prices and volume 0.
    """
    chosen = aggs or {name: make(time) for name, make in OHLCV.items()}
    binned = df.groupBy(*keys, PERIOD_END[freq](time).alias("period_end")).agg(
        *[agg.alias(name) for name, agg in chosen.items()])
    if not fill_empty:
        return binned
    full = period_spine(df, freq, keys, time).join(binned, [*keys, "period_end"], "left")
    return full.na.fill(0, ["volume"]) if "volume" in chosen else full


def time_buckets(df: DataFrame, time: str, value: str, width: str = "1 day",
                 keys: Sequence[str] = ("ticker",), chunk: int = SPINE_CHUNK) -> DataFrame:
    """Mean per fixed time bucket, buckets without rows included with NULL."""
    binned = (df.groupBy(*keys, F.window(time, width)["start"].alias("bucket"))
              .agg(F.avg(value).alias("mean_value"), F.count(value).alias("n")))
    ends = binned.groupBy(*keys).agg(F.min("bucket").alias("a"), F.max("bucket").alias("b"))
    step = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {width}"))
    n = F.expr("timestampdiff(MICROSECOND, a, b)") / step + 1

    def label(i: Column) -> Column:
        return F.col("a") + F.make_dt_interval(secs=(i * step / 1_000_000).cast("decimal(18,6)"))
    spine = _spine(ends, keys, n, label, "bucket", chunk)
    return spine.join(binned, [*keys, "bucket"], "left").na.fill(0, ["n"])


def monthly_range(bars: DataFrame) -> DataFrame:
    low, high = F.min("close"), F.max("close")
    return bars.groupBy("ticker", F.trunc("date", "MM").alias("month")).agg(
        F.try_divide(high - low, low).alias("monthly_range_return"))


def monthly_mean(series: DataFrame, value: str = "value") -> DataFrame:
    return series.groupBy("series_id", F.trunc("date", "MM").alias("month")).agg(
        F.avg(value).alias("indicator_value"))


def volatility(df: DataFrame, keys: Sequence[str], x: str, out: str = "volatility") -> DataFrame:
    return df.groupBy(*keys).agg(F.stddev_samp(x).alias(out))


def correlation_moments(x: str, y: str) -> list[Column]:
    """Aggregates that :func:`correlation_of` turns into a correlation."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return [F.covar_pop(a, b).alias("__c"), F.stddev_pop(a).alias("__sa"), F.stddev_pop(b).alias("__sb"),
            F.min(a).alias("__a0"), F.max(a).alias("__a1"), F.min(b).alias("__b0"), F.max(b).alias("__b1")]


def correlation_of() -> Column:
    """NULL where either side does not vary, so no division by zero is reached."""
    varies = (F.col("__a0") < F.col("__a1")) & (F.col("__b0") < F.col("__b1"))
    return F.when(varies, F.try_divide(F.col("__c"), F.col("__sa") * F.col("__sb")))


def correlation(df: DataFrame, keys: Sequence[str], x: str, y: str, out: str) -> DataFrame:
    """Pearson correlation per group in one pass with map-side merging."""
    return df.groupBy(*keys).agg(*correlation_moments(x, y)).select(*keys, correlation_of().alias(out))


def pivot_series(series: DataFrame, ids: Sequence[str], prefix: str = "macro_") -> DataFrame:
    """Long to wide; the ids are given, so no job runs to discover them."""
    wide = series.groupBy("date").pivot("series_id", list(ids)).agg(F.max("value"))
    return wide.select("date", *[F.col(f"`{i}`").alias(f"{prefix}{i}") for i in ids])


def normalisation(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """Mean and population deviation per key and column, a zero deviation replaced by 1."""
    aggs = []
    for c in columns:
        std = F.stddev_pop(c)
        aggs += [F.avg(c).alias(f"{c}_mean"), F.when(std == 0, F.lit(1.0)).otherwise(std).alias(f"{c}_std")]
    return df.groupBy(*keys).agg(*aggs)


def normalise(df: DataFrame, parameters: DataFrame, columns: Sequence[str],
              keys: Sequence[str] = ("ticker",)) -> DataFrame:
    joined = P.attach_table(df, parameters, keys)
    scaled = {c: F.try_divide(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std")) for c in columns}
    return joined.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])


def denormalise(df: DataFrame, parameters: DataFrame, columns: Sequence[str],
                keys: Sequence[str] = ("ticker",)) -> DataFrame:
    joined = P.attach_table(df, parameters, keys)
    back = {c: F.col(c) * F.col(f"{c}_std") + F.col(f"{c}_mean") for c in columns}
    return joined.select(*[back[c].alias(c) if c in back else F.col(c) for c in df.columns])


def zscore_outliers(df: DataFrame, x: str, threshold: float = 3.0, panel: P.Panel = P.BARS) -> DataFrame:
    moments = [F.avg(x).alias("__m"), F.stddev_samp(x).alias("__s")]
    z = F.abs(F.try_divide(F.col(x) - F.col("__m"), F.col("__s")))
    return (P.attach_per_key(df, panel, moments).withColumn("zscore", z)
            .withColumn("is_outlier", F.coalesce((z > threshold).cast("int"), F.lit(0))).drop("__m", "__s"))


def exact_quantiles(df: DataFrame, x: str, probs: dict[str, float], keys: Sequence[str] = ("ticker",),
                    margin: float = 2e-4) -> DataFrame:
    """Linearly interpolated quantiles without bringing a whole group to one task.

    Three passes with small shuffles: approximate quantiles per key just below and above each
    wanted one, the counts between them, and the distinct values of the bins that hold the
    wanted ranks. Such a bin holds about ``2 · margin`` of a key's rows whatever the values are,
    and the counts are exact, so the approximation never shows.
    """
    keys = list(keys)
    values = df.where(F.col(x).isNotNull()).select(*keys, F.col(x).cast("double").alias("__v"))
    sides = sorted({side for p in probs.values() for side in (max(p - margin, 0.0), min(p + margin, 1.0))})
    edges = F.percentile_approx("__v", sides, int(2 / margin))
    ranges = values.groupBy(*keys).agg(edges.alias("__edges"), F.count(F.lit(1)).alias("__total"))
    binned = P.attach_table(values, ranges, keys).select(
        *keys, "__v", "__total", F.size(F.filter("__edges", lambda e: e <= F.col("__v"))).alias("__bin"))
    earlier = W.partitionBy(*keys).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    histogram = (binned.groupBy(*keys, "__bin").agg(F.count(F.lit(1)).alias("__c"), F.max("__total").alias("__total"))
                 .withColumn("__start", F.coalesce(F.sum("__c").over(earlier), F.lit(0))))

    def rank(p: float) -> Column:
        return (F.col("__total") - 1) * F.lit(float(p))

    def covers(start: Column, n: Column, r: Column) -> Column:
        return (start <= r) & (r < start + n)

    wanted = F.lit(False)
    for p in probs.values():
        for edge in (F.floor(rank(p)), F.ceil(rank(p))):
            wanted = wanted | covers(F.col("__start"), F.col("__c"), edge)
    hit = histogram.where(wanted).select(*keys, "__bin", "__start")
    counted = binned.join(hit, [*keys, "__bin"]).groupBy(*keys, "__bin", "__start", "__total", "__v").agg(
        F.count(F.lit(1)).alias("__n"))
    inside = W.partitionBy(*keys, "__bin").orderBy("__v").rowsBetween(W.unboundedPreceding, -1)
    ranked = counted.withColumn("__first", F.col("__start") + F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    picks = []
    for name, p in probs.items():
        for side, edge in (("a", F.floor(rank(p))), ("b", F.ceil(rank(p)))):
            picks.append(F.max(F.when(covers(F.col("__first"), F.col("__n"), edge), F.col("__v")))
                         .alias(f"__{side}_{name}"))
    found = ranked.groupBy(*keys).agg(F.max("__total").alias("__total"), *picks)
    out = [(F.col(f"__a_{name}") + (F.col(f"__b_{name}") - F.col(f"__a_{name}")) * (rank(p) - F.floor(rank(p))))
           .alias(name) for name, p in probs.items()]
    return found.select(*keys, *out)


def iqr_outliers(df: DataFrame, x: str, threshold: float = 3.0, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    q = exact_quantiles(df, x, {"__q1": 0.25, "__q3": 0.75}, keys)
    spread = threshold * (F.col("__q3") - F.col("__q1"))
    outside = (F.col(x) < F.col("__q1") - spread) | (F.col(x) > F.col("__q3") + spread)
    return (P.attach_table(df, q, keys).withColumn("is_outlier", F.coalesce(outside.cast("int"), F.lit(0)))
            .drop("__q1", "__q3"))


def detect_outliers(df: DataFrame, x: str, method: str = "zscore", threshold: float = 3.0,
                    panel: P.Panel = P.BARS) -> DataFrame:
    """``is_outlier`` by z-score or by quartile distance."""
    if method == "zscore":
        return zscore_outliers(df, x, threshold, panel)
    if method == "iqr":
        return iqr_outliers(df, x, threshold, panel.keys)
    raise ValueError(f"unknown method {method!r}; use 'zscore' or 'iqr'")


def first_last(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.min_by("close", "date").alias("start_price"), F.max_by("close", "date").alias("end_price"))
