"""Window operators W1-W12."""

from pyspark.sql import functions as F

from tickloom.operators import panel as P
from tickloom.operators.features import period_returns, sequences
from tickloom.operators.frames import latest_rows
from tickloom.plans import sql as S
from tickloom.plans.registry import query, rounded, sql_rounded
from tickloom.sources import fixtures as X

BASE = ("ticker", "date")


@query("w1_lag", f"WITH {S.BARS} SELECT ticker, date, lag(close, 1) OVER {S.W} AS lag_1, lag(close, 5) OVER {S.W} AS lag_5 FROM bars")
def w1(spark, sf):
    df = P.windowed(X.bars(spark, sf), P.BARS, [lambda w: [F.lag("close", n).over(w).alias(f"lag_{n}") for n in (1, 5)]],
                    before=5)
    return df.select(*BASE, "lag_1", "lag_5")


@query("w2_lead", f"WITH {S.BARS} SELECT ticker, date, lead(close, 1) OVER {S.W} AS lead_1, lead(close, 5) OVER {S.W} AS lead_5 FROM bars")
def w2(spark, sf):
    df = P.windowed(X.bars(spark, sf), P.BARS,
                    [lambda w: [F.lead("close", n).over(w).alias(f"lead_{n}") for n in (1, 5)]], after=5)
    return df.select(*BASE, "lead_1", "lead_5")


@query("w3_returns", f"""WITH {S.BARS} SELECT ticker, date,
 {", ".join(f"round(close / nullif(lag(close, {n}) OVER {S.W}, 0) - 1, 8) AS return_{n}" for n in (1, 5, 20))} FROM bars""")
def w3(spark, sf):
    return period_returns(X.bars(spark, sf)).select(*BASE, *rounded(8, *[f"return_{n}" for n in (1, 5, 20)]))


@query("w4_rolling_mean", f"""WITH {S.BARS}, r AS (SELECT ticker, date, {S.full('avg', 'close', 20)} AS mean_full,
 avg(close) OVER {S.frame(20)} AS mean_partial FROM bars) SELECT ticker, date, {sql_rounded(4, 'mean_full', 'mean_partial')} FROM r""")
def w4(spark, sf):
    df = P.windowed(X.bars(spark, sf), P.BARS, [lambda w: [
        P.rolling(F.avg("close"), "close", 20, w).alias("mean_full"),
        P.rolling(F.avg("close"), "close", 20, w, 1).alias("mean_partial")]], before=19)
    return df.select(*BASE, *rounded(4, "mean_full", "mean_partial"))


@query("w5_rolling_std", f"""WITH {S.BARS}, r AS (SELECT ticker, date, {S.full('stddev_samp', 'close', 20)} AS std_20 FROM bars)
 SELECT ticker, date, {sql_rounded(2, 'std_20')} FROM r""")
def w5(spark, sf):
    df = P.windowed(X.bars(spark, sf), P.BARS,
                    [lambda w: [P.rolling(F.stddev_samp("close"), "close", 20, w).alias("std_20")]], before=19)
    return df.select(*BASE, *rounded(2, "std_20"))


@query("w6_rolling_extremes", f"""WITH {S.BARS} SELECT ticker, date, max(high) OVER {S.frame(14)} AS hh, min(low) OVER {S.frame(14)} AS ll,
 max(close) OVER p AS prev_max, min(close) OVER p AS prev_min FROM bars
 WINDOW p AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING)""")
def w6(spark, sf):
    df = P.windowed(X.bars(spark, sf), P.BARS, [lambda w: [
        P.rolling(F.max("high"), "high", 14, w, 1).alias("hh"), P.rolling(F.min("low"), "low", 14, w, 1).alias("ll"),
        F.max("close").over(w.rowsBetween(-90, -1)).alias("prev_max"),
        F.min("close").over(w.rowsBetween(-90, -1)).alias("prev_min")]], before=90)
    return df.select(*BASE, "hh", "ll", "prev_max", "prev_min")


_YEAR = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"


@query("w6_sliding_year", f"""WITH {S.BARS}, r AS (SELECT ticker, date, max(high) OVER {_YEAR} AS high_252, min(low) OVER {_YEAR} AS low_252,
 CAST(sum(volume) OVER {_YEAR} AS BIGINT) AS volume_252, CASE WHEN count(close) OVER {_YEAR} >= 252 THEN avg(close) OVER {_YEAR} END AS mean_252,
 CASE WHEN count(close) OVER {_YEAR} >= 252 THEN stddev_samp(close) OVER {_YEAR} END AS std_252 FROM bars)
 SELECT ticker, date, high_252, low_252, volume_252, {sql_rounded(4, 'mean_252')}, {sql_rounded(2, 'std_252')} FROM r""")
def w6_year(spark, sf):
    df = P.sliding(X.bars(spark, sf), P.BARS, {
        "high_252": P.Slide("max", "high", 252), "low_252": P.Slide("min", "low", 252), "volume_252": P.Slide("sum", "volume", 252),
        "mean_252": P.Slide("mean", "close", 252, least=252), "std_252": P.Slide("std", "close", 252, least=252)})
    return df.select(*BASE, "high_252", "low_252", "volume_252", *rounded(4, "mean_252"), *rounded(2, "std_252"))


_TICKS_900 = "(PARTITION BY ticker ORDER BY ts, event_id ROWS BETWEEN 900 PRECEDING AND 1 PRECEDING)"


@query("w5_sliding_ticks", f"""WITH {S.TICKS}, r AS (SELECT ticker, event_id, max(price) OVER {_TICKS_900} AS prev_max, min(price) OVER {_TICKS_900} AS prev_min,
 CAST(count(price) OVER {_TICKS_900} AS BIGINT) AS n_900, CAST(sum(CAST(price * 100 AS BIGINT)) OVER {_TICKS_900} AS BIGINT) AS cents_900, stddev_samp(price) OVER {_TICKS_900} AS std_900 FROM ticks)
 SELECT ticker, event_id, prev_max, prev_min, n_900, cents_900, {sql_rounded(6, 'std_900')} FROM r""")
def w5_sliding(spark, sf):
    cents = (F.col("price") * 100).cast("decimal(20,0)").cast("long")
    df = P.sliding(X.ticks_panel(spark, sf), X.TICKS, {
        "prev_max": P.Slide("max", "price", 900, 1), "prev_min": P.Slide("min", "price", 900, 1), "n_900": P.Slide("count", "price", 900, 1, least=0),
        "cents_900": P.Slide("sum", cents, 900, 1), "std_900": P.Slide("std", "price", 900, 1, least=2)})
    return df.select("ticker", "event_id", "prev_max", "prev_min", "n_900", "cents_900", *rounded(6, "std_900"))


@query("w7_first_last_value", f"""WITH {S.BARS} SELECT ticker, date, first_value(close) OVER u AS first_close,
 last_value(close) OVER u AS last_close FROM bars
 WINDOW u AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def w7(spark, sf):
    ends = [F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close")]
    return P.attach_per_key(X.bars(spark, sf), P.BARS, ends).select(*BASE, "first_close", "last_close")


_RUN = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("w8_running", f"""WITH {S.BARS} SELECT ticker, date, CAST(sum(volume) OVER {_RUN} AS BIGINT) AS running_volume,
 max(close) OVER {_RUN} AS running_max, round(exp(sum(ln(1 + (day(date) - 15) / 5000.0)) OVER {_RUN}), 6) AS running_product FROM bars""")
def w8(spark, sf):
    factor = 1 + (F.dayofmonth("date") - 15) / F.lit(5000.0)
    df = P.running(X.bars(spark, sf), P.BARS, {
        "running_volume": P.Run("sum", F.col("volume")), "running_max": P.Run("max", F.col("close")),
        "running_product": P.Run("product", factor)})
    return df.select(*BASE, "running_volume", "running_max", *rounded(6, "running_product"))


@query("w9_ewm", f"""WITH {S.BARS}, e AS (SELECT ticker, date, {S.ewm('close', '(2.0::DOUBLE/13)')} AS ewm_span_12,
 {S.ewm('close', '(1.0::DOUBLE/14)')} AS ewm_wilder_14, {S.ewm('close', '(2.0::DOUBLE/201)')} AS ewm_span_200 FROM bars)
 SELECT ticker, date, {sql_rounded(2, 'ewm_span_12', 'ewm_wilder_14', 'ewm_span_200')} FROM e""")
def w9(spark, sf):
    close = F.col("close")
    df = P.ewm(X.bars(spark, sf), P.BARS, [
        P.Ewm("ewm_span_12", close, P.span_alpha(12)), P.Ewm("ewm_wilder_14", close, 1 / 14),
        P.Ewm("ewm_span_200", close, P.span_alpha(200))])
    return df.select(*BASE, *rounded(2, "ewm_span_12", "ewm_wilder_14", "ewm_span_200"))


@query("w9_ewm_with_gaps", f"""WITH {S.BARS_GAPPY}, e AS (
  SELECT ticker, date, {S.ewm_gaps('close', '(2.0::DOUBLE/13)')} AS ewm_span_12
  FROM bars_gappy) SELECT ticker, date, {sql_rounded(2, 'ewm_span_12')} FROM e""")
def w9_gaps(spark, sf):
    df = P.ewm_with_gaps(X.bars_gappy(spark, sf), P.BARS, "ewm_span_12", "close", P.span_alpha(12))
    return df.select(*BASE, *rounded(2, "ewm_span_12"))


@query("w9_wide_panel", f"""WITH {S.BARS_LI}, e AS (SELECT ticker, date, {S.ewm('close', '(2.0::DOUBLE/13)')} AS ewm_span_12, {S.full('avg', 'close', 20)} AS mean_20 FROM bars_li)
 SELECT ticker, date, {sql_rounded(4, 'ewm_span_12')}, {sql_rounded(6, 'mean_20')} FROM e""")
def w9_wide(spark, sf):
    mean = {"mean_20": lambda w: P.rolling(F.avg("close"), "close", 20, w)}
    df = P.windowed(X.bars_li(spark, sf), P.BARS, P.merge_steps([[mean]]), before=19)
    df = P.ewm(df, P.BARS, [P.Ewm("ewm_span_12", F.col("close"), P.span_alpha(12))])
    return df.select(*BASE, *rounded(4, "ewm_span_12"), *rounded(6, "mean_20"))


@query("w10_lag_of_window", f"""WITH {S.BARS}, m AS (SELECT ticker, date, avg(close) OVER {S.frame(7)} AS ma FROM bars)
 SELECT ticker, date, round(ma - lag(ma, 7) OVER {S.W}, 4) AS ma_momentum FROM m""")
def w10(spark, sf):
    df = P.windowed(X.bars(spark, sf), P.BARS, [
        lambda w: [P.rolling(F.avg("close"), "close", 7, w, 1).alias("__ma")],
        lambda w: [(F.col("__ma") - F.lag("__ma", 7).over(w)).alias("ma_momentum")]], before=13)
    return df.select(*BASE, *rounded(4, "ma_momentum"))


@query("w11_latest_rows", f"""WITH {S.BARS} SELECT ticker, date, close, rank_latest FROM (
 SELECT ticker, date, close, CAST(row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS INTEGER) AS rank_latest FROM bars)
 WHERE rank_latest <= 20""")
def w11(spark, sf):
    return latest_rows(X.bars(spark, sf), 20, rank="rank_latest").select(*BASE, "close", "rank_latest")


@query("w12_sequences", f"""WITH {S.BARS}, s AS (SELECT ticker, date, list([close, volume::DOUBLE]) OVER {S.frame(10)} AS sequence,
 lead(close, 1) OVER {S.W} AS label, count(*) OVER {S.frame(10)} AS n FROM bars)
 SELECT ticker, date, CAST(to_json(sequence) AS VARCHAR) AS sequence, label FROM s WHERE n = 10 AND label IS NOT NULL""")
def w12(spark, sf):
    return sequences(X.bars(spark, sf), ["close", "volume"], "close", 10, 1).select(*BASE, F.to_json("sequence").alias("sequence"), "label")


_TICK_ORDER = "PARTITION BY ticker ORDER BY ts, event_id"
_LAST_50 = f"({_TICK_ORDER} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"


@query("w4_rolling_ticks", f"""WITH {S.TICKS}, r AS (SELECT ticker, event_id, CASE WHEN count(price) OVER {_LAST_50} >= 50 THEN avg(price) OVER {_LAST_50} END AS mean_50,
 CASE WHEN count(price) OVER {_LAST_50} >= 50 THEN stddev_samp(price) OVER {_LAST_50} END AS std_50, lag(price) OVER ({_TICK_ORDER}) AS prev_price FROM ticks)
 SELECT ticker, event_id, {sql_rounded(6, 'mean_50', 'std_50')}, prev_price FROM r""")
def w4_ticks(spark, sf):
    df = P.windowed(X.ticks_panel(spark, sf), X.TICKS, [
        lambda w: [P.rolling(F.avg("price"), "price", 50, w).alias("mean_50"),
                   P.rolling(F.stddev_samp("price"), "price", 50, w).alias("std_50"),
                   F.lag("price", 1).over(w).alias("prev_price")]], before=49)
    return df.select("ticker", "event_id", *rounded(6, "mean_50", "std_50"), "prev_price")


_SO_FAR = f"({_TICK_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("w8_running_ticks", f"""WITH {S.TICKS} SELECT ticker, event_id, CAST(sum(size) OVER {_SO_FAR} AS BIGINT) AS volume, max(price) OVER {_SO_FAR} AS peak,
 round(sum(CAST(price * 100 AS BIGINT) * size) OVER {_SO_FAR} / 100.0::DOUBLE / nullif(sum(size) OVER {_SO_FAR}, 0), 6) AS vwap FROM ticks""")
def w8_ticks(spark, sf):
    cents = (F.col("price") * 100).cast("decimal(20,0)").cast("long")
    df = P.running(X.ticks_panel(spark, sf), X.TICKS, {
        "volume": P.Run("sum", F.col("size")), "peak": P.Run("max", F.col("price")), "__value": P.Run("sum", cents * F.col("size"))})
    vwap = F.try_divide(F.col("__value") / 100, F.col("volume"))
    return df.select("ticker", "event_id", "volume", "peak", F.round(vwap, 6).alias("vwap"))


_TICK_LIST = f"list(price) OVER {_SO_FAR}"


@query("w9_ewm_ticks", f"""WITH {S.TICKS}, e AS (SELECT ticker, event_id, list_reduce({_TICK_LIST}, lambda a, b: a * (1 - 2.0::DOUBLE/27) + b * (2.0::DOUBLE/27)) AS ewm_26 FROM ticks)
 SELECT ticker, event_id, {sql_rounded(6, 'ewm_26')} FROM e""")
def w9_ticks(spark, sf):
    df = P.ewm(X.ticks_panel(spark, sf), X.TICKS, [P.Ewm("ewm_26", F.col("price"), P.span_alpha(26))])
    return df.select("ticker", "event_id", *rounded(6, "ewm_26"))


@query("p7_forward_fill_ticks", f"""WITH {S.TICKS}, h AS (SELECT ticker, ts, event_id, CASE WHEN size > 75 THEN price END AS price FROM ticks)
 SELECT ticker, event_id, last_value(price IGNORE NULLS) OVER {_SO_FAR} AS price FROM h""")
def p7_ticks(spark, sf):
    holes = X.ticks(spark, sf).withColumn("price", F.when(F.col("size") > 75, F.col("price")))
    bucket = P.time_bucket(holes, "ts", P.bucket_seconds(holes, X.TICKS))
    return P.forward_fill(holes, X.TICKS, ["price"], bucket).select("ticker", "event_id", "price")
