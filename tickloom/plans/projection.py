"""Projection, filter and NULL handling P1-P12."""

from pyspark.sql import functions as F

from tickloom.operators import frames as R
from tickloom.operators import panel as P
from tickloom.plans import sql as S
from tickloom.plans.registry import query, rounded
from tickloom.sources import fixtures as X

BASE = ("ticker", "date")


@query("p1_standardise_columns", f"WITH {S.BARS} SELECT ticker, date, open, high, low, close, volume FROM bars")
def p1(spark, sf):
    raw = X.bars(spark, sf).select(F.col("ticker").alias("Ticker"), F.col("date").alias("Date"), F.col("open").alias("OPEN"),
                                   F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
                                   F.col("volume").alias("Volume"))
    return R.standardise_ohlcv(raw)


@query("p2_coerce_numbers", """SELECT event_id, TRY_CAST(CASE WHEN value < 5 THEN '.' WHEN value > 100 THEN 'n/a'
 ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value FROM events""")
def p2(spark, sf):
    text = (F.when(F.col("value") < 5, ".").when(F.col("value") > 100, "n/a")
            .otherwise(F.col("value").cast("string")))
    return X.table(spark, sf, "events").select("event_id", R.to_number(text).alias("value"))


@query("p3_date_range", f"WITH {S.BARS} SELECT ticker, date, close FROM bars WHERE date BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'")
def p3(spark, sf):
    return R.date_range(X.bars(spark, sf), "1997-03-01", "1998-02-28").select(*BASE, "close")


@query("p4_lookback_slice", f"""WITH {S.BARS}, m AS (SELECT ticker, max(date) AS d FROM bars GROUP BY ticker)
 SELECT b.ticker, b.date, b.close FROM bars b JOIN m USING (ticker) WHERE b.date >= m.d - 30""")
def p4(spark, sf):
    return R.lookback_slice(X.bars(spark, sf), 30).select(*BASE, "close")


@query("p5_numeric_columns", f"WITH {S.BARS} SELECT ticker, open, high, low, close, volume FROM bars")
def p5(spark, sf):
    df = X.bars(spark, sf).withColumn("target_1d", F.lit(0.0))
    return df.select("ticker", *R.numeric_columns(df))


@query("p6_null_loss", f"""WITH {S.BARS_GAPPY} SELECT ticker, count(*) AS n_rows, count(close) AS n_kept,
 round(1 - count(close)::DOUBLE / count(*), 8) AS loss FROM bars_gappy GROUP BY ticker""")
def p6(spark, sf):
    return R.null_loss(X.bars_gappy(spark, sf), ["close", "volume"]).select("ticker", "n_rows", "n_kept", *rounded(8, "loss"))


@query("p6_drop_nulls", f"WITH {S.BARS_GAPPY} SELECT ticker, date, close, volume FROM bars_gappy WHERE close IS NOT NULL AND volume IS NOT NULL")
def p6_drop(spark, sf):
    return X.bars_gappy(spark, sf).na.drop(subset=["close", "volume"]).select(*BASE, "close", "volume")


@query("p6_preprocess", f"""WITH {S.BARS_GAPPY} SELECT ticker, date, open, high, low,
 coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS close,
 coalesce(last_value(volume IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS volume
 FROM bars_gappy""")
def p6_preprocess(spark, sf):
    return R.preprocess(X.bars_gappy(spark, sf)).drop("pos")


_BEFORE = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_AFTER = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query("p7_forward_fill", f"""WITH {S.BARS_GAPPY} SELECT ticker, date, last_value(close IGNORE NULLS) OVER {_BEFORE} AS close,
 last_value(volume IGNORE NULLS) OVER {_BEFORE} AS volume FROM bars_gappy""")
def p7(spark, sf):
    return P.forward_fill(X.bars_gappy(spark, sf), P.BARS, ["close", "volume"]).select(*BASE, "close", "volume")


@query("p8_backward_fill", f"""WITH {S.BARS_GAPPY} SELECT ticker, date, first_value(close IGNORE NULLS) OVER {_AFTER} AS close,
 first_value(volume IGNORE NULLS) OVER {_AFTER} AS volume FROM bars_gappy""")
def p8(spark, sf):
    return P.backward_fill(X.bars_gappy(spark, sf), P.BARS, ["close", "volume"]).select(*BASE, "close", "volume")


@query("p9_fill_all", f"""WITH {S.BARS_GAPPY} SELECT ticker, date, coalesce(last_value(close IGNORE NULLS) OVER {_BEFORE},
 first_value(close IGNORE NULLS) OVER {_AFTER}, 0) AS close, coalesce(last_value(volume IGNORE NULLS) OVER {_BEFORE},
 first_value(volume IGNORE NULLS) OVER {_AFTER}, 0) AS volume FROM bars_gappy""")
def p9(spark, sf):
    return P.fill_all(X.bars_gappy(spark, sf), P.BARS, ["close", "volume"]).select(*BASE, "close", "volume")


@query("p10_constant_fill", f"WITH {S.BARS_GAPPY} SELECT ticker, date, coalesce(close, 0) AS close, coalesce(volume, 0) AS volume FROM bars_gappy")
def p10(spark, sf):
    return X.bars_gappy(spark, sf).na.fill(0, ["close", "volume"]).select(*BASE, "close", "volume")


@query("p11_interpolate", f"""WITH {S.BARS_GAPPY}, n AS (SELECT ticker, date, close, row_number() OVER {S.W} AS rn FROM bars_gappy),
 p AS (SELECT *, last_value(CASE WHEN close IS NOT NULL THEN rn END IGNORE NULLS) OVER {_BEFORE} AS ra, last_value(close IGNORE NULLS) OVER {_BEFORE} AS xa,
  first_value(CASE WHEN close IS NOT NULL THEN rn END IGNORE NULLS) OVER {_AFTER} AS rb, first_value(close IGNORE NULLS) OVER {_AFTER} AS xb FROM n)
 SELECT ticker, date, round(CASE WHEN close IS NOT NULL THEN close WHEN ra IS NULL THEN NULL WHEN rb IS NULL THEN xa
  ELSE xa + (xb - xa) * (rn - ra)::DOUBLE / (rb - ra) END, 5) AS close FROM p""")
def p11(spark, sf):
    return P.interpolate(X.bars_gappy(spark, sf), P.BARS, ["close"]).select(*BASE, *rounded(5, "close"))


@query("p12_recent_table", f"""WITH {S.BARS}, r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars)
 SELECT ticker, strftime(date, '%Y-%m-%d') AS date, printf('%.2f', open) AS open, printf('%.2f', high) AS high, printf('%.2f', low) AS low,
 printf('%.2f', close) AS close, CAST(volume AS VARCHAR) AS volume FROM r WHERE rn <= 20""")
def p12(spark, sf):
    return R.recent_table(X.bars(spark, sf), 20)
