"""Feature engineering F1-F12, F15-F17 (F13 and F14 are with the models)."""

from pyspark.sql import functions as F

from tickloom.operators import features as E
from tickloom.plans import sql as S
from tickloom.plans.indicators import MAS
from tickloom.plans.joins import DAILY
from tickloom.plans.registry import ORACLES, query, rounded
from tickloom.sources import fixtures as X

BASE = ("ticker", "date")


@query("f1_lag_features", f"""WITH {S.BARS} SELECT ticker, date,
 {", ".join(f"lag({c}, {n}) OVER {S.W} AS {c}_lag_{n}" for c in ("open", "high", "low", "close", "volume") for n in range(1, 6))} FROM bars""")
def f1(spark, sf):
    df = E.lag_features(X.bars(spark, sf), 5)
    return df.select(*BASE, *[c for c in df.columns if "_lag_" in c])


@query("f2_history_features", f"""WITH {S.BARS} SELECT ticker, date, {", ".join(f"lag(close, {n}) OVER {S.W} AS close_lag_{n}" for n in (1, 2, 3, 5, 10))},
 {", ".join(f"round({S.full('avg', 'close', n)}, 6) AS close_rolling_mean_{n}" for n in (5, 10, 20))}, round({S.full('avg', 'close', 30)}, 4) AS close_rolling_mean_30,
 {", ".join(f"round({S.full('stddev_samp', 'close', n)}, 2) AS close_rolling_std_{n}" for n in (5, 10, 20, 30))} FROM bars""")
def f2(spark, sf):
    return E.history_features(X.bars(spark, sf)).select(
        *BASE, *[f"close_lag_{n}" for n in E.TARGET_LAGS], *rounded(6, *[f"close_rolling_mean_{n}" for n in (5, 10, 20)]),
        *rounded(4, "close_rolling_mean_30"), *rounded(2, *[f"close_rolling_std_{n}" for n in E.TARGET_WINDOWS]))


@query("f3_step_targets", f"""WITH {S.BARS} SELECT ticker, date, {", ".join(f"lead(close, {n}) OVER {S.W} AS target_{n}d" for n in range(1, 6))},
 round((lead(close) OVER {S.W} - close) / nullif(close, 0), 8) AS target_return_1d,
 CASE WHEN lead(close) OVER {S.W} > close THEN 1 ELSE 0 END AS target_direction FROM bars""")
def f3(spark, sf):
    df = E.step_targets(X.bars(spark, sf), 5)
    return df.select(*BASE, *[f"target_{n}d" for n in range(1, 6)], *rounded(8, "target_return_1d"), "target_direction")


@query("f4_return_targets", f"""WITH {S.BARS}, t AS (SELECT ticker, date, {", ".join(f"lead(close, {n}) OVER {S.W} / nullif(close, 0) - 1 AS t{n}" for n in (1, 5, 10, 20))} FROM bars)
 SELECT ticker, date, {", ".join(f"round(t{n}, 8) AS target_{n}d, coalesce(CAST(t{n} > 0 AS INTEGER), 0) AS target_{n}d_up" for n in (1, 5, 10, 20))} FROM t WHERE t20 IS NOT NULL""")
def f4(spark, sf):
    hs = (1, 5, 10, 20)
    return E.return_targets(X.bars(spark, sf)).select(
        *BASE, *rounded(8, *[f"target_{n}d" for n in hs]), *[f"target_{n}d_up" for n in hs])


@query("f5_percent_target", f"""WITH {S.BARS} SELECT ticker, date, lead(close, 5) OVER {S.W} AS target,
 round(100 * (lead(close, 5) OVER {S.W} / nullif(close, 0) - 1), 6) AS target_pct_change FROM bars""")
def f5(spark, sf):
    return E.percent_target(X.bars(spark, sf), 5).select(*BASE, "target", *rounded(6, "target_pct_change"))


@query("f6_class_targets", f"""WITH {S.BARS}, t AS (SELECT ticker, date, lead(close) OVER {S.W} AS f, 100 * (lead(close) OVER {S.W} / nullif(close, 0) - 1) AS r FROM bars)
 SELECT ticker, date, f AS target_future, round(r, 6) AS target_return, coalesce(CAST(r > 0 AS INTEGER), 0) AS target_binary,
 CASE WHEN r > 1 THEN 2 WHEN r < -1 THEN 0 ELSE 1 END AS target_class FROM t""")
def f6(spark, sf):
    return E.class_targets(X.bars(spark, sf)).select(
        *BASE, "target_future", *rounded(6, "target_return"), "target_binary", "target_class")


_PARTS = """CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month, CAST(week(date) AS INTEGER) AS week_of_year,
 CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year"""
_FLAGS = ", ".join(f"""CAST(date_trunc('{u}', date) = date AS INTEGER) AS is_{u}_start,
 CAST(date_trunc('{u}', date + 1) = date + 1 AS INTEGER) AS is_{u}_end""" for u in ("month", "quarter", "year"))


@query("f7_date_parts", f"WITH {S.BARS} SELECT ticker, date, {_PARTS} FROM bars")
def f7(spark, sf):
    return E.date_parts(X.bars(spark, sf).select(*BASE))


@query("f8_period_flags", f"WITH {S.BARS} SELECT ticker, date, {_FLAGS} FROM bars")
def f8(spark, sf):
    return E.period_flags(X.bars(spark, sf).select(*BASE))


@query("f9_cyclical", f"""WITH {S.BARS} SELECT ticker, date, round(sin(2 * pi() * (isodow(date) - 1) / 7), 8) AS sin_day_of_week,
 round(cos(2 * pi() * (isodow(date) - 1) / 7), 8) AS cos_day_of_week, round(sin(2 * pi() * month(date) / 12), 8) AS sin_month,
 round(cos(2 * pi() * month(date) / 12), 8) AS cos_month FROM bars""")
def f9(spark, sf):
    return E.cyclical(X.bars(spark, sf).select(*BASE)).select(
        *BASE, *rounded(8, "sin_day_of_week", "cos_day_of_week", "sin_month", "cos_month"))


_PROFILE = """profile AS (SELECT ticker, date, avg(polarity) AS polarity_mean, stddev_samp(polarity) AS polarity_std, count(polarity) AS polarity_count,
 avg(subjectivity) AS subjectivity_mean, stddev_samp(subjectivity) AS subjectivity_std FROM sentiment GROUP BY 1, 2)"""
_JOINED = """joined AS (SELECT b.ticker, b.date, coalesce(polarity_mean, 0) AS polarity_mean, coalesce(polarity_std, 0) AS polarity_std,
 coalesce(polarity_count, 0) AS polarity_count, coalesce(subjectivity_mean, 0) AS subjectivity_mean FROM bars_ev b LEFT JOIN profile USING (ticker, date))"""
_ROLLS = [(c, n) for n in (3, 7, 14) for c in ("polarity_mean", "polarity_std", "subjectivity_mean")]


@query("f10_sentiment_features", f"""WITH {S.BARS_EV}, {S.SENTIMENT}, {_PROFILE}, {_JOINED}
 SELECT ticker, date, polarity_count, round(polarity_mean, 8) AS polarity_mean, {", ".join(f"round({S.full('avg', c, n)}, 8) AS {c}_rolling_{n}d" for c, n in _ROLLS)} FROM joined""")
def f10(spark, sf):
    df = E.sentiment_features(X.bars_ev(spark, sf), X.sentiment(spark, sf))
    return df.select(*BASE, "polarity_count", *rounded(8, "polarity_mean", *[f"{c}_rolling_{n}d" for c, n in _ROLLS]))


@query("f11_min_max", f"""WITH {S.BARS}, m AS (SELECT ticker, min(close) AS lo, max(close) AS hi, min(volume) AS vlo, max(volume) AS vhi FROM bars GROUP BY ticker)
 SELECT ticker, date, round(coalesce((close - lo) / nullif(hi - lo, 0), 0), 8) AS close,
 round(coalesce((volume - vlo)::DOUBLE / nullif(vhi - vlo, 0), 0), 8) AS volume FROM bars JOIN m USING (ticker)""")
def f11(spark, sf):
    df = X.bars(spark, sf)
    return E.apply_min_max(df, E.min_max(df, ["close", "volume"]), ["close", "volume"]).select(*BASE, *rounded(8, "close", "volume"))


@query("f11_min_max_inverse", f"WITH {S.BARS} SELECT ticker, date, round(close, 4) AS close FROM bars")
def f11_inverse(spark, sf):
    df = X.bars(spark, sf)
    fitted = E.min_max(df, ["close"])
    return E.invert_min_max(E.apply_min_max(df, fitted, ["close"]), fitted, ["close"]).select(*BASE, *rounded(4, "close"))


def _split_sql(first, second, name_first, name_second):
    return f"""WITH {S.BARS}, n AS (SELECT ticker, date, row_number() OVER {S.W} - 1 AS p, count(*) OVER (PARTITION BY ticker) AS n FROM bars)
 SELECT ticker, date, CASE WHEN p < floor(n * {first}::DOUBLE) THEN '{name_first}'
 WHEN p < floor(n * {first}::DOUBLE) + floor(n * {second}::DOUBLE) THEN '{name_second}' ELSE 'test' END AS split FROM n"""


@query("f12_split_80_10_10", _split_sql(0.8, 0.1, "train", "val"))
def f12(spark, sf):
    return E.chronological_split(X.bars(spark, sf)).select(*BASE, "split")


@query("f12_split_70_15_15", _split_sql(0.7, 0.15, "train", "val"))
def f12_70(spark, sf):
    return E.chronological_split(X.bars(spark, sf), (("train", 0.7), ("val", 0.15))).select(*BASE, "split")


@query("f12_split_80_20", _split_sql(0.8, 0, "train", "val"))
def f12_80(spark, sf):
    return E.chronological_split(X.bars(spark, sf), (("train", 0.8),)).select(*BASE, "split")


@query("f15_full_features", f"""WITH {S.BARS_EV}, {S.SENTIMENT}, {_PROFILE}, {_JOINED}, bars AS (SELECT * FROM bars_ev), {MAS},
 x AS (SELECT ticker, date, close, close / nullif(lag(close) OVER {S.W}, 0) - 1 AS ret, lead(close, 5) OVER {S.W} / nullif(close, 0) - 1 AS t5,
  {S.ewm('close', '(2.0::DOUBLE/13)')} - {S.ewm('close', '(2.0::DOUBLE/27)')} AS macd FROM bars)
 SELECT ticker, date, x.close, round(m5, 6) AS sma_5, round(m20, 6) AS sma_20, round(macd, 6) AS macd, round(ret, 8) AS daily_return,
 CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, round(polarity_mean, 8) AS polarity_mean,
 round(t5, 8) AS target_5d, coalesce(CAST(t5 > 0 AS INTEGER), 0) AS target_5d_up FROM x JOIN ma USING (ticker, date) JOIN joined USING (ticker, date)""")
def f15(spark, sf):
    df = E.full_features(X.bars_ev(spark, sf), X.sentiment(spark, sf))
    return df.select(*BASE, "close", *rounded(6, "sma_5", "sma_20", "macd"), *rounded(8, "daily_return"), "day_of_week",
                     *rounded(8, "polarity_mean", "target_5d"), "target_5d_up")


# The columns of the whole pipeline by the digits they are compared to, with the query whose SQL gives them without the fill.
_FULL = {
    "t1_sma": {6: [f"sma_{n}" for n in (5, 10, 20, 50, 100, 200)]}, "t2_ema": {2: [f"ema_{n}" for n in (5, 10, 20, 50, 100, 200)]},
    "t3_rsi": {6: ["rsi"]}, "t4_rsi_wilder": {6: ["rsi_wilder"]},
    "t5_bollinger": {4: ["bb_middle"], 2: ["bb_std", "bb_upper", "bb_lower"], 8: ["bb_width"]},
    "t6_macd": {2: ["macd", "macd_signal", "macd_hist"]}, "t7_stochastic": {6: ["stoch_k", "stoch_d"]},
    "t8_adx": {6: ["plus_di", "minus_di", "adx"]}, "t9_atr": {4: ["true_range"], 3: ["atr"]}, "t10_obv": {0: ["obv"]}, "t11_cci": {5: ["cci"]},
    "t12_roc_mom": {6: ["roc_10", "mom_10"]}, "t13_williams_r": {6: ["williams_r"]},
    "t14_volume": {6: ["volume_ma5", "volume_ma10", "volume_ma20", "volume_change", "volume_ratio_ma5", "volume_ratio_ma20", "volume_volatility"]},
    "t15_volume_oscillator": {6: ["volume_osc", "price_volume_ratio"]}, "t16_returns": {8: ["daily_return", "log_return"]},
    "t17_volatility": {6: [f"volatility_{n}" for n in (5, 10, 20)]}, "t18_momentum": {8: [f"momentum_{n}" for n in (5, 10, 20)]},
    "t19_gap_range": {8: ["gap", "hl_range"]}, "t22_ma_state": {None: [f"ma_state_{a}_{b}" for a, b in ((5, 10), (10, 20), (20, 50), (50, 200))]},
    "t23_price_to_ma": {8: [f"price_to_ma{n}" for n in (5, 10, 20, 50, 100, 200)]},
}
_INDICATORS = {c: digits for groups in _FULL.values() for digits, names in groups.items() for c in names}
_CALENDAR = {"f7_date_parts": ["day_of_week", "day_of_month", "week_of_year", "month", "quarter", "year"],
             "f8_period_flags": [f"is_{u}_{e}" for u in ("month", "quarter", "year") for e in ("start", "end")],
             "f9_cyclical": ["sin_day_of_week", "cos_day_of_week", "sin_month", "cos_month"]}
_TARGETS = [f"target_{n}d" for n in (1, 5)]


def _whole_sql(source):
    """Every indicator filled forward, then backward, then with 0; calendar parts; targets; over the bars of ``source``."""
    def of(name):
        return ORACLES[name].replace(S.BARS, source)
    past, ahead = f"{S.W[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", f"{S.W[:-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    filled = ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER {past}, first_value({c} IGNORE NULLS) OVER {ahead}, 0) AS {c}" for c in _INDICATORS)
    tables = ", ".join(f"{name} AS ({of(name)})" for name in (*_FULL, *_CALENDAR))
    forward = ", ".join(f"lead(close, {n}) OVER {S.W} / nullif(close, 0) - 1 AS target_{n}d" for n in (1, 5))
    return f"""{source}, {tables}, wide AS (SELECT * FROM {" JOIN ".join([next(iter(_FULL)), *(f"{n} USING (ticker, date)" for n in [*_FULL, *_CALENDAR][1:])])}),
 filled AS (SELECT ticker, date, {filled}, {", ".join(c for names in _CALENDAR.values() for c in names)} FROM wide),
 targets AS (SELECT ticker, date, {forward} FROM bars),
 whole AS (SELECT ticker, date, {", ".join(f"round({c}, {d}) AS {c}" if d else c for c, d in _INDICATORS.items())}, {", ".join(c for names in _CALENDAR.values() for c in names)},
  {", ".join(f"round({c}, 8) AS {c}, coalesce(CAST({c} > 0 AS INTEGER), 0) AS {c}_up" for c in _TARGETS)} FROM filled JOIN targets USING (ticker, date))"""


def _whole_columns():
    return [*BASE, *(rounded(d, c)[0] if d else F.col(c) for c, d in _INDICATORS.items()), *(c for names in _CALENDAR.values() for c in (
        rounded(8, *names) if names[0].startswith("sin") else names)), *rounded(8, *_TARGETS), *(f"{c}_up" for c in _TARGETS)]


@query("f15_all_indicators", f"WITH {_whole_sql(S.BARS)} SELECT * FROM whole")
def f15_all(spark, sf):
    """Every column of the pipeline over long series."""
    return E.pipeline_features(X.bars(spark, sf)).select(*_whole_columns())


_EV_AS_BARS = S.BARS_EV.replace("bars_ev AS", "bars AS")


@query("f15_whole_pipeline", f"""WITH {_whole_sql(_EV_AS_BARS)}, bars_ev AS (SELECT * FROM bars), {S.SENTIMENT}, {_PROFILE}, {_JOINED},
 rolled AS (SELECT ticker, date, round(polarity_mean, 8) AS polarity_mean, polarity_count,
  {", ".join(f"round({S.full('avg', c, n)}, 8) AS {c}_rolling_{n}d" for c, n in _ROLLS)} FROM joined)
 SELECT * FROM whole JOIN rolled USING (ticker, date)""")
def f15_whole(spark, sf):
    """Every column of the pipeline with news sentiment; series shorter than the longest window are filled."""
    out = E.pipeline_features(X.bars_ev(spark, sf), X.sentiment(spark, sf))
    return out.select(*_whole_columns(), *rounded(8, "polarity_mean"), "polarity_count", *rounded(8, *[f"{c}_rolling_{n}d" for c, n in _ROLLS]))


@query("f16_combine_sources", f"""WITH {S.BARS_EV}, {S.SENTIMENT}, {DAILY}, {S.MACRO},
 shifted AS (SELECT series_id, CAST(date + INTERVAL 25 YEAR AS DATE) AS date, value FROM macro)
 SELECT b.ticker, b.date, b.close, round(coalesce(avg_polarity, 0), 8) AS avg_polarity, {", ".join(f"m{i}.value AS macro_{i}" for i in "ANR")}
 FROM bars_ev b LEFT JOIN daily USING (ticker, date)
 {" ".join(f"ASOF LEFT JOIN (SELECT date, value FROM shifted WHERE series_id = '{i}') m{i} ON b.date >= m{i}.date" for i in "ANR")}""")
def f16(spark, sf):
    macro = X.macro(spark, sf).withColumn("date", F.add_months("date", 300))
    df = E.combine_sources(X.bars_ev(spark, sf), X.sentiment(spark, sf), macro, X.MACRO_IDS)
    return df.select(*BASE, "close", *rounded(8, "avg_polarity"), *[f"macro_{i}" for i in X.MACRO_IDS])


@query("f17_business_days", f"""WITH {S.BARS}, l AS (SELECT ticker, max(date) AS d FROM bars GROUP BY ticker),
 c AS (SELECT ticker, CAST(unnest(generate_series(d + 1, d + 64, INTERVAL 1 DAY)) AS DATE) AS forecast_date FROM l),
 b AS (SELECT ticker, forecast_date, CAST(row_number() OVER (PARTITION BY ticker ORDER BY forecast_date) AS INTEGER) AS step FROM c WHERE isodow(forecast_date) < 6)
 SELECT ticker, step, forecast_date FROM b WHERE step <= 30""")
def f17(spark, sf):
    last = X.bars(spark, sf).groupBy("ticker").agg(F.max("date").alias("date"))
    return E.next_business_days(last, 30)
