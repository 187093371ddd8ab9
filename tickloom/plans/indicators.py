"""Indicators T1-T24."""

from tickloom.operators import indicators as I
from tickloom.plans import sql as S
from tickloom.plans.registry import query, rounded, sql_rounded
from tickloom.sources import fixtures as X

BASE = ("ticker", "date")
PREV = f"lag(close) OVER {S.W}"
RET = f"close / nullif({PREV}, 0) - 1"


@query("t1_sma", f"""WITH {S.BARS}, r AS (SELECT ticker, date,
 {", ".join(f"{S.full('avg', 'close', n)} AS sma_{n}" for n in (5, 10, 20, 50, 100, 200))} FROM bars)
 SELECT ticker, date, {sql_rounded(6, *[f'sma_{n}' for n in (5, 10, 20, 50, 100, 200)])} FROM r""")
def t1(spark, sf):
    ns = (5, 10, 20, 50, 100, 200)
    return I.compute(X.bars(spark, sf), [I.sma(n) for n in ns]).select(*BASE, *rounded(6, *[f"sma_{n}" for n in ns]))


EMA_SPANS = (5, 10, 12, 20, 26, 50, 100, 200)


@query("t2_ema", f"""WITH {S.BARS}, l AS (SELECT ticker, date, list(close) OVER (PARTITION BY ticker ORDER BY date
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS xs FROM bars) SELECT ticker, date,
 {", ".join(f"round(list_reduce(xs, lambda a, b: a * (1 - 2.0::DOUBLE/{n + 1}) + b * (2.0::DOUBLE/{n + 1})), 2) AS ema_{n}" for n in EMA_SPANS)} FROM l""")
def t2(spark, sf):
    return I.compute(X.bars(spark, sf), [I.ema(n) for n in EMA_SPANS]).select(
        *BASE, *rounded(2, *[f"ema_{n}" for n in EMA_SPANS]))


GL = f"""gl AS (SELECT *, greatest(coalesce(close - {PREV}, 0), 0) AS g, greatest(coalesce({PREV} - close, 0), 0) AS l,
 row_number() OVER {S.W} AS rn FROM bars)"""


@query("t3_rsi", f"""WITH {S.BARS}, {GL}, a AS (SELECT ticker, date, {S.full('avg', 'g', 14)} AS ag, {S.full('avg', 'l', 14)} AS al FROM gl)
 SELECT ticker, date, round(CASE WHEN al = 0 THEN 100 ELSE 100 - 100 / (1 + ag / al) END, 6) AS rsi FROM a""")
def t3(spark, sf):
    return I.compute(X.bars(spark, sf), [I.rsi()]).select(*BASE, *rounded(6, "rsi"))


def _wilder(x):
    return S.ewm(x, "(1.0::DOUBLE/14)")


@query("t4_rsi_wilder", f"""WITH {S.BARS}, {GL}, a AS (SELECT ticker, date, rn, {_wilder('g')} AS ag, {_wilder('l')} AS al FROM gl WHERE rn > 1)
 SELECT gl.ticker, gl.date, round(CASE WHEN gl.rn < 14 THEN NULL WHEN al = 0 THEN 100 ELSE 100 - 100 / (1 + ag / al) END, 6) AS rsi_wilder
 FROM gl LEFT JOIN a USING (ticker, date)""")
def t4(spark, sf):
    return I.compute(X.bars(spark, sf), [I.rsi_wilder()]).select(*BASE, *rounded(6, "rsi_wilder"))


@query("t5_bollinger", f"""WITH {S.BARS}, r AS (SELECT ticker, date, {S.full('avg', 'close', 20)} AS m, {S.full('stddev_samp', 'close', 20)} AS s,
 {S.full('stddev_pop', 'close', 20)} AS p FROM bars)
 SELECT ticker, date, round(m, 4) AS bb_middle, round(s, 2) AS bb_std, round(m + 2 * s, 2) AS bb_upper, round(m - 2 * s, 2) AS bb_lower,
 round(4 * s / nullif(m, 0), 8) AS bb_width, round(p, 2) AS bb_std_pop FROM r""")
def t5(spark, sf):
    df = I.compute(X.bars(spark, sf), [I.bollinger(), I.bollinger(population=True)])
    return df.select(*BASE, *rounded(4, "bb_middle"), *rounded(2, "bb_std", "bb_upper", "bb_lower"),
                     *rounded(8, "bb_width"), *rounded(2, "bb_std_pop"))


@query("t6_macd", f"""WITH {S.BARS}, m AS (SELECT ticker, date, {S.ewm('close', '(2.0::DOUBLE/13)')} - {S.ewm('close', '(2.0::DOUBLE/27)')} AS macd FROM bars),
 s AS (SELECT ticker, date, macd, {S.ewm('macd', '(2.0::DOUBLE/10)')} AS sig FROM m)
 SELECT ticker, date, round(macd, 2) AS macd, round(sig, 2) AS macd_signal, round(macd - sig, 2) AS macd_hist FROM s""")
def t6(spark, sf):
    return I.compute(X.bars(spark, sf), [I.macd()]).select(*BASE, *rounded(2, "macd", "macd_signal", "macd_hist"))


@query("t2_ema_with_gaps", f"""WITH {S.BARS_GAPPY}, e AS (SELECT ticker, date, {S.ewm_gaps('close', '(2.0::DOUBLE/6)')} AS ema_5,
 {S.ewm_gaps('close', '(2.0::DOUBLE/27)')} AS ema_26 FROM bars_gappy)
 SELECT ticker, date, round(ema_5, 2) AS ema_5, round(ema_26, 2) AS ema_26 FROM e""")
def t2_gaps(spark, sf):
    return I.compute(X.bars_gappy(spark, sf), [I.ema(5), I.ema(26)]).select(*BASE, *rounded(2, "ema_5", "ema_26"))


@query("t6_macd_with_gaps", f"""WITH {S.BARS_GAPPY}, m AS (SELECT ticker, date,
  {S.ewm_gaps('close', '(2.0::DOUBLE/13)')} - {S.ewm_gaps('close', '(2.0::DOUBLE/27)')} AS macd FROM bars_gappy),
 s AS (SELECT ticker, date, macd, {S.ewm_gaps('macd', '(2.0::DOUBLE/10)')} AS sig FROM m)
 SELECT ticker, date, round(macd, 2) AS macd, round(sig, 2) AS macd_signal, round(macd - sig, 2) AS macd_hist FROM s""")
def t6_gaps(spark, sf):
    return I.compute(X.bars_gappy(spark, sf), [I.macd()]).select(*BASE, *rounded(2, "macd", "macd_signal", "macd_hist"))


@query("t7_stochastic", f"""WITH {S.BARS}, e AS (SELECT ticker, date, close, {S.full('max', 'high', 14)} AS hh, {S.full('min', 'low', 14)} AS ll FROM bars),
 k AS (SELECT ticker, date, 100 * (close - ll) / nullif(hh - ll, 0) AS k FROM e)
 SELECT ticker, date, round(k, 6) AS stoch_k, round({S.full('avg', 'k', 3)}, 6) AS stoch_d FROM k""")
def t7(spark, sf):
    return I.compute(X.bars(spark, sf), [I.stochastic()]).select(*BASE, *rounded(6, "stoch_k", "stoch_d"))


TR = f"greatest(high - low, abs(high - {PREV}), abs(low - {PREV}))"


def _smoothed(x, first, n=14):
    """Mean of the first n rows from ``first`` (0-based), then Wilder smoothing."""
    run = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    seed = first + n
    return (f"CASE WHEN rn >= {seed} THEN list_reduce(list_concat([list_avg((list({x}) OVER {run})[{first + 1}:{seed}])], "
            f"(list({x}) OVER {run})[{seed + 1}:]), lambda a, b: (a * 13 + b) / 14) END")


ADX = f"""mv AS (SELECT *, row_number() OVER {S.W} AS rn, {TR} AS tr, high - lag(high) OVER {S.W} AS up, lag(low) OVER {S.W} - low AS dn FROM bars),
 dm AS (SELECT *, CASE WHEN up > dn AND up > 0 THEN up ELSE 0.0::DOUBLE END AS pdm, CASE WHEN dn > up AND dn > 0 THEN dn ELSE 0.0::DOUBLE END AS mdm FROM mv),
 sm AS (SELECT ticker, date, rn, {_smoothed('tr', 0)} AS str, {_smoothed('pdm', 0)} AS sp, {_smoothed('mdm', 0)} AS sn FROM dm),
 di AS (SELECT *, 100 * sp / nullif(str, 0) AS pdi, 100 * sn / nullif(str, 0) AS mdi FROM sm),
 dx AS (SELECT *, CASE WHEN pdi + mdi > 0 THEN 100 * abs(pdi - mdi) / (pdi + mdi) ELSE 0.0::DOUBLE END AS dx FROM di)"""


@query("t8_adx", f"""WITH {S.BARS}, {ADX} SELECT ticker, date, round(pdi, 6) AS plus_di, round(mdi, 6) AS minus_di,
 round({_smoothed('dx', 13)}, 6) AS adx FROM dx""")
def t8(spark, sf):
    return I.compute(X.bars(spark, sf), [I.adx()]).select(*BASE, *rounded(6, "plus_di", "minus_di", "adx"))


@query("t9_atr", f"""WITH {S.BARS}, t AS (SELECT *, row_number() OVER {S.W} AS rn, {TR} AS tr FROM bars)
 SELECT ticker, date, round(tr, 4) AS true_range, round({S.full('avg', 'tr', 14)}, 3) AS atr_simple, round({_smoothed('tr', 0)}, 3) AS atr FROM t""")
def t9(spark, sf):
    return I.compute(X.bars(spark, sf), [I.true_range(), I.atr_simple(), I.atr()]).select(
        *BASE, *rounded(4, "true_range"), *rounded(3, "atr_simple", "atr"))


_RUN = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("t10_obv", f"""WITH {S.BARS}, d AS (SELECT *, {PREV} AS prev FROM bars)
 SELECT ticker, date, CAST(sum(CASE WHEN close > prev THEN volume WHEN close < prev THEN -volume ELSE 0 END) OVER {_RUN} AS BIGINT) AS obv,
 CAST(sum(CASE WHEN close < prev THEN -volume ELSE volume END) OVER {_RUN} AS BIGINT) AS obv_b FROM d""")
def t10(spark, sf):
    return I.with_obv(X.bars(spark, sf), outputs={"obv": "a", "obv_b": "b"}).select(*BASE, "obv", "obv_b")


@query("t11_cci", f"""WITH {S.BARS}, t AS (SELECT ticker, date, (high + low + close) / 3 AS tp FROM bars),
 a AS (SELECT ticker, date, tp, list(tp) OVER {S.frame(14)} AS tps, {S.full('avg', 'tp', 14)} AS m FROM t),
 d AS (SELECT ticker, date, tp, m, list_avg(list_transform(tps, lambda x: abs(x - m))) AS mad FROM a)
 SELECT ticker, date, round((tp - m) / nullif(0.015::DOUBLE * mad, 0), 5) AS cci FROM d""")
def t11(spark, sf):
    return I.compute(X.bars(spark, sf), [I.cci()]).select(*BASE, *rounded(5, "cci"))


@query("t12_roc_mom", f"""WITH {S.BARS}, r AS (SELECT ticker, date, 100 * (close / nullif(lag(close, 10) OVER {S.W}, 0) - 1) AS roc,
 close - lag(close, 10) OVER {S.W} AS m FROM bars)
 SELECT ticker, date, round(roc, 6) AS roc_10, round(roc, 6) AS mom_10, round(m, 4) AS momentum_abs_10 FROM r""")
def t12(spark, sf):
    df = I.compute(X.bars(spark, sf), [I.roc(10), I.roc(10, "mom_10"), I.momentum_abs(10)])
    return df.select(*BASE, *rounded(6, "roc_10", "mom_10"), *rounded(4, "momentum_abs_10"))


@query("t13_williams_r", f"""WITH {S.BARS}, e AS (SELECT ticker, date, close, {S.full('max', 'high', 14)} AS hh, {S.full('min', 'low', 14)} AS ll FROM bars)
 SELECT ticker, date, round(-100 * (hh - close) / nullif(hh - ll, 0), 6) AS williams_r FROM e""")
def t13(spark, sf):
    return I.compute(X.bars(spark, sf), [I.williams_r()]).select(*BASE, *rounded(6, "williams_r"))


@query("t14_volume", f"""WITH {S.BARS}, v AS (SELECT ticker, date, volume, {", ".join(f"{S.full('avg', 'volume', n)} AS volume_ma{n}" for n in (5, 10, 20))},
 volume::DOUBLE / nullif(lag(volume) OVER {S.W}, 0) - 1 AS volume_change FROM bars)
 SELECT ticker, date, {sql_rounded(6, 'volume_ma5', 'volume_ma10', 'volume_ma20', 'volume_change')},
 round(volume / nullif(volume_ma5, 0), 6) AS volume_ratio_ma5, round(volume / nullif(volume_ma20, 0), 6) AS volume_ratio_ma20,
 round({S.full('stddev_samp', 'volume_change', 10)}, 6) AS volume_volatility FROM v""")
def t14(spark, sf):
    return I.compute(X.bars(spark, sf), [I.volume_stats()]).select(*BASE, *rounded(
        6, "volume_ma5", "volume_ma10", "volume_ma20", "volume_change", "volume_ratio_ma5", "volume_ratio_ma20",
        "volume_volatility"))


@query("t15_volume_oscillator", f"""WITH {S.BARS}, v AS (SELECT ticker, date, close, volume, {S.full('avg', 'volume', 5)} AS a, {S.full('avg', 'volume', 20)} AS b FROM bars)
 SELECT ticker, date, round(100 * (a - b) / nullif(b, 0), 6) AS volume_osc, round(close / nullif(volume, 0), 6) AS price_volume_ratio FROM v""")
def t15(spark, sf):
    return I.compute(X.bars(spark, sf), [I.volume_oscillator()]).select(
        *BASE, *rounded(6, "volume_osc", "price_volume_ratio"))


@query("t16_returns", f"""WITH {S.BARS} SELECT ticker, date, round({RET}, 8) AS daily_return, round(ln(close / nullif({PREV}, 0)), 8) AS log_return FROM bars""")
def t16(spark, sf):
    return I.compute(X.bars(spark, sf), [I.returns()]).select(*BASE, *rounded(8, "daily_return", "log_return"))


@query("t17_volatility", f"""WITH {S.BARS}, r AS (SELECT ticker, date, {RET} AS ret FROM bars) SELECT ticker, date,
 {", ".join(f"round({S.full('stddev_samp', 'ret', n)}, 6) AS volatility_{n}" for n in (5, 10, 20))} FROM r""")
def t17(spark, sf):
    return I.compute(X.bars(spark, sf), [I.volatility(n) for n in (5, 10, 20)]).select(
        *BASE, *rounded(6, *[f"volatility_{n}" for n in (5, 10, 20)]))


@query("t18_momentum", f"""WITH {S.BARS} SELECT ticker, date,
 {", ".join(f"round(close / nullif(lag(close, {n}) OVER {S.W}, 0) - 1, 8) AS momentum_{n}" for n in (5, 10, 20))} FROM bars""")
def t18(spark, sf):
    return I.compute(X.bars(spark, sf), [I.momentum(n) for n in (5, 10, 20)]).select(
        *BASE, *rounded(8, *[f"momentum_{n}" for n in (5, 10, 20)]))


@query("t19_gap_range", f"""WITH {S.BARS} SELECT ticker, date, round(open / nullif({PREV}, 0) - 1, 8) AS gap,
 round((high - low) / nullif(close, 0), 8) AS hl_range FROM bars""")
def t19(spark, sf):
    return I.compute(X.bars(spark, sf), [I.gap_and_range()]).select(*BASE, *rounded(8, "gap", "hl_range"))


@query("t20_above_ma", f"""WITH {S.BARS} SELECT ticker, date,
 {", ".join(f"coalesce(CAST(close > {S.full('avg', 'close', n)} AS INTEGER), 0) AS above_ma{n}" for n in (50, 200))} FROM bars""")
def t20(spark, sf):
    return I.compute(X.bars(spark, sf), [I.above_ma(50), I.above_ma(200)]).select(*BASE, "above_ma50", "above_ma200")


MAS = f"""ma AS (SELECT ticker, date, close, {", ".join(f"{S.full('avg', 'close', n)} AS m{n}" for n in (5, 10, 20, 50, 100, 200))} FROM bars)"""


def _cross(a, b):
    return (f"coalesce(CAST(m{a} > m{b} AND lag(m{a}) OVER {S.W} <= lag(m{b}) OVER {S.W} AS INTEGER), 0) AS ma_cross_{a}_{b}")


@query("t21_ma_cross_event", f"WITH {S.BARS}, {MAS} SELECT ticker, date, {_cross(5, 20)}, {_cross(10, 50)} FROM ma")
def t21(spark, sf):
    return I.compute(X.bars(spark, sf), [I.cross_event(5, 20), I.cross_event(10, 50)]).select(
        *BASE, "ma_cross_5_20", "ma_cross_10_50")


STATES = ((5, 10), (10, 20), (20, 50), (50, 200))


@query("t22_ma_state", f"""WITH {S.BARS}, {MAS} SELECT ticker, date,
 {", ".join(f"CASE WHEN m{a} > m{b} THEN 1 WHEN m{a} < m{b} THEN -1 ELSE 0 END AS ma_state_{a}_{b}" for a, b in STATES)} FROM ma""")
def t22(spark, sf):
    return I.compute(X.bars(spark, sf), [I.cross_state(a, b) for a, b in STATES]).select(
        *BASE, *[f"ma_state_{a}_{b}" for a, b in STATES])


@query("t23_price_to_ma", f"""WITH {S.BARS}, {MAS} SELECT ticker, date,
 {", ".join(f"round(close / nullif(m{n}, 0), 8) AS price_to_ma{n}" for n in (5, 10, 20, 50, 100, 200))} FROM ma""")
def t23(spark, sf):
    ns = (5, 10, 20, 50, 100, 200)
    return I.compute(X.bars(spark, sf), [I.price_to_ma(n) for n in ns]).select(
        *BASE, *rounded(8, *[f"price_to_ma{n}" for n in ns]))


@query("t24_configured_set", f"""WITH {S.BARS}, r AS (SELECT ticker, date, {S.full('avg', 'close', 30)} AS s30, {S.full('avg', 'close', 60)} AS s60,
 {S.ewm('close', '(2.0::DOUBLE/16)')} AS e15, {S.full('avg', 'close', 10)} AS m10, {S.full('stddev_samp', 'close', 10)} AS d10,
 close / nullif(lag(close, 3) OVER {S.W}, 0) - 1 AS mo FROM bars)
 SELECT ticker, date, round(s30, 4) AS sma_30, round(s60, 4) AS sma_60, round(e15, 2) AS ema_15, round(m10 + 1.5 * d10, 2) AS bb_upper_10_1_5,
 round(mo, 8) AS momentum_3 FROM r""")
def t24(spark, sf):
    spec = {"sma": [30, 60], "ema": [15], "bollinger": [(10, 1.5)], "momentum": [3]}
    return I.compute(X.bars(spark, sf), I.from_spec(spec)).select(
        *BASE, *rounded(4, "sma_30", "sma_60"), *rounded(2, "ema_15", "bb_upper_10_1_5"), *rounded(8, "momentum_3"))
