import numpy as np
import pandas as pd
import pytest
from helpers import BAR_SCHEMA, SMALL, close_to, collected, make_bars, to_spark

from tickloom.operators import indicators as I
from tickloom.operators import panel as P

def everything():
    return [I.sma(5), I.ema(5), I.rsi(), I.rsi_wilder(), I.bollinger(), I.macd(3, 6, 2), I.stochastic(), I.williams_r(),
           I.cci(), I.roc(), I.true_range(), I.atr(), I.atr_simple(), I.adx(), I.returns(), I.volatility(5), I.momentum(5),
           I.gap_and_range(), I.volume_stats(), I.volume_oscillator(), I.above_ma(5), I.cross_event(3, 6), I.cross_state(3, 6),
           I.price_to_ma(5)]


def test_small_blocks_equal_one_block(spark):
    pdf = make_bars({"A": 9000, "B": 30, "C": 1}, constant=("B",))
    df = P.number_rows(to_spark(spark, pdf))
    whole = I.compute(df, everything(), P.Panel(block_rows=1_000_000))
    names = [c for c in whole.columns if c not in df.columns]
    a, b = collected(whole, *names), collected(I.compute(df, everything(), SMALL), *names)
    assert len(a) == len(pdf)
    for c in names:
        close_to(a[c], b[c], rtol=1e-9)


def test_wilder_and_adx_follow_the_recursion(spark):
    pdf = make_bars({"A": 200})
    got = collected(I.compute(P.number_rows(to_spark(spark, pdf)), [I.atr(), I.adx()]), "atr", "plus_di", "minus_di", "adx")
    h, l, c = (pdf[x].to_numpy() for x in ("high", "low", "close"))
    tr = np.concatenate([[h[0] - l[0]], np.maximum.reduce([h[1:] - l[1:], abs(h[1:] - c[:-1]), abs(l[1:] - c[:-1])])])
    up, dn = np.diff(h, prepend=h[0]), -np.diff(l, prepend=l[0])
    pdm, mdm = np.where((up > dn) & (up > 0), up, 0), np.where((dn > up) & (dn > 0), dn, 0)

    def wilder(x, first, n=14):
        out = np.full(len(x), np.nan)
        out[first + n - 1] = x[first:first + n].mean()
        for i in range(first + n, len(x)):
            out[i] = (out[i - 1] * (n - 1) + x[i]) / n
        return out

    atr, p, m = wilder(tr, 0), wilder(pdm, 0), wilder(mdm, 0)
    pdi, mdi = 100 * p / atr, 100 * m / atr
    adx = wilder(100 * abs(pdi - mdi) / (pdi + mdi), 13)
    for name, want in (("atr", atr), ("plus_di", pdi), ("minus_di", mdi), ("adx", adx)):
        close_to(got[name], want, rtol=1e-8)


def test_rising_and_flat_series(spark):
    days = pd.date_range("2020-01-01", periods=60).date
    rising = pd.DataFrame({"ticker": "UP", "date": days, "open": 1.0, "high": 1.0, "low": 1.0, "close": np.arange(1.0, 61.0), "volume": 1})
    flat = rising.assign(ticker="FLAT", close=5.0)
    df = P.number_rows(to_spark(spark, pd.concat([rising, flat])))
    got = collected(I.compute(df, [I.rsi(), I.ema(12), I.bollinger()]), "rsi", "ema_12", "bb_std")
    up, level = got[got.ticker == "UP"], got[got.ticker == "FLAT"]
    assert (up.rsi.dropna() == 100).all() and up.rsi.isna().sum() == 13
    close_to(level.ema_12, np.full(60, 5.0))
    assert (level.rsi.dropna() == 100).all() and (level.bb_std.dropna() == 0).all()
    null_dialect = collected(I.compute(df, [I.rsi(dialect="pandas")]), "rsi")
    assert null_dialect[null_dialect.ticker == "FLAT"].rsi.isna().all()


def test_zero_price_and_volume_do_not_raise(spark):
    pdf = make_bars({"A": 40})
    pdf.loc[5:7, "close"] = 0.0
    pdf["volume"] = 0
    out = collected(I.compute(P.number_rows(to_spark(spark, pdf)), everything()), "daily_return", "volume_change", "price_volume_ratio")
    assert np.isnan(out.daily_return[6]) and out.daily_return[5] == -1.0
    assert out.volume_change.isna().all() and out.price_volume_ratio.isna().all()


@pytest.mark.parametrize("dialect", ["a", "b"])
def test_obv(spark, dialect):
    pdf = make_bars({"A": 120, "B": 1})
    pdf.loc[10, "close"] = pdf.loc[9, "close"]
    got = collected(I.with_obv(P.number_rows(to_spark(spark, pdf)), SMALL, {"obv": dialect}), "obv")
    want = []
    for _, g in pdf.groupby("ticker"):
        change = g.close.diff()
        step = np.where(change < 0, -g.volume, np.where((change > 0) | (dialect == "b"), g.volume, 0))
        want += step.cumsum().tolist()
    assert got.obv.tolist() == want


def test_same_indicator_with_other_settings_keeps_both(spark):
    df = P.number_rows(to_spark(spark, make_bars({"A": 60})))
    out = I.compute(df, I.from_spec({"rsi": [14, 7], "stochastic": [(14, 3), (5, 3)], "bollinger": [(20, 2.0), (10, 1.5)]}))
    assert {"rsi", "rsi_7", "stoch_k", "stoch_k_5_3", "bb_upper", "bb_upper_10_1_5"} <= set(out.columns)


def test_folds_and_fill_run_inside_compute(spark):
    """Small blocks, gaps and two tickers: one of them shorter than the windows."""
    pdf = make_bars({"A": 70, "B": 3})
    pdf.loc[[5, 6, 40], "volume"] = None
    df = to_spark(spark, pdf, BAR_SCHEMA.replace("bigint", "double"))
    chosen = [I.obv(), I.obv("obv_b", "b"), I.sma(5), I.macd(), I.cci()]
    made = collected(I.compute(df, chosen, SMALL), "obv", "obv_b")
    want = collected(I.with_obv(df, SMALL, {"obv": "a", "obv_b": "b"}), "obv", "obv_b")
    close_to(made[["obv", "obv_b"]], want[["obv", "obv_b"]])
    names = ["volume", "obv", "sma_5", "macd_signal", "cci"]
    plain = collected(I.compute(df, chosen, SMALL), *names)
    filled = plain.groupby("ticker")[names].transform(lambda x: x.ffill().bfill()).fillna(0)
    for staged in (False, True):
        got = collected(I.compute(df, chosen, SMALL, fill=True, staged=staged), *names)
        close_to(got[names], filled)
