import datetime

import numpy as np
import pytest
from helpers import SMALL, close_to

from tickloom.operators import forecast as C
from tickloom.operators import panel as P


def series_frame(spark, series):
    rows = [(k, datetime.date(2000, 1, 1) + datetime.timedelta(i), float(v)) for k, xs in series.items() for i, v in enumerate(xs)]
    return P.number_rows(spark.createDataFrame(rows, "ticker string, date date, close double"), SMALL)


def simulate(n, ar=(), ma=(), seed=0, c=0.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 50)
    w = np.zeros(n + 50)
    for t in range(5, n + 50):
        w[t] = c + sum(a * w[t - 1 - i] for i, a in enumerate(ar)) + e[t] + sum(m * e[t - 1 - i] for i, m in enumerate(ma))
    return w[50:]


@pytest.fixture(scope="module")
def df(spark):
    return series_frame(spark, {"AR": 100 + simulate(700, (0.6, -0.3), seed=1), "ARMA": 50 + simulate(900, (0.5,), (0.4,), seed=2),
                                "WALK": 20 + np.cumsum(simulate(400, seed=3)), "FLAT": np.full(50, 7.0), "SHORT": [1.0, 2.0]}).cache()


def test_ar_equals_least_squares(spark, df):
    fit = C.fit_arima(df, "close", 2, 0, 0, SMALL).where("ticker = 'AR'").first()
    y = np.array([r["close"] for r in df.where("ticker = 'AR'").orderBy("date").collect()])
    x = np.column_stack([np.ones(len(y) - 2), y[1:-1], y[:-2]])
    coef, rss, *_ = np.linalg.lstsq(x, y[2:], rcond=None)
    close_to([fit["intercept"], *fit["ar"]], coef, rtol=1e-6)
    assert fit["rss"] == pytest.approx(float(rss[0]), rel=1e-6)


def test_moving_average_terms_are_found(df):
    fit = C.fit_arima(df, "close", 1, 0, 1, SMALL).where("ticker = 'ARMA'").first()
    assert fit["ar"][0] == pytest.approx(0.5, abs=0.12) and fit["ma"][0] == pytest.approx(0.4, abs=0.12)


def test_grid_orders_share_rows_and_one_is_best(df):
    rows = C.grid_search(df, max_p=2, max_d=1, max_q=1, panel=SMALL).collect()
    by = {}
    for r in rows:
        by.setdefault((r["ticker"], r["d"]), set()).add(r["n"])
    assert all(len(n) == 1 for n in by.values())
    best = {r["ticker"]: r for r in rows if r["is_best"]}
    assert best["AR"]["d"] == 0 and best["AR"]["p"] == 2
    assert all(best[r["ticker"]]["aic"] <= r["aic"] for r in rows if r["aic"] is not None)
    assert {r["ticker"] for r in rows} == {"AR", "ARMA", "WALK", "FLAT", "SHORT"}
    assert all(r["aic"] is None and r["ar"] is None and r["reason"] for r in rows if r["ticker"] == "SHORT")


def test_short_series_get_their_autoregressive_orders(spark):
    y = 10 + simulate(12, (0.5,), seed=4)
    df = series_frame(spark, {"LONG": 10 + simulate(200, (0.5,), seed=5), "TWELVE": y})
    rows = {(r["p"], r["q"]): r for r in C.grid_search(df, max_p=1, max_d=0, max_q=1, panel=SMALL).where("ticker = 'TWELVE'").collect()}
    x = np.column_stack([np.ones(11), y[:-1]])
    coef, rss, *_ = np.linalg.lstsq(x, y[1:], rcond=None)
    close_to([rows[1, 0]["intercept"], *rows[1, 0]["ar"]], coef, rtol=1e-6)
    assert rows[0, 0]["n"] == rows[1, 0]["n"] == 11 and rows[1, 1]["aic"] is None
    assert [rows[0, 1]["reason"], rows[0, 0]["reason"]] == ["too few rows for residuals", None]
    assert {r["ticker"] for r in C.stationarity(df, lags=12, panel=SMALL).collect()} == {"LONG", "TWELVE"}
    ahead = C.forecast_arima(df, C.fit_arima(df, "close", 12, 0, 0, SMALL), 12, 0, 3).where("ticker = 'TWELVE'").collect()
    assert len(ahead) == 3 and all(r["predicted"] is None for r in ahead)


def test_stationarity_verdicts(df):
    got = {r["ticker"]: r["is_stationary"] for r in C.stationarity(df, lags=2, panel=SMALL).collect()}
    assert got["AR"] and got["ARMA"] and not got["WALK"]


def test_differencing(spark):
    y = np.arange(40.0) ** 2 + np.tile([0, 5, 1, 2], 10)
    df = series_frame(spark, {"A": y})
    got = [r["w"] for r in C.difference(df, "close", 1, 1, 4, SMALL).orderBy("pos").collect()]
    seasonal = y[4:] - y[:-4]
    close_to(got[5:], np.diff(seasonal))
    assert got[:5] == [None] * 5


def test_forecast_follows_the_recursion(df):
    fitted = C.fit_arima(df, "close", 2, 1, 0, SMALL)
    got = C.forecast_arima(df, fitted, 2, 1, 5).where("ticker = 'AR'").orderBy("step").collect()
    fit = fitted.where("ticker = 'AR'").first()
    y = [r["close"] for r in df.where("ticker = 'AR'").orderBy("date").collect()]
    for r in got:
        w = [y[-1] - y[-2], y[-2] - y[-3]]
        y.append(y[-1] + fit["intercept"] + fit["ar"][0] * w[0] + fit["ar"][1] * w[1])
        assert r["predicted"] == pytest.approx(y[-1])
        assert r["forecast_date"].weekday() < 5


def test_iterated_forecast_makes_features_anew(spark):
    """Two models, a short series without features, and one that ends on a Friday."""
    import datetime

    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    from tickloom.operators import indicators as I
    friday = datetime.date(2024, 1, 5)
    closes = {"A": [10.0, 11.0, 12.0, 11.0, 13.0, 12.5], "B": [5.0, 4.0, 4.5], "C": [7.0]}
    rows = [(t, friday - datetime.timedelta(len(c) - 1 - k), x, x, x, x, 100) for t, c in closes.items() for k, x in enumerate(c)]
    df = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume bigint")
    models = {"up": PipelineModel([SQLTransformer(statement="SELECT *, daily_return / 2 AS prediction FROM __THIS__ WHERE daily_return IS NOT NULL")]),
              "mean": PipelineModel([SQLTransformer(statement="SELECT *, 1 - price_to_ma3 AS prediction FROM __THIS__ WHERE price_to_ma3 IS NOT NULL")])}
    got = C.iterated_forecast(df, models, [I.returns(), I.price_to_ma(3)], steps=3, rows=4).collect()
    want = {}
    for t, path in closes.items():
        for m in models:
            c, day = list(path), friday
            for step in (1, 2, 3):
                if m == "up":
                    if len(c) < 2:
                        break
                    r = (c[-1] / c[-2] - 1) / 2
                else:
                    if len(c) < 3:
                        break
                    r = 1 - c[-1] / (sum(c[-3:]) / 3)
                c.append(c[-1] * (1 + r))
                day += datetime.timedelta(3 if day.weekday() == 4 else 1)
                want[t, m, step] = (day, c[-1])
    assert {(r["ticker"], r["model"], r["step"]) for r in got} == set(want)
    for r in got:
        day, value = want[r["ticker"], r["model"], r["step"]]
        assert r["forecast_date"] == day and abs(r["predicted"] - value) < 1e-9
