"""Models, evaluation and forecasting M1-M17, with F13 and F14."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tickloom.operators import evaluate as V
from tickloom.operators import features as E
from tickloom.operators import forecast as C
from tickloom.operators import indicators as I
from tickloom.operators import joins as J
from tickloom.operators import models as M
from tickloom.operators import panel as P
from tickloom.plans import sql as S
from tickloom.plans.registry import query, rounded
from tickloom.plans.sources import fresh
from tickloom.session import publish_once
from tickloom.sources import fixtures as X

BASE = ("ticker", "date")
FEATURES = ["daily_return", "rsi", "hl_range", "volume", "price_to_ma5", "price_to_ma20", "momentum_5", "volatility_10"]


def feature_table(spark, sf):
    """The stored feature panel: indicators, next return and direction, chronological split."""
    def build():
        chosen = [I.returns(), I.rsi(), I.gap_and_range(), I.price_to_ma(5), I.price_to_ma(20), I.momentum(5), I.volatility(10)]
        out = E.step_targets(I.compute(X.bars(spark, sf), chosen), 1)
        out = E.chronological_split(out, (("train", 0.8),))
        return out.where(F.col("target_1d").isNotNull()).na.drop(subset=FEATURES).select(
            *BASE, "pos", "close", *FEATURES, "target_1d", "target_return_1d", "target_direction", "split")
    return publish_once(spark, sf, "features", build)


def parts(spark, sf, label):
    df = feature_table(spark, sf).withColumn("label", F.col(label).cast("double"))
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")


def _fit_and_score(kind, task):
    label = "target_return_1d" if task == "regression" else "target_direction"

    def run(spark, sf):
        train, test = parts(spark, sf, label)
        model = M.pipeline(kind, task, FEATURES).fit(train)
        out = M.score(model, test, task != "regression")
        return out.select(*BASE, "label", "prediction", *(["score"] if task != "regression" else []))
    return run


for _id, _kind in (("m1", "random_forest"), ("m2", "gradient_boosted"), ("m3", "linear")):
    for _task in ("regression", "classification"):
        query(f"{_id}_{_kind}_{_task}")(_fit_and_score(_kind, _task))


_USED = f"""WITH {S.BARS}, f AS (SELECT ticker, date, row_number() OVER {S.W} - 1 AS pos, count(*) OVER (PARTITION BY ticker) AS n,
 lead(close) OVER {S.W} / close - 1 AS y, CASE WHEN lead(close) OVER {S.W} > close THEN 1.0::DOUBLE ELSE 0 END AS up FROM bars),
 u AS (SELECT *, pos < floor(n * 0.8::DOUBLE) AS train FROM f WHERE pos >= 19 AND y IS NOT NULL)"""


def _single_leaf(kind, **settings):
    """Models without a split say the mean of the training labels, in every row held out."""
    def run(spark, sf):
        out = None
        for task, label in (("regression", "target_return_1d"), ("classification", "target_direction")):
            if kind == "gradient_boosted" and task == "classification":
                continue
            train, test = parts(spark, sf, label)
            scored = M.score(M.pipeline(kind, task, FEATURES, maxDepth=0, **settings).fit(train), test, task != "regression")
            value = F.col("prediction" if task == "regression" else "score")
            rows = scored.select(*BASE, F.lit(task).alias("task"), F.round(value, 8).alias("value"))
            out = rows if out is None else out.unionByName(rows)
        return out
    return run


_LEAF = _USED + """, m AS (SELECT avg(y) AS y, avg(up) AS up FROM u WHERE train)
 SELECT ticker, date, 'regression' AS task, round(m.y, 8) AS value FROM u, m WHERE NOT train"""
query("m1_single_leaf", _LEAF + " UNION ALL SELECT ticker, date, 'classification', round(m.up, 8) FROM u, m WHERE NOT train")(
    _single_leaf("random_forest", numTrees=1, bootstrap=False))
query("m2_single_leaf", _LEAF)(_single_leaf("gradient_boosted", maxIter=1))


@query("m3_mean_identities", _USED + """ SELECT ticker, 'regression' AS task, count(*) AS n, 0.0::DOUBLE AS surplus FROM u WHERE train GROUP BY ticker
 UNION ALL SELECT ticker, 'classification', count(*), 0.0 FROM u WHERE train GROUP BY ticker""")
def m3_means(spark, sf):
    """With an indicator of each ticker among the features, fits without penalty have no surplus over the labels of any ticker."""
    out = None
    for task, label in (("regression", "target_return_1d"), ("classification", "target_direction")):
        train, _ = parts(spark, sf, label)
        tickers = [r[0] for r in X.bars(spark, sf).select("ticker").distinct().orderBy("ticker").limit(5).collect()]
        train = train.withColumns({f"is_{i}": (F.col("ticker") == t).cast("double") for i, t in enumerate(tickers)})
        names = ["daily_return", *[f"is_{i}" for i in range(1, len(tickers))]]
        scored = M.score(M.pipeline("linear", task, names).fit(train), train, task != "regression")
        surplus = F.avg(F.col("prediction" if task == "regression" else "score") - F.col("label"))
        rows = scored.groupBy("ticker").agg(F.count("*").alias("n"), F.round(surplus, 3 if task != "regression" else 8).alias("surplus"))
        rows = rows.select("ticker", F.lit(task).alias("task"), "n", (F.col("surplus") + 0.0).alias("surplus"))
        out = rows if out is None else out.unionByName(rows)
    return out


_ONE = f"""WITH {S.BARS}, f AS (SELECT ticker, date, row_number() OVER {S.W} - 1 AS pos, count(*) OVER (PARTITION BY ticker) AS n,
 close / lag(close) OVER {S.W} - 1 AS x, lead(close) OVER {S.W} / close - 1 AS y FROM bars),
 u AS (SELECT * FROM f WHERE pos >= 19 AND y IS NOT NULL),
 r AS (SELECT regr_intercept(y, x) AS c, regr_slope(y, x) AS a FROM u WHERE pos < floor(n * 0.8::DOUBLE))
 SELECT ticker, date, round(y, 6) AS label, round(c + a * x, 6) AS prediction FROM u, r WHERE pos >= floor(n * 0.8::DOUBLE)"""


@query("m3_one_feature", _ONE)
def m3_one(spark, sf):
    train, test = parts(spark, sf, "target_return_1d")
    model = M.pipeline("linear", "regression", ["daily_return"]).fit(train)
    return M.score(model, test).select(*BASE, *rounded(6, "label", "prediction"))


@query("m4_ranking_metrics", f"""WITH {S.CLF}, c AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM clf GROUP BY score),
 r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM c WINDOW w AS (ORDER BY score DESC)),
 p AS (SELECT *, tp / (tp + fp) AS prec FROM r), q AS (SELECT *, lag(prec) OVER (ORDER BY score DESC) AS prec0 FROM p)
 SELECT round(sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)), 8) AS auc_roc, round(sum(pos * (prec + coalesce(prec0, prec)) / 2) / sum(pos), 8) AS auc_pr,
 (SELECT round(avg(CAST(label = prediction AS INTEGER)), 8) FROM clf) AS accuracy FROM q""")
def m4(spark, sf):
    clf = X.classifier_scores(spark, sf)
    accuracy = clf.agg(F.round(F.avg((F.col("label") == F.col("prediction")).cast("int")), 8).alias("accuracy"))
    return V.ranking_metrics(clf).select(*rounded(8, "auc_roc", "auc_pr"), accuracy.scalar().alias("accuracy"))


@query("m4_model_metrics")
def m4_models(spark, sf):
    """Ranking and classification metrics of a fitted model on the held-out rows."""
    train, test = parts(spark, sf, "target_direction")
    scored = M.score(M.pipeline("linear", "classification", FEATURES).fit(train), test, True)
    return V.ranking_metrics(scored, ["ticker"]).join(V.classification_metrics(scored, ["ticker"]), "ticker")


@query("m5_classification_metrics", f"""WITH {S.CLF}, k AS (SELECT DISTINCT label AS c FROM clf UNION SELECT DISTINCT prediction FROM clf),
 s AS (SELECT c, (SELECT count(*) FROM clf WHERE label = c) AS a, (SELECT count(*) FROM clf WHERE prediction = c) AS g,
 (SELECT count(*) FROM clf WHERE label = c AND prediction = c) AS tp FROM k)
 SELECT round(sum(tp) / sum(a), 8) AS accuracy, round(sum(a * coalesce(tp / nullif(g, 0), 0)) / sum(a), 8) AS precision,
 round(sum(a * coalesce(tp / nullif(a, 0), 0)) / sum(a), 8) AS recall, round(sum(a * coalesce(2 * tp / nullif(a + g, 0), 0)) / sum(a), 8) AS f1 FROM s""")
def m5(spark, sf):
    return V.classification_metrics(X.classifier_scores(spark, sf)).select(*rounded(8, "accuracy", "precision", "recall", "f1"))


@query("m6_regression_metrics", f"""WITH {S.PREDS} SELECT model, ticker, count(*) AS n, round(avg((actual - predicted) ** 2), 0) AS mse,
 round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse, round(avg(abs(actual - predicted)), 4) AS mae,
 round(1 - avg((actual - predicted) ** 2) / var_pop(actual), 8) AS r2 FROM preds GROUP BY 1, 2""")
def m6(spark, sf):
    df = V.regression_metrics(X.predictions(spark, sf), ["model", "ticker"])
    return df.select("model", "ticker", "n", *rounded(0, "mse"), *rounded(4, "rmse", "mae"), *rounded(8, "r2"))


_W = "(PARTITION BY model, ticker ORDER BY date)"
_RUN = "(PARTITION BY model, ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("m7_backtest", f"""WITH {S.PREDS}, r AS (SELECT model, ticker, date, row_number() OVER {_W} AS rn,
 coalesce(actual / lag(actual) OVER {_W} - 1, 0) AS a, coalesce(predicted / lag(predicted) OVER {_W} - 1, 0) AS p FROM preds),
 s AS (SELECT *, CASE WHEN p > 0 THEN a ELSE 0 END AS s FROM r),
 e AS (SELECT *, sum(ln(1 + s)) OVER {_RUN} AS le FROM s), k AS (SELECT *, max(le) OVER {_RUN} AS lp FROM e)
 SELECT model, ticker, count(*) AS n, round(100 * (exp(arg_max(le, date)) - 1), 4) AS total_return,
 round(100 * (exp(arg_max(le, date) * 252 / count(*)) - 1), 4) AS annualized_return,
 round(avg(s) FILTER (rn > 1) / nullif(stddev_pop(s) FILTER (rn > 1), 0) * sqrt(252), 6) AS sharpe_ratio,
 round(100 * max(1 - exp(le - lp)), 6) AS max_drawdown,
 round(coalesce(100 * count(*) FILTER (s > 0) / nullif(count(*) FILTER (p <> 0), 0), 0), 6) AS win_rate FROM k GROUP BY 1, 2""")
def m7(spark, sf):
    df = V.backtest(X.predictions(spark, sf), X.SERIES)
    return df.select("model", "ticker", "n", *rounded(4, "total_return", "annualized_return"),
                     *rounded(6, "sharpe_ratio", "max_drawdown", "win_rate"))


@query("m7_backtest_returns", f"""WITH {S.PREDS}, g AS (SELECT model, ticker, date, actual / lag(actual) OVER {_W} - 1 AS a, predicted / lag(predicted) OVER {_W} - 1 AS p FROM preds),
 r AS (SELECT *, row_number() OVER {_W} AS rn FROM g WHERE a IS NOT NULL), s AS (SELECT *, CASE WHEN p > 0 THEN a ELSE 0 END AS s FROM r),
 e AS (SELECT *, sum(ln(1 + s)) OVER {_RUN} AS le FROM s), k AS (SELECT *, max(le) OVER {_RUN} AS lp FROM e)
 SELECT model, ticker, count(*) AS n, round(100 * (exp(arg_max(le, date)) - 1), 4) AS total_return,
 round(100 * (exp(arg_max(le, date) * 252 / count(*)) - 1), 4) AS annualized_return,
 round(avg(s) FILTER (rn > 1) / nullif(stddev_pop(s) FILTER (rn > 1), 0) * sqrt(252), 6) AS sharpe_ratio,
 round(100 * max(1 - exp(le - lp)), 6) AS max_drawdown,
 round(coalesce(100 * count(*) FILTER (s > 0) / nullif(count(*) FILTER (p <> 0), 0), 0), 6) AS win_rate FROM k GROUP BY 1, 2""")
def m7_returns(spark, sf):
    """Actual and predicted returns instead of prices."""
    moved = P.windowed(P.number_rows(X.predictions(spark, sf).drop("pos"), X.SERIES), X.SERIES, [lambda w: [
        P.pct_change(F.col(c), F.lag(c, 1).over(w)).alias(f"__{c}") for c in ("actual", "predicted")]], before=1)
    known = moved.where("__actual is not null").select("model", *BASE, F.col("__actual").alias("actual"), F.col("__predicted").alias("predicted"))
    df = V.backtest(known, X.SERIES, prices=False)
    return df.select("model", "ticker", "n", *rounded(4, "total_return", "annualized_return"),
                     *rounded(6, "sharpe_ratio", "max_drawdown", "win_rate"))


@query("m8_feature_importance")
def m8(spark, sf):
    train, _ = parts(spark, sf, "target_direction")
    return M.importance(M.pipeline("random_forest", "classification", FEATURES, numTrees=20).fit(train), FEATURES)


_ONE_FITS = _ONE[:_ONE.rindex(" SELECT ticker")]


@query("m8_linear_importance", _ONE_FITS + " SELECT 'daily_return' AS feature, round(a, 8) AS importance FROM r")
def m8_linear(spark, sf):
    train, _ = parts(spark, sf, "target_return_1d")
    out = M.importance(M.pipeline("linear", "regression", ["daily_return"]).fit(train), ["daily_return"])
    return out.select("feature", *rounded(8, "importance"))


@query("m9_saved_model", _ONE)
def m9(spark, sf):
    train, test = parts(spark, sf, "target_return_1d")
    path, features = fresh(spark, "m9"), ["daily_return"]
    M.save_model(M.pipeline("linear", "regression", features).fit(train), path, features, "label", kind="linear")
    model, meta = M.load_model(path)
    scored = M.score(model, test.select(*BASE, *meta["features"], meta["label"]))
    return scored.select(*BASE, *rounded(6, "label", "prediction"))


@query("m10_ensemble", f"""WITH {S.PREDS}, w AS (SELECT ticker, date, actual, max(CASE WHEN model = 'a' THEN predicted END) AS a,
 max(CASE WHEN model = 'b' THEN predicted END) AS b FROM preds GROUP BY 1, 2, 3)
 SELECT ticker, date, round((a + b) / 2, 4) AS average, round(a * 0.25::DOUBLE + b * 0.75::DOUBLE, 4) AS weighted FROM w""")
def m10(spark, sf):
    wide = J.align_models(X.predictions(spark, sf), ["a", "b"])
    both = V.ensemble(V.ensemble(wide, models=["a", "b"], out="average"), {"a": 1.0, "b": 3.0}, out="weighted")
    return both.select(*BASE, *rounded(4, "average", "weighted"))


@query("m10_ensemble_class", f"""WITH {S.CLF} SELECT doc_id, CAST(0.4::DOUBLE * score + 0.6::DOUBLE * prediction > 0.5 AS INTEGER) AS ensemble FROM clf""")
def m10_class(spark, sf):
    wide = X.classifier_scores(spark, sf).select("doc_id", F.col("score").alias("pred_a"), F.col("prediction").alias("pred_b"))
    return V.ensemble(wide, {"a": 0.4, "b": 0.6}, classify=True).select("doc_id", "ensemble")


@query("m10_ensemble_forecast", f"""WITH RECURSIVE {S.BARS}, l AS (SELECT ticker, close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS r FROM bars),
 s AS (SELECT ticker, max(close) FILTER (r = 1) AS y1, max(close) FILTER (r = 2) AS y2 FROM l WHERE r <= 2 GROUP BY ticker),
 f AS (SELECT ticker, 0 AS step, y1, y2, y1 AS z FROM s
  UNION ALL SELECT ticker, step + 1, 0.5::DOUBLE * y1 + 0.25::DOUBLE * y2, y1, 100 + 0.75::DOUBLE * z FROM f WHERE step < 10)
 SELECT ticker, step, round(0.75::DOUBLE * y1 + 0.25::DOUBLE * z, 3) AS predicted FROM f WHERE step > 0""")
def m10_forecast(spark, sf):
    start = C.last_values(X.bars(spark, sf), "close", 2)
    a = C.recursive_forecast(start, F.lit(0.0), F.array(F.lit(0.5), F.lit(0.25)), 10)
    b = C.recursive_forecast(start, F.lit(100.0), F.array(F.lit(0.75), F.lit(0.0)), 10)
    both = a.withColumn("model", F.lit("a")).unionByName(b.withColumn("model", F.lit("b")))
    return V.combine_forecasts(both, {"a": 3.0, "b": 1.0}).select("ticker", "step", *rounded(3, "predicted"))


@query("m11_stacking")
def m11(spark, sf):
    train, test = parts(spark, sf, "target_return_1d")
    bases = {"linear": M.pipeline("linear", "regression", FEATURES),
             "forest": M.pipeline("random_forest", "regression", FEATURES, numTrees=10, maxDepth=5)}
    return M.stack(train, test, bases).select(*BASE, "label", "prediction")


@query("m12_model_comparison")
def m12(spark, sf):
    train, test = parts(spark, sf, "target_return_1d")
    return M.compare(train, test, {
        "linear": M.pipeline("linear", "regression", FEATURES),
        "forest": M.pipeline("random_forest", "regression", FEATURES, numTrees=20, maxDepth=5),
        "boosted": M.pipeline("gradient_boosted", "regression", FEATURES, maxIter=5)})


@query("m12_comparison_metrics", _ONE_FITS + """, e AS (SELECT y, c + a * x - y AS e FROM u, r WHERE pos >= floor(n * 0.8::DOUBLE))
 SELECT 'one' AS model, count(*) AS n, round(avg(e * e), 8) AS mse, round(sqrt(avg(e * e)), 8) AS rmse, round(avg(abs(e)), 8) AS mae,
 round(1 - avg(e * e) / var_pop(y), 8) AS r2 FROM e""")
def m12_metrics(spark, sf):
    train, test = parts(spark, sf, "target_return_1d")
    out = M.compare(train, test, {"one": M.pipeline("linear", "regression", ["daily_return"])})
    return out.select("model", "n", *rounded(8, "mse", "rmse", "mae", "r2"))


_GRAM = """g AS (SELECT ticker, w, lag(w, 1) OVER (PARTITION BY ticker ORDER BY date) AS x1, lag(w, 2) OVER (PARTITION BY ticker ORDER BY date) AS x2
 FROM (SELECT ticker, date, close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS w FROM bars))"""


@query("m13_gram_matrix", f"""WITH {S.BARS}, {_GRAM}, f AS (SELECT * FROM g WHERE w IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL)
 SELECT ticker, count(*) AS n, round(sum(x1) / 1e6, 4) AS s_1, round(sum(x2) / 1e6, 4) AS s_2, round(sum(x1 * x1) / 1e12, 4) AS s_11,
 round(sum(x1 * x2) / 1e12, 4) AS s_12, round(sum(x2 * x2) / 1e12, 4) AS s_22, round(sum(x1 * w) / 1e12, 4) AS s_1y, round(sum(x2 * w) / 1e12, 4) AS s_2y,
 round(sum(w * w) / 1e12, 4) AS s_yy FROM f GROUP BY ticker""")
def m13_gram(spark, sf):
    g = C.arma_gram(X.bars(spark, sf), *C.difference_levels("close", 1), 2, 0, P.BARS)
    x, y = F.col("xtx"), F.col("xty")
    big = {"s_11": x[3], "s_12": x[4], "s_22": x[5], "s_1y": y[1], "s_2y": y[2], "s_yy": F.col("yty")}
    return g.select("ticker", "n", F.round(x[1] / 1e6, 4).alias("s_1"), F.round(x[2] / 1e6, 4).alias("s_2"),
                    *[F.round(c / 1e12, 4).alias(n) for n, c in big.items()])


@query("m13_ar1", f"""WITH {S.BARS}, g AS (SELECT ticker, close AS w, lag(close) OVER {S.W} AS x FROM bars)
 SELECT ticker, CAST(regr_count(w, x) AS BIGINT) AS n, round(regr_intercept(w, x), 3) AS intercept, round(regr_slope(w, x), 8) AS slope FROM g GROUP BY ticker""")
def m13_ar1(spark, sf):
    fit = C.fit_arima(X.bars(spark, sf), "close", 1, 0, 0)
    return fit.select("ticker", "n", *rounded(3, "intercept"), F.round(F.col("ar")[0], 8).alias("slope"))


def _lag_fit(w):
    return f"""WITH {S.BARS}, d AS (SELECT ticker, date, {w} AS w FROM bars), g AS (SELECT ticker, w, lag(w) OVER {S.W} AS x FROM d)
 SELECT ticker, CAST(regr_count(w, x) AS BIGINT) AS n, round(regr_intercept(w, x), 3) AS intercept, round(regr_slope(w, x), 8) AS slope FROM g GROUP BY ticker"""


def _fitted_lag(fit):
    return fit.select("ticker", "n", *rounded(3, "intercept"), F.round(F.col("ar")[0], 8).alias("slope"))


@query("m13_ar_of_differences", _lag_fit(f"close - lag(close) OVER {S.W}"))
def m13_differences(spark, sf):
    return _fitted_lag(C.fit_arima(X.bars(spark, sf), "close", 1, 1, 0))


@query("m17_seasonal_ar", _lag_fit(f"close - lag(close, 5) OVER {S.W}"))
def m17_ar(spark, sf):
    return _fitted_lag(C.fit_arima(X.bars(spark, sf), "close", 1, 0, 0, seasonal=1, season=5))


@query("m13_arima")
def m13(spark, sf):
    return C.fit_arima(X.bars(spark, sf), "close", 3, 1, 2)


@query("m13_forecast")
def m13_forecast(spark, sf):
    bars = X.bars(spark, sf)
    return C.forecast_arima(bars, C.fit_arima(bars, "close", 5, 1, 0), 5, 1, 30)


_AR1 = f"""WITH {S.BARS}, g AS (SELECT ticker, close AS w, lag(close) OVER {S.W} AS x FROM bars),
 r AS (SELECT ticker, regr_intercept(w, x) AS c, regr_slope(w, x) AS a FROM g GROUP BY ticker)"""


@query("m13_ar1_forecast", _AR1.replace("WITH bars", "WITH RECURSIVE bars") + """, s AS (SELECT ticker, arg_max(close, date) AS y FROM bars GROUP BY ticker),
 f AS (SELECT ticker, 0 AS step, y FROM s UNION ALL SELECT f.ticker, step + 1, c + a * y FROM f JOIN r USING (ticker) WHERE step < 15)
 SELECT ticker, step, round(y, 3) AS predicted FROM f WHERE step > 0""")
def m13_ar1_forecast(spark, sf):
    bars = X.bars(spark, sf)
    df = C.forecast_arima(bars, C.fit_arima(bars, "close", 1, 0, 0), 1, 0, 15)
    return df.select("ticker", "step", *rounded(3, "predicted"))


@query("m14_grid_search")
def m14(spark, sf):
    return C.grid_search(X.bars(spark, sf)).select("ticker", "p", "d", "q", "n", "aic", "bic", "is_best")


@query("m14_grid_search_short", f"""WITH {S.BARS}, t AS (SELECT DISTINCT ticker FROM bars UNION ALL SELECT 'SHORT'), o AS (SELECT ticker, p.i AS p, d.i AS d, q.i AS q
 FROM t, range(3) p(i), range(2) d(i), range(2) q(i))
 SELECT ticker, CAST(p AS INTEGER) AS p, CAST(d AS INTEGER) AS d, CAST(q AS INTEGER) AS q, ticker <> 'SHORT' OR q = 0 AS fitted,
 CASE WHEN ticker = 'SHORT' AND q > 0 THEN 'too few rows for residuals' END AS reason, CAST(1 AS BIGINT) AS n_best FROM o""")
def m14_short(spark, sf):
    """A ticker of twelve rows beside the others: its autoregressive orders are fitted, the rest say why not."""
    bars = X.bars(spark, sf).select(*BASE, "pos", "close")
    short = bars.where("pos < 12 AND ticker = '1-URGENT'")
    df = C.grid_search(bars.unionByName(short.withColumn("ticker", F.lit("SHORT"))), max_p=2, max_d=1, max_q=1)
    best = df.groupBy("ticker").agg(F.count_if("is_best").alias("n_best"))
    return df.join(best, "ticker").select("ticker", "p", "d", "q", F.col("aic").isNotNull().alias("fitted"), "reason", "n_best")


@query("m14_best_is_least", f"""WITH {S.BARS} SELECT DISTINCT ticker, CAST(108 AS BIGINT) AS n_orders, CAST(1 AS BIGINT) AS n_best, true AS least FROM bars""")
def m14_least(spark, sf):
    df = C.grid_search(X.bars(spark, sf))
    return df.groupBy("ticker").agg(F.count("aic").alias("n_orders"), F.count_if("is_best").alias("n_best"),
                                    (F.max(F.when(F.col("is_best"), F.col("aic"))) == F.min("aic")).alias("least"))


@query("m13_hold_out", f"""WITH RECURSIVE {S.BARS}, q AS (SELECT ticker, date, close, row_number() OVER {S.W} - 1 AS pos, count(*) OVER (PARTITION BY ticker) AS n FROM bars),
 t AS (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS x FROM q WHERE pos < floor(n * 0.8::DOUBLE)),
 r AS (SELECT ticker, regr_intercept(close, x) AS c, regr_slope(close, x) AS a, arg_max(close, pos) AS y, max(pos) AS last FROM t GROUP BY ticker),
 f AS (SELECT ticker, 0 AS step, y FROM r UNION ALL SELECT f.ticker, step + 1, c + a * f.y FROM f JOIN r USING (ticker) WHERE step < 10)
 SELECT f.ticker, q.date, CAST(f.step AS INTEGER) AS step, q.close AS actual, round(f.y, 3) AS predicted FROM f JOIN r USING (ticker) JOIN q ON q.ticker = f.ticker AND q.pos = r.last + f.step WHERE f.step > 0""")
def m13_hold_out(spark, sf):
    df = C.hold_out_forecast(X.bars(spark, sf), "close", 1, 0, 0.8, 10)
    return df.select(*BASE, "step", "actual", *rounded(3, "predicted"))


_SEARCH = ", ".join(f"""s{d} AS (SELECT ticker, w, lag(w) OVER (PARTITION BY ticker ORDER BY date) AS x FROM ({src}))""" for d, src in (
    (0, "SELECT ticker, date, close AS w FROM bars"), (1, f"SELECT ticker, date, close - lag(close) OVER {S.W} AS w FROM bars")))
_FITS = " UNION ALL ".join(f"""SELECT ticker, {p} AS p, {d} AS d, count(*) AS n, {'regr_syy(w, x) * (1 - regr_r2(w, x))' if p else 'var_pop(w) * count(*)'} AS rss
 FROM s{d} WHERE w IS NOT NULL AND x IS NOT NULL GROUP BY ticker""" for d in (0, 1) for p in (0, 1))


@query("m14_grid_search_ar", f"""WITH {S.BARS}, {_SEARCH}, f AS ({_FITS}), a AS (SELECT *, n * ln(rss / n) + 2 * (p + 1) AS aic, n * ln(rss / n) + ln(n) * (p + 1) AS bic FROM f)
 SELECT ticker, p, d, n, round(aic, 4) AS aic, round(bic, 4) AS bic, aic = min(aic) OVER (PARTITION BY ticker) AS is_best FROM a""")
def m14_ar(spark, sf):
    df = C.grid_search(X.bars(spark, sf), max_p=1, max_d=1, max_q=0)
    return df.select("ticker", "p", "d", "n", *rounded(4, "aic", "bic"), "is_best")


@query("m15_dickey_fuller", f"""WITH {S.BARS}, g AS (SELECT ticker, close - lag(close) OVER {S.W} AS w, lag(close) OVER {S.W} AS x FROM bars),
 r AS (SELECT ticker, CAST(regr_count(w, x) AS BIGINT) AS n, regr_slope(w, x) AS b, regr_syy(w, x) * (1 - regr_r2(w, x)) AS rss, regr_sxx(w, x) AS sxx FROM g GROUP BY ticker)
 SELECT ticker, n, round(b / sqrt(rss / (n - 2) / sxx), 6) AS adf_statistic, b / sqrt(rss / (n - 2) / sxx) < -2.86 AS is_stationary FROM r""")
def m15_simple(spark, sf):
    return C.stationarity(X.bars(spark, sf), lags=0).select("ticker", "n", *rounded(6, "adf_statistic"), "is_stationary")


@query("m15_stationarity")
def m15(spark, sf):
    return C.stationarity(X.bars(spark, sf))


@query("m16_recursive_forecast", f"""WITH RECURSIVE {S.BARS}, l AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS r FROM bars),
 s AS (SELECT ticker, max(date) AS d, max(close) FILTER (r = 1) AS y1, max(close) FILTER (r = 2) AS y2, max(close) FILTER (r = 3) AS y3 FROM l WHERE r <= 3 GROUP BY ticker),
 f AS (SELECT ticker, d, 0 AS step, y1, y2, y3 FROM s
  UNION ALL SELECT ticker, d, step + 1, 1000.0::DOUBLE + 0.5::DOUBLE * y1 + 0.3::DOUBLE * y2 + 0.1::DOUBLE * y3, y1, y2 FROM f WHERE step < 20),
 c AS (SELECT ticker, CAST(unnest(generate_series(d + 1, d + 44, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
 b AS (SELECT ticker, day, CAST(row_number() OVER (PARTITION BY ticker ORDER BY day) AS INTEGER) AS step FROM c WHERE isodow(day) < 6)
 SELECT f.ticker, b.step, b.day AS forecast_date, round(y1, 4) AS predicted FROM f JOIN b ON f.ticker = b.ticker AND f.step = b.step""")
def m16(spark, sf):
    start = C.last_values(X.bars(spark, sf), "close", 3)
    weights = F.array(F.lit(0.5), F.lit(0.3), F.lit(0.1))
    df = C.recursive_forecast(start, F.lit(1000.0), weights, 20)
    return df.select("ticker", "step", "forecast_date", *rounded(4, "predicted"))


_NEXT_DAY = "CASE WHEN isodow(d) = 5 THEN d + 3 WHEN isodow(d) = 6 THEN d + 2 ELSE d + 1 END"


@query("m16_fitted_forecast", f"""WITH RECURSIVE {S.BARS}, f AS (SELECT ticker, date, close, row_number() OVER {S.W} - 1 AS pos, count(*) OVER (PARTITION BY ticker) AS n,
 close / lag(close) OVER {S.W} - 1 AS x, lead(close) OVER {S.W} / close - 1 AS y FROM bars),
 u AS (SELECT * FROM f WHERE pos >= 19 AND y IS NOT NULL),
 r AS (SELECT regr_intercept(y, x) AS c, regr_slope(y, x) AS a FROM u WHERE pos < floor(n * 0.8::DOUBLE)),
 s AS (SELECT ticker, date AS d, close AS y1, x, 0 AS step FROM f WHERE pos = n - 1
  UNION ALL SELECT ticker, {_NEXT_DAY}, y1 * (1 + (c + a * x)), c + a * x, step + 1 FROM s, r WHERE step < 5)
 SELECT ticker, 'linear' AS model, CAST(step AS INTEGER) AS step, CAST(d AS DATE) AS forecast_date, round(y1, 2) AS predicted FROM s WHERE step > 0""")
def m16_fitted(spark, sf):
    """A fitted pipeline's predicted returns become bars, from which its feature is made again."""
    train, _ = parts(spark, sf, "target_return_1d")
    model = M.pipeline("linear", "regression", ["daily_return"]).fit(train)
    df = C.iterated_forecast(X.bars(spark, sf), {"linear": model}, [I.returns()], steps=5, rows=30)
    return df.select("ticker", "model", "step", "forecast_date", *rounded(2, "predicted"))


@query("m17_seasonal_difference", f"""WITH {S.BARS}, s AS (SELECT ticker, date, close - lag(close, 5) OVER {S.W} AS v FROM bars)
 SELECT ticker, date, round(v - lag(v) OVER {S.W}, 4) AS w FROM s""")
def m17(spark, sf):
    return C.difference(X.bars(spark, sf), "close", 1, 1, 5).select(*BASE, *rounded(4, "w"))


@query("m17_seasonal_arima")
def m17_fit(spark, sf):
    return C.fit_arima(X.bars(spark, sf), "close", 2, 1, 1, seasonal=1, season=5)


@query("f13_principal_components")
def f13(spark, sf):
    df = feature_table(spark, sf)
    return M.principal_components(df.select(*BASE, *FEATURES), FEATURES, 5).select(*BASE, *[f"PCA_{i}" for i in range(1, 6)])


@query("f13_two_components", f"""WITH {S.BARS}, m AS (SELECT avg(close) AS mc, stddev_samp(close) AS sc, avg(volume) AS mv, stddev_samp(volume) AS sv,
 sign(corr(close, volume)) AS r FROM bars), z AS (SELECT ticker, date, (close - mc) / sc AS a, r * (volume - mv) / sv AS b FROM bars, m)
 SELECT ticker, date, round((a + b) ** 2 / 2, 6) AS first, round((a - b) ** 2 / 2, 6) AS second FROM z""")
def f13_two(spark, sf):
    """Two standardised features turn by 45 degrees; squares, since the sign of a component is free."""
    df = M.principal_components(X.bars(spark, sf).select(*BASE, "close", "volume"), ["close", "volume"], 2)
    return df.select(*BASE, *[F.round(F.col(f"PCA_{i}") ** 2, 6).alias(n) for i, n in ((1, "first"), (2, "second"))])


@query("f14_assembled_features", f"""WITH {S.BARS}, t AS (SELECT *, lead(close) OVER {S.W} AS nxt FROM bars)
 SELECT ticker, date, CAST(to_json([open, high, low, close, volume::DOUBLE]) AS VARCHAR) AS features, CASE WHEN nxt > close THEN 1 ELSE 0 END AS label FROM t""")
def f14(spark, sf):
    df = E.step_targets(X.bars(spark, sf), 5)
    return M.training_frame(df).select(*BASE, F.to_json(vector_to_array("features")).alias("features"), "label")
