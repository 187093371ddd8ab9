"""Autoregressive forecasters for many series in one job.

All regressions run on Gram matrices: one aggregate over the rows gives the sums of products
per key, and the fits of any number of orders are small dense solves on those sums. A series
is never gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickloom.operators import panel as P
from tickloom.operators.features import chronological_split, next_business_days
from tickloom.operators.frames import latest_record, latest_rows
from tickloom.operators.indicators import Indicator, compute
from tickloom.operators.models import score
from tickloom.session import publish

# Asymptotic Dickey-Fuller critical values with a constant.
ADF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def difference_levels(y: str, d: int = 0, seasonal: int = 0, season: int = 0, out: str = "w") -> tuple[list[P.Level], int]:
    """Levels for ``(1-B)^d (1-B^S)^D y`` and how many rows they look back."""
    coefficients = lag_polynomial(d, seasonal, season)
    lags = [i for i in range(1, len(coefficients)) if coefficients[i]]

    def lagged(w) -> list[Column]:
        return [F.lag(y, i).over(w).alias(f"__y{i}") for i in lags]

    def combined(w) -> list[Column]:
        total = F.col(y).cast("double")
        for i in lags:
            total = total + F.lit(float(coefficients[i])) * F.col(f"__y{i}")
        return [total.alias(out)]

    return [lagged, combined], max(lags, default=0)


def difference(df: DataFrame, y: str, d: int = 0, seasonal: int = 0, season: int = 0,
               panel: P.Panel = P.BARS, out: str = "w") -> DataFrame:
    levels, reach = difference_levels(y, d, seasonal, season, out)
    return P.drop_work_columns(P.windowed(df, panel, levels, before=reach))


def lag_polynomial(d: int, seasonal: int, season: int) -> list[float]:
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    step = np.zeros(season + 1)
    step[0], step[-1] = 1.0, -1.0
    for _ in range(seasonal):
        poly = np.convolve(poly, step)
    return poly.tolist()


def lagged_columns(columns: dict[str, int], panel: P.Panel):
    """A level with lags 1..n of each column, named ``__<column>_<lag>``."""
    return lambda w: [F.lag(c, i).over(w).alias(f"__{c}_{i}") for c, n in columns.items() for i in range(1, n + 1)]


def gram(df: DataFrame, keys: Sequence[str], y: Column, xs: Sequence[Column], *also: Column) -> DataFrame:
    """Per key: n, X'X (upper triangle by rows), X'y and y'y, with a constant as the first x.

    Rows with a NULL in y or any x are left out of every sum, so all orders share their rows. A
    key without a complete row has n = 0 and sums of 0. ``also`` are further aggregates of ``df``.
    """
    names = [f"__x{i}" for i in range(len(xs))]
    rows = df.select("*", y.cast("double").alias("__t"), *[x.cast("double").alias(n) for x, n in zip(xs, names)])
    complete = F.lit(True)
    for c in ("__t", *names):
        complete = complete & F.col(c).isNotNull()
    rows = rows.withColumn("__one", F.when(complete, F.lit(1.0)))

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(F.col("__one") * x), F.lit(0.0))

    terms = [F.col("__one"), *[F.col(n) for n in names]]
    m = len(terms)
    xtx = [total(terms[i] * terms[j]) for i in range(m) for j in range(i, m)]
    return rows.groupBy(*keys).agg(
        F.count("__one").alias("n"), F.array(*xtx).alias("xtx"),
        F.array(*[total(t * F.col("__t")) for t in terms]).alias("xty"),
        total(F.col("__t") * F.col("__t")).alias("yty"), *also)


def _matrices(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    b = np.stack(batch["xty"].to_numpy())
    m = b.shape[1]
    a = np.zeros((len(batch), m, m))
    upper = np.triu_indices(m)
    a[:, upper[0], upper[1]] = np.stack(batch["xtx"].to_numpy())
    a = np.triu(a) + np.transpose(np.triu(a, 1), (0, 2, 1))
    return a, b, batch["yty"].to_numpy(), batch["n"].to_numpy().astype(float)


def _solve(a: np.ndarray, b: np.ndarray, yty: np.ndarray, n: np.ndarray):
    """Least squares from sums of products, columns scaled to unit length first."""
    scale = np.sqrt(np.einsum("tii->ti", a))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv(a / (scale[:, :, None] * scale[:, None, :]), rcond=1e-12, hermitian=True)
    inverse = inverse / (scale[:, :, None] * scale[:, None, :])
    coef = np.einsum("tij,tj->ti", inverse, b)
    rss = yty - 2 * np.einsum("ti,ti->t", coef, b) + np.einsum("ti,tij,tj->t", coef, a, coef)
    rss = np.maximum(rss, 1e-12 * np.maximum(yty, 1e-300))
    m = b.shape[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        aic = n * np.log(rss / n) + 2 * m
        bic = n * np.log(rss / n) + m * np.log(n)
    return coef, inverse, rss, aic, bic


def fit_orders(grams: DataFrame, keys: Sequence[str], max_p: int, max_q: int,
               orders: Sequence[tuple[int, int]]) -> DataFrame:
    """Fit each (p, q) on the matching part of the full Gram matrix; one output row per key and order.

    An order that a key cannot be fitted with has NULL coefficients and figures, and ``reason`` says why.
    """
    passed = [c for c in grams.columns if c not in ("xtx", "xty", "yty", "n", "staged")]
    kinds = {f.name: f.dataType.simpleString() for f in grams.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in passed) + (
        ", p int, q int, n bigint, intercept double, ar array<double>, ma array<double>,"
        " rss double, sigma2 double, aic double, bic double, reason string")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            a, b, yty, n = _matrices(batch)
            for p, q in orders:
                use = [0, *range(1, p + 1), *range(1 + max_p, 1 + max_p + q)]
                enough = n > len(use)
                staged = batch["staged"].to_numpy(bool) if q and "staged" in batch else np.full(len(batch), True)
                fits = enough & staged
                coef, _, rss, aic, bic = _solve(a[:, use][:, :, use], b[:, use], yty, n)
                out = batch[passed].copy()
                out["p"], out["q"], out["n"] = p, q, n.astype(int)
                out["intercept"] = coef[:, 0]
                out["ar"] = [c if ok else None for c, ok in zip(coef[:, 1:p + 1], fits)]
                out["ma"] = [c if ok else None for c, ok in zip(coef[:, p + 1:], fits)]
                out["rss"], out["sigma2"], out["aic"], out["bic"] = rss, rss / np.maximum(n, 1), aic, bic
                out.loc[~fits, ["intercept", "rss", "sigma2", "aic", "bic"]] = np.nan
                out["reason"] = np.select([fits, enough], [None, "too few rows for residuals"], "too few rows")
                yield out

    return grams.mapInPandas(solve, schema)


def arma_gram(df: DataFrame, levels: Sequence[P.Level], reach: int, max_p: int, max_q: int, panel: P.Panel,
              long_order: int = 10) -> DataFrame:
    """Gram matrix of [1, lags 1..p of w, lags 1..q of the residuals], w being made by ``levels``.

    The residuals are those of a long autoregression per key, the first stage of
    Hannan-Rissanen. Its coefficients join the rows before the window pass, so each stage is
    one blocked pass and one aggregate. A key too short for it has residuals of 0 and ``staged``
    false: its autoregressive orders are fitted on all its rows.
    """
    rows = P.ensure_numbered(df, panel)
    if not max_q:
        lags = P.windowed(rows, panel, [*levels, lagged_columns({"w": max_p}, panel)], before=reach + max_p)
        return gram(lags, panel.keys, F.col("w"), [F.col(f"__w_{i}") for i in range(1, max_p + 1)])
    first = arma_gram(df, levels, reach, long_order, 0, panel)
    fitted = fit_orders(first, panel.keys, long_order, 0, [(long_order, 0)])
    rows = P.attach_table(rows, fitted.select(*panel.keys, F.col("intercept").alias("__c"), F.col("ar").alias("__ar")), panel.keys)
    expected = F.col("__c")
    for i in range(1, long_order + 1):
        expected = expected + F.col("__ar")[i - 1] * F.col(f"__w_{i}")
    deep = max(max_p, long_order)
    lags = P.windowed(rows, panel, [*levels, lagged_columns({"w": deep}, panel),
                                    lambda w: [F.when(F.col("__c").isNull(), F.lit(0.0)).otherwise(F.col("w") - expected).alias("e")],
                                    lagged_columns({"e": max_q}, panel)], before=reach + deep + max_q)
    staged = F.col("__c").isNotNull()
    residuals = [F.when(staged, F.col(f"__e_{i}")).otherwise(F.lit(0.0)) for i in range(1, max_q + 1)]
    xs = [*[F.col(f"__w_{i}") for i in range(1, max_p + 1)], *residuals]
    return gram(lags, panel.keys, F.col("w"), xs, F.max(staged).alias("staged"))


def fit_arima(df: DataFrame, y: str = "close", p: int = 5, d: int = 1, q: int = 0, panel: P.Panel = P.BARS,
              seasonal: int = 0, season: int = 0) -> DataFrame:
    """One ARIMA(p, d, q) per key, by least squares; moving-average terms by Hannan-Rissanen."""
    levels, reach = difference_levels(y, d, seasonal, season)
    grams = arma_gram(df.select(*panel.keys, *panel.order, *_pos(df, panel), y), levels, reach, p, q, panel)
    return fit_orders(grams, panel.keys, p, q, [(p, q)]).withColumn("d", F.lit(d))


def _pos(df: DataFrame, panel: P.Panel) -> list[str]:
    return [panel.pos] if panel.pos in df.columns else []


def grid_search(df: DataFrame, y: str = "close", max_p: int = 5, max_d: int = 2, max_q: int = 5,
                criterion: str = "aic", panel: P.Panel = P.BARS) -> DataFrame:
    """Every order of the grid per key, the best one marked.

    The differenced series become keys of their own, and all orders of one are fitted on
    parts of a single Gram matrix: the rows are read once per stage, not once per order. Orders
    that a key is too short for are kept, with a ``reason`` and without figures.
    """
    orders = [(p, q) for p in range(max_p + 1) for q in range(max_q + 1)]
    weights = [lag_polynomial(d, 0, 0) for d in range(max_d + 1)]
    rows = df.select(*panel.keys, *panel.order, *_pos(df, panel), y)
    wide = P.windowed(rows, panel, [
        lagged_columns({y: max_d}, panel),
        lambda w: [sum((F.lit(c) * F.col(f"__{y}_{i}") for i, c in enumerate(poly) if i), F.col(y).cast("double"))
                   .alias(f"__d{d}") for d, poly in enumerate(weights)]], before=max_d)
    stacked = F.expr(f"stack({max_d + 1}, {', '.join(f'{d}, __d{d}' for d in range(max_d + 1))}) AS (d, w)")
    series = P.Panel((*panel.keys, "d"), panel.order, panel.pos, panel.block_rows, panel.scan_rows)
    grams = arma_gram(wide.select(*panel.keys, *panel.order, panel.pos, stacked), [], 0, max_p, max_q, series)
    fitted = fit_orders(grams, series.keys, max_p, max_q, orders)
    place = F.struct(F.col(criterion), "d", "p", "q")
    best = fitted.groupBy(*panel.keys).agg(F.min(F.when(F.col(criterion).isNotNull(), place)).alias("__best"))
    chosen = F.coalesce(place == F.col("__best"), F.lit(False))
    return fitted.join(best, list(panel.keys)).withColumn("is_best", chosen).drop("__best")


def stationarity(df: DataFrame, y: str = "close", lags: int = 4, panel: P.Panel = P.BARS) -> DataFrame:
    """Augmented Dickey-Fuller t-statistic per key and the verdict at 5 %; NULL for a key with too few rows."""
    levels, reach = difference_levels(y, 1)
    rows = df.select(*panel.keys, *panel.order, *_pos(df, panel), F.col(y))
    lagged = P.windowed(rows, panel, [*levels, lagged_columns({"w": lags}, panel)], before=reach + lags)
    xs = [F.col("__y1"), *[F.col(f"__w_{i}") for i in range(1, lags + 1)]]
    grams = gram(lagged, panel.keys, F.col("w"), xs)
    keys = list(panel.keys)
    kinds = {f.name: f.dataType.simpleString() for f in grams.schema.fields}

    def statistic(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            a, b, yty, n = _matrices(batch)
            coef, inverse, rss, _, _ = _solve(a, b, yty, n)
            variance = rss / np.maximum(n - b.shape[1], 1) * inverse[:, 1, 1]
            out = batch[keys].copy()
            out["n"] = n.astype(int)
            out["adf_statistic"] = np.where((variance > 0) & (n > b.shape[1]), coef[:, 1] / np.sqrt(np.maximum(variance, 1e-300)), np.nan)
            yield out

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n bigint, adf_statistic double"
    return grams.mapInPandas(statistic, schema).withColumn(
        "is_stationary", F.col("adf_statistic") < ADF_CRITICAL["5%"])


def last_values(df: DataFrame, y: str, k: int, keys: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """The newest k values per key, newest first, with the last date; k bounds the list."""
    top = latest_rows(df.select(*keys, order, y), k, keys, order, rank="__r")
    return top.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__r", F.col(y).alias("v")))), lambda x: x["v"]).alias("lags"),
        F.max(order).alias("date"))


def recursive_forecast(start: DataFrame, intercept: Column, weights: Column, steps: int,
                       keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """Feed each prediction back as the newest lag; dated on the next business days.

    ``start`` has ``lags`` (newest first) and ``date``; ``weights`` is an array of equal length, or
    NULL for a key without a fit, whose steps are then dated and NULL.
    """
    def step(lags: Column, _: Column) -> Column:
        products = F.zip_with(F.slice(lags, F.lit(1), F.size(weights)), weights, lambda x, a: x * a)
        value = F.aggregate(products, intercept.cast("double"), lambda s, x: s + x)
        return F.concat(F.array(value), lags)

    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("lags").cast("array<double>"), step)
    values = F.when(weights.isNotNull(), F.slice(F.reverse(F.slice(path, 1, steps)), 1, steps))
    grown = start.select(*keys, "date", values.alias("values"))
    days = next_business_days(grown, steps)
    return days.select(*keys, "step", "forecast_date", F.element_at("values", F.col("step").cast("int")).alias("predicted"))


def forecast_arima(df: DataFrame, fitted: DataFrame, p: int, d: int, steps: int = 30, y: str = "close",
                   keys: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """Forecast levels from AR(p) fits on d-th differences: the differencing is multiplied into the weights."""
    poly = lag_polynomial(d, 0, 0)
    # (1 - a1 B - ... - ap B^p) · poly(B): weight i is minus its coefficient i.
    weights = []
    for i in range(1, p + d + 1):
        total = F.lit(-poly[i] if i < len(poly) else 0.0)
        for k in range(1, p + 1):
            if 0 <= i - k < len(poly) and poly[i - k]:
                total = total + F.col("ar")[k - 1] * F.lit(float(poly[i - k]))
        weights.append(total)
    start = last_values(df, y, p + d, keys, order).join(fitted, list(keys))
    start = start.withColumn("__weights", F.when(F.size("lags") == p + d, F.array(*weights).cast("array<double>")))
    return recursive_forecast(start, F.col("intercept"), F.col("__weights"), steps, keys)


def hold_out_forecast(df: DataFrame, y: str = "close", p: int = 5, d: int = 1, share: float = 0.8, horizon: int = 30,
                      panel: P.Panel = P.BARS) -> DataFrame:
    """Fit on each key's first rows, forecast the next ``horizon`` and set them beside the actual values."""
    rows = P.ensure_numbered(df, panel).select(*panel.keys, *panel.order, panel.pos, y)
    parts = chronological_split(rows, (("train", share),), panel=panel)
    train, test = parts.where("split = 'train'"), parts.where("split = 'test'")
    last = train.groupBy(*panel.keys).agg(F.max(panel.pos).alias("__last"))
    ahead = forecast_arima(train, fit_arima(train, y, p, d, 0, panel), p, d, horizon, y, panel.keys, panel.order[0])
    placed = ahead.join(last, list(panel.keys)).withColumn(panel.pos, F.col("__last") + F.col("step"))
    return (placed.join(test.select(*panel.keys, panel.pos, *panel.order, F.col(y).alias("actual")), [*panel.keys, panel.pos])
            .select(*panel.keys, *panel.order, "step", "actual", "predicted"))


def next_weekday(day: Column) -> Column:
    return F.date_add(day, F.when(F.weekday(day) == 4, 3).when(F.weekday(day) == 5, 2).otherwise(1))


def iterated_forecast(bars: DataFrame, models: Mapping[str, PipelineModel], indicators: Sequence[Indicator], steps: int = 5,
                      rows: int = 200, returns: bool = True, unknown: Mapping[str, Column] | None = None,
                      panel: P.Panel = P.BARS) -> DataFrame:
    """Forecasts of fitted pipelines over several steps: each prediction becomes the next bar, and features are made anew.

    Each key's last ``rows`` bars, the reach of the indicators or more, are the start; one bar per key and model is added a step, so
    no step reads more than the tails. A predicted return (or a level, without ``returns``) gives the close; open, high and low of
    that bar are the same, other columns keep their last value, and those of ``unknown`` take the one given. Bars are dated on
    weekdays. Every step is one written table, so lineage stays short. A key whose newest row lacks a feature has no forecast
    from that step on. Rows: keys, ``model``, ``step``, ``forecast_date``, ``predicted``.
    """
    keys, day = list(panel.keys), panel.order[0]
    columns = [c for c in bars.columns if c != panel.pos]
    inner = replace(panel, keys=(*panel.keys, "model"))
    size = F.count(F.lit(1)).over(W.partitionBy(*keys))
    tails = latest_rows(bars.select(*columns), rows, keys, day, rank="__r").withColumn(panel.pos, (size - F.col("__r")).cast("long")).drop("__r")
    names = F.array(*(F.lit(n) for n in models))
    known = publish(tails.select("*", F.explode(names).alias("model")), "tails")
    kinds, ahead = dict(known.dtypes), []
    for step in range(1, steps + 1):
        newest = publish(latest_record(compute(known, indicators, inner), [*keys, "model"], panel.pos), "newest")
        scored = None
        for name, model in models.items():
            one = score(model, newest.where(F.col("model") == name)).select(*newest.columns, F.col("prediction").cast("double"))
            scored = one if scored is None else scored.unionByName(one)
        close = F.col("close") * (1 + F.col("prediction")) if returns else F.col("prediction")
        made = {"close": close, day: next_weekday(F.col(day)), panel.pos: F.col(panel.pos) + 1,
                **{c: close for c in ("open", "high", "low") if c in columns}, **(unknown or {})}
        # A key without a prediction in an earlier step still has an older newest bar.
        reached = scored if step == 1 else scored.join(ahead[-1].select(*keys, "model", F.col(panel.pos)), [*keys, "model", panel.pos], "left_semi")
        bar = reached.select(*(made.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in known.columns))
        ahead.append(publish(bar.where("close is not null"), "forecast-bars"))
        known = known.unionByName(ahead[-1])
    out = None
    for step, bar in enumerate(ahead, 1):
        one = bar.select(*keys, "model", F.lit(step).alias("step"), F.col(day).alias("forecast_date"), F.col("close").alias("predicted"))
        out = one if out is None else out.unionByName(one)
    return out
