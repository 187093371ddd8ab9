import numpy as np
import pandas as pd
import pytest
from helpers import BAR_SCHEMA, SMALL, close_to, collected, make_bars, to_spark
from pyspark.sql import functions as F

from tickloom.operators import panel as P

SIZES = {"HOT": 900, "MID": 150, "TWO": 2, "ONE": 1}


@pytest.fixture(scope="module")
def pdf():
    return make_bars(SIZES)


@pytest.fixture(scope="module")
def bars(spark, pdf):
    return P.number_rows(to_spark(spark, pdf), SMALL).cache()


def by_ticker(pdf, fn):
    return pd.concat([fn(g) for _, g in pdf.sort_values(["ticker", "date"]).groupby("ticker")]).reset_index(drop=True)


def with_nulls(pdf):
    out = pdf.copy()
    rng = np.random.default_rng(3)
    out.loc[rng.random(len(out)) < 0.4, "close"] = np.nan
    first = out.groupby("ticker").head(1).index
    last = out.groupby("ticker").tail(1).index
    out.loc[first, "close"] = np.nan
    out.loc[last, "close"] = np.nan
    run = out.index[out.ticker == "HOT"][200:280]
    out.loc[run, "close"] = np.nan
    return out


def test_positions(bars, pdf):
    got = collected(bars, "pos")
    expected = pdf.sort_values(["ticker", "date"]).groupby("ticker").cumcount()
    assert got["pos"].tolist() == expected.tolist()


def test_bounded_frames_match_pandas_at_block_edges(bars, pdf):
    df = P.windowed(bars, SMALL, [
        lambda w: [F.lag("close", 2).over(w).alias("lag_2"), F.lead("close", 3).over(w).alias("lead_3"),
                   P.rolling(F.avg("close"), "close", 5, w).alias("mean_5")],
        lambda w: [P.rolling(F.stddev_samp("mean_5"), "mean_5", 4, w).alias("std_of_mean")]], before=8, after=3)
    assert df.count() == len(pdf)
    got = collected(df, "lag_2", "lead_3", "mean_5", "std_of_mean")
    want = by_ticker(pdf, lambda g: pd.DataFrame({
        "lag_2": g.close.shift(2), "lead_3": g.close.shift(-3), "mean_5": g.close.rolling(5).mean(),
        "std_of_mean": g.close.rolling(5).mean().rolling(4).std()}))
    for c in want:
        close_to(got[c], want[c], rtol=1e-7)


def test_no_task_holds_a_hot_key(bars):
    """The largest window group is a block with its halo, whatever the key's size."""
    seen = P.windowed(bars, SMALL, [lambda w: [F.count(F.lit(1)).over(w.rowsBetween(-10**6, 10**6)).alias("group_rows")]],
                      before=5)
    assert seen.agg(F.max("group_rows")).first()[0] <= SMALL.block_size(5) + 5


@pytest.mark.parametrize("fold,fn", [("sum", "cumsum"), ("max", "cummax"), ("min", "cummin"), ("product", "cumprod")])
def test_running_folds(bars, pdf, fold, fn):
    x = F.col("close") / 100
    got = collected(P.running(bars, SMALL, {"y": P.Run(fold, x)}), "y")
    want = by_ticker(pdf, lambda g: pd.DataFrame({"y": getattr(g.close / 100, fn)()}))
    close_to(got["y"], want["y"])


def test_fills(spark, pdf):
    holes = with_nulls(pdf)
    df = P.number_rows(to_spark(spark, holes), SMALL)
    want = by_ticker(holes, lambda g: pd.DataFrame({
        "f": g.close.ffill(), "b": g.close.bfill(), "a": g.close.ffill().bfill().fillna(0),
        "i": g.close.reset_index(drop=True).interpolate(method="linear").values}))
    close_to(collected(P.forward_fill(df, SMALL, ["close"]), "close")["close"], want["f"])
    close_to(collected(P.backward_fill(df, SMALL, ["close"]), "close")["close"], want["b"])
    close_to(collected(P.fill_all(df, SMALL, ["close"]), "close")["close"], want["a"])
    close_to(collected(P.interpolate(df, SMALL, ["close"]), "close")["close"], want["i"])


@pytest.mark.parametrize("span", [1, 2, 5, 12, 200])
def test_ewm(spark, span):
    pdf = make_bars({"LONG": 12_000, "ONE": 1, "FLAT": 40}, constant=("FLAT",))
    df = P.number_rows(to_spark(spark, pdf), SMALL)
    got = collected(P.ewm(df, SMALL, [P.Ewm("y", F.col("close"), P.span_alpha(span))]), "y")
    want = by_ticker(pdf, lambda g: pd.DataFrame({"y": g.close.ewm(span=span, adjust=False).mean()}))
    close_to(got["y"], want["y"], rtol=1e-12)


@pytest.mark.parametrize("span", [2, 12])
def test_ewm_keeps_the_whole_history(spark, span):
    """NULLs in first, middle and last rows, NaN, infinity and a spike over many blocks and segments."""
    n, k = 3000, P.span_alpha(span)
    series = {t: [100.0 + i % 7 for i in range(n)] for t in ("NAN", "INF", "SPIKE", "HOLES", "NONE")}
    series["NAN"][5], series["INF"][5], series["SPIKE"][2880 - 500] = float("nan"), float("inf"), 1e60
    series["HOLES"] = [None if i % 50 or i == 0 or i > 2900 else v for i, v in enumerate(series["HOLES"])]
    series["NONE"] = [None] * 40
    rows = [(t, i, v) for t, values in series.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ticker string, pos long, close double")
    blocked = P.Panel(order=("pos",), block_rows=16, scan_rows=2)
    got = {(r.ticker, r.pos): r.y for r in P.ewm(df, blocked, [P.Ewm("y", F.col("close"), k)]).collect()}
    assert len(got) == len(rows)
    for t, values in series.items():
        y = None
        for i, v in enumerate(values):
            y = y if v is None else v if y is None else y * (1 - k) + v * k
            assert got[t, i] == y or got[t, i] == pytest.approx(y, rel=1e-11, nan_ok=True), (t, i)


def test_ewm_over_missing_blocks(spark):
    """Positions without rows, whole blocks and segments of them included, leave the mean as it is."""
    rows = [("A", p, float(p % 7)) for p in range(400) if p % 100 < 3 or 250 < p < 270] + [("B", 399, 2.0)]
    df = spark.createDataFrame(rows, "ticker string, pos bigint, close double")
    got = {(r.ticker, r.pos): r.y for r in P.ewm(df, SMALL, [P.Ewm("y", F.col("close"), 0.3)]).collect()}
    want, y = {("B", 399): 2.0}, None
    for ticker, pos, x in rows[:-1]:
        y = x if y is None else 0.7 * y + 0.3 * x
        want[ticker, pos] = y
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == pytest.approx(value, rel=1e-12)


def test_ewm_with_gaps(spark, pdf):
    holes = with_nulls(pdf)
    df = P.number_rows(to_spark(spark, holes), SMALL)
    got = collected(P.ewm_with_gaps(df, SMALL, "y", "close", P.span_alpha(3)), "y")

    def expected(g):
        known = g.close.dropna()
        return pd.DataFrame({"y": known.ewm(span=3, adjust=False).mean().reindex(g.index).ffill()})
    close_to(got["y"], by_ticker(holes, expected)["y"])


def test_folds_by_time_need_no_positions(spark, bars, pdf):
    plain = to_spark(spark, with_nulls(pdf))
    runs = {"f": P.Run("last", F.col("close")), "b": P.Run("last", F.col("close"), reverse=True)}
    a = collected(P.running(plain, SMALL, runs), "f", "b")
    b = collected(P.running(P.number_rows(plain, SMALL), SMALL, runs), "f", "b")
    close_to(a["f"], b["f"], rtol=0, atol=0)
    close_to(a["b"], b["b"], rtol=0, atol=0)


def test_attach_per_key(bars, pdf):
    got = collected(P.attach_per_key(bars, SMALL, [F.avg("close").alias("m"), F.max("volume").alias("v")]), "m", "v")
    g = pdf.sort_values(["ticker", "date"]).groupby("ticker")
    close_to(got["m"], g.close.transform("mean").values)
    assert got["v"].tolist() == g.volume.transform("max").tolist()


def test_result_does_not_depend_on_partitioning_or_other_tickers(spark, pdf):
    level = [lambda w: [P.rolling(F.avg("close"), "close", 5, w).alias("m")]]
    alone = P.windowed(to_spark(spark, pdf[pdf.ticker == "MID"]), SMALL, level, before=4)
    shuffled = P.windowed(to_spark(spark, pdf.sample(frac=1, random_state=1)).repartition(7), SMALL, level, before=4)
    a = collected(alone, "m")
    b = collected(shuffled.where("ticker = 'MID'"), "m")
    close_to(a["m"], b["m"], rtol=0, atol=0)


def test_empty_input(spark):
    empty = spark.createDataFrame([], BAR_SCHEMA)
    assert P.windowed(empty, SMALL, [lambda w: [F.lag("close", 1).over(w).alias("x")]], before=1).count() == 0
    assert P.running(empty, SMALL, {"s": P.Run("sum", F.col("close"))}).count() == 0
    assert P.fill_all(empty, SMALL, ["close"]).count() == 0


def test_bucket_width_follows_the_densest_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 4 == 0, "S").otherwise("D").alias("ticker"), F.timestamp_seconds("id").alias("t"))
    panel = P.Panel(order=("t",))
    width = P.bucket_seconds(df, panel, rows=30)
    assert width == pytest.approx(40, rel=0.01)
    out = P.number_rows(df, panel, P.time_bucket(df, "t", width))
    last = {r["ticker"]: (r["n"], r["p"]) for r in out.groupBy("ticker").agg(F.count("*").alias("n"), F.max("pos").alias("p")).collect()}
    assert last == {"S": (1000, 999), "D": (3000, 2999)}


def test_position_by_timestamp_and_tie_break(spark):
    rows = [("A", f"2024-01-01 00:0{i // 2}:00", i) for i in range(10)]
    df = spark.createDataFrame(rows, "ticker string, t string, seq int").select("ticker", F.to_timestamp("t").alias("t"), "seq")
    panel = P.Panel(order=("t", "seq"), block_rows=4)
    out = P.number_rows(df, panel, P.time_bucket(df, "t", 60)).orderBy("seq").collect()
    assert [r["pos"] for r in out] == list(range(10))


@pytest.mark.parametrize("n,gap,start", [(1, 0, 0), (7, 0, 0), (16, 1, 0), (40, 0, 0), (40, 1, 0), (40, 3, 55), (300, 1, 37)])
def test_sliding_folds(spark, pdf, n, gap, start):
    """Any window and distance, with NULLs, and where the first rows of each key are filtered away."""
    holes = with_nulls(pdf)
    df = P.number_rows(to_spark(spark, holes), SMALL).where(F.col("pos") >= start).withColumn("__mine", F.lit(1))
    folds = ("count", "sum", "mean", "std", "max", "min")
    out = P.sliding(df, SMALL, {f: P.Slide(f, "close", n, gap, least=0 if f == "count" else 1) for f in folds})
    assert out.columns == [*df.columns, *folds]

    def expected(g):
        g = g.iloc[start:]
        seen = g["close"].rolling(n, min_periods=1)
        out = pd.DataFrame({"count": g["close"].notna().rolling(n, min_periods=1).sum(), "sum": seen.sum(), "mean": seen.mean(),
                            "std": seen.std(), "max": seen.max(), "min": seen.min()}).shift(gap)
        out["count"] = out["count"].fillna(0)
        return out

    want, got = by_ticker(holes, expected), collected(out, *folds)
    assert len(want) == len(got)
    for f in folds:
        close_to(got[f], want[f], rtol=1e-7, atol=1e-7)


def test_sliding_of_nothing(spark):
    empty = spark.createDataFrame([], BAR_SCHEMA)
    assert P.sliding(empty, SMALL, {"top": P.Slide("max", "close", 5)}).collect() == []
