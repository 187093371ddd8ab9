import datetime

import numpy as np
import pandas as pd
import pytest
from helpers import SMALL, close_to, collected, make_bars, to_spark
from pyspark.sql import functions as F

from tickloom.functions import text as T
from tickloom.operators import aggregates as A
from tickloom.operators import evaluate as V
from tickloom.operators import features as E
from tickloom.operators import frames as R
from tickloom.operators import joins as J
from tickloom.operators import panel as P
from tickloom.operators import patterns as Q
from tickloom.operators import sentiment as N
from tickloom.operators import tables as K
from tickloom.sources import ingest as G
from tickloom.sources import schemas
from tickloom.sources.catalogue import keyword_table, small_table


@pytest.fixture(scope="module")
def pdf():
    return make_bars({"HOT": 600, "MID": 80, "FLAT": 40, "ONE": 1}, constant=("FLAT",))


@pytest.fixture(scope="module")
def bars(spark, pdf):
    return P.number_rows(to_spark(spark, pdf), SMALL).cache()


# --- frames --------------------------------------------------------------------------------


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([(1.0,)], "Open double")
    with pytest.raises(ValueError, match="close"):
        R.standardise_ohlcv(df)


def test_numbers_with_junk(spark):
    df = spark.createDataFrame([(" 1.5 ",), (".",), ("1e3",), ("",), (None,), ("12x",)], "x string")
    assert [r[0] for r in df.select(R.to_number("x")).collect()] == [1.5, None, 1000.0, None, None, None]


def test_lookback_defaults_to_each_last_date(bars, pdf):
    got = R.lookback_slice(bars, 30, panel=SMALL).groupBy("ticker").agg(F.max("date").alias("d")).collect()
    assert {r["ticker"]: r["d"] for r in got} == pdf.groupby("ticker").date.max().to_dict()


def test_conform_fills_absent_columns_and_drops_time_of_day(spark):
    df = spark.createDataFrame([("A", "2024-01-02 10:30:00", "7.9", "x")], "Ticker string, Date string, volume string, close string")
    row = schemas.conform(df, schemas.STOCK).first()
    assert (row["date"], row["volume"], row["close"], row["open"]) == (datetime.date(2024, 1, 2), 7, None, None)


# --- aggregates ----------------------------------------------------------------------------


def test_correlation_is_null_without_variation(bars, pdf):
    got = {r["ticker"]: r["c"] for r in A.correlation(bars, ["ticker"], "close", "volume", "c").collect()}
    assert got["FLAT"] is None and got["ONE"] is None
    hot = pdf[pdf.ticker == "HOT"]
    assert got["HOT"] == pytest.approx(hot.close.corr(hot.volume))


def test_correlation_bucket_edges(spark):
    df = spark.createDataFrame([(0.71,), (0.7,), (0.3,), (-0.3,), (-0.7,), (-0.71,), (None,)], "r double")
    got = [r[0] for r in df.select(Q.correlation_strength(F.col("r"))).collect()]
    assert got == ["Strong Positive", "Positive", "Positive", "Weak", "Negative", "Strong Negative", None]


@pytest.mark.parametrize("margin", [0.5, 0.05, 2e-4])
def test_exact_quantiles_with_heavy_ties(spark, margin):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"ticker": ["A"] * 500 + ["B"] * 3 + ["C"], "x": np.concatenate(
        [np.where(rng.random(500) < 0.6, 5.0, rng.normal(0, 3, 500)), [1.0, 2.0, 10.0], [4.0]])})
    df = spark.createDataFrame([(t, float(x)) for t, x in pdf.itertuples(index=False)], "ticker string, x double")
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = A.exact_quantiles(df, "x", probs, margin=margin).toPandas().set_index("ticker")
    for name, p in probs.items():
        close_to(got[name].sort_index(), pdf.groupby("ticker").x.quantile(p).sort_index())


def test_quantiles_beside_an_outlier(spark):
    values = [float(i) for i in range(5000)] + [1e9]
    df = spark.createDataFrame([("A", v) for v in values], "ticker string, x double")
    got = A.exact_quantiles(df, "x", {"p05": 0.05, "p50": 0.5}).first()
    close_to([got["p05"], got["p50"]], np.quantile(values, [0.05, 0.5]))


def test_attached_tables_keep_every_row(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), ("B", None), (None, 3)], "ticker string, x int")
    table = spark.createDataFrame([("A", 10)], "ticker string, y int")
    got = P.attach_table(df, table, ["ticker"]).collect()
    assert sorted((r["ticker"] or "", r["x"] or 0, r["y"] or 0) for r in got) == [
        ("", 3, 0), ("A", 1, 10), ("A", 1, 10), ("A", 2, 10), ("B", 0, 0)]


def test_outliers_on_a_constant_series_are_none(bars):
    flat = A.zscore_outliers(bars, "close", panel=SMALL).where("ticker IN ('FLAT', 'ONE')")
    assert flat.agg(F.max("is_outlier")).first()[0] == 0
    assert A.iqr_outliers(bars, "close").where("ticker = 'FLAT'").agg(F.max("is_outlier")).first()[0] == 0


def test_resample_week_labels_and_empty_bins(spark):
    rows = [("A", datetime.date(2024, 1, 3), 1.0, 2.0, 0.5, 1.5, 10), ("A", datetime.date(2024, 1, 7), 1.5, 3.0, 1.0, 2.5, 5),
            ("A", datetime.date(2024, 1, 23), 9.0, 9.0, 9.0, 9.0, 1)]
    df = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume bigint")
    got = A.resample(df, "W").orderBy("period_end").collect()
    assert [r["period_end"].day for r in got] == [7, 14, 21, 28]
    assert (got[0]["open"], got[0]["high"], got[0]["low"], got[0]["close"], got[0]["volume"]) == (1.0, 3.0, 0.5, 2.5, 15)
    assert got[1]["close"] is None and got[1]["volume"] == 0
    assert A.resample(df, "W", fill_empty=False).count() == 2


def test_normalise_round_trip(bars):
    fitted = A.normalisation(bars, ["close"])
    back = collected(A.denormalise(A.normalise(bars, fitted, ["close"]), fitted, ["close"]), "close")
    close_to(back["close"], collected(bars, "close")["close"])


def test_volatility_sees_the_row_before_the_lookback(bars, pdf):
    as_of = pdf[pdf.ticker == "HOT"].date.max()
    got = {r["ticker"]: r["volatility"] for r in Q.high_volatility(bars, 300, 0.0, as_of, SMALL).collect()}
    hot = pdf[pdf.ticker == "HOT"].sort_values("date")
    recent = hot.close.pct_change()[(hot.date >= as_of - datetime.timedelta(300)).values]
    assert recent.iloc[0] == recent.iloc[0] and got["HOT"] == pytest.approx(recent.std())


# --- joins ---------------------------------------------------------------------------------


def test_as_of_join_matches_pandas(spark):
    rng = np.random.default_rng(5)
    def table(n, name):
        return pd.DataFrame({"k": rng.choice(["A", "B", "C"], n, p=[0.7, 0.2, 0.1]), "t": rng.choice(20_000, n, replace=False), name: np.arange(n)})
    left, right = table(800, "id"), table(60, "v")
    right.loc[0, "t"] = left.loc[0, "t"]
    sl = spark.createDataFrame(left.astype(object).values.tolist(), "k string, t bigint, id bigint")
    sr = spark.createDataFrame(right.astype(object).values.tolist(), "k string, t bigint, v bigint")
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("t"), on="t", by="k").sort_values("id")["v"]
    for bucket in (F.floor(F.col("t") / 100), F.floor(F.col("t") / 100_000)):
        got = J.as_of_join(sl, sr, ["k"], "t", ["v"], bucket).orderBy("id").toPandas()["v"]
        close_to(got, want)


def test_as_of_macro_before_first_value_is_null(spark, bars):
    macro = spark.createDataFrame([("X", datetime.date(2000, 3, 1), 1.0), ("Y", datetime.date(2000, 6, 1), 2.0)],
                                  "series_id string, date date, value double")
    out = J.as_of_macro(bars, macro, ["X", "Y"])
    assert out.count() == bars.count()
    early = out.where("date < '2000-03-01'").agg(F.count("macro_X"), F.count("macro_Y")).first()
    late = out.where("date >= '2000-06-01'").agg(F.min("macro_X"), F.min("macro_Y")).first()
    assert tuple(early) == (0, 0) and tuple(late) == (1.0, 2.0)


def test_hold_out_is_a_repeatable_partition(bars):
    kept, held = J.hold_out(bars, ["ticker", "date"], 0.8)
    again, _ = J.hold_out(bars.repartition(5), ["ticker", "date"], 0.8)
    assert kept.count() + held.count() == bars.count() and kept.exceptAll(again).count() == 0
    assert 0.7 < kept.count() / bars.count() < 0.9


def test_keyword_phrases(spark):
    docs = spark.createDataFrame([(1, "Tim  Cook, speaks"), (2, "cook Tim"), (3, "buy $AAPL now"), (4, "appleton"), (5, ""), (6, None)],
                                 "doc_id int, text string")
    words = keyword_table(spark, {"AAPL": ["Tim Cook", "$AAPL", "Apple"], "Z": ["one two three four"]})
    assert sorted(r["doc_id"] for r in J.tag_keywords(docs, words).collect()) == [1, 3]


# --- features ------------------------------------------------------------------------------


def test_class_target_edges(spark):
    days = [datetime.date(2024, 1, d) for d in range(1, 6)]
    closes = [100.0, 102.0, 102.0, 90.0, 90.5]
    df = spark.createDataFrame([("A", d, c) for d, c in zip(days, closes)], "ticker string, date date, close double")
    got = collected(E.class_targets(df), "target_class", "target_binary")
    assert got.target_class.tolist() == [2, 1, 0, 1, 1] and got.target_binary.tolist() == [1, 0, 0, 1, 0]


def test_splits_are_chronological_and_floored(bars, pdf):
    got = E.chronological_split(bars, panel=SMALL).groupBy("ticker", "split").count().collect()
    sizes = {(r["ticker"], r["split"]): r["count"] for r in got}
    n = pdf.groupby("ticker").size()
    for t in n.index:
        train, val = int(n[t] * 0.8), int(n[t] * 0.1)
        assert sizes.get((t, "train"), 0) == train and sizes.get((t, "val"), 0) == val
        assert sizes.get((t, "test"), 0) == n[t] - train - val


def test_sequences_cross_block_edges(bars, pdf):
    got = E.sequences(bars, ["close"], "close", 5, 2, SMALL).where("ticker = 'HOT'").orderBy("pos").collect()
    close = pdf[pdf.ticker == "HOT"].close.tolist()
    assert len(got) == 600 - 4 - 2
    for i, r in enumerate(got):
        assert [x[0] for x in r["sequence"]] == close[i:i + 5] and r["label"] == close[i + 6]


def test_min_max_of_a_constant_is_zero(bars):
    out = E.apply_min_max(bars, E.min_max(bars, ["close"]), ["close"])
    assert out.where("ticker IN ('FLAT', 'ONE')").agg(F.max("close"), F.min("close")).first() == (0.0, 0.0)


def test_targets_never_enter_the_features(spark, bars):
    df = E.step_targets(bars, 3, panel=SMALL)
    assert R.numeric_columns(df) == ["open", "high", "low", "close", "volume"]


def test_business_days(spark):
    df = spark.createDataFrame([("A", datetime.date(2024, 5, 3))], "ticker string, date date")
    got = [r["forecast_date"] for r in E.next_business_days(df, 6).orderBy("step").collect()]
    assert got == [d.date() for d in pd.bdate_range("2024-05-06", periods=6)]


# --- text ----------------------------------------------------------------------------------


def test_clean_text(spark):
    df = spark.createDataFrame([("See https://a.b/c?d=1 @me #tag Café, it's  50%!",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(T.clean_text("t")).collect()] == ["See Café its 50", "", None]


def test_paragraphs_do_not_match_other_tags(spark):
    html = "<pre>no</pre><P>upper</P><p class='x'>one <b>bold</b></p><path d='0'/><p>two\nlines</p>" + "<p>n</p>" * 12
    got = spark.createDataFrame([(html,)], "h string").select(T.html_paragraphs("h")).first()[0]
    assert got == "one bold two\nlines " + " ".join(["n"] * 8)


def test_scores_of_empty_and_unknown_text_are_zero(spark):
    docs = spark.createDataFrame([(1, "Good good bad"), (2, ""), (3, None), (4, "unknown")], "doc_id int, text string")
    lex = small_table(spark, [("good", 0.5, 0.6), ("bad", -0.4, 0.9)], "word string, polarity double, subjectivity double")
    got = {r["doc_id"]: (round(r["polarity"], 6), round(r["subjectivity"], 6), r["sentiment"]) for r in N.score_text(docs, lex).collect()}
    assert got == {1: (0.2, 0.7, "positive"), 2: (0.0, 0.0, "neutral"), 3: (0.0, 0.0, "neutral"), 4: (0.0, 0.0, "neutral")}


# --- tables --------------------------------------------------------------------------------


def test_upsert_keeps_fields_that_are_not_set(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, x string, y int")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, x string")
    got = sorted(tuple(r) for r in K.upsert(old, new, ["k"]).select("k", "x", "y").collect())
    assert got == [(1, "a", 10), (2, "c", 20), (3, "d", None)]
    assert tuple(K.upsert_report(old, new, ["k"]).first()) == (1, 1)


def test_replace_table_swaps(spark, tmp_path):
    path = str(tmp_path / "t")
    K.save(spark.range(3), path)
    K.replace_table(spark.read.parquet(path).where("id > 0"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [1, 2]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_stored_upsert_leaves_other_folders_alone(spark, bars, tmp_path):
    path = tmp_path / "t"
    K.save_bars(bars, str(path))
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    new = spark.createDataFrame([("MID", datetime.date(1999, 1, 1), 1.0), ("MID", bars.where("ticker = 'MID'").first()["date"], 2.0)],
                                "ticker string, date date, close double")
    K.upsert_stored(str(path), new.withColumn("bucket", G.ticker_bucket(F.col("ticker"))), ["ticker", "date"], "bucket")
    kept = [p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]]
    folder = spark.range(1).select(G.ticker_bucket(F.lit("MID"))).first()[0]
    assert len(kept) == len([p for p in before if f"bucket={folder}/" not in str(p)])
    assert spark.read.parquet(str(path)).count() == bars.count() + 1


def test_update_inserts_only_when_nothing_matches(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "k int, v int")
    hit = K.update_where(df, F.col("v") > 4, {"v": 0}, insert={"k": 9, "v": 9})
    miss = K.update_where(df, F.col("v") > 40, {"v": 0}, insert={"k": 9, "v": 9})
    assert sorted(r["k"] for r in hit.collect()) == [1, 2] and sorted(r["k"] for r in miss.collect()) == [1, 2, 9]


def test_delete_keeps_rows_where_the_predicate_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, v int")
    assert sorted(r["k"] for r in K.delete_where(df, F.col("v") > 4).collect()) == [2]
    assert sorted(r["k"] for r in K.delete_where(df, F.col("v") > 4, many=False, keys=["k"]).collect()) == [2, 3]
    assert K.delete_where(df, F.col("v") > 99, many=False, keys=["k"]).count() == 3


def test_ticker_folder_is_pruned(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    K.save_bars(bars, path)
    one = G.load_bars(spark, path, "MID")
    assert one.count() == 80 and "bucket" not in one.columns
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_any_number_of_ticker_folders_is_read(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    K.save_bars(bars, path, buckets=3)
    one = G.load_bars(spark, path, "MID")
    assert one.count() == 80
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="3 ticker folders"):
        K.save_bars(bars, path, "append")
    K.save_bars(bars, path, "append", buckets=3)
    assert G.load_bars(spark, path, "MID").count() == 160
    K.save(bars.withColumn("bucket", F.lit(0)), str(tmp_path / "plain"), partition_by=["bucket"])
    assert G.load_bars(spark, str(tmp_path / "plain"), "MID").count() == 80


def test_macro_csv_with_junk_and_time_of_day(spark, tmp_path):
    (tmp_path / "m.csv").write_text("date,value,series_id,indicator_name\n2020-01-01 05:00:00,1.5,A,x\n2020-02-01,.,A,x\n")
    rows = G.load_macro(spark, str(tmp_path / "m.csv")).orderBy("date").collect()
    assert [(r["date"].month, r["value"]) for r in rows] == [(1, 1.5), (2, None)]


def test_sentiment_file_without_ticker(spark, tmp_path):
    (tmp_path / "s.csv").write_text("title,source,published_at,polarity,subjectivity,sentiment\nx,news,2024-02-03 04:05:06,0.25,bad,positive\n")
    row = G.load_sentiment(spark, str(tmp_path / "s.csv"), "AAA").first()
    assert (row["ticker"], row["day"], row["polarity"], row["subjectivity"]) == ("AAA", datetime.date(2024, 2, 3), 0.25, None)


@pytest.mark.parametrize("method", ["ffill", "bfill", "interpolate", "drop"])
def test_missing_value_methods(spark, method):
    rows = [("A", datetime.date(2024, 1, i + 1), v) for i, v in enumerate([None, 1.0, None, 3.0, None])]
    df = P.number_rows(spark.createDataFrame(rows, "ticker string, date date, close double"))
    got = [r["close"] for r in R.handle_missing(df, method).orderBy("date").collect()]
    assert got == {"ffill": [None, 1, 1, 3, 3], "bfill": [1, 1, 3, 3, None], "interpolate": [None, 1, 2, 3, 3], "drop": [1, 3]}[method]


def test_unknown_methods_raise(bars):
    with pytest.raises(ValueError):
        R.handle_missing(bars, "guess")
    with pytest.raises(ValueError):
        A.detect_outliers(bars, "close", "guess")


# --- evaluation ----------------------------------------------------------------------------


def test_ranking_against_pairs(spark):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 300), np.round(rng.random(300), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = V.ranking_metrics(df).first()
    diff = s[y == 1][:, None] - s[y == 0][None, :]
    assert got["auc_roc"] == pytest.approx(((diff > 0) + 0.5 * (diff == 0)).mean())
    coarse = V.ranking_metrics(df, buckets=3).first()
    assert coarse["auc_roc"] == pytest.approx(got["auc_roc"]) and coarse["auc_pr"] == pytest.approx(got["auc_pr"])


def test_classification_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 0)], "label int, prediction int")
    r = V.classification_metrics(df).first()
    assert r["accuracy"] == 0.5 and r["precision"] == pytest.approx(0.25) and r["recall"] == 0.5


def test_backtest_across_blocks(spark):
    rng = np.random.default_rng(2)
    n = 200
    actual, predicted = 100 + np.cumsum(rng.normal(0, 1, n)), 100 + np.cumsum(rng.normal(0, 1, n))
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(i) for i in range(n)]
    df = spark.createDataFrame([("A", d, float(a), float(p)) for d, a, p in zip(days, actual, predicted)],
                               "ticker string, date date, actual double, predicted double")
    got = V.backtest(df, SMALL).first()
    r = np.append(0, np.diff(actual) / actual[:-1])
    p = np.append(0, np.diff(predicted) / predicted[:-1])
    s = np.where(p > 0, r, 0)
    equity = np.cumprod(1 + s)
    daily = np.diff(equity) / equity[:-1]
    peak = np.maximum.accumulate(equity)
    assert got["total_return"] == pytest.approx(100 * (equity[-1] - 1))
    assert got["sharpe_ratio"] == pytest.approx(daily.mean() / daily.std() * np.sqrt(252))
    assert got["max_drawdown"] == pytest.approx(100 * ((peak - equity) / peak).max())
    assert got["win_rate"] == pytest.approx(100 * (s > 0).sum() / (p != 0).sum())


def test_stored_changes_leave_other_files_alone(spark, tmp_path):
    """Files without a match keep their path and time, also below partition folders; running again changes nothing."""
    import os

    def files():
        return {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/*/part-*.parquet")}

    def rows():
        return sorted(tuple(r) for r in spark.read.option("mergeSchema", "true").parquet(path).select("k", "p", "x", "y").collect())
    path = str(tmp_path / "t")
    df = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 3).cast("int").alias("p"), F.lit(1.0).alias("x"), F.lit("a b").alias("y"))
    df.repartitionByRange(4, "k").write.partitionBy("p").parquet(path)
    before, want = files(), {(k, k % 3, 1.0, "a b") for k in range(40)}
    new = spark.createDataFrame([(0, 0, 5.0), (100, 7, 6.0)], "k long, p int, x double")
    for _ in range(2):
        K.upsert_files(path, new, ["k", "p"], partition_by=["p"])
        want = {(k, p, 5.0 if k == 0 else x, y) for k, p, x, y in want if k != 100} | {(100, 7, 6.0, None)}
        assert rows() == sorted(want, key=lambda r: r[:2])
    after = files()
    assert sum(before.get(f) == t for f, t in after.items()) == len(before) - 1
    assert K.update_files(spark, path, F.col("k") == 39, {"x": 9.0}, ["p"]) == 1 and K.delete_files(spark, path, F.col("k") == 38, ["p"]) == 1
    assert K.update_files(spark, path, F.col("k") == -1, {"x": 9.0}, ["p"]) == 0
    want = {(k, p, 9.0 if k == 39 else x, y) for k, p, x, y in want if k != 38}
    assert rows() == sorted(want, key=lambda r: r[:2]) and sum(before.get(f) == t for f, t in files().items()) == len(before) - 3
    assert not [f for f in os.listdir(path) if f.startswith("_staged")]


@pytest.mark.parametrize("freq", ["D", "W", "M"])
def test_spines_are_made_in_chunks(spark, freq):
    """Small chunks give the same labels as one; a key with one row has one."""
    days = [("A", datetime.date(2000, 1, 31)), ("A", datetime.date(2001, 3, 1)), ("B", datetime.date(2000, 2, 29))]
    df = spark.createDataFrame(days, "ticker string, date date")
    got = sorted(tuple(r) for r in A.period_spine(df, freq, ["ticker"], "date", chunk=3).collect())
    pandas = {"D": "D", "W": "W-SUN", "M": "ME"}[freq]
    want = []
    for t in "AB":
        own = [d for k, d in days if k == t]
        s = pd.Series(1, pd.to_datetime([own[0], own[-1]])).resample(pandas).sum()
        want += [(t, d.date()) for d in s.index]
    assert got == sorted(set(want))


def test_time_buckets_over_a_long_gap(spark):
    rows = [("A", datetime.datetime(2024, 1, 1), 1.0), ("A", datetime.datetime(2024, 1, 2, 0, 0, 30), 3.0), ("B", None, 1.0)]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp, v double")
    out = A.time_buckets(df, "ts", "v", "10 seconds", chunk=100)
    assert out.where("ticker = 'A'").count() == 8640 + 4 and out.agg(F.sum("n")).first()[0] == 2
    assert out.select("bucket").distinct().where("bucket is not null").count() == 8644
