"""Joins J1-J10."""

from pyspark.sql import functions as F

from tickloom.operators import aggregates as A
from tickloom.operators import joins as J
from tickloom.operators import panel as P
from tickloom.operators import patterns as Q
from tickloom.plans import sql as S
from tickloom.plans.registry import query, rounded
from tickloom.sources import fixtures as X
from tickloom.sources.catalogue import MACRO_CATALOGUE, indicator_catalogue, keyword_table
from tickloom.streaming.aggregates import tick_bars

BASE = ("ticker", "date")
DAILY = "daily AS (SELECT ticker, date, avg(polarity) AS avg_polarity, avg(subjectivity) AS avg_subjectivity FROM sentiment GROUP BY 1, 2)"


@query("j1_bars_sentiment", f"""WITH {S.BARS_EV}, {S.SENTIMENT}, {DAILY} SELECT b.ticker, b.date, b.close,
 round(coalesce(avg_polarity, 0), 8) AS avg_polarity, round(coalesce(avg_subjectivity, 0), 8) AS avg_subjectivity
 FROM bars_ev b LEFT JOIN daily d USING (ticker, date)""")
def j1(spark, sf):
    df = J.with_daily_scores(X.bars_ev(spark, sf), A.daily_mean_sentiment(X.sentiment(spark, sf)))
    return df.select(*BASE, "close", *rounded(8, "avg_polarity", "avg_subjectivity"))


WIDE = """wide AS (SELECT date, max(CASE WHEN series_id = 'A' THEN value END) AS macro_A, max(CASE WHEN series_id = 'N' THEN value END) AS macro_N,
 max(CASE WHEN series_id = 'R' THEN value END) AS macro_R FROM macro GROUP BY date)"""
_BEFORE = "(PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("j2_macro_on_date", f"""WITH {S.BARS}, {S.MACRO}, {WIDE} SELECT ticker, date, close,
 {", ".join(f"last_value(macro_{i} IGNORE NULLS) OVER {_BEFORE} AS macro_{i}" for i in "ANR")} FROM bars LEFT JOIN wide USING (date)""")
def j2(spark, sf):
    df = J.with_macro_on_date(X.bars(spark, sf), X.macro(spark, sf), X.MACRO_IDS)
    return df.select(*BASE, "close", *[f"macro_{i}" for i in X.MACRO_IDS])


@query("j3_returns_sentiment", f"""WITH {S.BARS_EV}, {S.SENTIMENT}, {DAILY},
 r AS (SELECT ticker, date, close / nullif(lag(close) OVER {S.W}, 0) - 1 AS daily_return FROM bars_ev)
 SELECT ticker, date, round(daily_return, 8) AS daily_return, round(avg_polarity, 8) AS avg_polarity FROM r JOIN daily USING (ticker, date)""")
def j3(spark, sf):
    returns = Q.with_return(X.bars_ev(spark, sf), P.BARS)
    return (returns.join(A.daily_mean_sentiment(X.sentiment(spark, sf)), ["ticker", "date"])
            .select(*BASE, *rounded(8, "daily_return", "avg_polarity")))


@query("j4_monthly_macro", f"""WITH {S.BARS}, {S.MACRO}, m AS (SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS month,
 (max(close) - min(close)) / nullif(min(close), 0) AS r FROM bars GROUP BY 1, 2)
 SELECT ticker, month, series_id, round(r, 8) AS monthly_range_return, round(value, 6) AS indicator_value FROM m JOIN macro ON month = macro.date""")
def j4(spark, sf):
    return (A.monthly_range(X.bars(spark, sf)).join(A.monthly_mean(X.macro(spark, sf)), "month")
            .select("ticker", "month", "series_id", *rounded(8, "monthly_range_return"), *rounded(6, "indicator_value")))


@query("j5_vendor_difference", f"""WITH {S.BARS_B} SELECT ticker, date, a.close AS close_a, round(b.close, 6) AS close_b, round(a.close - b.close, 6) AS diff,
 round(100 * (a.close - b.close) / nullif(a.close, 0), 8) AS diff_pct FROM bars a JOIN bars_b b USING (ticker, date)""")
def j5(spark, sf):
    return J.matched_difference(X.bars(spark, sf), X.bars_b(spark, sf)).select(
        *BASE, "close_a", *rounded(6, "close_b", "diff"), *rounded(8, "diff_pct"))


@query("j5_unmatched_keys", f"""WITH {S.BARS_B} SELECT ticker, date, 'a' AS only_in FROM bars a ANTI JOIN bars_b b USING (ticker, date)
 UNION ALL SELECT ticker, date, 'b' FROM bars_b b ANTI JOIN bars a USING (ticker, date)""")
def j5_unmatched(spark, sf):
    return J.unmatched_keys(X.bars(spark, sf), X.bars_b(spark, sf))


@query("j6_as_of_macro", f"""WITH {S.BARS}, {S.MACRO} SELECT b.ticker, b.date, b.close,
 {", ".join(f"m{i}.value AS macro_{i}" for i in "ANR")} FROM bars b
 {" ".join(f"ASOF LEFT JOIN (SELECT date, value FROM macro WHERE series_id = '{i}') m{i} ON b.date >= m{i}.date" for i in "ANR")}""")
def j6(spark, sf):
    return J.as_of_macro(X.bars(spark, sf), X.macro(spark, sf), X.MACRO_IDS).select(
        *BASE, "close", *[f"macro_{i}" for i in X.MACRO_IDS])


@query("j6_as_of_ticks", f"""WITH {S.TICKS}, q AS (SELECT ticker, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, arg_max(price, event_id) AS price FROM ticks GROUP BY 1, 2)
 SELECT t.ticker, t.ts, t.event_id, t.price, q.price AS hour_close FROM ticks t ASOF LEFT JOIN q ON t.ticker = q.ticker AND t.ts >= q.ts""")
def j6_ticks(spark, sf):
    """Each tick with the close of the last hourly bar that was complete."""
    ticks = X.ticks(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    closes = tick_bars(ticks, "1 hour").select("ticker", F.col("bar_end").alias("ts"), F.col("close").alias("hour_close"))
    bucket = P.time_bucket(ticks, "ts", P.bucket_seconds(ticks, X.TICKS))
    return J.as_of_join(ticks.select("ticker", "ts", "event_id", "price"), closes, ["ticker"], "ts", ["hour_close"], bucket)


@query("j7_hold_out", f"""WITH {S.BARS} SELECT ticker, date, close,
 CASE WHEN CAST('0x' || substr(md5(ticker || '|' || date), 1, 8) AS BIGINT) % 10000 < 8000 THEN 'train' ELSE 'test' END AS part FROM bars""")
def j7(spark, sf):
    kept, held = J.hold_out(X.bars(spark, sf).select(*BASE, "close"), ["ticker", "date"], 0.8)
    return kept.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("test")))


_NAMES = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in zip("ANR", (r[1] for r in MACRO_CATALOGUE)))


@query("j8_catalogue_lookup", f"WITH {S.MACRO} SELECT series_id, date, value, CASE series_id {_NAMES} END AS indicator_name FROM macro")
def j8(spark, sf):
    names = indicator_catalogue(spark, dict(zip(X.MACRO_IDS, [r[0] for r in MACRO_CATALOGUE])))
    return X.macro(spark, sf).join(names.select("series_id", "indicator_name"), "series_id", "left")


TERMS = {"AAA": ["the", "thanks"], "BBB": ["Nicht", "und die"], "CCC": ["de la", "QUE"], "DDD": ["zzzz"]}


def _term_sql():
    clean = "' ' || lower(regexp_replace(text, '[^\\p{L}\\p{N}$]+', ' ', 'g')) || ' '"
    tests = []
    for ticker, words in TERMS.items():
        for word in words:
            low = word.lower()
            tests.append(f"SELECT doc_id, '{ticker}' AS ticker FROM d WHERE contains(w, ' {low} ')")
    return f"WITH d AS (SELECT doc_id, {clean} AS w FROM documents) SELECT DISTINCT * FROM ({' UNION ALL '.join(tests)})"


@query("j9_keyword_tags", _term_sql())
def j9(spark, sf):
    return J.tag_keywords(X.table(spark, sf, "documents").select("doc_id", "text"), keyword_table(spark, TERMS))


@query("j10_align_models", f"""WITH {S.PREDS} SELECT ticker, date, actual, max(CASE WHEN model = 'a' THEN predicted END) AS pred_a,
 round(max(CASE WHEN model = 'b' THEN predicted END), 4) AS pred_b FROM preds GROUP BY 1, 2, 3""")
def j10(spark, sf):
    return J.align_models(X.predictions(spark, sf), ["a", "b"]).select(*BASE, "actual", "pred_a", *rounded(4, "pred_b"))
