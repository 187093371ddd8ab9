"""Sinks and table maintenance K1-K13."""

import uuid

from pyspark.sql import functions as F

from tickloom.operators import tables as K
from tickloom.plans import sql as S
from tickloom.plans.registry import query, rounded
from tickloom.plans.sources import ALL_BARS, OHLCV, fresh
from tickloom.sources import fixtures as X
from tickloom.sources import ingest as G

BASE = ("ticker", "date")


@query("k1_save_partitioned", ALL_BARS)
def k1(spark, sf):
    path = fresh(spark, "k1")
    K.save(X.bars(spark, sf).select(*OHLCV).withColumn("year", F.year("date")), path, "parquet", partition_by=["year"])
    return spark.read.parquet(path).select(*OHLCV)


@query("k2_save_table", f"WITH {S.BARS} SELECT ticker, date, close, volume FROM bars")
def k2(spark, sf):
    bars = X.bars(spark, sf).select(*BASE, "close", "volume").withColumn("year", F.year("date"))
    database = f"market_{uuid.uuid4().hex[:12]}"
    return K.save_table(bars, "bars", database, fresh(spark, "k2"), partition_by=["year"]).select(*BASE, "close", "volume")


@query("k3_view_and_list", f"WITH {S.BARS} SELECT 'bars_view' AS table_name, count(*) AS n_rows FROM bars")
def k3(spark, sf):
    view = K.register_view(X.bars(spark, sf), "bars_view")
    listed = [t for t in K.list_tables(spark) if t == "bars_view"]
    return view.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(listed[0]).alias("table_name"), "n_rows")


@query("k4_sql", f"WITH {S.BARS} SELECT ticker, max(close) AS peak, count(*) AS n FROM bars GROUP BY ticker")
def k4(spark, sf):
    return K.run_sql(spark, "SELECT ticker, max(close) AS peak, count(*) AS n FROM {bars} GROUP BY ticker",
                     bars=X.bars(spark, sf))


@query("k5_append", f"""WITH {S.BARS} SELECT ticker, date, close, volume FROM bars WHERE date < DATE '1998-01-01'
 UNION ALL SELECT ticker, date, close, NULL FROM bars WHERE date >= DATE '1998-01-01'""")
def k5(spark, sf):
    bars = X.bars(spark, sf)
    old = bars.where("date < '1998-01-01'").select(*BASE, "close", "volume")
    return K.append(old, bars.where("date >= '1998-01-01'").select(*BASE, "close"))


_OLD = "o AS (SELECT ticker, date, close, volume FROM bars WHERE date < DATE '1999-01-01')"
_NEW = "n AS (SELECT ticker, date, close * 2 AS close FROM bars WHERE date >= DATE '1998-01-01')"


def _halves(spark, sf):
    bars = X.bars(spark, sf)
    return (bars.where("date < '1999-01-01'").select(*BASE, "close", "volume"),
            bars.where("date >= '1998-01-01'").select(*BASE, (F.col("close") * 2).alias("close")))


@query("k6_upsert", f"""WITH {S.BARS}, {_OLD}, {_NEW} SELECT ticker, date, coalesce(n.close, o.close) AS close, o.volume
 FROM o FULL JOIN n USING (ticker, date)""")
def k6(spark, sf):
    old, new = _halves(spark, sf)
    return K.upsert(old, new, BASE)


@query("k6_upsert_stored", f"""WITH {S.BARS}, {_OLD}, {_NEW} SELECT ticker, date, coalesce(n.close, o.close) AS close, o.volume
 FROM o FULL JOIN n USING (ticker, date)""")
def k6_stored(spark, sf):
    old, new = _halves(spark, sf)
    path = fresh(spark, "k6")
    K.save(old, path)
    K.replace_table(K.upsert(spark.read.parquet(path), new, BASE), path)
    return spark.read.parquet(path)


@query("k6_upsert_partitions", f"""WITH {S.BARS}, n AS (SELECT ticker, date, close * 2 AS close, volume FROM bars WHERE ticker = '2-HIGH' AND date >= DATE '1998-01-01'),
 o AS (SELECT ticker, date, close, volume FROM bars WHERE date < DATE '1999-01-01')
 SELECT ticker, date, coalesce(n.close, o.close) AS close, coalesce(n.volume, o.volume) AS volume FROM o FULL JOIN n USING (ticker, date)""")
def k6_partitions(spark, sf):
    bars = X.bars(spark, sf).select(*BASE, "close", "volume")
    path = fresh(spark, "k6-partitions")
    K.save_bars(bars.where("date < '1999-01-01'"), path)
    new = bars.where("ticker = '2-HIGH' AND date >= '1998-01-01'").withColumn("close", F.col("close") * 2)
    K.upsert_stored(path, new.withColumn("bucket", G.ticker_bucket(F.col("ticker"))), BASE, "bucket")
    return spark.read.parquet(path).drop("bucket")


def _by_date(spark, sf, name):
    """The bars in files that each hold a span of dates."""
    path = fresh(spark, name)
    bars = X.bars(spark, sf).select(*BASE, "close", "volume")
    bars.where("date < '2000-01-01'").repartitionByRange(8, "date").write.parquet(path)
    return bars, path


@query("k6_upsert_files", f"""WITH {S.BARS} SELECT ticker, date, CASE WHEN date >= DATE '1999-11-01' THEN close * 2 ELSE close END AS close, volume FROM bars""")
def k6_files(spark, sf):
    """The last two months' rows change, later rows are new; only the files of those months are written again."""
    bars, path = _by_date(spark, sf, "k6-files")
    K.upsert_files(path, bars.where("date >= '1999-11-01'").withColumn("close", F.col("close") * 2), BASE)
    return spark.read.parquet(path)


@query("k7_update_files", f"""WITH {S.BARS} SELECT ticker, date, CASE WHEN date < DATE '1995-06-01' AND volume > 1 THEN -1 ELSE close END AS close, volume
 FROM bars WHERE date < DATE '2000-01-01'""")
def k7_files(spark, sf):
    _, path = _by_date(spark, sf, "k7-files")
    K.update_files(spark, path, (F.col("date") < "1995-06-01") & (F.col("volume") > 1), {"close": -1.0})
    return spark.read.parquet(path)


@query("k8_delete_files", f"WITH {S.BARS} SELECT ticker, date, close, volume FROM bars WHERE date >= DATE '1995-06-01' AND date < DATE '2000-01-01'")
def k8_files(spark, sf):
    _, path = _by_date(spark, sf, "k8-files")
    K.delete_files(spark, path, F.col("date") < "1995-06-01")
    return spark.read.parquet(path)


@query("k6_upsert_report", f"""WITH {S.BARS}, {_OLD}, {_NEW} SELECT count(*) FILTER (o.close IS NULL) AS inserted,
 count(*) FILTER (o.close IS NOT NULL) AS updated FROM n LEFT JOIN o USING (ticker, date)""")
def k6_report(spark, sf):
    return K.upsert_report(*_halves(spark, sf), BASE)


@query("k6_upsert_last_wins", """WITH f AS (SELECT user_id, ts, event_id, value FROM events)
 SELECT user_id, event_id, value FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def k6_last(spark, sf):
    events = X.table(spark, sf, "events").select("user_id", "event_id", "value")
    first = events.groupBy("user_id").agg(F.min("event_id").alias("event_id"), F.min_by("value", "event_id").alias("value"))
    return K.upsert(first, events, ["user_id"], "event_id")


@query("k7_update_where", f"""WITH {S.BARS} SELECT ticker, date, CASE WHEN volume < 2 THEN 0 ELSE close END AS close, volume FROM bars
 UNION ALL SELECT 'NEW', DATE '2001-08-01', 1.0, 0 FROM (SELECT count(*) AS n FROM bars WHERE volume < -1) WHERE n = 0""")
def k7(spark, sf):
    bars = X.bars(spark, sf).select(*BASE, "close", "volume")
    changed = K.update_where(bars, F.col("volume") < 2, {"close": 0.0})
    return K.update_where(changed, F.col("volume") < -1, {"close": -1.0},
                          insert={"ticker": "NEW", "date": "2001-08-01", "close": 1.0, "volume": 0})


@query("k7_update_first", f"""WITH {S.BARS}, f AS (SELECT ticker, date FROM bars WHERE volume < 3 ORDER BY ticker, date LIMIT 1)
 SELECT b.ticker, b.date, CASE WHEN f.date IS NOT NULL THEN -1 ELSE close END AS close FROM bars b LEFT JOIN f USING (ticker, date)""")
def k7_first(spark, sf):
    bars = X.bars(spark, sf).select(*BASE, "close", "volume")
    return K.update_where(bars, F.col("volume") < 3, {"close": -1.0}, many=False, keys=BASE).select(*BASE, "close")


@query("k8_delete_where", f"WITH {S.BARS} SELECT ticker, date, close FROM bars WHERE NOT coalesce(close > 100000, false)")
def k8(spark, sf):
    return K.delete_where(X.bars(spark, sf).select(*BASE, "close"), F.col("close") > 100000)


@query("k8_delete_first", f"""WITH {S.BARS}, f AS (SELECT ticker, date FROM bars WHERE close > 100000 ORDER BY ticker, date LIMIT 1)
 SELECT ticker, date, close FROM bars ANTI JOIN f USING (ticker, date)""")
def k8_first(spark, sf):
    return K.delete_where(X.bars(spark, sf).select(*BASE, "close"), F.col("close") > 100000, many=False, keys=BASE)


@query("k8_delete_keys", f"WITH {S.BARS_B} SELECT ticker, date, close FROM bars ANTI JOIN bars_b USING (ticker, date)")
def k8_keys(spark, sf):
    return K.delete_keys(X.bars(spark, sf).select(*BASE, "close"), X.bars_b(spark, sf), BASE)


@query("k9_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def k9(spark, sf):
    return K.duplicate_keys(X.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("k10_export", "SELECT doc_id, lang, source FROM documents WHERE lang <> 'en'")
def k10(spark, sf):
    path = fresh(spark, "k10")
    docs = X.table(spark, sf, "documents").select("doc_id", "lang", "source").withColumn("_id", F.xxhash64("doc_id"))
    K.export(docs, path, F.col("lang") != "en", "csv")
    return G.load(spark, path, "csv").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source")


@query("k11_messages", f"""WITH {S.BARS_EV} SELECT ticker AS key,
 '{{"ticker":"' || ticker || '","date":"' || date || '","close":' || close || ',"volume":' || volume || '}}' AS value FROM bars_ev""")
def k11(spark, sf):
    return K.messages(X.bars_ev(spark, sf).select(*BASE, "close", "volume"))


def prediction_docs(spark, sf):
    preds = X.predictions(spark, sf).withColumn("predicted", F.round("predicted", 2))
    issued = preds.withColumn("issued", F.trunc("date", "MM"))
    return K.prediction_documents(issued, value_field={"b": "Predicted_Value"})


@query("k12_prediction_documents", f"""WITH {S.PREDS}, m AS (SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS issued, model,
 '{{' || string_agg('"' || date || '":{{"' || CASE model WHEN 'b' THEN 'Predicted_Value' ELSE 'Predicted_Close' END || '":' || round(predicted, 2) || '}}', ',' ORDER BY date) || '}}' AS j
 FROM preds GROUP BY 1, 2, 3)
 SELECT ticker, issued, '{{' || string_agg('"' || model || '":' || j, ',' ORDER BY model) || '}}' AS predictions FROM m GROUP BY 1, 2""")
def k12(spark, sf):
    return prediction_docs(spark, sf).select("ticker", "issued", F.to_json("predictions").alias("predictions"))


@query("k13_latest_predictions", f"""WITH {S.PREDS}, i AS (SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS issued, model, date, predicted FROM preds),
 l AS (SELECT ticker, max(issued) AS issued FROM i GROUP BY ticker)
 SELECT ticker, issued, model, date, round(predicted, 2) AS predicted FROM i JOIN l USING (ticker, issued)""")
def k13(spark, sf):
    return K.latest_predictions(prediction_docs(spark, sf)).select("ticker", "issued", "model", "date", *rounded(2, "predicted")).orderBy("ticker", "date")
