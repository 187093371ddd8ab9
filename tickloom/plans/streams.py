"""Streams R1-R8 and the stream source S13, over the event table as a file stream."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tickloom.operators import indicators as I
from tickloom.operators import models as M
from tickloom.plans import sql as S
from tickloom.plans.models import FEATURES, parts
from tickloom.plans.registry import query, rounded
from tickloom.plans.sources import fresh
from tickloom.session import is_folder
from tickloom.sources import fixtures as X
from tickloom.streaming import aggregates as A
from tickloom.streaming import buffers as B
from tickloom.streaming import scoring as C
from tickloom.streaming import sources as R


def table_stream(spark, sf, name):
    """A table, be it one file or a folder of files, as a stream."""
    path, schema = f"{sf.rstrip('/')}/{name}.parquet", X.table(spark, sf, name).schema
    if is_folder(spark, path):
        return R.file_stream(spark, path, schema)
    return R.file_stream(spark, sf, schema, glob=f"{name}.parquet")  # a stream's path is a folder


def split_stream(spark, sf, name, files=4):
    """A table as a stream of several files, one per trigger."""
    folder, table = fresh(spark, f"{name}-files"), X.table(spark, sf, name)
    table.repartition(files).write.parquet(folder)
    return R.file_stream(spark, folder, table.schema, files_per_trigger=1)


def event_messages(spark, sf, events=None):
    """Every event as one JSON message on each topic; some lack the key or the time, some are not JSON."""
    e = X.ticks_of(table_stream(spark, sf, "events") if events is None else events)
    ticker, price = F.when(F.col("price") >= 1, F.col("ticker")), F.col("price")
    at, n = F.when(F.col("size") < 90, F.col("ts")).alias("timestamp"), F.col("event_id")
    bodies = {R.STOCK_TOPIC: F.struct(ticker.alias("ticker"), price, at, n),
              R.SENTIMENT_TOPIC: F.struct(ticker.alias("ticker"), (price / 100).alias("score"), at, n),
              R.MACRO_TOPIC: F.struct(ticker.alias("series_id"), F.to_date("ts").alias("date"), price.alias("value"), n)}
    broken = F.when(F.col("size") == 13, "{oops ").otherwise("")
    messages = F.array(*[F.struct(F.lit(topic).alias("topic"), F.concat(broken, F.to_json(body)).alias("value"))
                         for topic, body in bodies.items()])
    return e.select(F.inline(messages))


SIZED = "e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS size FROM events)"
KEPT = f"WITH {SIZED}, kept AS (SELECT * FROM e WHERE value >= 1 AND size <> 13)"


@query("s13_stream_source", "SELECT event_id, ts, user_id, event_type, value FROM events")
def s13(spark, sf):
    return R.drain(table_stream(spark, sf, "events"), "s13").select("event_id", "ts", "user_id", "event_type", "value")


@query("r1_decode_stock", f"{KEPT} SELECT event_id, event_type AS ticker, value AS price FROM kept")
def r1(spark, sf):
    rows = R.decode(event_messages(spark, sf), R.STOCK_TOPIC, R.STOCK_MESSAGE + ", event_id bigint")
    return R.drain(rows, "r1").select("event_id", "ticker", "price")


@query("r1_decode_macro", f"{KEPT} SELECT event_id, event_type AS series_id, CAST(ts AS DATE) AS date, value FROM kept")
def r1_macro(spark, sf):
    rows = R.decode(event_messages(spark, sf), R.MACRO_TOPIC, R.MACRO_MESSAGE + ", event_id bigint", "series_id")
    return R.drain(rows, "r1m").select("event_id", "series_id", "date", "value")


@query("r1_macro_text", f"""{KEPT} SELECT event_id, event_type AS series_id, CASE WHEN size % 2 = 0 THEN value END AS value FROM kept""")
def r1_macro_text(spark, sf):
    """Values sent as text, every other one a lone dot: such a message is kept and its value is NULL."""
    broken = F.regexp_replace("value", '"value":[^,}]*', '"value":"."')
    odd = F.get_json_object("value", "$.odd") == "1"
    e = X.ticks_of(table_stream(spark, sf, "events")).where("price >= 1 AND size <> 13")
    body = F.to_json(F.struct(F.col("ticker").alias("series_id"), F.col("price").alias("value"), "event_id",
                              (F.col("size") % 2).alias("odd")))
    messages = e.select(F.lit(R.MACRO_TOPIC).alias("topic"), body.alias("value"))
    messages = messages.withColumn("value", F.when(odd, broken).otherwise(F.col("value")))
    rows = R.decode(messages, R.MACRO_TOPIC, "series_id string, value double, event_id bigint", "series_id")
    return R.drain(rows, "r1t").select("event_id", "series_id", "value")


@query("r1_dropped_messages", f"WITH {SIZED} SELECT count(*) AS n_dropped FROM e WHERE value < 1 OR size = 13")
def r1_dropped(spark, sf):
    rows = R.corrupt(event_messages(spark, sf), R.STOCK_TOPIC, R.STOCK_MESSAGE + ", event_id bigint")
    return R.drain(rows, "r1d").agg(F.count(F.lit(1)).alias("n_dropped"))


@query("r2_arrival_stamp", f"{KEPT} SELECT event_id, true AS has_time, size >= 90 AS stamped_on_arrival FROM kept")
def r2(spark, sf):
    rows = R.decode(event_messages(spark, sf), R.STOCK_TOPIC, R.STOCK_MESSAGE + ", event_id bigint")
    marked = R.stamped(rows.withColumn("stamped_on_arrival", F.col("timestamp").isNull()))
    return R.drain(marked, "r2").select("event_id", F.col("timestamp").isNotNull().alias("has_time"), "stamped_on_arrival")


@query("r3_last_rows", f"""{KEPT} SELECT event_type AS ticker, event_id, value AS price FROM kept
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 200""")
def r3(spark, sf):
    rows = R.decode(event_messages(spark, sf), R.STOCK_TOPIC, "ticker string, price double, event_id bigint")
    return B.newest_buffers(R.drain(B.last_rows(rows, order=["event_id"], size=B.BARS_KEPT), "r3", "update", batches=True)).select(
        "ticker", "event_id", "price")


@query("r3_last_rows_batches", f"""{KEPT} SELECT event_type AS ticker, event_id, value AS price FROM kept
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 50""")
def r3_batches(spark, sf):
    """The buffers after the last of several triggers."""
    messages = event_messages(spark, sf, split_stream(spark, sf, "events"))
    rows = R.decode(messages, R.STOCK_TOPIC, "ticker string, price double, event_id bigint")
    stored = R.drain(B.last_rows(rows, order=["event_id"], size=50), "r3b", "update", batches=True)
    return B.newest_buffers(stored).select("ticker", "event_id", "price")


@query("r3_last_records", f"""{KEPT} SELECT event_type AS ticker, event_id, round(value / 100, 6) AS score FROM kept
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 1000""")
def r3_records(spark, sf):
    rows = R.decode(event_messages(spark, sf), R.SENTIMENT_TOPIC, "ticker string, score double, event_id bigint")
    return B.newest_buffers(R.drain(B.last_rows(rows, order=["event_id"], size=B.RECORDS_KEPT), "r3s", "update", batches=True)).select(
        "ticker", "event_id", *rounded(6, "score"))


@query("r3_macro_records", f"""{KEPT} SELECT event_type AS series_id, event_id, CAST(ts AS DATE) AS date, value FROM kept
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) <= 1000""")
def r3_macro(spark, sf):
    """The buffers of macro series over several triggers."""
    messages = event_messages(spark, sf, split_stream(spark, sf, "events", 2))
    rows = R.decode(messages, R.MACRO_TOPIC, "series_id string, date date, value double, event_id bigint", "series_id")
    stored = R.drain(B.last_rows(rows, keys=["series_id"], order=["event_id"], size=B.RECORDS_KEPT), "r3m", "update", batches=True)
    return B.newest_buffers(stored, ["series_id"]).select("series_id", "event_id", "date", "value")


def bar_messages(spark, sf):
    """The stored daily bars as a stream of bar messages."""
    folder = fresh(spark, "bar-stream")
    X.bars(spark, sf).select("ticker", "date", "open", "high", "low", "close", "volume").write.parquet(folder)
    return R.json_messages(R.file_stream(spark, folder, R.BAR_MESSAGE), R.STOCK_TOPIC)


def scored(spark, sf, name):
    train, _ = parts(spark, sf, "target_return_1d")
    models = {"linear": M.pipeline("linear", "regression", FEATURES).fit(train),
              "forest": M.pipeline("random_forest", "regression", FEATURES, numTrees=5, maxDepth=4).fit(train)}
    indicators = [I.returns(), I.rsi(), I.gap_and_range(), I.price_to_ma(5), I.price_to_ma(20), I.momentum(5), I.volatility(10)]
    bars = R.decode(bar_messages(spark, sf), R.STOCK_TOPIC, R.BAR_MESSAGE)
    buffers = B.last_rows(bars, size=B.BARS_KEPT, minimum=B.BARS_NEEDED)
    return R.drain(buffers, name, "update", transform=C.scorer(models, indicators))


@query("r4_scored_buffers")
def r4(spark, sf):
    return scored(spark, sf, "r4").select("ticker", "date", "close", "model", "predicted")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_RECORDS = f"""records AS (SELECT {list(PRIORITIES)}[doc_id % 5 + 1] AS ticker, CAST(DATE '1998-07-06' + CAST((doc_id // 5) % 28 AS INTEGER) AS DATE) AS date,
 CAST((doc_id // 5) % 28 AS BIGINT) * 86400 + doc_id % 86400 AS moment, ((doc_id * 37) % 201 - 100) / 100.0::DOUBLE AS polarity FROM documents)"""


def record_stream(spark, sf):
    """Sentiment records of the last four weeks of the bars, one second apart within a day."""
    d = F.col("doc_id")
    day = F.date_add(F.lit("1998-07-06").cast("date"), (F.floor(d / 5) % 28).cast("int"))
    names = F.array(*[F.lit(t) for t in PRIORITIES])
    return table_stream(spark, sf, "documents").select(
        F.element_at(names, (d % 5 + 1).cast("int")).alias("ticker"), F.timestamp_seconds(F.unix_timestamp(day) + d % 86400).alias("ts"),
        (((d * 37) % 201 - 100) / 100).alias("polarity"), (((d * 53) % 101) / 100).alias("subjectivity"))


# Two fixed linear models over features of prices and sentiment.
MODELS = {"trend": "0.0005 + 0.2 * daily_return - 0.1 * (price_to_ma5 - 1) + 0.01 * polarity_3", "news": "0.001 - 0.05 * daily_return + 0.02 * polarity_3"}
HORIZON = 5


def forecast_stream(spark, sf, name, transform=lambda forecasts: forecasts):
    """Bars and sentiment records meet in one keyed state; its buffers are forecast batch by batch."""
    models = {n: PipelineModel([SQLTransformer(statement=f"SELECT *, {formula} AS prediction FROM __THIS__")]) for n, formula in MODELS.items()}
    indicators = [I.returns(), I.price_to_ma(5), I.sma(3, "polarity_mean", "polarity_3", min_periods=1)]
    run = C.forecaster(models, indicators, HORIZON, {"polarity_mean": F.lit(0.0), "subjectivity_mean": F.lit(0.0)})
    bars = R.decode(bar_messages(spark, sf), R.STOCK_TOPIC, R.BAR_MESSAGE)
    return R.drain(B.bars_and_scores(bars, record_stream(spark, sf)), name, "update", transform=lambda batch: transform(run(batch)))


_FORECASTS = f"""WITH RECURSIVE {S.BARS}, {_RECORDS}, l AS (SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS r FROM bars),
 kept AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY moment DESC) <= 1000),
 daily AS (SELECT ticker, date, avg(polarity) AS p FROM kept GROUP BY 1, 2),
 s AS (SELECT ticker, max(date) AS d, list(close ORDER BY r) AS y, list(coalesce(p, 0.0::DOUBLE) ORDER BY r) AS p FROM l LEFT JOIN daily USING (ticker, date) WHERE r <= 5 GROUP BY 1),
 f AS (SELECT ticker, m.model, d, 0 AS step, y, p FROM s, (SELECT unnest(['trend', 'news']) AS model) m
  UNION ALL SELECT ticker, model, {"CASE WHEN isodow(d) = 5 THEN d + 3 WHEN isodow(d) = 6 THEN d + 2 ELSE d + 1 END"}, step + 1,
   list_prepend(y[1] * (1 + CASE model WHEN 'trend' THEN 0.0005::DOUBLE + 0.2::DOUBLE * (y[1] / y[2] - 1) - 0.1::DOUBLE * (y[1] / list_avg(y[1:5]) - 1) + 0.01::DOUBLE * list_avg(p[1:3])
    ELSE 0.001::DOUBLE - 0.05::DOUBLE * (y[1] / y[2] - 1) + 0.02::DOUBLE * list_avg(p[1:3]) END), y), list_prepend(0.0::DOUBLE, p) FROM f WHERE step < {HORIZON})
"""


@query("r4_forecasts_with_sentiment", f"""{_FORECASTS}
 SELECT ticker, model, CAST(step AS INTEGER) AS step, CAST(d AS DATE) AS forecast_date, round(y[1], 4) AS predicted FROM f WHERE step > 0""")
def r4_forecasts(spark, sf):
    return forecast_stream(spark, sf, "r4f").select("ticker", "model", "step", "forecast_date", *rounded(4, "predicted"))


@query("r6_prediction_documents", f"""{_FORECASTS}
 SELECT ticker, CAST({HORIZON} AS INTEGER) AS prediction_horizon, model, CAST(d AS DATE) AS forecast_date, round(y[1], 4) AS predicted FROM f WHERE step > 0""")
def r6_documents(spark, sf):
    """Nested documents written per batch, and the newest of each ticker read back."""
    stored = forecast_stream(spark, sf, "r6d", lambda forecasts: C.prediction_documents(forecasts, HORIZON))
    return C.flat_documents(C.newest_documents(stored)).select("ticker", "prediction_horizon", "model", "forecast_date", *rounded(4, "predicted"))


@query("r5_streamed_sentiment", f"""WITH {S.BARS_EV}, {S.SENTIMENT}, d AS (SELECT ticker, date, avg(polarity) AS p, avg(subjectivity) AS s, count(*) AS n FROM sentiment GROUP BY 1, 2)
 SELECT ticker, date, close, round(p, 8) AS polarity_mean, round(s, 8) AS subjectivity_mean, n AS polarity_count FROM d JOIN bars_ev USING (ticker, date)
 WHERE date + 1 <= (SELECT max(date) FROM sentiment) - 1""")
def r5(spark, sf):
    records = X.sentiment_records(table_stream(spark, sf, "documents"))
    daily = A.daily_sentiment(records.withColumn("ts", F.col("date").cast("timestamp")))
    joined = A.with_bars(daily, X.bars_ev(spark, sf))
    return R.drain(joined, "r5").select("ticker", "date", "close", *rounded(8, "polarity_mean", "subjectivity_mean"), "polarity_count")


@query("r5_bars_left_sentiment", f"""WITH {S.BARS_EV}, {S.SENTIMENT}, d AS (SELECT ticker, date, avg(polarity) AS p, avg(subjectivity) AS s, count(*) AS n FROM sentiment
 WHERE date + 1 <= (SELECT max(date) FROM sentiment) - 1 GROUP BY 1, 2)
 SELECT ticker, date, close, round(coalesce(p, 0), 8) AS polarity_mean, round(coalesce(s, 0), 8) AS subjectivity_mean, coalesce(n, 0) AS polarity_count
 FROM bars_ev LEFT JOIN d USING (ticker, date)""")
def r5_left(spark, sf):
    records = X.sentiment_records(table_stream(spark, sf, "documents"))
    daily = R.drain(A.daily_sentiment(records.withColumn("ts", F.col("date").cast("timestamp"))), "r5_left")
    joined = A.bars_with_sentiment(X.bars_ev(spark, sf), daily)
    return joined.select("ticker", "date", "close", *rounded(8, "polarity_mean", "subjectivity_mean"), "polarity_count")


_MIDDLE = "DATE '2024-01-15'"


def in_triggers(spark, name, table, *parts, files=4):
    """A table as a stream that delivers the rows of each part in a trigger of its own, and then the others."""
    folder, rest = fresh(spark, name), F.lit(True)
    for part in (*parts, F.lit(True)):
        table.where(rest & part).repartition(files).write.mode("append").parquet(folder)
        rest = rest & ~part
    return R.file_stream(spark, folder, table.schema, files_per_trigger=files)


@query("r5_stream_left_join", f"""WITH {S.BARS_EV}, {S.SENTIMENT},
 w AS (SELECT least((SELECT max(date) FROM bars_ev WHERE date <= {_MIDDLE}), (SELECT max(date) FROM sentiment WHERE date <= {_MIDDLE} AND ticker <> 'view')) - 1 AS first,
  least((SELECT max(date) FROM bars_ev), (SELECT max(date) FROM sentiment)) - 1 AS last),
 d AS (SELECT ticker, date, avg(polarity) AS p, avg(subjectivity) AS s, count(*) AS n FROM sentiment, w WHERE NOT (ticker = 'view' AND date + 1 <= first) GROUP BY 1, 2)
 SELECT ticker, date, close, round(coalesce(p, 0), 8) AS polarity_mean, round(coalesce(s, 0), 8) AS subjectivity_mean, coalesce(n, 0) AS polarity_count
 FROM bars_ev LEFT JOIN d USING (ticker, date), w WHERE date + 1 <= last""")
def r5_stream_join(spark, sf):
    """Two streams in three triggers; the early records of one ticker come in the last, when most of their days are closed."""
    records = X.sentiment_records(X.table(spark, sf, "documents")).select("ticker", "polarity", "subjectivity", F.col("date").cast("timestamp").alias("ts"))
    early, middle = F.expr(f"date(ts) <= {_MIDDLE}"), F.expr(f"date(ts) BETWEEN {_MIDDLE} + 1 AND {_MIDDLE} + 10")
    scores = in_triggers(spark, "r5-records", records, early & (F.col("ticker") != "view"), middle)
    bars = in_triggers(spark, "r5-bars", X.bars_ev(spark, sf).select("ticker", "date", "close"),
                       F.expr(f"date <= {_MIDDLE}"), F.expr(f"date <= {_MIDDLE} + 10"))
    joined = R.drain(A.bars_left_sentiment(bars, scores), "r5j")
    return joined.select("ticker", "date", "close", *rounded(8, "polarity_mean", "subjectivity_mean"), "polarity_count")


@query("r6_newest_predictions")
def r6(spark, sf):
    return C.newest_predictions(scored(spark, sf, "r6")).select("ticker", "model", "date", "predicted", "batch_id")


@query("r7_tick_bars", f"""WITH {S.TICKS}, b AS (SELECT ticker, date_trunc('hour', ts) AS bar_start, arg_min(price, event_id) AS open, max(price) AS high, min(price) AS low,
 arg_max(price, event_id) AS close, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_ticks FROM ticks GROUP BY 1, 2)
 SELECT ticker, bar_start, open, high, low, close, volume, n_ticks FROM b
 WHERE bar_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM ticks) - INTERVAL 10 MINUTE""")
def r7(spark, sf):
    bars = A.tick_bars(X.ticks_of(table_stream(spark, sf, "events")))
    return R.drain(bars, "r7").drop("bar_end")


_LATE = f"""{S.TICKS}, w AS (SELECT max(ts) - INTERVAL 10 MINUTE AS closed FROM ticks WHERE ticker <> 'view'),
 marked AS (SELECT ticks.*, ticker = 'view' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= closed AS late FROM ticks, w)"""


def late_views(spark, sf, name):
    """Ticks in three triggers, those of one ticker in the last, when most of their hours are closed."""
    stream = in_triggers(spark, f"{name}-ticks", X.ticks(spark, sf), F.expr(f"ticker <> 'view' AND ts < {_MIDDLE}"), F.col("ticker") != "view")
    path = fresh(spark, name)
    A.bars_and_late_ticks(stream, path, f"{path}-checkpoint", R.ALL_AVAILABLE).awaitTermination()
    return path


@query("r7_late_ticks", f"WITH {_LATE} SELECT ticker, ts, event_id, price, size FROM marked WHERE late")
def r7_late(spark, sf):
    return spark.read.parquet(f"{late_views(spark, sf, 'r7-late')}/late").select("ticker", "ts", "event_id", "price", "size")


@query("r7_bars_in_time", f"""WITH {_LATE} SELECT ticker, date_trunc('hour', ts) AS bar_start, arg_min(price, event_id) AS open, max(price) AS high, min(price) AS low,
 arg_max(price, event_id) AS close, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_ticks FROM marked WHERE NOT late GROUP BY 1, 2""")
def r7_in_time(spark, sf):
    """Bars whose ticks came over several triggers; with the late ticks they account for every row."""
    return A.merged_bars(spark.read.parquet(f"{late_views(spark, sf, 'r7-in-time')}/bars"))


@query("r7_tick_bars_batch", f"""WITH {S.TICKS} SELECT ticker, date_trunc('hour', ts) AS bar_start, arg_min(price, event_id) AS open, max(price) AS high, min(price) AS low,
 arg_max(price, event_id) AS close, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_ticks FROM ticks GROUP BY 1, 2""")
def r7_batch(spark, sf):
    return A.tick_bars(X.ticks(spark, sf)).drop("bar_end")


@query("r8_triggered_stream", "SELECT event_type AS ticker, count(*) AS n FROM events GROUP BY 1")
def r8(spark, sf):
    return R.drain(table_stream(spark, sf, "events").select(F.col("event_type").alias("ticker")), "r8").groupBy(
        "ticker").agg(F.count(F.lit(1)).alias("n"))


@query("r8_processing_time", "SELECT event_type AS ticker, count(*) AS n FROM events GROUP BY 1")
def r8_processing_time(spark, sf):
    """Several triggers on a clock, one file each."""
    stream = split_stream(spark, sf, "events").select(F.col("event_type").alias("ticker"))
    rows = R.drain(stream, "r8p", trigger={"processingTime": "200 milliseconds"})
    return rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
