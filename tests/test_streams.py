import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.streaming import aggregates as A
from tickloom.streaming import buffers as B
from tickloom.streaming import sources as R

SCHEMA = "ticker string, ts timestamp, event_id bigint, price double, size bigint"
T0 = datetime.datetime(2024, 1, 1)


def write_files(spark, folder, batches):
    """One file per batch, in name order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/b{i}")
    import pathlib
    import shutil
    import time
    flat = pathlib.Path(folder, "flat")
    flat.mkdir()
    for i in range(len(batches)):
        source = next(pathlib.Path(folder, f"b{i}").glob("*.parquet"))
        shutil.copy(source, flat / f"{i:03d}.parquet")
        time.sleep(0.05)
    return str(flat)


def ticks(ticker, start, n, minutes=1):
    return [(ticker, T0 + datetime.timedelta(minutes=minutes * (start + i)), start + i, float(start + i), 1) for i in range(n)]


def test_buffer_keeps_the_last_rows_over_batches(spark, tmp_path):
    batches = [ticks("A", 0, 30) + ticks("B", 0, 2), ticks("A", 30, 5), ticks("A", 35, 1) + ticks("B", 2, 1)]
    stream = R.file_stream(spark, write_files(spark, str(tmp_path), batches), SCHEMA, files_per_trigger=1)
    out = R.drain(B.last_rows(stream, order=["ts"], size=10, minimum=3), "buffer-test", "update", batches=True)
    last = out.groupBy("ticker").agg(F.max("batch_id").alias("batch_id"))
    got = {}
    for r in out.join(last, ["ticker", "batch_id"]).collect():
        got.setdefault(r["ticker"], []).append(r["event_id"])
    assert sorted(got["A"]) == list(range(26, 36)) and sorted(got["B"]) == [0, 1, 2]
    assert out.where("ticker = 'B' AND batch_id = 0").count() == 0


def test_trim_keeps_what_a_buffer_needs(spark):
    rows = ticks("A", 0, 500) + ticks("B", 0, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = B.trim(df, ["ticker"], ["ts"], 10)
    assert out.where("ticker = 'A'").count() <= 40 and out.where("ticker = 'B'").count() == 3
    assert {r[0] for r in out.where("ticker = 'A'").select("event_id").collect()} >= set(range(490, 500))


def test_streamed_bars_equal_the_batch_and_late_ticks_are_dropped(spark, tmp_path):
    on_time = [ticks("A", 0, 90), ticks("A", 90, 90), ticks("A", 180, 60)]
    late = [("A", T0 + datetime.timedelta(minutes=5), 999, 1e6, 1)]
    batches = [*on_time, late + ticks("A", 240, 30)]
    stream = R.file_stream(spark, write_files(spark, str(tmp_path), batches), SCHEMA, files_per_trigger=1)
    got = R.drain(A.tick_bars(stream), "bars-test").orderBy("bar_start").collect()
    flat = spark.createDataFrame([r for b in on_time for r in b] + ticks("A", 240, 30), SCHEMA)
    want = A.tick_bars(flat).orderBy("bar_start").collect()
    assert len(got) == 4 and got == want[:4]


def test_decode_drops_keyless_and_broken_messages(spark):
    rows = [("stock-data", '{"ticker":"A","price":1.5}'), ("stock-data", '{"price":2}'), ("stock-data", "{oops"),
            ("other", '{"ticker":"A","price":9}'), ("stock-data", None)]
    df = spark.createDataFrame(rows, "topic string, value string")
    kept = R.decode(df, R.STOCK_TOPIC, R.STOCK_MESSAGE).collect()
    assert [(r["ticker"], r["price"]) for r in kept] == [("A", 1.5)]
    assert R.corrupt(df, R.STOCK_TOPIC, R.STOCK_MESSAGE).count() == 3
    assert R.stamped(R.decode(df, R.STOCK_TOPIC, R.STOCK_MESSAGE)).first()["timestamp"] is not None


def test_replayed_batch_is_not_doubled(spark, tmp_path):
    stream = R.file_stream(spark, write_files(spark, str(tmp_path), [ticks("A", 0, 5)]), SCHEMA)
    out = str(tmp_path / "out")
    for run in ("c1", "c2"):
        R.write_batches(stream, out, str(tmp_path / run), R.ALL_AVAILABLE).awaitTermination()
    assert spark.read.parquet(out).count() == 5


@pytest.mark.parametrize("kind,text", [("stock", "60 seconds"), ("sentiment", "5 minutes"), ("macro", "60 minutes")])
def test_cadence(kind, text):
    assert R.polled(kind) == {"processingTime": text}


def test_worker_functions_need_no_package_on_the_worker(tmp_path):
    """What is sent to Python workers must load in a process that cannot import this package."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from pyspark.sql import types as T

    from tickloom.operators import forecast
    things = (B.newest, B.LastRows(T.StructType([]), ["k"], ["t"], 1, 1), forecast._solve, forecast._matrices)
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(things))
    code = "import pickle; print(len(pickle.load(open('f.pkl', 'rb'))))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert done.stdout.strip() == "4", done.stderr


def test_buffer_takes_late_rows_by_their_order_and_keeps_ties(spark, tmp_path):
    """Rows may come late: what counts is their order, not the trigger; rows of one time all count."""
    batches = [ticks("A", 10, 4), [*ticks("A", 0, 3), *ticks("A", 12, 1)], [*ticks("A", 11, 1), ("A", None, 77, 1.0, 1)]]
    stream = R.file_stream(spark, write_files(spark, str(tmp_path), batches), SCHEMA, files_per_trigger=1)
    out = R.drain(B.last_rows(stream, order=["ts"], size=5), "late-test", "update", batches=True).orderBy("batch_id").collect()
    by_batch = {}
    for r in out:
        by_batch.setdefault(r["batch_id"], []).append(r["event_id"])
    assert sorted(by_batch[0]) == [10, 11, 12, 13]
    assert sorted(by_batch[1]) == [10, 11, 12, 12, 13]
    assert sorted(by_batch[2]) == [11, 12, 12, 13, 77]


def test_bars_and_scores_share_a_state(spark, tmp_path):
    day = datetime.date(2024, 1, 1)
    bar_schema, record_schema = "ticker string, date date, close double", "ticker string, ts timestamp, polarity double, subjectivity double"

    def at(k, hour):
        return T0 + datetime.timedelta(days=k, hours=hour)
    bars = [[("A", day, 1.0), ("B", day, 5.0)], [("A", day + datetime.timedelta(1), 2.0)], [("A", day + datetime.timedelta(2), 3.0)]]
    records = [[("A", at(0, 1), 0.5, 0.2), ("A", at(0, 2), 0.1, None), ("C", at(0, 2), 1.0, 1.0)], [("A", at(1, 3), -1.0, 0.4)], [("A", at(9, 3), 1.0, 1.0)]]

    def files(name, schema, batches):
        import pathlib
        import shutil
        import time
        folder = tmp_path / name
        (folder / "flat").mkdir(parents=True)
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"b{i}"))
            shutil.copy(next(pathlib.Path(folder, f"b{i}").glob("*.parquet")), folder / "flat" / f"{i}.parquet")
            time.sleep(0.05)
        return R.file_stream(spark, str(folder / "flat"), schema, files_per_trigger=1)
    joined = B.bars_and_scores(files("bars", bar_schema, bars), files("records", record_schema, records), size=2, records_size=3, minimum=1)
    out = R.drain(joined, "two-inputs", "update", batches=True)
    newest = sorted(tuple(r) for r in B.newest_buffers(out).select("ticker", "date", "close", "polarity_mean", "subjectivity_mean").collect())
    one, two = day + datetime.timedelta(1), day + datetime.timedelta(2)
    assert newest == [("A", one, 2.0, -1.0, 0.4), ("A", two, 3.0, 0.0, 0.0), ("B", day, 5.0, 0.0, 0.0)]
    first = {r["polarity_mean"] for r in out.where("batch_id = 0 AND ticker = 'A'").collect()}
    assert len(first) == 1 and abs(first.pop() - 0.3) < 1e-12


def test_documents_are_read_newest_batch_first(spark, tmp_path):
    from tickloom.streaming import scoring as C
    schema = "ticker string, model string, step int, forecast_date date, predicted double, scored_at timestamp"
    day = datetime.date(2024, 1, 1)

    def rows(value, tickers):
        return spark.createDataFrame([(t, m, k, day + datetime.timedelta(k), value + k, T0) for t in tickers for m in ("x", "y") for k in (1, 2)], schema)
    out = str(tmp_path / "docs")
    for batch, (value, tickers) in enumerate([(0.0, "AB"), (10.0, "A")]):
        C.prediction_documents(rows(value, tickers), 2).write.parquet(f"{out}/batch_id={batch}")
    got = C.flat_documents(C.newest_documents(spark.read.parquet(out))).collect()
    assert {(r["ticker"], r["model"], r["forecast_date"].day): r["predicted"] for r in got} == {
        (t, m, 1 + k): (10.0 if t == "A" else 0.0) + k for t in "AB" for m in "xy" for k in (1, 2)}


def test_late_ticks_and_bars_account_for_every_row(spark, tmp_path):
    late = [("A", T0 + datetime.timedelta(minutes=5), 999, 1e6, 1), ("B", T0 + datetime.timedelta(minutes=150), 998, 7.0, 2)]
    batches = [ticks("A", 0, 90), ticks("A", 90, 90), late + ticks("A", 180, 60) + [("A", None, 1000, 1.0, 1)], ticks("A", 240, 1)]
    stream = R.file_stream(spark, write_files(spark, str(tmp_path), batches), SCHEMA, files_per_trigger=1)
    out = str(tmp_path / "out")
    for run in ("c1", "c2"):
        A.bars_and_late_ticks(stream, out, str(tmp_path / run), R.ALL_AVAILABLE).awaitTermination()
    assert [r["event_id"] for r in spark.read.parquet(f"{out}/late").collect()] == [999]
    bars = {(r["ticker"], r["bar_start"]): r for r in A.merged_bars(spark.read.parquet(f"{out}/bars")).collect()}
    want = A.tick_bars(spark.createDataFrame([r for b in batches for r in b if r[2] not in (999, 1000)], SCHEMA)).drop("bar_end").collect()
    assert bars == {(r["ticker"], r["bar_start"]): r for r in want}


def test_bars_wait_for_the_records_of_their_day(spark, tmp_path):
    """A bar of a closed day without records leaves as missing; records that come after that change nothing."""
    from tickloom.plans.streams import in_triggers
    day = datetime.date(2024, 1, 1)
    bars = spark.createDataFrame([("A", day + datetime.timedelta(k), float(k)) for k in range(12)], "ticker string, date date, close double")
    at = [0, 1, 1, 3, 6, 7, 9, 11, 1]
    records = spark.createDataFrame([("A", T0 + datetime.timedelta(days=k, hours=i), float(i), 0.5, i) for i, k in enumerate(at)],
                                    "ticker string, ts timestamp, polarity double, subjectivity double, i int")
    left = in_triggers(spark, "bars-test", bars, F.col("close") <= 5, F.col("close") <= 9, files=1)
    right = in_triggers(spark, "records-test", records, F.expr("date(ts) <= '2024-01-06' and i < 8"), F.expr("i < 7"), files=1).drop("i")
    got = {r["close"]: (r["polarity_mean"], r["polarity_count"]) for r in R.drain(A.bars_left_sentiment(left, right), "left-join").collect()}
    assert got == {0.0: (0.0, 1), 1.0: (1.5, 2), 2.0: (0.0, 0), 3.0: (3.0, 1), 4.0: (0.0, 0), 5.0: (0.0, 0), 6.0: (4.0, 1), 7.0: (5.0, 1), 8.0: (0.0, 0), 9.0: (6.0, 1)}


def test_a_table_streams_from_a_folder_of_files_as_from_one_file(spark, tmp_path):
    from tickloom.plans.streams import table_stream
    rows = spark.range(40)
    rows.repartition(3).write.parquet(f"{tmp_path}/many/documents.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    next(tmp_path.glob("one/part-*.parquet")).rename(tmp_path / "one/documents.parquet")
    for folder in ("many", "one", "one/"):
        got = R.drain(table_stream(spark, f"{tmp_path}/{folder}", "documents"), "table-test").collect()
        assert sorted(r["id"] for r in got) == list(range(40)), folder


def test_streamed_sentiment_of_folders_equals_that_of_files(spark, tmp_path):
    from tickloom.plans.streams import r5
    events = spark.range(300).selectExpr("id event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, id % 30) ts", "id user_id",
                                         "element_at(array('click', 'error', 'purchase', 'signup', 'view'), int(id % 5 + 1)) event_type", "double(id) value", "'{\"k\": 1}' props")
    documents = spark.range(300).selectExpr("id doc_id", "'x' text", "'en' lang", "'s' source", "1L n_chars")
    for name, rows in (("events", events), ("documents", documents)):
        rows.repartition(3).write.parquet(f"{tmp_path}/many/{name}.parquet")
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        (tmp_path / "one").mkdir(exist_ok=True)
        next(tmp_path.glob(f"{name}/part-*.parquet")).rename(tmp_path / f"one/{name}.parquet")
    many, one = ({tuple(r) for r in r5(spark, f"{tmp_path}/{folder}").collect()} for folder in ("many", "one"))
    assert many and many == one
