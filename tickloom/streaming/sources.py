"""Stream sources, message decoding, triggers, and running a stream into a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.session import shared_root

# Topic names, message fields and polling cadences.
STOCK_TOPIC, SENTIMENT_TOPIC, MACRO_TOPIC = "stock-data", "sentiment-data", "economic-data"
STOCK_MESSAGE = "ticker string, price double, timestamp timestamp"
BAR_MESSAGE = "ticker string, date date, open double, high double, low double, close double, volume bigint"
SENTIMENT_MESSAGE = "ticker string, sentiment string, score double, text string, timestamp timestamp"
MACRO_MESSAGE = "series_id string, date date, value double, timestamp timestamp"
CADENCE = {"stock": "60 seconds", "sentiment": "5 minutes", "macro": "60 minutes"}


def topic_stream(spark: SparkSession, topics: str | Sequence[str], servers: str, latest: bool = True) -> DataFrame:
    """Subscribe to one or many topics; needs the Kafka connector on the classpath."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", names)
           .option("startingOffsets", "latest" if latest else "earliest").load())
    return raw.select("topic", F.col("key").cast("string"), F.col("value").cast("string"))


def file_stream(spark: SparkSession, folder: str, schema: T.StructType | str, fmt: str = "parquet",
                glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def _parsed(messages: DataFrame, topic: str, schema: str) -> DataFrame:
    """The messages of a topic with ``m``, their fields as text: a number that is not one makes no message unreadable."""
    fields = T._parse_datatype_string(schema).names
    texts = ", ".join(f"`{n}` string" for n in [*fields, "_corrupt"])
    parsed = F.from_json("value", texts, {"columnNameOfCorruptRecord": "_corrupt"})
    return messages.where(F.col("topic") == topic).withColumn("m", parsed)


def _typed(schema: str) -> list[Column]:
    fields = T._parse_datatype_string(schema).fields
    return [F.col(f"m.`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields]


def _readable(schema: str, key: str) -> Column:
    typed = dict(zip(T._parse_datatype_string(schema).names, _typed(schema)))
    return F.coalesce(F.col("m._corrupt").isNull() & typed[key].isNotNull(), F.lit(False))


def decode(messages: DataFrame, topic: str, schema: str, key: str = "ticker") -> DataFrame:
    """Typed rows of one topic; messages without a key or with text that is not JSON are dropped.

    A field whose text is not of its type is NULL, as in files.
    """
    rows = _parsed(messages, topic, schema)
    return rows.where(_readable(schema, key)).select(_typed(schema))


def corrupt(messages: DataFrame, topic: str, schema: str, key: str = "ticker") -> DataFrame:
    """The messages that :func:`decode` drops, for inspection."""
    return _parsed(messages, topic, schema).where(~_readable(schema, key)).select(messages.columns)


def stamped(rows: DataFrame, column: str = "timestamp") -> DataFrame:
    """The arrival time where the message has none."""
    return rows.withColumn(column, F.coalesce(column, F.current_timestamp()))


def polled(kind: str) -> dict[str, str]:
    """Trigger settings of a polling cadence."""
    return {"processingTime": CADENCE[kind]}


ALL_AVAILABLE = {"availableNow": True}


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state on local disk with incremental checkpoints, not in executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def write_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict, mode: str = "append") -> StreamingQuery:
    """Append to Parquet with exactly-once commits."""
    return (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def write_batches(stream: DataFrame, path: str, checkpoint: str, trigger: dict, mode: str = "append",
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """One folder per batch, overwritten when a batch is replayed, so results are exactly once.

    A transform may read its batch several times, so the batch is kept for as long as it runs.
    """
    def save(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        if transform is None:
            batch.write.mode("overwrite").parquet(target)
            return
        kept = batch.persist()
        try:
            transform(kept).write.mode("overwrite").parquet(target)
        finally:
            kept.unpersist()
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**trigger)
            .foreachBatch(save).start())


def write_topic(messages: DataFrame, topic: str, servers: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Send (key, value) messages to a Kafka topic; needs the connector on the classpath."""
    return (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def drain(stream: DataFrame, name: str, mode: str = "append",
          transform: Callable[[DataFrame], DataFrame] | None = None, batches: bool = False,
          trigger: dict | None = None) -> DataFrame:
    """Process everything available and return the written table.

    A stream under a ``processingTime`` trigger is stopped once all that is there has been processed.
    """
    spark = stream.sparkSession
    root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    write = write_batches if batches or transform else write_stream
    args = {"transform": transform} if transform else {}
    query = write(stream, f"{root}/out", f"{root}/checkpoint", trigger or ALL_AVAILABLE, mode, **args)
    if trigger and "processingTime" in trigger:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    else:
        query.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def json_messages(rows: DataFrame, topic: str | Column) -> DataFrame:
    """Rows as (topic, value) messages."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    return rows.select(name.alias("topic"), F.to_json(F.struct("*")).alias("value"))
