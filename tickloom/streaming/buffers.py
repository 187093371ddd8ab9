"""The last n rows per key, kept as keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.streaming.sources import use_rocksdb

# Buffer sizes and the rows needed before scoring.
BARS_KEPT, RECORDS_KEPT, BARS_NEEDED = 200, 1000, 60
#: Rows that a task holds while trimming; passing rows on earlier changes no result.
_FLUSH_ROWS = 200_000


def newest(rows: pa.Table, keys: Sequence[str], order: Sequence[str], size: int) -> pa.Table:
    """The last ``size`` rows of each key by ``order``; rows that tie keep their order, NULLs count as newest."""
    places = pa.array(np.arange(rows.num_rows))
    by = [(c, "ascending") for c in (*keys, *order, "__place")]
    rows = rows.append_column("__place", places).sort_by(by)
    codes = [rows.column(c).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for c in keys]
    changed = np.zeros(max(rows.num_rows - 1, 0), bool)
    for code in codes:
        changed |= code[1:] != code[:-1]
    ends = np.flatnonzero(np.concatenate((changed, [True])) if rows.num_rows else changed)
    left = ends[np.searchsorted(ends, np.arange(rows.num_rows))] - np.arange(rows.num_rows)
    return rows.filter(pa.array(left < size)).drop_columns(["__place"])


def trim(stream: DataFrame, keys: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """Drop rows that cannot be among the last ``size`` of their key, inside each input task.

    A hot key then sends at most ``size`` rows per task to its state. Memory is bounded by
    passing the kept rows on when they grow, which only trims less.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            kept = newest(rows if kept is None else pa.concat_tables([kept, rows]), keys, order, size)
            if kept.num_rows > _FLUSH_ROWS:
                yield from kept.combine_chunks().to_batches()
                kept = None
        if kept is not None:
            yield from kept.combine_chunks().to_batches()
    return stream.mapInArrow(run, stream.schema)


def newest_buffers(stored: DataFrame, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """The buffer of each key's latest trigger, from the batch folders that the buffers were written to."""
    latest = stored.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
    return stored.join(latest, [*keys, "batch_id"], "left_semi")


class Held:
    """Rows in a map state by their order and arrival; a row is written once and removed once.

    A trigger reads the keys, writes the new rows that stay and removes the old ones that leave, so writes follow the new
    rows and not the buffer.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, schema: T.StructType, order: Sequence[str], size: int):
        places = T.StructType([*(schema[c] for c in order), T.StructField("__n", T.LongType())])
        self.rows, self.arrived = handle.getMapState(name, places, schema), handle.getValueState(f"{name}_n", T.StructType([places["__n"]]))
        self.names, self.order, self.size = schema.names, [schema.names.index(c) for c in order], size

    @staticmethod
    def _rank(place: tuple) -> tuple:
        return tuple((v is None, v) if v is not None else (True, 0) for v in place)

    def add(self, rows: list[tuple]) -> None:
        n = self.arrived.get()[0] if self.arrived.exists() else 0
        places = {(*(r[k] for k in self.order), n + i): r for i, r in enumerate(rows)}
        self.arrived.update((n + len(rows),))
        old = {tuple(k) for k in self.rows.keys()}
        stays = set(sorted(old | set(places), key=self._rank)[-self.size:])
        for place in old - stays:
            self.rows.removeKey(place)
        for place, row in places.items():
            if place in stays:
                self.rows.updateValue(place, row)

    def all(self) -> list[tuple]:
        """The rows in order."""
        return [tuple(row) for _, row in sorted(((tuple(k), v) for k, v in self.rows.iterator()), key=lambda x: self._rank(x[0]))]


def plain_rows(chunk: pd.DataFrame, schema: T.StructType) -> list[tuple]:
    """Rows as Python values of the schema's types, missing ones as None."""
    columns = []
    for f in schema.fields:
        values = chunk[f.name]
        if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            columns.append([None if pd.isna(v) else pd.Timestamp(v).to_pydatetime() for v in values])
        elif isinstance(f.dataType, T.IntegralType):
            columns.append([None if pd.isna(v) else int(v) for v in values])
        elif isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType):
            columns.append([None if v is None or v is pd.NA else float(v) for v in values])
        else:
            columns.append([None if v is None or v is pd.NaT else v for v in values])
    return list(zip(*columns))


class LastRows(StatefulProcessor):
    """State: the key's last rows in order. Emits the whole buffer once it holds ``minimum`` rows."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str], size: int, minimum: int):
        self.schema, self.keys, self.order, self.size, self.minimum = schema, keys, order, size, minimum

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = Held(handle, "rows", self.schema, self.order, self.size)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [r for chunk in rows for r in plain_rows(chunk, self.schema)]
        if not new:
            return
        self.held.add(new)
        kept = self.held.all()
        if len(kept) >= self.minimum:
            yield pd.DataFrame(kept, columns=self.schema.names)

    def close(self) -> None:
        pass


def last_rows(stream: DataFrame, keys: Sequence[str] = ("ticker",), order: Sequence[str] = ("date",),
              size: int = BARS_KEPT, minimum: int = 1) -> DataFrame:
    """Each trigger emits the current buffer of every key that got new rows."""
    use_rocksdb(stream.sparkSession)
    trimmed = trim(stream, keys, order, size)
    processor = LastRows(stream.schema, list(keys), list(order), size, minimum)
    return trimmed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=stream.schema, outputMode="Update", timeMode="None")


#: What a record adds to the bars of its day.
SCORES = ("polarity", "subjectivity")


class BarsAndScores(StatefulProcessor):
    """Two inputs in one key's state: its last bars and its last sentiment records.

    A trigger with new bars emits the buffered bars with the mean scores of the records buffered for their day, 0 where there
    are none, once there are ``minimum`` bars. Records alone emit nothing; they count at the next bar.
    """

    def __init__(self, bars: T.StructType, records: T.StructType, out: T.StructType, size: int, records_size: int, minimum: int):
        self.bars, self.records, self.out = bars, records, out
        self.size, self.records_size, self.minimum = size, records_size, minimum

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = Held(handle, "bars", self.bars, ["date"], self.size)
        self.scored = Held(handle, "records", self.records, ["ts"], self.records_size)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bars, records = [], []
        for chunk in rows:
            is_bar = chunk["is_bar"].astype(bool)
            bars += plain_rows(chunk[is_bar], self.bars)
            records += plain_rows(chunk[~is_bar], self.records)
        if records:
            self.scored.add(records)
        if not bars:
            return
        self.held.add(bars)
        kept = self.held.all()
        if len(kept) < self.minimum:
            return
        out = pd.DataFrame(kept, columns=self.bars.names)
        daily = pd.DataFrame(self.scored.all(), columns=self.records.names)
        daily = daily.assign(date=[ts.date() for ts in daily["ts"]])
        means = daily.groupby("date")[list(SCORES)].mean().rename(columns={c: f"{c}_mean" for c in SCORES})
        out = out.merge(means, how="left", left_on="date", right_index=True)
        yield out.fillna({f"{c}_mean": 0.0 for c in SCORES})[self.out.names]

    def close(self) -> None:
        pass


def bars_and_scores(bars: DataFrame, records: DataFrame, size: int = BARS_KEPT, records_size: int = RECORDS_KEPT,
                    minimum: int = BARS_NEEDED) -> DataFrame:
    """Streams of bars (ticker, date, ...) and sentiment records (ticker, ts, scores) meet in one keyed state.

    Both are trimmed before the shuffle. Emits every ticker's bar buffer with ``polarity_mean`` and ``subjectivity_mean``.
    """
    use_rocksdb(bars.sparkSession)
    records = records.select("ticker", F.col("ts").cast("timestamp").alias("ts"), *(F.col(c).cast("double").alias(c) for c in SCORES))
    kept = trim(bars, ["ticker"], ["date"], size), trim(records, ["ticker"], ["ts"], records_size)
    union = kept[0].withColumn("is_bar", F.lit(True)).unionByName(kept[1].withColumn("is_bar", F.lit(False)), allowMissingColumns=True)
    out = T.StructType([*bars.schema.fields, *(T.StructField(f"{c}_mean", T.DoubleType()) for c in SCORES)])
    processor = BarsAndScores(bars.schema, records.schema, out, size, records_size, minimum)
    return union.groupBy("ticker").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Update", timeMode="None")
