"""Row selection and NULL policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tickloom.operators import panel as P


def standardise_ohlcv(df: DataFrame, required: Sequence[str] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """Lower-case column names with underscores; raise when a required one is missing."""
    names = {c: c.strip().lower().replace(" ", "_") for c in df.columns}
    missing = sorted(set(required) - set(names.values()))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def to_number(x: str | Column, kind: str = "double") -> Column:
    """A number, or NULL where the text is not one."""
    c = F.col(x) if isinstance(x, str) else x
    return F.trim(c.cast("string")).try_cast(kind)


def date_range(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def lookback_slice(df: DataFrame, window: int = 30, day=None, panel: P.Panel = P.BARS) -> DataFrame:
    """Rows in ``[d - window, d]``; d is each key's last date when not given."""
    if day is not None:
        d = F.lit(day).cast("date")
        return df.where(F.col("date").between(F.date_sub(d, window), d))
    dated = P.attach_per_key(df, panel, [F.max("date").alias("__d")])
    return dated.where(F.col("date") >= F.date_sub("__d", window)).drop("__d")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("ticker", "date", "pos")) -> list[str]:
    """Numeric columns other than keys and every ``target``; reads the schema only."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
            and f.name not in exclude and not f.name.startswith("target")]


def null_loss(df: DataFrame, subset: Sequence[str], keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """Rows before and after dropping NULLs in ``subset``, and the share lost, in one aggregate."""
    whole = F.lit(True)
    for c in subset:
        whole = whole & F.col(c).isNotNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(whole).alias("n_kept"))
            .withColumn("loss", 1 - F.col("n_kept") / F.col("n_rows")))


def handle_missing(df: DataFrame, method: str = "ffill", columns: Sequence[str] | None = None,
                   panel: P.Panel = P.BARS) -> DataFrame:
    """``ffill``, ``bfill``, ``interpolate`` or ``drop`` on the columns (default: all numeric ones)."""
    names = list(columns or numeric_columns(df))
    if method == "drop":
        return df.na.drop(subset=names)
    fills = {"ffill": P.forward_fill, "bfill": P.backward_fill, "interpolate": P.interpolate}
    if method not in fills:
        raise ValueError(f"unknown method {method!r}; use one of {sorted([*fills, 'drop'])}")
    return fills[method](df, panel, names)


def preprocess(df: DataFrame, fill: str | None = "ffill", drop: bool = True, columns: Sequence[str] | None = None,
               panel: P.Panel = P.BARS) -> DataFrame:
    """Fill, set what is left to 0, then drop rows that still have a NULL."""
    names = list(columns or numeric_columns(df))
    if fill:
        df = handle_missing(df, fill, names, panel).na.fill(0, names)
    return df.na.drop() if drop else df


def latest_rows(df: DataFrame, k: int, keys: Sequence[str] = ("ticker",), order: str = "date",
                rank: str = "rank_latest") -> DataFrame:
    """The last k rows per key; the rank limit is applied before the shuffle as well."""
    w = W.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def latest_record(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """One row per key, the newest; a partial aggregate rather than a window.

    Rows of fixed-width columns are kept column by column, which Spark aggregates by hash;
    a struct or text buffer would make it sort the input.
    """
    rest = [f for f in df.schema.fields if f.name not in keys]
    if all(isinstance(f.dataType, _FIXED_WIDTH) for f in rest):
        return df.groupBy(*keys).agg(*[F.max_by(f.name, time).alias(f.name) for f in rest]).select(*df.columns)
    names = [f.name for f in rest]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*names), F.col(time)).alias("__r"))
    return newest.select(*keys, *[F.col("__r")[c].alias(c) for c in names])


def recent_table(df: DataFrame, k: int = 20) -> DataFrame:
    """The newest rows as display text: ISO dates and two decimals."""
    top = latest_rows(df, k)
    prices = [F.format_string("%.2f", c).alias(c) for c in ("open", "high", "low", "close")]
    return top.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("date"), *prices,
                      F.col("volume").cast("string").alias("volume"))
