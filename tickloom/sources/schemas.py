"""Declared schemas and conforming a frame to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.frames import to_number

# Column names and types of the three input tables.
STOCK = T.StructType([
    T.StructField("ticker", T.StringType(), False), T.StructField("date", T.DateType(), False),
    *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")],
    T.StructField("volume", T.LongType()), T.StructField("adj_close", T.DoubleType())])
SENTIMENT = T.StructType([
    T.StructField("ticker", T.StringType(), False), T.StructField("date", T.TimestampType(), False),
    T.StructField("source", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("polarity", T.DoubleType()), T.StructField("subjectivity", T.DoubleType()),
    T.StructField("sentiment", T.StringType())])
MACRO = T.StructType([
    T.StructField("series_id", T.StringType(), False), T.StructField("date", T.DateType(), False),
    T.StructField("value", T.DoubleType()), T.StructField("indicator_name", T.StringType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order; text that does not parse and absent columns become NULL."""
    present = {c.lower(): c for c in df.columns}

    def column(field: T.StructField) -> Column:
        source = present.get(field.name)
        if source is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(f"`{source}`")
        kind = field.dataType
        if isinstance(kind, T.LongType) and not isinstance(df.schema[source].dataType, T.IntegralType):
            value = to_number(c, "double").try_cast("bigint")
        elif isinstance(kind, T.NumericType):
            value = to_number(c, kind.simpleString())
        elif isinstance(kind, T.DateType):
            value = c.try_cast("timestamp").cast("date")
        else:
            value = c.try_cast(kind.simpleString())
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])
