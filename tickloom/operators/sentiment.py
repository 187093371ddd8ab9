"""Lexicon scoring of text records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import sentiment_label, tokens
from tickloom.operators.aggregates import daily_sentiment_profile


def score_text(records: DataFrame, lexicon: DataFrame, text: str = "text", keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Mean polarity and subjectivity of the known words per record; 0 and 0 when there is none.

    Only keys and words leave the scan, and a record's words are averaged on the map side
    before the shuffle. The lexicon is broadcast only if Spark measures it as small.
    """
    keys = list(keys)
    words = records.select(*keys, F.explode(tokens(F.coalesce(F.col(text), F.lit("")))).alias("word"))
    hits = words.join(lexicon, "word", "left")
    means = hits.groupBy(*keys).agg(F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity"))
    filled = means.na.fill(0.0, ["polarity", "subjectivity"])
    return filled.withColumn("sentiment", sentiment_label("polarity"))


def daily_text_sentiment(records: DataFrame, lexicon: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Records with ticker, date and text, scored and profiled per ticker and day."""
    return daily_sentiment_profile(score_text(records, lexicon, text, [key, "ticker", "date"]))
