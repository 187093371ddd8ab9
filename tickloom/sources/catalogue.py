"""Small reference tables: the macro indicator catalogue and keyword lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Macro series id, indicator name, frequency.
MACRO_CATALOGUE = [
    ("GDP", "Gross Domestic Product", "Quarterly"),
    ("UNRATE", "Unemployment Rate", "Monthly"),
    ("CPIAUCSL", "Consumer Price Index", "Monthly"),
    ("FEDFUNDS", "Federal Funds Rate", "Monthly"),
    ("INDPRO", "Industrial Production Index", "Monthly"),
    ("HOUST", "Housing Starts", "Monthly"),
    ("PCE", "Personal Consumption Expenditures", "Monthly"),
    ("RETAIL", "Retail Sales", "Monthly"),
    ("M2", "M2 Money Stock", "Weekly"),
]

# Search terms per ticker.
TICKER_KEYWORDS = {
    "AAPL": ["Apple", "iPhone", "MacBook", "Tim Cook", "$AAPL"],
    "MSFT": ["Microsoft", "Windows", "Azure", "Satya Nadella", "$MSFT"],
    "GOOG": ["Google", "Alphabet", "Android", "Sundar Pichai", "$GOOG"],
    "AMZN": ["Amazon", "AWS", "Jeff Bezos", "Andy Jassy", "$AMZN"],
    "META": ["Meta", "Facebook", "Instagram", "Mark Zuckerberg", "$META"],
}


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A configuration-sized table inside the plan, so that join planning knows its real size."""
    names = [part.split()[0] for part in schema.split(",")]
    literals = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows])
    inlined = spark.range(1).select(F.inline(literals).alias(*names))
    return inlined.select(*[F.col(n).cast(part.split()[1]).alias(n) for n, part in zip(names, schema.split(","))])


def indicator_catalogue(spark: SparkSession, rename: Mapping[str, str] | None = None) -> DataFrame:
    """The catalogue; ``rename`` maps a table's own series ids to catalogue ids."""
    ids = rename or {row[0]: row[0] for row in MACRO_CATALOGUE}
    rows = {row[0]: row for row in MACRO_CATALOGUE}
    return small_table(spark, [(own, rows[i][1], rows[i][2]) for own, i in ids.items()],
                       "series_id string, indicator_name string, frequency string")


def keyword_table(spark: SparkSession, keywords: Mapping[str, Sequence[str]] = TICKER_KEYWORDS) -> DataFrame:
    return small_table(spark, [(t, k) for t, ks in keywords.items() for k in ks], "ticker string, keyword string")
