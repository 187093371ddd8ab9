"""Scoring buffered bars with fitted models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import panel as P
from tickloom.operators.forecast import iterated_forecast
from tickloom.operators.frames import latest_record
from tickloom.operators.indicators import Indicator, compute
from tickloom.operators.models import score
from tickloom.streaming.buffers import BARS_KEPT


def scorer(models: Mapping[str, PipelineModel], indicators: Sequence[Indicator],
           panel: P.Panel = P.BARS) -> Callable[[DataFrame], DataFrame]:
    """A batch function: buffers in, one prediction per ticker and model out.

    Features are recomputed on the buffers, which hold a bounded number of rows per ticker,
    and only the newest row of each ticker is scored.
    """
    def run(buffers: DataFrame) -> DataFrame:
        features = compute(P.number_rows(buffers, panel), list(indicators), panel)
        newest = latest_record(features, list(panel.keys), panel.order[0])
        out = None
        for name, model in models.items():
            one = score(model, newest).select(*panel.keys, *panel.order, "close", F.lit(name).alias("model"),
                                              F.col("prediction").alias("predicted"))
            out = one if out is None else out.unionByName(one)
        return out.withColumn("scored_at", F.current_timestamp())
    return run


def newest_predictions(stored: DataFrame) -> DataFrame:
    """The prediction of the latest batch per ticker and model."""
    return latest_record(stored, ["ticker", "model"], "batch_id")


def forecaster(models: Mapping[str, PipelineModel], indicators: Sequence[Indicator], horizon: int = 5,
               unknown: Mapping[str, Column] | None = None, panel: P.Panel = P.BARS) -> Callable[[DataFrame], DataFrame]:
    """A batch function: buffers in, ``horizon`` predictions per ticker and model out.

    Buffers hold a bounded number of rows per ticker; features are made from them again after every predicted bar.
    """
    def run(buffers: DataFrame) -> DataFrame:
        ahead = iterated_forecast(buffers, models, indicators, horizon, BARS_KEPT, unknown=unknown, panel=panel)
        return ahead.withColumn("scored_at", F.current_timestamp())
    return run


def prediction_documents(forecasts: DataFrame, horizon: int) -> DataFrame:
    """One nested document per ticker: its time, the horizon, and by model and date what is predicted."""
    by_date = F.map_from_entries(F.sort_array(F.collect_list(F.struct(
        F.col("forecast_date").cast("string").alias("date"), F.struct(F.col("predicted").alias("predicted_close")).alias("values")))))
    models = forecasts.groupBy("ticker", "model").agg(F.max("scored_at").alias("timestamp"), by_date.alias("days"))
    return models.groupBy("ticker").agg(
        F.max("timestamp").alias("timestamp"), F.lit(horizon).alias("prediction_horizon"),
        F.map_from_entries(F.collect_list(F.struct("model", "days"))).alias("predictions"))


def newest_documents(stored: DataFrame) -> DataFrame:
    """Each ticker's document of its latest batch; a batch that ran again has replaced its own documents."""
    return latest_record(stored, ["ticker"], "batch_id")


def flat_documents(documents: DataFrame) -> DataFrame:
    """A row per ticker, model and date."""
    models = documents.select("ticker", "prediction_horizon", F.explode("predictions").alias("model", "days"))
    days = models.select("ticker", "prediction_horizon", "model", F.explode("days").alias("day", "values"))
    return days.select("ticker", "prediction_horizon", "model", F.col("day").cast("date").alias("forecast_date"),
                       F.col("values.predicted_close").alias("predicted"))
