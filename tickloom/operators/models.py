"""Spark ML estimators over feature panels: training, scoring, persistence, stacking, comparison."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.evaluate import classification_metrics, regression_metrics
from tickloom.operators.frames import numeric_columns

# The standard settings of each model.
DEFAULTS = {
    "random_forest": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "gradient_boosted": {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "seed": 42},
    "linear": {"maxIter": 100, "regParam": 0.0},
}
_ESTIMATORS = {
    ("random_forest", "regression"): RandomForestRegressor, ("random_forest", "classification"): RandomForestClassifier,
    ("gradient_boosted", "regression"): GBTRegressor, ("gradient_boosted", "classification"): GBTClassifier,
    ("linear", "regression"): LinearRegression, ("linear", "classification"): LogisticRegression,
}


def estimator(kind: str, task: str, label: str = "label", **settings) -> Estimator:
    return _ESTIMATORS[kind, task](featuresCol="features", labelCol=label, **{**DEFAULTS[kind], **settings})


def assembler(features: Sequence[str]) -> VectorAssembler:
    """Rows with a NULL feature are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def training_frame(df: DataFrame, features: Sequence[str] | None = None, target: str = "target_direction",
                   keep: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """Assembled feature vector and ``label``; every ``target`` column is kept out of the features."""
    names = list(features or numeric_columns(df))
    return assembler(names).transform(df).select(*keep, "features", F.col(target).alias("label"))


def pipeline(kind: str, task: str, features: Sequence[str], label: str = "label", **settings) -> Pipeline:
    return Pipeline(stages=[assembler(features), estimator(kind, task, label, **settings)])


def principal_components(df: DataFrame, features: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """Columns ``PCA_1..k`` of the standardised features; targets are excluded."""
    names = list(features or numeric_columns(df))
    stages = [assembler(names), StandardScaler(inputCol="features", outputCol="__scaled", withMean=True, withStd=True),
              PCA(k=min(k, len(names)), inputCol="__scaled", outputCol="__pca")]
    model = Pipeline(stages=stages).fit(df)
    out = model.transform(df).withColumn("__pca", vector_to_array("__pca"))
    return out.select(*df.columns, *[F.col("__pca")[i].alias(f"PCA_{i + 1}") for i in range(min(k, len(names)))])


def score(model: PipelineModel, df: DataFrame, classify: bool = False) -> DataFrame:
    out = model.transform(df)
    if classify:
        out = out.withColumn("score", vector_to_array("probability")[1])
    return out.drop("features", "rawPrediction", "probability")


def importance(model: PipelineModel, features: Sequence[str], top: int = 20) -> DataFrame:
    """Importances, or absolute coefficients of a linear model, largest first. Sized by the features."""
    spark = SparkSession.active()
    fitted = model.stages[-1]
    values = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    rows = list(zip(features, [float(v) for v in values.toArray()]))
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.abs("importance").desc(), "feature").limit(top))


def save_model(model: PipelineModel, path: str, features: Sequence[str], label: str, **notes) -> None:
    """The fitted pipeline and one metadata row beside it."""
    model.write().overwrite().save(f"{path}/model")
    meta = json.dumps({"features": list(features), "label": label, **notes})
    SparkSession.active().sql("SELECT :meta AS value", {"meta": meta}).write.mode("overwrite").text(f"{path}/metadata")


def load_model(path: str) -> tuple[PipelineModel, dict]:
    meta = SparkSession.active().read.text(f"{path}/metadata").first()
    return PipelineModel.load(f"{path}/model"), json.loads(meta[0])


def fold_of(keys: Sequence[str], folds: int):
    return F.pmod(F.xxhash64(*keys), F.lit(folds))


def stack(train: DataFrame, test: DataFrame, bases: Mapping[str, Pipeline], task: str = "regression",
          label: str = "label", keys: Sequence[str] = ("ticker", "date"), folds: int = 3, alpha: float = 1.0) -> DataFrame:
    """Base models scored out of fold, and a ridge or logistic model on their predictions.

    A fold is a hash of the row's key, so it does not depend on partitioning. ``alpha`` is
    the weight of the squared coefficients in the sum of squares.
    """
    keys = list(keys)
    out = "prediction" if task == "regression" else "score"

    def predict(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
        return score(model, rows, task != "regression").select(*keys, label, F.col(out).alias("__v"), F.lit(name).alias("__m"))

    oof, final = None, None
    for name, base in bases.items():
        for k in range(folds):
            part = predict(base.fit(train.where(fold_of(keys, folds) != k)), train.where(fold_of(keys, folds) == k), name)
            oof = part if oof is None else oof.unionByName(part)
        whole = predict(base.fit(train), test, name)
        final = whole if final is None else final.unionByName(whole)

    def wide(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, label).pivot("__m", list(bases)).agg(F.max("__v"))

    meta_features = list(bases)
    level_one = wide(oof).cache()
    if task == "regression":
        n = max(level_one.count(), 1)
        meta = LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=0.0, regParam=alpha / n,
                                standardization=False)
    else:
        meta = LogisticRegression(featuresCol="features", labelCol=label)
    model = Pipeline(stages=[assembler(meta_features), meta]).fit(level_one)
    level_one.unpersist()
    return score(model, wide(final), task != "regression")


def compare(train: DataFrame, test: DataFrame, candidates: Mapping[str, Pipeline], task: str = "regression",
            label: str = "label") -> DataFrame:
    """Metrics with fit and score seconds per model; one row per model."""
    table = None
    for name, candidate in candidates.items():
        begun = time.perf_counter()
        model = candidate.fit(train)
        fitted = time.perf_counter()
        scored = score(model, test, task != "regression")
        if task == "regression":
            metrics = regression_metrics(scored, [], label, "prediction")
        else:
            metrics = classification_metrics(scored, [], label, "prediction")
        row = metrics.first().asDict()
        took = {"fit_seconds": fitted - begun, "score_seconds": time.perf_counter() - fitted}
        one = SparkSession.active().sql(
            "SELECT " + ", ".join(f":{k} AS {k}" for k in ("model", *row, *took)), {"model": name, **row, **took})
        table = one if table is None else table.unionByName(one)
    return table
