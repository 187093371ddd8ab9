"""Model evaluation as aggregates over tables of predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickloom.operators import panel as P


def regression_metrics(df: DataFrame, keys: Sequence[str], y: str = "actual", p: str = "predicted") -> DataFrame:
    """MSE, RMSE, MAE and R² in one aggregate."""
    error = F.col(y) - F.col(p)
    both = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    sums = both.groupBy(*keys).agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
                                   F.var_pop(y).alias("__v"), F.count(F.lit(1)).alias("n"))
    return sums.select(*keys, "n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                       (1 - F.try_divide(F.col("mse"), F.col("__v"))).alias("r2"))


def classification_metrics(df: DataFrame, keys: Sequence[str] = (), label: str = "label",
                           prediction: str = "prediction") -> DataFrame:
    """Accuracy and precision, recall, F1 weighted by the true class, from the confusion counts."""
    keys = list(keys)
    confusion = df.groupBy(*keys, F.col(label).alias("__y"), F.col(prediction).alias("__p")).agg(
        F.count(F.lit(1)).alias("__n"))
    hit = F.when(F.col("__y") == F.col("__p"), F.col("__n")).otherwise(F.lit(0))
    sides = F.array(F.struct(F.col("__y").alias("c"), F.col("__n").alias("actual"), F.lit(0).cast("bigint").alias("guessed"),
                             hit.alias("tp")),
                    F.struct(F.col("__p").cast(confusion.schema["__y"].dataType).alias("c"), F.lit(0).cast("bigint").alias("actual"),
                             F.col("__n").alias("guessed"), F.lit(0).cast("bigint").alias("tp")))
    per_class = confusion.select(*keys, F.inline(sides)).groupBy(*keys, "c").agg(
        F.sum("actual").alias("actual"), F.sum("guessed").alias("guessed"), F.sum("tp").alias("tp"))
    tp = F.col("tp").cast("double")
    precision = F.coalesce(F.try_divide(tp, F.col("guessed")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, F.col("actual")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, F.col("actual") + F.col("guessed")), F.lit(0.0))

    def weighted(x: Column) -> Column:
        return F.try_divide(F.sum(x * F.col("actual")), F.sum("actual"))

    return per_class.groupBy(*keys).agg(
        F.try_divide(F.sum(tp), F.sum("actual")).alias("accuracy"), weighted(precision).alias("precision"),
        weighted(recall).alias("recall"), weighted(f1).alias("f1"))


def ranking_metrics(df: DataFrame, keys: Sequence[str] = (), label: str = "label", score: str = "score",
                    buckets: int = 64) -> DataFrame:
    """Area under the ROC and the precision-recall curve; tied scores form one point.

    Rows are counted per distinct score, and the counts are accumulated from the highest score
    down over buckets of about equally many distinct scores, so the ordering is never in one task.
    """
    keys = list(keys) or ["__all"]
    source = df if keys != ["__all"] else df.withColumn("__all", F.lit(0))
    counts = source.groupBy(*keys, (-F.col(score)).alias("__s")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) == 0).alias("__neg"))
    edges = counts.groupBy(*keys).agg(F.percentile_approx("__s", [i / buckets for i in range(1, buckets)]).alias("__edges"))
    counts = P.attach_table(counts, edges, keys)
    line = P.Panel(keys=tuple(keys), order=("__s",))
    points = P.running(counts, line, {"__tp": P.Run("sum", F.col("__pos")), "__fp": P.Run("sum", F.col("__neg"))},
                       F.size(F.filter("__edges", lambda e: e <= F.col("__s"))))
    tp, fp, pos, neg = (F.col(c) for c in ("__tp", "__fp", "__pos", "__neg"))
    here = F.try_divide(tp, tp + fp)
    before = F.coalesce(F.try_divide(tp - pos, tp - pos + fp - neg), here)
    areas = points.groupBy(*keys).agg(
        F.sum(neg * (tp - pos / 2)).alias("__roc"), F.sum(pos * (here + before) / 2).alias("__pr"),
        F.max(tp).alias("__P"), F.max(fp).alias("__N"))
    out = areas.select(*keys, F.try_divide(F.col("__roc"), F.col("__P") * F.col("__N")).alias("auc_roc"),
                       F.try_divide(F.col("__pr"), F.col("__P")).alias("auc_pr"))
    return out.drop("__all")


TRADING_DAYS = 252


def equity_curve(moves: DataFrame, panel: P.Panel, growth: str) -> DataFrame:
    """Running product of ``growth`` and its running peak, columns ``equity`` and ``peak``.

    The peak of a block depends on the equity before it: a block's table row holds its growth
    and its highest local equity, from which both carries follow in turn.
    """
    keys = list(panel.keys)
    blocked = moves.withColumn("__blk", F.expr(f"`{panel.pos}` div {panel.scan_rows}"))
    inside = W.partitionBy(*keys, "__blk").orderBy(panel.pos).rowsBetween(W.unboundedPreceding, 0)
    local = blocked.withColumn("__e", F.product(growth).over(inside))
    local = local.withColumn("__h", F.max("__e").over(inside))
    across = W.partitionBy(*keys).orderBy("__blk").rowsBetween(W.unboundedPreceding, -1)
    blocks = local.groupBy(*keys, "__blk").agg(F.max_by("__e", panel.pos).alias("__g"), F.max("__e").alias("__top"))
    carries = (blocks.withColumn("__ce", F.coalesce(F.product("__g").over(across), F.lit(1.0)))
               .withColumn("__ch", F.max(F.col("__ce") * F.col("__top")).over(across))
               .select(*keys, "__blk", "__ce", "__ch"))
    joined = local.join(carries, [*keys, "__blk"])
    return joined.select(*moves.columns, (F.col("__ce") * F.col("__e")).alias("equity"),
                         F.greatest("__ch", F.col("__ce") * F.col("__h")).alias("peak"))


def backtest(preds: DataFrame, panel: P.Panel, initial: float = 10_000.0, prices: bool = True) -> DataFrame:
    """Long when the predicted return is positive, else cash; one row of figures per key.

    ``preds`` has ``actual`` and ``predicted``, as prices or as returns.
    """
    df = P.ensure_numbered(preds, panel).select(*panel.keys, panel.pos, "actual", "predicted")
    first = F.col(panel.pos) == 0
    if prices:
        df = P.windowed(df, panel, [lambda w: [F.lag("actual", 1).over(w).alias("__a"),
                                               F.lag("predicted", 1).over(w).alias("__p")]], before=1)
        actual = F.when(first, F.lit(0.0)).otherwise(P.pct_change(F.col("actual"), F.col("__a")))
        predicted = F.when(first, F.lit(0.0)).otherwise(P.pct_change(F.col("predicted"), F.col("__p")))
    else:
        actual, predicted = F.col("actual"), F.col("predicted")
    moves = df.select(*panel.keys, panel.pos, predicted.alias("__pr"),
                      F.when(predicted > 0, actual).otherwise(F.lit(0.0)).alias("__s"))
    curve = equity_curve(moves.withColumn("__growth", 1 + F.col("__s")), panel, "__growth")
    later = F.when(~first, F.col("__s"))
    fall = F.try_divide(F.col("peak") - F.col("equity"), F.col("peak"))
    stats = curve.groupBy(*panel.keys).agg(
        F.max_by("equity", panel.pos).alias("__end"), F.count(F.lit(1)).alias("n"), F.avg(later).alias("__m"),
        F.stddev_pop(later).alias("__sd"), F.max(fall).alias("__dd"),
        F.count_if(F.col("__s") > 0).alias("__wins"), F.count_if(F.col("__pr") != 0).alias("__trades"))
    end = F.col("__end")
    return stats.select(
        *panel.keys, "n", (initial * end).alias("final_value"), (100 * (end - 1)).alias("total_return"),
        (100 * (F.pow(end, TRADING_DAYS / F.col("n")) - 1)).alias("annualized_return"),
        (F.try_divide(F.col("__m"), F.when(F.col("__sd") > 0, F.col("__sd"))) * F.sqrt(F.lit(float(TRADING_DAYS)))).alias("sharpe_ratio"),
        (100 * F.col("__dd")).alias("max_drawdown"),
        F.coalesce(100 * F.try_divide(F.col("__wins"), F.col("__trades")), F.lit(0.0)).alias("win_rate"))


def ensemble(wide: DataFrame, weights: Mapping[str, float] | None = None, models: Sequence[str] = (),
             classify: bool = False, out: str = "ensemble") -> DataFrame:
    """Weighted (weights normalised) or plain average of ``pred_<model>`` columns; NULL if one is missing."""
    names = list(weights or models)
    total = float(sum(weights.values())) if weights else float(len(names))
    mean = None
    for m in names:
        term = F.col(f"pred_{m}") * F.lit((weights[m] if weights else 1.0) / total)
        mean = term if mean is None else mean + term
    return wide.withColumn(out, (mean > 0.5).cast("int") if classify else mean)


def combine_forecasts(forecasts: DataFrame, weights: Mapping[str, float], at: Sequence[str] = ("ticker", "step", "forecast_date")) -> DataFrame:
    """Weighted average of long-form forecasts (weights normalised) where every model has a value."""
    total = float(sum(weights.values()))
    weight = F.lit(None).cast("double")
    for name, w in weights.items():
        weight = F.when(F.col("model") == name, F.lit(w / total)).otherwise(weight)
    known = forecasts.withColumn("__w", weight).where(F.col("__w").isNotNull() & F.col("predicted").isNotNull())
    return (known.groupBy(*at).agg(F.sum(F.col("__w") * F.col("predicted")).alias("predicted"), F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") == len(weights)).drop("__n"))
