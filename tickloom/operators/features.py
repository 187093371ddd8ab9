"""Feature engineering: lags, targets, calendar parts, scaling, splits, sequences, combination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import indicators as I
from tickloom.operators import joins as J
from tickloom.operators import panel as P
from tickloom.operators.aggregates import daily_mean_sentiment, daily_sentiment_profile
from tickloom.operators.frames import numeric_columns


def lag_features(df: DataFrame, k: int = 5, columns: Sequence[str] | None = None, panel: P.Panel = P.BARS) -> DataFrame:
    """Lags 1..k of every numeric column, in one pass."""
    df = P.ensure_numbered(df, panel)
    names = list(columns or numeric_columns(df))
    return P.windowed(df, panel, [lambda w: [F.lag(c, n).over(w).alias(f"{c}_lag_{n}")
                                             for c in names for n in range(1, k + 1)]], before=k)


def period_returns(df: DataFrame, periods: Sequence[int] = (1, 5, 20), x: str = "close", panel: P.Panel = P.BARS) -> DataFrame:
    """``return_<n>``: the change over n rows."""
    out = P.windowed(df, panel, [
        lambda w: [F.lag(x, n).over(w).alias(f"__{n}") for n in periods],
        lambda w: [P.pct_change(F.col(x), F.col(f"__{n}")).alias(f"return_{n}") for n in periods]], before=max(periods))
    return P.drop_work_columns(out)


# Lags and windows of the target column.
TARGET_LAGS = (1, 2, 3, 5, 10)
TARGET_WINDOWS = (5, 10, 20, 30)


def history_features(df: DataFrame, x: str = "close", panel: P.Panel = P.BARS) -> DataFrame:
    def level(w) -> list[Column]:
        return [*[F.lag(x, n).over(w).alias(f"{x}_lag_{n}") for n in TARGET_LAGS],
                *[P.rolling(F.avg(x), x, n, w).alias(f"{x}_rolling_mean_{n}") for n in TARGET_WINDOWS],
                *[P.rolling(F.stddev_samp(x), x, n, w).alias(f"{x}_rolling_std_{n}") for n in TARGET_WINDOWS]]
    return P.windowed(df, panel, [level], before=max(TARGET_WINDOWS))


def step_targets(df: DataFrame, k: int = 5, x: str = "close", panel: P.Panel = P.BARS) -> DataFrame:
    """``target_1d..kd`` are future values; the next return and its direction follow."""
    return P.windowed(df, panel, [
        lambda w: [F.lead(x, n).over(w).alias(f"target_{n}d") for n in range(1, k + 1)],
        lambda w: [F.try_divide(F.col("target_1d") - F.col(x), F.col(x)).alias("target_return_1d")],
        lambda w: [F.when(F.col("target_return_1d") > 0, 1).otherwise(0).alias("target_direction")]], after=k)


def return_targets(df: DataFrame, horizons: Sequence[int] = (1, 5, 10, 20), x: str = "close",
                   drop_tail: bool = True, panel: P.Panel = P.BARS) -> DataFrame:
    """Forward returns and up flags; rows without the longest one are dropped."""
    out = P.windowed(df, panel, [
        lambda w: [F.lead(x, n).over(w).alias(f"__f_{n}") for n in horizons],
        lambda w: [P.pct_change(F.col(f"__f_{n}"), F.col(x)).alias(f"target_{n}d") for n in horizons],
        lambda w: [P.flag(F.col(f"target_{n}d") > 0).alias(f"target_{n}d_up") for n in horizons]], after=max(horizons))
    out = P.drop_work_columns(out)
    return out.where(F.col(f"target_{max(horizons)}d").isNotNull()) if drop_tail else out


def percent_target(df: DataFrame, horizon: int = 5, x: str = "close", panel: P.Panel = P.BARS) -> DataFrame:
    return P.windowed(df, panel, [
        lambda w: [F.lead(x, horizon).over(w).alias("target")],
        lambda w: [(100 * P.pct_change(F.col("target"), F.col(x))).alias("target_pct_change")]], after=horizon)


def class_targets(df: DataFrame, periods: int = 1, x: str = "close", panel: P.Panel = P.BARS) -> DataFrame:
    """Future value, percent return, up flag, and 0/1/2 for below -1 %, between, above 1 %; unknown is 1."""
    ret = F.col("target_return")
    return P.windowed(df, panel, [
        lambda w: [F.lead(x, periods).over(w).alias("target_future")],
        lambda w: [(100 * P.pct_change(F.col("target_future"), F.col(x))).alias("target_return")],
        lambda w: [P.flag(ret > 0).alias("target_binary"),
                   F.when(ret > 1, 2).when(ret < -1, 0).otherwise(1).alias("target_class")]], after=periods)


def date_parts(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumns({
        "day_of_week": F.weekday(column), "day_of_month": F.dayofmonth(column), "week_of_year": F.weekofyear(column),
        "month": F.month(column), "quarter": F.quarter(column), "year": F.year(column)})


def period_flags(df: DataFrame, column: str = "date") -> DataFrame:
    c = F.col(column)
    tomorrow = F.date_add(c, 1)
    out = {}
    for name, unit in (("month", "MM"), ("quarter", "QUARTER"), ("year", "YEAR")):
        out[f"is_{name}_start"] = (F.trunc(c, unit) == c).cast("int")
        out[f"is_{name}_end"] = (F.trunc(tomorrow, unit) == tomorrow).cast("int")
    return df.withColumns(out)


def cyclical(df: DataFrame, column: str = "date") -> DataFrame:
    day = 2 * F.pi() * F.weekday(column) / 7
    month = 2 * F.pi() * F.month(column) / 12
    return df.withColumns({"sin_day_of_week": F.sin(day), "cos_day_of_week": F.cos(day),
                           "sin_month": F.sin(month), "cos_month": F.cos(month)})


def time_features(df: DataFrame, column: str = "date") -> DataFrame:
    return cyclical(period_flags(date_parts(df, column), column), column)


# Sentiment rolling windows.
SENTIMENT_WINDOWS = (3, 7, 14)


def sentiment_features(bars: DataFrame, records: DataFrame, panel: P.Panel = P.BARS) -> DataFrame:
    """Daily sentiment profile joined to the bars, with rolling means per ticker."""
    joined = J.with_daily_scores(P.ensure_numbered(bars, panel), daily_sentiment_profile(records))
    return P.windowed(joined, panel, [lambda w: [
        P.rolling(F.avg(c), c, n, w).alias(f"{c}_rolling_{n}d")
        for n in SENTIMENT_WINDOWS for c in ("polarity_mean", "polarity_std", "subjectivity_mean")]],
        before=max(SENTIMENT_WINDOWS))


def min_max(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """Scaling parameters: minimum and range per key; join with :func:`apply_min_max`."""
    return df.groupBy(*keys).agg(*[a for c in columns for a in (
        F.min(c).alias(f"{c}_min"), (F.max(c) - F.min(c)).alias(f"{c}_range"))])


def apply_min_max(df: DataFrame, fitted: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """Scaled columns; a constant column becomes 0."""
    joined = P.attach_table(df, fitted, keys)
    new = {c: F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}_min"), F.col(f"{c}_range")),
                         F.when(F.col(c).isNotNull(), F.lit(0.0))) for c in columns}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def invert_min_max(df: DataFrame, fitted: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("ticker",)) -> DataFrame:
    joined = P.attach_table(df, fitted, keys)
    new = {c: F.col(c) * F.col(f"{c}_range") + F.col(f"{c}_min") for c in columns}
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def chronological_split(df: DataFrame, shares: Sequence[tuple[str, float]] = (("train", 0.8), ("val", 0.1)),
                        rest: str = "test", panel: P.Panel = P.BARS, out: str = "split") -> DataFrame:
    """Name each row's part by position in its key; every part but the last has ``floor(n·share)`` rows."""
    sized = P.attach_per_key(df, panel, [F.count(F.lit(1)).alias("__n"), F.min(panel.pos).alias("__p0")])
    place = F.col(panel.pos) - F.col("__p0")
    bound, part = F.lit(0), None
    for name, share in shares:
        bound = bound + F.floor(F.col("__n") * F.lit(float(share)))
        part = F.when(place < bound, name) if part is None else part.when(place < bound, name)
    return sized.withColumn(out, part.otherwise(rest)).drop("__n", "__p0")


def sequences(df: DataFrame, columns: Sequence[str], label: str, length: int, horizon: int = 1,
              panel: P.Panel = P.BARS) -> DataFrame:
    """The last ``length`` rows of the columns as an array of arrays, and the label ``horizon`` rows on."""
    row = F.array(*[F.col(c).cast("double") for c in columns])
    out = P.windowed(df, panel, [lambda w: [
        F.collect_list(row).over(w.rowsBetween(-(length - 1), 0)).alias("sequence"),
        F.lead(label, horizon).over(w).alias("label")]], before=length, after=horizon)
    return out.where((F.size("sequence") == length) & F.col("label").isNotNull())


def combine_sources(bars: DataFrame, records: DataFrame | None = None, macro: DataFrame | None = None,
                    macro_ids: Sequence[str] = (), as_of: bool = True) -> DataFrame:
    """Bars with daily mean sentiment (missing is 0) and the macro values known on the day."""
    out = bars
    if records is not None:
        out = J.with_daily_scores(out, daily_mean_sentiment(records))
    if macro is not None:
        out = J.as_of_macro(out, macro, macro_ids) if as_of else J.with_macro_on_date(out, macro, macro_ids)
    return out


def full_features(bars: DataFrame, records: DataFrame | None = None, target_periods: Sequence[int] = (1, 5),
                  panel: P.Panel = P.BARS) -> DataFrame:
    """Indicators, calendar parts, sentiment and forward targets in one lazy plan."""
    chosen = [*I.from_spec(I.STANDARD_SPEC), I.returns(), I.gap_and_range(), I.volume_stats()]
    out = time_features(I.compute(bars, chosen, panel))
    if records is not None:
        out = sentiment_features(out, records, panel)
    return return_targets(out, target_periods, drop_tail=False, panel=panel) if target_periods else out


def pipeline_features(bars: DataFrame, records: DataFrame | None = None, target_periods: Sequence[int] = (1, 5),
                      panel: P.Panel = P.BARS) -> DataFrame:
    """The whole feature pipeline: every indicator without gaps, calendar parts, sentiment, forward targets.

    The indicators are staged: the table is written between levels of exponential means. Indicators are filled as in :func:`indicators.compute`; targets are not, so the newest rows have none.
    """
    out = time_features(I.compute(bars, I.full_set(), panel, fill=True, staged=True))
    if records is not None:
        out = sentiment_features(out, records, panel)
    return return_targets(out, target_periods, drop_tail=False, panel=panel) if target_periods else out


def next_business_days(last: DataFrame, steps: int, date: str = "date") -> DataFrame:
    """The next ``steps`` weekdays after each row's date, numbered from 1."""
    span = F.sequence(F.date_add(date, 1), F.date_add(date, 2 * steps + 4))
    days = F.slice(F.filter(span, lambda d: F.weekday(d) < 5), 1, steps)
    keys = [c for c in last.columns if c != date]
    return last.select(*keys, F.posexplode(days).alias("step", "forecast_date")).withColumn("step", F.col("step") + 1)
