"""Joins of bars with sentiment, macro series, a second vendor and keyword lists.

No broadcast is forced: Spark broadcasts a side only when its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import panel as P
from tickloom.operators.aggregates import pivot_series


def with_daily_scores(bars: DataFrame, daily: DataFrame, default: float = 0) -> DataFrame:
    """Left join of daily scores; a day without records gets ``default``."""
    scores = [c for c in daily.columns if c not in ("ticker", "date")]
    return bars.join(daily, ["ticker", "date"], "left").na.fill(default, scores)


def with_macro_on_date(bars: DataFrame, series: DataFrame, ids: Sequence[str], panel: P.Panel = P.BARS) -> DataFrame:
    """Left join of the wide macro table on the exact date, then forward fill within the ticker."""
    wide = pivot_series(series, ids)
    columns = [c for c in wide.columns if c != "date"]
    return P.forward_fill(bars.join(wide, "date", "left"), panel, columns)


def as_of_macro(bars: DataFrame, series: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The last macro value on or before each bar's date.

    The result depends on the date alone, so the as-of search runs over the distinct dates of
    the bars and the series, and the bars then take their day's values by an equi-join.
    Days are few whatever the number of bars.
    """
    wide = pivot_series(series, ids)
    columns = [c for c in wide.columns if c != "date"]
    days = bars.select("date").distinct().join(wide, "date", "full")
    line = P.Panel(keys=("__all",))
    filled = P.forward_fill(days.withColumn("__all", F.lit(1)), line, columns)
    return bars.join(filled.select("date", *columns), "date", "left")


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str],
               bucket: Column | None = None, prefer_right: bool = True) -> DataFrame:
    """The last ``right`` row of the same key on or before each ``left`` row's time.

    Union, tag, and a forward fill over time buckets: no range join and no key in one task.
    ``bucket`` must grow with the time and should leave a bucket of one key fit for a task. Right rows
    sort before left rows of equal time when ``prefer_right``. Several right rows at one time
    must be reduced to one by the caller.
    """
    keys = list(keys)
    side = 0 if prefer_right else 1
    extra = [c for c in left.columns if c not in (*keys, time)]
    l = left.select(*keys, time, F.lit(1 - side).alias("__side"), F.struct(*extra).alias("__row"),
                    F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("__val"))
    r = right.select(*keys, time, F.lit(side).alias("__side"),
                     F.lit(None).cast(l.schema["__row"].dataType).alias("__row"), F.struct(*values).alias("__val"))
    both = l.unionByName(r)
    line = P.Panel(keys=tuple(keys), order=(time, "__side"))
    filled = P.forward_fill(both, line, ["__val"], bucket)
    return (filled.where(F.col("__side") == 1 - side)
            .select(*keys, time, *[F.col("__row")[c].alias(c) for c in extra],
                    *[F.col("__val")[c].alias(c) for c in values]))


def matched_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both vendors' closes on common (ticker, date) keys with difference and percent difference."""
    left = a.select("ticker", "date", F.col("close").alias("close_a"))
    right = b.select("ticker", "date", F.col("close").alias("close_b"))
    diff = F.col("close_a") - F.col("close_b")
    return (left.join(right, ["ticker", "date"])
            .withColumns({"diff": diff, "diff_pct": 100 * F.try_divide(diff, F.col("close_a"))}))


def unmatched_keys(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """Keys on one side only, with the side they are on."""
    keys = list(keys)
    x, y = a.select(*keys), b.select(*keys)
    return (x.join(y, keys, "left_anti").withColumn("only_in", F.lit("a"))
            .unionByName(y.join(x, keys, "left_anti").withColumn("only_in", F.lit("b"))))


def hold_out(df: DataFrame, keys: Sequence[str], share: float) -> tuple[DataFrame, DataFrame]:
    """A repeatable random split by the MD5 of the keys' texts: (kept, held out by anti-join on the keys)."""
    place = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), 1, 8), 16, 10).cast("long")
    kept = df.where(place % 10_000 < int(share * 10_000))
    return kept, df.join(kept.select(*keys), list(keys), "left_anti")


def tag_keywords(docs: DataFrame, keywords: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ticker) for each ticker one of whose keywords occurs in the text.

    Text and keywords are reduced to lower-case words, and a keyword of m words is found by an
    equi-join on the text's different runs of m words (a run past the end is NULL and joins nothing), for the lengths that
    keywords have; the text itself is never shuffled. These lengths are read from the keyword list, which is configuration.
    """
    def words(c: str | Column) -> Column:
        return F.split(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}$]+", " ")), " ")

    terms = keywords.select("ticker", words("keyword").alias("__w"))
    lengths = sorted(r[0] for r in terms.select(F.size("__w")).distinct().collect()) or [1]
    terms = terms.select("ticker", F.array_join("__w", " ").alias("__term")).distinct()

    runs = [F.col("__w")]
    for m in range(2, lengths[-1] + 1):
        runs.append(F.zip_with(runs[-1], F.slice("__w", m, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b)))
    tokens = docs.select(key, words(text).alias("__w")).select(key, F.explode(F.array_distinct(F.concat(*(runs[m - 1] for m in lengths)))).alias("__term"))
    return tokens.join(terms, "__term").select(key, "ticker").distinct()


def align_models(preds: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per (ticker, date) with a column per model."""
    wide = preds.groupBy("ticker", "date", "actual").pivot("model", list(models)).agg(F.max("predicted"))
    return wide.select("ticker", "date", "actual", *[F.col(f"`{m}`").alias(f"pred_{m}") for m in models])
