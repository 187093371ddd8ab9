"""Sorts, limits and set operations L1-L5."""

from pyspark.sql import functions as F

from tickloom.plans import sql as S
from tickloom.plans.registry import query
from tickloom.sources import fixtures as X

BASE = ("ticker", "date")


@query("l1_order_by_abs", f"WITH {S.BARS} SELECT ticker, date, round(close - open, 4) AS move FROM bars ORDER BY abs(close - open) DESC")
def l1(spark, sf):
    move = F.col("close") - F.col("open")
    return X.bars(spark, sf).select(*BASE, F.round(move, 4).alias("move")).orderBy(F.abs("move").desc(), *BASE)


@query("l2_top_k", f"WITH {S.BARS} SELECT ticker, date, close FROM bars ORDER BY close DESC, ticker, date LIMIT 25")
def l2(spark, sf):
    return X.bars(spark, sf).select(*BASE, "close").orderBy(F.col("close").desc(), *BASE).limit(25)


@query("l3_union", f"""WITH {S.BARS_B} SELECT ticker, date, round(close, 6) AS close, 'a' AS vendor FROM bars
 UNION ALL SELECT ticker, date, round(close, 6), 'b' FROM bars_b""")
def l3(spark, sf):
    a = X.bars(spark, sf).select(*BASE, F.round("close", 6).alias("close"), F.lit("a").alias("vendor"))
    b = X.bars_b(spark, sf).select(*BASE, F.round("close", 6).alias("close"), F.lit("b").alias("vendor"))
    return a.unionByName(b)


@query("l4_intersect_keys", f"WITH {S.BARS_B} SELECT ticker, date FROM bars INTERSECT SELECT ticker, date FROM bars_b")
def l4(spark, sf):
    return X.bars(spark, sf).select(*BASE).intersect(X.bars_b(spark, sf).select(*BASE))


@query("l5_except_keys", f"WITH {S.BARS_B} SELECT ticker, date FROM bars EXCEPT SELECT ticker, date FROM bars_b")
def l5(spark, sf):
    return X.bars(spark, sf).select(*BASE).subtract(X.bars_b(spark, sf).select(*BASE))
