"""Sources S1-S12 (S13 is with the streams)."""

import uuid

from pyspark.sql import functions as F

from tickloom.operators import tables as K
from tickloom.operators.frames import latest_record
from tickloom.plans import sql as S
from tickloom.plans.joins import _NAMES
from tickloom.plans.registry import query
from tickloom.session import shared_root
from tickloom.sources import fixtures as X
from tickloom.sources import ingest as G
from tickloom.sources import schemas
from tickloom.sources.catalogue import MACRO_CATALOGUE, indicator_catalogue
from tickloom.functions.text import PARAGRAPH, TAG

BASE = ("ticker", "date")
OHLCV = ("ticker", "date", "open", "high", "low", "close", "volume")
ALL_BARS = f"WITH {S.BARS} SELECT ticker, date, open, high, low, close, volume FROM bars"


def fresh(spark, name):
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def _file_round_trip(fmt):
    def run(spark, sf):
        path = fresh(spark, f"s1-{fmt}")
        K.save(X.bars(spark, sf).select(*OHLCV), path, fmt)
        return G.load(spark, path, fmt, schemas.STOCK).select(*OHLCV)
    return run


for _fmt in ("csv", "json", "parquet"):
    query(f"s1_load_{_fmt}", ALL_BARS)(_file_round_trip(_fmt))


@query("s2_conform_schema", f"""WITH {S.BARS} SELECT ticker, date, open, high, low, CASE WHEN day(date) = 13 THEN NULL ELSE close END AS close,
 volume, CAST(NULL AS DOUBLE) AS adj_close FROM bars""")
def s2(spark, sf):
    text = X.bars(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in OHLCV])
    junk = text.withColumn("close", F.when(F.dayofmonth(F.to_date("date")) == 13, "n/a").otherwise(F.col("close")))
    return schemas.conform(junk, schemas.STOCK)


@query("s3_load_bars", f"""WITH {S.BARS} SELECT ticker, date, close, volume FROM bars
 WHERE ticker = '1-URGENT' AND date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
def s3(spark, sf):
    path = fresh(spark, "s3-bars")
    K.save_bars(X.bars(spark, sf), path)
    return G.load_bars(spark, path, "1-URGENT", "1996-01-01", "1997-12-31").select(*BASE, "close", "volume")


@query("s3_load_macro", f"""WITH {S.MACRO} SELECT series_id, date, CASE WHEN month(date) <> 1 THEN value END AS value, CAST(NULL AS VARCHAR) AS indicator_name
 FROM macro WHERE date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'""")
def s3_macro(spark, sf):
    """CSV files with a time of day and, each January, a mark instead of a number."""
    path = fresh(spark, "s3-macro")
    value = F.when(F.month("date") == 1, F.lit(".")).otherwise(F.col("value").cast("string"))
    K.save(X.macro(spark, sf).select("series_id", F.concat(F.col("date").cast("string"), F.lit(" 09:30:00")).alias("date"), value.alias("value")), path, "csv")
    return G.load_macro(spark, path, "1994-01-01", "1996-12-31")


@query("s3_load_sentiment", f"""WITH {S.SENTIMENT} SELECT ticker, CAST(date AS VARCHAR) || ' 16:00:00' AS published, date AS day, source, polarity, subjectivity, count(*) AS n
 FROM sentiment WHERE ticker = 'view' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY ALL""")
def s3_sentiment(spark, sf):
    """JSON files of all tickers with ``published_at``; one ticker and a range of days."""
    path = fresh(spark, "s3-sentiment")
    at = F.concat(F.col("date").cast("string"), F.lit(" 16:00:00")).alias("published_at")
    K.save(X.sentiment(spark, sf).select("ticker", at, "source", "polarity", "subjectivity"), path, "json")
    df = G.load_sentiment(spark, path, "view", "json", "2024-01-05", "2024-01-20")
    return df.groupBy("ticker", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("published"), "day", "source", "polarity", "subjectivity").agg(F.count("*").alias("n"))


def vendor_payloads(spark, sf):
    """One payload per ticker and month, as a polling collector lands them."""
    fields = F.create_map(*[x for name, key in G.VENDOR_FIELDS.items() for x in (
        F.lit(key), F.format_string("%.4f", "close" if name == "adj_close" else name) if name != "volume"
        else F.col("volume").cast("string"))])
    day = F.struct(F.date_format("date", "yyyy-MM-dd").alias("k"), fields.alias("v"))
    months = X.bars(spark, sf).groupBy("ticker", F.trunc("date", "MM").alias("month")).agg(
        F.map_from_entries(F.collect_list(day)).alias("days"))
    return months.select("ticker", F.to_json(F.create_map(F.lit(G.VENDOR_SERIES), "days")).alias("payload"))


@query("s4_vendor_bars", f"""WITH {S.BARS} SELECT ticker, date, open, high, low, close, close AS adj_close, volume FROM bars
 WHERE date BETWEEN DATE '1996-06-01' AND DATE '2000-05-31'""")
def s4(spark, sf):
    return G.flatten_vendor_bars(vendor_payloads(spark, sf), start="1996-06-01", end="2000-05-31")


@query("s5_macro_observations", f"""WITH {S.MACRO} SELECT series_id, date, CASE WHEN month(date) <> 3 THEN value END AS value,
 CASE series_id {_NAMES} END AS indicator_name FROM macro""")
def s5(spark, sf):
    text = F.when(F.month("date") == 3, ".").otherwise(F.col("value").cast("string"))
    one = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), text.alias("value"))
    years = X.macro(spark, sf).groupBy("series_id", F.year("date").alias("y")).agg(F.collect_list(one).alias("observations"))
    payloads = years.select("series_id", F.to_json(F.struct("observations")).alias("payload"))
    names = indicator_catalogue(spark, dict(zip(X.MACRO_IDS, [r[0] for r in MACRO_CATALOGUE])))
    return G.flatten_observations(payloads, names)


@query("s6_news_articles", """SELECT doc_id, 'Item ' || doc_id AS title, source, 'http://news.example/' || doc_id AS url,
 TIMESTAMP '2024-01-01' + to_seconds(doc_id * 60) AS published_at, 'Item ' || doc_id || ' ' || lang || ' ' || text AS text FROM documents""")
def s6(spark, sf):
    d = F.col("doc_id")
    epoch = F.lit(1704067200) + d * 60
    iso = F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    article = F.struct(
        F.concat(F.lit("Item "), d).alias("title"), F.col("lang").alias("description"), F.col("text").alias("content"),
        F.concat(F.lit("http://news.example/"), d).alias("url"), F.when(F.col("lang") == "en", iso).alias("publishedAt"),
        F.when(F.col("lang") != "en", epoch).alias("epoch"), F.struct(F.col("source").alias("name")).alias("source"))
    payloads = X.table(spark, sf, "documents").select("doc_id", F.to_json(F.array(article)).alias("payload"))
    return G.flatten_articles(payloads, ["doc_id"])


@query("s7_social_posts", """SELECT conv_id, turn, text, TIMESTAMP '2024-01-01' + to_seconds(turn * 3600) AS created_at, role AS user,
 CAST(conv_id % 1000 AS INTEGER) AS followers, CAST(turn AS INTEGER) AS retweet_count, CAST(turn * 2 AS INTEGER) AS favorite_count FROM conversations""")
def s7(spark, sf):
    at = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 3600), "yyyy-MM-dd HH:mm:ss")
    post = F.struct("text", at.alias("created_at"), F.col("turn").alias("retweet_count"), (F.col("turn") * 2).alias("favorite_count"),
                    F.struct(F.col("role").alias("screen_name"), (F.col("conv_id") % 1000).alias("followers_count")).alias("user"))
    payloads = X.table(spark, sf, "conversations").select("conv_id", "turn", F.to_json(post).alias("payload"))
    return G.flatten_posts(payloads, ["conv_id", "turn"])


@query("s8_page_paragraphs", f"""SELECT page_id, url, array_to_string(list_transform(regexp_extract_all(html, '{PARAGRAPH}', 1)[1:10],
 lambda p: trim(regexp_replace(p, '{TAG}', '', 'g'), ' ')), ' ') AS text FROM pages""")
def s8(spark, sf):
    return G.page_text(X.table(spark, sf, "pages"))


@query("s9_snapshots", f"""WITH {S.BARS} SELECT ticker, date, close, CASE WHEN date < DATE '1998-01-01' THEN volume END AS volume FROM bars""")
def s9(spark, sf):
    root = fresh(spark, "s9-snapshots")
    bars = X.bars(spark, sf)
    K.save(bars.where("date < '1998-01-01'").select(*BASE, "close", "volume"), f"{root}/realtime_a")
    K.save(bars.where("date >= '1998-01-01'").select(*BASE, "close"), f"{root}/realtime_b")
    return G.read_snapshots(spark, f"{root}/realtime_*").select(*BASE, "close", "volume")


@query("s10_latest_record", f"""WITH {S.TICKS} SELECT ticker, ts, event_id, price, size FROM ticks
 QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY ts DESC, event_id DESC) = 1""")
def s10(spark, sf):
    return latest_record(X.ticks(spark, sf), ["ticker"], "ts")


@query("s11_find_documents", "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en' AND n_chars > 200 ORDER BY n_chars DESC, doc_id LIMIT 50")
def s11(spark, sf):
    docs = X.table(spark, sf, "documents").withColumn("_id", F.xxhash64("doc_id"))
    return G.find(docs, (F.col("lang") == "en") & (F.col("n_chars") > 200), ["_id", "doc_id", "lang", "n_chars"],
                  [("n_chars", -1), ("doc_id", 1)], 50)


@query("s12_known_tickers", "SELECT DISTINCT o_orderpriority AS ticker FROM orders")
def s12(spark, sf):
    return G.known_tickers(X.bars(spark, sf))
