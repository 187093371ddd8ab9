"""Text and sentiment X1-X4."""

from pyspark.sql import functions as F

from tickloom.functions import text as T
from tickloom.operators import sentiment as N
from tickloom.plans.registry import query, rounded
from tickloom.sources import fixtures as X


def clean_sql(text: str) -> str:
    out = text
    for pattern in (T.URL, T.MENTION, T.HASHTAG, T.NOT_WORD):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'), ' ')"


LEXICON = "lex(word, polarity, subjectivity) AS (VALUES " + ", ".join(
    f"('{w}', {p}::DOUBLE, {s}::DOUBLE)" for w, p, s in X.LEXICON) + ")"


def scored_sql(source: str, text: str = "text") -> str:
    return f"""words AS (SELECT key, unnest(string_split(lower({clean_sql(text)}), ' ')) AS word FROM {source}),
 scored AS (SELECT key, coalesce(avg(polarity), 0) AS polarity, coalesce(avg(subjectivity), 0) AS subjectivity
 FROM words LEFT JOIN lex USING (word) GROUP BY key)"""


LABEL = "CASE WHEN polarity > 0.1 THEN 'positive' WHEN polarity < -0.1 THEN 'negative' ELSE 'neutral' END"
RICH = "text || ' see https://x.example/a?b=1 @user_1 #tag9 www.site.example 50%!'"


@query("x1_clean_text", f"SELECT doc_id, {clean_sql(RICH)} AS clean FROM documents")
def x1(spark, sf):
    rich = F.concat("text", F.lit(" see https://x.example/a?b=1 @user_1 #tag9 www.site.example 50%!"))
    return X.table(spark, sf, "documents").select("doc_id", "text").select("doc_id", T.clean_text(rich).alias("clean"))


@query("x2_lexicon_score", f"""WITH {LEXICON}, src AS (SELECT doc_id AS key, text FROM documents), {scored_sql('src')}
 SELECT key AS doc_id, round(polarity, 10) AS polarity, round(subjectivity, 10) AS subjectivity FROM scored""")
def x2(spark, sf):
    df = N.score_text(X.table(spark, sf, "documents").select("doc_id", "text"), X.lexicon(spark))
    return df.select("doc_id", *rounded(10, "polarity", "subjectivity"))


@query("x3_sentiment_label", f"""WITH {LEXICON}, src AS (SELECT doc_id AS key, text FROM documents), {scored_sql('src')},
 r AS (SELECT key, round(polarity, 6) AS polarity FROM scored) SELECT key AS doc_id, {LABEL} AS sentiment FROM r""")
def x3(spark, sf):
    df = N.score_text(X.table(spark, sf, "documents").select("doc_id", "text"), X.lexicon(spark))
    return df.select("doc_id", T.sentiment_label(F.round("polarity", 6)).alias("sentiment"))


@query("x4_sentiment_table", f"""WITH {LEXICON}, src AS (SELECT doc_id AS key, text FROM documents), {scored_sql('src')},
 d AS (SELECT ['click', 'error', 'purchase', 'signup', 'view'][key % 5 + 1] AS ticker,
  CAST(DATE '2024-01-01' + CAST((key // 5) % 30 AS INTEGER) AS DATE) AS date, polarity, subjectivity FROM scored)
 SELECT ticker, date, round(avg(polarity), 9) AS polarity_mean, round(stddev_samp(polarity), 9) AS polarity_std, count(*) AS polarity_count,
 round(avg(subjectivity), 9) AS subjectivity_mean, round(stddev_samp(subjectivity), 9) AS subjectivity_std FROM d GROUP BY 1, 2""")
def x4(spark, sf):
    records = X.sentiment_records(X.table(spark, sf, "documents").select("doc_id", "text", "source"))
    return N.daily_text_sentiment(records, X.lexicon(spark)).select(
        "ticker", "date", *rounded(9, "polarity_mean", "polarity_std"), "polarity_count",
        *rounded(9, "subjectivity_mean", "subjectivity_std"))


@query("x4_page_sentiment", f"""WITH {LEXICON}, src AS (SELECT page_id AS key, array_to_string(list_transform(
 regexp_extract_all(html, '{T.PARAGRAPH}', 1)[1:10], lambda p: trim(regexp_replace(p, '{T.TAG}', '', 'g'), ' ')), ' ') AS text FROM pages), {scored_sql('src')}
 SELECT key AS page_id, round(polarity, 10) AS polarity, round(subjectivity, 10) AS subjectivity,
 CASE WHEN round(polarity, 6) > 0.1 THEN 'positive' WHEN round(polarity, 6) < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment FROM scored""")
def x4_pages(spark, sf):
    pages = X.table(spark, sf, "pages").select("page_id", "html").select("page_id", T.html_paragraphs("html").alias("text"))
    df = N.score_text(pages, X.lexicon(spark), keys=["page_id"])
    return df.select("page_id", *rounded(10, "polarity", "subjectivity"),
                     T.sentiment_label(F.round("polarity", 6)).alias("sentiment"))
