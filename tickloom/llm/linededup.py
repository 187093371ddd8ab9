"""Line deduplication with a log-template tree of fixed depth, in DataFrame functions only.

A line's words with a digit become a wildcard. The tree's levels are the number of words and the first three of them;
in a leaf, lines that agree with the leaf's commonest line in most places form one template with it, and any other line
is a template of its own. Templates that enough documents hold are dropped from all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import query, table
from tickloom.session import publish

WILD = "<*>"
_FIELD = r"[^\x20]*[0-9][^\x20]*"


def _masked(line: Column) -> Column:
    """The line without blanks around it and with its variable words as wildcards."""
    line = F.trim(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, _FIELD, WILD)).otherwise(line)


def _leaf(masked: Column, depth: int) -> Column:
    words = F.split(masked, "\x20")
    return F.concat_ws("\x20", F.size(words).cast("string"), F.slice(words, 1, depth))


def _lines(docs: DataFrame, depth: int, least_words: int) -> DataFrame:
    """(doc_id, leaf, masked) of every line of at least ``least_words`` words."""
    rows = docs.where("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    rows = rows.select("doc_id", _masked(F.col("line")).alias("masked"))
    return rows.where(F.size(F.split("masked", "\x20")) >= least_words).select("doc_id", _leaf(F.col("masked"), depth).alias("leaf"), "masked")


def dropped_lines(docs: DataFrame, least_docs: int = 3, depth: int = 3, likeness: float = 0.7, least_words: int = 3) -> DataFrame:
    """(doc_id, lines): the hashes of the masked lines that each document loses, for documents that lose any.

    A line belongs to its leaf's commonest line (most documents, then lowest hash) if at least ``likeness`` of their
    words agree place by place. A template goes if ``least_docs`` documents or more hold it. Counting is by distinct
    (line, document) with partial sums; only the texts of lines in leaves that enough documents share are moved.
    """
    hashed = F.md5(F.col("masked").cast("binary"))
    held = publish(_lines(docs, depth, least_words).select("doc_id", "leaf", hashed.alias("line")).distinct(), "lines")
    shared = held.select("leaf", "doc_id").distinct().groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= least_docs)
    held = publish(held.join(shared.select("leaf"), "leaf"), "lines")
    variants = held.groupBy("leaf", "line").agg(F.count("*").alias("docs"))
    heads = variants.groupBy("leaf").agg(
        F.min_by("line", F.struct(-F.col("docs"), F.col("line"))).alias("head"), F.count("*").alias("variants")).where("variants > 1").select("leaf", "head")
    heads = publish(heads, "heads")
    # The hint keeps leaves that grow with the input from being broadcast.
    texts = _lines(docs, depth, least_words).join(heads.hint("shuffle_hash"), "leaf").select("leaf", "head", hashed.alias("line"), "masked")
    texts = publish(texts.groupBy("leaf", "head", "line").agg(F.min("masked").alias("masked")), "texts")
    first = texts.where("line = head").select("leaf", F.split("masked", "\x20").alias("model"))
    words = F.split("masked", "\x20")
    agree = F.size(F.filter(F.zip_with(words, F.col("model"), lambda a, b: a == b), lambda same: same))
    joined = texts.where("line <> head").join(first, "leaf").where(agree >= likeness * F.size(words)).select("leaf", "line", "head")
    named = held.join(joined, ["leaf", "line"], "left").select("doc_id", "leaf", "line", F.coalesce("head", "line").alias("template"))
    named = publish(named, "named")
    gone = named.select("leaf", "template", "doc_id").distinct().groupBy("leaf", "template").agg(
        F.count("*").alias("docs")).where(F.col("docs") >= least_docs).select("leaf", "template")
    return named.join(gone, ["leaf", "template"]).groupBy("doc_id").agg(F.collect_set("line").alias("lines"))


def without_templates(docs: DataFrame, least_docs: int = 3, depth: int = 3, likeness: float = 0.7, least_words: int = 3) -> DataFrame:
    """``docs`` with the text cleared of recurring lines, n_lines and n_dropped; other columns as they are.

    Null texts stay null with no lines; an empty text is one empty line, which stays. Lines of fewer than
    ``least_words`` words always stay, since they say too little to be a template. A document counts once per
    template, however often it repeats it; rows of one doc_id count as one document, and so do rows without. Columns
    named n_lines or n_dropped give way to the results.
    """
    lost = dropped_lines(docs.select("doc_id", "text"), least_docs, depth, likeness, least_words).select(
        F.col("doc_id").alias("__of"), F.col("lines").alias("__lost"))
    rows = docs.drop("n_lines", "n_dropped")
    # The hint keeps lists that grow with the input from being broadcast.
    rows = rows.join(lost.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(F.col("__of")), "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line: ~F.coalesce(F.array_contains("__lost", F.md5(_masked(line).cast("binary"))), F.lit(False)))
    kept = F.when(F.col("__lost").isNull(), lines).otherwise(kept)
    rows = rows.withColumns({"__lines": lines, "__kept": kept})
    count = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).cast("long")
    return rows.select(*[F.array_join("__kept", "\n").alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")],
                       count("__lines").alias("n_lines"), (count("__lines") - count("__kept")).alias("n_dropped"))


_ORACLE = r"""
WITH l AS (
  SELECT k, doc_id, i, line, CASE WHEN regexp_matches(t, '[0-9]') THEN regexp_replace(t, '[^\x20]*[0-9][^\x20]*', '<*>', 'g') ELSE t END AS masked
  FROM (SELECT k, doc_id, i, lines[i] AS line, trim(lines[i], ' ') AS t FROM (
    SELECT k, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (
      SELECT row_number() OVER () AS k, doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL)))),
w AS (SELECT *, string_split(masked, ' ') AS words, md5(masked) AS h FROM l),
leafed AS (SELECT *, concat_ws(' ', len(words), list_aggregate(words[1:3], 'string_agg', ' ')) AS leaf FROM w WHERE len(words) >= 3),
held AS (SELECT DISTINCT doc_id, leaf, h FROM leafed),
shared AS (SELECT leaf FROM held GROUP BY leaf HAVING count(DISTINCT doc_id) >= 3),
variants AS (SELECT leaf, h, count(*) AS docs FROM held JOIN shared USING (leaf) GROUP BY ALL),
heads AS (SELECT leaf, h AS head FROM variants QUALIFY row_number() OVER (PARTITION BY leaf ORDER BY docs DESC, h) = 1),
texts AS (SELECT DISTINCT leaf, h, words FROM leafed JOIN shared USING (leaf)),
joined AS (
  SELECT t.leaf, t.h, hd.head FROM texts t JOIN heads hd ON hd.leaf = t.leaf JOIN texts m ON m.leaf = t.leaf AND m.h = hd.head
  WHERE t.h <> hd.head AND len(list_filter(list_zip(t.words, m.words), lambda z: z[1] = z[2])) >= 0.7 * len(t.words)),
named AS (SELECT v.doc_id, v.leaf, v.h, coalesce(j.head, v.h) AS template FROM held v JOIN shared USING (leaf) LEFT JOIN joined j ON j.leaf = v.leaf AND j.h = v.h),
gone AS (SELECT leaf, template FROM named GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
lost AS (SELECT DISTINCT doc_id, h FROM named JOIN gone USING (leaf, template)),
done AS (
  SELECT w.k, count(*) AS n_lines, count(lost.h) AS n_dropped, coalesce(string_agg(w.line, chr(10) ORDER BY w.i) FILTER (WHERE lost.h IS NULL), '') AS text
  FROM w LEFT JOIN lost ON lost.doc_id = w.doc_id AND lost.h = w.h GROUP BY w.k)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, sha256(done.text) AS text_sha256
FROM (SELECT row_number() OVER () AS k, doc_id FROM documents) d LEFT JOIN done USING (k)
"""


@query("op3_line_templates", _ORACLE)
def _line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_templates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))
