"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Words become templates: numbers, units and names turn into typed placeholders, other words into small letters without
marks. Windows of templates are hash-joined with those of the benchmark, and what the placeholders stand for must map
consistently along a match, so a question with other names and numbers is caught and chance matches are not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import query, table
from tickloom.session import publish

#: Words after a number that count as its unit.
UNITS = ("mm", "cm", "m", "km", "g", "kg", "mg", "lb", "oz", "ml", "l", "s", "min", "h", "hours", "minutes", "seconds",
         "days", "weeks", "months", "years", "miles", "feet", "inches", "metres", "meters", "dollars", "euros", "cents", "percent")
#: Opens a placeholder: a private-use character, removed from texts beforehand. Its type follows, then the word itself.
MARK = "\ue000"
WIDTH = 5
#: A match has so many windows at least, or all of its item's; and so many tokens that are literal or have the item's own value, or all.
LEAST, LITERAL = 3, 5
#: A match that removes a document has so many such tokens at least.
CLEAN_LITERAL = 3

#: The blank before a name; the blank comes first, so that other places cost one comparison.
_NAME = r"\x20(?<=[^.!?:\s]\x20)(?=\p{Lu}\p{Ll})"
_NUMBER = r"([0-9])(?<=(?:^|[\s($])[0-9])"
_UNIT = rf"({MARK}d[^\s]*\x20)({'|'.join(UNITS)})([\s.,;:!?)]|$)"
#: Characters of scripts that write words without blanks between them: each is a token.
_SOLID = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]"
_STRIP = r"[!-/:-@\[-`{-~]+"


def tokens(text: str = "text") -> Column:
    """Words in small letters without ASCII marks, placeholders as mark, type and word.

    A capitalised word is a name unless it opens a text, line or sentence.
    """
    whole = F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(MARK), F.lit(""))
    # Such characters have three bytes or more, so texts without any other than ASCII are not searched.
    solid = (F.octet_length(text) > F.char_length(text) + 1) & F.col(text).rlike(_SOLID)
    # Each text takes one branch, so nothing is replaced or matched twice.
    return F.when(solid, _words(F.regexp_replace(whole, f"({_SOLID})", "\x20$1\x20"), text)).otherwise(_words(whole, text))


def _words(out: Column, text: str) -> Column:
    named = F.regexp_replace(out, _NAME, f"\x20{MARK}n")
    numbered = F.regexp_replace(F.regexp_replace(named, _NUMBER, f"{MARK}d$1"), _UNIT, f"$1{MARK}u$2$3")
    out = F.when(F.col(text).rlike("[0-9]"), numbered).otherwise(named)
    return F.array_remove(F.split(F.lower(F.regexp_replace(out, _STRIP, "")), r"[\x20\x09-\x0D]+"), "")


def windows(rows: DataFrame, width: int = WIDTH, widths: Sequence[int] = ()) -> DataFrame:
    """The columns of ``rows`` but tokens, with place, hash and slots of every run of ``width`` tokens, and of ``widths``.

    ``slots`` has the words behind the placeholders of a run, null where it has none. The hash depends on the width.
    """
    kept = [c for c in rows.columns if c != "tokens"]
    plain = F.transform("tokens", lambda w: F.when(w.startswith(MARK), F.substring(w, 1, 2)).otherwise(w))
    rows = rows.withColumn("marked", F.exists("tokens", lambda w: w.startswith(MARK))).withColumn(
        "templates", F.when(F.col("marked"), plain).otherwise(F.col("tokens")))
    # Too short sequences give no runs here: a filter on their size would move below the tokens and make them twice.
    runs = [f"""transform(if(size(templates) < {n}, array(), sequence(1, size(templates) - {n - 1})), i -> named_struct(
        'place', i - 1, 'hash', xxhash64(slice(templates, i, {n})),
        'slots', if(marked, filter(slice(tokens, i, {n}), w -> startswith(w, '{MARK}')), null)))""" for n in (width, *widths)]
    rows = rows.select(*kept, F.explode(F.expr(runs[0] if len(runs) == 1 else f"concat({', '.join(runs)})")).alias("run"))
    return rows.select(*kept, "run.place", "run.hash", F.when(F.size("run.slots") > 0, F.col("run.slots")).alias("slots"))


def _placed(rows: DataFrame, width: int) -> DataFrame:
    """``windows`` of benchmark items of one width, with the places of their literal tokens and of their placeholders."""
    of = lambda kept: F.expr(
        f"filter(sequence(place, place + {width - 1}), p -> {kept} startswith(element_at(of, int(p + 1)), '{MARK}'))")
    found = windows(rows.withColumn("of", F.col("tokens")), width)
    return found.withColumns({"plain": of("not"), "held": of(""), "width": F.lit(width)}).drop("of")


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: float = 0.5, enough: int = 9) -> DataFrame:
    """(doc_id, unnamed, item_id, windows, literals): the benchmark items that each document holds, with the most windows and literals of a match.

    A match is a run of windows at one distance between document and item. It counts with ``share`` of the item's
    windows, but ``LEAST`` of them or else all, or with ``enough`` of them (nine windows of five words are 13 words), if
    every slot value of the item stands for one value of the document throughout and ``LITERAL`` tokens (all, in a
    shorter item) are literal or have the item's own value. An item of fewer than ``width`` words is one window of its
    own width, so that it has to be there whole and as it is. Null and empty items and texts match nothing. Repeated
    items are reported one by one; rows of one doc_id count as one document. Rows without doc_id have the MD5 of their text
    as ``unnamed`` (null for the others), so that each text stands for itself. Other columns are ignored, empty tables give no
    rows, and a long text is one array of its tokens and one row per window. The side of the benchmark is broadcast only
    if Spark finds its written size small.
    """
    listed = benchmark.select("item_id", tokens().alias("tokens"))
    short = sorted(r[0] for r in listed.select(F.size("tokens").alias("n")).where((F.col("n") > 0) & (F.col("n") < width)).distinct().collect())
    items = _placed(listed, width)
    for n in short:
        items = items.union(_placed(listed.where(F.size("tokens") == n), n))
    items = publish(items.distinct(), "items")
    wanted = items.groupBy("item_id").agg(F.count_distinct("place").alias("all"), F.max("width").alias("width"))
    wanted = wanted.select("item_id", F.greatest(F.least(F.ceil(F.col("all") * share), F.lit(enough)), F.least("all", F.lit(LEAST))).alias("needed"),
                           F.least(F.col("all") + F.col("width") - 1, F.lit(LITERAL)).alias("literal"))
    runs = windows(docs.select("doc_id", _unnamed(docs).alias("unnamed"), tokens().alias("tokens")), width, short)
    found = runs.join(items.select("item_id", F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots"), "plain", "held"), "hash")
    pairs = F.when(F.col("slots").isNotNull(), F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")))
    same = F.when(F.col("slots").isNotNull(), F.expr(
        "transform(filter(arrays_zip(held, item_slots, slots), x -> x.item_slots = x.slots), x -> x.held)")).otherwise(F.lit([]).cast("array<int>"))
    matched = found.groupBy("doc_id", "unnamed", "item_id", (F.col("place") - F.col("item_place")).alias("distance")).agg(
        F.count_distinct("item_place").alias("windows"), F.flatten(F.collect_set(pairs)).alias("pairs"),
        F.size(F.array_distinct(F.flatten(F.collect_set(F.concat("plain", same))))).alias("literals"))
    values = F.array_distinct(F.transform("pairs", lambda p: p["i"]))
    matched = matched.join(wanted, "item_id").where(
        (F.col("windows") >= F.col("needed")) & (F.col("literals") >= F.col("literal")) & (F.size(values) == F.size(F.array_distinct("pairs"))))
    return matched.groupBy("doc_id", "unnamed", "item_id").agg(F.max("windows").alias("windows"), F.max("literals").alias("literals"))


def _unnamed(docs: DataFrame) -> Column:
    return F.when(docs["doc_id"].isNull(), F.md5(docs["text"].cast("binary")))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, n_items, items (ids in order, comma-joined)."""
    found = leaks(docs, benchmark).groupBy(F.col("doc_id").alias("of"), "unnamed").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    rows = docs.select("doc_id", _unnamed(docs).alias("mine"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & F.col("mine").eqNullSafe(F.col("unnamed")), "left")
    count = F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids"))
    return rows.select("doc_id", (count > 0).alias("contaminated"), count.cast("long").alias("n_items"),
                       F.coalesce(F.array_join("ids", ","), F.lit("")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item of ``CLEAN_LITERAL`` literal tokens or more, all columns as they are.

    Shorter items ("Yes") are part of many clean texts; :func:`report` has them.
    """
    found = leaks(docs, benchmark).where(F.col("literals") >= CLEAN_LITERAL).select(F.col("doc_id").alias("of"), F.col("unnamed").alias("mine")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["of"]) & _unnamed(docs).eqNullSafe(found["mine"]), "left_anti")


def _sql_tokens(source: str, key: str) -> str:
    units = "|".join(UNITS)
    text = f"replace(coalesce(text, ''), '{MARK}', '')"
    text = rf"CASE WHEN regexp_matches(text, '{_SOLID}') THEN regexp_replace({text}, '({_SOLID})', ' \1 ', 'g') ELSE {text} END"
    name = r"regexp_replace({}, '([^.!?:\s]\x20)(\p{{Lu}}\p{{Ll}})', '\1" + MARK + r"n\2', 'g')"
    named = name.format(name.format(text))
    numbered = (rf"regexp_replace(regexp_replace({named}, '(^|[\s($])([0-9])', '\1{MARK}d\2', 'g'), "
                rf"'({MARK}d[^\s]*\x20)({units})([\s.,;:!?)]|$)', '\1{MARK}u\2\3', 'g')")
    return (rf"SELECT {key}, regexp_extract_all(lower(regexp_replace(CASE WHEN regexp_matches(text, '[0-9]') THEN {numbered} ELSE {named} END, "
            rf"'[!-/:-@\[-`{{-~]+', '', 'g')), '[^\x20\x09-\x0D]+') AS w FROM {source}")


_PLAIN = f"list_transform(x, lambda y: CASE WHEN starts_with(y, '{MARK}') THEN y[1:2] ELSE y END)"
_ORACLE = f"""
WITH d AS MATERIALIZED ({_sql_tokens('documents', 'doc_id, text')}), b AS MATERIALIZED (SELECT *, least(len(w), {WIDTH}) AS width FROM ({_sql_tokens('benchmark', 'item_id')})),
dw AS (SELECT coalesce('i' || doc_id, 't' || md5(text)) AS k, width, unnest(range(0, len(w) - width + 1)) AS place, w FROM d, (SELECT DISTINCT width FROM b WHERE width > 0 UNION SELECT {WIDTH}) WHERE len(w) >= width),
bw AS (SELECT DISTINCT item_id, width, unnest(range(0, len(w) - width + 1)) AS place, w FROM b WHERE width > 0),
dt AS (SELECT *, {_PLAIN} AS t FROM (SELECT k, place, list_slice(w, place + 1, place + width) AS x FROM dw)),
bt AS MATERIALIZED (SELECT *, {_PLAIN} AS t FROM (SELECT item_id, width, place, list_slice(w, place + 1, place + width) AS x FROM bw)),
needed AS (SELECT item_id, greatest(least(ceil(n * 0.5), 9), least(n, {LEAST})) AS needed, least(n + width - 1, {LITERAL}) AS literal
  FROM (SELECT item_id, count(DISTINCT place) AS n, max(width) AS width FROM bt GROUP BY item_id)),
hit AS MATERIALIZED (SELECT dt.k, bt.item_id, dt.place - bt.place AS distance, bt.place, dt.x AS dx, bt.x AS bx FROM dt JOIN bt ON dt.t = bt.t),
slot AS MATERIALIZED (SELECT k, item_id, distance, unnest(range(place, place + len(bx))) AS token, unnest(bx) AS i, unnest(dx) AS v FROM hit),
torn AS (SELECT DISTINCT k, item_id, distance FROM slot WHERE starts_with(i, '{MARK}') GROUP BY k, item_id, distance, i HAVING count(DISTINCT v) > 1),
same AS (SELECT k, item_id, distance, count(DISTINCT token) AS literals FROM slot WHERE i = v GROUP BY ALL),
runs AS (SELECT k, item_id, distance, count(DISTINCT place) AS n FROM hit GROUP BY ALL),
leak AS (SELECT DISTINCT k, item_id FROM runs JOIN needed USING (item_id) JOIN same USING (k, item_id, distance) ANTI JOIN torn USING (k, item_id, distance)
         WHERE n >= needed AND literals >= literal),
ids AS (SELECT k, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items FROM leak GROUP BY k)
SELECT documents.doc_id, n IS NOT NULL AS contaminated, CAST(coalesce(n, 0) AS BIGINT) AS n_items, coalesce(items, '') AS items
FROM documents LEFT JOIN ids ON ids.k = coalesce('i' || doc_id, 't' || md5(text))
"""


@query("op10_benchmark_templates", _ORACLE)
def _templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
