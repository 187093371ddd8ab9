"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Known entities (e-mail, IP, card, phone) are the seeds. What stands before an identifier, its last word or its last two words,
is a lexical pattern. Patterns and the values that they introduce form a graph, which is scored in rounds: a pattern's
confidence is the score of the values it introduces over all places where its words occur in the corpus, followed by
anything; a value scores as its best trusted pattern. Values that are no entity of a known form but score high are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import query, table
from tickloom.session import publish


@dataclass(frozen=True)
class Kind:
    """An entity: its pattern for Java and for RE2, the SQL test of a match ``m`` (Spark's and DuckDB's), what its texts must hold.

    The Java pattern finds the same matches without trying every start inside a long word and without recursion.
    """
    name: str
    java: str
    re2: str
    valid: str
    valid_duckdb: str
    needs: str


_OCTET = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP = rf"^{_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET}$"


def _digits(most: int, least: int, of: str) -> str:
    return f"length({of}) BETWEEN {least} AND {most}"


_BARE, _BARE_DUCKDB = "regexp_replace(m, '[^0-9]', '')", "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (f"aggregate(transform(sequence(1, length({_BARE})), j -> cast(substr({_BARE}, -j, 1) as int) * (2 - j % 2)), 0L, "
         "(s, v) -> s + v div 10 + v % 10) % 10 = 0")
_LUHN_DUCKDB = (f"list_sum(list_transform(range(1, length({_BARE_DUCKDB}) + 1), lambda j: CAST({_BARE_DUCKDB}[length({_BARE_DUCKDB}) + 1 - j] AS INT) * (2 - j % 2) // 10"
                f" + CAST({_BARE_DUCKDB}[length({_BARE_DUCKDB}) + 1 - j] AS INT) * (2 - j % 2) % 10)) % 10 = 0")

#: The base entities, in the order of their kinds.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", "true", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         f"m rlike r'{_IP}'", f"regexp_matches(m, '{_IP}')", "[0-9][.][0-9]"),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", r"[0-9]([\x20-]?[0-9])+",
         f"CASE WHEN {_digits(19, 12, _BARE)} THEN {_LUHN} ELSE false END", f"CASE WHEN {_digits(19, 12, _BARE_DUCKDB)} THEN {_LUHN_DUCKDB} ELSE false END", r"[0-9][\x20-]?[0-9]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
         _digits(15, 9, _BARE), _digits(15, 9, _BARE_DUCKDB), r"\+[0-9]"),
)
#: The kind of added spans.
LEARNED = "learned"

#: What patterns can introduce: phones, groups of digits, and words of these characters that hold a digit or an ``@``.
_WORD, _EDGE = "A-Za-z0-9._%+@#/-", "._%#/-"
_START = _WORD.replace("0-9", "").replace("@", "")
_BY_NAME = {k.name: k for k in BASE}
ANY_JAVA = "|".join((_BY_NAME["phone"].java, r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++){2,}+", rf"(?:\G|(?<![{_WORD}]))[{_START}]*+[0-9@][{_WORD}]*+"))
ANY_RE2 = "|".join((_BY_NAME["phone"].re2, r"[0-9]+(?:[\x20-][0-9]+){2,}", rf"[{_START}]*[0-9@][{_WORD}]*"))

#: A value that is no known entity has so many characters and digits at least.
LEAST_CHARACTERS, LEAST_DIGITS = 5, 3
#: Characters before a value in which its last two words are sought; a longer word is cut.
CONTEXT = 200
#: A trusted pattern introduces so many different values at least, with this confidence, in thousandths.
LEAST_VALUES, LEAST_CONFIDENCE = 3, 600
ROUNDS = 3

_BLANKS = r"[\x20\x09-\x0D]+"
#: The form of a whole value of each kind.
_FORMS = {"email": r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:[.][A-Za-z0-9-]++)++$", "ip": r"^[0-9]++(?:[.][0-9]++){3}$",
          "card": r"^[0-9](?:[\x20-]?[0-9])++$", "phone": r"^[+][0-9][\x20().0-9-]+[0-9]$"}
_SPAN = "struct<start:int,rule:int,end:int,kind:string>"


def _placed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds ``<name>_s``, the starts of the matches ``<name>_m`` among the gaps of lengths ``<name>_g``.

    Lengths are summed within blocks of about the square root of their number, and over blocks, so that a text of very
    many matches does not sum them all for each.
    """
    df = df.selectExpr("*", *(f"zip_with(slice({n}_g, 1, size({n}_m)), {n}_m, (g, m) -> g + length(m)) as {n}_x" for n in names),
                       *(f"cast(ceil(sqrt(size({n}_m))) as int) as {n}_b" for n in names))
    starts = (
        "transform(slice({n}_g, 1, size({n}_m)), (g, i) -> g + aggregate(slice(tops, 1, cast(i div {n}_b as int)), 0, (s, v) -> s + v)"
        " + aggregate(slice({n}_x, cast(i div {n}_b as int) * {n}_b + 1, i % {n}_b), 0, (s, v) -> s + v))")
    tops = "transform(sequence(0, greatest({n}_b, 1) - 1), k -> aggregate(slice({n}_x, k * {n}_b + 1, {n}_b), 0, (s, v) -> s + v))"
    # The one-element array binds the block sums, so that they are made once and not for each match.
    return df.selectExpr("*", *(f"element_at(transform(array({tops.format(n=n)}), tops -> {starts.format(n=n)}), 1) as {n}_s" for n in names))


def entities(docs: DataFrame) -> DataFrame:
    """(key, doc_id, base, values): the base spans of each row, and what its patterns can introduce.

    ``values`` holds (start, end, value, known, last, both): every entity and every word with digits, whether it is an entity,
    and the last word and last two words before it. ``key`` numbers the rows; the table is written, so that numbers stay.
    """
    names = [k.name for k in BASE]
    rows = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("t"))
    columns = []
    for kind in BASE:
        sought = F.contains("t", F.lit("@")) if kind.needs == "@" else F.col("t").rlike(kind.needs)
        columns += [F.when(sought, F.regexp_extract_all("t", F.lit(kind.java), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(f"{kind.name}_m"),
                    F.when(sought, F.transform(F.split("t", kind.java, -1), F.length)).otherwise(F.array().cast("array<int>")).alias(f"{kind.name}_g")]
    sought = F.col("t").rlike("[0-9@]")
    gap = F.transform(F.split("t", ANY_JAVA, -1), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(CONTEXT)).alias("tail")))
    columns += [F.when(sought, F.regexp_extract_all("t", F.lit(ANY_JAVA), F.lit(0))).otherwise(F.array().cast("array<string>")).alias("any_m"),
                F.when(sought, gap).otherwise(F.array().cast("array<struct<n:int,tail:string>>")).alias("gaps")]
    found = rows.select("key", "doc_id", *columns).withColumn("any_g", F.col("gaps.n"))
    found = _placed(found, [*names, "any"])
    spans = [f"transform(filter(transform({k.name}_m, (m, i) -> struct({k.name}_s[i] as start, {n} as rule, {k.name}_s[i] + length(m) as end,"
             f" '{k.name}' as kind, {k.valid} as ok)), x -> x.ok), x -> struct(x.start, x.rule, x.end, x.kind))" for n, k in enumerate(BASE)]
    known = "CASE " + " ".join(f"WHEN m rlike r'{_FORMS[k.name]}' THEN {k.valid}" for k in BASE) + " ELSE false END"
    before = f"filter(split(lower(right(concat(if(i > 0, any_m[i - 1], ''), gaps[i].tail), {CONTEXT})), r'{_BLANKS}'), w -> w <> '')"
    trimmed = (f"transform(any_m, (m, i) -> struct(any_s[i] + length(m) - length(ltrim('{_EDGE}', m)) as start, ltrim('{_EDGE}', rtrim('+{_EDGE}', m)) as value, {before} as words))")
    values = (f"transform({trimmed}, x -> struct(x.start, x.start + length(x.value) as end, x.value, {known.replace('m rlike', 'x.value rlike').replace('(m,', '(x.value,')} as known, x.words))")
    shaped = f"x.known or length(x.value) >= {LEAST_CHARACTERS} and length(regexp_replace(x.value, '[^0-9]', '')) >= {LEAST_DIGITS}"
    found = found.selectExpr("key", "doc_id", f"sort_array(concat({', '.join(spans)})) as base", f"filter({values}, x -> {shaped}) as seen")
    return publish(found.selectExpr("key", "doc_id", "base", (
        "transform(seen, x -> struct(x.start, x.end, x.value, x.known, try_element_at(x.words, -1) as last, "
        "try_element_at(x.words, -2) || ' ' || try_element_at(x.words, -1) as both)) as values")), "entities")


def pattern_edges(found: DataFrame) -> DataFrame:
    """(pattern, value, known, n): how often each pattern introduces each value, for patterns that introduce ``LEAST_VALUES`` values."""
    each = found.select(F.explode("values").alias("v")).select(F.explode(F.array("v.last", "v.both")).alias("pattern"), "v.value", "v.known")
    edges = each.where("pattern is not null").groupBy("pattern", "value", "known").agg(F.count(F.lit(1)).alias("n"))
    edges = publish(edges, "pattern-edges")
    several = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("fills")).where(F.col("values") >= LEAST_VALUES)
    return publish(edges.join(several, "pattern").select("pattern", "value", "known", "n", "fills"), "pattern-edges")


def occurrences(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """(pattern, total): how often the words of each pattern occur in the corpus, whatever follows.

    Words other than the last words of patterns are left out first, then pairs that are no pattern, and what is left is
    counted where it is read. Patterns and their last words are one small row each, and Spark broadcasts them only where its
    measure of them allows.
    """
    patterns = publish(edges.groupBy("pattern").agg(F.first("fills").alias("fills")), "patterns")
    last = publish(patterns.select(F.substring_index("pattern", " ", -1).alias("w")).distinct(), "last-words")
    words = docs.where("text is not null").select(F.split(F.lower("text"), _BLANKS).alias("words"))
    pairs = words.select(F.inline(F.arrays_zip(F.col("words").alias("w"), F.concat(F.array(F.lit("")), "words").alias("before"))))
    each = pairs.join(last, "w", "left_semi").select(F.explode(F.array("w", F.concat_ws(" ", "before", "w"))).alias("pattern"))
    counts = publish(each.join(patterns, "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "pattern-counts")
    total = patterns.join(counts, "pattern", "left").select("pattern", F.greatest(F.coalesce("n", F.lit(0)), "fills").alias("total"))
    return publish(total, "pattern-totals")


def scored_values(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, score) of the values that trusted patterns introduce and that are no known entities, in thousandths.

    In each round a pattern's confidence is the score of all it introduces, over its occurrences and one more; entities score
    1,000, other values as the best pattern that the round before trusted. Whole numbers make the result the same on every run.
    """
    seeds = publish(edges.where("known").select("value", F.lit(1000).cast("bigint").alias("score")).distinct(), "scores")
    scores = seeds
    for _ in range(rounds):
        mass = edges.join(scores, "value").groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("mass"), F.count(F.lit(1)).alias("values"))
        trusted = mass.join(totals, "pattern").withColumn("confidence", F.expr("mass div (total + 1)"))
        trusted = trusted.where((F.col("values") >= LEAST_VALUES) & (F.col("confidence") >= LEAST_CONFIDENCE))
        learned = edges.where("not known").join(trusted.select("pattern", "confidence"), "pattern").groupBy("value").agg(F.max("confidence").alias("score"))
        learned = publish(learned, "scores")
        scores = seeds.unionByName(learned)
    return learned


def scan(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id and ``found``, the spans (start, rule, end, kind) in each row of ``docs``, by start and rule.

    Base entities come with the rule of their place in ``BASE``; every occurrence of a value learned from the whole table
    follows as ``LEARNED`` unless it overlaps a base span. Positions count code points, ends are exclusive. Null and empty
    texts hold nothing and introduce nothing. Every row is scanned for itself, also where doc_ids repeat or are null; copies count
    as often as they occur, but a pattern needs different values. Other columns are ignored; empty tables give no rows.
    """
    docs = docs.select("doc_id", "text")
    found = entities(docs)
    edges = pattern_edges(found)
    learned = scored_values(edges, occurrences(docs, edges), rounds)
    places = found.select("key", F.explode("values").alias("v")).where("not v.known").select("key", "v.start", "v.end", "v.value")
    more = places.join(learned, "value").groupBy(F.col("key").alias("of")).agg(F.sort_array(F.collect_list(F.struct(
        "start", F.lit(len(BASE)).alias("rule"), "end", F.lit(LEARNED).alias("kind")))).alias("more"))
    free = f"filter(coalesce(more, cast(array() as array<{_SPAN}>)), e -> not exists(base, b -> b.start < e.end and e.start < b.end))"
    return found.join(more, F.col("key") == F.col("of"), "left").selectExpr("doc_id", f"sort_array(concat(base, {free})) as found")


# --- SQL -------------------------------------------------------------------------------------------------------------

def _sql_base(n: int, k: Kind) -> str:
    at = f"""coalesce(list_sum(list_transform(g[1:i], lambda y: length(y))), 0)::INT + coalesce(list_sum(list_transform(x[1:i - 1], lambda y: length(y))), 0)::INT"""
    return f"""
{k.name} AS (SELECT k, {n} AS rule, '{k.name}' AS kind, s, s + length(m) AS e FROM (
  SELECT k, unnest(x) AS m, unnest(list_transform(range(1, len(x) + 1), lambda i: {at})) AS s
  FROM (SELECT k, regexp_extract_all(t, '{k.re2}', 0) AS x, regexp_split_to_array(t, '{k.re2}') AS g FROM d)) WHERE {k.valid_duckdb})"""


def _sql_round(r: int, before: str) -> str:
    return f"""
trusted{r} AS (SELECT pattern, sum(n * score)::BIGINT // (any_value(total) + 1) AS confidence FROM edges JOIN {before} USING (value) JOIN totals USING (pattern)
  GROUP BY pattern HAVING count(*) >= {LEAST_VALUES} AND sum(n * score)::BIGINT // (any_value(total) + 1) >= {LEAST_CONFIDENCE}),
learned{r} AS (SELECT value, max(confidence) AS score FROM edges JOIN trusted{r} USING (pattern) WHERE NOT known GROUP BY 1),
scores{r} AS (SELECT * FROM scores0 UNION ALL SELECT * FROM learned{r})"""


_KNOWN_DUCKDB = "CASE " + " ".join(f"WHEN regexp_matches(m, '{_FORMS[k.name].replace('++', '+')}') THEN {k.valid_duckdb}" for k in BASE) + " ELSE false END"
_AT = ("coalesce(list_sum(list_transform(g[1:i], lambda y: length(y))), 0)::INT + coalesce(list_sum(list_transform(x[1:i - 1], lambda y: length(y))), 0)::INT")
_LIST = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rule)"
_ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), {','.join(_sql_base(n, k) for n, k in enumerate(BASE))},
base AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM {k.name}' for k in BASE)}),
anything AS (SELECT k, m, s, s + length(m) AS e, {_KNOWN_DUCKDB} AS known,
    list_filter(regexp_split_to_array(lower(right(before, {CONTEXT})), '{_BLANKS}'), lambda w: w <> '') AS words
  FROM (SELECT k, ltrim(rtrim(raw, '+{_EDGE}'), '{_EDGE}') AS m, s + length(raw) - length(ltrim(raw, '{_EDGE}')) AS s, before FROM (
        SELECT k, unnest(x) AS raw, unnest(list_transform(range(1, len(x) + 1), lambda i: {_AT})) AS s,
          unnest(list_transform(range(1, len(x) + 1), lambda i: CASE WHEN i > 1 THEN x[i - 1] ELSE '' END || right(g[i], {CONTEXT}))) AS before
        FROM (SELECT k, regexp_extract_all(t, '{ANY_RE2}', 0) AS x, regexp_split_to_array(t, '{ANY_RE2}') AS g FROM d)))),
seen AS MATERIALIZED (SELECT k, m AS value, s, e, known, words[-1] AS l1, words[-2] || ' ' || words[-1] AS l2 FROM anything
  WHERE known OR length(m) >= {LEAST_CHARACTERS} AND length({_BARE_DUCKDB}) >= {LEAST_DIGITS}),
every AS (SELECT pattern, value, known, count(*) AS n FROM (SELECT l1 AS pattern, value, known FROM seen UNION ALL SELECT l2, value, known FROM seen)
  WHERE pattern IS NOT NULL GROUP BY ALL),
edges AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY pattern)::BIGINT AS fills FROM every QUALIFY count(*) OVER (PARTITION BY pattern) >= {LEAST_VALUES}),
words AS (SELECT regexp_split_to_array(lower(t), '{_BLANKS}') AS w FROM d),
pairs AS (SELECT unnest(w) AS w, unnest(list_prepend('', w[:-2])) AS before FROM words),
counts AS (SELECT w AS pattern, count(*) AS n FROM pairs GROUP BY 1 UNION ALL SELECT before || ' ' || w, count(*) FROM pairs GROUP BY 1),
totals AS MATERIALIZED (SELECT pattern, greatest(coalesce(max(c.n), 0), max(fills)) AS total FROM edges LEFT JOIN counts c USING (pattern) GROUP BY 1),
scores0 AS (SELECT DISTINCT value, 1000 AS score FROM edges WHERE known),{','.join(_sql_round(r, f'scores{r - 1}') for r in range(1, ROUNDS + 1))},
more AS (SELECT k, {len(BASE)} AS rule, '{LEARNED}' AS kind, s, e FROM seen JOIN learned{ROUNDS} USING (value)
  WHERE NOT known AND NOT EXISTS (SELECT 1 FROM base b WHERE b.k = seen.k AND b.s < seen.e AND seen.s < b.e)),
b AS (SELECT k, {', '.join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in BASE)}, {_LIST} AS listed FROM base GROUP BY k),
a AS (SELECT k, count(*) FILTER (rule = {len(BASE)}) AS n_{LEARNED}, {_LIST} AS listed FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY k)
SELECT doc_id, {', '.join(f'coalesce(n_{k.name}, 0) AS n_{k.name}' for k in BASE)}, coalesce(n_{LEARNED}, 0) AS n_{LEARNED},
       sha256(coalesce(b.listed, '')) AS base_sha256, coalesce(a.listed, '') AS spans
FROM d LEFT JOIN b USING (k) LEFT JOIN a USING (k)
"""


@query("op12_personal_data", _ORACLE)
def _personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = '{name}')) as bigint)").alias(f"n_{name}") for name in (*(k.name for k in BASE), LEARNED)]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["rule"] < len(BASE))
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
