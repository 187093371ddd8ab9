"""Secret scanning with a trigram inverted index, in DataFrame functions only.

Each rule's regex yields a Boolean query: alternatives of trigrams that a match must contain. Postings (trigram,
document) are built for all trigrams of the queries, intersected per document, and only the candidates of a rule are
scanned by its regex. A rule with an alternative that has no trigram scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import query, table
from tickloom.session import publish


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose group ``group`` has at least ``least`` characters.

    Matches are leftmost and do not overlap; one that is too short is dropped but keeps its characters.
    """
    kind: str
    pattern: str
    group: int
    least: int


#: The base rules, in the order of their kinds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further rules, whose trigrams make them cheap.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams (small letters), one of which every match contains whole; None if nothing is mandatory.

    A pattern becomes alternatives of literal pieces: literals lengthen a piece, optional parts and branches fork, and
    anything else ends a piece.
    """
    def grow(items, heads):
        for op, value in items:
            op = str(op)
            if op == "LITERAL":
                heads = [(*h[:-1], h[-1] + chr(value).lower()) for h in heads]
            elif op == "SUBPATTERN":
                heads = grow(value[-1], heads)
            elif op == "BRANCH":
                heads = [g for part in value[1] for g in grow(part, heads)]
            elif op == "MAX_REPEAT" and value[:2] == (0, 1) and str(value[2][0][0]) in ("LITERAL", "SUBPATTERN"):
                heads = heads + grow(value[2], heads)
            elif op == "MAX_REPEAT" and value[0] >= 1:
                heads = [(*g, "") for g in grow(value[2], heads)]
            else:
                heads = [(*h, "") for h in heads]
        return heads

    from re import _parser as parser
    out = set()
    for pieces in grow(parser.parse(pattern), [("",)]):
        grams = frozenset(p[i:i + 3] for p in pieces for i in range(len(p) - 2))
        if not grams:
            return None
        out.add(grams)
    return sorted(out, key=sorted)


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The index: (gram, doc_id) for each of the given trigrams in each text, letters folded."""
    small = F.lower("text")
    present = F.filter(F.array(*(F.when(F.contains(small, F.lit(g)), F.lit(k)) for k, g in enumerate(grams))), lambda x: x.isNotNull())
    return docs.where("text is not null").select("doc_id", F.explode(present).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], grams: list[str]) -> DataFrame:
    """(doc_id, rules): the bits of the rules whose query a document's postings satisfy, where there are any."""
    place = {g: 1 << k for k, g in enumerate(grams)}
    masks = index.groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, gram)")).alias("mask"))
    found = F.lit(0)
    for k, rule in enumerate(rules):
        asked = trigram_query(rule.pattern)
        if asked is None:
            continue
        met = F.lit(False)
        for alternative in asked:
            need = sum(place[g] for g in alternative)
            met = met | (F.col("mask").bitwiseAND(F.lit(need)) == need)
        found = found + F.when(met, 1 << k).otherwise(0)
    return masks.select("doc_id", found.alias("rules")).where("rules > 0")


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, rule order, end, kind) of a rule's matches, from the lengths of matches and of what is between."""
    pattern = F.lit(rule.pattern)
    whole, part = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
    lengths = F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
                           F.transform(whole, F.length).alias("size"), F.transform(part, F.length).alias("held"))
    empty = F.array().cast("array<struct<start:int,rule:int,end:int,kind:string>>")
    walked = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda acc, m: F.struct(
        (acc["at"] + m["gap"] + F.coalesce(m["size"], F.lit(0))).alias("at"),
        F.when(m["held"] >= rule.least, F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + m["gap"]).alias("start"), F.lit(order).alias("rule"),
            (acc["at"] + m["gap"] + m["size"]).alias("end"), F.lit(rule.kind).alias("kind"))))).otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])
    return F.when(text.rlike(rule.pattern), walked).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id and ``found``, the spans (start, rule, end, kind) of all rules in each row of ``docs``, by start and rule.

    Positions count code points; ends are exclusive. Null and empty texts hold nothing. The index only narrows what is
    scanned, so rows that share a doc_id, or have none, share candidates but are scanned each for itself. Other columns
    are ignored.
    """
    docs = docs.select("doc_id", "text")
    grams = sorted({g for r in rules for alternative in trigram_query(r.pattern) or () for g in alternative})
    if len(grams) > 63:
        raise ValueError("more than 63 trigrams; scan the rules in two groups")
    index = publish(postings(docs, grams), "trigrams")
    chosen = candidates(index, rules, grams).withColumnRenamed("doc_id", "__of")
    # The hint keeps candidates that grow with the input from being broadcast.
    rows = docs.join(chosen.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col("__of")), "left")
    text, bits = F.coalesce("text", F.lit("")), F.coalesce("rules", F.lit(0))
    empty = F.array().cast("array<struct<start:int,rule:int,end:int,kind:string>>")
    found = [_spans(text, r, k) if trigram_query(r.pattern) is None
             else F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, _spans(text, r, k)).otherwise(empty) for k, r in enumerate(rules)]
    return rows.select("doc_id", F.sort_array(F.concat(*found)).alias("found"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql_rule(rule: Rule) -> str:
    keywords = {c: f"[{c}{c.upper()}]" for c in "abcdefghijklmnopqrstuvwxyz"}
    pattern = re.sub(r"\(\?i:([^)]*)\)", lambda m: "(?:" + "".join(keywords.get(c, c) for c in m[1]) + ")", rule.pattern).replace("'", "''")
    return f"""
{rule.kind} AS (
  SELECT k, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'start': coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)::INT
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::INT, 'size': length(m[i]), 'held': length(h[i])}}), lambda s: s.held >= {rule.least}) AS spans
  FROM (SELECT k, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS h, regexp_split_to_array(t, '{pattern}') AS g FROM d))"""


def _sql_list(rules: tuple[Rule, ...], first: int = 0) -> str:
    every = " UNION ALL ".join(f"SELECT k, {n} AS rule, '{r.kind}' AS kind, unnest(spans) AS s FROM {r.kind}" for n, r in enumerate(rules))
    return (f"SELECT k, string_agg(kind || ':' || s.start || ':' || (s.start + s.size), ',' ORDER BY s.start, rule) AS spans FROM ({every}) GROUP BY k")


_ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), {','.join(map(_sql_rule, BASE + MORE))},
base AS ({_sql_list(BASE)}), whole AS ({_sql_list(BASE + MORE)})
SELECT d.doc_id, CAST(len(assign.spans) AS BIGINT) AS n_assign, CAST(len(access.spans) AS BIGINT) AS n_access,
       CAST(len(hex.spans) AS BIGINT) AS n_hex, sha256(coalesce(base.spans, '')) AS base_sha256, coalesce(whole.spans, '') AS spans
FROM d JOIN assign USING (k) JOIN access USING (k) JOIN hex USING (k) LEFT JOIN base USING (k) LEFT JOIN whole USING (k)
"""


@query("op4_secret_spans", _ORACLE)
def _secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = '{r.kind}')) as bigint)").alias(f"n_{r.kind}") for r in BASE]
    base = F.filter("found", lambda s: s["rule"] < len(BASE))
    return rows.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))
