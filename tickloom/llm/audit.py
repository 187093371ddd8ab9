"""Interaction of quality filters: who removes what in every order of five filters.

A document that fails the filters of a set ``m`` survives exactly the subsets of filters that share nothing with ``m``.
These are the set bits of one 32-bit word. Adding up the words bit by bit gives the survivors of all 32 subsets, and
every figure of every order is a difference of two of them. The addition is carry-save: three words of one weight give
a sum word and a carry word of twice the weight, all 32 positions at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import query, table
from tickloom.session import publish

#: The filters, and what their failure conditions compare with.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, MARKS = 200, 50, 3, b"#$%&*|"
_CAPITALS = bytes(range(0x41, 0x5B))
#: Documents that are counted for each part: all, those with quality 1, those with toxic 1.
LABELS = ("whole", "good", "toxic")
#: Parts whose counters a task holds at once.
HELD_PARTS = 4096

#: The word of each set of failed filters: bit S is set if a document survives the subset S.
SURVIVAL = np.array([sum(1 << s for s in range(32) if not s & m) for m in range(32)], np.uint32)


def failures(text: str) -> int:
    """The filters A to D that a text fails, as bits 0 to 3."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    out = 1 if len(words) < LEAST_WORDS else 0
    if 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words):
        out |= 2
    if 100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MOST_CAPITALS_PERCENT * len(text):
        out |= 4
    return out | 8 if re.search(rb"[" + re.escape(MARKS) + rb"]", raw) else out


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        failed, digests = [], []
        for text in batch.column("text"):
            t = text.as_py() or ""
            failed.append(failures(t))
            digests.append(hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()), pa.array(failed, pa.int32())],
                                         ["doc_id", "part", "digest", "failed"])


class BitCounters:
    """How many of the words added have each bit set: vertical counters, one list of words for each power of two."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, words: np.ndarray) -> None:
        level = 0
        while len(words):
            if level == len(self.levels):
                self.levels.append(np.zeros(0, np.uint32))
            words, carries = np.concatenate((self.levels[level], words)), []
            while len(words) > 2:
                third = len(words) // 3
                a, b, c, rest = words[:third], words[third:2 * third], words[2 * third:3 * third], words[3 * third:]
                either = a ^ b
                carries.append(a & b | either & c)
                words = np.concatenate((either ^ c, rest))
            self.levels[level] = words
            words, level = np.concatenate(carries) if carries else np.zeros(0, np.uint32), level + 1

    def counts(self) -> np.ndarray:
        bits = np.arange(32, dtype=np.uint32)
        return sum((((words[:, None] >> bits) & np.uint32(1)).sum(0, dtype=np.int64) << k for k, words in enumerate(self.levels)), np.zeros(32, np.int64))


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, whole, good, toxic) with 32 survivor counts each, once or more per part."""
    held: dict[str, list[BitCounters]] = {}

    def out() -> pa.RecordBatch:
        arrays = [pa.array(list(held), pa.string())]
        arrays += [pa.array([c[k].counts().tolist() for c in held.values()], pa.list_(pa.int64())) for k in range(len(LABELS))]
        return pa.RecordBatch.from_arrays(arrays, ["part", *LABELS])

    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        code, words = parts.indices.to_numpy(zero_copy_only=False), SURVIVAL[batch.column("failed").to_numpy(zero_copy_only=False)]
        marks = [np.ones(len(words), bool), *(batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in LABELS[1:])]
        for k, part in enumerate(parts.dictionary.to_pylist()):
            here = code == k
            for counters, mark in zip(held.setdefault(part, [BitCounters() for _ in LABELS]), marks):
                counters.add(words[here & mark])
            if len(held) >= HELD_PARTS:
                yield out()
                held.clear()
    if held:
        yield out()


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All orders and steps of each part, from its survivor counts."""
    orders = [p for p in permutations(range(len(FILTERS)))]
    steps = [("".join(FILTERS[f] for f in p), k + 1, p[k], sum(1 << f for f in p[:k])) for p in orders for k in range(len(p))]
    names, numbers = [s[0] for s in steps], np.array([s[1:] for s in steps])
    step, bit, before = numbers[:, 0], 1 << numbers[:, 1], numbers[:, 2]
    everything = len(SURVIVAL) - 1
    for batch in batches:
        for part, *counts in zip(*(batch.column(c).to_pylist() for c in ("part", *LABELS))):
            whole, good, toxic = (np.array(c, np.int64) for c in counts)
            removed = whole[before] - whole[before | bit]
            share = np.array([sum(factorial(s.bit_count()) * factorial(4 - s.bit_count()) * (whole[s] - whole[s | 1 << f])
                                  for s in range(32) if not s >> f & 1) for f in range(len(FILTERS))])
            columns = [whole[before | bit], removed, whole[0] - whole[bit] - removed, whole[everything ^ bit] - whole[everything],
                       good[before] - good[before | bit], toxic[before] - toxic[before | bit], share[numbers[:, 1]]]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(steps)), pa.array(names), pa.array(step, pa.int32()), *(pa.array(c, pa.int64()) for c in columns)],
                                             ["part", "filter_order", "step", *FIGURES])


FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def survivors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part: ``whole``, ``good`` and ``toxic``, each 32 counts of the documents that survive every subset of filters.

    A part is a value of ``lang``, with null as the empty string. Null texts count as empty. A document without a doc_id
    is never an earlier or a later copy, and has no labels; rows of one doc_id are documents of their own, of which none
    is the copy of another. A doc_id with several rows in ``labels`` is good or toxic if one of them says so. Empty
    documents give no rows. Other columns are ignored. Copies meet by their SHA-256 digests: only the smallest doc_id of
    a digest is kept, and joined by digest and doc_id, so that a large group of copies is spread over tasks.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("part"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    facts = publish(rows.mapInArrow(_facts, f"doc_id {id_type}, part string, digest binary, failed int"), "filter-failures")
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    marks = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    # Rows without an id match nothing; the salt spreads them over the tasks of both joins.
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("digest") % 1024).otherwise(0)
    spread = facts.withColumn("__salt", salt.cast("long"))
    joined = spread.join(first.withColumn("__salt", F.lit(0).cast("long")).hint("merge"), ["digest", "doc_id", "__salt"], "left")
    joined = joined.join(marks.withColumn("__salt", F.lit(0).cast("long")).hint("merge"), ["doc_id", "__salt"], "left")
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    words = joined.select("part", (F.col("failed") + F.when(repeats, 16).otherwise(0)).alias("failed"),
                          *(F.coalesce(c, F.lit(0)).alias(c) for c in LABELS[1:]))
    counted = words.mapInArrow(_survivors, "part string, " + ", ".join(f"{c} array<bigint>" for c in LABELS))
    sums = [F.array(*(F.sum(F.col(c)[k]) for k in range(32))).alias(c) for c in LABELS]
    return counted.groupBy("part").agg(*sums)


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: the counts of ``FIGURES`` (see :func:`survivors` for what counts as a document)."""
    return survivors(docs, labels).mapInArrow(_report, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in FIGURES))


_ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
         'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), 'D': regexp_matches(t, '[#$%&*|]'),
         'E': coalesce(doc_id > least, false)} AS x
      FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda c: CASE c WHEN 'A' THEN x.A WHEN 'B' THEN x.B WHEN 'C' THEN x.C
        WHEN 'D' THEN x.D ELSE x.E END) AS fails, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
steps AS (SELECT o, s, substr(o, s, 1) AS c, string_split(left(o, s - 1), '') AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS s)),
r AS (SELECT part, o, s, c, g.n, good, toxic, fails, list_contains(fails, c) AS bad, list_has_any(fails, earlier) AS gone FROM g, steps),
t AS (SELECT part, o AS filter_order, s::INT AS step, c, sum(n) FILTER (NOT gone AND NOT bad) AS kept, sum(n) FILTER (NOT gone AND bad) AS removed,
        sum(n) FILTER (gone AND bad) AS redundant, sum(n) FILTER (fails = [c]) AS unique_fails,
        sum(n) FILTER (NOT gone AND bad AND good) AS good_lost, sum(n) FILTER (NOT gone AND bad AND toxic) AS toxic_lost
      FROM r GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, c), 0)::BIGINT AS shapley
FROM t
"""


@query("op13_filter_interactions", _ORACLE)
def _interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
