"""Filter interactions against direct counting."""

import random
from itertools import permutations

import numpy as np

from tickloom.llm import audit

DOCS = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int, text string, lang string"


def brute(docs, labels):
    parts = {}
    for k, (i, text, lang, *_) in enumerate(docs):
        t = text or ""
        words = t.encode().split()
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": any(c in "#$%&*|" for c in t),
                 "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in docs)}
        mine = [x for x in labels if x[0] == i and i is not None]
        parts.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part, rows in parts.items():
        share = dict.fromkeys("ABCDE", 0)
        for p in permutations("ABCDE"):
            for k, f in enumerate(p):
                gone = [bool(r[0] & set(p[:k])) for r in rows]
                lost = [r for r, g in zip(rows, gone) if not g and f in r[0]]
                share[f] += len(lost)
                out[part, "".join(p), k + 1] = [sum(not g and f not in r[0] for r, g in zip(rows, gone)), len(lost),
                                                sum(g and f in r[0] for r, g in zip(rows, gone)), sum(r[0] == {f} for r in rows),
                                                sum(r[1] for r in lost), sum(r[2] for r in lost)]
        for (q, p, k), v in out.items():
            if q == part:
                v.append(share[p[k - 1]])
    return out


def texts(rng):
    small = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 150, 230, 260])))
    few = " ".join(f"w{rng.randrange(60)}" for _ in range(240))
    return rng.choice([small, few, small.upper(), small + " $", few + " |", "", None, small])


def test_interactions_match_direct_counting(spark):
    rng = random.Random(5)
    pool = [texts(rng) for _ in range(40)]
    docs = [(rng.choice([None, *range(60)]), rng.choice(pool), rng.choice(["en", "de", None, ""]), "s") for _ in range(150)]
    labels = [(rng.choice([None, *range(70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x", "zz") for _ in range(60)]
    got = audit.interactions(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): [r[f] for f in audit.FIGURES] for r in got} == brute(docs, labels)


def test_one_text_in_most_rows_and_very_long_texts(spark):
    docs = [(k, "same", "en", "s") for k in range(400)] + [(1000, "é" * 1_000_000, "en", "s"), (1001, "Ab " * 300_000, "fr", "s")]
    got = audit.interactions(spark.createDataFrame(docs, DOCS).repartition(7), spark.createDataFrame([], LABELS)).collect()
    assert {(r.part, r.filter_order, r.step): [r[f] for f in audit.FIGURES] for r in got} == brute(docs, [])


def test_empty_tables_and_clashing_columns(spark):
    nothing = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([(1, 1, 0, "x", "zz")], LABELS)
    assert audit.interactions(nothing, labels).count() == 0
    docs = spark.createDataFrame([(1, "a b", "en", 7, "p", 1, 2)], "doc_id long, text string, lang string, quality int, part string, failed int, good int")
    assert {r.good_lost for r in audit.interactions(docs, labels).collect()} == {0, 1}


def test_counters_count_bits():
    rng = np.random.default_rng(2)
    counters, every = audit.BitCounters(), []
    for n in (0, 1, 2, 3, 1000, 7, 4097):
        words = rng.integers(0, 2 ** 32, n, dtype=np.uint32)
        counters.add(words)
        every.append(words)
    every = np.concatenate(every)
    assert counters.counts().tolist() == [int(((every >> np.uint32(b)) & np.uint32(1)).sum()) for b in range(32)]
