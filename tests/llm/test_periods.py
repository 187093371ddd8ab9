"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tickloom.llm import periods


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if w[q:] == w[:len(w) - q])


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q) and smallest_period(words[i:j + q]) == q:
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


def sequences(rng):
    letters = rng.choice([1, 2, 2, 3, 5])
    out = []
    while len(out) < rng.randint(0, 120):
        unit = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.5:
            unit = [unit[0]] * rng.randint(1, 11) + unit[:rng.randint(1, 3)]
        out += (unit * rng.randint(1, 7))[:rng.randint(1, 80)]
        out += [rng.randrange(letters) for _ in range(rng.randint(0, 3))]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    documents = [sequences(rng) for _ in range(60)]
    numbers, document = np.array([x for d in documents for x in d], np.int64), np.repeat(np.arange(60), [len(d) for d in documents])
    at = np.cumsum([0, *map(len, documents)])
    got = {}
    for s, length, q in zip(*(c.tolist() for c in periods.find_runs(numbers, document))):
        k = int(document[s])
        got.setdefault(k, []).append((s - int(at[k]), length, q))
    assert got == {k: r for k, d in enumerate(documents) if (r := brute_runs(d))}


def test_wavelet_matrix_matches_sorting():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300):
        values = rng.permutation(n)
        index = periods.WaveletMatrix(values)
        lo = rng.integers(0, n, 400)
        hi, x = np.minimum(n, lo + rng.integers(0, n + 1, 400)), rng.integers(0, 2 * n + 1, 400)
        after, before = index.successor(lo, hi, x), index.predecessor(lo, hi, x)
        for a, b, v, s, p in zip(lo, hi, x, after, before):
            assert s == min((y for y in values[a:b] if y >= v), default=-1) and p == max((y for y in values[a:b] if y < v), default=-1)


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(9)
    texts = [rng.choice([" ", "\n", "\t "]).join(f"w{x}" for x in sequences(rng)) for _ in range(150)]
    rows = [(rng.choice([None, rng.randrange(10**6), k]), t) for k, t in enumerate(texts)]
    rows += [(7, None), (8, ""), (9, " \n"), (10, "one"), (10, "one"), (11, "Å é " * 9), (12, "x\x0bx\x0cx\rx x\tx x x")]
    rows += [(i, " ".join(f"v{rng.randrange(3000)}" for _ in range(900))) for i in range(100, 140)]
    docs = spark.createDataFrame([(*r, 1, "p", 0) for r in rows], "doc_id long, text string, starts int, collapsed string, n_words int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    from tickloom.llm.queries import QUERIES
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(brute_row(*r)) for r in rows)


def test_long_document_and_empty_table(spark):
    long = " ".join(["a b c d e"] * 60_000 + ["z"] + [f"w{k}" for k in range(50_000)])
    out = periods.periodic_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()[0]
    assert (out.starts, out.lengths, out.periods) == ([0], [300_000], [5]) and out.collapsed.split()[:6] == ["a", "b", "c", "d", "e", "z"]
    assert periods.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
