import numpy as np
import pytest

from tickloom.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    good = [(i, np.array(v, np.float64), lab) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {(a[0], b[0]) for k, a in enumerate(good) for b in good[:k]
             if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= threshold}
    low = {i: i for i, _, _ in rows}
    for _ in rows:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return {i: (sum(i in p for p in links), low[i], low[i] == i and i is not None) for i, _, _ in rows}


def made(n, seed, d=32):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = rng.normal(size=d)
        rows.append((base, int(rng.integers(0, 3))))
        for _ in range(int(rng.integers(0, 5))):
            rows.append((base + rng.normal(size=d) * rng.uniform(0, 0.5), rows[-1][1]))
    return [(k, [float(x) for x in np.float32(v)], lab) for k, (v, lab) in enumerate(rows)]


def test_matches_brute_force(spark):
    rows = made(120, 1)
    rows += [(9000, rows[3][1], rows[3][2]), (9001, rows[3][1], rows[3][2]), (9002, [2 * x for x in rows[3][1]], rows[3][2]),
             (9003, None, 1), (9004, [0.0] * 32, 1), (9005, [None] + [1.0] * 31, 1), (9006, [float("nan")] + [1.0] * 31, 1),
             (9007, rows[3][1], None), (9008, [], 1), (9009, [1.0, 2.0], 1), (9010, [2.0, 4.0], 1), (None, rows[3][1], rows[3][2])]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in V.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got.keys() == want.keys()
    differ = sum(got[k] != want[k] for k in want)
    assert differ <= 0.02 * len(rows), [(k, got[k], want[k]) for k in want if got[k] != want[k]][:5]
    assert got[None] == (0, None, False)


def test_chunked_buckets_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(V, "CHUNK", 8)
    base = np.random.default_rng(2).normal(size=16)
    rows = [(i, [float(x) for x in np.float32(base + np.random.default_rng(i).normal(size=16) * 0.02)], 1) for i in range(60)]
    got = V.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(59, 0)}
    assert [r.vec_id for r in got if r.kept] == [0]


def test_empty_table(spark):
    assert V.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("d", [1, 3, 64, 100])
def test_bounds_hold(d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(60, d))
    x[30:] = x[:30] + rng.normal(size=(30, d)) * 0.2
    i, j = V.links_within(x, np.arange(60), np.arange(60), 0.93, V.rotations(d, 1))
    exact = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    want = set(zip(*map(list, np.nonzero(exact >= 0.93))))
    assert len(want - set(zip(i, j))) <= 0.001 * len(want)
    assert all(exact[a, b] >= 0.93 - 1e-12 for a, b in zip(i, j))
