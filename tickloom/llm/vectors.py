"""Near-duplicate embeddings: binary codes of randomly rotated vectors with correction factors.

Signs of rotated vectors serve twice. Sixteen of them at a time are the key of a bucket, and within a bucket the code of
one vector and the rotated other give an unbiased estimate of the inner product with a confidence bound; only pairs
whose upper bound reaches the threshold are recomputed, in double precision from the stored vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import components, query, table
from tickloom.session import publish

#: Buckets per vector and signs per key. A pair at cosine 0.93 agrees in a sign with probability 0.88, so it misses
#: all 48 buckets with probability 0.0015; at 0.95 with 0.00002.
BANDS, SIGNS = 48, 16
#: Width of the confidence interval: an estimate errs by more with probability below 2 exp(-WIDTH^2 / 2).
WIDTH = 5.0
#: Rows of a bucket that are compared at once, and rows a task's group should have.
CHUNK, GROUP_ROWS = 1024, 4096


def rotations(d: int, n: int, seed: int = 5) -> np.ndarray:
    """``n`` random orthogonal matrices side by side, (d, n * d)."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(n)], axis=1)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision."""
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket keys (uint16 per band), rotated unit vectors, and the correction factors of their sign codes."""
    d = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ turn
    keys = np.packbits(turned[:, :BANDS * SIGNS] > 0, axis=1)
    first = turned[:, :d]
    return keys.view(np.uint16) if keys.shape[1] % 2 == 0 else None, first, np.abs(first).sum(axis=1) / np.sqrt(d)


def links_within(vectors: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of ``left``, j of ``right``) whose cosine reaches the threshold.

    The estimate of <x, y> is <sign(x)/sqrt(d), y> / factor(x); its error is sqrt((1 - factor^2) / factor^2 / (d - 1))
    times a standard normal at most. Pairs whose bounds exclude the threshold are not computed exactly.
    """
    d = vectors.shape[1]
    _, turned, factor = encode(vectors, turn)
    code = np.where(turned[left] > 0, 1.0, -1.0) / np.sqrt(d)
    estimate = code @ turned[right].T / factor[left][:, None]
    bound = WIDTH * np.sqrt(np.maximum(1 - factor[left] ** 2, 0) / factor[left] ** 2 / max(1, d - 1))
    i, j = np.nonzero(estimate + bound[:, None] >= threshold)
    exact = np.concatenate([cosines(vectors[left[i[k:k + 65536]]], vectors[right[j[k:k + 65536]]]) for k in range(0, len(i), 65536)] or [np.zeros(0)])
    keep = exact >= threshold
    return left[i[keep]], right[j[keep]]


def _lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each of ``n`` places' lowest place reachable over the links (i, j)."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def near_vectors(rows: DataFrame, threshold: float = 0.93) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows are linked if their labels are equal and not null and their cosine is at least ``threshold``. Null vectors,
    zero ones, those with null or non-finite components, and rows without a vec_id or label link with nothing. Equal
    vectors of a label are one class that is compared once and counted as many. Vectors of different lengths never
    link. Rows of one vec_id but different vectors share a component and the sum of their links. Other columns are ignored.

    Buckets with one class are dropped by a count; larger ones are compared in blocks of about 1,024 by 1,024 rows, so
    a bucket of any size is spread over tasks. A pair counts only in the first band where it meets. Blocks give sums
    per class and links to the lowest class they connect to, never all pairs.
    """
    clean = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.coalesce(finite, F.lit(False)) & F.exists("__v", lambda x: x != 0)
              & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", clean.alias("__v")).withColumn("usable", F.coalesce(usable, F.lit(False)))
    same = ["label", "d", "x", "y"]
    rows = publish(rows.withColumns({"d": F.size("__v"), "x": F.xxhash64("__v"), "y": F.xxhash64(F.lit(1), F.reverse("__v"))}), "vectors")
    classes = rows.where("usable").groupBy(*same).agg(F.min("vec_id").alias("class"), F.count("*").alias("weight"))
    classes = publish(classes, "classes")
    heads = publish(rows.where("usable").join(classes.withColumnRenamed("class", "vec_id"), [*same, "vec_id"]).dropDuplicates([*same, "vec_id"])
                    .select(F.col("vec_id").alias("class"), "x", "label", "d", "weight", F.col("__v").alias("v")), "heads")

    def keyed(batches):
        for batch in batches:
            lengths = np.asarray(batch.column("d"))
            values = np.asarray(batch.column("v").flatten())
            ends = np.cumsum(lengths)
            for d in np.unique(lengths):
                own = np.flatnonzero(lengths == d)
                vectors = values[(ends[own] - d)[:, None] + np.arange(d)]
                keys, _, _ = encode(vectors, rotations(d, -(-BANDS * SIGNS // d)))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).take(pa.array(own)) for c in ("class", "x", "label", "d", "weight")),
                    pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (len(own) + 1) * BANDS, BANDS), pa.int32()), pa.array(keys.astype(np.int32).ravel()))],
                    ["class", "x", "label", "d", "weight", "v", "keys", "bands"])

    kind = heads.schema["label"].dataType.simpleString()
    coded = publish(heads.mapInArrow(keyed, f"class long, x long, label {kind}, d int, weight long, v binary, keys binary, bands array<int>"), "codes")
    slots = coded.select("class", "x", "label", "d", F.posexplode("bands").alias("band", "key"))
    sizes = slots.groupBy("label", "d", "band", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = publish(sizes.withColumns({"chunks": F.ceil(F.col("n") / CHUNK).cast("int"), "bucket": F.monotonically_increasing_id()}), "buckets")
    total = sizes.agg(F.sum(F.col("n") * F.col("chunks"))).first()[0] or 0
    groups = int(total // GROUP_ROWS + 1)
    placed = slots.join(sizes.hint("shuffle_hash"), ["label", "d", "band", "key"]).withColumn("own", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    placed = placed.select("class", "x", "band", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    placed = placed.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    placed = placed.withColumn("group", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(groups))).drop("other")
    placed = placed.join(coded.select("class", "x", "weight", "v", "keys"), ["class", "x"])

    def compare(held: pa.Table) -> pa.Table:
        bucket, low, high, own = (held.column(c).to_numpy() for c in ("bucket", "low", "high", "own"))
        names, weights, bands = (held.column(c).to_numpy() for c in ("class", "weight", "band"))
        order = np.lexsort((high, low, bucket))
        edges = np.flatnonzero(np.concatenate(([True], np.any(np.diff(np.stack([bucket, low, high])[:, order], axis=1) != 0, axis=0))))
        raw, packed = held.column("v").combine_chunks(), held.column("keys").combine_chunks()
        counts, tos, froms, turns = np.zeros(len(order), np.int64), [], [], {}
        for at in np.split(order, edges[1:]):
            vectors = np.stack([np.frombuffer(raw[int(k)].as_buffer(), np.float64) for k in at])
            left = np.flatnonzero(own[at] == low[at[0]])
            right = np.flatnonzero(own[at] == high[at[0]])
            if not len(left) or not len(right):
                continue
            if (d := vectors.shape[1]) not in turns:
                turns[d] = rotations(d, 1)
            i, j = links_within(vectors, left, right, threshold, turns[d])
            once = i < j if low[at[0]] == high[at[0]] else np.ones(len(i), bool)
            i, j = i[once], j[once]
            if not len(i):
                continue
            keys = np.stack([np.frombuffer(packed[int(k)].as_buffer(), np.uint16) for k in at])
            new = np.ones(len(i), bool)
            for band in range(bands[at[0]]):
                new[new] = keys[i[new], band] != keys[j[new], band]
            np.add.at(counts, at[i[new]], weights[at[j[new]]])
            np.add.at(counts, at[j[new]], weights[at[i[new]]])
            least = _lowest(len(at), i, j)
            joined = np.flatnonzero(least != np.arange(len(at)))
            froms.append(names[at[joined]])
            tos.append(names[at[least[joined]]])
        seen = np.flatnonzero(counts)
        a = np.concatenate([names[seen], *froms])
        b = np.concatenate([names[seen], *tos])
        n = np.concatenate([counts[seen], np.zeros(len(a) - len(seen), np.int64)])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    found = publish(placed.groupBy("group").applyInArrow(compare, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "found")
    named = publish(components(found.where("a <> b").select("a", "b")), "components")
    degree = found.where("a = b").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    known = classes.join(degree, "class", "left").join(named, classes["class"] == named.node, "left").select(
        *same, (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "class").alias("part"))
    out = rows.join(known, [F.col("usable"), *(rows[c].eqNullSafe(known[c]) for c in same)], "left")
    part = F.coalesce("part", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), part.alias("component_id"),
                      F.coalesce(F.col("vec_id") == part, F.lit(False)).alias("kept"))


_ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e)) >= 0.93),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
low AS (SELECT node, min(other) AS low FROM reach GROUP BY node), deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id, e.vec_id <= coalesce(low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN deg ON deg.a = e.vec_id LEFT JOIN low ON low.node = e.vec_id
"""


@query("op9_embedding_near_duplicates", _ORACLE)
def _near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
