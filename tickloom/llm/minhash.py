"""Near-duplicate documents: MinHash with tensored banding, confirmed on whole shingle sets.

A document gets two small collections of ``tables`` half keys, each of ``width`` minhashes. Every pair of one half key
from either collection is the key of one hash table, so ``tables`` squared tables of ``2 * width`` minhashes cost only
``2 * tables * width`` minhash computations. Two documents of similarity s meet in some table with probability
(1 - (1 - s^width)^tables)^2: 0.9996 at 0.8 and 0.99998 at 0.85 with the defaults, and hardly ever when s is below 0.1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import components, constants, mix, query, shingle_sets, table, text_slices
from tickloom.session import publish


def signatures(docs: DataFrame, words: int, tables: int, width: int) -> DataFrame:
    """doc_id, n (set size), set_x and set_y (a 128-bit hash of the set), and the half keys ``left`` and ``right``."""

    def run(batches):
        factors, masks = constants(2 * tables * width, 11), constants(2 * tables * width, 12)
        for batch in batches:
            for start, stop, data, at in text_slices(batch):
                sets = shingle_sets(data, at, words)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                keys = np.zeros((len(n), 2 * tables), np.uint64)
                x, y = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(full):
                    items = np.concatenate([sets[i] for i in full])
                    first = np.cumsum(n[full]) - n[full]
                    x[full] = np.add.reduceat(mix(items), first)
                    y[full] = np.add.reduceat(mix(items ^ np.uint64(0x5851F42D4C957F2D)), first)
                    for k in range(2 * tables):
                        key = np.full(len(full), k, np.uint64)
                        for i in range(k * width, k * width + width):
                            key = mix(key * np.uint64(3) + np.minimum.reduceat((items ^ masks[i]) * factors[i], first))
                        keys[full, k] = key
                keys = keys.astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, stop - start), pa.array(n, pa.int64()),
                    pa.array(x.astype(np.int64)), pa.array(y.astype(np.int64)),
                    *(pa.ListArray.from_arrays(pa.array(np.arange(0, (len(n) + 1) * tables, tables), pa.int32()),
                                               pa.array(np.ascontiguousarray(side).ravel()))
                      for side in (keys[:, :tables], keys[:, tables:]))],
                    ["doc_id", "n", "set_x", "set_y", "left", "right"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, set_x long, set_y long, left array<long>, right array<long>")


def set_table(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(doc_id, items) of the wanted ids: sorted shingle hashes as bytes. Texts are shuffled this once."""
    def hashed(batches):
        for batch in batches:
            for start, stop, data, at in text_slices(batch):
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, stop - start),
                    pa.array([s.tobytes() for s in shingle_sets(data, at, words)], pa.binary())], ["doc_id", "items"])

    # The hint keeps ids that grow with the input from being broadcast.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    return publish(docs.mapInArrow(hashed, "doc_id long, items binary"), "sets")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]))
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * same >= percent * (len(both) - same)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets have 100 * intersection >= percent * union."""
    def check(batches):
        for batch in batches:
            keep = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(check, "a long, b long").distinct())


def across(named: DataFrame, sets: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """Links between components that meet in a bucket, from ``named`` (family, rep, part): at least one per linked pair.

    The buckets whose smallest member is of one component form a family. Its documents of other components are
    compared with each other and with those of that component, in blocks of about ``block`` by ``block`` sets with a
    common index of their items; documents of the family's own component are not compared with each other. A document
    gives at most one link per block and component, so pairs are never listed.
    """
    own = F.col("part") == F.col("family")
    rows = publish(named.select("family", "rep", "part", own.alias("own")).distinct(), "families")
    sizes = rows.groupBy("family").agg(F.count_if("own").alias("m"), F.count_if(~F.col("own")).alias("n"))
    slots = lambda c: F.greatest(F.ceil(F.col(c) / block), F.lit(1)).cast("int")
    rows = rows.join(sizes.select("family", slots("m").alias("lefts"), slots("n").alias("rights")), "family")
    slot = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    kept = ("family", "rep", "part")
    left = rows.where("own").select(*kept, F.lit(0).alias("kind"), slot("lefts").alias("l"), every("rights").alias("r"), F.lit(True).alias("first"), F.lit(False).alias("second"))
    right = rows.where(~F.col("own")).select(*kept, F.lit(0).alias("kind"), every("lefts").alias("l"), slot("rights").alias("r"), F.lit(False).alias("first"), F.lit(True).alias("second"))
    both = rows.where(~F.col("own")).select(*kept, slot("rights").alias("mine"), every("rights").alias("other")).select(
        *kept, F.lit(1).alias("kind"), F.least("mine", "other").alias("l"), F.greatest("mine", "other").alias("r"),
        (F.col("mine") <= F.col("other")).alias("first"), (F.col("mine") >= F.col("other")).alias("second"))
    rows = left.union(right).union(both).join(sets.withColumnRenamed("doc_id", "rep"), "rep")

    def compare(held: pa.Table) -> pa.Table:
        ids, part = held.column("rep").to_numpy(), held.column("part").to_numpy()
        items = [np.frombuffer(x.as_buffer(), np.uint64) for x in held.column("items")]
        ours, theirs = (np.flatnonzero(held.column(c).to_numpy()) for c in ("first", "second"))
        found = []
        if len(ours) and len(theirs):
            lengths = np.array([len(items[i]) for i in ours])
            order = np.argsort(flat := np.concatenate([items[i] for i in ours]), kind="stable")
            flat, owner = flat[order], np.repeat(np.arange(len(ours)), lengths)[order]
            for j in theirs:
                low, high = np.searchsorted(flat, items[j], "left"), np.searchsorted(flat, items[j], "right")
                take = high - low
                places = np.repeat(low - (np.cumsum(take) - take), take) + np.arange(take.sum())
                same = np.bincount(owner[places], minlength=len(ours))
                hits = ours[100 * same >= percent * (lengths + len(items[j]) - same)]
                hits = hits[part[hits] != part[j]]
                found += [(ids[i], ids[j]) for i in hits[np.unique(part[hits], return_index=True)[1]]]
        found = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return rows.groupBy("family", "kind", "l", "r").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, tables: int = 12, width: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles;
    component_id is the smallest doc_id reachable by links.

    1. Documents with equal sets become one class, named by its smallest doc_id.
    2. In every bucket each class is paired with the bucket's smallest; pairs are confirmed, and components formed.
    3. Where components still meet in a bucket, their documents are compared in blocks, so no link between different
       texts depends on the choice in step 2.

    Buckets and classes are found by pre-aggregated minima and joins, never gathered. Null and empty texts have no
    shingles: size 0, linked with nothing. Rows of one doc_id count as one document. A row with a null doc_id gets the
    component of the texts equal to it, if any has an id, and is not kept. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    sig = publish(signatures(docs, words, tables, width), "signatures")
    rep = sig.where("n > 0").groupBy("n", "set_x", "set_y").agg(F.min("doc_id").alias("rep"))
    rep = publish(rep.where("rep is not null"), "classes")
    halves = sig.join(rep.withColumnRenamed("rep", "doc_id"), ["doc_id", "n", "set_x", "set_y"]).select(
        F.col("doc_id").alias("rep"), "left", "right")
    slots = F.explode(F.expr(f"transform(sequence(0, {tables * tables - 1}), t -> xxhash64(t, left[cast(t / {tables} as int)], right[t % {tables}]))"))
    rows = halves.select("rep", slots.alias("key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    members = publish(rows.join(shared.select("key", "low").hint("shuffle_hash"), "key"), "members")
    sets = set_table(docs, members.select(F.col("rep").alias("doc_id")).distinct(), words)

    stars = members.where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    links = publish(confirmed(stars, sets, percent), "links")
    found = publish(components(links), "components")
    parts = lambda node, part: found.select(F.col("node").alias(node), F.col("component").alias(part))
    named = members.join(parts("rep", "part"), "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    mixed = named.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.min("low").alias("low")).where("p < q")
    mixed = mixed.join(parts("low", "family"), "low", "left").select("key", F.coalesce("family", "low").alias("family"))
    more = across(named.select("key", "rep", "part").join(mixed, "key"), sets, percent)

    # Rows of one doc_id with different texts stand for one document: their classes are linked too.
    equal = publish(sig.join(rep, ["n", "set_x", "set_y"], "left").select("doc_id", "n", "rep"), "rows")
    ids = equal.where("doc_id is not null and rep is not null").select("doc_id", "rep").distinct()
    torn = ids.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("doc_id", "a")
    extra = publish(more.union(ids.join(torn, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))), "links")
    if not extra.isEmpty():
        found = components(links.union(extra))
    component = F.coalesce("component", "rep", "doc_id")
    return equal.join(found, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


_ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n, y.n AS m, count(*) AS same
  FROM items x JOIN items y ON x.item = y.item AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
  GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * same >= 80 * (n + m - same)),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS node, b AS other FROM ends UNION SELECT r.node, e.b FROM reach r JOIN ends e ON r.other = e.a),
least AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(l.low, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(l.low, s.doc_id) AS kept
FROM sets s LEFT JOIN least l ON l.node = s.doc_id
"""


@query("op1_minhash_near_duplicates", _ORACLE)
def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)
