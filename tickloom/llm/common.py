"""What the corpus operators share: registration, word hashing over Arrow buffers, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import publish

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Words are runs of anything but these characters, in SQL, Java and RE2 alike.
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that no model learns from; null ids are held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


# --- text as Arrow buffers -------------------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit words, whose bits then all depend on one another."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers from a seed."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def text_slices(batch: pa.RecordBatch, column: str = "text", bytes_each: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, UTF-8 bytes and document offsets of slices of a batch; null texts count as empty.

    A slice holds about ``bytes_each`` bytes, or one longer document.
    """
    texts = batch.column(column).fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + bytes_each, "right")) - 1)
        at = offsets[start:stop + 1]
        yield start, stop, data[at[0]:at[-1]], at - at[0]
        start = stop


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of every document (with the total at the end)."""
    solid = ~_SPACE[data]
    before, after = np.empty(len(data) + 1, bool), np.empty(len(data) + 1, bool)
    before[0], before[1:] = True, ~solid
    after[-1], after[:-1] = True, ~solid
    before[at[:-1]] = True
    starts = np.flatnonzero(solid & before[:-1])
    after[at[1:]] = True
    ends = np.flatnonzero(solid & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word, with A-Z taken as a-z unless ``lower`` is off."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    symbols = constants(256, 1)
    if lower:
        symbols = symbols[_LOWER]
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), 0xD6E8FEB86659FD93, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    solid = data[np.repeat(starts - first, lengths) + np.arange(len(inside))]
    return mix(np.add.reduceat(symbols[solid] * powers[inside], first) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words, repeats included, and each document's first one.

    A document of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(made)))
    where = np.repeat(first[:-1], made) + np.arange(starts[-1]) - np.repeat(starts[:-1], made)
    taken = np.repeat(np.minimum(counts, width), made)
    out = mix(words[where] + taken.astype(np.uint64))
    for k in range(1, width):
        more = taken > k
        out[more] = mix(out[more] * np.uint64(3) + words[where[more] + k])
    return out, starts


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Each document's sorted distinct shingle hashes."""
    starts, ends, first = word_bounds(data, at)
    hashes, bounds = shingle_hashes(word_hashes(data, starts, ends), first, width)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


# --- graphs ----------------------------------------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable from it.

    Contraction: in every round each node moves to its neighbour of lowest random priority, chains are followed
    twice, and links are renamed; about half of the nodes or more vanish per round. Links stay distributed, hubs are
    pre-aggregated, and each round is written to the shared folder, so lineage stays short. Null ends and loops are
    ignored; no links give no rows.
    """
    ends = links.select("a", "b").where("a <> b")
    edges = publish(ends.union(ends.select("b", "a")).distinct(), "edges")
    labels = publish(edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        best = edges.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(turn))).alias("b"))
        lower = F.xxhash64("b", F.lit(turn)) < F.xxhash64("a", F.lit(turn))
        move = publish(best.select(F.col("a").alias("of"), F.when(lower, F.col("b")).otherwise(F.col("a")).alias("to")), "moves")
        for _ in range(2):
            onward = move.select(F.col("of").alias("to"), F.col("to").alias("next"))
            move = move.join(onward, "to").select("of", F.col("next").alias("to"))
        move = publish(move, "moves")
        labels = publish(labels.join(move, labels.label == move.of, "left")
                         .select("node", F.coalesce("to", "label").alias("label")), "labels")
        edges = publish(edges.join(move, edges.a == move.of).select(F.col("to").alias("a"), "b")
                        .join(move, F.col("b") == move.of).select("a", F.col("to").alias("b"))
                        .where("a <> b").distinct(), "edges")
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")
