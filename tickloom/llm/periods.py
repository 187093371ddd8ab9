"""Periodic runs in the word sequences of documents, by internal pattern matching.

Words of a slice of documents become numbers, and the stretches that can hold a run are laid out one after another, each
closed by a number of its own. Ranks of all blocks of 1, 2, 4 ... words come from doubling; the last ranks order the suffixes,
and a block's occurrences are a range of that suffix array. A wavelet matrix over the array answers the next (or last)
occurrence of an aligned block of 2^k words at a distance of 2^k to 2^(k+1) - 1 from it. Those occurrences are one
arithmetic progression: its first and last member and, where the block itself is periodic, the distance between the ends
of both periodic stretches are the only periods a run around the block can have. Each is extended as far as it
holds by comparing ranks. A run of four periods or more holds an aligned block and its next two occurrences, so none is missed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.common import query, table

#: The words and the periods that a run has at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Bytes of text that a task handles at once; a longer document is a slice of its own.
SLICE_BYTES = 2 << 20


class WaveletMatrix:
    """Numbers below ``2**bits`` in an order, for many range queries at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros, self.before = [], []
        for b in reversed(range(self.bits)):
            ones = (values >> b) & 1
            self.before.append(np.concatenate(([0], np.cumsum(1 - ones))).astype(np.int32))
            self.zeros.append(int(self.before[-1][-1]))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def _step(self, level: int, at: np.ndarray, one: np.ndarray) -> np.ndarray:
        low = self.before[level][at]
        return np.where(one, self.zeros[level] + at - low, low)

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the numbers at ``lo`` to ``hi`` (exclusive) are smaller than ``x``."""
        out, lo, hi = np.zeros(len(lo), np.int64), lo.astype(np.int64), hi.astype(np.int64)
        x, over = np.minimum(x, (1 << self.bits) - 1), x >= 1 << self.bits
        full = hi - lo
        for level in range(self.bits):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            low, high = self.before[level][lo], self.before[level][hi]
            out += np.where(one, high - low, 0)
            lo, hi = np.where(one, self.zeros[level] + lo - low, low), np.where(one, self.zeros[level] + hi - high, high)
        return np.where(over, full, out)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the numbers at ``lo`` to ``hi``; k must be below their number."""
        out, lo, hi, k = np.zeros(len(lo), np.int64), lo.astype(np.int64), hi.astype(np.int64), k.astype(np.int64)
        for level in range(self.bits):
            low, high = self.before[level][lo], self.before[level][hi]
            one = k >= high - low
            k = np.where(one, k - (high - low), k)
            lo, hi = np.where(one, self.zeros[level] + lo - low, low), np.where(one, self.zeros[level] + hi - high, high)
            out = (out << 1) | one
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest number of each range that is not below ``x``, -1 if there is none."""
        k = self.below(lo, hi, x)
        some, out = k < hi - lo, np.full(len(lo), -1, np.int64)
        out[some] = self.smallest(lo[some], hi[some], k[some])
        return out

    def predecessor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The largest number of each range that is below ``x``, -1 if there is none."""
        k = self.below(lo, hi, x) - 1
        some, out = k >= 0, np.full(len(lo), -1, np.int64)
        out[some] = self.smallest(lo[some], hi[some], k[some])
        return out


class Blocks:
    """Ranks of all blocks of 2^k numbers of a sequence, and its suffix array."""

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        self.n, self.ranks = n, []
        self.order = np.argsort(numbers, kind="stable")
        keys = numbers.astype(np.int64)
        while True:
            ordered = keys[self.order]
            new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            rank = np.empty(n, np.int32)
            rank[self.order] = first
            self.ranks.append(rank)
            size = 1 << (len(self.ranks) - 1)
            if new.all() or size >= n:
                break
            # A block that runs past the end is unlike all others: the sequence ends in a number of its own.
            second = np.zeros(n, np.int64)
            second[:n - size] = rank[size:] + 1
            keys = rank.astype(np.int64) * (n + 1) + second
            self.order = self._within(keys, new)

    def _within(self, keys: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Order by new keys; only groups of equal old keys are sorted again."""
        alone = new & np.concatenate((new[1:], [True]))
        many = self.order[~alone]
        order = self.order.copy()
        order[~alone] = many[np.argsort(keys[many], kind="stable")]
        return order

    def group(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array range of the block at each place."""
        sizes = np.bincount(self.ranks[level], minlength=self.n)
        lo = self.ranks[level][at]
        return lo.astype(np.int64), lo + sizes[lo]

    def common_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers from a and from b (a < b) on are equal."""
        out = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.ranks))):
            size, rank = 1 << level, self.ranks[level]
            for _ in range(2 if level == len(self.ranks) - 1 else 1):
                fits = b + out + size <= self.n
                same = fits & (rank[np.where(fits, a + out, 0)] == rank[np.where(fits, b + out, 0)])
                out += np.where(same, size, 0)
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many numbers before a and before b (a < b) are equal."""
        out = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.ranks))):
            size, rank = 1 << level, self.ranks[level]
            for _ in range(2 if level == len(self.ranks) - 1 else 1):
                fits = a - out - size >= 0
                same = fits & (rank[np.where(fits, a - out - size, 0)] == rank[np.where(fits, b - out - size, 0)])
                out += np.where(same, size, 0)
        return out


def _stretches(numbers: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that can be in a run, and the stretch of each.

    A word of a run occurs four times in it, so stretches are cut at words that occur less often in their stretch, until
    nothing changes; stretches shorter than a run go.
    """
    place, stretch = np.arange(len(numbers)), document.astype(np.int64)
    while len(place):
        _, inverse, counts = np.unique(stretch * (int(numbers.max()) + 1) + numbers[place], return_inverse=True, return_counts=True)
        keep = counts[inverse] >= LEAST_PERIODS
        cut = np.concatenate(([True], (stretch[1:] != stretch[:-1]) | (place[1:] != place[:-1] + 1)))
        stays = np.flatnonzero(keep)
        if not len(stays):
            return place[:0], stretch[:0]
        cuts = np.cumsum(cut | ~keep | np.concatenate(([True], ~keep[:-1])))[stays]
        _, back, lengths = np.unique(cuts, return_inverse=True, return_counts=True)
        long = lengths[back] >= LEAST_WORDS
        changed = len(stays) < len(place) or not long.all()
        place, stretch = place[stays[long]], back[long]
        if not changed:
            return place, stretch
    return place, stretch


def find_runs(numbers: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run of the sequences, by start and period.

    ``document`` numbers the sequences that ``numbers`` consists of; no run spans two. A run has ``LEAST_PERIODS`` periods and
    ``LEAST_WORDS`` words or more, and neither neighbour continues it.
    """
    nothing = np.zeros(0, np.int64)
    place, stretch = _stretches(numbers, document)
    if not len(place):
        return nothing, nothing, nothing
    first = np.concatenate(([True], stretch[1:] != stretch[:-1]))
    number = np.cumsum(first) - 1
    laid = np.arange(len(place)) + number
    n = len(place) + int(number[-1]) + 1
    sequence, back = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    sequence[laid], back[laid] = numbers[place], place
    ends = np.flatnonzero(sequence < 0)
    sequence[ends] = int(numbers.max()) + 1 + np.arange(len(ends))

    blocks = Blocks(sequence)
    index = WaveletMatrix(blocks.order.astype(np.int64))
    found = []
    for level in range(len(blocks.ranks)):
        size = 1 << level
        x = np.arange(0, n, size)
        lo, hi = blocks.group(level, x)
        often = hi - lo >= LEAST_PERIODS - 1
        x, lo, hi = x[often], lo[often], hi[often]
        if not len(x):
            break
        y = index.successor(lo, hi, x + size)
        near = (y >= 0) & (y < x + 2 * size)
        x, lo, hi, y = x[near], lo[near], hi[near], y[near]
        if not len(x):
            continue
        last = index.predecessor(lo, hi, x + 2 * size)
        found += [(x, y - x), (x, last - x)]
        second = index.successor(lo, hi, y + 1)
        step = second - y
        periodic = (second >= 0) & (second <= last) & (2 * step <= size)
        x, y, step = x[periodic], y[periodic], step[periodic]
        here, there = x + blocks.common_after(x, x + step), y + blocks.common_after(y, y + step)
        found.append((x, there - here))
    if not found:
        return nothing, nothing, nothing
    x, q = (np.concatenate(c) for c in zip(*found))
    x, q = np.unique(np.stack((x, q))[:, q > 0], axis=1)
    start, end = x - blocks.common_before(x, x + q), x + q + blocks.common_after(x, x + q)
    long = (end - start >= LEAST_PERIODS * q) & (end - start >= LEAST_WORDS)
    # Of several periods of one stretch the smallest is its own; the others are multiples of it.
    start, end, q = np.unique(np.stack((start[long], end[long], q[long])), axis=1)
    own = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1]))) if len(start) else np.zeros(0, bool)
    start, end, q = back[start[own]], end[own] - start[own], q[own]
    by = np.lexsort((q, start))
    return start[by], end[by], q[by]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, of which one in ten (by the CRC of its id) repeats a part of itself from some word on."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[bytes]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if ids and held + len(raw) > SLICE_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(raw)
            held += len(raw)
    if ids:
        yield ids, texts


_NAMES = ("doc_id", "n_words", "starts", "lengths", "periods", "collapsed")


def _runs(batches: Iterator[pa.RecordBatch], plant: bool, id_type: pa.DataType, digests: bool) -> Iterator[pa.RecordBatch]:
    for ids, texts in _slices(batches):
        split = [t.split() for t in texts]
        documents = [planted(w, i) for w, i in zip(split, ids)] if plant else split
        sizes = np.array([len(w) for w in documents])
        at = np.concatenate(([0], np.cumsum(sizes)))
        known: dict[bytes, int] = {}
        numbers = np.fromiter((known.setdefault(w, len(known)) for words in documents for w in words), np.int64, int(at[-1]))
        start, length, period = find_runs(numbers, np.repeat(np.arange(len(ids)), sizes))
        change = np.zeros(int(at[-1]) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        dropped = np.cumsum(change[:-1]) > 0
        bounds = np.searchsorted(start, at)
        rows = []
        for k, words in enumerate(documents):
            a, b = bounds[k], bounds[k + 1]
            if a < b:
                words = [words[j] for j in np.flatnonzero(~dropped[at[k]:at[k + 1]])]
            joined = b" ".join(words)
            rows.append((ids[k], int(sizes[k]), (start[a:b] - at[k]).tolist(), length[a:b].tolist(), period[a:b].tolist(),
                         hashlib.sha256(joined).hexdigest() if digests else joined.decode("utf-8", "surrogatepass")))
        longs = pa.list_(pa.int64())
        kinds = (id_type, pa.int64(), longs, longs, longs, pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], list(_NAMES))


def periodic_runs(docs: DataFrame, plant: bool = False, digests: bool = False) -> DataFrame:
    """Per document: doc_id, ``n_words``, ``starts``, ``lengths`` and ``periods`` of its runs, and ``collapsed``, its text without repeats.

    Words are runs of anything but blanks. A run is a stretch whose words ``period`` apart are equal, for the smallest such
    period, of four periods and six words or more, that neither neighbour continues; runs come by start, then period. ``collapsed``
    joins by single blanks the words that lie behind the first period of no run; with ``digests`` it is the SHA-256 of that text.
    ``plant`` first makes one document in ten periodic (:func:`planted`), for tests of whole tables; a null id never is.
    Null and empty texts have no words. Every row is a document of its own, also where doc_ids repeat or are null, and other
    columns are ignored. Documents are handled within their partition, without a shuffle, in slices of ``SLICE_BYTES``; a
    longer document is one slice, at about a hundred bytes of memory for each of its words that recurs.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    return rows.mapInArrow(lambda batches: _runs(batches, plant, id_type, digests),
                           f"doc_id {kind.simpleString()}, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string")


@query("op11_periodic_runs")
def _periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = periodic_runs(table(spark, sf_dir, "documents"), plant=True, digests=True)
    runs = runs.selectExpr("*", "zip_with(zip_with(starts, lengths, (s, l) -> struct(s as start, l as length)), periods, "
                                "(x, p) -> struct(-x.length as back, x.start, p as period, x.length)) as runs")
    best = runs.selectExpr("*", "array_min(runs) as best")
    return best.selectExpr(
        "doc_id", "cast(size(runs) as bigint) as n_runs", "best.start", "best.length", "best.period",
        "1000 * best.length div best.period as exponent_milli",
        "sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), ''), 256) as runs_sha256",
        "collapsed as collapsed_sha256")
