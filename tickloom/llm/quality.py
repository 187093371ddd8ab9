"""Text quality: Naive Bayes support vectors.

N-grams of a text are indicators in a hashed space. Log-count ratios of the two classes, counted over every learning
row, scale the indicators; a linear hinge-loss model over the scaled indicators is fitted by dual coordinate descent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import held_out, mix, query, table, text_slices, word_bounds, word_hashes
from tickloom.session import publish

#: Hashed n-gram space: 2^17 features, so a model never holds more than 2^17 numbers.
BITS = 17
#: Rows the hinge-loss model is fitted on: those of lowest hash. The count ratios take in every learning row.
FIT_ROWS = 4000

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x30:0x3A], _SHAPE[0x80:] = 0x41, 0x61, 0x30, 0x61


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (document << BITS | feature) keys, and the first key of every document.

    Indicators: words and word pairs with A-Z taken as a-z, and 4-grams of the bytes' shapes (capital, small, digit,
    other letters as small, marks as they are), which see shouting, rows of marks and listings in any language.
    """
    starts, ends, first = word_bounds(data, at)
    words = word_hashes(data, starts, ends)
    top = np.uint64(64 - BITS)
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(first))
    keys = [owner << np.uint64(BITS) | words >> top]
    if len(words) > 1:
        pairs = mix(words[:-1] * np.uint64(3) + words[1:])
        inside = owner[1:] == owner[:-1]
        keys.append(owner[1:][inside] << np.uint64(BITS) | (pairs >> top)[inside])
    if len(data) > 3:
        shape = _SHAPE[data].astype(np.uint32)
        grams = shape[:-3] | shape[1:-2] << np.uint32(8) | shape[2:-1] << np.uint32(16) | shape[3:] << np.uint32(24)
        owner = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
        inside = owner[3:] == owner[:-3]
        inside[1:] &= (grams[1:] != grams[:-1]) | ~inside[:-1]
        grams = grams[inside]
        keys.append(owner[3:][inside] << np.uint64(BITS) | mix(grams.astype(np.uint64) + np.uint64(1 << 40)) >> top)
    keys = np.sort(np.concatenate(keys))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    return keys, np.searchsorted(keys, np.arange(len(at), dtype=np.uint64) << np.uint64(BITS))


def class_counts(rows: DataFrame) -> DataFrame:
    """(feature, label, docs): documents of each class that hold the feature; (-1, label) holds the class sizes.

    Tasks add up their own rows first, so each sends at most 2^(BITS + 1) sums.
    """
    def count(batches):
        sums = np.zeros((2, 1 << BITS), np.int64)
        sizes = np.zeros(2, np.int64)
        for batch in batches:
            labels = np.asarray(batch.column("label"))
            for start, stop, data, at in text_slices(batch):
                keys, first = features(data, at)
                label = labels[start:stop]
                sizes += np.bincount(label, minlength=2)
                which = np.repeat(label, np.diff(first)).astype(np.uint64)
                both = which << np.uint64(BITS) | keys & np.uint64((1 << BITS) - 1)
                sums += np.bincount(both.astype(np.int64), minlength=2 << BITS).reshape(2, -1)
        label, feature = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((feature, [-1, -1])), pa.int64()), pa.array(np.concatenate((label, [0, 1])), pa.int32()),
            pa.array(np.concatenate((sums[label, feature], sizes)), pa.int64())], ["feature", "label", "docs"])

    return rows.mapInArrow(count, "feature long, label int, docs long").groupBy("feature", "label").agg(F.sum("docs").alias("docs"))


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = 1.0, sweeps: int = 20,
                 tolerance: float = 1e-3) -> np.ndarray:
    """Weights and bias (last) of the hinge-loss model of unit-length rows ``ratio[row]``.

    One dual variable per row is moved to its box-constrained optimum in turn, in a fixed random order. Classes are
    weighted inversely to their sizes. One class alone gives a constant model.
    """
    weights = np.zeros(len(ratio) + 1)
    signs = np.where(labels == 1, 1.0, -1.0)
    if len(rows) == 0 or abs(signs.sum()) == len(rows):
        weights[-1] = float(np.sign(signs.sum())) if len(rows) else 0.0
        return weights
    values = [ratio[r] / max(1e-12, float(np.sqrt(np.square(ratio[r]).sum()))) for r in rows]
    limit = np.where(signs > 0, cost * len(rows) / (2 * (signs > 0).sum()), cost * len(rows) / (2 * (signs < 0).sum()))
    alpha, order = np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(sweeps):
        worst = 0.0
        for i in order.permutation(len(rows)):
            slope = signs[i] * (values[i] @ weights[rows[i]] + weights[-1]) - 1
            new = min(max(alpha[i] - slope / (float(values[i] @ values[i]) + 1), 0.0), limit[i])
            step = (new - alpha[i]) * signs[i]
            worst = max(worst, abs(step))
            if step:
                weights[rows[i]] += step * values[i]
                weights[-1] += step
                alpha[i] = new
        if worst < tolerance:
            break
    return weights


class Model:
    """Ratios, weights and the slope and offset that turn margins into probabilities; fixed size."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray):
        self.ratio, self.weights = ratio.astype(np.float32), (ratio * weights[:-1]).astype(np.float32)
        self.square, self.bias, self.slope = np.square(self.ratio), float(weights[-1]), 2.0

    def margins(self, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(first) - 1, self.bias)
        feature = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
        total = np.concatenate(([0.0], np.cumsum(self.weights[feature], dtype=np.float64)))
        length = np.concatenate(([0.0], np.cumsum(self.square[feature], dtype=np.float64)))
        norm = np.sqrt(np.maximum(length[first[1:]] - length[first[:-1]], 1e-12))
        return (total[first[1:]] - total[first[:-1]]) / norm + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-self.slope * margins, -50, 50)))


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, smoothing: float = 1.0) -> Model:
    """A model from (text, label, key) rows with label 0 or 1.

    Ratios count all rows in Spark. The hinge-loss fit takes ``fit_rows`` rows, those of the lowest hash of key and
    text (and repeats of them); they are turned into features in Spark and fitted on the driver, whose memory that bound limits.
    """
    rows = rows.select("text", F.col("label").cast("int").alias("label"), "key")
    counts = class_counts(rows).collect()
    sums, sizes = np.zeros((2, 1 << BITS)), np.zeros(2)
    for feature, label, docs in counts:
        if feature < 0:
            sizes[label] += docs
        else:
            sums[label, feature] = docs
    share = (sums + smoothing) / (sizes[:, None] + 2 * smoothing)
    ratio = np.log(share[1] / share[0])
    ratio[sums.sum(axis=0) < 3] = 0

    def encode(batches):
        for batch in batches:
            for start, stop, data, at in text_slices(batch):
                keys, first = features(data, at)
                items = (keys & np.uint64((1 << BITS) - 1)).astype(np.int32)
                useful = ratio[items] != 0
                kept = np.concatenate(([0], np.cumsum(useful)))[first]
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array(kept, pa.int32()), pa.array(items[useful], pa.int32())),
                    batch.column("label").slice(start, stop - start)], ["items", "label"])

    place = F.xxhash64("key", "text")
    last = rows.select(place.alias("place")).orderBy("place").limit(fit_rows).agg(F.max("place")).first()[0]
    sample = rows.where(place <= last) if last is not None else rows
    sample = sample.mapInArrow(encode, "items array<int>, label int").toArrow()
    items = [np.asarray(x.values) for x in sample.column("items")]
    labels = sample.column("label").to_numpy()
    return Model(ratio, dual_descent(items, labels, ratio))


def learning_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(text, label, key) of the labelled documents outside the held-out third; labels other than 0 and 1 are ignored.

    Labels are reduced to one per doc_id (the largest) before the join.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max(label).alias("label"))
    # The hint keeps labels that grow with the input from being broadcast.
    return docs.select("doc_id", "text").join(known.hint("shuffle_hash"), "doc_id").select("text", "label", F.col("doc_id").alias("key"))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", keep: tuple[str, ...] = ("doc_id",),
          names: tuple[str, str] = ("score", "predicted"), fit_rows: int = FIT_ROWS) -> DataFrame:
    """``keep`` columns of every row of ``docs`` with score (0 to 1) and predicted (1 if score >= 0.5, else 0).

    Scores depend on the text alone. Null and empty texts have no indicators and get the model's bias. Without any
    usable label every score is 0.5; with labels of one class all predictions are that class. Repeated rows are
    scored alike; repeated labels of one document count once.
    """
    model = fit(publish(learning_rows(docs, labels, label), "labelled"), fit_rows)
    carrier = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.col("text").alias("t"))

    def run(batches):
        for batch in batches:
            for start, stop, data, at in text_slices(batch, "t"):
                scores = model.scores(model.margins(*features(data, at)))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(start, stop - start) for c in batch.columns[:-1]), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                    [*keep, *names])

    return carrier.mapInArrow(run, docs.select(*keep).schema.add(names[0], "double").add(names[1], "integer"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted to be of good quality, all columns as they are."""
    scored = score(docs, labels, keep=tuple(docs.columns), names=("__score", "__predicted"))
    return scored.where("__predicted = 1").select(*docs.columns)


@query("op6_quality_classifier")
def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
