"""Language identification by interpolated Kneser-Ney character models, one per language.

Counts of four-character runs come from every learning document and stay in tables, as do the counts of shorter runs
and of contexts; nothing of the model is cut or sent whole to a task. Texts are packed into slices, the distinct runs
of a bin of slices are joined with their log-probabilities and looked up as a sorted array of 64-bit hashes. A text gets the
language of lowest cross-entropy per character, with a calibrated probability and a rejection mark for texts that are
worse than what the language's own texts look like.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import held_out, mix, query, table, text_slices
from tickloom.session import publish, publish_buckets

ORDER = 4
#: Discounts and limits per language are literals of the tasks; more languages raise an error.
MOST_LANGUAGES = 200
#: Learning documents tried for calibration: at most so many, those of lowest hash among one in 64.
CALIBRATION_ROWS = 2000
#: Bytes of text in a slice, with up to four languages; fewer with more, as every run brings a number per language.
SLICE_BYTES = 2 << 20
#: Bytes of text and different runs in a bin of slices, likewise: its runs are sent once for all its slices.
BIN_BYTES, BIN_RUNS = 32 << 20, 1 << 18


def _letters() -> np.ndarray:
    """Small letters as they are, capitals as small, anything else as a blank, for the first 65,536 characters."""
    out = np.full(1 << 16, 32, np.uint16)
    for code in range(1 << 16):
        character = chr(code)
        if character.isalpha():
            small = character.lower()
            out[code] = ord(small) if len(small) == 1 and ord(small) < 1 << 16 else code
    return out


def runs(data: np.ndarray, at: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every character's run (16 bits each of the three before it and itself), each text's first, and if it has letters.

    Three start marks stand before every text. Characters beyond the first 65,536 are folded to their low bits.
    """
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    first = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[at]
    small = letters[codes & 0xFFFF]
    high = codes >> 16 != 0
    if high.any():
        small[high] = (codes[high] & 0xFFFF).astype(np.uint16) | np.uint16(0xE000)
    seen = np.concatenate(([0], np.cumsum(small != 32)))
    padded = np.zeros(len(small) + 3 * (len(at) - 1) + 3, np.uint64)
    places = np.arange(len(small)) + 3 * np.repeat(np.arange(1, len(at)), np.diff(first))
    padded[places] = small
    key = (padded[places - 3] << np.uint64(48) | padded[places - 2] << np.uint64(32)
           | padded[places - 1] << np.uint64(16) | padded[places])
    return key, first, seen[first[1:]] > seen[first[:-1]]


def run_counts(rows: DataFrame) -> DataFrame:
    """(lang, run, n) over all rows (text, lang); tasks merge their own counts first."""
    letters = _letters()

    def count(batches):
        held: dict[str, list] = {}

        def merged(pairs):
            keys, n = np.concatenate([k for k, _ in pairs]), np.concatenate([c for _, c in pairs])
            order = np.argsort(keys)
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[first], np.add.reduceat(n, first)

        def batch_of(lang, pairs):
            keys, n = merged(pairs)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "run", "n"])

        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for start, stop, data, at in text_slices(batch):
                keys, first, _ = runs(data, at, letters)
                owner = np.repeat(langs[start:stop], np.diff(first))
                for lang in set(langs[start:stop]):
                    own = np.sort(keys[owner == lang])
                    if not len(own):
                        continue
                    edge = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                    pairs = held.setdefault(lang, [])
                    pairs.append((own[edge], np.diff(np.append(edge, len(own)))))
                    if sum(len(k) for k, _ in pairs) > 1 << 20:
                        held[lang] = pairs = [merged(pairs)]
                        if len(pairs[0][0]) > 1 << 19:
                            yield batch_of(lang, held.pop(lang))
        for lang, pairs in held.items():
            yield batch_of(lang, pairs)

    return rows.mapInArrow(count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))


class HashArray:
    """Sorted hashes with values; a lookup starts at the first of its leading bits and walks the few that share them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = np.append(hashes[order], np.uint64(2**64 - 1)), values[order]
        bits = max(1, int(len(keys)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(hashes[order], np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.depth = int(np.diff(np.append(self.first, len(keys))).max(initial=0))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, and whether the key is there; places of absent keys mean nothing."""
        hashes = mix(keys)
        at = self.first[hashes >> self.shift]
        for _ in range(self.depth):
            at = at + (self.hashes[at] < hashes)
        there = (self.hashes[at] == hashes) & (at < len(self.values))
        return np.where(there, at, 0), there

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        if not len(self.values):
            return np.full(len(keys), default)
        at, there = self.find(keys)
        return np.where(there, self.values[at], default)


def discount_of(ones: float, twos: float) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


class KneserNey:
    """One language in memory: what each run gains over the next shorter one, and what each context leaves to it."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.gains, self.rests = [], []
        for order in range(ORDER, 0, -1):
            discount = discount_of(np.count_nonzero(counts == 1), np.count_nonzero(counts == 2))
            contexts, inverse = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, types = np.bincount(inverse, counts), np.bincount(inverse)
            self.gains.append(HashArray(keys, (counts - np.minimum(discount, counts)) / total[inverse]))
            self.rests.append(HashArray(contexts, discount * types / total))
            # The next order counts in how many contexts a shorter run occurs.
            keys, counts = np.unique(keys & np.uint64((1 << 16 * (order - 1)) - 1), return_counts=True)
            counts = counts.astype(float)

    def log2(self, keys: np.ndarray) -> np.ndarray:
        chance = np.full(len(keys), 1 / (1 << 16))
        for k, (gain, rest) in reversed(list(enumerate(zip(self.gains, self.rests)))):
            run = keys & np.uint64((1 << 16 * (ORDER - k)) - 1)
            chance = gain.get(run, 0.0) + rest.get(run >> np.uint64(16), 1.0) * chance
        return np.log2(chance)


def _low(run: str, order: int) -> Column:
    return F.col(run) if order == ORDER else F.col(run).bitwiseAND(F.lit((1 << 16 * order) - 1))


def _dense(column: pa.Array, field: str, languages: int) -> np.ndarray:
    """A row of numbers by language for each list of (lang, ...); 0 where a language is not in it."""
    lengths, flat = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), column.flatten()
    out = np.zeros((len(column), languages))
    out[np.repeat(np.arange(len(column)), lengths), pc.struct_field(flat, "lang").to_numpy(zero_copy_only=False)] = pc.struct_field(
        flat, field).to_numpy(zero_copy_only=False)
    return out


def _packed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


class Counts:
    """The counts behind the models of all languages: one table of (lang, run, n) for each order, and its discounts.

    An order's count of a run below the longest is the number of longer runs that end in it.
    """

    def __init__(self, counts: DataFrame, languages: int):
        self.languages, self.grams = languages, {ORDER: counts}
        for order in range(ORDER - 1, 0, -1):
            shorter = self.grams[order + 1].groupBy("lang", _low("run", order).alias("run")).agg(F.count("*").alias("n"))
            self.grams[order] = publish(shorter, "runs")
        seen = None
        for order, grams in self.grams.items():
            rare = grams.where("n <= 2").groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
            rare = rare.withColumn("order", F.lit(order))
            seen = rare if seen is None else seen.union(rare)
        self.discounts = {order: np.full(languages, 0.5) for order in self.grams}
        for r in seen.collect():  # a row per language and order
            self.discounts[r.order][r.lang] = discount_of(r.ones, r.twos)

    def bits(self, wanted: DataFrame) -> DataFrame:
        """(run, bits) for the distinct runs ``wanted``: the log2-probabilities under all languages as 4-byte floats."""
        chances, languages = None, self.languages
        for order in range(1, ORDER + 1):
            grams, discount = self.grams[order], self.discounts[order]
            own = grams.groupBy("run").agg(F.collect_list(F.struct("lang", "n")).alias("own"))
            around = grams.groupBy("lang", F.shiftrightunsigned("run", 16).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
            around = around.groupBy("context").agg(F.collect_list(F.struct("lang", "total", "types")).alias("around"))
            rows = wanted.select(_low("run", order).alias("run")).distinct()
            rows = rows.join(own, "run", "left").withColumn("context", F.shiftrightunsigned("run", 16)).join(around, "context", "left")
            if chances is not None:
                rows = rows.withColumn("shorter", _low("run", order - 1)).join(chances.withColumnRenamed("run", "shorter"), "shorter")
            else:
                rows = rows.withColumn("bits", F.lit(None).cast("binary"))

            def chance(batches, order=order, discount=discount):
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    shorter = 1 / (1 << 16)
                    if order > 1:
                        shorter = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.float64).reshape(-1, languages)
                    n, total, types = (_dense(batch.column(c), field, languages) for c, field in (("own", "n"), ("around", "total"), ("around", "types")))
                    out = np.where(total > 0, (n - np.minimum(discount, n) + discount * types * shorter) / np.maximum(total, 1), shorter)
                    out = np.log2(out).astype(np.float32) if order == ORDER else out
                    yield pa.RecordBatch.from_arrays([batch.column("run"), _packed(out)], ["run", "bits"])

            chances = rows.select("run", "own", "around", "bits").mapInArrow(chance, "run long, bits binary")
        return chances


def entropies(rows: DataFrame, carried: str, counts: Counts, finish: Callable, schema: str) -> DataFrame:
    """``finish`` of every slice of ``rows``: the column ``carried``, bits per character of each text under each language, letters.

    Texts are written once, compressed, in buckets of their bin, and only the log-probabilities of a bin's runs travel to
    them. A bin is some slices of one task; its runs stand in its last row.
    """
    kind, languages = rows.schema[carried].dataType.simpleString(), counts.languages
    letters, few = _letters(), max(4, languages)
    bytes_each, bin_bytes, bin_runs = (max(1 << 16, n * 4 // few) for n in (SLICE_BYTES, BIN_BYTES, BIN_RUNS))

    def cut(batches):
        def row(names, sizes, text):
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([names], pa.list_(arrow)), pa.array([sizes], pa.list_(pa.int64())), pa.array([text], pa.binary()),
                 pa.array([own if full else []], pa.list_(pa.int64()))], ["bin", "carried", "sizes", "text", "runs"])

        name, own, held, arrow = uuid.uuid4().bytes, np.zeros(0, np.int64), 0, None
        for batch in batches:
            arrow = batch.column(carried).type
            for start, stop, data, at in text_slices(batch, bytes_each=bytes_each):
                own = np.union1d(own, runs(data, at, letters)[0].astype(np.int64))
                held += len(data)
                full = held >= bin_bytes or len(own) >= bin_runs
                text = pa.compress(data.tobytes(), codec="zstd", asbytes=True) if len(data) else b""
                yield row(batch.column(carried).slice(start, stop - start).to_pylist(), np.diff(at).tolist(), text)
                if full:
                    name, own, held = uuid.uuid4().bytes, np.zeros(0, np.int64), 0
        if len(own):
            full = True
            yield row([], [], b"")

    slices = publish_buckets(rows.select(carried, "text").mapInArrow(cut, f"bin binary, carried array<{kind}>, sizes array<long>, text binary, runs array<long>"), "slices", "bin")
    each = slices.select("bin", F.explode("runs").alias("run"))
    known = counts.bits(publish(each.select("run").distinct(), "wanted"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        known, done = None, []
        if right.num_rows:
            bits = np.frombuffer(b"".join(right.column("bits").to_pylist()), np.float32).reshape(-1, languages)
            known = HashArray(right.column("run").to_numpy().astype(np.uint64), bits)
        for k in range(left.num_rows):
            row = left.slice(k, 1).combine_chunks()
            at = np.concatenate(([0], np.cumsum(row.column("sizes").chunk(0).flatten().to_numpy()))).astype(np.int64)
            if len(at) == 1:
                continue
            text = row.column("text")[0].as_py()
            data = np.frombuffer(pa.decompress(text, decompressed_size=int(at[-1]), codec="zstd", asbytes=True) if text else b"", np.uint8)
            keys, first, lettered = runs(data, at, letters)
            out, full = np.zeros((len(at) - 1, languages)), np.flatnonzero(np.diff(first))
            if len(full):
                places, there = known.find(keys) if known else (None, np.zeros(1, bool))
                if not there.all():
                    raise ValueError("runs of a bin without log-probabilities")
                out[full] = -np.add.reduceat(known.values[places], first[full], axis=0, dtype=np.float64) / np.diff(first)[full][:, None]
            done.append(finish(row.column("carried").chunk(0).flatten(), out, lettered))
        return pa.concat_tables(done)

    return slices.select("bin", "carried", "sizes", "text").groupBy("bin").cogroup(
        each.join(known, "run").select(F.col("bin").alias("of"), "run", "bits").groupBy("of")).applyInArrow(score, schema)


class Identifier:
    """The counts of all languages, with how entropies become a probability and a rejection."""

    def __init__(self, counts: Counts | None, languages: list[str]):
        self.counts, self.languages = counts, languages
        self.sharpness, self.limit = 8.0, np.full(len(languages), 16.0)  # 16 bits: no better than any character at random

    def posterior(self, entropies: np.ndarray) -> np.ndarray:
        weight = np.exp2(-self.sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
        return weight / weight.sum(axis=1, keepdims=True)

    def calibrate(self, entropies: np.ndarray, language: np.ndarray) -> None:
        """Sharpness of highest likelihood, and each language's limit: mean and four deviations of its own texts."""
        if not len(language):
            return
        def loss(sharpness):
            self.sharpness = sharpness
            return -np.log(np.maximum(self.posterior(entropies)[np.arange(len(language)), language], 1e-6)).sum()
        self.sharpness = min((2.0 ** k for k in range(-2, 7)), key=loss)
        for k in range(len(self.languages)):
            own = entropies[language == k, k]
            if len(own) >= 8:
                self.limit[k] = own.mean() + 4 * own.std()


def learn(rows: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Identifier:
    """An identifier from (text, lang, key) rows; null and empty texts and null languages teach nothing.

    Counts cover every row. For calibration the rows that are tried are taken off the counts again.
    """
    rows = rows.where("lang is not null and text is not null")
    place = F.xxhash64("key", "text")
    part = F.pmod(F.xxhash64(F.lit("calibration"), "key"), F.lit(64)) == 0
    last = rows.where(part).select(place.alias("place")).orderBy("place").limit(calibration_rows).agg(F.max("place")).first()[0]
    tried = part & (place <= last) if last is not None else F.lit(False)
    marked = rows.select("text", F.concat(F.when(tried, "1").otherwise("0"), "lang").alias("lang"))
    counts = run_counts(marked).groupBy(F.expr("substring(lang, 2)").alias("lang"), "run").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("lang").startswith("0"), F.col("n")).otherwise(0)).alias("others"))
    counts = publish(counts, "runs")
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not languages:
        return Identifier(None, [])
    place_of = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int") - 1
    counts = counts.withColumn("lang", place_of)
    model = Identifier(Counts(counts.select("lang", "run", "n"), len(languages)), languages)
    if last is not None:
        others = Counts(counts.where("others > 0").select("lang", "run", F.col("others").alias("n")), len(languages))
        out = _entropies(rows.where(tried).select("text", "lang"), others).toArrow()
        model.calibrate(np.array(out.column("bits").to_pylist()).reshape(-1, len(languages)),
                        np.array([languages.index(x) for x in out.column("lang").to_pylist()], int))
    return model


def _entropies(rows: DataFrame, counts: Counts) -> DataFrame:
    """(lang, bits) of every row of ``rows`` (text, lang) with letters."""
    def finish(lang, bits, lettered):
        return pa.table([lang.filter(pa.array(lettered)), pa.array(bits[lettered].tolist(), pa.list_(pa.float64()))], ["lang", "bits"])
    return entropies(rows, "lang", counts, finish, "lang string, bits array<double>")


def identify(docs: DataFrame, model: Identifier) -> DataFrame:
    """(doc_id, lang_pred, score, bits, rejected) for every row of ``docs``, from its text alone.

    Null texts, and texts without a letter, are ``und`` with score 0, and so is everything if no language was learned.
    ``bits`` is the cross-entropy per character of the chosen language; above its limit the text is marked rejected,
    and its score falls accordingly. Equal entropies give the first language by name. Repeated rows agree.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model.counts is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits"), F.lit(False).alias("rejected"))
    languages, limit, posterior = model.languages, model.limit, Identifier(None, model.languages)
    posterior.sharpness = model.sharpness

    def finish(doc_id, entropies, lettered):
        best = entropies.argmin(axis=1)
        bits = np.where(lettered, entropies[np.arange(len(best)), best], 0)
        excess = np.maximum(bits - limit[best], 0)
        scores = np.where(lettered, posterior.posterior(entropies)[np.arange(len(best)), best] * np.exp2(-excess), 0)
        names = [languages[b] if has else "und" for b, has in zip(best, lettered)]
        return pa.table([doc_id, pa.array(names, pa.string()), pa.array(scores), pa.array(bits), pa.array(lettered & (excess > 0))],
                        ["doc_id", "lang_pred", "score", "bits", "rejected"])

    return entropies(rows, "doc_id", model.counts, finish, "doc_id long, lang_pred string, score double, bits double, rejected boolean")


@query("op2_language_id")
def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()).select("text", "lang", F.col("doc_id").alias("key")))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits", "rejected")
