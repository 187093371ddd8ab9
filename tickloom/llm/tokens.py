"""Token ids on disk: Simple-8b words with per-block offsets.

A table of blocks, written and read by Spark in Parquet files, so that a lost task writes its files again and any store
that Spark knows will do. One row holds whole documents in order: ``docs`` and ``lengths`` name them, ``words`` is
their ids as little-endian 64-bit words, ``offsets`` the first word of every 1,024 ids, ``escapes`` the ids too large
for a word. Rows are ordered by (part, block) and hold the number of ids before them within their part.

A word's top four bits select how many ids of how many bits its other 60 bits hold. Sixty set bits mark an escape: an
id of that size or more, stored beside the words.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import query, table
from tickloom.session import shared_root

#: Ids per word and their bits, by selector (fixed values of the code); selectors 0 and 1 are runs of zeros.
PACKED = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
          (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = (1 << 60) - 1
SPAN = 1024
BLOCK_IDS = 1 << 20
#: Bytes of text that are encoded together.
BATCH_BYTES = 1 << 23
#: Different words in one call of the tokenizer.
WORDS = 1 << 13
#: Words of letters alone that are encoded as one piece.
JOINED = 64
#: Such a word: of ranges that every Unicode version since 5.0 has as letters without a gap.
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u0513\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]+$"

BLOCKS = ("part int, block int, before long, ids long, docs array<long>, lengths array<long>, words binary, "
          "offsets binary, escapes binary")


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For every place of every row, the layout of most ids whose width holds them all; rows end in 240 zeros.

    The maximum over n places is that of two overlapping runs of a power of two, and those double from one another.
    """
    runs = {1: bits}
    for n in (2, 4, 8, 16, 32, 64, 128):
        runs[n] = runs[n // 2].copy()
        np.maximum(runs[n][:, :-n // 2], runs[n // 2][:, n // 2:], out=runs[n][:, :-n // 2])
    select = np.full(bits.shape, len(PACKED) - 1, np.uint8)
    for s in range(len(PACKED) - 2, -1, -1):
        n, wide = PACKED[s]
        half = 1 << (n.bit_length() - 1)
        most = runs[half].copy()
        if n > half:
            np.maximum(most[:, :half - n], runs[half][:, n - half:], out=most[:, :half - n])
        if (fits := most <= wide).any():
            np.putmask(select, fits, s)
    return select


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() >> np.uint64(32):
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)  # rounding up matters to no layout but the last
    short = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)
    low = values.astype(np.uint32)
    high = low >> 16
    bits = short[low & 0xFFFF]
    if high.any():
        bits = np.where(high, short[high] + np.uint8(16), bits)
    return bits


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of every span of 1,024 ids (with their number at the end), and the escaped ids.

    Every span is packed on its own, greedily: each word takes the layout of most ids that fits, where places past the
    end of the span count as zeros. The walk from word to word steps through all spans at once.
    """
    ids = np.asarray(ids, np.uint64)
    spans = -(-len(ids) // SPAN)
    if not spans:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32), np.zeros(0, np.uint64)
    escaped = ids >= np.uint64(ESCAPE)
    row = SPAN + 240
    values = np.zeros((spans, row), np.uint64)
    flat = np.zeros(spans * SPAN, np.uint64)
    flat[:len(ids)] = np.where(escaped, np.uint64(ESCAPE), ids)
    values[:, :SPAN] = flat.reshape(spans, SPAN)
    bits = _bit_lengths(values)
    select, values = _selectors(bits).ravel(), values.ravel()
    step = np.array([n for n, _ in PACKED])[select]
    at = np.arange(spans) * row
    ends = at + np.minimum(SPAN, len(ids) - np.arange(spans) * SPAN)
    heads = []
    while len(at):
        heads.append(at)
        at = at + step[at]
        alive = at < ends
        at, ends = at[alive], ends[alive]
    heads = np.sort(np.concatenate(heads))
    chosen = select[heads]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        n, wide = PACKED[s]
        if wide:
            rows = np.flatnonzero(chosen == s)
            for lane in range(n):
                words[rows] |= values[heads[rows] + lane] << np.uint64(lane * wide)
    offsets = np.searchsorted(heads, np.arange(spans + 1) * row).astype(np.uint32)
    return words, offsets, ids[escaped]


def decode(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` ids of ``encode``. All words of one selector are unpacked together."""
    if not count:
        return np.zeros(0, np.uint64)
    select = (words >> np.uint64(60)).astype(np.int64)
    sizes = np.array([n for n, _ in PACKED])[select]
    # Only the last word of a span can hold fewer ids than its layout has room for.
    held = np.concatenate(([0], np.cumsum(sizes)))
    offsets = offsets.astype(np.int64)
    span = np.minimum(SPAN, count - np.arange(len(offsets) - 1) * SPAN)
    sizes[offsets[1:] - 1] -= held[offsets[1:]] - held[offsets[:-1]] - span
    start = np.cumsum(sizes) - sizes
    out = np.zeros(count, np.uint64)
    for s in np.unique(select):
        n, wide = PACKED[s]
        if wide:
            rows = np.flatnonzero(select == s)
            for lane in range(n):
                got = rows[sizes[rows] > lane]
                out[start[got] + lane] = words[got] >> np.uint64(lane * wide) & np.uint64((1 << wide) - 1)
    out[out == np.uint64(ESCAPE)] = escapes
    return out


def _runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``ids[start:start + size]`` of every run, one after another."""
    before = np.cumsum(sizes) - sizes
    return ids[np.repeat(starts - before, sizes) + np.arange(sizes.sum())]


def _lines(words: pa.Array, each: int) -> pa.Array:
    """The words, each after a blank, joined ``each`` at a time."""
    offsets = np.append(np.arange(0, len(words), each), len(words)).astype(np.int32)
    return pc.binary_join_element_wise("", pc.binary_join(pa.ListArray.from_arrays(offsets, words), " "), " ")


class WordCoder:
    """A byte-level tokenizer that encodes each different word of a batch once.

    Such a tokenizer never joins characters across a blank that stands between two other characters: the blank opens
    the next piece. So texts are cut there, and the different words of a batch are encoded in one call. A text with any
    other blank, or with the name of a special token, is encoded whole. Nothing is kept from batch to batch, so a batch bounds the memory.

    Cutting pieces costs more than merging their bytes. A word of letters is one piece, so many such words go through
    the merges as one, where the vocabulary has no token that reaches from a letter over a blank.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose token starts with a blank
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.pieces, self.bytes = self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.joins = self._joins(vocabulary)
        self.marks = pa.array(list(".,;:!?"))
        self.mark_ids = np.array([self.tokenizer.encode(m).ids[0] for m in self.marks.to_pylist()], np.uint32)

    def _joins(self, vocabulary: dict[str, int]) -> bool:
        """Whether words of letters keep their ids when they are merged as one piece."""
        from tokenizers import decoders, models, pre_tokenizers
        model, pieces, decoder = self.tokenizer.model, self.pieces, decoders.ByteLevel()
        plain = (isinstance(model, models.BPE) and isinstance(pieces, pre_tokenizers.ByteLevel) and pieces.use_regex
                 and not pieces.add_prefix_space and self.tokenizer.normalizer is None and not model.ignore_merges
                 and not (model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix))
        texts = [decoder.decode([token]) for token in vocabulary if "\u0120" in token[1:]]
        return plain and all("  " in t or any(not c.isalpha() and c not in " \ufffd" for c in t) for t in texts)

    def _texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts as they are, one after another, and each text's number of ids."""
        texts, coded = texts.to_pylist(), []
        for at in range(0, len(texts), 256):  # what a call returns takes many times its ids' room
            group = self.tokenizer.encode_batch_fast(texts[at:at + 256], add_special_tokens=False)
            coded += [np.array(c.ids, np.uint32) for c in group]
        return np.concatenate([np.zeros(0, np.uint32), *coded]), np.array([len(c) for c in coded], np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, each after a blank, and each word's number of ids.

        A mark that ends a word after a letter or digit is a piece of its own, so such words share the ids of the rest.
        """
        marked = pc.match_substring_regex(words, r"[\p{L}\p{N}][.,;:!?]$")
        cores = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        lettered = pc.match_substring_regex(cores.dictionary, LETTERS).to_numpy(zero_copy_only=False) & self.joins
        self.tokenizer.encode_special_tokens = True  # no word here is a special token, nor are neighbours together
        self.tokenizer.pre_tokenizer = self.bytes
        joined = self._texts(_lines(cores.dictionary.filter(pa.array(lettered)), JOINED))[0]
        self.tokenizer.pre_tokenizer = self.pieces
        lines = _lines(cores.dictionary.filter(pa.array(~lettered)), WORDS)
        ids = np.concatenate([joined, *[self._texts(lines.slice(at, 1))[0] for at in range(len(lines))]])
        self.tokenizer.encode_special_tokens = False
        starts = np.flatnonzero(self.opens[ids])
        assert len(starts) == len(cores.dictionary)
        place = np.where(lettered, np.cumsum(lettered), lettered.sum() + np.cumsum(~lettered)) - 1
        number = place[cores.indices.to_numpy()]
        starts, sizes = starts[number], np.diff(np.append(starts, len(ids)))[number]
        marked = marked.to_numpy(zero_copy_only=False)
        last = pc.index_in(pc.utf8_slice_codeunits(words.filter(pa.array(marked)), -1), self.marks).to_numpy(zero_copy_only=False)
        ids = np.insert(_runs(ids, starts, sizes), np.cumsum(sizes)[marked], self.mark_ids[last.astype(np.int64)])
        return ids, sizes + marked

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and each text's number of ids."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        split = pc.split_pattern(texts, " ")
        first = split.offsets.to_numpy()[:-1]
        coded = split.flatten().dictionary_encode()
        words, number = coded.dictionary, coded.indices.to_numpy()
        blank = pc.or_(pc.equal(words, ""), pc.not_equal(pc.utf8_trim_whitespace(words), words)).to_numpy(zero_copy_only=False)
        whole = np.logical_or.reduceat(blank[number], first)
        for name in self.special:  # the tokenizer gives them their own ids and cuts the text there
            whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        # The first word of a text has no blank before it, so it is encoded apart, as are texts that must not be cut.
        apart, apart_sizes = self._texts(pc.if_else(pa.array(whole), texts, words.take(pa.array(number[first]))))
        alone = np.repeat(whole, np.diff(np.append(first, len(number))))
        alone[first] = True
        used = np.zeros(len(words), bool)
        used[number[~alone]] = True
        ids, used_sizes = self._words(words.filter(pa.array(used)))
        sizes, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        sizes[used], starts[used] = used_sizes, np.cumsum(used_sizes) - used_sizes
        sizes, starts = np.where(alone, 0, sizes[number]), starts[number]
        sizes[first], starts[first] = apart_sizes, len(ids) + np.cumsum(apart_sizes) - apart_sizes
        return _runs(np.concatenate((ids, apart)), starts, sizes), np.add.reduceat(sizes, first)


@functools.lru_cache(maxsize=1)
def word_coder(path: str) -> WordCoder:
    """The coder of a Python worker, loaded once for all its tasks: what a load leaves behind would add up.

    A task has one core, so the tokenizer starts no threads.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordCoder(path)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Token blocks of every text of ``docs`` in ascending doc_id order, as a folder at ``path``.

    Each document's ids end with ``end_id``. Null texts count as empty; null doc_ids come first; rows of one doc_id
    follow each other in the order of their texts. An empty table makes an empty folder of the same schema. Documents
    are dealt out by ranges of doc_id and sorted in their partition, so ranges stay even whatever the ids are.
    """
    def run(batches):
        words, part, block, before = word_coder(tokenizer), TaskContext.get().partitionId(), 0, 0
        docs_, lengths, pieces, held = [], [], [], 0

        def flush():
            ids = np.concatenate(pieces)
            packed, offsets, escapes = encode(ids)
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "before": before, "ids": len(ids), "docs": docs_, "lengths": lengths,
                "words": packed.astype("<u8").tobytes(), "offsets": offsets.astype("<u4").tobytes(),
                "escapes": escapes.astype("<u8").tobytes()}], schema)

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), pc.fill_null(batch.column("text"), "")
            size = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, "right")))
                flat, counts = words.encode(texts.slice(at, stop - at))
                flat, counts = np.insert(flat, np.cumsum(counts), end_id), counts + 1
                ends = np.cumsum(counts)
                done = 0
                while done < len(counts):
                    begin = int(ends[done] - counts[done])
                    more = 1 + int(np.searchsorted(ends, begin + BLOCK_IDS - held))
                    pieces.append(flat[begin:int(ends[min(more, len(ends)) - 1])])
                    docs_ += names[at + done:at + more][:len(counts) - done]
                    lengths += counts[done:more].tolist()
                    held += len(pieces[-1])
                    done = min(more, len(counts))
                    if held >= BLOCK_IDS:
                        yield flush()
                        block, before = block + 1, before + held
                        docs_, lengths, pieces, held = [], [], [], 0
                at = stop
        if docs_:
            yield flush()

    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("ids", pa.int64()),
                        ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()),
                        ("offsets", pa.binary()), ("escapes", pa.binary())])
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
     .sortWithinPartitions("doc_id", "text").mapInArrow(run, BLOCKS).write.parquet(path))


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a folder with ``start``, the number of ids before each.

    One sum per part is all that meets and all that is broadcast: as many rows as the writing job had tasks, which
    ``spark.sql.shuffle.partitions`` bounds.
    """
    blocks = spark.read.parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("ids").alias("held"))
    ahead = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    return blocks.join(F.broadcast(parts), "part").select("docs", "lengths", "words", "offsets", "escapes",
                                             (F.col("ahead") + F.col("before")).alias("start"))


def _decoded(batch: pa.RecordBatch):
    for row in batch.to_pylist():
        lengths = np.array(row["lengths"], np.int64)
        ids = decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4"),
                     np.frombuffer(row["escapes"], "<u8"), int(lengths.sum()))
        yield row["docs"], row["start"], lengths, ids


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of a folder; ``start`` counts the ids of all documents before it."""
    def run(batches):
        for batch in batches:
            for docs, start, lengths, ids in _decoded(batch):
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(start + ends - lengths),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.astype(np.int64)))],
                    ["doc_id", "start", "ids"])

    return _blocks(spark, path).mapInArrow(run, "doc_id long, start long, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a folder, from its ids as 32-bit numbers."""
    def run(batches):
        for batch in batches:
            for docs, start, lengths, ids in _decoded(batch):
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _blocks(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``digests`` of ``docs`` written to a new folder in the shared one."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    path = f"{shared_root(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, str(tokenizer))
    return digests(spark, path)


@query("op7_token_blocks")
def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(spark, table(spark, sf_dir, "documents"))
