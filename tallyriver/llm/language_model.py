"""Scores of texts by a language model whose counts lie in a log-frequency Bloom filter.

1. Documents to learn from give counts of their words and word pairs, combined per group of texts and dealt out to
   shards by ranges of a 64-bit hash. There are as many shards as the text needs.
2. A shard's counts go to powers of two: an n-gram met c times is put into the shard's Bloom filter once for each level
   up to the bits of c. Beside the filter lies the exact count of every word. A shard is one row of a stored table.
3. A count is read back by probing level after level until one is missing. A pair's probability is smoothed with the
   word's own one by a pseudo-count, a word's one by adding a tenth.

The filters are broadcast if their measured size is within a limit. Beyond it groups of texts send their distinct
n-grams to the shards and get the levels back, with the same result. The base score needs exact counts: those of words
that make up more than 1/20,000 of all tokens are broadcast, all others are asked for at the shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.llm.text import byte_texts, mixed, renamed, word_hashes, words
from tallyriver.storage import SHUFFLE_CLEANUP, session_settings, shared_folder

SMOOTHING = 0.1
#: what a word's own probability weighs beside the pairs after its context, in occurrences
PSEUDO_COUNT = 500.0
#: bits of the filter for each level of each n-gram, and hash functions
BITS, PROBES = 12, 8
SHARD_CHARS = 8 << 20
GROUP_BYTES = 4 << 20
GROUP_ROWS = 1 << 16
BROADCAST_BYTES = 160 << 20
#: words with a larger share of all tokens are broadcast, so these are fewer than this number
FREQUENT = 20_000
#: words of the shards that are asked together
BUCKET_WORDS = 500_000
#: n-grams that are looked up at a time, so that the arrays of a look-up stay small
LOOKUP = 1 << 17
#: n-grams of all questions to a shard that are looked up together, each distinct one once
ASKED = 1 << 20
#: bytes that tell a pair from the others of its shard
PAIR_BYTES = 5

# words hold no blank, so these are no words
END, BEGIN = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" end", b" begin"))
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_LEVEL, _LOW, _HALF = 0xD6E8FEB86659FD93, np.uint64(0xFFFFFFFF), np.uint64(32)

SHARD = "shard int, tokens bigint, words bigint, hashes binary, counts binary, bits binary"


class Totals(NamedTuple):
    """Tokens and distinct tokens that were learnt from."""

    tokens: int
    words: int


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _PAIR + mixed(second))


def levels_of(counts: np.ndarray) -> np.ndarray:
    """How many bits a count has."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def count_at(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for none."""
    low = np.exp2(levels - 1.0)
    return np.where(levels > 0, (3 * low - 1) / 2, 0.0)


def within_shard(pairs: np.ndarray) -> np.ndarray:
    """What a shard knows a pair by: the lowest bits of its hash."""
    return pairs & np.uint64((1 << 8 * PAIR_BYTES) - 1)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash's upper 31 bits."""
    return (((hashes >> np.uint64(33)) * np.uint64(shards)) >> np.uint64(31)).astype(np.int64)


def _probes(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram's level, the first probe as a share of 2**32, and the step to the next ones."""
    both = mixed(hashes + np.uint64(level * _LEVEL & 0xFFFFFFFFFFFFFFFF))
    return both & _LOW, both >> _HALF


def _bit(probe: np.ndarray, size: np.ndarray) -> np.ndarray:
    return ((probe * size) >> _HALF).astype(np.int64)


def filter_bits(hashes: np.ndarray, counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The Bloom filter of n-grams and their counts, as packed bits."""
    levels = levels_of(counts)
    flags = np.zeros(max(8, -(-int(levels.sum()) * bits // 8) * 8), bool)
    size = np.uint64(len(flags))
    for level in range(1, int(levels.max(initial=0)) + 1):
        probe, step = _probes(hashes[levels >= level], level)
        for _ in range(PROBES):
            flags[_bit(probe, size)] = True
            probe = (probe + step) & _LOW
    return np.packbits(flags)


class Filters:
    """The filters of several shards in one array."""

    def __init__(self, lengths: list[int], data: bytes):
        """``data`` holds packed bits, of each shard as many bytes as ``lengths`` says."""
        self.bits = np.frombuffer(data, np.uint8)
        self.sizes = np.array(lengths, np.uint64) * np.uint64(8)
        self.offsets = 8 * (np.cumsum(lengths) - lengths)

    def levels(self, hashes: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """The highest level up to which all probes of each n-gram are set in the filter of its shard."""
        parts = [slice(i, i + LOOKUP) for i in range(0, len(hashes), LOOKUP)]
        return np.concatenate([np.empty(0, np.uint8), *[self._levels(hashes[p], shard[p]) for p in parts]])

    def _levels(self, hashes: np.ndarray, shard: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), np.uint8)
        open_ = np.flatnonzero(self.sizes[shard] > 0)
        level = 0
        while len(open_):
            level += 1
            there, size, offset = open_, self.sizes[shard[open_]], self.offsets[shard[open_]]
            probe, step = _probes(hashes[there], level)
            for _ in range(PROBES):
                at = _bit(probe, size) + offset
                kept = np.flatnonzero((self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
                if len(kept) < len(there):
                    there, size, offset, probe, step = (x[kept] for x in (there, size, offset, probe, step))
                probe = (probe + step) & _LOW
            found[there] = level
            open_ = there
        return found


def exact_in(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Counts from sorted hashes and their counts; 0 for others."""
    known, counts = table
    at = np.searchsorted(known, hashes)
    found = np.zeros(len(hashes), np.int64)
    inside = np.flatnonzero(at < len(known))
    inside = inside[known[at[inside]] == hashes[inside]]
    found[inside] = counts[at[inside]]
    return found


def _packed(values: np.ndarray) -> bytes:
    """Sorted hashes as differences, one byte of all after the other, which compresses well."""
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


class _Group(NamedTuple):
    """Tokens of several texts in a row, and their distinct words and pairs in the order of their hashes."""

    #: number of tokens, begin included, of each text
    sizes: np.ndarray
    #: for every token of a text but its begin: its own place in ``words``, that of the one before, that of both in ``pairs``
    word: np.ndarray
    before: np.ndarray
    pair: np.ndarray
    words: np.ndarray
    pairs: np.ndarray


def _firsts(values: np.ndarray) -> np.ndarray:
    """Which of sorted values differ from the one before."""
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return first


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the place of each value among them, fewer than 2**31."""
    order = np.argsort(values)
    found = values[order]
    first = _firsts(found)
    place = np.empty(len(values), np.int32)
    place[order] = np.cumsum(first, dtype=np.int32) - 1
    return found[first], place


def _grouped(texts: Iterator[bytes | None]) -> _Group:
    tokens = [np.concatenate(([BEGIN], word_hashes(words(t or b"")), [END])) for t in texts]
    sizes = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate(tokens)
    del tokens
    real = np.ones(len(flat), bool)
    real[np.cumsum(sizes) - sizes] = False
    # a begin is never before another token than the first of its text, an end never
    before = np.append(real[1:], False)
    both = pair_hashes(flat[before], flat[real])
    single, place = _distinct(flat)
    del flat
    pairs, pair = _distinct(both)
    return _Group(sizes, place[real], place[before], pair, single, pairs)


def _per_text(group: _Group, values: np.ndarray) -> np.ndarray:
    """Sums over the tokens of each text."""
    ends = np.cumsum(group.sizes - 1)
    return np.add.reduceat(values, ends - group.sizes + 1)


def model_scores(group: _Group, near: np.ndarray, pair_near: np.ndarray, totals: Totals, pseudo_count: float) -> np.ndarray:
    """log10 of each text's probability by the counts of the group's words and pairs."""
    single = (np.minimum(near, totals.tokens) + SMOOTHING) / (totals.tokens + SMOOTHING * (totals.words + 1))
    context = near[group.before]
    both = np.minimum(pair_near[group.pair], context) + pseudo_count * single[group.word]
    return _per_text(group, np.log10(both / (context + pseudo_count)))


def base_scores(exact: np.ndarray, totals: Totals) -> np.ndarray:
    """log10 of the smoothed shares of words met so often."""
    return np.log10(exact + SMOOTHING) - np.log10(totals.tokens + SMOOTHING * (totals.words + 1))


def _cuts(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted hashes of each shard begin."""
    return np.searchsorted(shard_of(hashes, shards), np.arange(shards + 1))


#: a batch of texts is about a group, as larger ones would only wait in memory
_GROUP_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": f"{GROUP_BYTES}b"}


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have about ``GROUP_BYTES``; a longer text is alone."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
            if i > start and (size + (n or 0) > GROUP_BYTES or i - start >= GROUP_ROWS):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def _narrow(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bytes of each value."""
    return values.astype(np.uint64, copy=False).view(np.uint8).reshape(-1, 8)[:, :width].reshape(-1)


def _widened(data: np.ndarray, width: int) -> np.ndarray:
    values = np.zeros((len(data) // width, 8), np.uint8)
    values[:, :width] = data.reshape(-1, width)
    return values.view(np.uint64).reshape(-1)


def _cells(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary column of the bytes of ``data`` between the values at ``cuts``, which all have the same width."""
    width = data.nbytes // max(1, int(cuts[-1]))
    buffers = [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, buffers)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the cells of a binary column begin and end, and the bytes of all of them."""
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return ends, np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)


def _runs(numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of one number begins and ends."""
    cuts = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]) if len(numbers) else iter(())


def _pieces(words: np.ndarray, pairs: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shards of sorted words and pairs, and where the words and the pairs of each begin and end."""
    cuts = [_cuts(h, shards) for h in (words, pairs)]
    there = np.flatnonzero(np.diff(cuts[0]) + np.diff(cuts[1]))
    return there, *(np.append(c[there], c[-1]) for c in cuts)


def _in_bytes(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of one byte each; one that was met more than 255 times comes several times."""
    times = -(-counts // 255)
    parts = np.full(int(times.sum()), 255, np.uint8)
    parts[np.cumsum(times) - 1] = counts - 255 * (times - 1)
    return np.repeat(hashes, times), parts


def _count_pass(shards: int):
    """For groups of texts and shards: distinct words and pairs with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            group = _grouped(byte_texts(batch.column("text")))
            counts = np.bincount(group.word, minlength=len(group.words))
            # begins are counted as the contexts that they are
            counts[np.searchsorted(group.words, BEGIN)] = len(group.sizes)
            words, counts = _in_bytes(group.words, counts)
            pairs, times = _in_bytes(group.pairs, np.bincount(group.pair, minlength=len(group.pairs)))
            del group
            there, *cuts = _pieces(words, pairs, shards)
            pairs = _narrow(pairs, PAIR_BYTES)
            cells = [_cells(d, c) for d, c in ((words, cuts[0]), (counts, cuts[0]), (pairs, cuts[1]), (times, cuts[1]))]
            yield pa.record_batch([pa.array(there, pa.int32()), *cells], names=_names("shard int, " + _COUNTED))

    return run


_COUNTED = "words binary, counts binary, pairs binary, times binary"
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def _names(fields: str) -> list[str]:
    return [f.split()[0] for f in fields.split(", ")]


def _columns(rows: list[tuple], fields: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in fields.split(", ")))
    columns = zip(*rows) if rows else ((),) * len(names)
    return pa.record_batch([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], names=list(names))


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and the sums of their counts."""
    flat = np.concatenate(hashes)
    order = np.argsort(flat)
    flat = flat[order]
    first = _firsts(flat)
    return flat[first], np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(first), dtype=np.int64)


def _build_pass(bits: int):
    """Rows sorted by shard to one row for each shard; the parts of a shard are summed as they come."""

    def summed(parts: list[list]) -> list:
        words, counts, pairs, times = zip(*parts)
        return [*_summed(words, counts), *_summed(pairs, times)]

    def made(shard: int, parts: list[list]) -> pa.RecordBatch:
        hashes, counts, pairs, times = summed(parts)
        real = hashes != BEGIN
        packed = filter_bits(np.concatenate([hashes, pairs]), np.concatenate([counts, times]), bits)
        blobs = [x.tobytes() for x in (hashes[real], counts[real], packed)]
        return _columns([(shard, int(counts[real].sum()), int(real.sum()), *blobs)], SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, size = None, [], 0
        for batch in batches:
            numbers, columns = batch.column("shard").to_numpy(), [_bytes(batch.column(n)) for n in _names(_COUNTED)]
            for i, j in _runs(numbers):
                if parts and numbers[i] != shard:
                    yield made(shard, parts)
                    parts, size = [], 0
                shard = int(numbers[i])
                words, counts, pairs, times = (d[e[i] : e[j]] for e, d in columns)
                parts.append([words.copy().view(np.uint64), counts.copy(), _widened(pairs, PAIR_BYTES), times.copy()])
                size += len(counts) + len(times)
                if size > 2 * (len(parts[0][0]) + len(parts[0][2])) + (1 << 20):
                    parts = [summed(parts)]
                    size = len(parts[0][0]) + len(parts[0][2])
        if parts:
            yield made(shard, parts)

    return run


class Model(NamedTuple):
    """The stored shards, how many ranges there are, the totals, and the bytes of all filters."""

    index: DataFrame
    shards: int
    totals: Totals
    size: int


def fit_language_model(
    docs: DataFrame, text_col: str = "text", shard_chars: int = SHARD_CHARS, bits: int = BITS
) -> Model:
    """A model of all words and pairs of ``docs``. There is one shard for every ``shard_chars`` characters of text.

    A null text is an empty one, which has an end only. Without any document the model knows nothing.
    """
    spark = docs.sparkSession
    source = renamed(docs, text=text_col)
    chars = source.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint") + 1).alias("n")).first()["n"] or 0
    shards = max(1, -(-chars // shard_chars))
    counted = source.mapInArrow(_count_pass(shards), f"shard int, {_COUNTED}")
    path = shared_folder(spark, "language-model")
    dealt = counted.repartition("shard").sortWithinPartitions("shard")
    with session_settings(spark, {SHUFFLE_CLEANUP: "true"} | _GROUP_BATCHES):
        dealt.mapInArrow(_build_pass(bits), SHARD).write.parquet(path)
    index = spark.read.schema(SHARD).parquet(path)
    row = index.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words"), F.sum(F.length("bits")).alias("size")).first()
    return Model(index, shards, Totals(row["tokens"] or 0, row["words"] or 0), row["size"] or 0)


_SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"


def _filters(model: Model) -> tuple[list[int], bytes]:
    """The filters of all shards, fetched one partition of the index after the other."""
    rows = {r["shard"]: bytes(r["bits"]) for r in model.index.select("shard", "bits").toLocalIterator()}
    bits = [rows.pop(s, b"") for s in range(model.shards)]
    return [len(b) for b in bits], b"".join(bits)


def _frequent(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Words above the share, and their counts."""
    least = model.totals.tokens / FREQUENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in _rows(batch):
                hashes, counts = np.frombuffer(hashes, np.int64), np.frombuffer(counts, np.int64)
                often = counts > least
                yield pa.record_batch([pa.array(hashes[often]), pa.array(counts[often])], names=["word", "n"])

    rows = model.index.select("hashes", "counts").mapInArrow(run, "word bigint, n bigint").collect()
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], np.array([r["n"] for r in rows], np.int64)[order]


#: the texts of a group, its rare words of a bucket, how many texts hold each, which, and how often
_QUESTION = "bucket int, keys binary, hashes binary, holders binary, texts binary, times binary"
_PARTS = f"key bigint, doc_id bigint, {_SCORES}, {_QUESTION}"


def _with_broadcast(source: DataFrame, model: Model, pseudo_count: float) -> DataFrame:
    spark = source.sparkSession
    # the size of the filters has been measured; frequent words are fewer than FREQUENT
    shared = spark.sparkContext.broadcast((*_filters(model), _frequent(model)))
    shards, totals = model.shards, model.totals
    together = max(1, BUCKET_WORDS * shards // max(totals.words, 1))
    scored = _PARTS.split(", bucket")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, data, frequent = shared.value
        filters = Filters(lengths, data)
        for batch in _groups(batches):
            group = _grouped(byte_texts(batch.column("text")))
            near = count_at(filters.levels(group.words, shard_of(group.words, shards)))
            pair_near = count_at(filters.levels(within_shard(group.pairs), shard_of(group.pairs, shards)))
            score = model_scores(group, near, pair_near, totals, pseudo_count)
            exact = exact_in(frequent, group.words)
            often = exact > 0
            base = _per_text(group, np.where(often, base_scores(exact, totals), 0.0)[group.word])
            known = _per_text(group, often.astype(np.int64)[group.word])
            keys = batch.column("key").to_numpy()
            columns = [batch.column("key"), batch.column("doc_id"), *map(pa.array, (group.sizes - 1, known, base, score))]
            rows = pa.record_batch(columns, names=[f.split()[0] for f in scored.split(", ")])
            # rare words with the texts that hold them, by the bucket of their shard
            text = np.repeat(np.arange(len(keys)), group.sizes - 1)
            rare = np.flatnonzero(~often[group.word])
            both, times = np.unique(group.word[rare].astype(np.int64) * len(keys) + text[rare], return_counts=True)
            word, text = both // len(keys), both % len(keys)
            cuts = np.append(_cuts(group.words[word], shards)[:-1:together], len(word))
            questions = []
            for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
                if i < j:
                    words_, texts_ = np.unique(word[i:j], return_counts=True)
                    arrays = texts_.astype(np.uint16), text[i:j].astype(np.uint16), times[i:j].astype(np.uint32)
                    questions.append((b, keys.tobytes(), _packed(group.words[words_]), *[a.tobytes() for a in arrays]))
            yield _aligned(rows)
            yield _aligned(_columns(questions, _QUESTION))

    path = shared_folder(spark, "scored-texts")
    # written, so that a row keeps its key
    keyed = source.withColumn("key", F.monotonically_increasing_id()).select("key", "doc_id", "text")
    with session_settings(spark, _GROUP_BATCHES):
        keyed.mapInArrow(run, _PARTS).write.parquet(path)
    parts = spark.read.schema(_PARTS).parquet(path)
    held = model.index.select((F.col("shard") / together).cast("int").alias("bucket"), "shard", "hashes", "counts")
    asked = ["keys", "holders", "texts", "times"]
    questions = parts.filter("bucket is not null").select("bucket", F.lit(None).cast("int").alias("shard"), "hashes", *asked)
    both = held.unionByName(questions, allowMissingColumns=True).repartition("bucket")
    both = both.sortWithinPartitions("bucket", F.col("shard").asc_nulls_last())
    sums = both.select("bucket", "shard", "hashes", "counts", *asked).mapInArrow(_sum_pass(totals), "key bigint, base double, known bigint")
    sums = sums.groupBy("key").agg(F.sum("base").alias("base"), F.sum("known").alias("known"))
    rows = parts.filter("bucket is null").join(sums, "key", "left")
    return rows.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("base", F.lit(0.0))).alias("base_score"), "score",
    )


def _aligned(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with all columns of the parts, null where it has none."""
    names, kinds = zip(*(f.split() for f in _PARTS.split(", ")))
    columns = [
        batch.column(n) if n in batch.schema.names else pa.nulls(batch.num_rows, _KINDS[k]) for n, k in zip(names, kinds)
    ]
    return pa.record_batch(columns, names=list(names))


def _sum_pass(totals: Totals):
    """Rows of one bucket, its shards' words ahead of the questions, to sums for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (np.empty(0, np.uint64), np.empty(0, np.int64))
        bucket, heads, table = None, [], None
        for batch in batches:
            for number, shard, hashes, counts, keys, *arrays in _rows(batch):
                if number != bucket:
                    bucket, heads, table = number, [], None
                if shard is not None:
                    heads.append((np.frombuffer(hashes, np.uint64), np.frombuffer(counts, np.int64)))
                    continue
                if table is None:
                    table, heads = tuple(map(np.concatenate, zip(*heads))) if heads else nothing, []
                holders, texts, times = (np.frombuffer(a, k) for a, k in zip(arrays, (np.uint16, np.uint16, np.uint32)))
                # a word may be in all texts of a group
                holders = np.where(holders == 0, 1 << 16, holders)
                exact = np.repeat(exact_in(table, _unpacked(hashes)), holders)
                keys = np.frombuffer(keys, np.int64)
                base = np.bincount(texts, base_scores(exact, totals) * times, len(keys))
                known = np.bincount(texts, (exact > 0) * times, len(keys)).astype(np.int64)
                asked = np.flatnonzero(np.bincount(texts, minlength=len(keys)))
                texts, base, known = keys[asked], base[asked], known[asked]
                yield pa.record_batch(list(map(pa.array, (texts, base, known))), names=["key", "base", "known"])

    return run


_GROUP = "key bigint, ids array<bigint>, ends binary, texts binary"
_ASKED = "shard int, key bigint, words binary, pairs binary"
_ANSWER = "key bigint, shard int, exact binary, near binary, pair_near binary"


def _texts(ends: bytes, data: bytes) -> Iterator[bytes]:
    """The texts of a stored group."""
    ends = np.frombuffer(ends, np.int64).tolist()
    data = pa.decompress(data, ends[-1], codec="zstd", asbytes=True) if ends[-1] else b""
    for start, end in zip([0, *ends], ends):
        yield data[start:end]


def _answer_pass(width: int):
    """Rows sorted by shard, the shard's own one ahead of the questions, to the counts of all words and pairs asked for.

    An exact count has ``width`` bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, table, filters = None, None, None
        for batch in batches:
            numbers, keys = batch.column("shard").to_numpy(), batch.column("key")
            (words_at, words_), (pairs_at, pairs_) = (_bytes(batch.column(n)) for n in ("words", "pairs"))
            at = words_at // 8 + pairs_at // PAIR_BYTES
            for i, j in _runs(numbers):
                if numbers[i] != shard:
                    shard, table, filters = numbers[i], (np.empty(0, np.uint64), np.empty(0, np.int64)), Filters([0], b"")
                if batch.column("bits")[i].is_valid:
                    hashes, counts, bits = (batch.column(n)[i].as_py() for n in ("hashes", "counts", "bits"))
                    table, filters = (np.frombuffer(hashes, np.uint64), np.frombuffer(counts, np.int64)), Filters([len(bits)], bits)
                    i += 1
                while i < j:
                    # at least one question, however long
                    end = min(j, max(i + 1, int(np.searchsorted(at, at[i] + ASKED))))
                    words, word = _distinct(words_[words_at[i] : words_at[end]].copy().view(np.uint64))
                    pairs, pair = _distinct(_widened(pairs_[pairs_at[i] : pairs_at[end]], PAIR_BYTES))
                    near, pair_near = (filters.levels(h, np.zeros(len(h), np.int64)) for h in (words, pairs))
                    cuts = (words_at[i : end + 1] - words_at[i]) // 8, (pairs_at[i : end + 1] - pairs_at[i]) // PAIR_BYTES
                    exact = _cells(_narrow(exact_in(table, words)[word], width), cuts[0])
                    found = exact, _cells(near[word], cuts[0]), _cells(pair_near[pair], cuts[1])
                    yield pa.record_batch([keys[i:end], batch.column("shard")[i:end], *found], names=_names(_ANSWER))
                    i = end

    return run


def _with_questions(source: DataFrame, model: Model, pseudo_count: float) -> DataFrame:
    """The same scores with the filters left where they are."""
    spark = source.sparkSession
    path, found = shared_folder(spark, "grouped-texts"), shared_folder(spark, "found-counts")
    shards, totals = model.shards, model.totals
    width = max(1, -(-totals.tokens.bit_length() // 8))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id"))
            texts = [t or b"" for t in byte_texts(batch.column("text"))]
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64).tobytes()
            data = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
            yield pa.record_batch([ids, pa.array([ends]), pa.array([data])], names=["ids", "ends", "texts"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, ends, data in _rows(batch):
                group = _grouped(_texts(ends, data))
                there, *cuts = _pieces(group.words, group.pairs, shards)
                keys = pa.array(np.full(len(there), key))
                cells = _cells(group.words, cuts[0]), _cells(_narrow(group.pairs, PAIR_BYTES), cuts[1])
                yield pa.record_batch([pa.array(there, pa.int32()), keys, *cells], names=_names(_ASKED))

    def scored(ids: pa.Array, ends: bytes, data: bytes, answers: list[list[np.ndarray]]) -> pa.RecordBatch:
        group = _grouped(_texts(ends, data))
        exact, near, pair_near = (np.concatenate(a) for a in zip(*answers))
        exact = _widened(exact, width)
        base = _per_text(group, base_scores(exact, totals)[group.word])
        known = _per_text(group, (exact > 0).astype(np.int64)[group.word])
        scores = model_scores(group, count_at(near), count_at(pair_near), totals, pseudo_count)
        columns = [ids, *map(pa.array, (group.sizes - 1, known, base, scores))]
        return pa.record_batch(columns, names=["doc_id", *_names(_SCORES)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, answers = None, []
        for batch in batches:
            columns = [_bytes(batch.column(n)) for n in ("exact", "near", "pair_near")]
            heads = np.flatnonzero(batch.column("shard").is_null().to_numpy(zero_copy_only=False)).tolist()
            for i, j in zip([0, *heads], [*heads, batch.num_rows]):
                answers.append([d[e[i] : e[j]].copy() for e, d in columns])
                if j < batch.num_rows:
                    if group is not None:
                        yield scored(*group, answers)
                    group = batch.column("ids")[j].values, batch.column("ends")[j].as_py(), batch.column("texts")[j].as_py()
                    answers = []
        if group is not None:
            yield scored(*group, answers)

    gathered = source.select("doc_id", "text").mapInArrow(gather, _GROUP.split(", ", 1)[1])
    # written, so that a group keeps its key
    with session_settings(spark, _GROUP_BATCHES):
        gathered.withColumn("key", F.monotonically_increasing_id()).write.parquet(path)
    groups = spark.read.schema(_GROUP).parquet(path)
    asked = groups.select("key", "ends", "texts").mapInArrow(ask, _ASKED)
    held = model.index.select("shard", "hashes", "counts", "bits")
    both = held.unionByName(asked, allowMissingColumns=True).repartition("shard")
    both = both.sortWithinPartitions("shard", F.col("bits").isNull())
    both = both.select("shard", "hashes", "counts", "bits", "key", "words", "pairs")
    # written, so that the questions need no disk any more
    with session_settings(spark, {SHUFFLE_CLEANUP: "true"}):
        both.mapInArrow(_answer_pass(width), _ANSWER).write.parquet(found)
    answers = spark.read.schema(_ANSWER).parquet(found)
    # every group with its answers, in the order of its hashes
    rows = groups.withColumn("shard", F.lit(None).cast("int")).unionByName(answers, allowMissingColumns=True)
    rows = rows.repartition("key").sortWithinPartitions("key", F.col("shard").asc_nulls_first())
    return rows.mapInArrow(score, f"doc_id bigint, {_SCORES}")


def score_texts(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    pseudo_count: float = PSEUDO_COUNT,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every document's ``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    Tokens are the words (runs of anything but ASCII white space, A-Z in lower case) and one end. ``n_known`` counts
    tokens that were learnt, ``base_score`` sums log10 of their smoothed exact shares, ``score`` is log10 of the
    model's probability of the text. The model's filters are broadcast up to ``broadcast_bytes``; beyond it groups of
    texts send their distinct words and pairs to the shards.

    Defined cases: a null or empty text is its end alone; ids that are null or repeated come back as they are; further
    columns are ignored; an empty table gives an empty result; a model of nothing gives every token the same share.
    """
    source = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    if model.size <= broadcast_bytes:
        return _with_broadcast(source, model, pseudo_count)
    return _with_questions(source, model, pseudo_count)
