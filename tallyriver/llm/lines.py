"""Removal of lines that many documents share.

1. Every document's distinct long lines become 128-bit hashes; documents are counted for each hash, with the largest
   document id, in two combining aggregations.
2. Hashes of enough documents are dealt out to shards. Each shard gets a minimal perfect hash with compact arrays in
   its order: a fingerprint, the number of documents and the largest id. A shard is one row of a stored table.
3. The documents' line hashes go to the shards and probe the arrays, in vectors; no line meets another line. A shard
   is replicated ``salts`` times, so the probes of a line that is in most documents do not meet in one task.
4. The hits come back to their documents, which lose those lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.llm.phash import Lookup, PerfectHash, build
from tallyriver.llm.text import byte_texts, renamed, small_batches, with_columns_from
from tallyriver.storage import shared_folder

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
SHARD_KEYS = 200_000
SALTS = 8
_BLANK = b" \t\n\x0b\x0c\r"
_PAIR = np.dtype([("low", "<u8"), ("high", "<u8")])


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends, A-Z in lower case."""
    return line.strip(_BLANK).lower()


def is_long(key: bytes, min_length: int) -> bool:
    """Whether a key has at least so many code points."""
    return len(key) >= min_length and (len(key) >= 4 * min_length or len(key.decode("utf-8", "replace")) >= min_length)


def _digest(key: bytes) -> bytes:
    """16 bytes, the low half first."""
    return xxhash.xxh3_128_intdigest(key).to_bytes(16, "little")


def _hash_pass(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for doc, text in zip(batch.column("id").to_pylist(), byte_texts(batch.column("text"))):
                keys = {key for line in text.split(b"\n") if is_long(key := line_key(line), min_length)}
                found.extend(map(_digest, keys))
                ids.append(np.full(len(keys), doc, np.int64))
            pairs = np.frombuffer(b"".join(found), _PAIR)
            yield pa.record_batch(
                [pa.array(np.concatenate(ids) if ids else np.empty(0, np.int64)), pa.array(pairs["high"].view(np.int64)),
                 pa.array(pairs["low"].view(np.int64))],
                names=["id", "high", "low"],
            )

    return run


def _shard(shards: int) -> Column:
    # other bits than those that the perfect hash and the fingerprint use
    return F.pmod(F.xxhash64("low", "high"), F.lit(shards)).cast("int")


def _build_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard to one row for each shard."""
    shard, parts = None, []

    def made() -> pa.RecordBatch:
        keys = pa.Table.from_batches(parts)
        high, low = (keys.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
        built = build(high, low)
        order = np.empty(len(high), np.int64)
        order[Lookup(built)(high, low)] = np.arange(len(high))
        arrays = [
            # half of the line's hash as its fingerprint: 64 bits
            low[order],
            np.minimum(keys.column("documents").to_numpy()[order], 2**32 - 1).astype(np.uint32),
            keys.column("last").to_numpy()[order],
        ]
        return pa.record_batch(
            [pa.array([shard], pa.int32()), pa.array([built.sizes], pa.list_(pa.int64())),
             *[pa.array([a.tobytes()], pa.binary()) for a in (built.bits, *arrays)]],
            names=["shard", "sizes", "bits", "fingerprints", "counts", "lasts"],
        )

    for batch in batches:
        numbers = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1), len(numbers)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if parts and numbers[start] != shard:
                yield made()
                parts = []
            shard = int(numbers[start])
            parts.append(batch.slice(start, end - start))
    if parts:
        yield made()


INDEX = "shard int, sizes array<bigint>, bits binary, fingerprints binary, counts binary, lasts binary"


class _Arrays:
    """One shard's perfect hash and arrays, as a task holds them."""

    def __init__(self, row: dict):
        self.find = Lookup(PerfectHash(np.frombuffer(row["bits"], np.uint8), list(row["sizes"])))
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.uint32)
        self.lasts = np.frombuffer(row["lasts"], np.int64)

    def dropped(self, docs: np.ndarray, high: np.ndarray, low: np.ndarray, min_documents: int) -> np.ndarray:
        """Which lines are found here, in enough documents, and not in their last one."""
        at = self.find(high, low)
        known = at >= 0
        at = np.maximum(at, 0)
        return known & (self.fingerprints[at] == low) & (self.counts[at] >= min_documents) & (self.lasts[at] != docs)


def _probe_pass(min_documents: int):
    """Rows of one (shard, salt) with the shard's arrays ahead of its probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, arrays = None, None
        for batch in batches:
            numbers, heads = batch.column("shard").to_numpy(), batch.column("bits").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.unique(np.concatenate(([0], np.flatnonzero(heads), np.flatnonzero(heads) + 1,
                                             np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(numbers)])))
            for start, end in zip(cuts, cuts[1:]):
                if heads[start]:
                    shard, arrays = int(numbers[start]), _Arrays(batch.slice(start, 1).to_pylist()[0])
                elif int(numbers[start]) == shard:
                    part = batch.slice(start, end - start)
                    docs, high, low = (part.column(c).to_numpy() for c in ("id", "high", "low"))
                    lost = arrays.dropped(docs, high.view(np.uint64), low.view(np.uint64), min_documents)
                    pairs = np.empty(int(lost.sum()), _PAIR)
                    pairs["high"], pairs["low"] = high[lost].view(np.uint64), low[lost].view(np.uint64)
                    raw = pairs.tobytes()
                    yield pa.record_batch(
                        [pa.array(docs[lost]), pa.array([raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary())],
                        names=["id", "line"],
                    )

    return run


def line_index(docs: DataFrame, id_col: str, text_col: str, min_length: int, min_documents: int, shard_keys: int):
    """The stored line hashes of all documents and the index of those in enough documents."""
    spark = docs.sparkSession
    hashed, indexed = shared_folder(spark, "line-hashes"), shared_folder(spark, "line-index")
    source = renamed(docs, id=id_col, text=text_col).filter("id is not null and text is not null")
    source = source.withColumn("id", F.col("id").cast("bigint"))
    fields = "id bigint, high bigint, low bigint"
    source.mapInArrow(_hash_pass(min_length), fields).write.parquet(hashed)
    lines = spark.read.schema(fields).parquet(hashed)
    keys = lines.distinct().groupBy("high", "low").agg(F.count(F.lit(1)).alias("documents"), F.max("id").alias("last"))
    stored = shared_folder(spark, "line-keys")
    keys.filter(F.col("documents") >= min_documents).write.parquet(stored)
    keys = spark.read.schema(keys.schema).parquet(stored)
    shards = max(1, -(-keys.count() // shard_keys))
    dealt = keys.withColumn("shard", _shard(shards)).repartition("shard").sortWithinPartitions("shard")
    dealt.mapInArrow(_build_pass, INDEX).write.parquet(indexed)
    return lines, spark.read.schema(INDEX).parquet(indexed), shards


def _split(text: bytes | None, lost: set[bytes], min_length: int) -> tuple[int, int, bytes]:
    lines = (text or b"").split(b"\n")
    if not lost:
        return len(lines), 0, text or b""
    kept = [x for x in lines if not (is_long(key := line_key(x), min_length) and _digest(key) in lost)]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
    shard_keys: int = SHARD_KEYS,
    salts: int = SALTS,
) -> DataFrame:
    """``docs`` with shared lines removed from its text, and columns ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys of at least
    ``min_length`` code points in at least ``min_documents`` documents lose all their lines but those of the largest
    id that has the key. ``n_lines`` counts lines before that.

    Defined cases: a null or empty text is one empty line and comes out empty. Rows that repeat an id are one document
    for the counts, and each loses its own lines. Rows without an id are not counted and keep all lines. Columns called
    ``n_lines`` or ``n_dropped`` are replaced, all others come back. An empty table gives an empty result.
    """
    lines, index, shards = line_index(docs, id_col, text_col, min_length, min_documents, shard_keys)
    arrays = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    probes = lines.distinct().select(
        _shard(shards).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"), "id", "high", "low"
    )
    both = arrays.unionByName(probes, allowMissingColumns=True)
    both = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("bits").isNull())
    hits = both.mapInArrow(_probe_pass(min_documents), "id bigint, line binary")
    lost = hits.groupBy("id").agg(F.collect_set("line").alias("lost__")).withColumnRenamed("id", "lost_id__")

    kept = docs.drop("n_lines", "n_dropped")
    joined = kept.join(lost, kept[f"`{id_col}`"].cast("bigint") == F.col("lost_id__"), "left").drop("lost_id__")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = [
                _split(text, set(gone or ()), min_length)
                for text, gone in zip(byte_texts(batch.column(text_col)), batch.column("lost__").to_pylist())
            ]
            n, dropped, texts = zip(*rows) if rows else ((), (), ())
            yield with_columns_from(
                batch.drop_columns(["lost__"]),
                **{text_col: pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": pa.array(n, pa.int64()),
                   "n_dropped": pa.array(dropped, pa.int64())},
            )

    counts = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped")]
    return joined.mapInArrow(run, T.StructType([*kept.schema.fields, *counts]))
