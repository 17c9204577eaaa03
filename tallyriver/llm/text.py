"""Words, word hashes and shingles of texts, as numpy arrays inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyriver.storage import shared_folder

SHINGLE_WORDS = 5
HELD_OUT_FOLDS = 5
BATCH_ROWS = 256

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def renamed(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given names, so that no other column can clash."""
    return docs.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def held_out(doc_id: Column, folds: int = HELD_OUT_FOLDS) -> Column:
    """Whether a row belongs to the fold that no model learns from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, for results that are as large as their rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


def byte_texts(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a text column, one row at a time."""
    data = column.cast(pa.large_binary())
    for value in data:
        yield value.as_py()


def words(text: bytes) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z in lower case."""
    return text.lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads close values."""
    values = (values ^ (values >> np.uint64(32))) * _STEP
    return values ^ (values >> np.uint64(29))


def shingle_hashes(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter; none without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    out = np.full(n - width + 1, width, np.uint64)
    factor = _MULTIPLIER
    for i in range(width):
        out += hashes[i : n - width + 1 + i] * factor
        factor = np.uint64((int(factor) * int(_MULTIPLIER)) & 0xFFFFFFFFFFFFFFFF)
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def shingle_set(text: bytes | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    if not text:
        return np.empty(0, np.uint64)
    return distinct(shingle_hashes(word_hashes(words(text)), size))


def bounded_sample(rows: DataFrame, id_col: str, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows (never over twice as many), chosen by the hash of an id: all rows if there are fewer.

    The choice depends on the ids and the number of rows alone. Rows without an id are never chosen.
    """
    scale = 1_000_000_000
    total = rows.filter(F.col(id_col).isNotNull()).count()
    share = min(scale, -(-scale * max_rows // max(total, 1)))
    return rows.filter(F.pmod(F.xxhash64(id_col), F.lit(scale)) < share).filter(F.col(id_col).isNotNull()).limit(2 * max_rows)


def quotas(counts: dict, max_rows: int) -> dict:
    """How many rows of each class are drawn: as many of each, what small classes leave goes to larger ones.

    ``max_rows`` in all, but one of each class at least.
    """
    found, left = {}, max_rows
    for i, (name, count) in enumerate(sorted(counts.items(), key=lambda x: x[1])):
        found[name] = min(count, max(1, left // (len(counts) - i)))
        left = max(0, left - found[name])
    return found


def stratified_sample(rows: DataFrame, id_col: str, class_col: str, max_rows: int) -> DataFrame:
    """Distinct pairs ``id_col`` and ``class_col``, of each class as many as ``quotas`` says, chosen by the hash of the id.

    A class with few rows is there however many rows the others have. Rows without an id or a class are never chosen.
    """
    spark, scale = rows.sparkSession, 1_000_000_000
    path = shared_folder(spark, "learnable")
    named = rows.select(id_col, class_col).filter(F.col(id_col).isNotNull() & F.col(class_col).isNotNull())
    named.distinct().write.parquet(path)
    pairs = spark.read.schema(named.schema).parquet(path)
    # one row for each class, as a model of them needs
    counts = {r[class_col]: r["count"] for r in pairs.groupBy(class_col).count().collect()}
    wanted = [(name, counts[name], n) for name, n in quotas(counts, max_rows).items()]
    kind = named.schema[class_col].dataType.simpleString()
    drawn = pairs.join(F.broadcast(spark.createDataFrame(wanted, f"`{class_col}` {kind}, count__ bigint, wanted__ bigint")), class_col)
    # about four times as many by their hash, so that the sort meets few rows
    near = F.pmod(F.xxhash64(id_col), F.lit(scale)) * (F.col("count__") / scale) <= 4 * F.col("wanted__") + 40
    first = Window.partitionBy(class_col).orderBy(F.pmod(F.xxhash64(id_col), F.lit(scale)), id_col)
    ranked = drawn.filter(near).withColumn("place__", F.row_number().over(first))
    return ranked.filter(F.col("place__") <= F.col("wanted__")).select(id_col, class_col)


def with_columns_from(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with further columns at its end; those of the same name are replaced in their place."""
    kept = {name: columns.get(name, batch.column(name)) for name in batch.schema.names}
    return pa.RecordBatch.from_pydict({**kept, **columns})
