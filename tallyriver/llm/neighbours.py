"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample; every row is then dealt to one leaf of each tree. A query walks all trees at
once through one priority queue, ordered by how far it lies beyond the planes on the way, and probes the leaves in
that order. Leaves and their probes meet by a shuffle, large leaves in blocks; a block keeps each query's best rows by
exact cosine, and the best of all blocks are the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyriver.llm.text import bounded_sample, renamed
from tallyriver.storage import shared_folder

TREES = 8
SAMPLE_ROWS = 20_000
SAMPLE_LEAF = 32
MAX_DEPTH = 9
#: The share of all trees' leaves that a query probes.
PROBED = 0.16
BLOCK_ROWS = 20_000
CLOSE = 1e-9


class Forest(NamedTuple):
    """Trees in heap order: plane (dim,) and offset of every inner node, the leaf number or -1 of every node."""

    planes: np.ndarray
    offsets: np.ndarray
    leaves: np.ndarray
    count: int


def usable(vector: Column) -> Column:
    """Neither null nor zero, and no component null, infinite or not a number."""
    numbers = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(numbers & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose rows all have the same length."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Every row times a power of two, which is exact, so that its largest component is near 1 and squares stay finite."""
    largest = np.abs(rows).max(axis=1, initial=0.0)
    return np.ldexp(rows, -np.frexp(largest)[1][:, None])


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = _scaled(rows)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def grow(sample: np.ndarray, trees: int = TREES, seed: int = 3) -> Forest:
    """Median splits along random directions, until a node holds few sampled rows or cannot be split."""
    depth = int(np.clip(np.floor(np.log2(max(len(sample), 1) / SAMPLE_LEAF)), 0, MAX_DEPTH))
    nodes, dim = (1 << (depth + 1)) - 1, sample.shape[1] if sample.ndim == 2 else 0
    random = np.random.default_rng(seed)
    planes = random.standard_normal((trees, nodes, dim))
    planes /= np.sqrt((planes * planes).sum(axis=2, keepdims=True)) + 1e-300
    offsets, leaves, count = np.zeros((trees, nodes)), np.full((trees, nodes), -1, np.int64), 0
    for tree in range(trees):
        stack = [(0, np.arange(len(sample)))]
        while stack:
            node, rows = stack.pop()
            margins = sample[rows] @ planes[tree, node] if dim else np.zeros(0)
            cut = float(np.median(margins)) if len(rows) else 0.0
            right = margins > cut
            if 2 * node + 2 >= nodes or not right.any():
                leaves[tree, node], count = count, count + 1
                continue
            offsets[tree, node] = cut
            stack += [(2 * node + 1, rows[~right]), (2 * node + 2, rows[right])]
    return Forest(planes, offsets, leaves, count)


def leaves_of(forest: Forest, rows: np.ndarray) -> np.ndarray:
    """The leaf of every unit row in every tree: (row, tree)."""
    out = np.empty((len(rows), len(forest.leaves)), np.int64)
    for tree in range(len(forest.leaves)):
        at = np.zeros(len(rows), np.int64)
        moving = np.flatnonzero(forest.leaves[tree, at] < 0)
        while len(moving):
            nodes = at[moving]
            margins = np.einsum("ij,ij->i", rows[moving], forest.planes[tree, nodes]) - forest.offsets[tree, nodes]
            at[moving] = 2 * nodes + 1 + (margins > 0)
            moving = moving[forest.leaves[tree, at[moving]] < 0]
        out[:, tree] = forest.leaves[tree, at]
    return out


def probes(forest: Forest, query: np.ndarray, wanted: int) -> list[int]:
    """The ``wanted`` leaves nearest to a unit query, from one queue shared by all trees."""
    margins = forest.planes @ query - forest.offsets
    queue = [(0.0, tree, 0) for tree in range(len(forest.leaves))]
    found: list[int] = []
    while queue and len(found) < wanted:
        beyond, tree, node = heapq.heappop(queue)
        if forest.leaves[tree, node] >= 0:
            found.append(int(forest.leaves[tree, node]))
            continue
        margin = margins[tree, node]
        near, far = (2 * node + 2, 2 * node + 1) if margin > 0 else (2 * node + 1, 2 * node + 2)
        heapq.heappush(queue, (beyond, tree, near))
        heapq.heappush(queue, (max(beyond, abs(float(margin))), tree, far))
    return found


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, row by row, so that equal rows have equal results wherever they stand."""
    rows, query = _scaled(rows), _scaled(query[None])[0]
    lengths = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum())
    return (rows * query).sum(axis=1) / lengths


def best(ids: np.ndarray, rows: np.ndarray, rough: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest ids but the query's own, each with its best row's cosine, ties by id.

    ``ids`` are in order and may repeat. ``rough``: cosines up to ``CLOSE``.
    """
    rough = np.where(ids == own, -np.inf, rough)
    firsts = np.flatnonzero(np.concatenate((np.ones(min(len(ids), 1), bool), ids[1:] != ids[:-1])))
    of_ids = np.maximum.reduceat(rough, firsts) if len(firsts) < len(ids) else rough
    if len(of_ids) > k:
        chosen = np.flatnonzero(rough >= np.partition(of_ids, len(of_ids) - k)[len(of_ids) - k] - CLOSE)
    else:
        chosen = np.arange(len(rough))
    chosen = chosen[ids[chosen] != own]
    scores = cosines(rows[chosen], query)
    order = np.lexsort((-scores, ids[chosen]))
    found, scores = ids[chosen][order], scores[order]
    once = np.concatenate((np.ones(min(len(found), 1), bool), found[1:] != found[:-1]))
    found, scores = found[once], scores[once]
    order = np.lexsort((found, -scores))[:k]
    return found[order], scores[order]


class Index(NamedTuple):
    """The forest, the path of the stored rows by leaf, blocks of each leaf, and the vectors' dimension."""

    forest: Forest
    path: str
    blocks: np.ndarray
    dim: int


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    named = renamed(rows, id=id_col, vector=vector_col).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    return named.select(F.col("id").cast("bigint").alias("id"), F.col("vector").cast("array<double>").alias("vector"))


def build_index(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> Index:
    """Grow a forest on about ``sample_rows`` rows and store every row under its leaves.

    Left out are rows without an id, and vectors that are null, zero, hold null or non-finite components, or have
    another length than most of the sample. Rows of the same id and vector are one row; an id may have several vectors.
    """
    spark = rows.sparkSession
    distinct = shared_folder(spark, "vectors")
    _vectors(rows, id_col, vector_col).distinct().write.parquet(distinct)
    vectors = spark.read.schema("id bigint, vector array<double>").parquet(distinct)
    sampled = bounded_sample(vectors.withColumn("row", F.xxhash64("id", "vector")), "row", sample_rows)
    sample = [r["vector"] for r in sampled.orderBy("id", "vector").collect()]
    lengths = [len(v) for v in sample]
    dim = max(sorted(set(lengths)), key=lengths.count) if lengths else 0
    forest = grow(_unit(np.array([v for v in sample if len(v) == dim], np.float64).reshape(-1, max(dim, 1))), trees)
    shared = spark.sparkContext.broadcast(forest)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = leaves_of(shared.value, _unit(_matrix(batch.column("vector"))))
            for tree in range(found.shape[1]):
                yield pa.record_batch([pa.array(found[:, tree], pa.int32()), *batch.columns], names=["leaf", "id", "vector"])

    path, fields = shared_folder(spark, "vector-index"), "leaf int, id bigint, vector array<double>"
    vectors.filter(F.size("vector") == dim).mapInArrow(deal, fields).write.parquet(path)
    blocks = np.ones(max(forest.count, 1), np.int64)
    # one number for each leaf of the forest
    for row in spark.read.schema(fields).parquet(path).groupBy("leaf").count().collect():
        blocks[row["leaf"]] = -(-row["count"] // block_rows)
    return Index(forest, path, blocks, dim)


def dealt_rows(spark: SparkSession, index: Index) -> DataFrame:
    """The stored rows with their block, by a hash of id and vector, so that one id's vectors spread too."""
    blocks = F.array(*[F.lit(int(b)) for b in index.blocks]) if index.blocks.max() > 1 else None
    block = F.pmod(F.xxhash64("id", "vector"), F.get(blocks, F.col("leaf"))) if blocks is not None else F.lit(0)
    stored = spark.read.schema("leaf int, id bigint, vector array<double>").parquet(index.path)
    return stored.select("leaf", block.cast("int").alias("block"), F.lit(False).alias("query"), "id", "vector")


def _probe_pass(shared, probed: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, blocks = shared.value
        wanted = max(int(np.ceil(probed * forest.count)), min(forest.count, 2 * len(forest.leaves)))
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves, parts, take = [], [], []
            for i, row in enumerate(_unit(_matrix(batch.column("vector")))):
                for leaf in probes(forest, row, wanted):
                    for block in range(blocks[leaf]):
                        leaves.append(leaf)
                        parts.append(block)
                        take.append(i)
            chosen = batch.take(pa.array(take, pa.int64()))
            yield pa.record_batch(
                [pa.array(leaves, pa.int32()), pa.array(parts, pa.int32()), pa.array([True] * len(take)), *chosen.columns],
                names=["leaf", "block", "query", "id", "vector"],
            )

    return run


def _search_pass(k: int):
    """Rows of one block, then its queries; a block's rows are bounded, queries pass by in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts, rows, units = None, [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf, block = batch.column("leaf").to_numpy(), batch.column("block").to_numpy()
            asks = batch.column("query").to_numpy(zero_copy_only=False)
            changes = (leaf[1:] != leaf[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])
            cuts = [0, *(np.flatnonzero(changes) + 1), len(leaf)]
            found: list[tuple[int, np.ndarray, np.ndarray]] = []
            for start, end in zip(cuts, cuts[1:]):
                part = batch.slice(start, end - start)
                if (leaf[start], block[start]) != key:
                    key, ids, parts, rows = (leaf[start], block[start]), [], [], None
                numbers, vectors = part.column("id").to_numpy(), _matrix(part.column("vector"))
                if not asks[start]:
                    ids.append(numbers)
                    parts.append(vectors)
                    continue
                if not ids:
                    continue
                if rows is None:
                    known = np.concatenate(ids)
                    order = np.argsort(known, kind="stable")
                    known, rows = known[order], np.concatenate(parts)[order]
                    units = _unit(rows)
                rough = _unit(vectors) @ units.T
                found += [(q, *best(known, rows, rough[i], vectors[i], q, k)) for i, q in enumerate(numbers)]
            if found:
                yield pa.record_batch(
                    [pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[2] for f in found]), pa.float64())],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def search(
    index: Index, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", probed: float = PROBED
) -> DataFrame:
    """Each query's ``k`` nearest rows found: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Nearness is the cosine of the original vectors in double precision, ties go to the smaller id; a row with the
    query's own id is never a result, and an id with several vectors counts by its nearest. Queries that the index
    would leave out have no result; a repeated id is one query with the best of its vectors. An empty table gives an
    empty result. ``probed`` is the share of all leaves that a query visits, two for each tree at least.
    """
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast((index.forest, index.blocks))
    asked = _vectors(queries, id_col, vector_col).filter(F.size("vector") == index.dim).distinct()
    # a fixed number, as the probing of few rows is long work
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id", "vector")
    fields = "leaf int, block int, query boolean, id bigint, vector array<double>"
    probing = asked.mapInArrow(_probe_pass(shared, probed), fields)
    stored = dealt_rows(spark, index)
    both = stored.unionByName(probing).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "query")
    near = both.mapInArrow(_search_pass(k), "query_id bigint, vec_id bigint, score double")
    once = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
