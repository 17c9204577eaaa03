"""Naive Bayes support vectors for document quality.

Features are indicators of byte n-grams, and of word n-grams that repeat one word, hashed to a fixed number of
columns. Each indicator is scaled by its class
log-count ratio and every row to unit length; a linear hinge-loss model is fitted by dual coordinate descent, and its
margin is turned into a probability by margins of models that have not seen the row.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyriver.llm.text import byte_texts, held_out, mixed, renamed, small_batches, stratified_sample, with_columns_from

COLUMNS = 1 << 18
ORDERS = (1, 2, 3)
REPEATS = (2, 3, 4)
MAX_ROWS = 6_000
FOLDS = 5
CHUNK = 1 << 20


class Model(NamedTuple):
    """Weight of each column, intercept, and slope and offset from margins to probabilities."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float


class Indicators:
    """Hashed columns of the n-grams that occur in a text, whatever its length."""

    def __init__(self):
        self.flags = np.zeros(COLUMNS, bool)

    def of(self, text: bytes | None) -> np.ndarray:
        data = np.frombuffer(text or b"", np.uint8)
        longest = max(ORDERS)
        for at in range(0, len(data), CHUNK):
            part = data[at : at + CHUNK + longest - 1].astype(np.uint64)
            for order in ORDERS:
                n = len(part) - order + 1
                if n > 0:
                    code = np.full(n, order, np.uint64)
                    for i in range(order):
                        code = code * np.uint64(256) + part[i : i + n]
                    self.flags[(mixed(code) % np.uint64(COLUMNS)).astype(np.int64)] = True
        words = (text or b"").split()
        repeats = bytes(map(operator.eq, words, words[1:]))
        for times in REPEATS:
            if b"\x01" * (times - 1) in repeats:
                self.flags[int(mixed(np.array([times], np.uint64) << np.uint64(40))[0] % np.uint64(COLUMNS))] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found


def log_count_ratio(rows: list[np.ndarray], positive: np.ndarray) -> np.ndarray:
    """log of the share of positive over negative rows that have a column, both smoothed by one."""
    counts = [np.ones(COLUMNS), np.ones(COLUMNS)]
    for columns, good in zip(rows, positive):
        counts[int(good)][columns] += 1
    return np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, epochs: int = 12, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and intercept of the hinge-loss model; the intercept is the weight of a constant column."""
    weights, intercept = np.zeros(COLUMNS), 0.0
    alpha = np.zeros(len(rows))
    lengths = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.arange(len(rows))
    shuffle = np.random.default_rng(seed)
    for _ in range(epochs):
        shuffle.shuffle(order)
        moved = 0.0
        for i in order:
            columns, values = rows[i]
            slack = signs[i] * (float(weights[columns] @ values) + intercept) - 1.0
            step = min(max(alpha[i] - slack / lengths[i], 0.0), costs[i]) - alpha[i]
            if step:
                alpha[i] += step
                weights[columns] += step * signs[i] * values
                intercept += step * signs[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, intercept


def sigmoid_fit(margins: np.ndarray, positive: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve through smoothed targets, by damped Newton steps.

    Both classes weigh the same, so a probability does not depend on how many rows of each the sample has.
    """
    good, bad = positive.sum(), (~positive).sum()
    target = np.where(positive, (good + 1) / (good + 2), 1 / (bad + 2))
    share = len(positive) / (2 * np.maximum(np.where(positive, good, bad), 1))
    points = np.stack([margins, np.ones_like(margins)])
    line = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(line @ points, -30, 30)))
        hessian = (points * (share * p * (1 - p))) @ points.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, points @ (share * (target - p)) - 1e-3 * line)
        line = line + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(line[0]), float(line[1])


def _separator(rows: list[np.ndarray], positive: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and squared ratios of all columns, and the intercept, from rows of both classes."""
    ratio = log_count_ratio(rows, positive)

    def scaled(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = ratio[columns]
        return columns, values / max(float(np.sqrt(values @ values)), 1e-9)

    signs = np.where(positive, 1.0, -1.0)
    costs = np.where(positive, len(rows) / (2 * positive.sum()), len(rows) / (2 * (~positive).sum()))
    weights, intercept = dual_coordinate_descent([scaled(c) for c in rows], signs, costs)
    # the ratio goes into the weights; scoring still divides by the scaled row's length
    return np.stack([weights * ratio, ratio * ratio]).astype(np.float32), intercept


def _margin(weights: np.ndarray, intercept: float, columns: np.ndarray) -> float:
    sums = weights[:, columns].sum(axis=1, dtype=np.float64)
    return float(sums[0]) / max(float(np.sqrt(sums[1])), 1e-9) + intercept


def fit_rows(rows: list[np.ndarray], positive: np.ndarray) -> Model:
    """A model of rows of columns, calibrated on margins by models that have not seen the row.

    Rows of a class go to ``FOLDS`` folds in turn. A row's margin is that of a model of the other folds; where these
    lack a class, that of the model of all rows. Without both classes the model is their smoothed share.
    """
    if not positive.any() or positive.all():
        share = (positive.sum() + 1) / (len(rows) + 2)
        return Model(np.zeros(COLUMNS, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    whole = _separator(rows, positive)
    margins = np.array([_margin(*whole, c) for c in rows])
    fold = np.where(positive, np.cumsum(positive), np.cumsum(~positive)) % FOLDS
    for k in range(FOLDS):
        learns, tested = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if positive[learns].any() and not positive[learns].all():
            part = _separator([rows[i] for i in learns], positive[learns])
            margins[tested] = [_margin(*part, rows[i]) for i in tested]
    slope, offset = sigmoid_fit(margins, positive)
    weights, intercept = whole
    return Model(weights, intercept, slope, offset)


def probability(model: Model, columns: np.ndarray) -> float:
    if model.weights.ndim == 1:
        margin = 0.0
    else:
        margin = _margin(model.weights, model.intercept, columns)
    return float(1 / (1 + np.exp(-np.clip(model.slope * margin + model.offset, -30, 30))))


def _first(rows: DataFrame, groups: list[str], order: list[str], count: int, place: str = "place") -> DataFrame:
    """The first ``count`` rows of each group, in the order of ``order`` and of the hash of ``id``."""
    by = Window.partitionBy(*groups).orderBy(*order, F.xxhash64("id"), "id")
    return rows.withColumn(place, F.row_number().over(by)).filter(F.col(place) <= count)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Model:
    """A model of ``labels.<label_col>`` (1 good, 0 bad), fitted on about ``max_rows`` labelled rows.

    Rows of the held-out fold, without an id, or with another label take no part. As many ids of either label are
    drawn, and what a rare one leaves goes to the other. An id that is labelled or occurs more than once counts as
    often, up to ``2 * max_rows`` rows of a label. ``max_rows`` bounds what reaches the driver: hashed columns, not texts.
    """
    wanted = renamed(labels, id=id_col, label=label_col).filter(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    known = renamed(docs, id=id_col).distinct()
    wanted = wanted.select("id", F.col("label").cast("int").alias("label")).join(known, "id", "left_semi")
    pairs = wanted.join(F.broadcast(stratified_sample(wanted, "id", "label", max_rows)), ["id", "label"]).groupBy("id", "label").count()
    copies = F.sequence(F.lit(1), F.least(F.col("count"), F.lit(2 * max_rows)).cast("int"))
    chosen = _first(pairs.select("id", "label", F.explode(copies).alias("copy")), ["label"], ["copy"], 2 * max_rows)
    texts = renamed(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id")
    texts = _first(texts.withColumn("by", F.xxhash64("text")), ["id", "label", "copy"], ["by"], 2 * max_rows, "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            found = [indicators.of(t).astype(np.int32).tobytes() for t in byte_texts(batch.column("text"))]
            yield pa.record_batch(
                [*(batch.column(c) for c in ("id", "label", "copy", "turn")), pa.array(found, pa.binary())],
                names=["id", "label", "copy", "turn", "columns"],
            )

    fields = "id bigint, label int, copy int, turn int, columns binary"
    found = texts.select(F.col("id").cast("bigint").alias("id"), "label", "copy", "turn", "text").mapInArrow(run, fields)
    # every id's first row comes before any repeated one
    rows = _first(found, ["label"], ["turn", "copy"], 2 * max_rows).collect()
    rows.sort(key=lambda r: (r["id"], r["label"], r["columns"]))
    return fit_rows([np.frombuffer(r["columns"], np.int32) for r in rows], np.array([r["label"] == 1 for r in rows], bool))


def with_quality(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``: the probability that a text is good, from 0 to 1.

    Null and empty texts have no n-gram and all get the same score, that of the intercept. A column that is already
    called ``score_col`` is replaced; all others, and repeated rows, come back unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in small_batches(batches):
            scores = [probability(shared.value, indicators.of(t)) for t in byte_texts(batch.column(text_col))]
            yield with_columns_from(batch, **{score_col: pa.array(scores, pa.float64())})

    kept = docs.drop(score_col)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(score_col, T.DoubleType())]))
