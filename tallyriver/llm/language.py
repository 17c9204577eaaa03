"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of a fixed number of bytes, all of them; two recurrent passes, one from either end, give
every position of a window its class probabilities, and a document's probabilities are the mean over its positions.
The network is trained here in numpy by backpropagation through time on windows of a bounded sample.

State is kept as (direction, feature, window), so every step works on whole rows of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.llm.text import byte_texts, held_out, renamed, stratified_sample, with_columns_from

WINDOW = 64
HIDDEN = 8
MAX_ROWS = 3_000
WINDOWS_PER_ROW = 8
STEPS = 220
BATCH = 192
#: Windows that a task pushes through the network at once.
LANES = 4096
UNDETERMINED = "und"


class Model(NamedTuple):
    """Byte inputs (2, 3H, 256), recurrent weights (2, 3H, H), outputs (C, 2H) with offsets (C,), class names."""

    inputs: np.ndarray
    recurrent: np.ndarray
    outputs: np.ndarray
    offsets: np.ndarray
    names: list[str]


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of some bytes, the last one padded, and how many bytes each holds."""
    n = -(-len(data) // WINDOW)
    padded = np.zeros(n * WINDOW, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    sizes = np.full(n, WINDOW, np.int32)
    if n:
        sizes[-1] = len(data) - (n - 1) * WINDOW
    return padded.reshape(n, WINDOW), sizes


def drawn_windows(data: bytes, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """``wanted`` of the windows of some bytes, each as likely as any other; all of them if there are fewer."""
    cut, sizes = windows_of(data)
    if len(cut) > wanted:
        at = np.random.default_rng(xxhash.xxh3_64_intdigest(data)).choice(len(cut), wanted, replace=False)
        cut, sizes = cut[at], sizes[at]
    return cut, sizes


def _gates(model: Model, seen: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step: update and reset gates, candidate, and what the reset gate lets through."""
    h = HIDDEN
    x = np.stack([np.take(model.inputs[d], seen[d], axis=1) for d in (0, 1)])
    u = model.recurrent @ state
    both = np.tanh((x[:, : 2 * h] + u[:, : 2 * h]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
    update, reset = both[:, :h], both[:, h:]
    candidate = np.tanh(x[:, 2 * h :] + reset * u[:, 2 * h :])
    return update, reset, candidate, u[:, 2 * h :]


def states(model: Model, bytes_: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states (position, 2H, window): forward ones before a position's end, backward ones from its other side."""
    count, length = bytes_.shape
    columns = np.ascontiguousarray(bytes_.T)
    state = np.zeros((2, HIDDEN, count), np.float32)
    out = np.empty((length, 2 * HIDDEN, count), np.float32)
    for t in range(length):
        seen = columns[t], columns[length - 1 - t]
        update, reset, candidate, recalled = _gates(model, seen, state)
        if trace is not None:
            trace.append((seen, state, update, reset, candidate, recalled))
        state = candidate + update * (state - candidate)
        out[t, :HIDDEN], out[length - 1 - t, HIDDEN:] = state[0], state[1]
    return out


def position_probabilities(model: Model, hidden: np.ndarray) -> np.ndarray:
    """Class probabilities (position, class, window)."""
    scores = model.outputs @ hidden + model.offsets[:, None]
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _mask(sizes: np.ndarray) -> np.ndarray:
    return (np.arange(WINDOW)[:, None] < sizes).astype(np.float32)


def window_sums(model: Model, bytes_: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum over a window's positions of their class probabilities: (window, class)."""
    probabilities = position_probabilities(model, states(model, bytes_))
    return np.einsum("tcn,tn->nc", probabilities, _mask(sizes))


def _gradients(model: Model, bytes_: np.ndarray, sizes: np.ndarray, classes: np.ndarray):
    """Loss and gradients of the mean cross entropy over all positions, by backpropagation through time."""
    h, trace = HIDDEN, []
    hidden = states(model, bytes_, trace)
    probabilities = position_probabilities(model, hidden)
    mask = _mask(sizes)[:, None, :]
    total = mask.sum()
    count = np.arange(len(classes))
    picked = probabilities[:, classes, count]
    loss = float(-(np.log(picked + 1e-9) * mask[:, 0]).sum() / total)
    slope = probabilities.copy()
    slope[:, classes, count] -= 1
    slope *= mask / total
    d_outputs = np.einsum("tcn,thn->ch", slope, hidden)
    d_offsets = slope.sum(axis=(0, 2))
    d_hidden = np.matmul(model.outputs.T, slope)
    d_inputs, d_recurrent = np.zeros_like(model.inputs), np.zeros_like(model.recurrent)
    carried = np.zeros((2, h, len(classes)), np.float32)
    length = len(trace)
    for t in range(length - 1, -1, -1):
        seen, state, update, reset, candidate, recalled = trace[t]
        d_state = carried + np.stack([d_hidden[t, :h], d_hidden[length - 1 - t, h:]])
        d_candidate = d_state * (1 - update) * (1 - candidate * candidate)
        d_update = d_state * (state - candidate) * update * (1 - update)
        d_reset = d_candidate * recalled * reset * (1 - reset)
        d_u = np.concatenate([d_update, d_reset, d_candidate * reset], axis=1)
        d_x = np.concatenate([d_update, d_reset, d_candidate], axis=1)
        d_recurrent += d_u @ state.transpose(0, 2, 1)
        for d in (0, 1):
            np.add.at(d_inputs[d].T, seen[d], d_x[d].T)
        carried = d_state * update + model.recurrent.transpose(0, 2, 1) @ d_u
    return loss, [d_inputs, d_recurrent, d_outputs.astype(np.float32), d_offsets.astype(np.float32)]


def train(bytes_: np.ndarray, sizes: np.ndarray, labels: list[str], steps: int = STEPS, seed: int = 11) -> Model:
    """A model of labelled windows, by Adam; with a single label (or none) a model that always gives it."""
    names = sorted(set(labels))
    random = np.random.default_rng(seed)
    h, c = HIDDEN, max(len(names), 1)
    shapes = [(2, 3 * h, 256), (2, 3 * h, h), (c, 2 * h), (c,)]
    values = [(random.standard_normal(s) * 0.3).astype(np.float32) for s in shapes]
    if len(names) < 2:
        return Model(*values, names)
    classes = np.array([names.index(x) for x in labels])
    # every label is drawn as often
    chance = 1 / np.bincount(classes)[classes]
    chance /= chance.sum()
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        drawn = random.choice(len(classes), BATCH, p=chance)
        model = Model(*values, names)
        _, gradients = _gradients(model, bytes_[drawn], sizes[drawn], classes[drawn])
        norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
        rate = 0.03 * (1 - step / (steps + 1)) + 0.001
        for i, g in enumerate(gradients):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            scaled = (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
            values[i] = (values[i] - rate * scaled).astype(np.float32)
    return Model(*values, names)


def fit_language(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = MAX_ROWS,
    windows: int = WINDOWS_PER_ROW,
    steps: int = STEPS,
) -> Model:
    """A model of the ``lang_col`` values, trained on windows of up to ``max_rows`` rows in ``steps`` steps.

    Rows of the held-out fold, and rows without an id, a language or a text, take no part. Every language of the
    others is learnt: as many rows of each, and what small ones leave goes to larger ones. ``max_rows`` (one for each
    language at least) bounds what reaches the driver: ``windows`` windows of each chosen row, drawn over its whole
    text. Rows of the same id and language are one, with the first of their texts in order.
    """
    rows = renamed(docs, id=id_col, text=text_col, lang=lang_col)
    rows = rows.filter(F.col("lang").isNotNull() & (F.col("text") != "") & ~held_out(F.col("id")))
    chosen = stratified_sample(rows, "id", "lang", max_rows)
    texts = rows.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, parts, sizes = [], [], [], []
            rows = zip(batch.column("id").to_pylist(), batch.column("lang").to_pylist(), byte_texts(batch.column("text")))
            for i, lang, text in rows:
                for part, size in zip(*drawn_windows(text, windows)):
                    ids.append(i)
                    langs.append(str(lang))
                    parts.append(part.tobytes())
                    sizes.append(int(size))
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary()),
                 pa.array(sizes, pa.int32())],
                names=["id", "lang", "part", "size"],
            )

    typed = texts.select(F.col("id").cast("bigint").alias("id"), "lang", "text")
    found = typed.mapInArrow(run, "id bigint, lang string, part binary, size int").collect()
    found.sort(key=lambda r: (r["id"], r["part"], r["lang"]))
    data = np.frombuffer(b"".join(r["part"] for r in found), np.uint8).reshape(-1, WINDOW)
    return train(data, np.array([r["size"] for r in found], np.int32), [r["lang"] for r in found], steps)


def document_probabilities(model: Model, texts: Iterator[bytes | None]) -> Iterator[np.ndarray | None]:
    """Mean class probabilities of each text's positions, None for a text without bytes. Windows of several texts
    go through the network together; a long text takes several rounds."""
    c = max(len(model.names), 1)
    waiting: list[list] = []
    data: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    held = 0

    def flush():
        nonlocal held
        if held:
            sums = window_sums(model, np.concatenate(data), np.concatenate(sizes))
            owner = np.concatenate(owners)
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            for i, total in zip(owner[starts], np.add.reduceat(sums, starts, axis=0)):
                waiting[i][0] += total
        data.clear(), sizes.clear(), owners.clear()
        held = 0

    for text in texts:
        waiting.append([np.zeros(c), len(text or b"")])
        cut, size = windows_of(text or b"")
        for at in range(0, len(cut), LANES):
            part = cut[at : at + LANES]
            data.append(part)
            sizes.append(size[at : at + LANES])
            owners.append(np.full(len(part), len(waiting) - 1))
            held += len(part)
            if held >= LANES:
                flush()
                if at + LANES >= len(cut):
                    for total, n in waiting:
                        yield total / n if n else None
                    waiting.clear()
    flush()
    for total, n in waiting:
        yield total / n if n else None


def with_language(
    docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score"
) -> DataFrame:
    """``docs`` with the likeliest language of each text and its probability.

    A null text, one without a letter, and every text under a model that has learnt no language give ``und`` and 0.
    Ties go to the first name in order. Columns called ``lang_col`` or ``score_col`` are replaced; all others, and
    repeated rows, come back unchanged.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            langs, scores = [], []
            for p in document_probabilities(model, byte_texts(batch.column(text_col))):
                known = p is not None and model.names
                langs.append(model.names[int(p.argmax())] if known else UNDETERMINED)
                scores.append(min(1.0, float(p.max())) if known else 0.0)
            yield with_columns_from(batch, **{lang_col: pa.array(langs, pa.string()), score_col: pa.array(scores, pa.float64())})

    kept = docs.drop(lang_col, score_col)
    fields = [T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())]
    labelled = kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))
    letter = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    return labelled.withColumns(
        {
            lang_col: F.when(letter, F.col(lang_col)).otherwise(UNDETERMINED),
            score_col: F.when(letter, F.col(score_col)).otherwise(0.0),
        }
    )
