"""Runs of words that repeat with a period, found by dyadic square catching.

Words are appended; for every range of periods from a power of two up to the next one there is a level of catchers. A
catcher is a completed, aligned block of words. Each appended word completes a suffix as long as the block, which is
compared with the catchers that lie one of the level's periods back: an equal one is a piece of a square. Every square
long enough holds an aligned block in its left half, so none escapes. Pieces of one period in consecutive blocks, with
what still agrees at both ends, merge into a run.

Suffixes are compared by sums of numbered words modulo 2**64; the runs found are compared word by word afterwards, and
what the sums got wrong is searched again, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.llm.text import byte_texts, mixed, renamed, small_batches, word_hashes

MIN_LENGTH = 12
#: bytes of text whose words are searched at once; a longer text is searched alone
GROUP_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)

#: from words to their order: the place from which each word is taken, or None for the words as they are
Rewrite = Callable[[int | None, int], np.ndarray | None]


class Runs(NamedTuple):
    """First word, number of words and smallest period of each run, by start and period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


class _Level:
    """Catchers for periods from ``low`` up to ``high``: blocks of ``block`` words."""

    def __init__(self, low: int, min_length: int):
        self.low, self.high = low, 2 * low
        # so many pairs of equal words one period apart has a run at least; half as long blocks cannot all miss it
        pairs = min(max(min_length - q, q) for q in range(low, self.high)) if low < min_length else low
        self.block = 1 << (((pairs + 1) // 2).bit_length() - 1)
        self.seen = 0
        self.pieces: list[np.ndarray] = []

    def advance(self, text: SquareCatchers) -> None:
        """Compare the suffixes that words appended since the last call have completed with the live catchers."""
        block = self.block
        ends = np.arange(self.seen, text.n - block + 1)
        if not len(ends):
            return
        suffixes = text.window(ends, block)
        first = max(0, self.seen - self.high) // block
        catchers = text.window(np.arange(first * block, text.n - block + 1, block), block)
        found = []
        for back in range(self.low, self.high, block):
            at = (ends - back) // block
            equal = np.flatnonzero(at >= 0)
            equal = equal[suffixes[equal] == catchers[at[equal] - first]]
            period = ends[equal] - at[equal] * block
            inside = period < self.high
            found.append(np.stack([period[inside], at[equal][inside]]))
        self.seen = text.n - block + 1
        self.pieces.append(_stretches(np.concatenate(found, axis=1)))

    def merged(self) -> np.ndarray:
        """Period, first and last block of every stretch of consecutive catching blocks."""
        pieces = np.concatenate([np.empty((3, 0), np.int64), *self.pieces], axis=1)
        if len(self.pieces) < 2 or not pieces.shape[1]:
            return pieces
        period, first, last = pieces
        order = np.lexsort((first, period))
        period, first, last = period[order], first[order], last[order]
        opens = np.ones(len(period), bool)
        # suffixes of different calls never meet the same catcher at the same period twice
        opens[1:] = (period[1:] != period[:-1]) | (first[1:] != last[:-1] + 1)
        at = np.flatnonzero(opens)
        ends = np.append(at[1:], len(period)) - 1
        self.pieces = [np.stack([period[at], first[at], last[ends]])]
        return self.pieces[0]


def _stretches(pieces: np.ndarray) -> np.ndarray:
    """Period, first and last block of consecutive blocks of one period."""
    if not pieces.shape[1]:
        return np.empty((3, 0), np.int64)
    period, block = pieces
    order = np.lexsort((block, period))
    period, block = period[order], block[order]
    opens = np.ones(len(period), bool)
    opens[1:] = (period[1:] != period[:-1]) | (block[1:] != block[:-1] + 1)
    at = np.flatnonzero(opens)
    ends = np.append(at[1:], len(period)) - 1
    return np.stack([period[at], block[at], block[ends]])


class SquareCatchers:
    """Words appended so far, their catchers, and the runs that the caught squares make up."""

    def __init__(self, min_length: int = MIN_LENGTH, longest: int | None = None):
        """``longest`` is the length of the longest text if the words are of several texts, kept apart by unique words."""
        self.min_length, self.longest = min_length, longest
        self.words = np.empty(0, np.uint64)
        self.sums, self.inverse = np.zeros(1, np.uint64), np.ones(1, np.uint64)
        self.power = np.uint64(1)
        self.levels: list[_Level] = []

    @property
    def n(self) -> int:
        return len(self.words)

    def window(self, start: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        """A number for the ``size`` words from each start; equal words have equal numbers."""
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]

    def append(self, words: np.ndarray) -> None:
        """Append words (as 64-bit numbers) and advance all levels over them."""
        if not len(words):
            return
        powers = np.full(len(words) + 1, _BASE)
        powers[0] = self.power
        np.multiply.accumulate(powers, out=powers)
        sums = np.cumsum(mixed(words.copy()) * powers[:-1]) + self.sums[-1]
        back = np.full(len(words) + 1, _INVERSE)
        back[0] = self.inverse[-1]
        np.multiply.accumulate(back, out=back)
        self.words = np.concatenate([self.words, words])
        self.sums = np.concatenate([self.sums, sums])
        self.inverse = np.concatenate([self.inverse, back[1:]])
        self.power = powers[-1]
        low = self.levels[-1].high if self.levels else 1
        while 2 * low <= min(self.n, self.longest or self.n):
            self.levels.append(_Level(low, self.min_length))
            low *= 2
        for level in self.levels:
            level.advance(self)

    def _candidates(self) -> np.ndarray:
        """Start, end and period of all maximal stretches that are long enough, as the sums have it."""
        found = [np.empty((3, 0), np.int64)]
        for level in self.levels:
            period, first, last = level.merged()
            start, stop = first * level.block, (last + 1) * level.block
            # a neighbouring block does not agree, so less than a block does
            step = level.block >> 1
            while step:
                fits = np.flatnonzero(start >= step)
                a = start[fits] - step
                fits = fits[self.window(a, step) == self.window(a + period[fits], step)]
                start[fits] -= step
                fits = np.flatnonzero(stop + period + step <= self.n)
                a = stop[fits]
                fits = fits[self.window(a, step) == self.window(a + period[fits], step)]
                stop[fits] += step
                step >>= 1
            found.append(self._long_enough(start, stop, period))
        return np.concatenate(found, axis=1)

    def _long_enough(self, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
        fits = (stop - start >= period) & (stop - start + period >= self.min_length)
        return np.stack([start[fits], stop[fits] + period[fits], period[fits]])

    def _agreeing(self, start: int, end: int, period: int) -> np.ndarray:
        """The stretches from ``start`` to ``end`` whose words do repeat with the period."""
        equal = np.zeros(end - start - period + 2, np.int8)
        equal[1:-1] = self.words[start : end - period] == self.words[start + period : end]
        edges = np.diff(equal)
        starts, stops = np.flatnonzero(edges == 1) + start, np.flatnonzero(edges == -1) + start
        return self._long_enough(starts, stops, np.full(len(starts), period))

    def runs(self) -> Runs:
        """All runs of the words so far with at least ``min_length`` words and two periods."""
        open_, sure = self._candidates(), np.empty((3, 0), np.int64)
        while open_.shape[1]:
            # a stretch found with several periods is a run of the smallest, which divides the others
            both = np.concatenate([sure, open_], axis=1)
            known = np.repeat([1, 0], [sure.shape[1], open_.shape[1]])
            order = np.lexsort((both[2], both[1], both[0]))
            both, known = both[:, order], known[order]
            smallest = np.ones(both.shape[1], bool)
            smallest[1:] = (both[0, 1:] != both[0, :-1]) | (both[1, 1:] != both[1, :-1])
            fine, again = [], []
            for start, end, period in both[:, smallest & (known == 0)].T:
                same = np.array_equal(self.words[start : end - period], self.words[start + period : end])
                fine.append([start, end, period]) if same else again.append(self._agreeing(start, end, period))
            kept = np.array(fine, np.int64).reshape(-1, 3).T
            sure = np.concatenate([both[:, smallest & (known == 1)], kept, *again], axis=1)
            # where the sums were wrong, the larger periods of that stretch are looked at again
            open_ = both[:, ~smallest & (known == 0)] if again else np.empty((3, 0), np.int64)
        order = np.lexsort((sure[2], sure[1], sure[0]))
        start, end, period = sure[:, order]
        first = np.ones(len(start), bool)
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        start, end, period = start[first], end[first], period[first]
        order = np.lexsort((period, start))
        return Runs(start[order], (end - start)[order], period[order])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, bytes]]]:
    """Rows whose texts have about ``GROUP_BYTES`` together."""
    group, size = [], 0
    for batch in small_batches(batches):
        for doc, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text"))):
            if group and size + len(text or b"") > GROUP_BYTES:
                yield group
                group, size = [], 0
            group.append((doc, text or b""))
            size += len(text or b"")
    if group:
        yield group


def _searched(group: list[tuple[int | None, bytes]], min_length: int, rewrite: Rewrite | None) -> pa.RecordBatch:
    texts, codes, places = [], [], []
    for number, (doc, text) in enumerate(group):
        tokens = text.split()
        place = rewrite(doc, len(tokens)) if rewrite else None
        hashes = word_hashes(tokens)
        texts.append(tokens)
        places.append(place)
        codes += [hashes if place is None else hashes[place], mixed(np.array([number], np.uint64) + np.uint64(1 << 63))]
    sizes = np.array([len(c) for c in codes[::2]], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    catchers = SquareCatchers(min_length, longest=int(sizes.max()))
    catchers.append(np.concatenate(codes))
    runs = catchers.runs()
    cuts = np.searchsorted(runs.start, begins)
    start = runs.start - np.repeat(begins[:-1], np.diff(cuts))
    collapsed = []
    for i, (tokens, place) in enumerate(zip(texts, places)):
        if cuts[i] == cuts[i + 1]:
            words = tokens if place is None else [tokens[k] for k in place]
        else:
            own = slice(cuts[i], cuts[i + 1])
            depth = np.zeros(sizes[i] + 1, np.int64)
            np.add.at(depth, start[own] + runs.period[own], 1)
            np.add.at(depth, start[own] + runs.length[own], -1)
            kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
            words = [tokens[k] for k in (kept if place is None else place[kept])]
        collapsed.append(b" ".join(words))
    fields = [pa.field(c, pa.int64()) for c in ("start", "length", "period")]
    found = pa.StructArray.from_arrays([pa.array(a) for a in (start, runs.length, runs.period)], fields=fields)
    return pa.record_batch(
        [pa.array([doc for doc, _ in group], pa.int64()), pa.array(sizes),
         pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), found), pa.array(collapsed, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, rewrite: Rewrite | None = None
) -> DataFrame:
    """Every document's ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    Words are runs of anything but ASCII white space, compared byte by byte and numbered from 0. A run is a stretch
    with smallest period q of at least ``min_length`` and 2q words that no neighbouring word extends with that period.
    ``runs`` are (start, length, period) by start and period. ``collapsed`` are the words, joined by one space, without
    those that a run holds after its first period. ``rewrite`` gives, from an id and a number of words, the places
    from which the words are taken before the search.

    Each row is searched by itself, whatever its length, in memory of some 100 bytes a word; nothing is shuffled.
    Defined cases: a null or empty text has no words, no runs and collapses to the empty text; ids that are null or
    repeated come back as they are; further columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            yield _searched(group, min_length, rewrite)

    source = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    fields = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return source.mapInArrow(run, fields)


def run_digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    top = found.withColumn("top", longest)
    length, period = F.col("top.length"), -F.col("top.col3")
    return top.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("top.col2")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
