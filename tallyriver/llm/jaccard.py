"""Exact Jaccard self-join of word n-gram sets by prefix trees.

1. One pass hashes every text to its set, names the set's class (copies share it) and counts shingles in a fixed
   number of hash buckets. The bucket loads give the global order: shingles of crowded buckets come last.
2. Every class sends the first shingles of its ordered set. A partner may miss ``spare`` of them at most, and twice
   as many and one are sent, so a class stays a candidate only while at least ``spare`` of its shingles are met by
   other candidates. Linked sets lie in one band of sizes or in neighbouring ones, so what remains meets by band: a
   class is at home in its own and a guest in the band below, and guests count only where they meet one at home.
   Candidates of a band that meet at a shingle are joined to a star; connected stars are candidate groups.
3. The full sets of each group's home classes are stored in a trie. Every set walks the trie, sharing the overlap
   counted on common paths; subtrees that cannot reach the needed overlap by their remaining lengths are cut, and so
   are subtrees whose sets are all linked with the walking set already.

Links are exact for the hashed shingles (64 bits). Copies are never expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.llm.components import components
from tallyriver.llm.text import SHINGLE_WORDS, byte_texts, renamed, shingle_set
from tallyriver.storage import shared_folder

BUCKETS = 1 << 18
SLICES = 16
GROUP_TOKENS = 4_000_000
#: From this place on (twice the mean load) a shingle's classes are dealt out in parts.
CROWDED = 4
REFINEMENTS = 2
#: Bands grow by a quarter at least, so that their number stays small for high percentages, too.
WIDEST_BAND = 80
LARGEST_SET = 1 << 40


def class_name(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a sorted shingle set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def levels(loads: np.ndarray) -> np.ndarray:
    """A bucket's place in the global order: quarter powers of two above the mean load, as one byte."""
    mean = max(float(loads.mean()), 1.0)
    return np.clip(np.floor(4 * np.log2(np.maximum(loads / mean, 1.0))), 0, 255).astype(np.uint8)


def _needed(size: int, percent: int) -> int:
    """The least overlap of a set of ``size`` with any partner: size * percent / 100, rounded up."""
    return -(-size * percent // 100)


def band_edges(percent: int) -> list[int]:
    """Least sizes of the bands: sets of one band link with sets of the same band and its neighbours alone."""
    edges, step = [1], min(percent, WIDEST_BAND)
    while edges[-1] < LARGEST_SET:
        edges.append(max(edges[-1] + 1, -(-100 * edges[-1] // step)))
    return edges


def _sets_pass(size: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads, seen = np.zeros(buckets, np.int64), set()
        for batch in batches:
            sizes, names = [], []
            for text in byte_texts(batch.column("text")):
                shingles = shingle_set(text, size)
                name = class_name(shingles)
                sizes.append(len(shingles))
                names.append(name if len(shingles) else None)
                if name not in seen:
                    seen.add(name)
                    np.add.at(loads, (shingles % np.uint64(buckets)).astype(np.int64), 1)
            n = len(sizes)
            yield pa.record_batch(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.nulls(n, pa.int32()),
                 pa.nulls(n, pa.binary())],
                names=["id", "n", "class", "slice", "loads"],
            )
        parts = np.split(loads, SLICES)
        yield pa.record_batch(
            [pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()),
             pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=["id", "n", "class", "slice", "loads"],
        )

    return run


def _sum_loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task one sum for each slice it has met."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, data in zip(batch.column("slice").to_pylist(), batch.column("loads")):
            loads = np.frombuffer(data.as_py(), np.int64)
            sums[part] = sums[part] + loads if part in sums else loads
    if sums:
        yield pa.record_batch(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["slice", "loads"],
        )


def _prefix_pass(size: int, percent: int, order: np.ndarray):
    buckets = len(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            tokens, names, places = [], [], []
            for text in byte_texts(batch.column("text")):
                shingles = shingle_set(text, size)
                n, name = len(shingles), class_name(shingles)
                # a smaller set has no partner but itself: n overlaps of n + 1 are too few
                if n * 100 < percent * (n + 1) or name in seen:
                    continue
                seen.add(name)
                place = order[(shingles % np.uint64(buckets)).astype(np.int64)]
                first = np.lexsort((shingles, place))[: 2 * (n - _needed(n, percent)) + 1]
                tokens.append(shingles[first].view(np.int64))
                places.append(place[first])
                names.append(np.full(len(first), name, np.int64))
            if tokens:
                yield pa.record_batch(
                    [pa.array(np.concatenate(tokens)), pa.array(np.concatenate(places).astype(np.int16)),
                     pa.array(np.concatenate(names))],
                    names=["token", "place", "class"],
                )

    return run


class _Node:
    """A trie node: the tokens of its edge, its children, and bounds over the sets below."""

    __slots__ = ("edge", "children", "members", "least", "most", "rest", "some", "mixed")

    def __init__(self, edge, member, size, rest):
        self.edge, self.children, self.members = edge, {}, []
        self.least = self.most = size
        self.rest, self.some, self.mixed = rest, member, False


class Trie:
    """Sets of one candidate group; ``link`` joins a set with all stored ones, then stores it if it is to meet others."""

    def __init__(self, vocabulary: int, percent: int):
        self.percent = percent
        self.roots: dict[int, _Node] = {}
        self.parent: list[int] = []
        self.mask = np.zeros(vocabulary, bool)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def overlap_needed(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))

    def link(self, tokens: np.ndarray, size: int, store: bool = True) -> None:
        """``tokens``: the set's shared shingles in trie order; ``size``: the whole set's size."""
        me = len(self.parent)
        self.parent.append(me)
        self.mask[tokens] = True
        low, high = _needed(size, self.percent), size * 100 // self.percent
        stack = [(node, 0) for node in self.roots.values()]
        while stack:
            node, shared = stack.pop()
            if node.most < low or node.least > high:
                continue
            if not node.mixed and self.find(node.some) == self.find(me):
                continue
            mine = len(tokens) - int(np.searchsorted(tokens, node.edge[0]))
            needed = self.overlap_needed(size, max(node.least, low))
            if shared + min(mine, len(node.edge) + node.rest) < needed:
                continue
            shared += int(np.count_nonzero(self.mask[node.edge]))
            for other, other_size in node.members:
                if shared >= self.overlap_needed(size, other_size):
                    self.parent[self.find(me)] = self.find(other)
            stack.extend((child, shared) for child in node.children.values())
        self.mask[tokens] = False
        if store:
            self._store(tokens, size, me)

    def _store(self, tokens: np.ndarray, size: int, me: int) -> None:
        level, at = self.roots, 0
        while at < len(tokens):
            first = int(tokens[at])
            node = level.get(first)
            if node is None:
                node = level[first] = _Node(tokens[at:], me, size, 0)
                node.members.append((me, size))
                return
            common = min(len(node.edge), len(tokens) - at)
            differ = np.flatnonzero(node.edge[:common] != tokens[at : at + common])
            split = int(differ[0]) if len(differ) else common
            if split < len(node.edge):
                upper = _Node(node.edge[:split], node.some, node.least, len(node.edge) - split + node.rest)
                upper.most, upper.mixed = node.most, node.mixed
                node.edge = node.edge[split:]
                upper.children[int(node.edge[0])] = node
                level[first] = node = upper
            at += split
            node.least, node.most = min(node.least, size), max(node.most, size)
            node.rest = max(node.rest, len(tokens) - at)
            node.mixed = node.mixed or self.find(node.some) != self.find(me)
            if at == len(tokens):
                node.members.append((me, size))
            level = node.children


def linked(
    names: list[int], sets: list[np.ndarray], percent: int, homes: list[bool] | None = None
) -> list[tuple[int, int]]:
    """(name, smallest linked name) of one group of distinct sets; sets without links are left out.

    Two guests (sets not at home) are not compared with each other.
    """
    known, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # trie order: shingles of many sets first, so that similar sets share long paths
    rank = np.empty(len(known), np.int32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(known), dtype=np.int32)
    vocabulary = int(np.count_nonzero(counts > 1))
    trie, ranks = Trie(max(vocabulary, 1), percent), rank[codes]
    ends = np.cumsum([len(shingles) for shingles in sets])
    at_home = np.ones(len(sets), bool) if homes is None else np.array(homes, bool)
    order = np.argsort(~at_home, kind="stable")
    for i in order:
        mine = np.sort(ranks[ends[i] - len(sets[i]) : ends[i]])
        trie.link(mine[: np.searchsorted(mine, vocabulary)], len(sets[i]), store=bool(at_home[i]))
    least: dict[int, int] = {}
    for i, at in enumerate(order):
        root = trie.find(i)
        least[root] = min(least.get(root, names[at]), names[at])
    return [(names[at], least[trie.find(i)]) for i, at in enumerate(order) if least[trie.find(i)] != names[at]]


def _met(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows whose shingle (``keys``) another class has too, one of them at home; crowded shingles are taken to have one."""
    over = f"over (partition by {', '.join(keys)})"
    both = rows.repartition(*keys).dropDuplicates([*keys, "place", "class"])
    both = both.withColumns({f: F.expr(f"{f}(class) {over}") for f in ("min", "max")})
    shared = F.expr("min <> max")
    if "home" in rows.columns:
        both, shared = both.withColumn("met", F.expr(f"max(home) {over}")), shared & F.col("met")
    kept = both.filter((F.col("place") >= CROWDED) | shared).select(rows.columns)
    path = shared_folder(rows.sparkSession, "met")
    kept.write.parquet(path)
    return rows.sparkSession.read.schema(kept.schema).parquet(path)


def _set_pass(size: int):
    """Texts of candidates to their sets; rows whose text is not of the class that called for them go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, tokens = [], []
            for i, (text, name) in enumerate(zip(byte_texts(batch.column("text")), batch.column("class").to_pylist())):
                shingles = shingle_set(text, size)
                if class_name(shingles) == name:
                    keep.append(i)
                    tokens.append(shingles.tobytes())
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.record_batch(
                [part.column("targets"), part.column("class"), pa.array(tokens, pa.binary())],
                names=["targets", "class", "tokens"],
            )

    return run


def _trie_pass(percent: int):
    """Rows sorted by group and block pair; one group's sets are in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sets = None, {}

        def links() -> pa.RecordBatch:
            names, homes = list(sets), [home for home, _ in sets.values()]
            found = linked(names, [tokens for _, tokens in sets.values()], percent, homes) if len(sets) > 1 else []
            columns = list(zip(*found)) or [(), ()]
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("group", "pair", "class", "home", "tokens")])
            for group, pair, name, home, tokens in rows:
                if (group, pair) != key:
                    if sets:
                        yield links()
                    key, sets = (group, pair), {}
                sets[name] = (home or name in sets and sets[name][0], np.frombuffer(tokens, np.uint64))
        if sets:
            yield links()

    return run


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    size: int = SHINGLE_WORDS,
    buckets: int = BUCKETS,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Every document's ``doc_id``, ``n_shingles``, ``class_id`` and ``component_id``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of ``size``-word shingles; the
    component is the smallest id reachable by links. Documents of one class have the same set.

    Defined cases: a null, empty or blank text has no shingles, no class and its own id as component. A text with
    fewer than ``size`` words has one shingle, the whole sequence. Rows that repeat an id come back as often, each
    by its own text. A null id links like any other; the component is the smallest id that is not null. An empty
    table gives an empty result. Further columns are ignored.

    ``group_tokens`` bounds the shingles a task holds of one group: a larger candidate group is dealt out in blocks
    by class, every pair of blocks meets in a task, and the links are contracted afterwards.
    """
    spark = docs.sparkSession
    source = renamed(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    passed = shared_folder(spark, "sets")
    fields = "id bigint, n bigint, class bigint, slice int, loads binary"
    source.mapInArrow(_sets_pass(size, buckets), fields).write.parquet(passed)
    seen = spark.read.schema(fields).parquet(passed)
    classes = seen.filter("slice is null").select("id", "n", "class")

    # what comes to the driver is one number for each bucket
    partial = seen.filter("slice is not null").select("slice", "loads").repartition(SLICES, "slice")
    loads = np.zeros((SLICES, buckets // SLICES), np.int64)
    for row in partial.mapInArrow(_sum_loads, "slice int, loads binary").collect():
        loads[row["slice"]] += np.frombuffer(row["loads"], np.int64)
    order = levels(loads.reshape(-1))

    # a crowded shingle's classes meet in parts, one for each multiple of the mean load, and the parts meet again
    prefixes = source.select("text").mapInArrow(_prefix_pass(size, percent, order), "token bigint, place smallint, class bigint")
    parts = F.when(F.col("place") >= CROWDED, F.ceil(F.pow(F.lit(2.0), F.col("place") / 4))).otherwise(F.lit(1))
    met = _met(prefixes.withColumn("part", F.pmod(F.xxhash64("class"), parts)), "token", "part")
    spare = F.greatest(F.lit(1), F.col("n") - F.ceil(F.col("n") * percent / 100))
    band = F.size(F.filter(F.lit(band_edges(percent)), lambda edge: edge <= F.col("n"))).cast("smallint")
    sized = classes.groupBy("class").agg(F.min("id").alias("id"), F.min("n").alias("n"))
    needs = sized.select("class", spare.alias("spare"), band.alias("own"))
    able = met.groupBy("class").agg(F.count(F.lit(1)).alias("k")).join(needs, "class").filter("k >= spare")
    met = met.join(able.select("class", "own"), "class").withColumn("band", F.explode(F.array(F.col("own"), F.expr("own - 1S"))))
    met = _met(met.withColumn("home", F.expr("band = own")).drop("own"), "token", "part", "band")
    for _ in range(REFINEMENTS - 1):
        counts = met.groupBy("class", "band").agg(F.count(F.lit(1)).alias("k")).join(needs, "class")
        met = met.join(counts.filter("k >= spare").select("class", "band"), ["class", "band"], "left_semi")
        met = _met(met, "token", "part", "band")
    met = met.withColumn("unit", F.xxhash64("class", "band"))
    over = "over (partition by token, part, band)"
    head = F.expr(f"coalesce(min(case when home then unit end) {over}, min(unit) {over})")
    met = met.withColumn("head", head)
    heads = met.filter((F.col("place") >= CROWDED) & F.expr("unit = head")).select("token", "band", "head")
    tops = heads.groupBy("token", "band").agg(F.min("head").alias("top"))
    stars = met.filter("unit <> head").select(F.col("unit").alias("a"), F.col("head").alias("b"))
    stars = stars.union(heads.join(tops, ["token", "band"]).filter("head <> top").select(F.col("head"), F.col("top")))
    groups = components(stars.distinct()).select(F.col("node").alias("unit"), F.col("root").alias("group"))

    members = met.select("unit", "class", "home").distinct().join(groups, "unit").join(sized, "class")
    totals = members.groupBy("group").agg(F.ceil(F.sum("n") / group_tokens).cast("int").alias("blocks"))
    target = F.struct("group", "blocks", "home")
    called = members.join(totals, "group").groupBy("class").agg(F.min("id").alias("id"), F.collect_list(target).alias("targets"))
    texts = source.alias("s").join(called.alias("c"), F.col("s.id").eqNullSafe(F.col("c.id")))
    texts = texts.select("text", "class", "targets")
    fields = "targets array<struct<group: bigint, blocks: int, home: boolean>>, class bigint, tokens binary"
    sets = texts.mapInArrow(_set_pass(size), fields).select(F.inline("targets"), "class", "tokens")

    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(block, other) * F.col("blocks") + F.greatest(block, other),
    )
    meeting = sets.withColumn("pair", F.explode(pairs)).select("group", "pair", "class", "home", "tokens")
    meeting = meeting.repartition("group", "pair").sortWithinPartitions("group", "pair")
    links = components(meeting.mapInArrow(_trie_pass(percent), "a bigint, b bigint"))

    firsts = classes.filter("class is not null").groupBy("class").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("k"))
    joined = firsts.join(links.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = joined.filter("k > 1 or root <> class or first is null").union(
        joined.join(links.select("root").distinct(), "root", "left_semi").select(joined.columns)
    )
    named = named.distinct().join(least, "root").select("class", "component_id")
    whole = classes.join(named, "class", "left")
    return whole.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("class").alias("class_id"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
