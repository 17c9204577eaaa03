"""Repair of the structure of conversations by a shortest path over edits, with checkpoints.

A conversation is well formed if its roles' initials are ``(s?(ua)+)?``. Rows are kept, given another role, deleted, or
new ones inserted, at a cost each. A backward pass computes, for every boundary between rows and every state of that
pattern, the least cost of the rest. It keeps these vectors only at checkpoints, about the square root of the rows
apart. A forward pass recomputes the vectors of one block at a time and emits, among the tight edits, the one whose
letter comes first in ASCII.

On Spark, rows are sorted over range partitions by conversation and turn and packed into blocks, so the partitions of a
large conversation are ordinary ones. A conversation of one block is repaired where it lies. For one of several blocks,
each block gives its costs as a (min, +) matrix; their products from the end are the vectors at the blocks' ends, each
block walks from those, and a last task for each conversation joins the pieces that the contract wants in one value.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyriver.storage import broadcast_if_small, shared_folder

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK_ROWS = 16_384
BLOCK_BYTES = 4 << 20
BATCH_BLOCKS = 512
BATCH_BYTES = 4 << 20

# states of the pattern: nothing yet, after the system row, after a user row, after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("", "", "user", "assistant")
FINAL = (0, math.inf, math.inf, 0)
_INITIALS = {"s": 0, "u": 1, "a": 2}
_OTHER = 3
# faults of a row
SOUND, CUT, BLANK, DUPLICATE = range(4)
_SPACE = " \t\n\v\f\r"
_LEGAL = {"su", "ua", "au"}


def kind(role: str, fault: int) -> int:
    """A row's number for the search: the initial of its role and its fault."""
    return fault * 4 + _INITIALS.get(role[:1], _OTHER)


def _edits(kind: int) -> list[list[tuple[str, int, int]]]:
    """For every state, the edits of a row of this kind as (letter, cost, state after), in the order of their letters."""
    fault, initial = divmod(kind, 4)
    found = []
    for state in STATES:
        edits = [("D", DELETE, state)]
        if fault in (SOUND, CUT):
            extra = TRUNCATED if fault == CUT else 0
            if initial == 0 and state == START:
                edits.append(("K", KEEP + extra, SYSTEM))
            elif initial == (2 if NEXT[state] == ASSISTANT else 1):
                edits.append(("K", KEEP + extra, NEXT[state]))
            edits.append(("R", REROLE + extra, NEXT[state]))
        found.append(edits)
    return found


EDITS = [_edits(k) for k in range(16)]


def with_inserts(costs: Sequence[float]) -> tuple[float, ...]:
    """The costs at a boundary where rows may be inserted first."""
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    return (
        min(costs[START], INSERT + user),
        min(costs[SYSTEM], INSERT + user),
        user,
        min(costs[ASSISTANT], INSERT + costs[USER]),
    )


def before(kind: int, after: Sequence[float]) -> tuple[float, ...]:
    """The costs before a row from those behind it."""
    return with_inserts([min(cost + after[to] for _, cost, to in edits) for edits in EDITS[kind]])


def backward(kinds: bytes, end: Sequence[float]) -> tuple[float, ...]:
    """The costs before all rows from those behind the last one."""
    costs = tuple(end)
    for k in reversed(kinds):
        costs = before(k, costs)
    return costs


def walk(kinds: bytes, end: Sequence[float], state: int = START, last: bool = True) -> tuple[str, int]:
    """Letters of the cheapest edits from a state, the first in ASCII among them, and the state behind them.

    ``end`` are the costs behind the last row; ``last`` says whether inserts behind it belong here.
    """
    apart = math.isqrt(len(kinds)) + 1
    kept = {len(kinds): tuple(end)}
    costs = tuple(end)
    for i in range(len(kinds) - 1, -1, -1):
        costs = before(kinds[i], costs)
        if i % apart == 0:
            kept[i] = costs
    letters = []
    for first in range(0, len(kinds), apart):
        stop = min(first + apart, len(kinds))
        vectors = [kept[stop]]
        for i in range(stop - 1, first - 1, -1):
            vectors.append(before(kinds[i], vectors[-1]))
        vectors.reverse()
        for i in range(first, stop):
            here, after = vectors[i - first], vectors[i - first + 1]
            done = False
            while not done:
                for letter, cost, to in EDITS[kinds[i]][state]:
                    if letter > "I" and here[state] == INSERT + here[NEXT[state]]:
                        break
                    if here[state] == cost + after[to]:
                        letters.append(letter)
                        state, done = to, True
                        break
                if not done:
                    letters.append("I")
                    state = NEXT[state]
    while last and end[state] != FINAL[state]:
        letters.append("I")
        state = NEXT[state]
    return "".join(letters), state


def repair(kinds: bytes) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a whole conversation."""
    end = with_inserts(FINAL)
    return int(backward(kinds, end)[START]), walk(kinds, end)[0]


def repaired(letters: str, roles: Sequence[str], texts: Sequence[str], state: int) -> tuple[list[tuple[str, str]], int]:
    """The (role, text) rows that the edits make of the rows, and the state behind them."""
    rows, i = [], 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            rows.append((ROLES[state], ""))
            continue
        if letter != "D":
            state = SYSTEM if letter == "K" and roles[i][:1] == "s" else NEXT[state]
            rows.append((roles[i] if letter == "K" else ROLES[state], texts[i]))
        i += 1
    return rows, state


def _fault(text: str, seen: bool) -> int:
    end = text.rstrip(_SPACE)[-1:]
    return BLANK if not end else DUPLICATE if seen else SOUND if end in ".!?" else CUT


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def kinds_of(roles: Sequence[str], texts: Sequence[str], earlier: Sequence[bytes] = ()) -> bytes:
    """The kinds of a conversation's rows; ``earlier`` are digests of rows before them."""
    seen, found = set(earlier), bytearray()
    for role, text in zip(roles, texts):
        digest = _digest(role, text)
        found.append(kind(role, _fault(text, digest in seen)))
        seen.add(digest)
    return bytes(found)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows with a few faults put in by the checksum of conversation and turn; ``copies`` 0 marks a dropped row."""
    key = F.concat_ws(":", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (conv_col, turn_col)])
    fate = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (
        rows.withColumn("copies", F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))
        .withColumn("role", F.when(fate == 4, "user").otherwise(role))
        .withColumn("text", F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
    )


_BLOCK = (
    "place bigint, first_turn bigint, last_turn bigint, turns bigint, illegal bigint, roles array<string>, texts array<string>"
)


class _Block:
    """Rows of one conversation that lie together in a partition."""

    def __init__(self, conv):
        self.conv, self.roles, self.texts, self.size = conv, [], [], 0
        self.first = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            if self.roles and self.roles[-1][:1] + role[:1] not in _LEGAL:
                self.illegal += 1
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(role) + len(text)
        if copies and turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1

    def row(self, place: int) -> dict:
        return {
            "conv": self.conv, "place": place, "first_turn": self.first, "last_turn": self.last, "turns": self.turns,
            "illegal": self.illegal, "roles": self.roles, "texts": self.texts,
        }


def _pack(schema: pa.Schema, block_rows: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        block, done, size = None, [], 0
        for batch in batches:
            for conv, turn, role, text, copies in zip(*[c.to_pylist() for c in batch.columns]):
                full = block and (len(block.roles) >= block_rows or block.size >= block_bytes)
                if block is None or full or conv != block.conv:
                    if block:
                        done.append(block.row(place))
                        size += block.size
                        place += 1
                    if len(done) >= BATCH_BLOCKS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done, size = [], 0
                    block = _Block(conv)
                block.add(turn, role, text, copies)
        if block:
            done.append(block.row(place))
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _blocks(rows: DataFrame, conv: T.StructField, block_rows: int, block_bytes: int) -> DataFrame:
    """All rows in order, packed and stored."""
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession, "conversation-blocks")
    order = ["conv", "turn", "role", "digest", "id"]
    keyed = rows.withColumn("digest", F.xxhash64("text")).withColumn("id", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "copies")
    schema = T.StructType([conv, *T.StructType.fromDDL(_BLOCK).fields])
    packed = dealt.mapInArrow(_pack(_arrow(schema), block_rows, block_bytes), schema)
    packed.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class _Whole:
    """A conversation's result, from its blocks in order."""

    def __init__(self, conv):
        self.conv, self.first, self.last, self.turns = conv, None, None, 0
        self.faults, self.illegal, self.role = [0] * 4, 0, None
        self.cost, self.letters, self.hash, self.any = 0, [], hashlib.sha256(), False

    def add(self, block: dict, letters: str, faults: Sequence[int], first: str | None, last: str | None, lines: bytes) -> None:
        if block["first_turn"] is not None:
            self.turns += block["turns"] - (self.last == block["first_turn"])
            self.first = block["first_turn"] if self.first is None else self.first
            self.last = block["last_turn"]
        self.faults = [a + b for a, b in zip(self.faults, faults)]
        if first is not None:
            self.illegal += block["illegal"] + (self.role is not None and self.role + first not in _LEGAL)
            self.role = last
        self.letters.append(letters)
        if lines:
            self.hash.update(b"\n" + lines if self.any else lines)
            self.any = True

    def row(self) -> dict:
        letters = "".join(self.letters)
        return {
            "conv": self.conv, "gaps": 0 if self.first is None else self.last - self.first + 1 - self.turns,
            "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT],
            "illegal": self.illegal, "cost": self.cost, "audit": letters, "repaired_sha256": self.hash.hexdigest(),
        }


def _lines(rows: list[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in rows).encode("utf-8", "surrogatepass")


def _faults(kinds: bytes) -> list[int]:
    counts = [0] * 4
    for k in kinds:
        counts[k >> 2] += 1
    return counts


_RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def _repair_blocks(schema: pa.Schema):
    """Conversations of one block each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = with_inserts(FINAL)
        for batch in batches:
            done = []
            for block in batch.to_pylist():
                whole, roles, texts = _Whole(block["conv"]), block["roles"], block["texts"]
                kinds = kinds_of(roles, texts)
                letters, _ = walk(kinds, end)
                whole.cost = int(backward(kinds, end)[START])
                initials = (roles[0][:1], roles[-1][:1]) if roles else (None, None)
                whole.add(block, letters, _faults(kinds), *initials, _lines(repaired(letters, roles, texts, START)[0]))
                done.append(whole.row())
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Rows sorted by conversation, each with whether it opens one."""
    conv, begun = None, False
    for batch in batches:
        for row in batch.to_pylist():
            opens = not begun or row["conv"] != conv
            conv, begun = row["conv"], True
            yield opens, row


def _compose_ends(schema: pa.Schema):
    """From the blocks' matrices, last block first, the costs behind every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, done = None, []
        for opens, row in _by_conversation(batches):
            costs = with_inserts(FINAL) if opens else costs
            last, behind = opens, costs
            matrix = row["matrix"]
            costs = tuple(min(matrix[4 * s + k] + behind[k] for k in STATES) for s in STATES)
            done.append({"conv": row["conv"], "place": row["place"], "ends": list(behind), "begins": list(costs), "last": last})
            if len(done) >= BATCH_BLOCKS:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _compose_states(schema: pa.Schema):
    """From the states behind every block for each state before it, the state before every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = START, []
        for opens, row in _by_conversation(batches):
            state = START if opens else state
            done.append({"conv": row["conv"], "place": row["place"], "state": state})
            state = row["exits"][state]
            if len(done) >= BATCH_BLOCKS:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def _mapped(rows: DataFrame, conv: T.StructField, fields: str, made) -> DataFrame:
    """``made(row)`` of every row, a few rows at a time."""
    schema = T.StructType([conv, *T.StructType.fromDDL(fields).fields])
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 8):
                yield pa.RecordBatch.from_pylist([made(row) for row in batch.slice(start, 8).to_pylist()], arrow)

    return rows.mapInArrow(run, schema)


def _streamed(rows: DataFrame, conv: T.StructField, fields: str, fold, backwards: bool = False) -> DataFrame:
    """``fold`` over the rows of each conversation in the order of their blocks."""
    schema = T.StructType([conv, *T.StructType.fromDDL(fields).fields])
    place = F.col("place").desc() if backwards else F.col("place")
    return rows.repartition("conv").sortWithinPartitions("conv", place).mapInArrow(fold(_arrow(schema)), schema)


def _matrix(row: dict) -> dict:
    unit = [[0 if k == j else math.inf for k in STATES] for j in STATES]
    columns = [backward(row["kinds"], e) for e in unit]
    return {"conv": row["conv"], "place": row["place"], "matrix": [float(columns[k][s]) for s in STATES for k in STATES]}


def _exits(row: dict) -> dict:
    exits = [walk(row["kinds"], row["ends"], s, last=False)[1] if math.isfinite(row["begins"][s]) else s for s in STATES]
    return {"conv": row["conv"], "place": row["place"], "exits": exits}


def _piece(row: dict) -> dict:
    letters, _ = walk(row["kinds"], row["ends"], row["state"], last=row["last"])
    lines = _lines(repaired(letters, row["roles"], row["texts"], row["state"])[0])
    first, last = (row["roles"][0][:1], row["roles"][-1][:1]) if row["roles"] else (None, None)
    cost = row["begins"][START]
    return {
        **{c: row[c] for c in ("conv", "place", "first_turn", "last_turn", "turns", "illegal")}, "cost": int(cost) if math.isfinite(cost) else 0,
        "letters": letters, "faults": _faults(row["kinds"]), "first": first, "last": last, "lines": lines,
    }


def _join_pieces(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for opens, row in _by_conversation(batches):
            if opens:
                if whole:
                    yield pa.RecordBatch.from_pylist([whole.row()], schema)
                whole = _Whole(row["conv"])
                whole.cost = row["cost"]
            whole.add(row, row["letters"], row["faults"], row["first"], row["last"], row["lines"])
        if whole:
            yield pa.RecordBatch.from_pylist([whole.row()], schema)

    return run


def _joined(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one block side by side."""
    b = b.withColumnRenamed("conv", "conv2__").withColumnRenamed("place", "place2__")
    both = a.join(b, a["conv"].eqNullSafe(b["conv2__"]) & (a["place"] == b["place2__"]), "left")
    return both.drop("conv2__", "place2__")


def _large(blocks: DataFrame, conv: T.StructField) -> DataFrame:
    """Results of conversations of several blocks."""
    spark = blocks.sparkSession

    def digests(row: dict) -> dict:
        found = {_digest(r, t) for r, t in zip(row["roles"], row["texts"])}
        return {"conv": row["conv"], "place": row["place"], "digests": sorted(found)}

    distinct = _mapped(blocks.select("conv", "place", "roles", "texts"), conv, "place bigint, digests array<binary>", digests)
    distinct = distinct.select("conv", "place", F.explode("digests").alias("digest"))
    firsts = distinct.groupBy("conv", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv").alias("conv2"), F.col("digest").alias("digest2"), "first")
    again = distinct.join(firsts, distinct["conv"].eqNullSafe(firsts["conv2"]) & (distinct["digest"] == firsts["digest2"]))
    again = again.filter(F.col("place") > F.col("first"))
    # a block has a bounded number of rows
    again = again.groupBy("conv", "place").agg(F.collect_list("digest").alias("earlier"))

    def kinds(row: dict) -> dict:
        found = kinds_of(row["roles"], row["texts"], row["earlier"] or ())
        return {"conv": row["conv"], "place": row["place"], "kinds": found}

    known = _mapped(_joined(blocks.select("conv", "place", "roles", "texts"), again), conv, "place bigint, kinds binary", kinds)
    path = shared_folder(spark, "conversation-kinds")
    known.write.parquet(path)
    known = spark.read.schema(known.schema).parquet(path)
    matrices = _mapped(known, conv, "place bigint, matrix array<double>", _matrix)
    planned = "place bigint, ends array<double>, begins array<double>, last boolean"
    ends = _joined(known, _streamed(matrices, conv, planned, _compose_ends, backwards=True))
    path = shared_folder(spark, "conversation-ends")
    ends.write.parquet(path)
    ends = spark.read.schema(ends.schema).parquet(path)
    exits = _mapped(ends, conv, "place bigint, exits array<int>", _exits)
    states = _streamed(exits, conv, "place bigint, state int", _compose_states)
    planned = _joined(_joined(blocks, ends), states)
    pieces = _mapped(
        planned, conv,
        "place bigint, first_turn bigint, last_turn bigint, turns bigint, illegal bigint, cost bigint, letters string, "
        "faults array<bigint>, first string, last string, lines binary", _piece,
    )
    return _streamed(pieces, conv, _RESULT, _join_pieces)


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    damage: bool = False,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each conversation: its faults, the cost and letters of its cheapest repair, and a digest of the result.

    Rows are taken by turn, nulls first, and those of one turn by role and a hash of the text. ``damage`` puts faults
    in first, as ``damaged`` says. The letters are K (keep), R (other role), D (delete) and I (insert).

    Defined cases: a null role or text is one space; such a role is only replaced or deleted, such a text is blank. A
    null conversation id is a conversation of its own. Repeated rows are duplicates. Roles are told by their first
    character, in its own case. Further columns are ignored; an empty table gives an empty result. A conversation
    without rows (all dropped) has zeros, no letters and the digest of the empty string.

    A conversation larger than ``block_rows`` or ``block_bytes``, or cut by a partition, is repaired in blocks. Only
    its letters and repaired bytes come together in one task, as one value and one checksum need.
    """
    named = rows.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    if damage:
        named = damaged(named, "conv", "turn")
    else:
        space = {c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")}
        named = named.withColumns({**space, "copies": F.lit(1)})
    conv = T.StructField("conv", named.schema["conv"].dataType)
    blocks = _blocks(named, conv, block_rows, block_bytes)
    several = blocks.groupBy("conv").count().filter("count > 1").select(F.col("conv").alias("several__"))
    # written, so that its size is known before it is broadcast
    path = shared_folder(rows.sparkSession, "large-conversations")
    several.write.parquet(path)
    several = broadcast_if_small(rows.sparkSession.read.schema(several.schema).parquet(path))
    whole = F.col("conv").eqNullSafe(F.col("several__"))
    schema = T.StructType([conv, *T.StructType.fromDDL(_RESULT).fields])
    small = blocks.join(several, whole, "left_anti").mapInArrow(_repair_blocks(_arrow(schema)), schema)
    large = _large(blocks.join(several, whole, "left_semi").select(*blocks.columns), conv)
    return small.unionByName(large).withColumnRenamed("conv", conv_col)
