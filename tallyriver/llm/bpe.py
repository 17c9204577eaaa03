"""Byte-level BPE through a sentencepiece model written directly from a rank file.

Every byte is mapped to one printable character, so each token of the vocabulary is a piece of plain text. A BPE
model whose pieces score minus their rank, with a normaliser that changes nothing, merges pairs in rank order as the
rank file's own library does. The model is serialised here field by field; nothing is trained.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyriver.llm.text import renamed, small_batches

CACHED_WORDS = 200_000
#: Added after the vocabulary, as the library wants one; no byte-mapped text can hold it.
UNKNOWN = "<unknown>"


def byte_characters() -> str:
    """The character that stands for each byte: itself if it is printable Latin-1, else the next one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in printable else chr(next(spare)) for b in range(256))


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError(f"the ranks of {path} are not 0 to {len(tokens) - 1}")
    return [tokens[rank] for rank in range(len(tokens))]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model: a token's id is its rank, its score minus its rank."""
    # Field numbers and enumerations of the sentencepiece model format.
    pieces, trainer, normaliser = 1, 2, 3
    piece_text, piece_score, piece_kind, kind_normal, kind_unknown = 1, 2, 3, 1, 2
    model_type, model_bpe, vocabulary_size, unknown_id = 3, 2, 4, 40
    name, dummy_prefix, remove_spaces, escape_spaces = 1, 3, 4, 5

    table = byte_characters()
    out = bytearray()
    for rank, token in enumerate([*tokens, None]):
        text = UNKNOWN if token is None else "".join(table[b] for b in token)
        score = _varint(piece_score << 3 | 5) + struct.pack("<f", -float(rank))
        kind = _number(piece_kind, kind_unknown if token is None else kind_normal)
        out += _block(pieces, _block(piece_text, text.encode()) + score + kind)
    out += _block(
        trainer,
        _number(model_type, model_bpe) + _number(vocabulary_size, len(tokens) + 1) + _number(unknown_id, len(tokens)),
    )
    out += _block(
        normaliser,
        _block(name, b"identity") + _number(dummy_prefix, 0) + _number(remove_spaces, 0) + _number(escape_spaces, 0),
    )
    return bytes(out)


def joined(tokens: list[bytes], ids: bytes) -> bytes:
    """The bytes of packed ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Codec:
    """Encodes texts to packed little-endian 32-bit ids and back; one for each task."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens, self.ranks = tokens, {token: rank for rank, token in enumerate(tokens)}
        self.table = {byte: char for byte, char in enumerate(byte_characters())}
        self.split = regex.compile(pattern).findall
        # the ids of words met lately, in two generations of a bounded size
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        rest = []
        for word in words.difference(self.known):
            # a word that is a token stays whole, whatever merges would make of it
            rank = self.ranks.get(word.encode())
            ids = self.older.get(word) if rank is None else rank.to_bytes(4, "little")
            if ids is None:
                rest.append(word)
            else:
                self.known[word] = ids
        mapped = [word.encode().decode("latin-1").translate(self.table) for word in rest]
        for word, ids in zip(rest, self.pieces.encode(mapped, num_threads=1) if rest else []):
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        words = self.split(text)
        self._learn(set(words))
        return b"".join(map(self.known.__getitem__, words))

    def decode(self, ids: bytes) -> bytes:
        return joined(self.tokens, ids)


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """Every document's ``doc_id``, ``n_tokens`` and ``ids``, packed as little-endian unsigned 32-bit integers.

    ``path`` is a rank file that the driver can read; ``pattern`` cuts a text into the words that are encoded one by
    one. Special tokens are not recognised. ``decoded`` adds what ``decode`` makes of the ids, in the same task.
    Defined cases: a null or empty text has no tokens; ids that are null or repeated come back as they are; further
    columns are ignored; an empty table gives an empty result.
    """
    tokens = read_ranks(path)
    # bounded by the vocabulary file
    parts = docs.sparkSession.sparkContext.broadcast((model_bytes(tokens), tokens, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*parts.value)
        for batch in small_batches(batches):
            ids = [codec.encode(text.as_py() or "") for text in batch.column("text")]
            columns = [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([codec.decode(i) for i in ids], pa.binary()))
            yield pa.record_batch(columns, names=["doc_id", "n_tokens", "ids", "decoded"][: len(columns)])

    source = renamed(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    fields = "doc_id bigint, n_tokens bigint, ids binary"
    return source.mapInArrow(run, f"{fields}, decoded binary" if decoded else fields)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encode``'s result with a further column ``decoded``: the text's bytes (null ids: no bytes)."""
    # a token's bytes are its piece's characters mapped back; bounded by the vocabulary file
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.value
        for batch in small_batches(batches):
            decoded = [joined(known, ids.as_py() or b"") for ids in batch.column("ids")]
            yield pa.record_batch([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"])

    kept = encoded.select("doc_id", "n_tokens", "ids")
    return kept.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """SHA-256 of the packed ids and of the decoded bytes."""
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
