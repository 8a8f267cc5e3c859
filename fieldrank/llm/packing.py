"""Token ids packed into fixed sequences, and their binary form.

Texts are encoded by a public byte-pair vocabulary (its path is a parameter; the
driver reads it and broadcasts it, and its size is checked). A document longer
than a sequence is split into pieces, none of whose tokens is lost. The pieces of
a shard are packed best-fit decreasing: longest first, each into the sequence
with the least room that still holds it, found by a search in a segment tree
over the room left. A shard is what one task holds at a time, ``SHARD_TOKENS``
tokens, so memory is bounded however large a partition is, and nothing shuffles.

Per sequence the result has the ids (padded to the sequence length), the
cumulative segment lengths and the position of each token in its segment, which
restarts at zero with every segment. ``matrices`` writes whole shards in binary.

Nulls and empty texts have no tokens and are in no sequence. A null id stays
null. Repeated rows are packed each for itself. An empty table gives no rows.
Only the named columns are read; others may have any name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldrank.llm.common import picked, slices

# The file of the vocabulary, and how it cuts text into pieces.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# An id that the vocabulary does not use, in unused places of a sequence.
PAD = 50_256

LENGTH = 2048
SHARD_TOKENS = 1 << 20

# Largest vocabulary file that is broadcast.
VOCABULARY_BYTES = 64 * 1024 * 1024

_encodings: dict[str, object] = {}


def broadcast_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as file:
        data = file.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast((path, data))


def encoding(path: str, data: bytes):
    """The tokenizer, built once per Python worker."""
    import tiktoken

    if path not in _encodings:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        _encodings[path] = tiktoken.Encoding(
            "given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[path]


# Longer texts are encoded in parts of at least so many characters.
_PART = 1 << 16
# Unicode white space, as the tokenizer's pattern means it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = regex.compile(
    PATTERN.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")
)


def parts_of(text: str, most: int = _PART) -> Iterator[str]:
    """A text in parts, cut only where the pattern ends a piece that is no white space.

    Pieces are encoded each for itself, and only white space looks at what follows it,
    so the parts have the ids of the whole text. A single piece of more than ``most``
    characters is cut inside.
    """
    if len(text) <= most:
        yield text
        return
    start = end = 0
    for piece in _PIECE.finditer(text):
        if piece.end() - start > most and end > start:
            yield text[start:end]
            start = end
        while piece.end() - piece.start() > most and piece.end() - start > most:
            yield text[start:start + most]
            start += most
        if not text[piece.end() - 1].isspace():
            end = piece.end()
    yield text[start:]


def encoder(path: str, data: bytes):
    """Turns a text into an array of token ids."""
    tokenizer = encoding(path, data)

    def encode(text: str) -> np.ndarray:
        return np.concatenate([
            tokenizer.encode_to_numpy(part, disallowed_special=()) for part in parts_of(text)
        ])

    return encode


class Capacities:
    """A segment tree that counts open sequences by the room they have left."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The open sequence with the least room of at least ``size``, and that room."""
        room = self._first_from(size)
        if room is None:
            return None
        self._change(room, -1)
        return self.open[room].pop(), room

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += by
            node //= 2

    def _first_from(self, size: int) -> int | None:
        node = size + self.leaves
        # Up until a subtree to the right has a count, then down to its first leaf.
        while not self.counts[node]:
            while node & 1:
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not self.counts[node]:
                node += 1
        return node - self.leaves


def pieces_of(lengths: np.ndarray, length: int) -> np.ndarray:
    """(document, first token, size) of each piece; only the last may be short."""
    counts = -(-lengths // length)
    document = np.repeat(np.arange(len(lengths)), counts)
    first = (np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts)) * length
    return np.stack((document, first, np.minimum(lengths[document] - first, length)), axis=1)


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Sequences of piece numbers, best-fit decreasing; equal sizes in given order."""
    rooms, packed = Capacities(length), []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        found = rooms.take(size)
        if found is None:
            packed.append([piece])
            left = length - size
            sequence = len(packed) - 1
        else:
            sequence, room = found
            packed[sequence].append(piece)
            left = room - size
        if left:
            rooms.add(left, sequence)
    return packed


@dataclass
class Sequences:
    """Packed ids, one row per sequence, with the segments in each."""

    ids: np.ndarray
    ends: list[np.ndarray]
    segments: list[list[tuple[int, int, int]]]

    def positions(self) -> np.ndarray:
        """Each token's place in its segment; zero in the padding."""
        out = np.zeros(self.ids.shape, dtype=np.int32)
        for row, ends in zip(out, self.ends):
            for start, end in zip(ends[:-1], ends[1:]):
                row[start:end] = np.arange(end - start)
        return out


def pack(tokens: list[np.ndarray], length: int, pad: int = PAD) -> Sequences:
    """Pack documents of token ids; ``segments`` name (document, first token, size)."""
    pieces = pieces_of(np.array([len(t) for t in tokens], dtype=np.int64), length)
    plan = best_fit(pieces[:, 2], length)
    ids = np.full((len(plan), length), pad, dtype=np.int32)
    ends, segments = [], []
    for row, sequence in zip(ids, plan):
        held = [tuple(pieces[p].tolist()) for p in sequence]
        at = np.cumsum([0, *[size for _, _, size in held]])
        for (document, first, size), start in zip(held, at):
            row[start:start + size] = tokens[document][first:first + size]
        ends.append(at)
        segments.append(held)
    return Sequences(ids, ends, segments)


def _shards(batches: Iterator[pa.RecordBatch], encode, most: int):
    """Ids and tokens of documents, cut into shards of about ``most`` tokens."""
    names, tokens, held = [], [], 0
    parts = (part for batch in batches for part in slices(batch, batch.column("text")))
    for part, texts in parts:
        for name, text in zip(part.column("doc_id").to_pylist(), texts):
            if not text:
                continue
            found = encode(text.decode())
            names.append(name)
            tokens.append(found)
            held += len(found)
            if held >= most:
                yield names, tokens
                names, tokens, held = [], [], 0
    if held:
        yield names, tokens


def _packed_by_task(docs: DataFrame, doc_id: str, text: str, vocabulary: str, length: int,
                    shard_tokens: int, schema: str, rows_of) -> DataFrame:
    shared = broadcast_vocabulary(docs.sparkSession, vocabulary)
    rows = picked(docs, doc_id=doc_id, text=text)
    ids = pa.list_(to_arrow_type(rows.schema["doc_id"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        shards = _shards(batches, encoder(*shared.value), shard_tokens)
        for i, (names, tokens) in enumerate(shards):
            yield from rows_of(f"{task:06d}-{i:04d}", names, pack(tokens, length), ids)

    return rows.mapInArrow(run, schema.format(id=rows.schema["doc_id"].dataType.simpleString()))


_SEQUENCES = (
    "shard string, sequence int, n_tokens int, doc_ids array<{id}>, first_tokens array<int>, "
    "cu_seqlens array<int>, position_resets array<int>, ids binary"
)


def _sequence_rows(shard: str, names: list, packed: Sequences, kind: pa.DataType, step: int = 1024):
    for low in range(0, len(packed.ids), step):
        part = range(low, min(low + step, len(packed.ids)))
        held = [packed.segments[i] for i in part]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(part)),
                pa.array(part, pa.int32()),
                pa.array([int(packed.ends[i][-1]) for i in part], pa.int32()),
                pa.array([[names[d] for d, _, _ in s] for s in held], kind),
                pa.array([[first for _, first, _ in s] for s in held], pa.list_(pa.int32())),
                pa.array([packed.ends[i].tolist() for i in part], pa.list_(pa.int32())),
                pa.array([packed.ends[i][:-1].tolist() for i in part], pa.list_(pa.int32())),
                pa.array([packed.ids[i].astype("<u4").tobytes() for i in part], pa.binary()),
            ],
            names=[c.split()[0] for c in _SEQUENCES.split(", ")],
        )


def packed_sequences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     vocabulary: str = VOCABULARY, length: int = LENGTH,
                     shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per sequence.

    ``ids`` are little-endian 32-bit numbers. ``doc_ids`` and ``first_tokens`` name
    the segments; ``cu_seqlens`` has their cumulative lengths from zero, and
    positions restart at ``position_resets``.
    """
    return _packed_by_task(
        docs, doc_id, text, vocabulary, length, shard_tokens, _SEQUENCES, _sequence_rows
    )


_MATRICES = (
    "shard string, n_sequences int, length int, ids binary, positions binary, cu_seqlens binary, "
    "segments binary, doc_ids array<{id}>"
)


def _matrix_rows(shard: str, names: list, packed: Sequences, kind: pa.DataType):
    segments = [(names[d], first) for held in packed.segments for d, first, _ in held]
    counts = np.array([len(e) for e in packed.ends], dtype="<i4")
    binary = [
        packed.ids.astype("<i4").tobytes(), packed.positions().astype("<i4").tobytes(),
        np.concatenate(packed.ends).astype("<i4").tobytes(), counts.tobytes(),
    ]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([shard]), pa.array([len(packed.ids)], pa.int32()),
            pa.array([packed.ids.shape[1]], pa.int32()), *[pa.array([b], pa.binary()) for b in binary],
            pa.array([[name for name, _ in segments]], kind),
        ],
        names=[c.split()[0] for c in _MATRICES.split(", ")],
    )


def write_matrices(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                   vocabulary: str = VOCABULARY, length: int = LENGTH,
                   shard_tokens: int = SHARD_TOKENS) -> None:
    """One row per shard: little-endian 32-bit matrices of ids and positions, the
    cumulative lengths of all sequences behind each other, and how many each has."""
    _packed_by_task(
        docs, doc_id, text, vocabulary, length, shard_tokens, _MATRICES, _matrix_rows
    ).write.parquet(path)


def read_matrix(row) -> Sequences:
    """The sequences of a row written by ``write_matrices``; segments are (document, 0, size)."""
    ids = np.frombuffer(row.ids, dtype="<i4").reshape(row.n_sequences, row.length)
    counts = np.frombuffer(row.segments, dtype="<i4")
    ends = np.split(np.frombuffer(row.cu_seqlens, dtype="<i4"), np.cumsum(counts)[:-1])
    names, segments = iter(row.doc_ids), []
    for end in ends:
        segments.append([(next(names), 0, int(n)) for n in np.diff(end)])
    return Sequences(ids, ends, segments)


def token_count(packed: DataFrame) -> DataFrame:
    """Tokens and sequences of each shard."""
    return packed.groupBy("shard").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_sequences")
    )
