"""Benchmark decontamination with an FM-index per shard of training text.

Words are ``[0-9a-z]`` and all non-ASCII characters in a row, A-Z lower-cased.
A window is ``width`` consecutive words of a benchmark item (an item of fewer
words is one window). Each batch of documents that a task reads is a shard: its
words, numbered by the benchmark's vocabulary, are indexed and all windows are
searched backwards in it; located occurrences are merged into spans.

Only runs of words that the benchmark knows, as long as its shortest window, can
hold an occurrence, so only these runs enter the index. Longer sequences than
``SHARD`` are indexed in pieces that overlap by a window less one word.

The benchmark is read in blocks of a bounded size, each broadcast; with more
than one block the documents pass through one map per block. Nothing shuffles.

Nulls: a null text has no words and no spans; a null item text has no windows;
items without an id are one item with the empty id. Repeated rows, of items as
of documents, count for themselves but change nothing. Empty tables give no
rows, or no hits. Very long texts are searched whole. Added columns stand beside
the document, packed in a struct, so no name can clash.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.llm.common import WORD_BYTES, picked, unpacked, whole, with_columns_of_text
from fieldrank.llm.fm_index import FMIndex

WIDTH = 13

# A document is contaminated when this share of its words, or more, is hit.
SHARE = 20

# Bytes of benchmark text in one block, which every worker holds.
BLOCK_BYTES = 16 * 1024 * 1024

# Words in one index.
SHARD = 1_000_000

_SPAN = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])
FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Windows:
    """The windows of benchmark items, as rows of word numbers by length.

    Word number 1 stands for every word that no item has.
    """

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, text in items:
            numbers = tuple(
                self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in words_of(text)
            )
            for i in range(max(1, len(numbers) - width + 1)):
                if numbers:
                    owners[numbers[i:i + width]].add(name)
        lengths: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for window in owners:
            lengths[len(window)].append(window)
        self.patterns = {n: np.array(rows, dtype=np.int64) for n, rows in lengths.items()}
        self.owners = {n: [sorted(owners[row]) for row in rows] for n, rows in lengths.items()}
        self.shortest = min(lengths, default=0)
        self.longest = max(lengths, default=0)
        self.alphabet = len(self.vocabulary) + 2


class Scanner:
    """Finds the windows in batches of documents."""

    def __init__(self, windows: Windows, shard: int = SHARD):
        self.windows, self.shard = windows, shard

    def runs(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """Runs of known words that are as long as the shortest window."""
        known = np.concatenate(([False], numbers > 1, [False]))
        edges = np.flatnonzero(known[1:] != known[:-1])
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.windows.shortest
        return list(zip(starts[long].tolist(), ends[long].tolist()))

    def search(self, pieces: list[tuple[int, int, np.ndarray]], hits, items) -> None:
        """Index (document, first word, word numbers) pieces and collect what is found."""
        stop = np.ones(1, dtype=np.int64)
        symbols = np.concatenate([part for _, _, p in pieces for part in (p, stop)])
        sizes = np.array([len(p) + 1 for _, _, p in pieces])
        starts = np.cumsum(sizes) - sizes
        documents = np.array([d for d, _, _ in pieces])
        firsts = np.array([first for _, first, _ in pieces])
        index = FMIndex(symbols, self.windows.alphabet)
        for length, patterns in self.windows.patterns.items():
            which, at = index.occurrences(patterns)
            if len(at) == 0:
                continue
            piece = np.searchsorted(starts, at, side="right") - 1
            word = firsts[piece] + at - starts[piece]
            found = documents[piece]
            order = np.lexsort((word, found))
            cuts = np.flatnonzero(np.diff(found[order])) + 1
            for group in np.split(order, cuts):
                document = int(found[group[0]])
                hits[document].append(np.stack((word[group], word[group] + length)))
                for row in np.unique(which[group]).tolist():
                    items[document].update(self.windows.owners[length][row])

    def __call__(self, texts: list[bytes | None]):
        """Per document its words, merged spans [start, end) and item names."""
        hits, items = defaultdict(list), defaultdict(set)
        lookup, overlap = self.windows.vocabulary.get, self.windows.longest - 1
        counts, pieces, waiting = [], [], 0
        for document, text in enumerate(texts):
            words = words_of(text)
            counts.append(len(words))
            if not self.windows.longest or not words:
                continue
            numbers = np.fromiter(map(lookup, words, repeat(1)), dtype=np.int64, count=len(words))
            for start, end in self.runs(numbers):
                while True:
                    stop = min(end, start + self.shard + overlap)
                    pieces.append((document, start, numbers[start:stop]))
                    waiting += stop - start
                    if waiting >= self.shard:
                        self.search(pieces, hits, items)
                        pieces, waiting = [], 0
                    if stop == end:
                        break
                    start = stop - overlap
        if pieces:
            self.search(pieces, hits, items)
        return counts, {d: merged(np.hstack(found)) for d, found in hits.items()}, items


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Union of [start, end) spans, given as two rows; touching spans join."""
    starts, ends = spans[:, np.argsort(spans[0], kind="stable")]
    reach = np.maximum.accumulate(ends)
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))
    return list(zip(starts[new].tolist(), reach[last].tolist()))


def benchmark_blocks(
    benchmark: DataFrame, item_id: str, text: str, block_bytes: int
) -> list[list[tuple[str, bytes]]]:
    """Distinct items, dealt by hash into blocks of about ``block_bytes``."""
    named = F.coalesce(F.col("item").cast("string"), F.lit(""))
    items = picked(benchmark, item=item_id, text=text).where(F.col("text").isNotNull())
    items = items.select(named.alias("item"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text").cast("long") + 16)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [
        [(row.item, row.text.encode()) for row in items.where(block == i).collect()]
        for i in range(n)
    ]


_built: dict[str, Windows] = {}


def _windows(shared: Broadcast, width: int) -> Windows:
    """Built once per Python worker; only the latest blocks are kept."""
    name, items = shared.value
    if name not in _built:
        if len(_built) >= 4:
            _built.clear()
        _built[name] = Windows(items, width)
    return _built[name]


def scanned(
    packed: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows packed by ``whole`` with ``n_words``, ``spans`` and ``items``.

    ``spans`` are merged [start, end) word ranges to remove; ``items`` are the
    names of the items found, sorted. ``keep`` are the fields of ``doc`` to return.
    """
    spark: SparkSession = packed.sparkSession
    names = packed.schema["doc"].dataType.fieldNames()
    blocks = benchmark_blocks(benchmark, item_id, item_text, block_bytes)
    for i, block in enumerate(blocks):
        shared, first = spark.sparkContext.broadcast((uuid.uuid4().hex, block)), i == 0

        def make(shared=shared):
            scanner = Scanner(_windows(shared, width))

            def function(texts):
                counts, spans, items = scanner(texts)
                order = range(len(texts))
                return [
                    pa.array(counts, pa.int64()),
                    pa.array(
                        [[{"start": a, "end": b} for a, b in spans.get(d, ())] for d in order],
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                    ),
                    pa.array([sorted(items.get(d, ())) for d in order], pa.list_(pa.string())),
                ]

            return function

        added = FOUND if first else [T.StructField(f"_{f.name}", f.dataType) for f in FOUND]
        last = i == len(blocks) - 1
        packed = with_columns_of_text(packed, text, make, added, keep if keep and last else names)
        if not first:
            packed = (
                packed.withColumn("spans", union_of_spans(F.concat("spans", "_spans")))
                .withColumn("items", F.array_sort(F.array_union("items", "_items")))
                .drop(*[f"_{f.name}" for f in FOUND])
            )
    return packed


def union_of_spans(spans):
    """Merge overlapping and touching spans of an array."""
    empty = F.array().cast(T.ArrayType(_SPAN))

    def add(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["start"] <= F.coalesce(last["end"], F.lit(-1)))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        before = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(joins, F.concat(before, F.array(wider))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(share: int = SHARE):
    hit = n_hit()
    return (hit > 0) & (share * hit >= F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                  text: str = "text", **options) -> DataFrame:
    """One row per document: how much of it the benchmark's windows hit."""
    packed = whole(picked(docs, doc_id=doc_id, text=text))
    found = scanned(packed, benchmark, "text", keep=["doc_id"], **options)
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"), "spans",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                         **options) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    found = scanned(whole(docs), benchmark, text, **options)
    return unpacked(found.where(~contaminated()))


def without_spans(texts: str, spans: list[tuple[int, int]]) -> str:
    """A text less its hit words; what separates the words left stays."""
    data = texts.encode()
    plain = np.frombuffer(data.translate(WORD_BYTES), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], plain, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    keep = np.ones(len(data), dtype=bool)
    for start, end in spans:
        keep[starts[start]:ends[end - 1]] = False
    return np.frombuffer(data, dtype=np.uint8)[keep].tobytes().decode()


def cleaned(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents with their text less the merged spans, as ``doc`` and ``cleaned_text``."""
    found = scanned(whole(docs), benchmark, text, **options)

    @F.pandas_udf("string")
    def remove(texts, spans):
        return texts.combine(spans, lambda t, s: t if t is None or not len(s) else without_spans(
            t, [(x["start"], x["end"]) for x in s]
        ))

    return found.withColumn("cleaned_text", remove(F.col("doc").getField(text), F.col("spans")))

