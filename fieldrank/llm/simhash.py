"""Near-duplicates by SimHash, found with pigeonhole blocks.

A fingerprint has 64 bits, the majority bits of the XXH64 hashes of all word
shingles. Two fingerprints that differ in at most ``distance`` bits agree in one
of ``distance + 1`` blocks of bits, so fingerprints meet by block value and are
then compared. Equal fingerprints are one row from the start, whatever their
number of documents. A block value with more fingerprints than ``BUCKET`` is first
linked to the one with the most documents; if most of it is not close to that, it
is cut again by blocks of the remaining bits (the same argument holds inside it),
and what is left to compare is compared in groups of bounded size. So no task ever
holds a large group and no link is lost. Within a group each fingerprint found
leaves the search, so n close ones cost n steps and give n - 1 links, never all
pairs.

Nulls and empty texts have no words and fingerprint zero, which is linked like
any other. A null id is never a component's id unless all its ids are null.
Repeated rows are documents like any other. An empty table gives no rows. Texts
are hashed whole. Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.llm.common import (
    LOWER_BYTES, join_measured, picked, unpacked, whole, with_columns_of_text,
)
from fieldrank.llm.components import components
from fieldrank.materialise import Stored, materialise

WORDS = 4
DISTANCE = 4
SEED = 42

# Most fingerprints that are compared within one bucket.
BUCKET = 8192

# Shingle hashes whose bits are counted at once.
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The SimHash of a text as an unsigned number; zero without words."""
    split = text.translate(LOWER_BYTES).split() if text else []
    if not split:
        return 0
    flat = b" ".join(split)
    if len(split) <= words:
        return xxhash.xxh64_intdigest(flat, SEED)
    ends = np.cumsum(np.fromiter(map(len, split), dtype=np.int64, count=len(split)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:len(split) - words + 1].tolist(), ends[words - 1:].tolist())
    hashes = np.array([digest(flat[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(packed: DataFrame, text: str, keep: list[str], words: int = WORDS) -> DataFrame:
    """Rows packed by ``whole`` with ``fingerprint``, the 64 bits as a long."""
    def make():
        def function(texts):
            numbers = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
            return [pa.array(numbers.view(np.int64))]

        return function

    added = [T.StructField("fingerprint", T.LongType())]
    return with_columns_of_text(packed, text, make, added, keep)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _split(mask: int, parts: int) -> list[int]:
    """``mask`` with, each time, one of ``parts`` blocks of the other bits added."""
    free = [i for i in range(64) if not mask >> i & 1]
    blocks = np.array_split(np.array(free, dtype=np.int64), parts)
    return [mask | sum(1 << int(i) for i in block) for block in blocks]


def _bucketed(rows: DataFrame, masks: list[list[int]]) -> DataFrame:
    """Each row once per block of its path: ``path``, ``value``, ``fp`` and ``n``."""
    parts = len(masks[0])
    listed = F.array(*[
        F.array(*[F.lit(_signed(mask)).cast("long") for mask in group]) for group in masks
    ])
    group = F.element_at(listed, F.col("path") + 1)
    return rows.select("path", "fp", "n", F.posexplode(group).alias("_part", "_mask")).select(
        (F.col("path") * parts + F.col("_part")).alias("path"),
        F.col("fp").bitwiseAND(F.col("_mask")).alias("value"),
        "fp", "n",
    )


def near(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, int]]:
    """Positions linked to an earlier position, group by group: (members, first)."""
    rest = np.arange(len(fps))
    while len(rest) > 1:
        first, rest = int(rest[0]), rest[1:]
        queue = [first]
        while queue and len(rest):
            close = np.bitwise_count(fps[rest] ^ fps[queue.pop()]) <= distance
            if close.any():
                found = rest[close]
                yield found, first
                queue += found.tolist()
                rest = rest[~close]


def _links(keys: np.ndarray, fps: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links inside runs of equal keys, as two rows of fingerprints."""
    out = []
    cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
    sizes = np.diff(cuts)
    # Runs of up to eight: every pair, for all such runs at once.
    short = np.repeat(sizes <= 8, sizes)
    small_keys, small_fps = keys[short], fps[short]
    for step in range(1, 8):
        same = small_keys[step:] == small_keys[:-step]
        a, b = small_fps[step:][same], small_fps[:-step][same]
        close = np.bitwise_count(a ^ b) <= distance
        out.append(np.stack((a[close], b[close])))
    for i in np.flatnonzero(sizes > 8).tolist():
        run = fps[cuts[i]:cuts[i + 1]]
        for members, first in near(run, distance):
            out.append(np.stack((run[members], np.full(len(members), run[first]))))
    return out


def _linker(distance: int):
    """Finds links in batches that arrive sorted by key; a run may span batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.zeros(0, dtype=[(name, np.int64) for name in (*_ON, "a", "b")])
        fps = np.zeros(0, dtype=np.uint64)

        def result(keys, fps):
            links = np.hstack(_links(keys, fps, distance)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], names=["u", "v"])

        for batch in batches:
            more = np.empty(batch.num_rows, dtype=keys.dtype)
            for name in keys.dtype.names:
                more[name] = batch.column(name).to_numpy()
            keys = np.concatenate((keys, more))
            fps = np.concatenate((fps, batch.column("fp").to_numpy().view(np.uint64)))
            ends = np.flatnonzero(keys[1:] != keys[:-1])
            if len(ends):
                cut = ends[-1] + 1
                yield result(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield result(keys, fps)

    return run


_ON = ["path", "value"]


def links(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links ``u``, ``v`` that join all of the distinct fingerprints ``fp`` that reach
    each other. ``n`` is how many documents a fingerprint has."""
    blocks = _split(0, distance + 1)
    cut = _bucketed(fps.select(F.lit(0).alias("path"), "fp", "n"), [blocks])
    found, wide = _linked(cut, distance, bucket)
    if wide is not None:
        cut = _bucketed(wide, [_split(mask, distance + 1) for mask in blocks])
        found = found.union(_linked(cut, distance, bucket, last=True)[0])
    return found


def _compared(rows: DataFrame, distance: int) -> DataFrame:
    """Links inside each group of ``path``, ``value``, ``a`` and ``b``."""
    on = [*_ON, "a", "b"]
    placed = rows.select(*on, "fp").repartition(*on).sortWithinPartitions(*on)
    return placed.mapInArrow(_linker(distance), "u long, v long")


def _linked(
    cut: DataFrame, distance: int, bucket: int, last: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    """Links inside buckets, and the rows of buckets that are to be cut again.

    A large bucket is linked to its fingerprint with the most documents first.
    What is close to that needs no comparing among itself; only the rest is
    compared, with all of the bucket, in a grid of groups of bounded size.
    """
    whole_bucket = {"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long")}
    large = materialise(
        cut.groupBy(*_ON)
        .agg(F.count(F.lit(1)).alias("rows"), F.max(F.struct("n", "fp")).alias("most"))
        .where(F.col("rows") > bucket).select(*_ON, "rows", F.col("most.fp").alias("centre"))
    )
    if not large.rows:
        return _compared(cut.withColumns(whole_bucket), distance), None
    small = join_measured(cut, large, _ON, "left_anti").withColumns(whole_bucket)
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("centre")))
    held = materialise(
        join_measured(cut, large, _ON, "inner").withColumn("near", apart <= distance)
    ).df
    stars = held.where("near AND fp <> centre").select(
        F.col("fp").alias("u"), F.col("centre").alias("v")
    )
    rests = materialise(held.groupBy(*_ON).agg(F.count_if(~F.col("near")).alias("rest")))
    held = join_measured(held, rests, _ON, "inner")
    grid = held.where("rest > 0" if last else f"rest > 0 AND rest <= {bucket}")
    grid = grid.withColumns({
        "wide": F.ceil(F.col("rows") / bucket), "high": F.ceil(F.col("rest") / bucket),
    })

    def part(n):
        return F.pmod(F.xxhash64("fp"), F.col(n))

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    all_rows = grid.select(*_ON, part("wide").alias("a"), every("high").alias("b"), "fp")
    rest = grid.where("NOT near").select(*_ON, every("wide").alias("a"), part("high").alias("b"), "fp")
    groups = small.select(*_ON, "a", "b", "fp").union(all_rows).union(rest)
    found = _compared(groups, distance).union(stars)
    wide = None if last else held.where(F.col("rest") > bucket).select("path", "fp", "n")
    return found, wide


def _grouped(fps: DataFrame, first, distance: int, bucket: int) -> DataFrame:
    """``fp``, whether rows ``shared`` it or reach it, and ``least``, their smallest ``first``."""
    own = materialise(fps.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), first.alias("own")))
    reached = components(links(own.df, distance, bucket))
    centres = reached.df.select(F.col("u").alias("fp"), F.col("v").alias("centre")).union(
        reached.df.select(F.col("v").alias("fp"), F.col("v").alias("centre")).distinct()
    )
    linked = own.df.join(centres, "fp")
    least = linked.groupBy("centre").agg(F.min("own").alias("least"))
    linked = linked.join(least, "centre").select("fp", F.lit(True).alias("shared"), "least")
    # min() skips nulls, which are ids that cannot name a component.
    alone = own.df.join(centres, "fp", "left_anti")
    return linked.union(alone.select("fp", F.col("n") > 1, F.col("own").alias("least")))


def families(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> Stored:
    """``fp`` and ``family`` of each fingerprint that reaches a smaller one; the
    family is the smallest. All others are families by themselves or their first."""
    own = materialise(fps.groupBy("fp").agg(F.count(F.lit(1)).alias("n")))
    reached = components(links(own.df, distance, bucket))
    return replace(
        reached, df=reached.df.select(F.col("u").alias("fp"), F.col("v").alias("family"))
    )


def clustered(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """One row per document: its fingerprint and the smallest id it reaches."""
    packed = whole(picked(docs, doc_id=doc_id, text=text))
    found = with_fingerprint(packed, "text", ["doc_id"])
    rows = materialise(found.select(F.col("doc.doc_id").alias("doc_id"), F.col("fingerprint").alias("fp"))).df
    groups = _grouped(rows, F.min("doc_id"), distance, bucket)
    # A document that reaches no other names itself.
    shared = materialise(groups.where("shared").select("fp", "least"))
    return join_measured(rows, shared, ["fp"], "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.coalesce("least", "doc_id").alias("component_id"),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """The document with the smallest id of each group; the first of equal ids.

    A row with a null id stays only where its whole group has none.
    """
    packed = whole(docs)
    rows = materialise(
        with_fingerprint(packed, text, packed.schema["doc"].dataType.fieldNames())
        .withColumn("_row", F.monotonically_increasing_id())
    ).df
    key = F.struct(F.col("id").isNull().alias("none"), "id", "_row")
    narrow = rows.select(
        F.col("fingerprint").alias("fp"), F.col("doc").getField(doc_id).alias("id"), "_row"
    )
    kept = _grouped(narrow, F.min(key), distance, bucket).select("least._row").distinct()
    gone = materialise(narrow.select("_row").join(kept, "_row", "left_anti"))
    return unpacked(join_measured(rows, gone, ["_row"], "left_anti"))
