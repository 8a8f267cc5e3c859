"""Shards by weighted rendezvous hashing of stable record keys.

Each record draws one score per shard from a hash of its key and the shard's
number and goes where the score is highest. A new shard only adds one score, so
a record either stays or moves into the new shard. All on built-in functions.

Nulls: a null key counts as the empty key, a null text has no bytes. Repeated
rows share their shard and get slots of their own. An empty table gives no rows.
Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldrank.llm.common import picked
from fieldrank.materialise import join_stored, materialise
from fieldrank.operators.ranking import group_sizes, number_rows

# Hexadecimal digits of the hash that make the score: 52 bits fit a double.
DIGITS = 13


def shard_scores(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """One score per shard, the weight over an exponential draw."""
    text = F.coalesce(key.cast("string"), F.lit(""))

    def score(weight, shard):
        digest = F.md5(F.concat_ws(":", F.lit(seed), shard, text))
        number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
        return weight / -F.ln((number + 0.5) / F.lit(float(16**DIGITS)))

    return F.transform(F.array(*[F.lit(float(w)) for w in weights]), score)


def best_shard(scores: Column) -> Column:
    """The shard of the highest score, the lowest of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def sharded(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    seed: int = 0,
    new_weight: float = 1.0,
) -> DataFrame:
    """Each document's shard, its slot there and its shard after one more is added.

    Slots follow the hash of the key. They are numbered by a window where shards
    are small and by range-partitioned passes where one is large.
    """
    n = len(weights)
    scores = shard_scores(F.col("doc_id"), [*weights, new_weight], seed)
    text_or_none = F.coalesce(F.col("text"), F.lit(""))
    placed = (
        picked(docs, doc_id=key, text=text)
        .select(
            "doc_id",
            (F.octet_length(text_or_none) + 8).cast("long").alias("size"),
            F.crc32(text_or_none).alias("text_crc32"),
            scores.alias("scores"),
        )
        .select(
            "doc_id", "size", "text_crc32",
            best_shard(F.slice("scores", 1, n)).alias("shard"),
            best_shard(F.col("scores")).alias("grown_shard"),
        )
        .withColumn("_origin", F.monotonically_increasing_id())
    )
    rows = materialise(placed).df
    sizes = group_sizes(rows, ["shard"])
    order = [
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
        F.col("doc_id"), F.col("text_crc32"), F.col("_origin"),
    ]
    numbered = number_rows(
        join_stored(rows, sizes, ["shard"]), ["shard"], {"slot": order}, "n_rows",
        sizes.observed["largest"],
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("slot") - 1).cast("long").alias("slot"), "grown_shard",
    )
