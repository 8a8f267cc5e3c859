"""Connected components of an edge table, by alternating star contraction.

Large-star links every larger neighbour of a vertex to the smallest one, small-star
links the smaller neighbours and the vertex itself. Both keep the components and
end in stars whose centre is the smallest vertex. Every round is written to the
shared folder, so no lineage grows and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.llm.common import join_measured
from fieldrank.materialise import Stored, materialise


def _stored(edges: DataFrame) -> Stored:
    return materialise(edges.distinct(), digest=F.bit_xor(F.xxhash64("u", "v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")))
    linked = join_measured(both, least, ["u"], "inner").where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger vertex ``u`` to the smaller ``v``."""
    least = materialise(edges.groupBy("u").agg(F.min("v").alias("least")))
    linked = join_measured(edges, least, ["u"], "inner")
    onward = linked.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return onward.union(least.df.select("u", F.col("least").alias("v")))


def components(edges: DataFrame) -> Stored:
    """Pairs ``u``, ``v`` in; each vertex ``u`` but the centres, with its centre ``v``, out."""
    ordered = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = _stored(ordered)
    while now.rows:
        before = (now.rows, now.observed["digest"])
        now = _stored(_small_star(_stored(_large_star(now.df)).df))
        if (now.rows, now.observed["digest"]) == before:
            break
    return now
