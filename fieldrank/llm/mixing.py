"""Mixing sources to target weights, by exact quotas of blocks.

1. Every document gets a place in a random order of its source (a hash) and
   every source is cut along that order into blocks.
2. A source's target is met by whole passes over its blocks and a part of one
   more pass, which ends at the document nearest to the target.
3. The blocks of all passes are dealt to the output shards by a splitting tree:
   each node draws from its counts per source how many blocks of each go to its
   left half (a multivariate hypergeometric draw: source by source, by inversion
   of the exact probabilities from the mode outwards); the leaves hold exact quotas.
4. Each shard takes its quota of consecutive blocks of the source's permuted
   list, so shards are disjoint, and shuffles its documents locally.

All on built-in functions. Only sums per source, per block and per ticket leave
the map side. There are about ``BLOCKS`` blocks, or ``SHARD_BLOCKS`` for each shard
where that is more, so no shard stays empty; a node of the tree is one row with the
counts of its sources, and the rows are spread over tasks as they multiply.

Nulls: a null text has no words, a null id counts as the empty id, a null source
is a source of its own and comes last. Rows equal in id and text share their
verdict. Documents without words are never taken. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fieldrank.llm.common import WORD, join_measured, picked, unpacked, whole
from fieldrank.materialise import Stored, materialise

# About so many blocks over all sources, and so many documents in a block at least,
# unless the shards need more blocks than that makes.
BLOCKS = 65_536
BLOCK_DOCS = 256
SHARD_BLOCKS = 16

# Above so many shards, a task sorts and writes several of them, one after the other.
SHARD_TASKS = 65_536

# Words in an output shard of documents.
SHARD_WORDS = 4_000_000

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0

_PREFIX = 16**8
_DRAW_DIGITS = 13


@dataclass(frozen=True)
class Mix:
    """What each source and block gives to the mix."""

    sources: Stored
    blocks: Stored


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, so that the null source can be joined."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def place(doc_id: Column, text: Column, seed: int) -> Column:
    """Where a document stands in the random order of its source."""
    return F.md5(
        F.concat_ws(
            ":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")),
            F.md5(F.coalesce(text, F.lit(""))),
        )
    )


def _block(place: Column, n_blocks: Column) -> Column:
    prefix = F.conv(F.substring(place, 1, 8), 16, 10).cast("long")
    return F.floor(prefix * n_blocks / F.lit(float(_PREFIX))).cast("long")


def with_targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets of sources of ``source_size``: the share by weight, none above its cap.

    Sources in the order of cap to weight fill up one after the other; those
    still open at the end share what is left by weight.
    """
    every = W.orderBy(F.col("source").asc_nulls_last())
    spot = (F.row_number().over(every) - 1) % len(weights)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("_weight", F.element_at(listed, (spot + 1).cast("int")))
    by_level = W.orderBy(F.col("_level"), F.col("_key")).rowsBetween(W.unboundedPreceding, -1)
    total = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (
        weighed.withColumn("_cap", cap * F.col("source_size"))
        .withColumn("_level", F.col("_cap") / F.col("_weight"))
        .withColumn("_all", share * F.sum("source_size").over(total))
        .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_cap").over(by_level), F.lit(0.0)))
        .withColumn(
            "_open",
            F.sum("_weight").over(total) - F.coalesce(F.sum("_weight").over(by_level), F.lit(0.0)),
        )
        .withColumn("_fill", F.col("_left") / F.col("_open"))
    )
    open_fill = F.min(F.when(F.col("_fill") < F.col("_level"), F.struct("_level", "_fill"))).over(total)
    return levels.withColumn(
        "target",
        F.when(open_fill.isNull() | (F.col("_level") < open_fill["_level"]), F.col("_cap"))
        .otherwise(open_fill["_fill"] * F.col("_weight")),
    ).drop("_weight", "_cap", "_level", "_all", "_left", "_open", "_fill")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, at: Column) -> Column:
    """How many of ``drawn`` among ``total`` are marked, where ``at`` in [0, 1) chooses.

    Weights are relative to that of the mode, each from its neighbour's by their exact
    ratio. ``at`` runs over the mode, then over what is above it, then below.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - marked))
    high = F.least(marked, drawn)
    mode = F.floor((drawn + 1) * (marked + 1) / (total + 2))
    given = F.struct(
        (total - marked - drawn).cast("double").alias("others"),
        marked.cast("double").alias("marked"), drawn.cast("double").alias("drawn"),
        low.alias("low"), high.alias("high"), at.alias("at"),
        F.greatest(low, F.least(high, mode)).cast("long").alias("mode"),
    )
    nothing = F.array().cast("array<bigint>")

    def walk(v: Column, up: bool, limit: Column) -> Column:
        """The sum of weights on a side of the mode, and how often it was within a limit."""
        if up:
            steps = F.when(v["high"] > v["mode"], F.sequence(v["mode"], v["high"] - 1))
        else:
            steps = F.when(v["low"] < v["mode"], F.sequence(v["mode"], v["low"] + 1, F.lit(-1).cast("long")))

        def step(state: Column, place: Column) -> Column:
            k = place.cast("double")
            ratio = (
                (v["marked"] - k) * (v["drawn"] - k) / ((k + 1) * (v["others"] + k + 1)) if up
                else k * (v["others"] + k) / ((v["marked"] - k + 1) * (v["drawn"] - k + 1))
            )
            return _with(state["weight"] * ratio, lambda weight: F.struct(
                weight.alias("weight"), (state["sum"] + weight).alias("sum"),
                (state["within"] + (state["sum"] + weight <= limit).cast("long")).alias("within"),
            ))

        start = F.struct(
            F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("within")
        )
        return F.aggregate(F.coalesce(steps, nothing), start, step)

    def chosen(v: Column) -> Column:
        sums = F.struct(
            walk(v, True, F.lit(0.0))["sum"].alias("up"), walk(v, False, F.lit(0.0))["sum"].alias("down")
        )

        def beyond_mode(rest: Column, up: Column) -> Column:
            above = v["mode"] + 1 + walk(v, True, rest)["within"]
            below = _with(rest - up, lambda r: v["mode"] - 1 - walk(v, False, r)["within"])
            return F.when(rest < up, above).otherwise(F.greatest(v["low"], below))

        return _with(sums, lambda w: _with(
            v["at"] * (1 + w["up"] + w["down"]) - 1,
            lambda rest: F.when(rest < 0, v["mode"]).otherwise(beyond_mode(rest, w["up"])),
        ))

    return _with(given, chosen)


def _halves(node: DataFrame, seed: int) -> DataFrame:
    """Split nodes (``_low``, ``_high``, ``_have``: blocks by source) in two, nearly equal
    for each shard."""
    zero = F.lit(0).cast("long")
    middle = F.floor((F.col("_low") + F.col("_high")) / 2).cast("int")
    size = F.aggregate("_have", zero, lambda n, x: n + x["_n"])
    held = F.floor(
        F.col("_size") * (F.col("_middle") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    )

    def at(key: Column) -> Column:
        drawn = F.md5(F.concat_ws(":", F.lit(seed), F.lit("draw"), F.col("_low"), F.col("_high"), key))
        digits = F.conv(F.substring(drawn, 1, _DRAW_DIGITS), 16, 10).cast("double")
        return digits / F.lit(16.0**_DRAW_DIGITS)

    def draw(state: Column, source: Column) -> Column:
        got = hypergeometric(state["total"], source["_n"], state["drawn"], at(source["_key"]))
        return _with(got, lambda n: F.struct(
            (state["total"] - source["_n"]).alias("total"), (state["drawn"] - n).alias("drawn"),
            F.concat(state["out"], F.array(n)).alias("out"),
        ))

    start = F.struct(
        F.col("_size").alias("total"), F.col("_held").alias("drawn"),
        F.array().cast("array<bigint>").alias("out"),
    )
    drawn = node.withColumns({"_middle": middle, "_size": size}).withColumn("_held", held).withColumn(
        "_left", F.aggregate("_have", start, draw, lambda s: s["out"])
    )

    def half(low: str, high: str, count: Callable[[Column, Column], Column]) -> Column:
        counts = F.zip_with(
            "_have", "_left",
            lambda x, n: F.struct(x["_key"].alias("_key"), count(x["_n"], n).alias("_n")),
        )
        return F.struct(
            F.col(low).alias("_low"), F.col(high).alias("_high"),
            F.filter(counts, lambda x: x["_n"] > 0).alias("_have"),
        )

    both = F.array(
        half("_low", "_middle", lambda n, left: left),
        half("_middle", "_high", lambda n, left: n - left),
    )
    return drawn.select(F.explode(both).alias("_half")).select("_half.*").where("_low < _high")


# Levels of the tree that one task goes down before the nodes are spread again.
_LEVELS = 6


def _quotas(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """Blocks of each source (``_key``, ``_n``) for each shard (``_low``)."""
    have = F.array_sort(F.collect_list(F.struct("_key", F.col("_n").cast("long").alias("_n"))))
    node = counts.agg(have.alias("_have")).select(
        F.lit(0).alias("_low"), F.lit(shards).alias("_high"), "_have"
    )
    for level in range((shards - 1).bit_length()):
        if level and level % _LEVELS == 0:
            node = node.repartition("_low", "_high")
        node = _halves(node, seed)
    return node.select("_low", F.explode("_have").alias("_source")).select(
        F.col("_source._key").alias("_key"), "_low", F.col("_source._n").alias("_quota")
    )


def plan_mix(
    placed: DataFrame,
    shards: int,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = 0,
) -> Mix:
    """Plan the mix of rows (``_key``, ``source``, ``size``, ``_place``)."""
    total = placed.agg(F.count(F.lit(1))).first()[0]
    block_docs = min(
        max(BLOCK_DOCS, -(-total // BLOCKS)), max(1, -(-total // (SHARD_BLOCKS * shards)))
    )
    sums = placed.groupBy("_key", "source").agg(
        F.sum("size").alias("source_size"),
        F.ceil(F.count(F.lit(1)) / block_docs).cast("long").alias("_blocks"),
    )
    targets = (
        with_targets(sums, weights, share, cap)
        .withColumn(
            "_passes",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0).cast("int"),
        )
        .withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size"))
    )
    sources = materialise(targets)

    cut = join_measured(placed, _without(sources, "source"), ["_key"], "inner")
    cut = cut.withColumn("_block", _block(F.col("_place"), F.col("_blocks")))
    run = W.partitionBy("_key").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        cut.groupBy("_key", "_block", "_passes", "_rest").agg(F.sum("size").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(run), F.lit(0)))
        .withColumn("_whole", (F.col("_rest") > 0) & (F.col("_before") + F.col("_size") <= F.col("_rest")))
        .withColumn(
            "_cut", (F.col("_rest") > 0) & ~F.col("_whole") & (F.col("_before") <= F.col("_rest"))
        )
    )
    blocks = materialise(blocks)

    # Only the block in which a source's last pass ends is looked at by document.
    ends = materialise(blocks.df.where("_cut").select("_key", "_block", "_before"))
    inside = W.partitionBy("_key").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
    last = (
        join_measured(cut, ends, ["_key", "_block"], "inner")
        .groupBy("_key", "_place", "_before", "_rest").agg(F.sum("size").alias("_size"))
        .withColumn("_before", F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .where(F.col("_before") + F.col("_size") / 2 <= F.col("_rest"))
        .groupBy("_key").agg(F.max("_place").alias("_last"))
    )
    last = materialise(last)

    units = (
        blocks.df.withColumn(
            "_times", F.col("_passes") + F.when(F.col("_whole") | F.col("_cut"), 1).otherwise(0)
        )
        .where("_times > 0")
        .withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    )
    permuted = F.md5(F.concat_ws(":", F.lit(seed), F.lit("block"), "_key", "_block", "_pass"))
    units = units.withColumn(
        "_ticket",
        F.row_number().over(W.partitionBy("_key").orderBy(permuted, "_block", "_pass")),
    ).select("_key", "_block", "_pass", "_ticket")
    units = materialise(units).df

    counts = units.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    quotas = materialise(_quotas(counts, shards, seed)).df
    upto = W.partitionBy("_key").orderBy("_low")
    spans = quotas.withColumn("_to", F.sum("_quota").over(upto)).select(
        "_key", "_low", F.explode(F.sequence(F.col("_to") - F.col("_quota") + 1, "_to")).alias("_ticket")
    )
    dealt = (
        units.withColumn("_ticket", F.col("_ticket").cast("long"))
        .join(spans, ["_key", "_ticket"])
        .groupBy("_key", "_block")
        .agg(F.array_sort(F.collect_list(F.struct("_pass", F.col("_low").alias("shard")))).alias("_dealt"))
    )
    given = materialise(
        blocks.df.select("_key", "_block", "_whole", "_cut").join(dealt, ["_key", "_block"])
    )
    ended = sources.df.join(last.df, "_key", "left")
    return Mix(materialise(ended), given)


def _without(side: Stored, *columns: str) -> Stored:
    return Stored(side.df.drop(*columns), side.rows, side.nbytes)


def with_shards(placed: DataFrame, mix: Mix) -> DataFrame:
    """Add ``source_size``, ``target`` and ``shards``, one entry per time the row is taken."""
    cut = join_measured(placed, _without(mix.sources, "source"), ["_key"], "inner")
    cut = cut.withColumn("_block", _block(F.col("_place"), F.col("_blocks")))
    cut = join_measured(cut, mix.blocks, ["_key", "_block"], "left")
    in_last = F.coalesce(
        F.col("_whole") | (F.col("_cut") & (F.col("_place") <= F.col("_last"))), F.lit(False)
    )
    times = F.col("_passes") + F.when(in_last, 1).otherwise(0)
    shards = F.coalesce(F.slice(F.col("_dealt.shard"), F.lit(1), times), F.array().cast("array<int>"))
    return cut.withColumn("shards", shards).drop(
        "_block", "_blocks", "_passes", "_rest", "_last", "_whole", "_cut", "_dealt"
    )


def _placed(rows: DataFrame, doc_id: Column, source: Column, text: Column, seed: int) -> DataFrame:
    return rows.withColumns({
        "_key": source_key(source), "_place": place(doc_id, text, seed), "size": n_words(text),
    })


def mix_report(
    docs: DataFrame,
    shards: int,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 0,
    **terms,
) -> DataFrame:
    """One row per document: what the mix takes of it and into which shards."""
    rows = picked(docs, doc_id=doc_id, source=source, text=text)
    rows = _placed(rows, F.col("doc_id"), F.col("source"), F.col("text"), seed).drop("text")
    rows = materialise(rows).df
    mixed = with_shards(rows, plan_mix(rows, shards, seed=seed, **terms))
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.size("shards") * F.col("size")).cast("long").alias("taken"),
        F.array_join(F.col("shards").cast("array<string>"), ",").alias("shards"),
    )


def mixed_documents(
    docs: DataFrame,
    shard_words: int = SHARD_WORDS,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 0,
    **terms,
) -> DataFrame:
    """The documents of the mix, a row for each time one is taken, shard by shard.

    There are as many shards as the mix has times ``shard_words`` words. Partition
    i holds output shard i in a random order; above ``SHARD_TASKS`` shards it holds
    the same number of consecutive ones, one after the other. Columns are those of
    ``docs``. A document without words is in no shard.
    """
    packed = whole(docs)
    get = F.col("doc").getField
    rows = _placed(packed, get(doc_id), get(source), get(text), seed)
    narrow = materialise(
        rows.select("_key", get(source).alias("source"), "size", "_place"), words=F.sum("size")
    )
    mixed_words = terms.get("share", SHARE) * (narrow.observed["words"] or 0)
    shards = max(1, math.ceil(mixed_words / shard_words))
    mixed = with_shards(rows, plan_mix(narrow.df, shards, seed=seed, **terms)).where("size > 0")
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("local"), "_place", "_spot"))
    together = -(-shards // SHARD_TASKS)
    out = (
        mixed.select("doc", "_place", F.posexplode("shards").alias("_spot", "_shard"))
        .repartitionById(-(-shards // together), F.floor(F.col("_shard") / together).cast("int"))
        .sortWithinPartitions("_shard", order)
    )
    return unpacked(out)
