"""The trie of conversation beginnings, rolled up by centroid decomposition.

Conversations are rebuilt first: one borrows its first turns from the conversation
whose id is the next lower multiple of ``FAMILY``. A node of the trie is a distinct
sequence of first turns. Its key combines 64-bit hashes of all its (position, turn)
pairs, twice over, so equal beginnings meet without comparing sequences. Grouping by
key gives each node its members, and its weight below: the turns its members have
from the node on, which no walk over the tree is needed for.

Sums over subtrees are made by centroid decomposition of the forest of parent edges.
A component's centroid is its deepest node with more than half of the weight; without
it all parts have half the weight or less. What lies at and below the centroid is
added up once and added to every node on the path from the centroid to the
component's top; then the parts are split in turn. A node meets each node below it in
exactly one component, the one whose centroid lies between both, and takes part in at
most as many components as the logarithm of the weight, however deep the tree is.

Components of more than ``TASK_NODES`` nodes are split by joins, all at once in each
round: members of a centroid are found by its key, the path by the turns of its
smallest member. Smaller ones are grouped to tasks, which split them alone.

The ids of conversations that end in a node are hashed in two steps: range
partitions join them to strings of bounded size, and only these meet, in order.

A null role or text is empty, a null turn comes first, equal turns follow the hash of
role and text. Rows without a conversation id belong to no conversation and are left out.
Repeated rows are turns of their own. An empty table has no nodes. Conversations of
any length are whole. Only the named columns are read; others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.llm.common import join_measured, picked
from fieldrank.materialise import Stored, materialise
from fieldrank.operators.ranking import group_sizes, number_rows

# A conversation borrows from the next lower multiple of this, fewer than
# ``BORROWED`` turns.
FAMILY = 100
BORROWED = 6

TASK_NODES = 20_000
# Ids in one string, and turns of a conversation that one window takes at once.
IDS_AT_ONCE = 8192
TURNS_AT_ONCE = 100_000

ROOT = "0" * 32

# What a node brings into the decomposition, and what it leaves with.
_OWN = ["own_leaves", "own_saved"]
_SUMS = ["n_leaves", "saved_tokens"]
_SOLVED = "node string, n_leaves long, saved_tokens long"


def numbered_turns(rows: DataFrame) -> tuple[DataFrame, Stored]:
    """Turns with their ``place`` from 0, the length of their text and a hash of what is
    said; and the number of turns of each conversation."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    turns = materialise(rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.length(text).cast("long").alias("chars"),
        F.sha2(F.concat_ws(":", F.octet_length(role), role, text), 256).alias("said"),
    )).df
    sizes = group_sizes(turns, ["conv_id"])
    placed = number_rows(
        join_measured(turns, sizes, ["conv_id"], "inner"), ["conv_id"],
        {"place": [F.asc_nulls_first("turn"), F.asc("said")]},
        "n_rows", sizes.observed["largest"],
    )
    return placed.select("conv_id", (F.col("place") - 1).alias("place"), "chars", "said"), sizes


def rebuilt(rows: DataFrame) -> tuple[DataFrame, Stored]:
    """Turns of the rebuilt conversations (``conv_id``, ``depth`` from 1, ``said``,
    ``chars``), and each conversation with its ``length``."""
    placed, sizes = numbered_turns(rows)
    turns = materialise(placed).df
    family = sizes.df.select(
        "conv_id", F.col("n_rows").alias("n_own"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % BORROWED).alias("asked"),
    )
    bases = sizes.df.select(F.col("conv_id").alias("base"), F.col("n_rows").alias("n_base"))
    lent = F.least("asked", F.coalesce("n_base", F.lit(0)))
    length = F.col("lent") + F.greatest(F.col("n_own") - F.col("asked"), F.lit(0))
    convs = materialise(
        family.join(bases, "base", "left").withColumn("lent", lent)
        .select("conv_id", "base", "asked", "lent", length.alias("length")),
        longest=F.max("length"),
    )
    heads = turns.where(F.col("place") < BORROWED - 1).withColumnRenamed("conv_id", "base")
    borrowed = convs.df.where("lent > 0").join(heads, "base").where("place < asked").select(
        "conv_id", (F.col("place") + 1).alias("depth"), "said", "chars", "length"
    )
    own = join_measured(turns, convs, ["conv_id"], "inner").where("place >= asked").select(
        "conv_id", (F.col("lent") + F.col("place") - F.col("asked") + 1).alias("depth"),
        "said", "chars", "length",
    )
    return borrowed.union(own), convs


def _hashes() -> list[Column]:
    """Two hashes of a turn and its position."""
    return [F.xxhash64("depth", "said"), F.xxhash64("said", F.lit("again"), "depth")]


def _key(*numbers: Column) -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(n)), 16, "0") for n in numbers])


def beginnings(turns: DataFrame, longest: int, at_once: int = TURNS_AT_ONCE) -> DataFrame:
    """Each turn with the key of the node that it leads to and of that node's parent.

    Long conversations are combined in runs of ``at_once`` turns, then run by run.
    """
    run = Window.partitionBy("conv_id", "_run").orderBy("depth")
    upto = run.rowsBetween(Window.unboundedPreceding, 0)
    hashes = dict(zip(["z1", "z2"], _hashes()))
    turns = turns.withColumns(hashes).withColumn("_run", F.floor((F.col("depth") - 1) / at_once))
    found = turns.withColumns({f"x{i}": F.bit_xor(f"z{i}").over(upto) for i in (1, 2)})
    if longest > at_once:
        earlier = Window.partitionBy("conv_id").orderBy("_run").rowsBetween(
            Window.unboundedPreceding, -1
        )
        runs = turns.groupBy("conv_id", "_run").agg(F.bit_xor("z1").alias("r1"), F.bit_xor("z2").alias("r2"))
        runs = materialise(runs.select("conv_id", "_run", *[
            F.coalesce(F.bit_xor(f"r{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in (1, 2)
        ]))
        found = join_measured(found, runs, ["conv_id", "_run"], "inner").withColumns(
            {f"x{i}": F.col(f"x{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)}
        )
    before = [F.col(f"x{i}").bitwiseXOR(F.col(f"z{i}")) for i in (1, 2)]
    return found.select(
        "conv_id", "depth", _key(F.col("x1"), F.col("x2")).alias("node"),
        _key(*before).alias("parent"), "chars", "length",
    )


def trie_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: its smallest member, members, children and weight."""
    weight = F.sum(F.col("length") - F.col("depth") + 1).alias("weight")
    members = [F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")]
    inner = turns.groupBy("node", "parent", "depth").agg(*members, F.max("chars").alias("chars"), weight)
    root = convs.agg(*members, F.sum(F.col("length") + 1).alias("weight")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("chars"), "weight",
    )
    nodes = materialise(inner.unionByName(root)).df
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    return nodes.join(children, "node", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))
    )


def _added(parents: list[int], weight: list[int], own: list[list[int]], sums: list[list[int]]) -> None:
    """Adds to ``sums`` the subtree sums of a component; nodes by depth, the top first."""
    parts = [list(range(len(parents)))]
    while parts:
        part = parts.pop()
        top = part[0]
        half = weight[top]
        # Nodes with more than half of the weight form a path down from the top.
        centre = max(i for i, v in enumerate(part) if 2 * weight[v] > half)
        centre = part[centre]
        place: dict[int, list[int]] = {}
        upper: list[int] = []
        totals = [values[centre] for values in own]
        for v in part:
            if v == centre:
                continue
            parent = parents[v]
            if parent == centre:
                place[v] = [v]
                parts.append(place[v])
            elif parent in place:
                place[v] = place[parent]
                place[v].append(v)
            else:
                upper.append(v)
                continue
            totals = [total + values[v] for total, values in zip(totals, own)]
        below = weight[centre]
        v = centre
        while True:
            for values, total in zip(sums, totals):
                values[v] += total
            if v == top:
                break
            v = parents[v]
            weight[v] -= below
        if upper:
            parts.append(upper)


def solved(components: DataFrame) -> DataFrame:
    """Subtree sums of components that one task can hold."""
    order = ["node", "comp", "parent", "weight", *_OWN, *_SUMS]

    def solve(columns: list[list]) -> pa.RecordBatch:
        nodes, _, parents, weight, *values = columns
        spots = {node: i for i, node in enumerate(nodes)}
        _added([spots.get(p, -1) for p in parents], weight, values[:2], values[2:])
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.string()), *[pa.array(v, pa.int64()) for v in values[2:]]],
            names=["node", *_SUMS],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in order]
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in order]
            comps, start = columns[1], 0
            for i in range(1, len(comps) + 1):
                if held[1] and i - 1 == start and comps[start] != held[1][0]:
                    yield solve(held)
                    held = [[] for _ in order]
                if i == len(comps) or comps[i] != comps[start]:
                    for values, column in zip(held, columns):
                        values.extend(column[start:i])
                    start = i
        if held[1]:
            yield solve(held)

    placed = components.repartition("comp").sortWithinPartitions("comp", "depth")
    return placed.select(*order).mapInArrow(run, _SOLVED)


def _split_once(state: DataFrame, stats: Stored, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits components at their centroids: centroids, now done, and the other nodes."""
    heavy = join_measured(state, stats, ["comp"], "inner").where("2 * weight > comp_weight")
    centres = materialise(heavy.groupBy("comp").agg(
        F.max_by(F.struct("node", "conv_id", "weight"), "depth").alias("c"),
        F.max("depth").alias("c_depth"), F.min("depth").alias("top_depth"),
    ).select(
        "comp", F.col("c.node").alias("c_node"), F.col("c.conv_id").alias("c_conv"),
        F.col("c.weight").alias("c_weight"), "c_depth", "top_depth",
    ))

    def beside(name: str, on: str) -> DataFrame:
        side = Stored(centres.df.withColumnRenamed(name, on), centres.rows, centres.nbytes)
        return join_measured(turns, side, [on], "inner")

    below = beside("c_node", "parent").select("comp", "conv_id", F.col("node").alias("child"))
    path = beside("c_conv", "conv_id").where("depth between top_depth and c_depth").select("node")
    path = path.union(centres.df.where("top_depth = 0").select(F.lit(ROOT))).withColumn("_path", F.lit(True))
    marked = materialise(
        join_measured(state, centres, ["comp"], "inner")
        .join(below, ["comp", "conv_id"], "left").join(path, "node", "left")
        .withColumn("child", F.when(F.col("depth") > F.col("c_depth"), F.col("child")))
        .withColumn("centre", F.col("node") == F.col("c_node"))
        .withColumn("_path", F.coalesce("_path", F.lit(False)))
    ).df
    totals = materialise(
        marked.where("centre or child is not null").groupBy("comp")
        .agg(*[F.sum(own).alias(f"_{own}") for own in _OWN])
    )
    added = {
        out: F.col(out) + F.when(F.col("_path"), F.col(f"_{own}")).otherwise(0)
        for out, own in zip(_SUMS, _OWN)
    }
    rest = F.col("weight") - F.when(F.col("_path"), F.col("c_weight")).otherwise(0)
    moved = join_measured(marked, totals, ["comp"], "inner").withColumns(
        {**added, "weight": rest, "comp": F.coalesce("child", "comp")}
    )
    return moved.where("centre").select(*state.columns), moved.where("not centre").select(*state.columns)


def rolled_up(nodes: DataFrame, turns: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """``node`` with ``n_leaves`` and ``saved_tokens`` summed over its subtree."""
    state = nodes.select(
        "node", F.lit(ROOT).alias("comp"), "parent", "depth", "conv_id", "weight",
        (F.col("n_children") == 0).cast("long").alias("own_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"),
        *[F.lit(0).cast("long").alias(name) for name in _SUMS],
    )
    done, small = [], []
    while True:
        stats = materialise(
            state.groupBy("comp").agg(
                F.max("weight").alias("comp_weight"), F.count(F.lit(1)).alias("comp_nodes")
            ),
            largest=F.max("comp_nodes"),
        )
        if (stats.observed["largest"] or 0) <= task_nodes:
            small.append(state)
            break
        both = materialise(join_measured(state, stats, ["comp"], "inner")).df
        small.append(both.where(F.col("comp_nodes") <= task_nodes).select(*state.columns))
        large = both.where(F.col("comp_nodes") > task_nodes).select(*state.columns)
        centres, state = _split_once(large, stats, turns)
        done.append(centres.select("node", *_SUMS))
    parts = small[0]
    for more in small[1:]:
        parts = parts.union(more)
    out = solved(parts)
    for centres in done:
        out = out.union(centres)
    return out


def hashed_ends(ends: DataFrame, at_once: int = IDS_AT_ONCE) -> DataFrame:
    """``node`` with the SHA-256 of the ids that end there, in order, comma-joined."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
            out, start = [], 0
            for i in range(1, len(nodes) + 1):
                if i == len(nodes) or nodes[i] != nodes[start] or i - start == at_once:
                    out.append((nodes[start], ids[start], ",".join(map(str, ids[start:i]))))
                    start = i
            columns = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.int64(), pa.string()))],
                names=["node", "least", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row(node, found):
            return pa.RecordBatch.from_arrays(
                [pa.array([node]), pa.array([found.hexdigest()])], names=["node", "ends_sha256"]
            )

        for batch in batches:
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node != now:
                    if now is not None:
                        yield row(now, state)
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if now is not None:
            yield row(now, state)

    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = (
        ends.repartitionByRange(tasks, "node", "conv_id").sortWithinPartitions("node", "conv_id")
        .mapInArrow(join, "node string, least long, ids string")
    )
    placed = lists.repartition("node").sortWithinPartitions("node", "least").select("node", "ids")
    return placed.mapInArrow(digest, "node string, ends_sha256 string")


def trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    task_nodes: int = TASK_NODES,
    at_once: int = TURNS_AT_ONCE,
    ids_at_once: int = IDS_AT_ONCE,
) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    rows = picked(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    said, convs = rebuilt(rows)
    turns = materialise(beginnings(said, convs.observed["longest"] or 0, at_once)).df
    nodes = materialise(trie_nodes(turns, convs.df))
    ends = turns.where("depth = length").select("node", "conv_id").union(
        convs.df.where("length = 0").select(F.lit(ROOT), "conv_id")
    )
    parents = nodes.df.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = join_measured(nodes.df, Stored(parents, nodes.rows, nodes.nbytes), ["parent"], "left")
    return (
        known.join(rolled_up(nodes.df, turns, task_nodes), "node")
        .join(hashed_ends(ends, ids_at_once), "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
