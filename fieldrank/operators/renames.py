"""Entities that come back under another id with the same or a similar name.

Names of dropped entities meet names that entered at the same date in blocks. Names
within ``edits`` edits have in common what is left of them after deleting up to ``edits``
characters, so short names meet by these rests: a block has names near each other only,
however many there are. A long name has too many rests and meets by shared q-grams. One
edit touches ``gram`` q-grams at most, so of two names within ``edits`` edits one has no
more than ``edits * gram`` different q-grams that the other lacks. Ordered by frequency,
rare ones first, their first ``edits * gram + 1`` therefore share one, and only these make
blocks; with fewer q-grams, long names meet by their rests too. No name within the bound is
missed. Names of one edit meet first, and only what they leave over is looked at for more.

A block with many dropped names is dealt to parts. Equal names are one row with a count,
so many entities of one name make no pairs. Links are one to one: the fewest edits first,
ties by a hash of both names. All pairs of names that are the best of both their names are
linked at once, then what is left over is looked at again; of equal names the lower ids
come first.
"""

from __future__ import annotations

from functools import reduce
from itertools import count
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldrank.materialise import Stored, join_stored, materialise
from fieldrank.names import named
from fieldrank.operators.movements import entered_dropped
from fieldrank.operators.ranking import group_sizes, number_rows
from fieldrank.roles import DEFAULT_ROLES, Roles

# Dropped names of a block in one part.
PART_NAMES = 1_000

# Names with more rests than this are long.
MOST_RESTS = 300

# Entities of one name that meet their links together.
CHUNK = 1_000


def renamed_entities(
    df: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    edits: int = 2,
    gram: int = 2,
    part_names: int = PART_NAMES,
) -> DataFrame:
    """Links of entities dropped at a date and entities that entered at it, one to one.

    Names are compared without case and outer blanks; entities without a name have no
    link. A link has ``edits`` edits at most.
    """
    changed = entered_dropped(df, roles, (roles.entity_name,))
    name = named(roles.entity_name).cast("string")
    rows = materialise(changed.where(name.isNotNull()).select(
        named(roles.snapshot_date).alias("_day"), named(roles.entity_id).alias("_id"),
        name.alias("_given"), F.lower(F.trim(name)).alias("_name"),
        (F.col("change") == "dropped").alias("_gone"),
    ))
    sizes = group_sizes(rows.df, ["_day", "_gone", "_name"], "_n")
    left = sizes.df.withColumn("_used", F.lit(0).cast("long"))

    gone, come = _open(left, True, "_before"), _open(left, False, "_now")
    same = gone.join(
        come, (gone["_day"] == come["_day"]) & (F.col("_before") == F.col("_now"))
    ).select(gone["_day"], "_before", "_now", F.lit(0).alias("_edits"))
    pieces, left = _settled(materialise(same), left)
    # Fewer edits come first, and what they leave over has no pair of fewer edits.
    for bound in range(1, edits + 1):
        near = near_names(
            _open(left, True, "_name").select("_day", "_name"),
            _open(left, False, "_name").select("_day", "_name"), bound, gram, part_names,
        )
        more, left = _settled(materialise(near), left)
        pieces += more
    return _linked(rows, sizes, pieces, roles)


def near_names(
    gone: DataFrame, come: DataFrame, edits: int, gram: int, part_names: int = PART_NAMES
) -> DataFrame:
    """Different names (``_day``, ``_name``) of both sides within some edits, once each."""
    names = gone.withColumn("_gone", F.lit(True)).union(come.withColumn("_gone", F.lit(False)))
    tokens = materialise(_tokens(names, edits, gram))
    blocks = materialise(
        tokens.df.groupBy("_day", "_token")
        .agg(F.count_if("_gone").alias("_n_gone"), F.count_if(~F.col("_gone")).alias("_n_come"))
        .where("_n_gone > 0 AND _n_come > 0")
        .select("_day", "_token", F.ceil(F.col("_n_gone") / part_names).cast("int").alias("_parts"))
    )
    placed = join_stored(tokens.df, blocks, ["_day", "_token"])
    part = F.pmod(F.xxhash64("_name"), F.col("_parts")).cast("int")
    before = placed.where("_gone").select(
        "_day", "_token", part.alias("_part"), F.col("_name").alias("_before")
    )
    now = placed.where("NOT _gone").select(
        "_day", "_token", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"),
        F.col("_name").alias("_now"),
    )
    apart = F.abs(F.length("_before") - F.length("_now"))
    return (
        before.join(now, ["_day", "_token", "_part"])
        .where((F.col("_before") != F.col("_now")) & (apart <= edits))
        .withColumn("_edits", F.levenshtein("_before", "_now", edits))
        .where("_edits >= 0")
        .groupBy("_day", "_before", "_now").agg(F.min("_edits").alias("_edits"))
    )


def _tokens(names: DataFrame, edits: int, gram: int) -> DataFrame:
    """The blocks of each name. Two names of which one is short both have their rests,
    two long ones both have their q-grams."""
    longest = _longest_short(edits)
    given = materialise(names, long=F.count_if(F.length("_name") > longest))
    by_rest = given.df.where(F.length("_name") <= longest + edits).select(
        "_day", "_gone", "_name", F.explode(_marked_rests(edits)).alias("_token")
    )
    if not given.observed["long"]:
        return by_rest
    by_gram = _gram_tokens(given.df.where(F.length("_name") > longest), edits, gram)
    return by_rest.union(by_gram).distinct()


def _longest_short(edits: int) -> int:
    """The length up to which a name has no more than ``MOST_RESTS`` rests."""
    most = max(edits, 1)
    return next(
        n for n in count() if sum(comb(n + 1, k) for k in range(most + 1)) > MOST_RESTS
    )


def _gram_tokens(names: DataFrame, edits: int, gram: int) -> DataFrame:
    needed = edits * gram + 1
    starts = F.sequence(F.lit(1), F.greatest(F.length("_name") - gram + 1, F.lit(1)))
    grams = F.array_distinct(
        F.transform(starts, lambda at: F.substr(F.col("_name"), at, F.lit(gram)))
    )
    spread = names.select("_day", "_gone", "_name", F.explode(grams).alias("_gram"))
    often = group_sizes(spread, ["_gram"], "_often")
    rare_first = F.array_sort(F.collect_list(F.struct("_often", "_gram")))["_gram"]
    first = join_stored(spread, often, ["_gram"]).groupBy("_day", "_gone", "_name").agg(
        F.slice(rare_first, 1, needed).alias("_first")
    )
    marked = F.transform("_first", lambda g: F.concat(F.lit("g"), g))
    few = F.size("_first") < needed
    every = F.when(few, F.concat(marked, _marked_rests(edits))).otherwise(marked)
    return first.select("_day", "_gone", "_name", F.explode(every).alias("_token"))


def _marked_rests(edits: int) -> Column:
    return F.transform(_rests(F.col("_name"), edits), lambda r: F.concat(F.lit("r"), r))


def _rests(name: Column, edits: int) -> Column:
    """What is left of a name after deleting up to so many characters."""
    def without_one(text: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
        return F.transform(places, lambda at: F.concat(
            F.substr(text, F.lit(1), at - 1), F.substr(text, at + 1)
        ))

    rests = F.array(name)
    for _ in range(edits):
        rests = F.array_distinct(F.concat(rests, F.flatten(F.transform(rests, without_one))))
    return rests


def _open(left: DataFrame, gone: bool, name: str) -> DataFrame:
    """Names of a side that still have entities without a link."""
    return left.where((F.col("_gone") == gone) & (F.col("_used") < F.col("_n"))).select(
        "_day", F.col("_name").alias(name), F.col("_n").alias(f"{name}_n"),
        F.col("_used").alias(f"{name}_used"),
    )


def _settled(edges: Stored, left: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Link names round by round; each round uses up one name of every link it makes."""
    pieces = []
    while edges.rows:
        open_edges = materialise(
            edges.df.join(_open(left, True, "_before"), ["_day", "_before"])
            .join(_open(left, False, "_now"), ["_day", "_now"])
        )
        rank = F.struct("_edits", F.md5(F.concat("_before", F.lit(":"), "_now")), "_before", "_now")
        both = ["_day", "_before", "_now"]
        best = [
            open_edges.df.groupBy("_day", name).agg(F.min_by(F.struct(*both), rank).alias("_best"))
            .select("_best.*") for name in ("_before", "_now")
        ]
        take = F.least(
            F.col("_before_n") - F.col("_before_used"), F.col("_now_n") - F.col("_now_used")
        )
        taken = materialise(
            open_edges.df.join(best[0].join(best[1], both), both)
            .select(*both, "_edits", "_before_used", "_now_used", take.alias("_take"))
        )
        if not taken.rows:
            break
        pieces.append(taken.df)
        more = reduce(DataFrame.union, (
            taken.df.select("_day", F.lit(gone).alias("_gone"), F.col(name).alias("_name"), "_take")
            for gone, name in ((True, "_before"), (False, "_now"))
        ))
        left = materialise(
            left.join(more, ["_day", "_gone", "_name"], "left")
            .withColumn("_used", F.col("_used") + F.coalesce("_take", F.lit(0))).drop("_take")
        ).df
        edges = Stored(open_edges.df.select(*both, "_edits"), open_edges.rows, open_edges.nbytes)
    return pieces, left


def _linked(rows: Stored, sizes: Stored, pieces: list[DataFrame], roles: Roles) -> DataFrame:
    """The entities of linked names, by their number among those of the name."""
    keys = ["_day", "_gone", "_name"]
    numbered = number_rows(
        join_stored(rows.df, sizes, keys), keys, {"_number": [F.col("_id")]}, "_n",
        sizes.observed["largest"],
    ).withColumn("_at", F.col("_number") - 1).withColumn("_chunk", F.floor(F.col("_at") / CHUNK))
    if not pieces:
        none = F.lit(0).cast("long")
        pieces = [rows.df.where(F.lit(False)).select(
            "_day", F.col("_name").alias("_before"), F.col("_name").alias("_now"),
            F.lit(0).alias("_edits"), none.alias("_before_used"), none.alias("_now_used"),
            none.alias("_take"),
        )]
    every = reduce(DataFrame.union, pieces)

    def side(gone: bool, name: str) -> DataFrame:
        start = F.col(f"{name}_used")
        chunks = F.sequence(F.floor(start / CHUNK), F.floor((start + F.col("_take") - 1) / CHUNK))
        placed = every.withColumn("_chunk", F.explode(chunks)).withColumn("_name", F.col(name))
        found = numbered.where(F.col("_gone") == gone).join(placed, ["_day", "_name", "_chunk"])
        at = F.col("_at") - start
        return found.where((at >= 0) & (at < F.col("_take"))).select(
            "_day", "_before", "_now", "_edits", at.alias("_spot"),
            F.col("_id").alias(f"{name}_id"), F.col("_given").alias(f"{name}_given"),
        )

    linked = side(True, "_before").join(
        side(False, "_now").drop("_edits"), ["_day", "_before", "_now", "_spot"]
    )
    return linked.select(
        F.col("_day").alias(roles.snapshot_date),
        F.col("_before_id").alias("id_before"), F.col("_now_id").alias("id_now"),
        F.col("_before_given").alias("name_before"), F.col("_now_given").alias("name_now"),
        F.col("_edits").alias("edits"),
    )
