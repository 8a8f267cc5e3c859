"""The daily chain: landing files to cleaned, leaderboard and trends tables."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.contracts import completed, contract_for, null_violations
from fieldrank.materialise import join_stored, materialise
from fieldrank.operators.cleaning import CleaningRules, cast_losses, clean
from fieldrank.operators.scoring import Scaling, Weights, leaderboard
from fieldrank.operators.statistics import TIER_CUTS
from fieldrank.operators.trends import trends, trends_after
from fieldrank.roles import DEFAULT_ROLES, Roles
from fieldrank.sources import landing
from fieldrank.sources.store import (
    Load,
    find_dates,
    find_table,
    merged,
    overwrite_load,
    read_dates,
    read_snapshots,
    table_summary,
    write_snapshots,
)


@dataclass(frozen=True)
class Tables:
    """Where the tables of one installation are."""

    root: str

    @property
    def flat(self) -> str:
        return f"{self.root}/flat"

    @property
    def cleaned(self) -> str:
        return f"{self.root}/cleaned"

    @property
    def leaderboard(self) -> str:
        return f"{self.root}/leaderboard"

    @property
    def trends(self) -> str:
        return f"{self.root}/trends"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"


class RejectedInput(ValueError):
    """Landing input that cannot be loaded, with ``on_reject="fail"``."""


@dataclass(frozen=True)
class Chain:
    """How landing records become cleaned rows and scores.

    ``keys`` names the measurements to keep; without it they are looked up in
    each batch, up to ``most_keys``. The files of a date complete each other and
    the newest record of each entity wins; with ``whole_files`` a file is a
    complete snapshot, so the newest file of a date replaces older ones.

    Envelopes that cannot be loaded, files that a newer one replaces and values
    that could not be read are written to the ``rejects`` table (``on_reject=
    "record"``); with ``"fail"`` unusable envelopes stop the load before anything
    is written.
    """

    rules: CleaningRules
    layout: landing.RecordLayout = landing.RECORD
    keys: list[str] | None = None
    on_missing: str = "fail"
    whole_files: bool = False
    on_reject: str = "record"
    most_keys: int = landing.MOST_KEYS
    roles: Roles = field(default=DEFAULT_ROLES)
    weights: Weights = field(default_factory=Weights)
    scaling: Scaling = field(default_factory=Scaling)
    cuts: tuple[float, float] = TIER_CUTS
    exact_cuts: bool = False


def flat_rows(envelopes: DataFrame, chain: Chain) -> DataFrame:
    """Landing envelopes to flat rows with one column per measurement.

    The envelopes should be stored: without ``keys`` they are read twice.
    """
    if chain.whole_files:
        envelopes = landing.newest_files(envelopes)
    rows = landing.flatten(landing.records(envelopes), chain.layout, chain.on_missing)
    if chain.layout.measurements is None:
        return rows
    return landing.spread_map(
        rows, chain.layout.measurements, chain.keys, chain.layout.prefix, chain.most_keys
    )


def load_envelopes(envelopes: DataFrame, tables: Tables, chain: Chain) -> Load:
    """Write the flat and cleaned partitions of the envelopes' dates, then
    bring leaderboard and trends up to date.

    The files and their times name the load, so a load that runs again replaces
    its lines in the rejects and in the load histories.
    """
    spark, roles = envelopes.sparkSession, chain.roles
    if chain.on_reject not in ("record", "fail"):
        raise ValueError(f"on_reject must be 'record' or 'fail', not {chain.on_reject!r}")
    stamp = F.xxhash64("file_path", "file_time").cast("decimal(38,0)")
    stored = materialise(envelopes, codec="zstd", digest=F.sum(stamp))
    envelopes = stored.df  # the files are parsed once
    name = f"{stored.rows} {stored.observed['digest']}".encode()
    load_id = f"load-{hashlib.sha256(name).hexdigest()[:32]}"
    unusable = materialise(landing.rejected(envelopes))
    if unusable.rows and chain.on_reject == "fail":
        raise RejectedInput("; ".join(
            f"{row.file_path}: {row.envelopes} {row.reason}" for row in unusable.df.head(20)
        ))
    rejects = unusable.df
    if chain.whole_files:
        rejects = rejects.unionByName(landing.superseded(envelopes))
    rows = flat_rows(envelopes, chain)
    if not chain.whole_files:
        rows = _with_earlier_files(rows, tables, chain)
    flat = write_snapshots(rows, tables.flat, load_id=load_id)
    if not flat.rows:
        return Load(0, [], _record_rejects(rejects, tables, load_id))
    arrived = read_dates(spark, tables.flat, flat.dates, merge_schema=True)
    lost = cast_losses(arrived, chain.rules).where("unreadable > 0").select(
        F.lit(None).cast("string").alias("file_path"),
        F.concat(F.lit("unreadable "), F.col("column_name")).alias("reason"),
        F.col("unreadable").alias("envelopes"),
    )
    cleaned = write_snapshots(
        completed(clean(arrived, chain.rules), contract_for("cleaned", roles)),
        tables.cleaned, roles.snapshot_date, contract="cleaned", open_columns=True, roles=roles,
        load_id=load_id,
    )
    refresh(spark, tables, cleaned.dates, chain=chain, load_id=load_id)
    left_out = _record_rejects(rejects.unionByName(lost), tables, load_id)
    return Load(cleaned.rows, cleaned.dates, left_out)


def _record_rejects(rejects: DataFrame, tables: Tables, load_id: str) -> int:
    """Write what a load left out to the rejects table; the number of its lines."""
    found = materialise(rejects)
    if found.rows:
        now = F.lit(dt.datetime.now(dt.timezone.utc))
        overwrite_load(found.df.withColumn("loaded_at", now), tables.rejects, load_id)
    return found.rows


def _with_earlier_files(rows: DataFrame, tables: Tables, chain: Chain) -> DataFrame:
    """Add what earlier files brought for the same dates. Rows of a file that
    comes again are replaced, so a repeated batch changes nothing."""
    spark = rows.sparkSession
    dates = rows.agg(F.collect_set("snapshot_date")).first()[0]
    earlier = find_dates(spark, tables.flat, dates, merge_schema=True)
    if earlier is None:
        return rows
    files = materialise(rows.select("file_path").distinct())
    others = earlier.select("file_path").distinct()
    if join_stored(others, files, ["file_path"], "left_anti").isEmpty():
        return rows  # all of them came again
    kept = join_stored(earlier, files, ["file_path"], "left_anti")
    # The result replaces the dates that it is read from.
    return materialise(merged(kept, rows)).df


def refresh(
    spark: SparkSession,
    tables: Tables,
    dates: list[dt.date],
    roles: Roles = DEFAULT_ROLES,
    chain: Chain | None = None,
    load_id: str | None = None,
) -> None:
    """Recompute what a change of ``dates`` in the cleaned table affects."""
    if not dates:
        return
    options: dict = {}
    if chain is not None:
        roles = chain.roles
        options = {"weights": chain.weights, "scaling": chain.scaling, "cuts": chain.cuts,
                   "exact_cuts": chain.exact_cuts}
    day = roles.snapshot_date
    written: dict = {"roles": roles, "load_id": load_id}
    cleaned = read_snapshots(spark, tables.cleaned).select(*roles.columns)
    board = leaderboard(read_dates(spark, tables.cleaned, dates, day), roles=roles, **options)
    # Ranking leaves the rows of a snapshot together.
    write_snapshots(board, tables.leaderboard, day, contract="leaderboard", arranged=True, **written)
    current = find_table(spark, tables.trends, day)
    if current is None:
        changed = trends(cleaned, roles)
    else:
        changed = trends_after(cleaned, current, dates, roles)
    write_snapshots(changed, tables.trends, day, contract="trends", **written)


def verification(spark: SparkSession, tables: Tables, dates: list[dt.date],
                 roles: Roles = DEFAULT_ROLES) -> dict[str, int]:
    """What a load left behind: rows and snapshots of its dates, and nulls where none may be."""
    rows = read_dates(spark, tables.cleaned, dates, roles.snapshot_date, merge_schema=True)
    summary = table_summary(rows, roles.snapshot_date).first()
    nulls = null_violations(rows, contract_for("cleaned", roles)).where("nulls > 0")
    return {
        "n_rows": summary.n_rows, "n_snapshots": summary.n_snapshots,
        **{f"{row.column_name} null": row.nulls for row in nulls.collect()},
    }


def run_daily(
    spark: SparkSession,
    landing_path: str,
    tables: Tables,
    chain: Chain,
    date: dt.date | None = None,
    multi_line: bool = True,
) -> Load:
    """Load the landing files, of one date or all, into the tables."""
    envelopes = landing.read_landing(spark, landing_path, multi_line)
    if date is not None:
        # Undated files belong to no date; they are told with every load.
        day = F.col("snapshot_date")
        envelopes = envelopes.where(day.isNull() | (day == F.lit(date)))
    return load_envelopes(envelopes, tables, chain)
