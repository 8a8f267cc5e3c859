"""The registered queries. Each runs over whole stored or given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.contracts import CLEANED, null_violations
from fieldrank.materialise import scratch_folder
from fieldrank.operators import cleaning, movements, reports, scoring, statistics
from fieldrank.operators import snapshots as slices
from fieldrank.operators.ranking import number_rows
from fieldrank.operators.scoring import Scaling, Weights
from fieldrank.operators.trends import trends, trends_after, with_previous
from fieldrank.plans.daily import Chain, Tables, run_daily
from fieldrank.roles import DEFAULT_ROLES as R
from fieldrank.roles import Roles
from fieldrank.sources import landing, store
from fieldrank.streaming.ingest import ingest_available
from workload import fixtures as fx
from workload import timelines

Query = Callable[[SparkSession, str], DataFrame]

DAY = dt.date(1998, 6, 1)
RELOADED = dt.date(1997, 3, 1)
# Snapshots above this size take the two-pass numbering in the *_two_pass queries.
SMALL = 80

# Digits to which values are compared that depend on the order of addition or
# on the engine's logarithm and root.
DIGITS = 6

WEIGHTINGS = {
    "balanced": Weights(),
    "fast": Weights(quality=0.25, speed=0.5, price=0.25),
    "cheap": Weights(quality=0.25, speed=0.25, price=0.5),
}


def _eligible(spark, sf_dir) -> DataFrame:
    return statistics.with_mean_price(scoring.scorable(fx.snapshots(spark, sf_dir)))


def _scored(spark, sf_dir, **options) -> DataFrame:
    return scoring.scored(fx.snapshots(spark, sf_dir), **options)[0]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in columns})


# Landing and cleaning

def flatten_nested(spark, sf_dir):
    return landing.flatten(fx.part_records(spark, sf_dir), keep_origin=False).drop("evaluations")


def map_spread(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "map<string,string>").alias("props")
    )
    return landing.spread_map(events, "props")


def measurements_spread(spark, sf_dir):
    flat = landing.flatten(fx.part_records(spark, sf_dir), keep_origin=False)
    spread = landing.spread_map(flat.select("id", "evaluations"), "evaluations")
    return spread.groupBy().agg(*(
        F.count(name).alias(f"{name}_rows") for name in spread.columns if name != "id"
    ))


def landing_read(spark, sf_dir):
    envelopes = landing.read_landing(spark, fx.land_snapshots(spark, sf_dir), multi_line=False)
    rows = landing.flatten(landing.records(envelopes), keep_origin=False)
    return landing.spread_map(rows, "evaluations", ["index"]).drop(
        "release_date", "median_time_to_first_token_seconds", "median_time_to_first_answer_token"
    )


def landing_rejects(spark, sf_dir):
    path = scratch_folder(spark)
    parts = fx.table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") == "ECONOMY", F.lit('{"status": "late"}'))
        .when(F.col("p_type") == "STANDARD", F.concat(F.lit('{"data": ['), "p_name"))
        .otherwise(F.concat(F.lit('{"data": [{"id": "'), F.col("p_name"), F.lit('"}]}')))
        .alias("value")
    )
    parts.write.text(f"{path}/2024-01-02")
    rejects = landing.rejected(landing.read_landing(spark, path, multi_line=False))
    return rejects.groupBy("reason").agg(F.sum("envelopes").alias("envelopes"))


def _short_records(spark, sf_dir):
    return fx.table(spark, sf_dir, "part").select(
        F.to_json(F.struct(
            F.col("p_partkey").cast("string").alias("id"),
            F.col("p_name").alias("slug"),
            F.struct(F.col("p_brand").alias("slug")).alias("model_creator"),
        )).alias("record")
    )


def incomplete_records(spark, sf_dir):
    short = _short_records(spark, sf_dir)
    absent = landing.incomplete_records(short).select(F.explode("missing").alias("key"))
    return absent.groupBy("key").agg(F.count(F.lit(1)).alias("n_records"))


def landing_rows(spark, sf_dir):
    """All columns of all records, with the file's date."""
    envelopes = landing.read_landing(spark, fx.land_snapshots(spark, sf_dir), multi_line=False)
    rows = landing.flatten(landing.records(envelopes), keep_origin=False)
    return landing.spread_map(rows, "evaluations", ["index"])


def measurements_by_row(spark, sf_dir):
    flat = landing.flatten(fx.part_records(spark, sf_dir), keep_origin=False)
    return landing.spread_map(flat.select("id", "evaluations"), "evaluations")


def measurements_long(spark, sf_dir):
    flat = landing.flatten(fx.part_records(spark, sf_dir), keep_origin=False)
    return landing.long_form(flat.select("id", "evaluations"), "evaluations")


def incomplete_by_record(spark, sf_dir):
    found = landing.incomplete_records(_short_records(spark, sf_dir))
    return found.select(
        F.get_json_object("record", "$.id").alias("id"), F.array_join("missing", ",").alias("missing")
    )


ODD_KEYS = ("v2.1", "with space", "tick`s", "Case", "case")


def spread_odd_keys(spark, sf_dir):
    """Measurement keys that are no plain names, through spreading and cleaning."""
    parts = fx.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.lit("2024-01-01").alias("snapshot_date"),
        F.create_map(
            F.element_at(F.array(*map(F.lit, ODD_KEYS)), (F.col("p_partkey") % 5 + 1).cast("int")),
            F.col("p_size").cast("string"),
        ).alias("m"),
    )
    rules = cleaning.CleaningRules(("id", "snapshot_date"), ("id",), dates=("snapshot_date",))
    rows = cleaning.clean(landing.spread_map(parts, "m"), rules)
    return rows.toDF("id", "snapshot_date", *(f"m{i}" for i in range(len(rows.columns) - 2)))


def clean_infinite(spark, sf_dir):
    """Ranks where some speeds are not finite: those rows are not scored."""
    speed = F.when(F.col("speed") % 3 == 0, F.lit("Infinity")).when(
        F.col("speed") % 3 == 1, F.lit("NaN")).otherwise(F.col("speed").cast("string"))
    rows = fx.snapshots(spark, sf_dir).withColumn("speed", speed)
    rules = cleaning.CleaningRules(
        ("entity_id", "snapshot_date"), ("entity_id",), zero_is_missing=("speed",)
    )
    board = scoring.leaderboard(cleaning.clean(rows, rules), exact_cuts=True)
    return board.select("snapshot_date", "entity_id", "rank", "speed_norm", "composite_score")


def identity_rows(spark, sf_dir):
    return cleaning.with_identity(fx.raw_rows(spark, sf_dir), ["id", "slug"])


def sentinel_rows(spark, sf_dir):
    rules = cleaning.CleaningRules((), (), zero_is_missing=("rate", "absent"))
    return cleaning.typed(fx.raw_rows(spark, sf_dir), rules).select(
        "id", "snapshot_date", "delivery", "rate"
    )


def clean_snapshots(spark, sf_dir):
    return cleaning.clean(fx.raw_rows(spark, sf_dir), fx.RAW_RULES)


def dedupe_latest(spark, sf_dir):
    return cleaning.dedupe(fx.raw_rows(spark, sf_dir), ["id", "snapshot_date"], ["delivery"])


def sentinel_to_null(spark, sf_dir):
    rules = cleaning.CleaningRules((), (), zero_is_missing=("rate", "absent"))
    typed = cleaning.typed(fx.raw_rows(spark, sf_dir), rules)
    return typed.groupBy("delivery").agg(
        F.count_if(F.col("rate").isNull()).alias("unmeasured"), F.sum("rate").alias("rate_sum")
    )


def safe_cast(spark, sf_dir):
    rules = cleaning.CleaningRules((), (), numbers=("cost_in", "cost_out"))
    typed = cleaning.typed(fx.raw_rows(spark, sf_dir), rules)
    return typed.select("id", "snapshot_date", "delivery", "cost_in", "cost_out")


def cast_losses(spark, sf_dir):
    return cleaning.cast_losses(fx.raw_rows(spark, sf_dir), fx.RAW_RULES)


def identity_filter(spark, sf_dir):
    return cleaning.with_identity(fx.raw_rows(spark, sf_dir), ["id", "slug"]).groupBy(
        "delivery"
    ).agg(F.count(F.lit(1)).alias("n_rows"))


# Tables

def snapshot_slice(spark, sf_dir):
    return slices.snapshot(fx.snapshots(spark, sf_dir), DAY)


def table_health(spark, sf_dir):
    return store.table_health(fx.snapshots(spark, sf_dir), R.metrics)


def table_summary(spark, sf_dir):
    return store.table_summary(fx.snapshots(spark, sf_dir))


def null_check(spark, sf_dir):
    return null_violations(fx.snapshots(spark, sf_dir), CLEANED)


def _reloaded(spark, sf_dir) -> str:
    root = scratch_folder(spark)
    rows = fx.snapshots(spark, sf_dir)
    store.write_snapshots(rows, root)
    change = slices.snapshot(rows, RELOADED).where(F.col("price_in") < 0.05)
    store.write_snapshots(change.withColumn("quality", F.col("quality") + 100.0), root)
    store.write_snapshots(rows.where(F.lit(False)), root)
    return root


def partition_reload(spark, sf_dir):
    return store.read_snapshots(spark, _reloaded(spark, sf_dir))


def load_audit(spark, sf_dir):
    history = store.load_history(spark, _reloaded(spark, sf_dir))
    return history.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("loads"), F.max_by("n_rows", "loaded_at").alias("n_rows")
    )


def merged_schema(spark, sf_dir):
    root = scratch_folder(spark)
    rows = fx.snapshots(spark, sf_dir)
    store.write_snapshots(rows.where(F.col(R.snapshot_date) < F.lit(DAY)).drop("speed"), root)
    store.write_snapshots(rows.where(F.col(R.snapshot_date) >= F.lit(DAY)), root)
    return store.read_snapshots(spark, root, merge_schema=True)


def merged_frames(spark, sf_dir):
    rows = fx.snapshots(spark, sf_dir)
    return store.merged(
        rows.where(F.col(R.snapshot_date) < F.lit(DAY)).drop("speed"),
        rows.where(F.col(R.snapshot_date) >= F.lit(DAY)),
    )


# Scoring

def scorable_filter(spark, sf_dir):
    return _eligible(spark, sf_dir)


def snapshot_stats(spark, sf_dir):
    return statistics.summarise(_eligible(spark, sf_dir), cuts=None)


def _quantiles(spark, sf_dir, window_rows=None):
    rows = _eligible(spark, sf_dir)
    return statistics.exact_quantiles(
        rows, "mean_price", statistics.TIER_CUTS, ("tier_low", "tier_mid"),
        statistics.measure(rows, cuts=None), window_rows=window_rows,
    )


def price_quantiles_exact(spark, sf_dir):
    return _quantiles(spark, sf_dir)


def price_quantiles_two_pass(spark, sf_dir):
    return _quantiles(spark, sf_dir, SMALL)


def price_quantiles_approx(spark, sf_dir):
    """Share of snapshots whose approximate cut points are within the rank error."""
    rows = _eligible(spark, sf_dir)
    cuts = statistics.summarise(rows).select("snapshot_date", "n_rows", "tier_low", "tier_mid")
    checks = rows.join(cuts, "snapshot_date").groupBy("snapshot_date", "n_rows")
    price = F.col("mean_price")
    counts = checks.agg(*(
        agg.alias(f"{cut}_{name}")
        for cut in ("tier_low", "tier_mid")
        for name, agg in (
            ("below", F.count_if(price < F.col(cut))), ("upto", F.count_if(price <= F.col(cut)))
        )
    ))
    def within(cut, share):
        slack = F.col("n_rows") * statistics.RANK_ERROR + 1
        target = F.col("n_rows") * share
        return (F.col(f"{cut}_below") <= target + slack) & (F.col(f"{cut}_upto") >= target - slack)
    return counts.agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count_if(within("tier_low", 0.33) & within("tier_mid", 0.66)).alias("within_error"),
    )


def minmax_norm(spark, sf_dir):
    return _scored(spark, sf_dir, cuts=None).select(
        "entity_id", "snapshot_date", "quality_norm", "speed_norm"
    )


def inverse_norm(spark, sf_dir):
    return _scored(spark, sf_dir, cuts=None).select("entity_id", "snapshot_date", "price_norm")


def composite_score(spark, sf_dir):
    return _scored(spark, sf_dir, cuts=None).select(
        "entity_id", "snapshot_date", "composite_score"
    )


def _ranked(spark, sf_dir, column, out, window_rows=None):
    rows, stats = scoring.scored(fx.snapshots(spark, sf_dir), cuts=None)
    narrow = rows.select("entity_id", "snapshot_date", column, statistics.SIZE)
    return number_rows(
        narrow, ["snapshot_date"], {out: scoring.rank_order(column)},
        statistics.SIZE, stats.largest, window_rows,
    ).drop(statistics.SIZE)


def composite_rank(spark, sf_dir):
    return _ranked(spark, sf_dir, "composite_score", "rank")


def composite_rank_two_pass(spark, sf_dir):
    return _ranked(spark, sf_dir, "composite_score", "rank", SMALL)


def value_ratio(spark, sf_dir):
    return _eligible(spark, sf_dir).select(
        "entity_id", "snapshot_date", scoring.value_ratio().alias("value_ratio")
    )


def efficiency_rank(spark, sf_dir):
    return _ranked(spark, sf_dir, "value_ratio", "efficiency_rank")


def cost_tier(spark, sf_dir):
    return _scored(spark, sf_dir, exact_cuts=True).select(
        "entity_id", "snapshot_date", "cost_tier"
    )


def leaderboard(spark, sf_dir):
    return scoring.leaderboard(fx.snapshots(spark, sf_dir), exact_cuts=True)


def leaderboard_two_pass(spark, sf_dir):
    return scoring.leaderboard(fx.snapshots(spark, sf_dir), exact_cuts=True, window_rows=SMALL)


def leaderboard_approx(spark, sf_dir):
    """The default leaderboard; its tiers depend on approximate cut points."""
    return scoring.leaderboard(fx.snapshots(spark, sf_dir)).drop("cost_tier")


def written_two_pass_board(spark, sf_dir):
    """The two-pass board through the contract of its table."""
    root = scratch_folder(spark)
    board = scoring.leaderboard(fx.snapshots(spark, sf_dir), exact_cuts=True, window_rows=SMALL)
    store.write_snapshots(board, root, contract="leaderboard")
    return store.read_snapshots(spark, root)


# Trends

def previous_values(spark, sf_dir):
    rows = statistics.with_mean_price(fx.snapshots(spark, sf_dir))
    return with_previous(rows).select(
        "entity_id", "snapshot_date", "prev_snapshot_date",
        "quality_previous", "speed_previous", "price_previous",
    )


def trends_full(spark, sf_dir):
    return trends(fx.snapshots(spark, sf_dir))


def trends_gaps(spark, sf_dir):
    return trends(fx.daily_events(spark, sf_dir))


def trends_incremental(spark, sf_dir):
    """Reload one date in the middle, refresh what it touches, read the table."""
    rows = fx.snapshots(spark, sf_dir)
    root = scratch_folder(spark)
    store.write_snapshots(trends(rows), root, contract="trends")
    after = store.read_snapshots(spark, _reloaded(spark, sf_dir))
    current = store.read_snapshots(spark, root)
    store.write_snapshots(trends_after(after, current, [RELOADED]), root, contract="trends")
    return store.read_snapshots(spark, root)


def trends_two_reloads(spark, sf_dir):
    """An early and a late date are reloaded with fewer entities, then the early
    one with all of them again."""
    rows = fx.snapshots(spark, sf_dir)
    root, table = scratch_folder(spark), scratch_folder(spark)
    store.write_snapshots(rows, root)
    store.write_snapshots(trends(rows), table, contract="trends")
    both = rows.where(F.col(R.snapshot_date).isin(RELOADED, DAY))
    fewer = both.where(F.col("entity_id").cast("int") % 3 != 0)
    steps = (
        (fewer.withColumn("quality", F.col("quality") + 100.0), [RELOADED, DAY]),
        (both.where(F.col(R.snapshot_date) == F.lit(RELOADED)), [RELOADED]),
    )
    for change, dates in steps:
        store.write_snapshots(change, root)
        after, current = store.read_snapshots(spark, root), store.read_snapshots(spark, table)
        store.write_snapshots(trends_after(after, current, dates), table, contract="trends")
    return store.read_snapshots(spark, table)


# Reports

def latest_snapshot(spark, sf_dir):
    return store.read_latest(spark, fx.snapshots_root(spark, sf_dir))


def latest_of_frame(spark, sf_dir):
    return slices.latest_snapshot(fx.snapshots(spark, sf_dir))


def asof_snapshot(spark, sf_dir):
    return slices.as_of(fx.snapshots(spark, sf_dir), DAY)


def asof_events(spark, sf_dir):
    return slices.as_of(fx.daily_events(spark, sf_dir), "2024-01-15")


def best_overall(spark, sf_dir):
    return reports.best_overall(fx.board(spark, sf_dir))


def best_value(spark, sf_dir):
    return reports.best_value(fx.board(spark, sf_dir))


def top_n(spark, sf_dir):
    return reports.top_n(fx.board(spark, sf_dir), DAY)


def top_n_per_snapshot(spark, sf_dir):
    return reports.top_n_per_snapshot(fx.board(spark, sf_dir))


def ever_top_n(spark, sf_dir):
    board = fx.board(spark, sf_dir)
    return reports.series(reports.ever_top_n(board, 1, "entity_name"))


def ever_top_five(spark, sf_dir):
    return reports.series(reports.ever_top_n(fx.board(spark, sf_dir), 5, "entity_name"))


def ever_top_five_ids(spark, sf_dir):
    return reports.series(reports.ever_top_n(fx.board(spark, sf_dir), 5, "entity_id"))


def tier_summary(spark, sf_dir):
    summary = reports.tier_summary(fx.board(spark, sf_dir))
    return summary.withColumns({
        "price_avg": F.round("price_avg", 12), "quality_norm_avg": F.round("quality_norm_avg", 9)
    })


# Other scalings, movements

def percent_rank_norm(spark, sf_dir):
    return _scored(spark, sf_dir, cuts=None, scaling=Scaling("percent_rank")).select(
        "entity_id", "snapshot_date", "quality_norm", "speed_norm", "price_norm"
    )


def percent_rank_two_pass(spark, sf_dir):
    return _scored(
        spark, sf_dir, cuts=None, scaling=Scaling("percent_rank"), window_rows=SMALL
    ).select("entity_id", "snapshot_date", "quality_norm", "speed_norm", "price_norm")


def zscore_clip_norm(spark, sf_dir):
    rows = _scored(spark, sf_dir, cuts=None, scaling=Scaling("z_score", clip=2.0)).select(
        "entity_id", "snapshot_date", "quality_norm", "speed_norm", "price_norm"
    )
    return _rounded(rows, "quality_norm", "speed_norm", "price_norm")


def log_price_norm(spark, sf_dir):
    rows = _scored(spark, sf_dir, cuts=None, scaling=Scaling(log_price=True)).select(
        "entity_id", "snapshot_date", "price_norm"
    )
    return _rounded(rows, "price_norm")


def reweighted_winner(spark, sf_dir):
    return movements.reweighted_winner(fx.board(spark, sf_dir), WEIGHTINGS)


def rank_movement(spark, sf_dir):
    return movements.rank_movement(fx.board(spark, sf_dir))


def entered_dropped(spark, sf_dir):
    return movements.entered_dropped(fx.board(spark, sf_dir))


# Incremental loading

def _ingested(spark, sf_dir) -> Tables:
    tables = Tables(scratch_folder(spark))
    chain = Chain(landing.record_rules("index"), keys=["index"])
    ingest_available(
        spark, fx.land_snapshots(spark, sf_dir), tables, chain,
        checkpoint=f"{tables.root}/_stream", multi_line=False,
    )
    return tables


def flat_table(spark, sf_dir):
    """The flat table that a load leaves, without the origin of its rows."""
    return store.read_snapshots(spark, _ingested(spark, sf_dir).flat).drop("file_path", "file_time")


def _loaded(spark, sf_dir, lines: DataFrame, chain: Chain, days=None) -> Tables:
    """Loads ``lines`` (``value`` per ``snapshot_date``), all at once or day by day."""
    path, tables = scratch_folder(spark), Tables(scratch_folder(spark))
    lines.write.partitionBy("snapshot_date").text(path)
    for day in days or [None]:
        run_daily(spark, path, tables, chain, day, multi_line=False)
    return tables


INDEX = Chain(landing.record_rules("index"), exact_cuts=True)


def chain_parts(spark, sf_dir):
    """Several files of a date complete each other without being asked to."""
    lines = fx.snapshot_lines(spark, sf_dir).repartition(3)
    tables = _loaded(spark, sf_dir, lines, INDEX)
    return store.read_snapshots(spark, tables.cleaned).select(*R.columns)


def chain_rejects(spark, sf_dir):
    """What a load could not use, by its date and reason."""
    bad = F.pmod(F.col("entity_id").cast("int"), F.lit(4))
    lines = fx.snapshot_lines(spark, sf_dir, "entity_id").withColumn(
        "value", F.when(bad == 0, F.lit("{")).when(bad == 1, F.lit('{"status": 1}'))
        .otherwise(F.col("value")))
    tables = _loaded(spark, sf_dir, lines.drop("entity_id"), INDEX)
    day = F.regexp_extract("file_path", r"(\d{4}-\d\d-\d\d)", 1).cast("date")
    return spark.read.parquet(tables.rejects).groupBy(
        day.alias("snapshot_date"), "reason"
    ).agg(F.sum("envelopes").alias("envelopes"))


def chain_without_quality(spark, sf_dir):
    """One day, loaded alone, has no quality: it is stored and has no ranks."""
    lines = fx.snapshot_lines(spark, sf_dir).where(F.col(R.snapshot_date).isin(RELOADED, DAY))
    renamed = F.replace(F.col("value"), F.lit('"index"'), F.lit('"other"'))
    lines = lines.withColumn(
        "value", F.when(F.col(R.snapshot_date) == F.lit(DAY), renamed).otherwise(F.col("value")))
    tables = _loaded(spark, sf_dir, lines, INDEX, [DAY, RELOADED])
    cleaned = store.read_snapshots(spark, tables.cleaned, merge_schema=True)
    board = store.read_snapshots(spark, tables.leaderboard)
    ranks = board.select("entity_id", "snapshot_date", "rank")
    return cleaned.select(*R.columns).join(ranks, ["entity_id", "snapshot_date"], "left")


def chain_other_names(spark, sf_dir):
    """An installation with column names, weights and scaling of its own."""
    roles = Roles(entity_id="key", entity_name="label", quality="merit", price_in="cost in")
    chain = Chain(
        landing.record_rules("index", roles=roles), roles=roles, weights=WEIGHTINGS["fast"],
        exact_cuts=True,
    )
    tables = _loaded(spark, sf_dir, fx.snapshot_lines(spark, sf_dir), chain)
    board = store.read_snapshots(spark, tables.leaderboard)
    return board.select("key", "label", "snapshot_date", "rank", "composite_score", "cost_tier")


def chain_other_date(spark, sf_dir):
    """An installation whose date column has another name, loaded twice: trends."""
    roles = Roles(snapshot_date="day")
    chain = Chain(landing.record_rules("index", roles=roles), roles=roles, exact_cuts=True)
    tables = _loaded(spark, sf_dir, fx.snapshot_lines(spark, sf_dir), chain)
    return store.read_snapshots(spark, tables.trends, day="day")


def repeated_load(spark, sf_dir):
    """The same landing files loaded twice: the lines of rejects and load histories."""
    bad = F.col("entity_id").cast("int") % 4 == 0
    lines = fx.snapshot_lines(spark, sf_dir, "entity_id").withColumn(
        "value", F.when(bad, F.lit("{")).otherwise(F.col("value")))
    path, tables = scratch_folder(spark), Tables(scratch_folder(spark))
    lines.drop("entity_id").write.partitionBy("snapshot_date").text(path)
    for _ in range(2):
        run_daily(spark, path, tables, INDEX, multi_line=False)
    rejects = spark.read.parquet(tables.rejects).agg(
        F.sum("envelopes").alias("envelopes"), F.count_distinct("load_id").alias("reject_loads")
    )
    loads = [
        store.load_history(spark, root).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_lines"),
            F.sum("n_rows").alias("n_rows"), F.max("version").cast("bigint").alias("last_version"),
        )
        for name, root in (("flat", tables.flat), ("cleaned", tables.cleaned))
    ]
    return loads[0].union(loads[1]).crossJoin(F.broadcast(rejects))  # one row


_streamed: dict[tuple[str, str], Tables] = {}


def _corrected(spark, sf_dir) -> Tables:
    """The stream after a second batch that corrects one date, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _streamed:
        _streamed[key] = _stream_with_correction(spark, sf_dir)
    return _streamed[key]


def _stream_with_correction(spark, sf_dir) -> Tables:
    path, tables = scratch_folder(spark), Tables(scratch_folder(spark))
    lines = fx.snapshot_lines(spark, sf_dir, "entity_id")
    changed = (F.col(R.snapshot_date) == F.lit(RELOADED)) & (F.col("entity_id").cast("int") % 2 == 0)
    fix = F.regexp_replace("value", r'"index":[0-9.]+', '"index":1.0')
    chain = Chain(landing.record_rules("index"), keys=["index"], exact_cuts=True)
    for batch in (lines, lines.where(changed).withColumn("value", fix)):
        batch.drop("entity_id").write.mode("append").partitionBy("snapshot_date").text(
            path, compression="gzip"
        )
        ingest_available(spark, path, tables, chain, f"{tables.root}/_stream", multi_line=False)
    return tables


def stream_correction(spark, sf_dir):
    return store.read_snapshots(spark, _corrected(spark, sf_dir).trends)


def stream_correction_board(spark, sf_dir):
    return store.read_snapshots(spark, _corrected(spark, sf_dir).leaderboard)


def stream_ingest(spark, sf_dir):
    tables = _ingested(spark, sf_dir)
    return store.read_snapshots(spark, tables.cleaned).select(*R.columns)


def stream_trends(spark, sf_dir):
    return store.read_snapshots(spark, _ingested(spark, sf_dir).trends)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        flatten_nested, map_spread, measurements_spread, landing_read, landing_rejects,
        incomplete_records, clean_snapshots, dedupe_latest, sentinel_to_null, safe_cast,
        cast_losses, identity_filter, snapshot_slice, table_health, table_summary, null_check,
        partition_reload, load_audit, merged_schema, merged_frames, scorable_filter,
        snapshot_stats, price_quantiles_exact, price_quantiles_two_pass, price_quantiles_approx,
        minmax_norm, inverse_norm, composite_score, composite_rank, composite_rank_two_pass,
        value_ratio, efficiency_rank, cost_tier, leaderboard, leaderboard_two_pass,
        leaderboard_approx, previous_values, trends_full, trends_gaps, trends_incremental,
        latest_snapshot, asof_snapshot, asof_events, best_overall, best_value, top_n,
        top_n_per_snapshot, ever_top_n, tier_summary, percent_rank_norm, percent_rank_two_pass,
        zscore_clip_norm, log_price_norm, reweighted_winner, rank_movement, entered_dropped,
        stream_ingest, stream_trends, latest_of_frame, landing_rows, measurements_by_row,
        measurements_long, incomplete_by_record, spread_odd_keys, clean_infinite, identity_rows,
        sentinel_rows, written_two_pass_board, trends_two_reloads, ever_top_five,
        ever_top_five_ids, flat_table, chain_parts, chain_rejects, chain_without_quality,
        chain_other_names, chain_other_date, repeated_load, stream_correction,
        stream_correction_board,
    )
}

QUERIES |= timelines.QUERIES
