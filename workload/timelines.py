"""Queries over time: as-of joins, states per date, correction history, skylines."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from fieldrank.materialise import materialise, scratch_folder
from fieldrank.operators.asof import asof_join
from fieldrank.operators.calendar import calendar_windows, windows_after
from fieldrank.operators.correlation import rank_correlation
from fieldrank.operators.renames import renamed_entities
from fieldrank.operators.skyline import skyline
from fieldrank.operators.spells import spells, spells_after
from fieldrank.operators.statistics import with_mean_price
from fieldrank.operators.trends import trends
from fieldrank.roles import DEFAULT_ROLES as R
from fieldrank.sources import history, landing, placed, states, store, variants
from fieldrank.streaming import changes
from workload import fixtures as fx

# Largest rank error that the sketches may show in the queries.
RANK_ERROR = 0.02
CUTS = [0.1, 0.5, 0.9]


def asof_purchases(spark, sf_dir):
    """Each event with the user's newest purchase of the last six hours."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    bought = fx.table(spark, sf_dir, "events").where("event_type = 'purchase'").select(
        F.col("user_id").alias("buyer"), F.col("ts").alias("bought"),
        F.col("event_id").alias("purchase_id"), F.col("value").alias("amount"),
    )
    return asof_join(
        events, bought, {"user_id": "buyer"}, "ts", "bought", ["purchase_id", "amount"],
        F.expr("INTERVAL 6 HOURS"), "bought_at",
    )


def asof_orders(spark, sf_dir):
    """Each order with the customer's newest snapshot-sized order before it: ties by date."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    urgent = fx.table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(
        "o_custkey", "o_orderdate", F.col("o_orderkey").alias("urgent_key")
    )
    return asof_join(
        orders, urgent, {"o_custkey": "o_custkey"}, "o_orderdate", "o_orderdate", ["urgent_key"],
        matched_time="urgent_date",
    )


_roots: dict[tuple[str, str], str] = {}


def _daily_states(spark, sf_dir):
    """States of the daily events, written, with the first day reloaded once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots:
        root, rows = scratch_folder(spark), scratch_folder(spark)
        store.write_snapshots(fx.daily_events(spark, sf_dir), rows)
        states.write_states(states.date_states(store.read_snapshots(spark, rows), ["quality"]), root)
        days = store.stored_dates(spark, rows)[:1]
        states.refresh_states(spark, rows, root, days, ["quality"])
        _roots[key] = root
    return states.read_states(spark, _roots[key])


def span_quantiles(spark, sf_dir):
    """Quantiles over 7, 30 and all days from states, held against the rows themselves."""
    stored = _daily_states(spark, sf_dir)
    found = None
    for days in (7, 30, None):
        part = states.span_quantiles(stored, "quality", days, CUTS)
        found = part if found is None else found.union(part)
    spans = found.select(
        R.snapshot_date, "days", "n_values",
        F.posexplode(F.arrays_zip(F.array(*map(F.lit, CUTS)).alias("cut"), F.col("quantiles").alias("q"))),
    ).select(R.snapshot_date, "days", "n_values", "col.cut", "col.q")
    rows = fx.daily_events(spark, sf_dir).select(F.col(R.snapshot_date).alias("_d"), "quality")
    since = F.when(F.col("days").isNull(), F.lit("0001-01-01").cast("date")).otherwise(
        F.date_sub(R.snapshot_date, F.col("days") - 1)
    )
    # Rows are counted per date and value first; spans are few.
    counts = rows.groupBy("_d", "quality").agg(F.count("quality").alias("n"))
    inside = (F.col("_d") <= F.col(R.snapshot_date)) & (F.col("_d") >= since)
    share = F.sum(F.when(F.col("quality") <= F.col("q"), F.col("n")).otherwise(0)) / F.sum("n")
    below = F.sum(F.when(F.col("quality") < F.col("q"), F.col("n")).otherwise(0)) / F.sum("n")
    near = (share >= F.col("cut") - RANK_ERROR) & (below <= F.col("cut") + RANK_ERROR)
    return F.broadcast(spans).join(counts, inside).groupBy(
        R.snapshot_date, "days", "n_values", "cut"
    ).agg(near.alias("near"))


def set_changes(spark, sf_dir):
    """Entities kept, come and gone between dates one and five steps apart, from states."""
    stored = _daily_states(spark, sf_dir)
    pairs = states.neighbour_dates(stored, 1).union(states.neighbour_dates(stored, 5))
    return states.set_changes(stored, pairs)


def month_entities(spark, sf_dir):
    return states.span_entities(_daily_states(spark, sf_dir))


_corrections: dict[tuple[str, str], str] = {}


def _corrected(spark, sf_dir):
    """Three loads: all months, then 1997 with other values and fewer rows, then half of
    1997 as it was; the second and third come twice."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _corrections:
        root = scratch_folder(spark)
        rows = fx.snapshots(spark, sf_dir).select("entity_id", "snapshot_date", "quality", "price_in")
        number = F.col("entity_id").cast("int")
        year = rows.where("year(snapshot_date) = 1997")
        second = year.where(number % 7 != 0).withColumn(
            "quality", F.when(number % 2 == 0, F.col("quality") + 1).otherwise(F.col("quality"))
        )
        third = year.where("month(snapshot_date) <= 6")
        for load, batch in ((1, rows), (2, second), (2, second), (3, third), (3, third)):
            history.record_load(spark, root, batch, load, ["entity_id"])
        _corrections[key] = root
    return history.read_history(spark, _corrections[key])


def correction_history(spark, sf_dir):
    return _corrected(spark, sf_dir)


def known_at_load(spark, sf_dir):
    return history.known_at(_corrected(spark, sf_dir), 2)


def price_skyline(spark, sf_dir):
    """Suppliers that no other one beats in price and quality, per month."""
    rows = with_mean_price(fx.snapshots(spark, sf_dir))
    return skyline(rows, "mean_price", R.quality, R.snapshot_date).select(
        "entity_id", "snapshot_date", "mean_price", "quality"
    )


def order_skyline(spark, sf_dir):
    """The same over single line items: no snapshot has fewer than thousands of rows."""
    items = fx.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    return skyline(items, "l_extendedprice", "l_quantity", "l_returnflag")


def presence_spells(spark, sf_dir):
    return spells(fx.daily_events(spark, sf_dir))


def spells_incremental(spark, sf_dir):
    """Spells before three days came or were corrected, brought up to date."""
    rows = fx.daily_events(spark, sf_dir)
    changed = [dt.date(2024, 1, day) for day in (1, 9, 10, 20)]
    number = F.dayofmonth(R.snapshot_date)
    # Before, day 9 was not there, days 1 and 10 had fewer users, day 20 others.
    user = F.col("entity_id").cast("int")
    before = rows.where((number != 9) & ~(number.isin(1, 10) & (user % 3 == 0)) & ~((number == 20) & (user % 2 == 0)))
    return spells_after(rows, materialise(spells(before)).df, changed)


def rank_agreement(spark, sf_dir):
    """How far the ranks of each month agree with those of the month before."""
    return _rounded(rank_correlation(fx.board(spark, sf_dir), "rank"))


def tied_agreement(spark, sf_dir):
    """The same of counts with many ties, five days apart, in ranges of 50 values."""
    return _rounded(rank_correlation(
        fx.daily_events(spark, sf_dir).withColumn("quality", F.floor(F.col("quality") / 2)),
        "quality", steps=5, rows_per_range=50,
    ))


def _rounded(df):
    # A little beside the ties, which each engine rounds by its own last bit.
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(F.col(name) + 3e-10, 6) + F.lit(0.0) for name in doubles})


def event_windows(spark, sf_dir):
    """Means, volatility and slopes of users over 7 and 30 days."""
    return _rounded(calendar_windows(fx.daily_events(spark, sf_dir), ["quality", "speed"]))


def windows_incremental(spark, sf_dir):
    """The window table of suppliers by month, after three months came or were corrected."""
    rows, days = fx.snapshots(spark, sf_dir), (31, 100)
    changed = [dt.date(1995, 3, 1), dt.date(1997, 11, 1), dt.date(1998, 1, 1)]
    month, supplier = F.col(R.snapshot_date), F.col("entity_id").cast("int")
    # Before, the first month was not there and the others had other rows.
    before = rows.where((month != changed[0]) & ~(month.isin(changed[1:]) & (supplier % 3 == 0)))
    root = scratch_folder(spark)
    store.write_snapshots(calendar_windows(before, ["quality"], days), root)
    store.write_snapshots(windows_after(rows, changed, ["quality"], days), root)
    return _rounded(store.read_snapshots(spark, root))


_measured: dict[tuple[str, str], str] = {}


def _measured_months(spark, sf_dir):
    """Suppliers by month with an open measurement each, named by the supplier: a number,
    a text where the speed was not measured, a list where the price is zero."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _measured:
        value = (
            F.when(F.col("speed").isNull(), '"none"').when(F.col("price_in") == 0, "[1, 2]")
            .otherwise(F.col("quality").cast("bigint").cast("string"))
        )
        text = F.concat(F.lit('{"supplier '), "entity_id", F.lit('": '), value, F.lit("}"))
        root = scratch_folder(spark)
        variants.write_measured(
            fx.snapshots(spark, sf_dir).select(
                R.snapshot_date, "entity_id", F.parse_json(text).alias(variants.MEASURED)
            ), root,
        )
        _measured[key] = root
    return store.read_snapshots(spark, _measured[key])


def measured_keys(spark, sf_dir):
    """Per month and key of the stored measurements: rows and the kinds of their values."""
    found = variants.key_states(_measured_months(spark, sf_dir).drop("entity_id"))
    return found.withColumn("kinds", F.array_join("kinds", ","))


def measured_drift(spark, sf_dir):
    """Keys that come, go, return or change their kind from month to month."""
    found = variants.drift(variants.key_states(_measured_months(spark, sf_dir)))
    return found.withColumns({
        name: F.array_join(name, ",") for name in ("kinds_before", "kinds_now")
    })


def measured_landing(spark, sf_dir):
    """Measurements of landing files, parsed once into VARIANT and read back by key."""
    envelopes = landing.read_landing(spark, fx.land_snapshots(spark, sf_dir), multi_line=False)
    root = scratch_folder(spark)
    variants.write_measured(
        variants.measured_records(landing.records(envelopes)).select("id", R.snapshot_date, variants.MEASURED),
        root,
    )
    return store.read_snapshots(spark, root).groupBy(R.snapshot_date).agg(
        F.count(variants.value_of("index")).alias("n_index"),
        F.sum(variants.value_of("index")).alias("index_total"),
        F.count(variants.value_of("absent")).alias("n_absent"),
    )


def placed_trends(spark, sf_dir):
    """Trends of the whole table placed by supplier, after three months were corrected:
    the window reads the buckets as they lie."""
    rows, table = fx.snapshots(spark, sf_dir), f"placed_{uuid.uuid4().hex}"
    changed = [dt.date(1995, 3, 1), dt.date(1997, 11, 1), dt.date(1998, 12, 1)]
    month, supplier = F.col(R.snapshot_date), F.col("entity_id").cast("int")
    before = rows.where((month != changed[0]) & ~(month.isin(changed[1:]) & (supplier % 3 == 0)))
    placed.place_by_entity(before, table, scratch_folder(spark), 8)
    placed.refresh_placed(rows, table, changed)
    return trends(placed.read_placed(spark, table))


def _with_new_ids(rows):
    """A seventh of the suppliers get another id at a month of their own, and most of
    them a name with up to two edits."""
    supplier, name = F.col("entity_id").cast("int"), F.substring(F.md5("entity_name"), 1, 10)
    since = F.add_months(F.lit(dt.date(1994, 1, 1)), supplier % 48)
    other = (supplier % 7 == 3) & (F.col(R.snapshot_date) >= since)
    edited = (
        F.when(supplier % 4 == 0, F.substring(name, 2, 9))
        .when(supplier % 4 == 1, F.concat(name, F.lit("xy")))
        .when(supplier % 4 == 2, F.concat(F.substring(name, 1, 4), F.lit("-"), F.substring(name, 6, 5)))
        .otherwise(F.upper(name))
    )
    return rows.withColumns({
        "entity_id": F.when(other, F.concat(F.lit("r"), "entity_id")).otherwise(F.col("entity_id")),
        "entity_name": F.when(other, edited).otherwise(name),
    })


def renamed_suppliers(spark, sf_dir):
    """Suppliers that go on under another id."""
    return renamed_entities(_with_new_ids(fx.snapshots(spark, sf_dir)))


def near_named_users(spark, sf_dir):
    """Names that differ in a few digits: most dropped ones have many near ones."""
    return renamed_entities(fx.daily_events(spark, sf_dir), part_names=4)


_streams: dict[tuple[str, str], str] = {}


def state_trends(spark, sf_dir):
    """Trends of the daily events from keyed state: three runs from one checkpoint, days
    out of order, so that the state has late rows, rows left out and forgotten users."""
    key = (spark.sparkContext.applicationId, sf_dir)
    rows = fx.daily_events(spark, sf_dir)
    if key not in _streams:
        source, out, checkpoint = (scratch_folder(spark) for _ in range(3))
        number = F.dayofmonth(R.snapshot_date)
        arrivals = (number <= 6, number.between(12, 18), (number > 6) & ~number.between(12, 18))
        for days in arrivals:
            rows.where(days).write.mode("append").parquet(source)
            stream = spark.readStream.schema(rows.schema).parquet(source)
            changes.stream_changes(stream, out, checkpoint, idle_days=2, late_days=2)
        _streams[key] = out
    return changes.settled(changes.read_changes(spark, _streams[key]), rows)


QUERIES = {
    query.__name__: query
    for query in (
        asof_purchases, asof_orders, span_quantiles, set_changes, month_entities,
        correction_history, known_at_load, price_skyline, order_skyline, state_trends,
        presence_spells, spells_incremental, rank_agreement, tied_agreement, event_windows,
        windows_incremental, measured_keys, measured_drift, measured_landing,
        placed_trends, renamed_suppliers, near_named_users,
    )
}
