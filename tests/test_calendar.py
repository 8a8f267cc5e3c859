import datetime as dt
import random
import statistics
from operator import itemgetter

import pytest
from conftest import day_of

from fieldrank.operators.calendar import calendar_windows, windows_after
from fieldrank.sources import store

SCHEMA = "entity_id string, snapshot_date date, quality double"


def plain(rows, days):
    out = []
    for key, day, _ in rows:
        row = {"entity_id": key, "snapshot_date": day}
        for length in days:
            inside = [
                (d.toordinal(), v) for k, d, v in rows
                if k == key and 0 <= (day - d).days < length and v is not None and v == v
            ]
            values = [v for _, v in inside]
            slope = None
            if len({d for d, _ in inside}) > 1:
                slope = statistics.linear_regression(*zip(*inside)).slope
            row |= {
                f"quality_{length}d_n": len(values),
                f"quality_{length}d_mean": statistics.fmean(values) if values else None,
                f"quality_{length}d_volatility": statistics.stdev(values) if len(values) > 1 else None,
                f"quality_{length}d_slope": slope,
            }
        out.append(row)
    return out



def check(found, expected):
    place = itemgetter("entity_id", "snapshot_date")
    found = sorted((r.asDict() for r in found.collect()), key=place)
    expected = sorted(expected, key=place)
    assert len(found) == len(expected)
    for ours, theirs in zip(found, expected):
        for name, value in theirs.items():
            # Values go up to 1e6, so this is 1e-13 of them.
            want = pytest.approx(value, rel=1e-9, abs=1e-7) if isinstance(value, float) else value
            assert ours[name] == want, name
        assert set(ours) == set(theirs)


def field(seed):
    rng = random.Random(seed)
    values = [None, float("nan"), 1.0, 2.5, -4.0, 1e6, 3.0, 8.0]
    return [
        (key, day_of(n), rng.choice(values))
        for key in "abc" for n in sorted(rng.sample(range(1, 90), 30))
    ]


@pytest.mark.parametrize("seed", range(2))
def test_gaps_nulls_and_repeated_dates(spark, seed):
    rows = field(seed)
    rows += rows[::5] + [("a", rows[0][1], 11.0)]
    found = calendar_windows(spark.createDataFrame(rows, SCHEMA), ["quality"], (3, 7, 30))
    check(found, plain(rows, (3, 7, 30)))


def test_a_constant_value_has_no_spread(spark):
    """After a jump the frames forget the old level wholly."""
    rows = [("a", day_of(n), 1e9 if n < 5 else 0.1) for n in range(1, 30)]
    last = calendar_windows(spark.createDataFrame(rows, SCHEMA), ["quality"], (7,)).where(
        "snapshot_date >= '2024-01-11'"
    ).collect()
    assert {(r.quality_7d_volatility, r.quality_7d_slope) for r in last} == {(0.0, 0.0)}


def test_update_equals_the_whole_table(spark, tmp_path):
    before, root, out = field(5), str(tmp_path / "rows"), str(tmp_path / "windows")
    store.write_snapshots(spark.createDataFrame(before, SCHEMA), root)
    store.write_snapshots(calendar_windows(store.read_snapshots(spark, root), ["quality"]), out)
    day = before[10][1]
    changed = [day, day_of(95)]
    batch = [(key, d, 5.0 + n) for d in changed for n, key in enumerate("bcz")]
    store.write_snapshots(spark.createDataFrame(batch, SCHEMA), root)
    rows = store.read_snapshots(spark, root)
    fresh = windows_after(rows, changed, ["quality"])
    touched = {r.snapshot_date for r in fresh.select("snapshot_date").distinct().collect()}
    assert all(any(dt.timedelta() <= d - c < dt.timedelta(days=30) for c in changed) for d in touched)
    store.write_snapshots(fresh, out)
    after = [r for r in before if r[1] not in changed] + batch
    check(store.read_snapshots(spark, out), plain(after, (7, 30)))


def test_one_exchange_and_pruned_dates(spark, tmp_path):
    root = str(tmp_path / "rows")
    store.write_snapshots(spark.createDataFrame(field(1), SCHEMA), root)
    fresh = windows_after(store.read_snapshots(spark, root), [day_of(40)], ["quality"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_no_rows_and_nothing_changed(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert calendar_windows(empty, ["quality"]).count() == 0
    assert windows_after(spark.createDataFrame(field(0), SCHEMA), [], ["quality"]).count() == 0
