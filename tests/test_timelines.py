import datetime as dt
import os
import random

import pytest
from conftest import as_set
from pyspark.sql import functions as F
from test_plans import plan_of

from fieldrank.operators.asof import asof_join
from fieldrank.operators.running import running
from fieldrank.operators.skyline import skyline
from fieldrank.sources import history, states, store

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def series(rng, n):
    """Half of all rows have one key; nulls, ties and repeated rows."""
    return [
        (None if rng.random() < 0.03 else "hot" if rng.random() < 0.5 else rng.choice("abcdef"),
         None if rng.random() < 0.03 else rng.randint(0, 400), i // 2)
        for i in range(n)
    ]


@pytest.mark.parametrize("tolerance", [None, 5])
def test_asof_join_equals_plain_search(spark, many_tasks, tolerance):
    rng = random.Random(7)
    left, right = series(rng, 600), series(rng, 300)
    expected = []
    for key, time, value in left:
        known = [
            (t, v) for k, t, v in right
            if k is not None and k == key and t is not None and time is not None and t <= time
        ]
        best = max(known, default=None)
        if best and tolerance is not None and time > best[0] + tolerance:
            best = None
        expected.append((key, time, value, *(best or (None, None))))
    schema = "key string, time int, value int"
    joined = asof_join(
        spark.createDataFrame(left, schema),
        spark.createDataFrame(right, "k string, t int, found int"),
        {"key": "k"}, "time", "t", ["found"], None if tolerance is None else F.lit(tolerance),
    )
    assert sorted(map(repr, map(tuple, joined.collect()))) == sorted(map(repr, expected))
    assert any(row[3] is not None for row in expected) and any(row[3] is None for row in expected)


def test_asof_join_of_empty_sides(spark):
    rows = spark.createDataFrame([("a", 1)], "key string, time int")
    none = rows.limit(0).withColumn("x", F.lit(1))
    assert [tuple(r) for r in asof_join(rows, none, {"key": "key"}, "time", "time", ["x"]).collect()] == [
        ("a", 1, None, None)
    ]
    assert asof_join(none, rows.withColumn("y", F.lit(1)), {"key": "key"}, "time", "time", ["y"]).count() == 0


def test_a_hot_group_is_carried_over_many_tasks(spark, many_tasks):
    rows = spark.range(5000).select(
        F.when(F.col("id") < 4500, "hot").otherwise("rare").alias("g"), "id",
        F.when(F.col("id") % 1500 == 7, F.col("id")).alias("v"),
    )
    found = running(rows, ["g"], ["id"], "v", "last")
    wrong = found.where(
        ~F.col("last").eqNullSafe(
            F.when(F.col("id") % 1500 >= 7, F.col("id") - F.col("id") % 1500 + 7)
            .otherwise(F.when(F.col("id") >= 1500, F.col("id") - F.col("id") % 1500 - 1493))
        )
    )
    assert wrong.where("g = 'hot'").count() == 0 and found.count() == 5000
    highest = running(rows.withColumn("v", -F.col("id")), ["g"], ["id"], "v", "top", "max", before_only=True)
    assert highest.where("g = 'hot' and id > 0 and top <> 0").count() == 0
    assert highest.where("top is null").count() == 2
    # The window works inside tasks, and the hot group lies in several of them.
    assert "_task" in plan_of(found)
    placed = rows.repartitionByRange(13, "g", "id").where("g = 'hot'")
    assert placed.select(F.spark_partition_id()).distinct().count() > 5
    with pytest.raises(ValueError, match="kind"):
        running(rows, ["g"], ["id"], "v", "x", "first")


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_skyline_equals_pairwise_comparison(spark, many_tasks, parts):
    rng = random.Random(parts)
    rows = [
        (day(0 if rng.random() < 0.4 else rng.randint(1, 4)), i,
         None if rng.random() < 0.05 else float(rng.randint(0, 30)),
         None if rng.random() < 0.05 else float(rng.randint(0, 30)))
        for i in range(300)
    ]
    # One snapshot in which every point is on the skyline, and repeated points.
    rows += [(day(9), i, float(i // 2), float(i // 2)) for i in range(120)]
    usable = [r for r in rows if r[2] is not None and r[3] is not None]
    expected = [
        a for a in usable
        if not any(b[0] == a[0] and b[2] <= a[2] and b[3] >= a[3] and b[2:] != a[2:] for b in usable)
    ]
    df = spark.createDataFrame(rows, "day date, id int, price double, quality double")
    assert as_set(skyline(df, "price", "quality", "day", parts)) == as_set(
        spark.createDataFrame(expected, df.schema)
    )
    assert len([r for r in expected if r[0] == day(9)]) == 120


@pytest.fixture
def measured(spark, snapshot_rows):
    return snapshot_rows(*[
        (f"e{i}", d, None if i % 50 == 0 else (i * 7919) % 1000, 1, 1, 1)
        for d in range(1, 5) for i in range(100 * d, 100 * d + 3000)
    ])


def test_quantiles_of_spans_come_from_states(spark, measured, tmp_path):
    root = str(tmp_path / "states")
    states.write_states(states.date_states(measured, ["quality"]), root)
    stored = states.read_states(spark, root)
    for days in (1, 3, None):
        for row in states.span_quantiles(stored, "quality", days, [0.05, 0.5, 0.95]).collect():
            first = DAY if days is None else row.snapshot_date - dt.timedelta(days=days - 1)
            values = sorted(
                r.quality for r in measured.where(
                    (F.col("snapshot_date") >= first) & (F.col("snapshot_date") <= row.snapshot_date)
                ).collect() if r.quality is not None
            )
            assert row.n_values == len(values)
            for cut, found in zip([0.05, 0.5, 0.95], row.quantiles):
                share = sum(v <= found for v in values) / len(values)
                assert abs(share - cut) < 0.02
    assert "lineitem" not in plan_of(stored) and "quality double" not in plan_of(stored)


def test_an_unmeasured_date_has_no_quantiles(spark, snapshot_rows):
    rows = snapshot_rows(("a", 1, None, 1, 1, 1), ("a", 2, float("nan"), 1, 1, 1), ("b", 3, 5, 1, 1, 1))
    found = states.span_quantiles(states.date_states(rows, ["quality"]), "quality", 1, [0.5]).collect()
    assert {(r.snapshot_date, r.n_values, tuple(r.quantiles or ())) for r in found} == {
        (day(0), 0, ()), (day(1), 0, ()), (day(2), 1, (5.0,))
    }


def test_sets_of_entities_within_their_error(measured):
    exact = {"kept": 2900, "entered": 100, "dropped": 100}
    for lg, error in ((16, 0), (9, 4 * 3100 / 2 ** 4.5)):
        table = states.date_states(measured, ["quality"], lg_entries=lg)
        rows = states.set_changes(table, states.neighbour_dates(table)).collect()
        assert len(rows) == 3
        for row in rows:
            assert all(abs(row[name] - n) <= error for name, n in exact.items())


def test_a_reload_replaces_the_state_of_its_date_only(spark, measured, tmp_path):
    rows, root = str(tmp_path / "rows"), str(tmp_path / "states")
    store.write_snapshots(measured, rows)
    states.write_states(states.date_states(measured, ["quality"]), root)

    def files():
        return {
            folder: sorted(os.listdir(os.path.join(root, folder)))
            for folder in os.listdir(root) if "=" in folder
        }

    before = files()
    store.write_snapshots(measured.where(F.col("snapshot_date") == day(1)).limit(40), rows)
    states.refresh_states(spark, rows, root, [day(1)], ["quality"])
    after = files()
    assert {f for f in before if before[f] != after[f]} == {f"snapshot_date={day(1)}"}
    counts = {r.snapshot_date: r.n_rows for r in states.read_states(spark, root).collect()}
    assert counts == {day(0): 3000, day(1): 40, day(2): 3000, day(3): 3000}
    states.refresh_states(spark, rows, root, [], ["quality"])


VALUES = "id string, snapshot_date date, v double, w string"


def versions(spark, root):
    return {
        (r.id, r.snapshot_date, r.v, r.known_from, r.known_until)
        for r in history.read_history(spark, root).collect()
    }


def test_correction_history(spark, tmp_path):
    root = str(tmp_path / "history")

    def load(number, *rows):
        df = spark.createDataFrame([(i, day(d), v, None) for i, d, v in rows], VALUES)
        return history.record_load(spark, root, df, number, ["id"])

    assert load(1, ("a", 0, 1.0), ("b", 0, 2.0), ("a", 1, 3.0)) == 3
    assert load(2, ("a", 0, 1.0), ("b", 0, 5.0)) == 2
    assert load(2, ("a", 0, 1.0), ("b", 0, 5.0)) == 0
    assert load(4, ("b", 0, 5.0), ("c", 0, None)) == 2
    assert versions(spark, root) == {
        ("a", day(0), 1.0, 1, 4), ("b", day(0), 2.0, 1, 2), ("b", day(0), 5.0, 2, None),
        ("c", day(0), None, 4, None), ("a", day(1), 3.0, 1, None),
    }
    with pytest.raises(ValueError, match="comes after"):
        load(3, ("b", 0, 7.0))
    # The same load may correct itself; what it had brought leaves no trace.
    load(4, ("b", 0, 5.0), ("c", 0, 9.0))
    assert ("c", day(0), 9.0, 4, None) in versions(spark, root)
    assert not any(v[0] == "c" and v[2] is None for v in versions(spark, root))
    for number, expected in ((1, 3), (2, 3), (4, 3)):
        assert history.known_at(history.read_history(spark, root), number).count() == expected
    assert load(5, ("z", 1, 1.0)) == 2
    assert history.record_load(
        spark, root, spark.createDataFrame([], VALUES), 6, ["id"]
    ) == 0


def test_partitions_without_change_are_not_written(spark, tmp_path):
    root = str(tmp_path / "history")
    rows = spark.createDataFrame([(str(i), day(i % 3), float(i), "x") for i in range(30)], VALUES)
    history.record_load(spark, root, rows, 1, ["id"])
    before = {f: os.listdir(os.path.join(root, f)) for f in os.listdir(root) if "=" in f}
    changed = rows.withColumn("v", F.when(F.col("snapshot_date") == day(2), -1.0).otherwise(F.col("v")))
    history.record_load(spark, root, changed, 2, ["id"])
    after = {f: os.listdir(os.path.join(root, f)) for f in os.listdir(root) if "=" in f}
    assert [f for f in before if before[f] != after[f]] == [f"snapshot_date={day(2)}"]
