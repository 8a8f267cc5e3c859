import random

import pytest
from conftest import as_dicts, as_set, day_of
from pyspark.sql import functions as F

from fieldrank.contracts import check_contract
from fieldrank.materialise import materialise
from fieldrank.operators import trends as trends_module
from fieldrank.operators.trends import trends, trends_after
from fieldrank.roles import DEFAULT_ROLES


def test_previous_is_the_entitys_own_last_row(snapshot_rows):
    rows = snapshot_rows(
        ("a", 1, 10, 5, 1, 1), ("b", 2, 1, 1, 1, 1), ("b", 3, 1, 1, 1, 1), ("a", 4, 13, 4, 2, 4),
    )
    found = trends(rows)
    check_contract(found, "trends")
    first, last = as_dicts(found.where("entity_id = 'a'"), "snapshot_date")
    assert first["prev_snapshot_date"] is None
    assert first["quality_delta"] is None and first["quality_current"] == 10.0
    assert last["prev_snapshot_date"] == day_of(1)
    assert (last["quality_delta"], last["speed_delta"], last["price_delta"]) == (3.0, -1.0, 2.0)
    assert (last["quality_previous"], last["price_current"]) == (10.0, 3.0)


def test_missing_metrics_void_only_their_delta(snapshot_rows):
    rows = snapshot_rows(("a", 1, 10, None, 1, 1), ("a", 2, 12, 5, None, 1), ("a", 3, 11, 6, 0, 0))
    _, second, third = as_dicts(trends(rows), "snapshot_date")
    deltas = [f"{name}_delta" for name in ("quality", "speed", "price")]
    assert [second[name] for name in deltas] == [2.0, None, None]
    assert [third[name] for name in deltas] == [-1.0, 1.0, None]
    assert third["price_current"] == 0.0


def history(snapshot_rows, seed, days, entities=12, presence=0.6):
    dice = random.Random(seed)
    return snapshot_rows(*(
        (f"e{i}", day, dice.randint(1, 50), dice.choice([None, 3, 8]), dice.randint(0, 4), 1)
        for i in range(entities) for day in days if dice.random() < presence
    ))


def test_deltas_add_up(snapshot_rows):
    found = trends(history(snapshot_rows, 1, range(1, 8)))
    sums = found.groupBy("entity_id").agg(
        F.sum("quality_delta").alias("total"),
        F.max_by("quality_current", "snapshot_date").alias("last"),
        F.min_by("quality_current", "snapshot_date").alias("first"), F.count("*").alias("n"),
    ).where("n > 1")
    assert sums.where("total != last - first").count() == 0 and sums.count() > 5


def replaced(table, changed):
    """What the table holds after its touched dates are replaced."""
    dates = changed.select("snapshot_date").distinct()
    return table.join(dates, "snapshot_date", "left_anti").unionByName(changed)


@pytest.mark.parametrize("lookback", [0, 2, 100])
@pytest.mark.parametrize("reloaded", [[1], [4], [9], [2, 3], [3, 8], [9, 10], [10]])
def test_incremental_equals_full(snapshot_rows, reloaded, lookback):
    old = history(snapshot_rows, 2, range(1, 10))
    fresh = history(snapshot_rows, 3, reloaded, presence=0.5)
    days = [day_of(n) for n in reloaded]
    new = old.where(~F.col("snapshot_date").isin(days)).unionByName(fresh)
    current = materialise(trends(old)).df
    changed = trends_after(new, current, days, lookback_days=lookback)
    assert as_set(replaced(current, changed)) == as_set(trends(new))


def rows_written(make):
    """What ``make`` returns, and the rows it wrote for itself."""
    sizes = []
    write = trends_module.materialise

    def counted(df, *args, **options):
        stored = write(df, *args, **options)
        sizes.append(stored.rows)
        return stored

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(trends_module, "materialise", counted)
        return make(), sum(sizes)


def test_a_reload_of_all_dates_looks_for_no_neighbours(snapshot_rows):
    days = range(1, 400, 40)
    rows = history(snapshot_rows, 7, days)
    current = materialise(trends(rows)).df
    found, written = rows_written(lambda: trends_after(rows, current, [*map(day_of, days)]))
    assert as_set(found) == as_set(trends(rows)) and written == 0


@pytest.mark.parametrize("side", [-1, 1])
def test_rows_and_changed_dates_meet_in_a_window(snapshot_rows, side):
    days = range(1, 120, 10)
    rows = history(snapshot_rows, 8, days)
    pairs = rows.select("entity_id", F.col("snapshot_date").alias("_changed"))
    beside = trends_module._beside(rows, pairs, DEFAULT_ROLES, side)
    plan = beside._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" in plan
    seen = {(r.entity_id, r._changed): r.snapshot_date for r in beside.collect()}
    dates = {}
    for row in rows.collect():
        dates.setdefault(row.entity_id, []).append(row.snapshot_date)
    want = {}
    for entity, own in dates.items():
        for at in own:
            others = [d for d in own if (d < at if side < 0 else d > at)]
            if others:
                want[entity, at] = max(others) if side < 0 else min(others)
    assert seen == want


def test_a_correction_reads_the_next_date_not_the_whole_history(snapshot_rows, monkeypatch):
    days = [*range(1, 400, 40)]
    rows = history(snapshot_rows, 9, days, presence=1.0)
    read = []
    beside = trends_module._beside

    def seen(near, *args):
        read.append(near.select("snapshot_date").distinct().count())
        return beside(near, *args)

    monkeypatch.setattr(trends_module, "_beside", seen)
    current = materialise(trends(rows)).df
    changed = trends_after(rows, current, [day_of(days[5])])
    assert as_set(replaced(current, changed)) == as_set(trends(rows))
    assert read == [1, 1]


def test_append_touches_only_its_date(snapshot_rows):
    old = history(snapshot_rows, 4, range(1, 6))
    new = old.unionByName(history(snapshot_rows, 5, [6]))
    changed = trends_after(new, materialise(trends(old)).df, [day_of(6)])
    assert [row[0] for row in changed.select("snapshot_date").distinct().collect()] == [day_of(6)]


def test_no_change_gives_no_rows(snapshot_rows):
    rows = history(snapshot_rows, 6, range(1, 4))
    assert trends_after(rows, trends(rows), []).count() == 0
