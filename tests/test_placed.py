import datetime as dt
import os
import random
import uuid

import pytest
from conftest import SNAPSHOT, as_set, day_of

from fieldrank.operators.trends import trends
from fieldrank.sources import placed


def field(spark, seed, days=range(1, 80)):
    rng = random.Random(seed)
    rows = [
        (f"id {n}", f"name {n}", "g", day_of(day), float(rng.randrange(9)), None, 1.0, 2.0)
        for day in days for n in range(12) if n == 0 or rng.random() < 0.5
    ]
    return spark.createDataFrame(rows, SNAPSHOT)


@pytest.fixture
def table(spark):
    name = f"placed_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def test_trends_without_an_exchange(spark, table, tmp_path):
    rows = field(spark, 1)
    placed.place_by_entity(rows, table, str(tmp_path / "t"), 4)
    found = trends(placed.read_placed(spark, table))
    assert as_set(found) == as_set(trends(rows))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    # A bucket of a month is one file.
    assert len(files(tmp_path / "t")) <= 4 * 3


def test_only_touched_months_are_rewritten(spark, table, tmp_path):
    rows, path = field(spark, 2), str(tmp_path / "t")
    placed.place_by_entity(rows, table, path, 3)
    before = files(path)
    changed = [dt.date(2024, 2, 29), dt.date(2024, 5, 1)]
    other = field(spark, 3, days=[60, 122])
    now = rows.where("snapshot_date <> '2024-02-29'").unionByName(other)
    placed.refresh_placed(now, table, changed)
    assert as_set(placed.read_placed(spark, table)) == as_set(now)
    after = files(path)
    kept = {name: at for name, at in before.items() if "period=2024-02" not in name}
    assert kept.items() <= after.items()
    assert any("period=2024-05" in name for name in after)
    plan = trends(placed.read_placed(spark, table))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    placed.refresh_placed(now, table, [])
    assert files(path) == after


def test_look_ups_skip_row_groups(spark, table, tmp_path):
    """An id between the others, which bounds of the files cannot rule out."""
    placed.place_by_entity(field(spark, 4), table, str(tmp_path / "t"), 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for entity, some in (("id 5x", False), ("id 5", True)):
            asked = placed.read_placed(spark, table).where(f"entity_id = '{entity}'")
            assert bool(asked._jdf.queryExecution().executedPlan().executeCollect()) is some
            plan = asked._jdf.queryExecution().executedPlan()
            plan.executeCollect()
            scan = plan.collectLeaves().head()
            assert (scan.metrics().apply("numOutputRows").value() > 0) is some
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
