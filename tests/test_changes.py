import pytest
from conftest import as_set
from pyspark.sql import functions as F

from fieldrank.operators.trends import trends
from fieldrank.streaming import changes


@pytest.fixture
def feed(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def run(rows, **options):
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        changes.stream_changes(stream, out, checkpoint, **options)
        return changes.read_changes(spark, out)

    return run


def test_state_goes_on_after_a_restart_and_forgets_idle_entities(feed, snapshot_rows):
    first = snapshot_rows(("a", 1, 1, 2, 3, 5), ("b", 1, 4, None, 1, 1), ("b", 2, 6, 1, 1, 1))
    second = snapshot_rows(("a", 3, 5, 1, 1, 1), ("c", 3, 1, 1, 1, 1))
    third = snapshot_rows(("c", 40, 2, 1, 1, 1))
    fourth = snapshot_rows(("a", 41, 9, 1, 1, 1), ("c", 41, 3, 1, 1, 1))
    corrected = snapshot_rows(("c", 41, 7, 1, 1, 1), ("b", 3, 7, 1, 1, 1))
    for part in (first, second):
        found = feed(part, idle_days=5, late_days=1)
    table = first.union(second)
    names = [n for n in found.columns if n not in ("first", "late", "batch")]
    assert as_set(found.select(*names)) == as_set(trends(table).select(*names))
    feed(third, idle_days=5, late_days=1)
    found = feed(fourth, idle_days=5, late_days=1)
    # "a" was away for 38 days, so its last row is forgotten: it is first again.
    assert found.where("entity_id = 'a' and first").count() == 2
    found = feed(corrected, idle_days=5, late_days=1)
    # The correction of the last date is late, the row of day 3 never reached the state.
    assert found.where("late").select("entity_id").collect() == [("c",)]
    assert found.where("entity_id = 'b'").count() == 2
    table = table.union(third).union(fourth.where("entity_id = 'a'")).union(corrected)
    settled = changes.settled(found, table)
    assert as_set(settled) == as_set(trends(table).select(*settled.columns))
    untouched = settled.where(F.col("entity_id") == "z")
    assert untouched.count() == 0
