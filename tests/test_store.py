import pytest
from conftest import as_dicts, as_set, day_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fieldrank.contracts import ContractError
from fieldrank.sources import store


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_first_write_creates_partitions(snapshot_rows, root, tmp_path):
    load = store.write_snapshots(snapshot_rows(("a", 1, 1, 1, 1, 1), ("a", 2, 1, 1, 1, 1)), root)
    assert (load.rows, load.dates) == (2, [day_of(1), day_of(2)])
    folders = {item.name for item in (tmp_path / "table").iterdir() if item.is_dir()}
    assert folders == {"snapshot_date=2024-01-01", "snapshot_date=2024-01-02"}


@pytest.mark.parametrize("arranged", [False, True])
def test_reload_replaces_exactly_its_dates(spark, snapshot_rows, root, arranged):
    rows = snapshot_rows(*((key, day, 1, 1, 1, 1) for key in "abc" for day in (1, 2, 3)))
    store.write_snapshots(rows, root)
    change = snapshot_rows(("a", 1, 9, 1, 1, 1), ("d", 3, 9, 1, 1, 1))
    for _ in range(2):  # twice is the same as once
        store.write_snapshots(change, root, arranged=arranged)
        expected = rows.where("snapshot_date = '2024-01-02'").unionByName(change)
        assert as_set(store.read_snapshots(spark, root)) == as_set(expected)


def test_nothing_to_write_changes_nothing(spark, snapshot_rows, root):
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1))
    store.write_snapshots(rows, root)
    assert store.write_snapshots(rows.where("false"), root) == store.Load(0, [])
    assert store.write_snapshots(rows.where("quality > 5"), root).rows == 0
    assert as_set(store.read_snapshots(spark, root)) == as_set(rows)
    assert store.load_history(spark, root).count() == 1


def test_rows_without_date_are_refused(snapshot_rows, root):
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1)).withColumn(
        "snapshot_date", F.lit(None).cast("date")
    )
    with pytest.raises(Exception, match="row without snapshot_date"):
        store.write_snapshots(rows, root)


def test_history_lists_every_load(spark, snapshot_rows, root):
    store.write_snapshots(snapshot_rows(("a", 1, 1, 1, 1, 1), ("b", 1, 1, 1, 1, 1)), root)
    store.write_snapshots(
        snapshot_rows(("a", 1, 1, 1, 1, 1), ("a", 2, 1, 1, 1, 1)), root, operation="correct"
    )
    found = as_dicts(store.load_history(spark, root), "loaded_at", "snapshot_date")
    assert [(r["operation"], r["snapshot_date"], r["n_rows"]) for r in found] == [
        ("replace dates", day_of(1), 2), ("correct", day_of(1), 1), ("correct", day_of(2), 1),
    ]
    assert [r["version"] for r in found] == [0, 1, 1]


def test_contract_is_checked_before_writing(spark, snapshot_rows, root):
    with pytest.raises(ContractError):
        store.write_snapshots(snapshot_rows(("a", 1, 1, 1, 1, 1)), root, contract="trends")
    with pytest.raises(ContractError, match="tags array<string>"):
        store.write_snapshots(
            snapshot_rows(("a", 1, 1, 1, 1, 1)).withColumn("tags", F.array(F.lit("x"))), root
        )
    assert store.find_table(spark, root) is None


def test_missing_table(spark, root):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        store.read_snapshots(spark, root)


def test_columns_may_come_and_go(spark, snapshot_rows, root):
    store.write_snapshots(snapshot_rows(("a", 1, 1, 1, 1, 1)).drop("speed"), root)
    newer = snapshot_rows(("a", 2, 1, 1, 1, 1)).withColumn("eval_new", F.lit(3.0))
    store.write_snapshots(newer, root)
    merged = store.read_snapshots(spark, root, merge_schema=True)
    first, second = as_dicts(merged, "snapshot_date")
    assert (first["speed"], first["eval_new"]) == (None, None)
    assert (second["speed"], second["eval_new"]) == (1.0, 3.0)


def test_spans_and_dates_prune_partitions(spark, snapshot_rows, root):
    store.write_snapshots(
        snapshot_rows(*(("a", day, 1, 1, 1, 1) for day in range(1, 6))), root
    )
    span = store.read_snapshots(spark, root, since="2024-01-02", until="2024-01-03")
    assert span.count() == 2
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert store.read_dates(spark, root, [day_of(4), day_of(5), day_of(9)]).count() == 2
    assert store.find_dates(spark, root, [day_of(9)]) is None
    assert store.find_dates(spark, root, []) is None


def test_summary_and_health(snapshot_rows):
    rows = snapshot_rows(("a", 1, 1, None, 0, 1), ("b", 1, 5, 2, 3, 1), ("a", 2, 2, 2, 2, 2))
    (total,) = store.table_summary(rows).collect()
    assert (total["n_rows"], total["n_snapshots"]) == (3, 2)
    first, _ = as_dicts(store.table_health(rows, ["quality", "speed"]), "snapshot_date")
    assert (first["n_rows"], first["speed_nulls"], first["quality_lo"], first["quality_hi"]) == (
        2, 1, 1.0, 5.0
    )


def test_only_a_missing_table_counts_as_none(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert store.find_table(spark, str(tmp_path / "empty")) is None
    with pytest.raises(AnalysisException):
        store.read_latest(spark, str(tmp_path / "absent"))


def test_dates_come_from_the_listing(snapshot_rows, spark, tmp_path):
    root = str(tmp_path / "odd {a,b}[1]*?" / "table")
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1), ("a", 3, 2, 1, 1, 1), ("b", 3, 4, 1, 1, 1))
    store.write_snapshots(rows, root)
    assert store.stored_dates(spark, root) == [day_of(1), day_of(3)]
    assert store.read_latest(spark, root).count() == 2
    assert store.read_dates(spark, root, [day_of(1), day_of(2)]).count() == 1
    assert store.find_dates(spark, root, [day_of(2)]) is None
    assert "snapshot_date=2024-01-01" not in " ".join(store.read_latest(spark, root).inputFiles())
