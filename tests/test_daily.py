import json

import pytest
from conftest import as_dicts, as_set, day_of
from test_landing import land, record

from fieldrank.__main__ import main
from fieldrank.operators.scoring import leaderboard
from fieldrank.operators.trends import trends
from fieldrank.plans import daily
from fieldrank.plans.daily import Chain, RejectedInput, Tables, run_daily, verification
from fieldrank.sources import landing, store
from fieldrank.streaming.ingest import ingest_available

CHAIN = Chain(landing.record_rules("index"))


def consistent(spark, tables):
    """Leaderboard and trends are what a full run over the cleaned table gives."""
    cleaned = store.read_snapshots(spark, tables.cleaned)
    assert as_set(store.read_snapshots(spark, tables.leaderboard)) == as_set(leaderboard(cleaned))
    assert as_set(store.read_snapshots(spark, tables.trends)) == as_set(trends(cleaned))
    return cleaned


def day(number, keys="abc", **options):
    return [record(key, price=1.0 + i, speed=10.0 * number + i, **options)
            for i, key in enumerate(keys)]


def test_days_one_after_the_other(spark, tmp_path):
    files, tables = tmp_path / "in", Tables(str(tmp_path / "out"))
    for number, keys in ((1, "abc"), (2, "ab"), (3, "abcd")):
        land(files, number, day(number, keys), minute=number)
        load = run_daily(spark, str(files), tables, CHAIN, date=day_of(number))
        assert (load.rows, load.dates) == (len(keys), [day_of(number)])
        consistent(spark, tables)
    found = as_dicts(
        store.read_snapshots(spark, tables.trends).where("entity_id = 'c'"), "snapshot_date"
    )
    assert found[1]["prev_snapshot_date"] == day_of(1) and found[1]["speed_delta"] == 20.0


def test_all_days_at_once_equal_days_one_by_one(spark, tmp_path):
    files = tmp_path / "in"
    for number in (1, 2, 3):
        land(files, number, day(number), minute=number)
    together, single = Tables(str(tmp_path / "a")), Tables(str(tmp_path / "b"))
    run_daily(spark, str(files), together, CHAIN)
    for number in (2, 1, 3):
        run_daily(spark, str(files), single, CHAIN, date=day_of(number))
    for name in ("cleaned", "leaderboard", "trends"):
        assert as_set(store.read_snapshots(spark, getattr(together, name))) == as_set(
            store.read_snapshots(spark, getattr(single, name))
        )


def test_a_snapshot_without_records_changes_nothing(spark, tmp_path):
    files, tables = tmp_path / "in", Tables(str(tmp_path / "out"))
    land(files, 1, [])
    assert run_daily(spark, str(files), tables, CHAIN).rows == 0
    assert store.find_table(spark, tables.leaderboard) is None


def test_new_measurement_appears_as_column(spark, tmp_path):
    files, tables = tmp_path / "in", Tables(str(tmp_path / "out"))
    land(files, 1, day(1))
    run_daily(spark, str(files), tables, CHAIN, date=day_of(1))
    land(files, 2, day(2, evaluations={"index": 3, "extra": "7"}))
    run_daily(spark, str(files), tables, CHAIN, date=day_of(2))
    cleaned = store.read_snapshots(spark, tables.cleaned, merge_schema=True)
    assert [row["eval_extra"] for row in cleaned.orderBy("snapshot_date").collect()] == (
        [None] * 3 + [7.0] * 3
    )


def stream(spark, tmp_path, chain=CHAIN, **options):
    tables = Tables(str(tmp_path / "out"))
    ingest_available(
        spark, str(tmp_path / "in"), tables, chain, str(tmp_path / "checkpoint"), **options
    )
    return tables


def test_stream_loads_only_new_files(spark, tmp_path):
    land(tmp_path / "in", 1, day(1), minute=1)
    land(tmp_path / "in", 2, day(2), minute=2)
    tables = stream(spark, tmp_path, files_per_batch=1)
    assert consistent(spark, tables).count() == 6
    land(tmp_path / "in", 3, day(3, "ad"), minute=3)
    stream(spark, tmp_path)
    assert consistent(spark, tables).count() == 8
    loads = store.load_history(spark, tables.cleaned)
    assert [row["n_rows"] for row in loads.orderBy("snapshot_date").collect()] == [3, 3, 2]
    stream(spark, tmp_path)
    assert store.load_history(spark, tables.cleaned).count() == 3


def test_stream_corrects_a_date(spark, tmp_path):
    files, whole = tmp_path / "in", Chain(landing.record_rules("index"), whole_files=True)
    land(files, 1, day(1), minute=1)
    land(files, 2, day(2), minute=2)
    tables = stream(spark, tmp_path, whole)
    land(files, 1, day(5, "bcd"), minute=3, name="raw_2024-01-01_again.json")
    stream(spark, tmp_path, whole)
    cleaned = consistent(spark, tables)
    assert [row["entity_id"] for row in cleaned.where("snapshot_date = '2024-01-01'")
            .orderBy("entity_id").collect()] == ["b", "c", "d"]


@pytest.mark.parametrize("per_batch", [None, 1])
def test_files_of_a_date_can_complete_each_other(spark, tmp_path, per_batch):
    files = tmp_path / "in"
    land(files, 1, day(1, "ab"), minute=1, name="2024-01-01/part-0.json")
    land(files, 1, day(2, "bc"), minute=2, name="2024-01-01/part-1.json")
    tables = stream(spark, tmp_path, files_per_batch=per_batch)
    cleaned = as_dicts(consistent(spark, tables), "entity_id")
    assert [(row["entity_id"], row["speed"]) for row in cleaned] == [
        ("a", 10.0), ("b", 20.0), ("c", 21.0)
    ]


def test_command_line(spark, tmp_path, capsys):
    land(tmp_path / "in", 1, day(1))
    land(tmp_path / "in", 2, day(2))
    common = [str(tmp_path / "in"), str(tmp_path / "out"), "--quality-key", "index"]
    main([*common, "--date", "2024-01-02"])
    told = capsys.readouterr().out.splitlines()
    assert told == ["3 rows on 1 dates, 0 rejects", "{'n_rows': 3, 'n_snapshots': 1}"]
    main([*common, "--stream", str(tmp_path / "checkpoint")])
    assert consistent(spark, Tables(str(tmp_path / "out"))).count() == 6


def rejects(spark, tables):
    found = spark.read.parquet(tables.rejects).collect()
    return sorted((row.file_path and row.file_path.rsplit("/", 1)[1], row.reason, row.envelopes)
                  for row in found)


def bad_landing(files):
    land(files, 1, day(1), minute=1)
    land(files, 1, day(2, "ab"), minute=2, name="raw_2024-01-01_b.json")
    land(files, 2, "{not json")
    land(files, 3, '{"status": 1}')
    land(files, 4, day(4), name="undated.json")


def test_what_a_load_leaves_out_is_recorded(spark, tmp_path):
    bad_landing(tmp_path / "in")
    unusable = [("raw_2024-01-02.json", "malformed", 1), ("raw_2024-01-03.json", "no data list", 1),
                ("undated.json", "no date in path", 1)]
    tables = Tables(str(tmp_path / "a"))
    load = run_daily(spark, str(tmp_path / "in"), tables, CHAIN)
    assert (load.rows, load.rejected) == (3, 3)
    assert rejects(spark, tables) == unusable
    tables = Tables(str(tmp_path / "b"))
    load = run_daily(spark, str(tmp_path / "in"), tables, Chain(CHAIN.rules, whole_files=True))
    assert (load.rows, load.rejected) == (2, 4)
    assert rejects(spark, tables) == [("raw_2024-01-01.json", "superseded", 1), *unusable]


def test_files_that_all_come_again_are_not_merged(spark, tmp_path, monkeypatch):
    files, tables = tmp_path / "in", Tables(str(tmp_path / "out"))
    land(files, 1, day(1), minute=1)
    land(files, 1, day(1, "cd"), minute=2)
    land(files, 2, day(2), minute=1)
    run_daily(spark, str(files), tables, CHAIN)
    first = as_set(store.read_snapshots(spark, tables.flat))
    merges = []
    monkeypatch.setattr(daily, "merged", lambda *sides: merges.append(sides) or store.merged(*sides))
    run_daily(spark, str(files), tables, CHAIN)
    assert as_set(store.read_snapshots(spark, tables.flat)) == first and not merges
    consistent(spark, tables)


def test_envelopes_are_kept_compressed(spark, tmp_path, monkeypatch):
    """Also those of compressed lines, as the queries land them."""
    files, tables = tmp_path / "in", Tables(str(tmp_path / "out"))
    envelope = json.dumps({"data": day(1)})
    lines = spark.createDataFrame([(envelope, day_of(1))], "value string, snapshot_date date")
    lines.write.partitionBy("snapshot_date").text(str(files), compression="gzip")
    codecs = []
    write = daily.materialise

    def noted(df, codec=None, **observed):
        codecs.append(codec)
        return write(df, codec, **observed)

    monkeypatch.setattr(daily, "materialise", noted)
    assert run_daily(spark, str(files), tables, CHAIN, multi_line=False).rows == 3
    assert codecs[0] == "zstd"


def test_a_strict_load_writes_nothing(spark, tmp_path):
    bad_landing(tmp_path / "in")
    tables = Tables(str(tmp_path / "out"))
    with pytest.raises(RejectedInput, match="raw_2024-01-02.json: 1 malformed"):
        run_daily(spark, str(tmp_path / "in"), tables, Chain(CHAIN.rules, on_reject="fail"))
    assert store.find_table(spark, tables.flat) is None
    with pytest.raises(ValueError, match="on_reject"):
        run_daily(spark, str(tmp_path / "in"), tables, Chain(CHAIN.rules, on_reject="hide"))


def test_unreadable_values_are_counted(spark, tmp_path):
    land(tmp_path / "in", 1, [record("a", price="free"), record("b", price="Infinity"), record("c")])
    tables = Tables(str(tmp_path / "out"))
    run_daily(spark, str(tmp_path / "in"), tables, CHAIN)
    assert rejects(spark, tables) == [(None, "unreadable pricing_price_1m_input_tokens", 2)]
    consistent(spark, tables)


def test_a_bad_file_in_a_stream_is_recorded(spark, tmp_path):
    land(tmp_path / "in", 1, day(1), minute=1)
    land(tmp_path / "in", 2, "{", minute=2)
    tables = stream(spark, tmp_path, files_per_batch=1)
    assert rejects(spark, tables) == [("raw_2024-01-02.json", "malformed", 1)]
    assert consistent(spark, tables).count() == 3


def test_odd_keys_and_a_day_without_quality(spark, tmp_path):
    land(tmp_path / "in", 1, day(1, evaluations={"v2.1": 3, "a b": 4, "`": 5, "Up": 6}))
    tables = Tables(str(tmp_path / "out"))
    run_daily(spark, str(tmp_path / "in"), tables, CHAIN)
    land(tmp_path / "in", 2, day(2))
    run_daily(spark, str(tmp_path / "in"), tables, CHAIN, day_of(2))
    cleaned = store.read_snapshots(spark, tables.cleaned, merge_schema=True)
    first = as_dicts(cleaned, "snapshot_date", "entity_id")[0]
    assert (first["eval_v2.1"], first["eval_a b"], first["eval_`"], first["quality"]) == (3, 4, 5, None)
    board = store.read_snapshots(spark, tables.leaderboard)
    assert {row.snapshot_date for row in board.collect()} == {day_of(2)}
    found = verification(spark, tables, [day_of(1), day_of(2)])
    assert found == {"n_rows": 6, "n_snapshots": 2}
