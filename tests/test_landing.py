import datetime as dt
import json
import os

import pytest
from conftest import as_dicts, day_of
from pyspark.sql import functions as F

from fieldrank.sources import landing
from fieldrank.sources.landing import RecordLayout


def record(key, price=1.0, speed=10.0, **changes):
    found = {
        "id": key, "slug": f"name {key}", "release_date": "2023-01-01",
        "model_creator": {"id": 4, "slug": "maker"},
        "pricing": {"price_1m_input_tokens": price, "price_1m_output_tokens": 2},
        "median_output_tokens_per_second": speed,
        "median_time_to_first_token_seconds": 0,
        "median_time_to_first_answer_token": None,
        "evaluations": {"index": 40.5},
    }
    found.update(changes)
    return found


def land(folder, day, records, minute=0, name=None, **envelope):
    path = folder / (name or f"raw_2024-01-{day:02}.json")
    path.parent.mkdir(parents=True, exist_ok=True)
    body = records if isinstance(records, str) else json.dumps(
        {"status": 200, "data": records, **envelope}, indent=2
    )
    path.write_text(body)
    stamp = dt.datetime(2024, 2, 1, 0, minute, tzinfo=dt.timezone.utc).timestamp()
    os.utime(path, (stamp, stamp))


def test_envelopes_become_flat_rows(spark, tmp_path):
    land(tmp_path, 1, [record("a"), record("b", price="0.25")])
    land(tmp_path, 2, [record("a", release_date=None)])
    envelopes = landing.read_landing(spark, str(tmp_path))
    rows = as_dicts(landing.flatten(landing.records(envelopes)), "snapshot_date", "id")
    assert [(r["snapshot_date"], r["id"]) for r in rows] == [
        (day_of(1), "a"), (day_of(1), "b"), (day_of(2), "a"),
    ]
    assert rows[0]["model_creator_slug"] == "maker"
    assert rows[1]["pricing_price_1m_input_tokens"] == "0.25"
    assert rows[0]["pricing_price_1m_output_tokens"] == "2"
    assert rows[0]["evaluations"] == {"index": "40.5"}
    assert rows[0]["median_time_to_first_answer_token"] is None
    assert rows[2]["release_date"] is None


def test_date_can_be_given(spark, tmp_path):
    land(tmp_path, 1, [record("a")], name="today.json")
    envelopes = landing.read_landing(spark, str(tmp_path), date="2024-03-04")
    assert str(landing.records(envelopes).first()["snapshot_date"]) == "2024-03-04"


def test_lines_of_envelopes(spark, tmp_path):
    folder = tmp_path / "2024-01-03"
    lines = "\n".join(json.dumps({"data": [record(key)]}) for key in "abc")
    land(folder, 3, lines, name="part-0.json")
    envelopes = landing.read_landing(spark, str(tmp_path), multi_line=False)
    rows = landing.records(envelopes)
    assert rows.count() == 3
    assert {row["snapshot_date"] for row in rows.collect()} == {day_of(3)}


def test_bad_files_are_counted_and_others_load(spark, tmp_path):
    land(tmp_path, 1, [record("a")])
    land(tmp_path, 2, '{"status": 500}')
    land(tmp_path, 3, '{"data": [{"id": ')
    land(tmp_path, 4, '{"data": {"id": "a"}}')
    land(tmp_path, 5, [record("x")], name="undated.json")
    envelopes = landing.read_landing(spark, str(tmp_path))
    found = {
        os.path.basename(row["file_path"]): row["reason"]
        for row in landing.rejected(envelopes).collect()
    }
    assert found.pop("raw_2024-01-04.json") in ("malformed", "no data list")
    assert found == {
        "raw_2024-01-02.json": "no data list", "raw_2024-01-03.json": "malformed",
        "undated.json": "no date in path",
    }
    assert [row["snapshot_date"] for row in landing.records(envelopes).collect()] == [day_of(1)]


def test_empty_data_list_is_no_reject(spark, tmp_path):
    land(tmp_path, 1, [])
    envelopes = landing.read_landing(spark, str(tmp_path))
    assert landing.rejected(envelopes).count() == 0 and landing.records(envelopes).count() == 0


def without(item, *keys):
    return {key: value for key, value in item.items() if key not in keys}


def test_missing_keys_fail_or_become_null(spark, tmp_path):
    bad = without(record("b"), "slug", "median_output_tokens_per_second")
    bad["pricing"] = {"price_1m_input_tokens": 1}
    land(tmp_path, 1, [record("a"), bad])
    rows = landing.records(landing.read_landing(spark, str(tmp_path)))
    (short,) = landing.incomplete_records(rows).collect()
    assert sorted(short["missing"]) == [
        "median_output_tokens_per_second", "pricing.price_1m_output_tokens", "slug"
    ]
    with pytest.raises(Exception, match="record lacks slug"):
        landing.flatten(rows).collect()
    assert landing.flatten(rows, on_missing="null").where("slug is null").count() == 1


def test_objects_of_the_wrong_kind_count_as_missing(spark, tmp_path):
    land(tmp_path, 1, [record("a", pricing="free"), record("b", model_creator=None), None])
    rows = landing.records(landing.read_landing(spark, str(tmp_path)))
    found = landing.incomplete_records(rows)
    assert sorted(len(row["missing"]) for row in found.collect()) == [1, 2, 9]
    flat = landing.flatten(rows, on_missing="null").orderBy("id").collect()
    assert [row["id"] for row in flat] == [None, "a", "b"]
    assert flat[1]["pricing_price_1m_input_tokens"] is None and flat[1]["evaluations"]


def test_null_values_are_not_missing(spark, tmp_path):
    land(tmp_path, 1, [without(record("a", slug=None, speed=None), "evaluations")])
    rows = landing.records(landing.read_landing(spark, str(tmp_path)))
    assert landing.incomplete_records(rows).count() == 0
    (row,) = landing.flatten(rows).collect()
    assert row["slug"] is None and row["evaluations"] is None


def test_map_spread(spark):
    rows = spark.createDataFrame(
        [(1, {"b": "2", "a": "x"}), (2, {"c": "3.5"}), (3, None)], "n int, m map<string,string>"
    )
    spread = landing.spread_map(rows, "m")
    assert spread.columns == ["n", "eval_a", "eval_b", "eval_c"]
    assert [tuple(row) for row in spread.orderBy("n").collect()] == [
        (1, None, 2.0, None), (2, None, None, 3.5), (3, None, None, None)
    ]
    assert landing.spread_map(rows, "m", ["c", "z"]).columns == ["n", "eval_c", "eval_z"]
    with pytest.raises(ValueError, match="more than 2 keys"):
        landing.map_keys(rows, "m", at_most=2)


def test_newest_file_of_a_date_replaces_older_ones(spark, tmp_path):
    land(tmp_path, 1, [record("a"), record("b")], minute=1, name="raw_2024-01-01_a.json")
    land(tmp_path, 1, [record("c")], minute=2, name="raw_2024-01-01_b.json")
    land(tmp_path, 1, '{"data": 4', minute=3, name="raw_2024-01-01_c.json")
    land(tmp_path, 2, [record("d")], minute=0)
    newest = landing.newest_files(landing.read_landing(spark, str(tmp_path)))
    ids = landing.flatten(landing.records(newest)).select("snapshot_date", "id")
    assert [tuple(row) for row in ids.orderBy("id").collect()] == [
        (day_of(1), "c"), (day_of(2), "d")
    ]


def test_layouts_are_parameters(spark):
    layout = RecordLayout(paths=("key", "inner.v"), measurements=None)
    rows = spark.range(1).select(
        F.current_date().alias("snapshot_date"),
        F.lit('{"key": 5, "inner": {"v": [1]}}').alias("record"),
    )
    (row,) = landing.flatten(rows, layout, keep_origin=False).select("key", "inner_v").collect()
    assert tuple(row) == ("5", "[1]")
    with pytest.raises(ValueError, match="two levels"):
        landing.flatten(rows, RecordLayout(paths=("a.b.c",)))
