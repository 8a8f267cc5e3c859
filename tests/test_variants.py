import json
import random

import pytest
from conftest import day_of
from pyspark.sql import functions as F

from fieldrank.sources import landing, store, variants

VALUES = [1, 2.5, "text", True, None, [1, "a"], {"x": 1}]


def kind_of(value):
    if value is None:
        return "null"
    for kind, name in ((bool, "boolean"), ((int, float), "number"), (str, "string"), (list, "array")):
        if isinstance(value, kind):
            return name
    return "object"


def plain(rows):
    days = sorted({day for day, _ in rows})
    held = {day: {} for day in days}
    for day, measured in rows:
        for key, value in (measured or {}).items():
            held[day].setdefault(key, []).append(kind_of(value))
    changes, seen, last = [], set(), {}
    for number, day in enumerate(days):
        before = held[days[number - 1]] if number else {}
        for key, kinds in held[day].items():
            now = sorted(set(kinds) - {"null"})
            if number and key not in seen:
                changes.append((day, key, "new", None, now))
            elif number and key not in before:
                changes.append((day, key, "back", last.get(key), now))
            if now and key in last and last[key] != now:
                changes.append((day, key, "kinds", last[key], now))
        for key in before.keys() - held[day].keys():
            changes.append((day, key, "gone", sorted(set(before[key]) - {"null"}), None))
        for key, kinds in held[day].items():
            seen.add(key)
            last[key] = sorted(set(kinds) - {"null"}) or last.get(key)
            if last[key] is None:
                del last[key]
    return sorted(changes, key=str)


def stored(spark, rows, root):
    table = spark.createDataFrame(
        [(day, None if m is None else json.dumps(m)) for day, m in rows], "snapshot_date date, text string"
    ).select("snapshot_date", F.parse_json("text").alias("measured"))
    variants.write_measured(table, root)
    return store.read_snapshots(spark, root)


@pytest.mark.parametrize("seed", range(3))
def test_drift(spark, tmp_path, seed):
    rng = random.Random(seed)
    keys = ["a", "B", "b", "it's", 'a "quoted" one', "with.dot", ""]
    rows = []
    for n in sorted(rng.sample(range(1, 40), 8)):
        common = rng.choice(VALUES)
        for _ in range(6):
            rows.append((day_of(n), {k: rng.choice([common, rng.choice(VALUES)]) for k in keys if rng.random() < 0.25}))
        rows.append((day_of(n), None))
    rows += [(day_of(50), None), (day_of(51), {}), (day_of(52), {"a": 1})]
    table = stored(spark, rows, str(tmp_path / "t"))
    found = [tuple(r) for r in variants.drift(variants.key_states(table)).select(
        "snapshot_date", "key", "change", "kinds_before", "kinds_now"
    ).collect()]
    assert sorted(found, key=str) == plain(rows)


def test_values_by_key_and_kind(spark, tmp_path):
    rows = [(day_of(1), {"it's": 1.5, "n": "7", "deep": {"x": [1]}}), (day_of(1), {"n": "seven"}), (day_of(2), None)]
    table = stored(spark, rows, str(tmp_path / "t"))
    found = table.select(
        variants.value_of("it's").alias("a"), variants.value_of("n").alias("n"),
        variants.value_of("deep", "variant").cast("string").alias("deep"),
    ).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1.5, 7.0, '{"x":[1]}'), (None, None, None), (None, None, None)], key=str
    )
    with pytest.raises(ValueError, match="quotes"):
        variants.value_of("'\"")
    schemas = {r.snapshot_date: r.measured_schema for r in variants.date_schemas(table).collect()}
    assert "deep: OBJECT<x: ARRAY<BIGINT>>" in schemas[day_of(1)]


def test_thousands_of_keys_in_one_pass_over_landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    measured = {f"key {n}": n / 4 for n in range(3000)}
    records = [{"id": "a", "slug": "A", "evaluations": measured}, {"id": "b"}, {"id": "c", "evaluations": None}]
    (folder / "2024-01-01.json").write_text(json.dumps({"data": records}))
    rows = variants.measured_records(landing.records(landing.read_landing(spark, str(folder))))
    assert [r.id for r in rows.where(F.col("measured").isNotNull() & ~F.is_variant_null("measured")).collect()] == ["a"]
    assert variants.entries(rows.select("id", "measured")).count() == 3000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1


def test_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], "snapshot_date date, text string").select(
        "snapshot_date", F.parse_json("text").alias("measured")
    )
    assert variants.drift(variants.key_states(empty)).count() == 0
