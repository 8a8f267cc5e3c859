import random

import pytest
from conftest import as_dicts, as_set, day_of

from fieldrank.contracts import CLEANED, contract_problems
from fieldrank.operators.cleaning import (
    CleaningRules,
    cast_losses,
    clean,
    dedupe,
    typed,
    with_identity,
)
from fieldrank.sources.landing import record_rules

RULES = CleaningRules(
    key=("id", "snapshot_date"), identity=("id", "slug"), dates=("snapshot_date",),
    numbers=("price",), zero_is_missing=("rate",), newest_first=("delivery",),
    renames={"id": "entity_id", "not_there": "other"},
)
SCHEMA = "id string, slug string, snapshot_date string, price string, rate string, delivery int"


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("text, value", [
    ("0.0", None), ("-0.0", None), ("0", None), (None, None), ("NaN", None), ("slow", None),
    ("12.5", 12.5),
])
def test_zero_and_unreadable_speeds_are_missing(spark, text, value):
    (row,) = typed(rows_of(spark, ("a", "s", "2024-01-01", "1", text, 1)), RULES).collect()
    assert row["rate"] == value


@pytest.mark.parametrize("text, value", [
    ("0", 0.0), ("1.5", 1.5), ("n/a", None), ("NaN", None), (None, None),
])
def test_prices_keep_zero(spark, text, value):
    (row,) = typed(rows_of(spark, ("a", "s", "2024-01-01", text, "1", 1)), RULES).collect()
    assert row["price"] == value


def test_unreadable_values_are_counted(spark):
    df = rows_of(
        spark, ("a", "s", "2024-01-01", "n/a", "0", 1), ("b", "s", "yesterday", None, "slow", 1)
    )
    found = {r["column_name"]: r["unreadable"] for r in cast_losses(df, RULES).collect()}
    assert found == {"snapshot_date": 1, "price": 1, "rate": 1}


def test_columns_that_are_absent_are_skipped(spark):
    df = rows_of(spark, ("a", "s", "2024-01-01", "1", "1", 1)).drop("price", "rate")
    assert typed(df, RULES).columns == df.columns


def test_rows_without_identity_go_before_deduplication(spark):
    df = rows_of(
        spark,
        ("a", None, "2024-01-01", "2", "1", 2), ("a", "s", "2024-01-01", "1", "1", 1),
        (None, "s", "2024-01-01", "1", "1", 1),
    )
    assert with_identity(df, ["id", "slug"]).count() == 1
    (row,) = clean(df, RULES).collect()
    assert (row["entity_id"], row["slug"], row["price"]) == ("a", "s", 1.0)


def test_survivor_does_not_depend_on_order(spark):
    copies = [
        ("a", "s", "2024-01-01", "1", "1", 1), ("a", "s", "2024-01-01", None, "1", 2),
        ("a", "s", "2024-01-01", "5", "1", 2), ("a", "t", "2024-01-01", "5", "1", 2),
        ("b", "s", "2024-01-01", "1", "1", 1), ("a", "s", "2024-01-02", "9", "1", 1),
    ]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(copies)
        kept = dedupe(rows_of(spark, *copies), ["id", "snapshot_date"], ["delivery"])
        seen.add(tuple(as_set(kept)))
    assert len(seen) == 1
    kept = as_dicts(
        dedupe(rows_of(spark, *copies), ["id", "snapshot_date"], ["delivery"]),
        "id", "snapshot_date",
    )
    assert [(r["id"], r["slug"], r["price"]) for r in kept] == [
        ("a", "s", "5"), ("a", "s", "9"), ("b", "s", "1")
    ]


def test_rules_for_landing_records_meet_the_contract(spark):
    rules = record_rules("index")
    flat = spark.createDataFrame(
        [("1", "one", "2023-01-01", "maker", "0.5", "bad", "10", "0", None, 7.0,
          day_of(1), "f", None)],
        "id string, slug string, release_date string, model_creator_slug string, "
        "pricing_price_1m_input_tokens string, pricing_price_1m_output_tokens string, "
        "median_output_tokens_per_second string, median_time_to_first_token_seconds string, "
        "median_time_to_first_answer_token string, eval_index double, snapshot_date date, "
        "file_path string, file_time timestamp",
    )
    cleaned = clean(flat, rules)
    assert contract_problems(cleaned.schema, CLEANED, open_columns=True) == []
    (row,) = cleaned.collect()
    assert (row["price_in"], row["price_out"], row["speed"]) == (0.5, None, 10.0)
    assert row["first_token_seconds"] is None and row["release_date"].isoformat() == "2023-01-01"
    assert "file_path" not in cleaned.columns
