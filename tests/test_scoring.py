import random

import pytest
from conftest import as_dicts, as_set, day_of
from pyspark.sql import functions as F

from fieldrank.contracts import check_contract
from fieldrank.operators import movements, scoring, snapshots, statistics, trends
from fieldrank.operators.scoring import Scaling, Weights
from fieldrank.roles import DEFAULT_ROLES, Roles


def board_of(df, **options):
    return as_dicts(scoring.leaderboard(df, **options), "snapshot_date", "rank")


def test_scores_ranks_and_tiers(snapshot_rows):
    rows = snapshot_rows(
        ("a", 1, 80, 100, 1, 3), ("b", 1, 60, 200, 1, 1), ("c", 1, 40, 150, 4, 8),
    )
    b, a, c = board_of(rows, exact_cuts=True)
    assert [row["entity_id"] for row in (b, a, c)] == ["b", "a", "c"]
    assert a["quality_norm"] == 100.0 and c["quality_norm"] == 0.0
    assert b["speed_norm"] == 100.0 and b["price_norm"] == 100.0
    assert a["price_norm"] == (1.0 - (2.0 - 1.0) / (6.0 - 1.0)) * 100.0
    assert b["composite_score"] == 50.0 * 0.5 + 100.0 * 0.3 + 100.0 * 0.2
    assert a["composite_score"] == 100.0 * 0.5 + 0.0 * 0.3 + 80.0 * 0.2
    assert b["value_ratio"] == 60.0 and b["efficiency_rank"] == 1
    assert [row["cost_tier"] for row in (b, a, c)] == ["budget", "mid", "premium"]


def test_flat_metric_gets_the_middle(snapshot_rows):
    board = board_of(snapshot_rows(("a", 1, 50, 10, 1, 1), ("b", 1, 50, 20, 2, 2)))
    assert {row["quality_norm"] for row in board} == {50.0}
    assert sorted(row["speed_norm"] for row in board) == [0.0, 100.0]


def test_single_entity(snapshot_rows):
    (row,) = board_of(snapshot_rows(("a", 1, 7, 8, 1, 2)))
    assert (row["quality_norm"], row["speed_norm"], row["price_norm"]) == (50.0, 50.0, 50.0)
    assert row["composite_score"] == 50.0
    assert row["rank"] == 1 and row["efficiency_rank"] == 1 and row["cost_tier"] == "budget"


@pytest.mark.parametrize("exact", [False, True])
def test_snapshot_without_scorable_rows_is_absent(snapshot_rows, exact):
    rows = snapshot_rows(("a", 1, 7, None, 1, 2), ("b", 2, 7, 8, 1, 2), ("c", 2, 7, 8, 0, 0))
    board = board_of(rows, exact_cuts=exact)
    assert [(row["snapshot_date"], row["entity_id"]) for row in board] == [(day_of(2), "b")]
    assert board_of(rows.where("snapshot_date = '2024-01-01'"), exact_cuts=exact) == []


@pytest.mark.parametrize("values", [
    (None, 1, 1, 1), (1, None, 1, 1), (1, 1, None, 1), (1, 1, 1, None), (1, 1, 0, 0),
])
def test_rows_that_cannot_be_scored(snapshot_rows, values):
    assert scoring.scorable(snapshot_rows(("a", 1, *values))).count() == 0


def test_ties_go_to_the_lower_id(snapshot_rows):
    board = board_of(snapshot_rows(*((key, 1, 5, 5, 1, 1) for key in "dbca")))
    assert [row["entity_id"] for row in board] == list("abcd")
    assert [row["rank"] for row in board] == [1, 2, 3, 4]
    assert [row["efficiency_rank"] for row in board] == [1, 2, 3, 4]


def random_field(snapshot_rows, seed, days=4, entities=40):
    dice = random.Random(seed)
    return snapshot_rows(*(
        (f"e{i}", day, dice.randint(1, 60), dice.randint(1, 300) or None,
         dice.choice([0, 0.25, 1, 5]), dice.choice([0.5, 1, 20]))
        for day in range(1, days + 1) for i in range(entities) if dice.random() < 0.9
    ))


def test_invariants(snapshot_rows):
    rows = random_field(snapshot_rows, 1)
    board = scoring.leaderboard(rows)
    check_contract(board, "leaderboard")
    per_day = as_dicts(
        board.groupBy("snapshot_date").agg(
            F.count("*").alias("n"), F.min("rank").alias("first"), F.max("rank").alias("last"),
            F.count_distinct("rank").alias("ranks"),
            F.max("efficiency_rank").alias("last_value"),
            *(F.min(f"{m}_norm").alias(f"{m}_lo") for m in ("quality", "speed", "price")),
            *(F.max(f"{m}_norm").alias(f"{m}_hi") for m in ("quality", "speed", "price")),
            F.min("composite_score").alias("lo"), F.max("composite_score").alias("hi"),
        ), "snapshot_date",
    )
    assert len(per_day) == 4
    for day in per_day:
        assert day["first"] == 1 and day["last"] == day["n"] == day["ranks"] == day["last_value"]
        for metric in ("quality", "speed", "price"):
            assert (day[f"{metric}_lo"], day[f"{metric}_hi"]) == (0.0, 100.0)
        assert 0 <= day["lo"] <= day["hi"] <= 100


def test_row_order_does_not_matter(snapshot_rows):
    rows = random_field(snapshot_rows, 2)
    shuffled = rows.repartition(7).orderBy(F.rand(5))
    assert as_set(scoring.leaderboard(rows, exact_cuts=True)) == as_set(
        scoring.leaderboard(shuffled, exact_cuts=True)
    )


def test_affine_change_keeps_norms_and_ranks(snapshot_rows):
    rows = random_field(snapshot_rows, 3)
    changed = rows.withColumn("quality", F.col("quality") * 4 + 8)
    columns = ("snapshot_date", "entity_id", "rank", "quality_norm")
    assert as_set(scoring.leaderboard(rows).select(*columns)) == as_set(
        scoring.leaderboard(changed).select(*columns)
    )


def test_other_snapshots_do_not_matter(snapshot_rows):
    rows = random_field(snapshot_rows, 4)
    one = rows.where("snapshot_date = '2024-01-02'")
    together = scoring.leaderboard(rows).where("snapshot_date = '2024-01-02'")
    assert as_set(scoring.leaderboard(one)) == as_set(together)


def test_weights_are_parameters(snapshot_rows):
    rows = snapshot_rows(("a", 1, 9, 1, 1, 1), ("b", 1, 1, 9, 1, 2))
    assert board_of(rows)[0]["entity_id"] == "a"
    assert board_of(rows, weights=Weights(0.1, 0.9, 0.0))[0]["entity_id"] == "b"


def test_exact_quantiles_take_the_row_at_the_rounded_up_position(snapshot_rows):
    rows = statistics.with_mean_price(
        snapshot_rows(*((f"e{i}", 1, 1, 1, i, i) for i in range(1, 11)))
    )
    found = statistics.exact_quantiles(
        rows, "mean_price", (0.33, 0.66), ("low", "mid"), statistics.measure(rows, cuts=None)
    )
    assert as_dicts(found, "low") == [{"snapshot_date": day_of(1), "low": 4.0, "mid": 7.0}]


def test_approximate_quantiles_stay_within_the_rank_error(spark):
    n = 20_000
    rows = spark.range(n).select(
        F.lit("2024-01-01").cast("date").alias("snapshot_date"),
        (F.col("id") * 7919 % n).cast("double").alias("mean_price"),
        F.lit(1.0).alias("quality"), F.lit(1.0).alias("speed"),
    )
    (row,) = statistics.summarise(rows).collect()
    assert abs(row["tier_low"] - 0.33 * n) <= 0.01 * n + 1
    assert abs(row["tier_mid"] - 0.66 * n) <= 0.01 * n + 1


def test_percent_rank_scaling(snapshot_rows):
    rows = snapshot_rows(*(
        (key, 1, value, 1, 1, 1 + i) for i, (key, value) in enumerate(zip("abc", (1, 1, 1000)))
    ))
    norms = {row["entity_id"]: row for row in board_of(rows, scaling=Scaling("percent_rank"))}
    assert [norms[key]["quality_norm"] for key in "abc"] == [0.0, 0.0, 100.0]
    assert [norms[key]["speed_norm"] for key in "abc"] == [50.0, 50.0, 50.0]
    assert [norms[key]["price_norm"] for key in "abc"] == [100.0, 50.0, 0.0]


def test_z_score_scaling_is_cut(snapshot_rows):
    rows = snapshot_rows(
        *((f"e{i}", 1, 10, 5, 1, 1) for i in range(50)), ("far", 1, 10_000, 5, 1, 1)
    )
    norms = {r["entity_id"]: r for r in board_of(rows, scaling=Scaling("z_score", clip=2.0))}
    assert norms["far"]["quality_norm"] == 100.0
    assert norms["e1"]["speed_norm"] == 50.0


def test_log_price_scaling(snapshot_rows):
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1), ("b", 1, 2, 2, 10, 10), ("c", 1, 3, 3, 100, 100))
    board = board_of(rows, scaling=Scaling(log_price=True))
    norms = {row["entity_id"]: row["price_norm"] for row in board}
    assert norms["a"] == 100.0 and norms["c"] == 0.0
    assert norms["b"] == pytest.approx(50.0)


def test_unknown_scaling_is_refused():
    with pytest.raises(ValueError):
        Scaling("median")
    with pytest.raises(ValueError):
        Scaling("z_score", log_price=True)


def test_columns_may_have_other_names(snapshot_rows):
    roles = Roles("key", "title", "maker", "day", "points", "rate", "cost_in", "cost_out")
    rows = random_field(snapshot_rows, 6)
    names = dict(zip(DEFAULT_ROLES.columns, roles.columns))
    renamed = rows.withColumnsRenamed(names)
    back = {new: old for old, new in names.items()}
    for make in (scoring.leaderboard, trends.trends):
        assert as_set(make(renamed, roles=roles).withColumnsRenamed(back)) == as_set(make(rows))
    board = scoring.leaderboard(renamed, roles=roles)
    assert movements.rank_movement(board, roles).count() == board.count()
    assert movements.entered_dropped(board, roles).count() == movements.entered_dropped(
        scoring.leaderboard(rows)
    ).count()
    assert snapshots.latest_snapshot(board, roles).select("day").distinct().count() == 1
