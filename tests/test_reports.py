import pytest
from conftest import as_dicts, as_set, day_of

from fieldrank.operators import movements, reports, snapshots
from fieldrank.operators.scoring import Weights, leaderboard


@pytest.fixture
def board(snapshot_rows):
    return leaderboard(snapshot_rows(
        ("a", 1, 9, 9, 1, 1), ("b", 1, 5, 5, 2, 2), ("c", 1, 1, 1, 3, 3),
        ("a", 2, 1, 1, 3, 3), ("b", 2, 9, 9, 1, 1), ("d", 2, 5, 5, 2, 2),
        ("b", 4, 9, 9, 1, 1), ("c", 4, 1, 1, 3, 3),
    ), exact_cuts=True)


def keys(df):
    return [
        (row["snapshot_date"].day, row["entity_id"])
        for row in df.orderBy("snapshot_date", "entity_id").collect()
    ]


def test_winners(board):
    assert keys(reports.best_overall(board)) == [(1, "a"), (2, "b"), (4, "b")]
    assert keys(reports.best_value(board)) == [(1, "a"), (2, "b"), (4, "b")]


def test_top_n(board):
    assert [row["rank"] for row in reports.top_n(board, day_of(1), 2).collect()] == [1, 2]
    assert keys(reports.top_n_per_snapshot(board, 1)) == [(1, "a"), (2, "b"), (4, "b")]


@pytest.mark.parametrize("key", ["entity_id", "entity_name"])
def test_ever_top_n(board, key):
    expected = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (4, "b")]
    assert keys(reports.ever_top_n(board, 1, key)) == expected
    lines = reports.series(reports.ever_top_n(board, 1, key)).collect()
    assert [(r["entity_id"], r["snapshot_date"].day) for r in lines] == [
        ("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 4)
    ]


def test_tier_summary(board):
    first = as_dicts(reports.tier_summary(board).where("snapshot_date = '2024-01-01'"), "cost_tier")
    assert [(r["cost_tier"], r["entities"], r["price_avg"]) for r in first] == [
        ("budget", 1, 1.0), ("mid", 1, 2.0), ("premium", 1, 3.0)
    ]


def test_latest_and_as_of(board):
    assert keys(snapshots.latest_snapshot(board)) == [(4, "b"), (4, "c")]
    assert keys(snapshots.as_of(board, day_of(3))) == [(1, "c"), (2, "a"), (2, "b"), (2, "d")]
    assert keys(snapshots.snapshot(board, "2024-01-02")) == [(2, "a"), (2, "b"), (2, "d")]


def test_rank_movement(board):
    moves = {
        (row["snapshot_date"].day, row["entity_id"]): row["places_gained"]
        for row in movements.rank_movement(board).collect()
    }
    assert moves[(1, "a")] is None and moves[(2, "a")] == -2 and moves[(2, "b")] == 1
    assert moves[(4, "c")] == 1


def test_entered_and_dropped(board):
    changes = movements.entered_dropped(board).collect()
    assert sorted((r["snapshot_date"].day, r["entity_id"], r["change"]) for r in changes) == [
        (2, "c", "dropped"), (2, "d", "entered"),
        (4, "a", "dropped"), (4, "c", "entered"), (4, "d", "dropped"),
    ]


def test_reweighted_winner(snapshot_rows):
    board = leaderboard(snapshot_rows(
        ("a", 1, 9, 1, 5, 5), ("b", 1, 1, 9, 5, 5), ("c", 1, 1, 1, 1, 1), ("d", 1, 9, 1, 5, 5),
    ))
    winners = movements.reweighted_winner(board, {
        "smart": Weights(1, 0, 0), "fast": Weights(0, 1, 0), "cheap": Weights(0, 0, 1),
    })
    assert {row["weighting"]: row["entity_id"] for row in winners.collect()} == {
        "smart": "a", "fast": "b", "cheap": "c"
    }


def test_reports_do_not_depend_on_row_order(board):
    assert as_set(movements.entered_dropped(board)) == as_set(
        movements.entered_dropped(board.repartition(5))
    )
