import datetime as dt
import random

import pytest
from conftest import as_set, day_of

from fieldrank.materialise import materialise
from fieldrank.operators.spells import spells, spells_after


def plain(rows):
    days = sorted({d for _, d in rows})
    out = []
    for key in sorted({k for k, _ in rows}):
        run = []
        for d in days:
            if (key, d) in rows:
                run.append(d)
            elif run:
                out.append((key, run[0], run[-1], len(run)))
                run = []
        if run:
            out.append((key, run[0], run[-1], len(run)))
    return out


def found(df):
    return sorted((r.entity_id, r.first_date, r.last_date, r.n_snapshots) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_spells_and_their_update(spark, seed):
    rng = random.Random(seed)
    schema = "entity_id string, snapshot_date date"
    days = [day_of(n) for n in sorted(rng.sample(range(1, 60), 14))]
    # One entity has most rows; "late" comes with a changed date only.
    rows = {(k, d) for d in days for k in "abcdef" if k == "a" or rng.random() < 0.6}
    table = spark.createDataFrame(sorted(rows), schema)
    assert found(spells(table)) == plain(rows)
    new_day, changed = day_of(61), [days[0], days[6], days[7], days[-1]]
    inner = next(day_of(n) for n in range(2, 60) if day_of(n) not in days)
    kept = {(k, d) for k, d in rows if d not in changed}
    after = kept | {(k, d) for d in changed for k in "abcdef" if rng.random() < 0.5}
    after |= {("late", new_day), ("b", new_day), ("c", inner), ("a", days[0])}
    after |= {("keeps the date", d) for d in changed}
    updated = spells_after(
        spark.createDataFrame(sorted(after), schema), materialise(spells(table)).df,
        [*changed, new_day, inner],
    )
    assert found(updated) == plain(after)


def test_nothing_changed_and_no_rows(spark):
    table = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "entity_id string, snapshot_date date")
    before = spells(table)
    assert as_set(spells_after(table, before, [])) == as_set(before)
    assert spells(table.limit(0)).count() == 0
