import hashlib
import random

import pytest
from conftest import day_of
from pyspark.sql import functions as F

from fieldrank.operators import renames
from fieldrank.operators.renames import near_names, renamed_entities
from fieldrank.roles import Roles

SCHEMA = "entity_id string, snapshot_date date, entity_name string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain(rows, edits):
    """Links taken one by one, by edits and hash; of equal names the lower id first."""
    days = sorted({day for _, day, _ in rows})
    by_day = {d: {k: n for k, day, n in rows if day == d} for d in days}
    out = []
    for before, now in zip(days, days[1:]):
        gone = {k: n.strip(" ").lower() for k, n in by_day[before].items() if k not in by_day[now] and n is not None}
        come = {k: n.strip(" ").lower() for k, n in by_day[now].items() if k not in by_day[before] and n is not None}
        pairs = sorted(
            (e, hashlib.md5(f"{a}:{b}".encode()).hexdigest(), a, b, i, j)
            for i, a in gone.items() for j, b in come.items() if (e := distance(a, b)) <= edits
        )
        for e, _, _, _, i, j in pairs:
            if i in gone and j in come:
                del gone[i], come[j]
                out.append((now, i, j, e))
    return sorted(out)


def found(df):
    return sorted((r.snapshot_date, r.id_before, r.id_now, r.edits) for r in df.collect())


def near_rows(seed, size, alphabet, longest):
    rng = random.Random(seed)
    def word():
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest)))
    return [
        (f"{d}{i:03d}" if rng.random() < 0.7 else f"{i:03d}", day_of(d), rng.choice([word(), word(), " Zz ", None]))
        for d in range(1, 5) for i in range(size)
    ]


@pytest.mark.parametrize("edits, alphabet, longest", [
    (0, "ab", 7), (1, "abcdefgh", 9), (2, "ab", 7), (2, "a", 14), (3, "abcdefgh", 9),
])
def test_equals_links_one_by_one(spark, monkeypatch, edits, alphabet, longest):
    monkeypatch.setattr(renames, "CHUNK", 3)
    rows = near_rows(edits, 30, alphabet, longest)
    df = spark.createDataFrame(rows, SCHEMA)
    links = found(renamed_entities(df, edits=edits, part_names=4))
    assert links == plain(rows, edits) and links
    ids = [(day, i) for day, i, _, _ in links] + [(day, j) for day, _, j, _ in links]
    assert len(ids) == len(set(ids))


@pytest.mark.parametrize("gram", [1, 2])
def test_no_near_name_is_missed(spark, gram):
    rng = random.Random(gram)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(160)]
    words += ["ab" * 12, "ab" * 11 + "a", "é" * 6, "é" * 5 + "x"]
    gone, come = sorted(set(words[::2])), sorted(set(words[1::2]))
    day = day_of(1)
    sides = [spark.createDataFrame([(day, w) for w in side], "_day date, _name string") for side in (gone, come)]
    near = {(r._before, r._now): r._edits for r in near_names(*sides, 2, gram, 7).collect()}
    assert near == {
        (a, b): e for a in gone for b in come if a != b and (e := distance(a, b)) <= 2
    }


def test_blocks_of_numbered_names_grow_with_the_names(spark):
    """Names that share all their q-grams with many others."""
    def pairs(n):
        names = spark.range(n).select(
            F.lit(day_of(1)).alias("_day"), (F.col("id") % 2 == 0).alias("_gone"),
            F.format_string("user %06d", F.col("id") * 37).alias("_name"),
        )
        sizes = renames._tokens(names, 2, 2).groupBy("_token").agg(
            F.count_if("_gone").alias("gone"), F.count_if(~F.col("_gone")).alias("come")
        )
        return sizes.agg(F.sum(F.col("gone") * F.col("come")).alias("n")).first().n

    assert pairs(4_000) < 8 * pairs(1_000)


@pytest.mark.parametrize("size", [0, 8, 300])
def test_short_and_long_names_meet(spark, monkeypatch, size):
    monkeypatch.setattr(renames, "MOST_RESTS", size)
    rng = random.Random(size)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 9))) for _ in range(150)]
    gone, come = sorted(set(words[::2])), sorted(set(words[1::2]))
    sides = [spark.createDataFrame([(day_of(1), w) for w in side], "_day date, _name string") for side in (gone, come)]
    near = {(r._before, r._now): r._edits for r in near_names(*sides, 2, 2, 7).collect()}
    assert near == {(a, b): e for a in gone for b in come if a != b and (e := distance(a, b)) <= 2}


def test_planted_renames_are_found(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, planted = [], set()
    for i in range(600):
        name = "model " + "".join(rng.choice(letters) for _ in range(9))
        rows.append((f"o{i}", day_of(1), name))
        kind = i % 3
        if kind == 0:
            spot = rng.randrange(len(name))
            other = name[:spot] + rng.choice(letters) + name[spot + rng.randint(0, 1):]
            rows.append((f"n{i}", day_of(2), other))
            planted.add((f"o{i}", f"n{i}"))
        elif kind == 1:
            rows.append((f"n{i}", day_of(2), "model " + "".join(rng.choice(letters) for _ in range(9))))
    links = {(i, j) for _, i, j, _ in found(renamed_entities(spark.createDataFrame(rows, SCHEMA)))}
    assert len(links & planted) >= 0.9 * len(planted)
    assert len(links & planted) >= 0.95 * len(links)


def test_many_entities_of_one_name_make_no_pairs(spark):
    n = 3_000
    old = spark.range(n).select(F.format_string("a%05d", "id").alias("entity_id"), F.lit(day_of(1)).alias("snapshot_date"))
    new = spark.range(n + 5).select(F.format_string("b%05d", "id").alias("entity_id"), F.lit(day_of(2)).alias("snapshot_date"))
    df = old.union(new).withColumn("entity_name", F.lit("unknown"))
    links = found(renamed_entities(df))
    assert links == [(day_of(2), f"a{i:05d}", f"b{i:05d}", 0) for i in range(n)]


def test_odd_tables(spark):
    roles = Roles(entity_id="the id", entity_name="a name", snapshot_date="day")
    rows = [("1", day_of(1), "x"), ("2", day_of(2), "X "), ("3", day_of(2), None)]
    df = spark.createDataFrame(rows, SCHEMA).toDF("the id", "day", "a name")
    assert [tuple(r) for r in renamed_entities(df, roles).collect()] == [
        (day_of(2), "1", "2", "x", "X ", 0)
    ]
    empty = renamed_entities(df.limit(0), roles)
    assert empty.collect() == [] and empty.columns[0] == "day"
    assert renamed_entities(df.where("day = '2024-01-01'"), roles).collect() == []
