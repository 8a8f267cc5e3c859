import pytest
from conftest import as_set
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_scoring import random_field

from fieldrank import materialise as written
from fieldrank.operators import movements, ranking, reports, scoring, statistics
from fieldrank.operators.scoring import Scaling


@pytest.fixture
def skewed(spark):
    """One group holds most rows, and most of them tie."""
    return spark.range(3_000).select(
        F.when(F.col("id") % 10 < 8, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 10))
        .alias("grp"),
        F.format_string("%06d", F.col("id")).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise((F.col("id") % 17).cast("double"))
        .alias("score"),
    )



def numbered(df, window_rows):
    sizes = ranking.group_sizes(df, ["grp"])
    rows = written.join_stored(df, sizes, ["grp"])
    return ranking.number_rows(
        rows, ["grp"],
        {"up": [F.col("score"), F.col("key")], "down": [F.col("score").desc(), F.col("key")]},
        "n_rows", sizes.observed["largest"], window_rows,
    )


@pytest.mark.parametrize("window_rows", [0, 500])
def test_two_passes_equal_the_window(skewed, window_rows):
    assert as_set(numbered(skewed, window_rows)) == as_set(numbered(skewed, 10_000))


def test_two_passes_equal_the_window_without_broadcast(skewed, monkeypatch):
    expected = as_set(numbered(skewed, 10_000))
    monkeypatch.setattr(written, "BROADCAST_ROWS", 0)
    assert as_set(numbered(skewed, 500)) == expected


@pytest.mark.parametrize("window_rows", [0, 5, 500])
@pytest.mark.parametrize("value", ["score", "number"])
def test_distribution_counts_up_to_each_value(skewed, window_rows, value):
    rows = skewed.withColumn("number", F.col("key").cast("int"))
    found = ranking.distribution(rows, ["grp"], value, 10_000, window_rows)
    upto = Window.partitionBy("grp").orderBy(value).rangeBetween(Window.unboundedPreceding, 0)
    expected = rows.select(
        "grp", value,
        F.count("*").over(Window.partitionBy("grp", value)).alias("n_equal"),
        F.count("*").over(upto).alias("n_upto"),
    ).distinct()
    assert as_set(found) == as_set(expected)


@pytest.mark.parametrize("window_rows", [0, 5, 500])
def test_percent_ranks_of_large_groups(skewed, window_rows):
    sizes = ranking.group_sizes(skewed, ["grp"])
    rows = written.join_stored(skewed, sizes, ["grp"])

    def ranked(limit):
        return as_set(ranking.percent_ranks(
            rows, ["grp"], {"share": "score"}, "key", "n_rows", sizes.observed["largest"], limit
        ))

    assert ranked(window_rows) == ranked(10_000)


@pytest.mark.parametrize("scaling", [Scaling(), Scaling("percent_rank"), Scaling("z_score")])
def test_leaderboard_is_the_same_on_both_ways(snapshot_rows, scaling):
    rows = random_field(snapshot_rows, 9)
    options = {"scaling": scaling, "exact_cuts": True}
    small = scoring.leaderboard(rows, **options)
    large = scoring.leaderboard(rows, window_rows=30, **options)
    assert as_set(small) == as_set(large)


def test_exact_quantiles_are_the_same_on_both_ways(snapshot_rows):
    rows = statistics.with_mean_price(scoring.scorable(random_field(snapshot_rows, 10)))
    measured = statistics.measure(rows, cuts=None)

    def cuts(limit):
        return as_set(statistics.exact_quantiles(
            rows, "mean_price", (0.33, 0.66), ("low", "mid"), measured, window_rows=limit
        ))

    assert cuts(0) == cuts(None)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_join_equals_broadcast_join(skewed, how, monkeypatch):
    side = written.materialise(
        skewed.groupBy("grp").agg(F.count("*").alias("n")).where("grp != 'g8'")
    )
    near = as_set(written.join_stored(skewed, side, ["grp"], how))
    monkeypatch.setattr(written, "BROADCAST_ROWS", 0)
    assert as_set(written.join_stored(skewed, side, ["grp"], how)) == near


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_shuffled_side_is_not_copied_and_hot_keys_are_split(spark, how, monkeypatch):
    """One key holds nine tenths; the side goes into the shuffle once."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    monkeypatch.setattr(written, "BROADCAST_ROWS", 0)
    key = F.when(F.col("id") % 10 == 0, F.col("id") % 100).otherwise(7)
    rows = spark.range(0, 100_000, 1, 8).select(key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    side = written.materialise(spark.range(100).select(F.col("id").alias("key"), (F.col("id") * 2).alias("n")))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = written.join_stored(rows, side, ["key"], how)
        found = joined.collect()
        execution = joined._jdf.queryExecution()
        execution.executedPlan().executeCollect()
        plan = execution.executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(found) == (0 if how == "left_anti" else 100_000)
    assert "skew=true" in plan and "Generate" not in plan


def test_wide_sides_are_not_broadcast(spark):
    text = F.repeat(F.lit("x"), 1_000_000).alias("t")
    side = written.materialise(spark.range(40).select("id", text))
    assert side.rows == 40 and side.nbytes > written.BROADCAST_BYTES
    assert not side.fits_broadcast


def test_materialise_counts_and_keeps_values(spark):
    stored = written.materialise(spark.range(10).toDF("v"), top=F.max("v"))
    assert (stored.rows, stored.observed["top"], stored.df.count()) == (10, 9, 10)
    assert stored.fits_broadcast


def test_materialise_of_nothing(spark):
    stored = written.materialise(spark.range(10).where("id < 0"), top=F.max("id"))
    assert (stored.rows, stored.nbytes, stored.observed["top"]) == (0, 0, None)
    assert stored.df.count() == 0


def test_keep_first_prunes_before_the_shuffle(skewed):
    first = ranking.keep_first(skewed, ["grp"], [F.col("score"), F.col("key")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle
    assert first.count() == 3


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.conf = {"spark.checkpoint.dir": folder}
        self.master, self.applicationId = master, "app"


def test_scratch_folder_is_the_sessions_own():
    given = written.scratch_folder(Session("yarn", "s3a://shared/checkpoints/"))
    assert given.startswith("s3a://shared/checkpoints/fieldrank/app/")
    assert "fieldrank" in written.scratch_folder(Session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        written.scratch_folder(Session("yarn"))


def test_numbers_have_one_type_at_every_size(skewed):
    sizes = ranking.group_sizes(skewed, ["grp"])
    rows = written.join_stored(skewed, sizes, ["grp"])
    orders = {"number": [F.col("score"), F.col("key")]}
    for limit in (500, 5_000):
        found = ranking.number_rows(rows, ["grp"], orders, "n_rows", 3_000, window_rows=limit)
        assert found.schema["number"].dataType.simpleString() == "bigint"


def test_nothing_depends_on_broadcasts(snapshot_rows, monkeypatch):
    rows = random_field(snapshot_rows, 12)

    def results(limit):
        board = scoring.leaderboard(rows, exact_cuts=True, window_rows=limit)
        ranked = scoring.leaderboard(rows, scaling=Scaling("percent_rank"), window_rows=limit)
        return [as_set(found) for found in (
            board, ranked, reports.ever_top_n(board, 2), movements.entered_dropped(board)
        )]

    expected = results(None)
    monkeypatch.setattr(written, "BROADCAST_ROWS", 0)
    assert results(None) == expected
    assert results(20) == expected
