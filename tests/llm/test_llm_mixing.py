import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldrank.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Share by weight; what is above a cap is shared again among the others."""
    total, capped = share * sum(sizes.values()), {}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        share_of = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share_of[s] > cap * sizes[s]]
        if not above:
            return capped | share_of
        capped |= {s: cap * sizes[s] for s in above}


def corpus(documents, per_source):
    rows, i = [], 0
    for source, n in per_source.items():
        for k in range(n):
            rows.append((i, "w " * (1 + (i * 7 + k) % 11), source))
            i += 1
    return documents(*rows)


@pytest.mark.parametrize("sources", [
    {"a": 300, "b": 40, "c": 90, "d": 10}, {"a": 5, "b": 900, None: 60}, {"only": 50},
])
def test_targets_and_what_is_taken(documents, sources, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    docs = corpus(documents, sources)
    rows = mixing.mix_report(docs, 4).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken = Counter(), Counter()
    for row in rows:
        sizes[row.source] += row.size
        taken[row.source] += row.taken
        assert row.taken in (0, row.size, 2 * row.size)
        assert len(list(filter(None, row.shards.split(",")))) * row.size == row.taken
    ordered = dict(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")))
    expected = targets(ordered)
    for row in rows:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(expected[row.source])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 6
    again = mixing.mix_report(docs.repartition(3), 4).collect()
    assert sorted(map(str, again)) == sorted(
        map(str, mixing.mix_report(docs, 4).collect())
    )


def test_shards_hold_exact_and_equal_quotas_of_blocks(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 1)
    docs = documents(*[(i, "one two", "a" if i % 3 else "b") for i in range(400)])
    counts = Counter()
    for row in mixing.mix_report(docs, 6).collect():
        counts.update(filter(None, row.shards.split(",")))
    assert len(counts) == 6 and max(counts.values()) - min(counts.values()) < 40


def test_tree_deals_every_block_once(spark):
    have = {"sa": 50, "sb": 7, "sc": 1}
    counts = spark.createDataFrame(list(have.items()), "_key string, _n long")
    for shards in (1, 2, 5, 8, 58, 150):
        quotas = mixing._quotas(counts, shards, 0).collect()
        by_source, by_shard = Counter(), Counter()
        for row in quotas:
            assert row._quota > 0 and 0 <= row._low < shards
            by_source[row._key] += row._quota
            by_shard[row._low] += row._quota
        assert by_source == have
        assert len(by_shard) == min(shards, 58)
        assert max(by_shard.values()) - min(by_shard[s] for s in range(shards)) <= 2
    assert mixing._quotas(counts.limit(0), 4, 0).collect() == []


@pytest.mark.parametrize("total, marked, drawn", [
    (10, 4, 5), (7, 7, 3), (9, 0, 4), (6, 5, 6), (40, 13, 20), (3, 1, 0), (5000, 1700, 2500),
])
def test_single_draws_have_exact_probabilities(spark, total, marked, drawn):
    n = 20_000
    args = [F.lit(x).cast("long") for x in (total, marked, drawn)]
    got = spark.range(n).select(
        mixing.hypergeometric(*args, (F.col("id") + 0.5) / n).alias("k")
    ).groupBy("k").count()
    counts = {row.k: row["count"] for row in got.collect()}
    assert sum(counts.values()) == n
    for k in range(marked + 1):
        exact = math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn) \
            if k <= drawn and drawn - k <= total - marked else 0
        assert abs(counts.get(k, 0) - n * exact) <= 2


def test_joint_draws_are_multivariate_hypergeometric(spark):
    n, have = 20_000, {"sa": 3, "sb": 2, "sc": 4}
    nodes = spark.range(n).select(
        (F.col("id") * 2).cast("int").alias("_low"), (F.col("id") * 2 + 2).cast("int").alias("_high"),
        F.array(*[
            F.struct(F.lit(k).alias("_key"), F.lit(v).cast("long").alias("_n")) for k, v in have.items()
        ]).alias("_have"),
    )
    left = mixing._halves(nodes, 3).where("_low % 2 = 0").collect()
    found = Counter(
        tuple({x._key: x._n for x in row._have}.get(key, 0) for key in have) for row in left
    )
    cells = 0
    for a in range(4):
        for b in range(3):
            c = 4 - a - b
            if not 0 <= c <= 4:
                assert (a, b, c) not in found
                continue
            exact = n * math.comb(3, a) * math.comb(2, b) * math.comb(4, c) / math.comb(9, 4)
            assert abs(found[a, b, c] - exact) <= 5 * math.sqrt(exact)
            cells += 1
    assert cells == len(found) and sum(found.values()) == n


def test_no_shard_is_empty(documents):
    docs = documents(*[(i, "one two", "a" if i % 3 else "b") for i in range(600)])
    shards = Counter()
    for row in mixing.mix_report(docs, 400).collect():
        shards.update(filter(None, row.shards.split(",")))
    assert len(shards) == 400


def test_a_task_may_hold_several_shards(documents, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_TASKS", 2)
    docs = corpus(documents, {"a": 60, "b": 25, "c": 30})
    mixed = mixing.mixed_documents(docs, 100)
    assert mixed.rdd.getNumPartitions() == 2
    report = mixing.mix_report(docs, 4).agg(F.sum("taken")).first()[0]
    assert mixed.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == report


def test_mixed_rows_follow_the_report(documents, clashing, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    docs = clashing(corpus(documents, {"a": 60, "b": 25, "c": 30}))
    words = docs.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    mixed = mixing.mixed_documents(docs, math.ceil(1.5 * words / 4))
    assert mixed.columns == docs.columns
    placed = mixed.select("doc_id", F.spark_partition_id().alias("shard")).collect()
    report = mixing.mix_report(docs, 4).collect()
    expected = Counter(
        (r.doc_id, int(s)) for r in report for s in r.shards.split(",") if s
    )
    assert Counter((r.doc_id, r.shard) for r in placed) == expected


def test_odd_documents(odd_documents, clashing):
    rows = mixing.mix_report(clashing(odd_documents), 4).collect()
    assert len(rows) == 12
    assert all(r.taken <= 2 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix_report(odd_documents.limit(0), 4).collect() == []
    assert mixing.mixed_documents(odd_documents.limit(0)).collect() == []
    wordless = odd_documents.where("doc_id < 4")
    assert {(r.target, r.taken) for r in mixing.mix_report(wordless, 4).collect()} == {(0.0, 0)}


def test_no_python(documents):
    docs = documents((1, "a b c"))
    for df in (mixing.mix_report(docs, 4), mixing.mixed_documents(docs)):
        plan = df._jdf.queryExecution().toString()
        assert not any(name in plan for name in ("Python", "Pandas", "Arrow"))
