import zlib
from collections import Counter

from fieldrank.llm.sharding import sharded
from fieldrank.operators import ranking


def rows_of(df, shards=5, **options):
    return sharded(df, [1.0] * shards, **options).collect()


def test_law_of_the_key(documents):
    docs = documents(*[(i, f"text {i}") for i in range(800)])
    now, grown = rows_of(docs), {r.doc_id: r.shard for r in rows_of(docs, 6)}
    moved = 0
    for row in now:
        assert row.size == len(f"text {row.doc_id}") + 8
        assert row.text_crc32 == zlib.crc32(f"text {row.doc_id}".encode())
        assert row.grown_shard == grown[row.doc_id]
        assert row.grown_shard in (row.shard, 5)
        moved += row.grown_shard != row.shard
    assert 80 < moved < 190
    again = {r.doc_id: r.shard for r in rows_of(docs.orderBy("text").repartition(3))}
    assert again == {r.doc_id: r.shard for r in now}


def gapless(rows):
    shards = {}
    for row in rows:
        shards.setdefault(row.shard, []).append(row.slot)
    return all(sorted(slots) == list(range(len(slots))) for slots in shards.values())


def test_slots_have_no_gaps_whatever_the_way(documents, monkeypatch):
    docs = documents(*[(i % 40, "t") for i in range(400)])
    assert gapless(rows_of(docs))
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 20)
    assert gapless(rows_of(docs))


def test_weights_share_records(documents):
    docs = documents(*[(i, "t") for i in range(3000)])
    counts = Counter(r.shard for r in sharded(docs, [1.0, 2.0, 3.0]).collect())
    assert all(abs(counts[i] - 500 * (i + 1)) < 120 for i in range(3))


def test_odd_documents(odd_documents, clashing):
    rows = rows_of(clashing(odd_documents))
    assert len(rows) == 12 and gapless(rows)
    assert {r.size for r in rows if r.doc_id == 1} == {8}
    assert len({r.shard for r in rows if r.doc_id == 6}) == 1
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert rows_of(odd_documents.limit(0)) == []


def test_no_python(documents):
    plan = sharded(documents((1, "a")), [1.0] * 3)._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow"))
