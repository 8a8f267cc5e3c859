import random
import re

import numpy as np
import pytest
import xxhash

from fieldrank.llm import simhash
from fieldrank.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def print_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance=4):
    """Smallest position that each position reaches, by comparing all pairs."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def near_copies(seed, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(120)) for _ in range(6)]
    out = []
    for i in range(n):
        words = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(["X", "yy", "Z"])
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("bucket", [4096, 8])
def test_equals_comparing_all_pairs(documents, bucket):
    docs = near_copies(1)
    rows = {r.doc_id: r for r in simhash.clustered(documents(*docs), bucket=bucket).collect()}
    prints = [print_of(text) for _, text in docs]
    label = groups(prints)
    assert len(set(label)) < 40
    assert [rows[i].fingerprint for i, _ in docs] == [f"{p:016x}" for p in prints]
    assert [rows[i].component_id for i, _ in docs] == label


@pytest.mark.parametrize("bucket", [2, 10, 40, 4096])
def test_links_join_a_chain_and_a_ball(spark, bucket):
    rng = np.random.default_rng(3)
    chain = np.cumsum([1 << (2 * i) for i in range(20)]).tolist()
    ball = [0xABCDEF0123456789 ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)]
    prints = sorted({*chain, *ball, *(int(x) for x in rng.integers(0, 1 << 63, 50))})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(p, 1) for p in signed], "fp long, n long")
    links = simhash.links(rows, bucket=bucket)
    found = components(links).df.collect()
    centre = {r.u: r.v for r in found}
    ours = [centre.get(p, p) for p in signed]
    label = groups(prints)
    assert len(set(zip(ours, label))) == len(set(ours)) == len(set(label))


def test_a_close_group_gives_few_links():
    fps = np.array([(1 << 40) | (1 << i) for i in range(30)], dtype=np.uint64)
    found = list(simhash.near(fps, 4))
    assert sum(len(members) for members, _ in found) == 29


def test_odd_documents(odd_documents, clashing):
    rows = simhash.clustered(clashing(odd_documents)).collect()
    assert len(rows) == 12
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].fingerprint for i in (1, 2, 3)} == {"0" * 16}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[9].component_id == 6 and by_id[5].component_id == 5
    assert sorted((r.component_id for r in rows if r.doc_id is None), key=str) == [1, None]
    assert simhash.clustered(odd_documents.limit(0)).collect() == []


def test_one_document_of_each_group_stays(odd_documents, documents, clashing):
    docs = clashing(odd_documents)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8]
    assert simhash.deduplicated(odd_documents.limit(0)).collect() == []
    copies = near_copies(2)
    label = groups([print_of(text) for _, text in copies])
    left = simhash.deduplicated(documents(*copies), bucket=8).collect()
    assert sorted(r.doc_id for r in left) == sorted(set(label))
    assert all(dict(copies)[r.doc_id] == r.text for r in left)


def test_long_chain_of_edges(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    assert {r.v for r in components(edges).df.collect()} == {0}
    assert components(edges).rows == 300
