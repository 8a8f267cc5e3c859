import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fieldrank.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, said, role, text))
    turns = {c: [t[3:] for t in sorted(all_turns)] for c, all_turns in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def brute(rows):
    members = defaultdict(list)
    convs = rebuilt(rows)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        below = [sums[child] for child in children[node]]
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, ids in members.items():
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]),
            *sums[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(map(repr, out))


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(repr(tuple(row)) for row in prefix_trie.trie(df, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for c in [*range(-3, 12), *range(95, 130), *range(400, 420), 777]:
        said = [rng.choice("ab") * rng.randint(0, 2) for _ in range(rng.randint(1, 7))]
        out += [(c, i, rng.choice(["user", None]), text) for i, text in enumerate(said)]
    # A deep chain that two conversations share, repeated rows, nulls, equal turns.
    for c in (2000, 2007):
        out += [(c, i, "user", f"t{i}") for i in range(300)]
    out += [(5, None, None, None), (5, None, None, None), (5, 1, "x", "y"), (5, 1, "x", "z"), (None, 0, "u", "t")]
    return out


@pytest.mark.parametrize("options", [
    {}, {"task_nodes": 25, "at_once": 4, "ids_at_once": 2}, {"task_nodes": 3},
])
def test_equals_brute_force(spark, rows, options):
    # Fewer shuffle partitions keep the many rounds of the smallest components short.
    expected = brute(rows if options.get("task_nodes") != 3 else rows[:120])
    assert found(spark, rows if options.get("task_nodes") != 3 else rows[:120], **options) == expected


def test_turnless_conversations_end_in_the_root(spark):
    # No conversation 100 exists, and these borrow more turns than they have.
    ids = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6][:3]
    table = [(c, 0, "user", "lost") for c in ids]
    assert found(spark, table) == brute(table)
    assert len(brute(table)) == 1


def test_empty_table_and_further_columns(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows[:40], SCHEMA)
    names = ["node", "parent", "depth", "comp", "weight", "place", "said", "chars", "n_rows", "length"]
    other = prefix_trie.trie(df.withColumns({name: F.lit("own") for name in names}))
    assert sorted(repr(tuple(r)) for r in other.collect()) == brute(rows[:40])
    assert prefix_trie.trie(df.limit(0)).collect() == []


def test_deep_component_in_one_task():
    n = 3000
    sums = [[0] * n, [0] * n]
    prefix_trie._added([-1, *range(n - 1)], list(range(n, 0, -1)), [[1] * n, list(range(n))], sums)
    assert sums[0] == list(range(n, 0, -1)) and sums[1][0] == n * (n - 1) // 2
