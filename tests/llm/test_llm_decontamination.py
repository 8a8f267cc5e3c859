import hashlib
import random
import re

import pytest

from fieldrank.llm import decontamination
from fieldrank.llm.common import whole

ITEM = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items, width=13):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            for i in range(max(1, len(v) - width + 1) if v else 0):
                window = v[i:i + width]
                for j in range(len(w) - len(window) + 1):
                    if w[j:j + len(window)] == window:
                        hit.update(range(j, j + len(window)))
                        found.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def ours(docs, benchmark, **options):
    rows = decontamination.contamination(docs, benchmark, **options).drop("spans").collect()
    return sorted(map(tuple, rows), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "ünd", "x1", "Zeta", "é"]
    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i % 7, text(rng.choice([1, 4, 13, 14, 30]))) for i in range(9)] + [(None, text(5)), (3, None)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(25)]
    docs += [(100 + i, f"{text(20)} {item} {text(9)}") for i, (_, item) in enumerate(items) if item]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    docs, items = case(seed)
    for options in ({}, {"block_bytes": 60}):
        found = ours(
            spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items, ITEM), **options,
        )
        assert found == brute(docs, items)


def test_small_indexes_find_the_same():
    docs, items = case(5)
    items = [(str(i), text.encode()) for i, text in items if text]
    texts = [text.encode() for _, text in docs]
    windows = decontamination.Windows(items, 13)
    large = decontamination.Scanner(windows)(texts)
    for shard in (1, 7, 40):
        assert decontamination.Scanner(windows, shard)(texts) == large


def test_odd_documents(spark, odd_documents, clashing):
    items = spark.createDataFrame([(1, "six words stand in this text"), (2, "")], ITEM)
    plain = ours(odd_documents, items)
    assert ours(clashing(odd_documents), items) == plain
    assert plain == brute([(r.doc_id, r.text) for r in odd_documents.collect()],
                          [(1, "six words stand in this text"), (2, "")])
    kept = decontamination.without_contaminated(clashing(odd_documents), items)
    assert kept.columns == clashing(odd_documents).columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7, 8]


def test_empty_tables(spark, odd_documents):
    none = spark.createDataFrame([], ITEM)
    assert decontamination.contamination(odd_documents.limit(0), none).collect() == []
    assert {r.n_hit for r in decontamination.contamination(odd_documents, none).collect()} == {0}


def test_removal_spans(spark, documents):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    docs = documents((1, f"Before it. {item.title()}! After, it."), (2, "nothing here"))
    found = decontamination.cleaned(docs, spark.createDataFrame([(1, item)], ITEM))
    rows = {r.doc.doc_id: r for r in found.collect()}
    assert [tuple(s) for s in rows[1].spans] == [(2, 16)]
    assert words(rows[1].cleaned_text) == ["before", "it", "after", "it"]
    assert rows[2].cleaned_text == "nothing here"


def test_no_shuffle(spark, documents):
    docs = documents((1, "a"))
    plan = decontamination.scanned(whole(docs), spark.createDataFrame([(1, "a b c")], ITEM))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
