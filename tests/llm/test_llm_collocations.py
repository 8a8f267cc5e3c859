import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fieldrank.llm import collocations
from fieldrank.llm.collocations import tokens

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least=30, longest=4, within=80, first=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i:i + k])] += 1
    rows = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        inner = defaultdict(int)
        for g, a in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inner[g[i:i + k]] = max(inner[g[i:i + k]], a)
        scored = []
        for g, a in found.items():
            if 100 * inner[g] >= within * a:
                continue
            cuts = [(counts[g[:k]], counts[g[k:]]) for k in range(1, len(g))]
            score, _, l, r = min(
                (2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts)
            )
            scored.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:first], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(rows)


def mined(spark, docs, **options):
    rows = spark.createDataFrame([(*d, "own") for d in docs], "text string, lang string, first string")
    return sorted(map(tuple, collocations.collocations(rows, **options).collect()))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    words = ["in", "order", "to", "New", "York", "of", "é", "\x1cx", "the", "a"]
    docs = []
    for i in range(150):
        text = "".join(
            rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!", "  "])
            for _ in range(rng.randint(0, 80))
        )
        docs.append((text + " in order to see new york ", rng.choice(["en", "de", None, "und"])))
    return [*docs, (None, "en"), ("", None), ("...", "fr"), (" the the the the" * 40, "en")]


@pytest.mark.parametrize("options", [
    {},
    {"broadcast": False, "block_words": 50, "one_number": 0},
    {"block_words": 7},
])
def test_equals_brute_force(spark, corpus, options):
    expected = brute(corpus, least=12)
    assert mined(spark, corpus, least=12, **options) == expected
    assert len(expected) > 60 and {row[0] for row in expected} == {"en", "de", "und"}


def test_the_first_of_many(spark, corpus):
    assert mined(spark, corpus, least=5, first=7) == brute(corpus, least=5, first=7)


def test_other_lengths(spark, corpus):
    assert mined(spark, corpus, least=12, longest=2) == brute(corpus, least=12, longest=2)
    assert mined(spark, corpus, least=12, longest=6) == brute(corpus, least=12, longest=6)


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_parts_of_a_text_do_not_change_its_words():
    text = "Ab c,d\te.f  g\n" * 50
    whole = [word for part in tokens(text.encode()) for word in part]
    for size in (1, 3, 10):
        assert [word for part in tokens(text.encode(), size) for word in part] == whole


def test_more_than_64_bits_in_a_pair():
    first = np.array([1, 1, 5], dtype=np.int64) << 59
    last = np.array([1, 3, 3], dtype=np.int64) << 59
    known = collocations._Frequent(first, last, np.array([7, 8, 9]))
    found = known.find(np.array([1, 5, 5, 2]) << 59, np.array([3, 3, 1, 1]) << 59)
    assert found.tolist() == [8, 9, -1, -1]


@pytest.mark.parametrize("broadcast", [True, False])
def test_python_gets_and_gives_short_batches(spark, monkeypatch, broadcast):
    monkeypatch.setattr(collocations, "BATCH_BYTES", 20_000, raising=False)
    frame, rows = type(spark.range(0)), 1 << 15
    whole = frame.mapInArrow

    def checked(df, function, schema):
        def run(batches):
            def given():
                for batch in batches:
                    assert batch.num_rows == 1 or batch.slice(0, batch.num_rows - 1).nbytes <= 20_000, "large"
                    yield batch

            for batch in function(given()):
                assert batch.num_rows <= rows, "long"
                yield batch

        return whole(df, run, schema)

    monkeypatch.setattr(frame, "mapInArrow", checked)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    rng = random.Random(5)
    docs = [(" ".join(f"w{rng.randrange(300)}" for _ in range(5_000)), "en") for _ in range(40)]
    expected = brute(docs, least=3)
    assert mined(spark, docs, least=3, broadcast=broadcast, block_words=45_000) == expected and expected
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_words_of_one_spelling_in_several_languages(spark):
    docs = [("a\x00b c " * 20, "x"), ("c " * 20, "x\ta\x00b"), ("b c " * 20, "x\ta"), ("ä\x1f c " * 9, None)]
    for broadcast in (True, False):
        assert mined(spark, docs, least=5, broadcast=broadcast) == brute(docs, least=5) != []
