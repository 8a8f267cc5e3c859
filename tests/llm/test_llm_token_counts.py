import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer, models

from fieldrank.llm import token_counts as tc

DATA = open(tc.vocabulary_path(), "rb").read()
LIBRARY = Tokenizer.from_buffer(DATA)


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(DATA)


def expected(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def same(counter, texts):
    return counter.count([t.encode() for t in texts]) == expected(texts)


def test_random_texts(counter):
    rng = random.Random(1)
    letters = "abcdehilnorstuxyz '.,!<|>1é中 ΑΣς́ 　\x1c\x85İ\U0001D7D8"
    assert same(counter, ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(2000)])


def test_every_code_point(counter):
    points = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    assert same(counter, ["a".join(points[i:i + 50]) for i in range(0, len(points), 500)])


def test_special_strings_and_long_words(counter):
    rng = random.Random(2)
    assert same(counter, [
        "<|endoftext|>", "a<|startoftext|>b<|endoftext|><|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "",
        "x" * 5000, "ab" * 3000, "漢字" * 2000, "the" * 2000, "👍" * 300, " \n\t ",
        "".join(rng.choices("abcdeinorst", k=20_000)),
    ])


def test_remembered_chunks_give_the_same(counter, monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 0)
    texts = ["some words and some more words", "more words"] * 3
    assert [counter.count([t.encode()])[0] for t in texts] == expected(texts)


def one_by_one(rules, symbols):
    """The pair of lowest rank, leftmost first, one merge at a time."""
    symbols = list(symbols)
    while True:
        pairs = [int(rules.rank(np.array([a]), np.array([b]))[0]) for a, b in zip(symbols, symbols[1:])]
        if not pairs or min(pairs) == tc._NONE:
            return len(symbols)
        at = pairs.index(min(pairs))
        symbols[at:at + 2] = [int(rules.results[min(pairs)])]


@pytest.mark.parametrize("seed", range(8))
def test_rules_out_of_order(seed):
    """Results that take part in pairs of lower rank: one merge after the other."""
    rng = random.Random(seed)
    names = dict.fromkeys([*tc.byte_letters(), "ab", "bc", "abc", "aba", "bb", "aa", "abca", "abcab", "bcb"])
    vocabulary = {name: i for i, name in enumerate(names)}
    merges = [[a, b] for a in names for b in names if len(a + b) < 6 and a + b in vocabulary]
    rng.shuffle(merges)
    rules = tc.Merges(vocabulary, merges)
    assert rules.unsafe.any()
    words = ["".join(rng.choices("abc", k=rng.randint(1, 40))) for _ in range(60)]
    symbols, lengths = rules.symbols(words)
    starts = np.cumsum(lengths) - lengths
    parts = [symbols[a:a + n] for a, n in zip(starts, lengths)]
    wanted = [one_by_one(rules, part) for part in parts]
    assert tc.count_in_rounds(rules, symbols.copy(), lengths).tolist() == wanted
    assert [tc.count_by_places(rules, part) for part in parts] == wanted
    library = Tokenizer(models.BPE(vocabulary, [tuple(m) for m in merges]))
    assert [len(library.encode(word).ids) for word in words] == wanted


def test_rows(spark, odd_documents, clashing):
    rows = odd_documents.collect()
    wanted = [
        (r.doc_id, len((r.text or "").encode()), n, n > 10) for r, n in zip(rows, expected([r.text or "" for r in rows]))
    ]
    found = tc.counted(clashing(odd_documents), limit=10).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
    assert tc.counted(odd_documents.limit(0)).collect() == []


def test_other_vocabularies_are_refused(spark, tmp_path, documents):
    path = tmp_path / "words.json"
    Tokenizer(models.WordLevel({"a": 0}, "a")).save(str(path))
    with pytest.raises(Exception, match="NoneType|byte-level"):
        tc.Counter(path.read_bytes())
