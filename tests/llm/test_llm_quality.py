import random
import re
from collections import Counter, defaultdict

import pytest

from fieldrank.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {
        i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)
    }
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated,
            len(covered), failed)


def normal(line):
    return " ".join(WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)))


def verdicts(docs, line_docs, line_share):
    """(id, kept, text that is left) by brute force."""
    holders, hosts = defaultdict(set), defaultdict(set)
    for _, text, host in docs:
        hosts[host].add(text or "")
        for line in (text or "").split("\n"):
            if normal(line):
                holders[host, normal(line)].add(text)
    out = []
    for doc_id, text, host in docs:
        common = {
            line for line in (text or "").split("\n")
            if len(holders[host, normal(line)]) > max(line_docs, line_share * len(hosts[host]))
        }
        left = "\n".join(line for line in (text or "").split("\n") if line not in common)
        total, _, _, _, _, failed = counts(text)
        rest = len(WORD.findall(left))
        out.append((doc_id, not failed and rest >= 10 and rest >= 0.3 * total, left))
    return out


def corpus(seed):
    rng = random.Random(seed)
    def line(n):
        return " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    common = ["Read  MORE about this here", "All rights reserved by us and them"]
    docs = []
    for i in range(60):
        lines = [line(rng.randint(1, 12)) for _ in range(rng.randint(0, 6))]
        if rng.random() < 0.6:
            lines.insert(rng.randint(0, len(lines)), rng.choice(common).replace("  ", rng.choice([" ", "\t"])))
        if rng.random() < 0.2 and lines:
            lines += [lines[0]] * 3
        docs.append((i, "\n".join(lines) + rng.choice(["", "\n", " #$|"]), rng.choice(["a", "b", None])))
    return docs + [(100 + i, docs[5][1], "a") for i in range(30)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(documents, seed):
    docs = corpus(seed)
    limits = {"line_docs": 5, "line_share": 0.1}
    rows = {r.doc_id: r for r in quality.report(documents(*docs), **limits).collect()}
    expected = verdicts(docs, 5, 0.1)
    for (doc_id, text, _), (_, kept, _) in zip(docs, expected):
        r = rows[doc_id]
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == counts(text)
        assert r.kept == kept
    left = {r.doc_id: r.text for r in quality.filtered(documents(*docs), **limits).collect()}
    assert left == {doc_id: text for doc_id, kept, text in expected if kept}
    assert any(text != dict((d[0], d[1]) for d in docs)[i] for i, text in left.items())


def test_many_distinct_words_take_the_exact_way():
    rng = random.Random(4)
    words = [f"w{i}".encode() for i in range(40_000)]
    rng.shuffle(words)
    assert quality.repeat_words(words) == 0
    assert quality.repeat_words(words + words[100:107]) == 14


def test_copies_of_a_text_are_one_document(documents):
    text = "\n".join(f"line {i} has some words in it" for i in range(5))
    docs = documents(*[(i, text) for i in range(50)], *[(100 + i, f"other {i} " * 12) for i in range(3)])
    rows = quality.report(docs, line_docs=1, line_share=0.0).where("doc_id < 100").collect()
    assert all(r.n_left == r.n_words for r in rows)


def test_odd_documents(odd_documents, clashing):
    docs = clashing(odd_documents)
    rows = quality.report(docs).collect()
    assert len(rows) == 12
    for row in rows:
        if row.doc_id in (1, 2, 3):
            assert (row.n_words, row.base_failed, row.kept) == (0, True, False)
    kept = quality.filtered(docs)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [5]
    assert quality.report(odd_documents.limit(0)).collect() == []
    assert quality.filtered(odd_documents.limit(0)).collect() == []


def test_near_copies_of_a_text_are_one_document(documents):
    rng = random.Random(5)

    def line(n):
        return " ".join(f"w{rng.randint(0, 4000)}" for _ in range(n))

    shared = [line(40) for _ in range(30)]
    family = [(i, "\n".join([*shared, f"copy {i}"])) for i in range(40)]
    others = [(100 + i, f"{line(30)}\nRead more about this here") for i in range(40)]
    rows = {r.doc_id: r for r in quality.report(documents(*family, *others)).collect()}
    assert all(rows[i].kept and rows[i].n_left == rows[i].n_words for i, _ in family)
    assert all(rows[i].n_left == rows[i].n_words - 5 for i, _ in others)
    left = {r.doc_id: r.text for r in quality.filtered(documents(*family, *others)).collect()}
    assert all(left[i] == text for i, text in family)


def test_a_shared_line_goes_from_a_large_source(documents):
    rng = random.Random(6)
    shared = "Read more about this here"

    def text(i):
        own = " ".join(f"w{rng.randint(0, 4000)}" for _ in range(30))
        return f"{own}\n{shared}" if i % 11 == 0 else own

    docs = [(i, text(i)) for i in range(500)]
    left = {r.doc_id: r.text for r in quality.filtered(documents(*docs)).collect()}
    assert len(left) == 500 and not any(shared in t for t in left.values())
