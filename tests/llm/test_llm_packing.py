from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldrank.llm import packing

TOKENIZER = packing.encoding(packing.VOCABULARY, open(packing.VOCABULARY, "rb").read())


@given(st.lists(st.integers(1, 30), max_size=60))
@settings(max_examples=80, deadline=None)
def test_best_fit_equals_a_plain_search(sizes):
    rooms = []
    for size in sorted(sizes, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            rooms[min(fits)[1]] -= size
        else:
            rooms.append(30 - size)
    packed = packing.best_fit(np.array(sizes, dtype=np.int64), 30)
    assert sorted(i for s in packed for i in s) == list(range(len(sizes)))
    assert sorted(30 - sum(sizes[i] for i in s) for s in packed) == sorted(rooms)


def texts_from(rows, length):
    """Texts by id, put together from the segments, with checks of each sequence."""
    parts = defaultdict(list)
    for row in rows:
        ids = np.frombuffer(row.ids, dtype="<u4")
        assert len(ids) == length and row.cu_seqlens[0] == 0 and row.cu_seqlens[-1] == row.n_tokens
        assert (ids[row.n_tokens:] == packing.PAD).all()
        assert row.position_resets == row.cu_seqlens[:-1]
        for doc, first, a, b in zip(row.doc_ids, row.first_tokens, row.cu_seqlens, row.cu_seqlens[1:]):
            assert 0 < b - a <= length
            parts[doc].append((first, ids[a:b].tolist()))
    return parts


@pytest.mark.parametrize("length", [16, 2048])
def test_every_token_comes_back(documents, length):
    docs = [(i, f"Some text, no {i}.\n\n" * (i % 9) + "ü€" * (i % 50)) for i in range(120)]
    docs.append((500, "a long text " * 20_000))
    rows = packing.packed_sequences(documents(*docs), length=length, shard_tokens=5000).collect()
    parts = texts_from(rows, length)
    assert set(parts) == {i for i, text in docs if text}
    for doc, text in docs:
        ordered = sorted(parts.get(doc, []))
        ids = [t for _, p in ordered for t in p]
        assert [first for first, _ in ordered] == list(range(0, len(ids), length))
        assert ids == TOKENIZER.encode_ordinary(text)
    assert len({(r.shard, r.sequence) for r in rows}) == len(rows)


def test_parts_of_long_texts_keep_the_tokens():
    for text in ("word, and  more\n\nlines é " * 9000, " \n\t" * 50_000 + "x", "a b" * 70_000):
        ids = [t for part in packing.parts_of(text) for t in TOKENIZER.encode_ordinary(part)]
        assert TOKENIZER.decode(ids) == text
    text = "word, and  more\n\nlines é " * 9000
    ids = [t for part in packing.parts_of(text) for t in TOKENIZER.encode_ordinary(part)]
    assert ids == TOKENIZER.encode_ordinary(text)


def test_matrices_round_trip(spark, documents, tmp_path):
    docs = documents(*[(i, f"text number {i} " * (1 + i % 30)) for i in range(90)])
    packing.write_matrices(docs, str(tmp_path / "m"), length=64, shard_tokens=3000)
    found = Counter()
    for row in spark.read.parquet(str(tmp_path / "m")).collect():
        packed = packing.read_matrix(row)
        positions = np.frombuffer(row.positions, dtype="<i4").reshape(packed.ids.shape)
        assert (positions == packed.positions()).all()
        for ids, ends, segments in zip(packed.ids, packed.ends, packed.segments):
            for (doc, _, size), start in zip(segments, ends):
                found[doc] += size
                assert positions[len(positions) and 0].shape == (64,)
                assert size <= 64 and start + size <= 64
    assert found == {i: len(TOKENIZER.encode_ordinary(f"text number {i} " * (1 + i % 30))) for i in range(90)}


def test_odd_documents(odd_documents, clashing):
    rows = packing.packed_sequences(clashing(odd_documents)).collect()
    held = Counter(d for r in rows for d, first in zip(r.doc_ids, r.first_tokens) if first == 0)
    assert held == {3: 1, 4: 1, 5: 1, 6: 2, None: 1, 7: 1, 8: 1, 9: 1}
    assert packing.packed_sequences(odd_documents.limit(0)).collect() == []


LONG = {
    "lines": "a word\nand more\n",
    "tabs": "a\tword\t\tand ",
    "mixed": "It's 12 o'clock —  ünïcödé\r\n\n 中文字 x\u2003y\u00a0z\x1c1 ",
    "unspaced": "漢字かな",
    "spaces": "   ",
}


@pytest.mark.parametrize("kind", sorted(LONG))
@pytest.mark.parametrize("more", [-1, 0, 1, 1000])
def test_ids_do_not_depend_on_the_parts(kind, more):
    text = (LONG[kind] * (packing._PART // len(LONG[kind]) + 2000))[:packing._PART + more]
    encode = packing.encoder(packing.VOCABULARY, open(packing.VOCABULARY, "rb").read())
    assert "".join(packing.parts_of(text)) == text
    whole = TOKENIZER.encode_ordinary(text)
    if kind not in ("unspaced", "spaces"):
        assert encode(text).tolist() == whole
        assert len(list(packing.parts_of(text, 100))) > 500
        small = [i for part in packing.parts_of(text, 100) for i in TOKENIZER.encode_ordinary(part)]
        assert small == whole


def test_ids_of_any_type(spark):
    rows = spark.createDataFrame([("a-1", "some text"), (None, "more")], "doc_id string, text string")
    held = packing.packed_sequences(rows).collect()
    assert sorted(d or "" for r in held for d in r.doc_ids) == ["", "a-1"]
