"""Licence scans: MinHash bands of text windows retrieve templates, exact
containment of word shingles verifies them.

Templates are put into classes by their number m of five-word shingles, each class
up to 1.25 times as large as the one before. A class up to B shingles has windows of
W = 1.25 B shingles that overlap so that any B in a row lie inside one. A window
that holds 0.8 of a template has a Jaccard similarity of ``least_jaccard`` = 0.8 m /
(W + 0.2 m) with it at least, which is above 0.45; with 48 bands of two rows the two
share a band with a probability of ``collision_probability`` > 0.99998. Only what
shares a band is looked at again, exactly, so nothing is reported that is not there.

A window's signature is taken over its shingles that consist of words of templates.
All shingles of templates do, so what the two share stays and what they don't shrinks:
the similarity can only grow. Windows without such a shingle share nothing.

A template that differs from one of another licence by few shingles (a version, a
name) must hold half of these. Of finds that overlap by half of the shorter one, the
one with the most shingles found less shingles missed stays.

Templates are fixed texts, or the caller's; they travel with the plan and their
size is checked. Each document is scanned by itself; nothing shuffles.

Nulls and empty texts have no words and no licences. Repeated rows are scanned
each for itself. An empty table gives no rows. Texts are scanned whole. Only the
named columns are read; others may have any name.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.llm.common import picked, whole, with_columns_of_text
from fieldrank.llm.decontamination import words_of
from fieldrank.llm.license_texts import TEMPLATES

SHINGLE = 5
CONTAINED = 0.8
WIDER = 1.25
BANDS, ROWS = 48, 2

# Share of the shingles that tell a template from another one which a find must hold.
TOLD = 0.5

# Bytes of templates that travel with the plan.
TEMPLATE_BYTES = 8 * 1024 * 1024

# Windows signed at once.
_AT_ONCE = 1 << 15

_PRIME = np.uint64(0x9E3779B97F4A7C15)


class Find(NamedTuple):
    license: str
    start: int  # first word
    end: int  # after the last word
    containment: float
    found: int  # shingles of the template that are there
    missed: int

    @property
    def weight(self) -> tuple:
        return (self.missed - self.found, -self.containment, self.start, self.end, self.license)


def collision_probability(jaccard: float) -> float:
    return 1 - (1 - jaccard**ROWS) ** BANDS


def shingles(words: list[bytes]) -> list[bytes]:
    """All shingles in order; the whole text where it is shorter."""
    if not words:
        return []
    return [b" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]


def size_class(size: int) -> int:
    """The largest size of the class that a template of ``size`` shingles is in."""
    top = 1
    while top < size:
        top = max(top + 1, int(top * WIDER))
    return top


def window(top: int) -> tuple[int, int]:
    """Shingles in a window of a class, and from one window to the next."""
    width = math.ceil(WIDER * top)
    return width, width - top + 1


def least_jaccard(size: int) -> float:
    """Of a template and a window that holds enough of it."""
    held = math.ceil(CONTAINED * size)
    return held / (window(size_class(size))[0] + size - held)


def _hashes(numbers: np.ndarray) -> np.ndarray:
    """One number per five numbers in a row."""
    out = np.zeros(max(0, len(numbers) - SHINGLE + 1), dtype=np.uint64)
    for i in range(SHINGLE):
        out = (out + numbers[i:i + len(out)].astype(np.uint64)) * _PRIME
        out ^= out >> np.uint64(31)
    return out


class Signer:
    """MinHash signatures of ranges: the least of mixed hashes, each mixed another way."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.times = draw.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
        self.plus = draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)

    def bands(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[np.ndarray]:
        """Band by band a number for each range [low, high) of hashes; none is empty."""
        levels = np.frexp((high - low).astype(np.float64))[1] - 1
        depth = int(levels.max()) + 1
        right = high - (1 << levels)
        for band in range(BANDS):
            out = np.zeros(len(low), dtype=np.uint64)
            for row in range(band * ROWS, (band + 1) * ROWS):
                mixed = hashes * self.times[row] + self.plus[row]
                least = [((mixed ^ (mixed >> np.uint64(32))) * _PRIME) >> np.uint64(32)]
                for level in range(1, depth):
                    half, below = 1 << (level - 1), least[-1]
                    above = below.copy()
                    np.minimum(below[:-half], below[half:], out=above[:-half])
                    least.append(above)
                table = np.stack(least)
                out = out << np.uint64(32) | np.minimum(table[levels, low], table[levels, right])
            yield out


class Templates:
    def __init__(self, texts: dict[str, list[str]]):
        self.signer = Signer()
        self.names: list[str] = []
        self.parts: list[frozenset[bytes]] = []
        self.vocabulary: dict[bytes, int] = {}
        numbers, tops = [], []
        for name, versions in texts.items():
            for text in versions:
                words = words_of(text.encode())
                if len(words) < SHINGLE:
                    raise ValueError(f"a template of {name} has less than {SHINGLE} words")
                self.names.append(name)
                self.parts.append(frozenset(shingles(words)))
                tops.append(size_class(len(self.parts[-1])))
                numbers.append(_hashes(np.array(
                    [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                )))
        self.tops = np.array(tops, dtype=np.int64)
        self.classes = np.unique(self.tops).tolist()
        ends = np.cumsum([len(n) for n in numbers], dtype=np.int64)
        # Per band the numbers of the templates, sorted, and whose they are.
        self.by_band = []
        if numbers:
            starts = np.concatenate(([0], ends[:-1]))
            for values in self.signer.bands(np.concatenate(numbers), starts, ends):
                order = np.argsort(values, kind="stable")
                self.by_band.append((values[order], order))
        self.telling = [self._telling(i) for i in range(len(self.names))]

    def _telling(self, number: int) -> list[frozenset[bytes]]:
        """Few shingles each that a template of another licence lacks.

        Where it lacks more than 0.4 of them, a find holds half of those anyway.
        """
        parts = self.parts[number]
        bound = len(parts) * (1 - CONTAINED) / TOLD
        told = {
            parts - other for name, other in zip(self.names, self.parts)
            if name != self.names[number]
        }
        return [few for few in told if 0 < len(few) <= bound]

    def candidates(self, words: list[bytes], starts: np.ndarray) -> list[tuple[int, int, int]]:
        """(first word, end word, template) of windows that share a band.

        ``words`` are those of several documents, which begin at ``starts``; the
        last of them is the number of words.
        """
        if len(words) < SHINGLE or not self.by_band:
            return []
        numbers = np.fromiter(
            map(self.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words)
        )
        unknown = np.concatenate(([0], np.cumsum(numbers == 0)))
        at = np.flatnonzero(unknown[SHINGLE:] == unknown[:-SHINGLE])
        doc = np.searchsorted(starts, at, side="right") - 1
        inside = at + SHINGLE <= starts[doc + 1]
        at, doc = at[inside], doc[inside]
        if len(at) == 0:
            return []
        hashes = _hashes(numbers)[at]
        first, last, tops = (np.concatenate(p) for p in zip(
            *[_windows(at, doc, starts, top) for top in self.classes]
        ))
        low, high = np.searchsorted(at, first), np.searchsorted(at, last)
        found, order = set(), np.argsort(low, kind="stable")
        for begin in range(0, len(order), _AT_ONCE):
            some = order[begin:begin + _AT_ONCE]
            base, end = int(low[some[0]]), int(high[some].max())
            signed = self.signer.bands(hashes[base:end], low[some] - base, high[some] - base)
            for values, (known, owner) in zip(signed, self.by_band):
                left = np.searchsorted(known, values)
                right = np.searchsorted(known, values, side="right")
                for hit in np.flatnonzero(right > left).tolist():
                    spot = some[hit]
                    for number in owner[left[hit]:right[hit]].tolist():
                        if self.tops[number] == tops[spot]:
                            found.add((int(first[spot]), int(last[spot]) + SHINGLE - 1, number))
        return sorted(found)

    def verified(self, inside: list[bytes], start: int, number: int) -> Find | None:
        """The find of a template in a window that begins at a word, if it holds enough."""
        parts = self.parts[number]
        places = [i for i, part in enumerate(inside) if part in parts]
        held = {inside[i] for i in places}
        if len(held) < CONTAINED * len(parts):
            return None
        if any(len(few & held) < TOLD * len(few) for few in self.telling[number]):
            return None
        return Find(
            self.names[number], start + places[0], start + places[-1] + SHINGLE,
            len(held) / len(parts), len(held), len(parts) - len(held),
        )


def _windows(at: np.ndarray, doc: np.ndarray, starts: np.ndarray, top: int):
    """First and end shingle of the windows of a class that hold a position, and the class."""
    width, stride = window(top)
    begin, total = starts[doc], starts[doc + 1] - starts[doc] - SHINGLE + 1
    last = np.maximum(0, -((width - total) // stride))
    near = np.minimum((at - begin) // stride, last)
    out = []
    for back in range(-(-width // stride)):
        step = near - back
        holds = (step >= 0) & (begin + step * stride + width > at)
        out.append((begin + step * stride)[holds])
    first = np.unique(np.concatenate(out))
    owner = np.searchsorted(starts, first, side="right") - 1
    end = np.minimum(first + width, starts[owner + 1] - SHINGLE + 1)
    return first, end, np.full(len(first), top)


def strongest(finds: Iterable[Find]) -> list[Find]:
    """The finds that no stronger one overlaps by half of the shorter of the two.

    Those that stay overlap each other by less, so few of them reach into any find:
    they are kept by their starts, in layers of lengths that differ by two at most.
    """
    layers: dict[int, list[tuple[int, int]]] = defaultdict(list)
    kept = []
    for find in sorted(set(finds), key=lambda f: f.weight):
        size = find.end - find.start
        if any(_overlapped(find, layer, 1 << bits) for bits, layer in layers.items()):
            continue
        insort(layers[size.bit_length()], (find.start, find.end))
        kept.append(find)
    return sorted(kept, key=lambda f: (f.start, f.end, f.license))


def _overlapped(find: Find, layer: list[tuple[int, int]], longest: int) -> bool:
    """Whether one of the spans, all shorter than ``longest``, overlaps a find by half."""
    spot = bisect_left(layer, (find.start - longest, 0))
    while spot < len(layer) and layer[spot][0] < find.end:
        start, end = layer[spot]
        shared = min(end, find.end) - max(start, find.start)
        if 2 * shared >= min(end - start, find.end - find.start):
            return True
        spot += 1
    return False


def scan(documents: list[list[bytes]], templates: Templates) -> list[list[Find]]:
    """The finds in each of some documents, given as words."""
    starts = np.concatenate(([0], np.cumsum([len(d) for d in documents], dtype=np.int64)))
    words = [word for document in documents for word in document]
    finds: list[list[Find]] = [[] for _ in documents]
    for (start, end), group in groupby(templates.candidates(words, starts), key=lambda c: c[:2]):
        doc = int(np.searchsorted(starts, start, side="right")) - 1
        inside = shingles(words[start:end])
        for _, _, number in group:
            find = templates.verified(inside, start - int(starts[doc]), number)
            if find is not None:
                finds[doc].append(find)
    return [strongest(found) for found in finds]


_FIND = T.StructType([
    T.StructField("license", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("containment", T.DoubleType()),
])

def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per document with the licences found in it and where."""
    size = sum(len(t.encode()) for texts in templates.values() for t in texts)
    if size > TEMPLATE_BYTES:
        raise ValueError(f"templates have {size} bytes, more than {TEMPLATE_BYTES}")

    def make():
        built = Templates(templates)

        def function(texts):
            documents = [words_of(text) for text in texts]
            counts = [len(words) for words in documents]
            rows = [
                [dict(zip(("license", "start", "end", "containment"), find)) for find in finds]
                for finds in scan(documents, built)
            ]
            kind = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                              ("containment", pa.float64())])
            return [pa.array(counts, pa.int64()), pa.array(rows, pa.list_(kind))]

        return function

    added = [T.StructField("n_words", T.LongType()), T.StructField("finds", T.ArrayType(_FIND))]
    packed = whole(picked(docs, doc_id=doc_id, text=text))
    names = F.array_sort(F.array_distinct(F.col("finds.license")))
    return with_columns_of_text(packed, "text", make, added, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words",
        F.size("finds").cast("long").alias("n_finds"),
        F.array_join(names, ",").alias("licenses"), "finds",
    )
