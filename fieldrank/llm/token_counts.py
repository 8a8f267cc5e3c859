"""Tokens of every text under a public byte-pair tokenizer, counted in arrays.

A text falls into chunks at ASCII white space. The library's own normaliser and
pre-tokenizer turn each new chunk into pre-tokens, once per worker; the pre-tokens
of a batch become one ragged array of symbols. In a round each pre-token applies
its pair of lowest rank, at all its places at once, and those without a pair left
are done: what remains of their symbols are their tokens. A pair whose result could
take part in a pair of lower rank is applied at its first place only, as one merge
after the other would do. Long pre-tokens (a text without white space is one) keep
the places of each pair by rank, so a round touches only what it changes.

The result is the one of the tokenizer library, without begin and end tokens. The
strings of special tokens inside a text are one token each, as is its default.

Nulls and empty texts have no tokens. Repeated rows get a result each, an empty
table gives no rows. Texts are read whole. Only the named columns are read, so
further columns may have any name.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.llm.common import picked, whole, with_columns_of_text
from fieldrank.llm.packing import broadcast_vocabulary

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048

# Pre-tokens of more symbols are merged one by one, by places instead of rounds.
LONG = 256

# Counts of chunks that a worker remembers, and the longest chunk it remembers.
REMEMBERED = 1_000_000
REMEMBERED_BYTES = 256

# Chunks that the library cuts in one call, and the digit set between them: the
# pattern makes every digit a pre-token of its own.
_AT_ONCE = 1024
_FENCE = "\U0001D7D8"

_NONE = np.iinfo(np.int32).max
_ADDED = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte.

    Printable bytes of Latin-1 stand for themselves, the others are numbered from 256.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(others)) for b in range(256)]


class Merges:
    """The merge rules of a vocabulary as arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = ""):
        self.width = max(vocabulary.values()) + 1
        ranks = {}
        for rank, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[vocabulary[a] * self.width + vocabulary[b]] = (rank, vocabulary[a + b])
        keys = sorted(ranks)
        self.keys = np.array(keys, dtype=np.int64)
        self.ranks = np.array([ranks[k][0] for k in keys], dtype=np.int32)
        self.results = np.zeros(len(merges), dtype=np.int64)
        for rank, result in ranks.values():
            self.results[rank] = result
        # The lowest rank that a symbol takes part in, and the rules it makes unsafe.
        lowest = np.full(self.width, _NONE, dtype=np.int64)
        np.minimum.at(lowest, self.keys // self.width, self.ranks)
        np.minimum.at(lowest, self.keys % self.width, self.ranks)
        self.unsafe = lowest[self.results] < np.arange(len(merges))
        # Symbols by code point of their letter, inside a word and at its end.
        self.inside = np.full(512, -1, dtype=np.int64)
        self.ending = np.full(512, -1, dtype=np.int64)
        for letter in byte_letters():
            self.inside[ord(letter)] = vocabulary[letter]
            self.ending[ord(letter)] = vocabulary[letter + suffix]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], _NONE)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all pre-tokens in one array, and how many each has."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        symbols = self.inside[letters]
        last = np.cumsum(lengths) - 1
        symbols[last] = self.ending[letters[last]]
        return symbols, lengths


def alternate(run: np.ndarray) -> np.ndarray:
    """Which of neighbouring places are taken from the left; ``run`` marks a place
    whose left neighbour is one as well."""
    index = np.arange(len(run))
    start = np.maximum.accumulate(np.where(run, 0, index))
    return (index - start) % 2 == 0


def count_in_rounds(rules: Merges, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Symbols left of each sequence of a ragged array, none of which is empty."""
    left = lengths.copy()
    names = np.arange(len(lengths))
    while len(names):
        owner = np.repeat(np.arange(len(names)), lengths)
        ranks = np.full(len(symbols), _NONE, dtype=np.int32)
        ranks[:-1] = rules.rank(symbols[:-1], symbols[1:])
        ends = np.cumsum(lengths)
        ranks[ends - 1] = _NONE
        lowest = np.minimum.reduceat(ranks, ends - lengths)
        places = np.flatnonzero((ranks == lowest[owner]) & (ranks != _NONE))
        if not len(places):
            break
        seq = owner[places]
        neighbour = np.diff(places, prepend=-2) == 1
        take = alternate(neighbour)
        careful = rules.unsafe[ranks[places]]
        if careful.any():
            first = np.diff(seq, prepend=-1) > 0
            take &= first | ~careful
        places = places[take]
        symbols[places] = rules.results[ranks[places]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[places + 1] = False
        active = lowest != _NONE
        lengths = lengths - np.bincount(owner[places], minlength=len(names))
        left[names] = lengths
        symbols = symbols[keep & active[owner]]
        lengths, names = lengths[active], names[active]
    return left


def count_by_places(rules: Merges, symbols: np.ndarray) -> int:
    """Symbols left of one sequence, with the places of each pair kept by rank."""
    n = len(symbols)
    symbols = symbols.copy()
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, dtype=bool)
    ranks = np.full(n, _NONE, dtype=np.int32)
    places: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(at: np.ndarray) -> None:
        at = at[(at >= 0) & (after[np.maximum(at, 0)] < n)]
        ranks[at] = rules.rank(symbols[at], symbols[after[at]])
        at = at[ranks[at] != _NONE]
        at = at[np.argsort(ranks[at], kind="stable")]
        cuts = np.flatnonzero(np.diff(ranks[at])) + 1
        for part in np.split(at, cuts):
            if len(part):
                add(int(ranks[part[0]]), part)

    def add(rank: int, part: np.ndarray) -> None:
        if rank not in places:
            places[rank] = []
            heapq.heappush(queue, rank)
        places[rank].append(part)

    enter(np.arange(n))
    while queue:
        rank = heapq.heappop(queue)
        at = np.unique(np.concatenate(places.pop(rank)))
        at = at[alive[at] & (ranks[at] == rank)]
        if not len(at):
            continue
        if rules.unsafe[rank]:
            if len(at) > 1:
                add(rank, at[1:])
            at = at[:1]
        neighbour = np.zeros(len(at), dtype=bool)
        neighbour[1:] = after[at[:-1]] == at[1:]
        at = at[alternate(neighbour)]
        gone = after[at]
        alive[gone] = False
        ranks[gone] = ranks[at] = _NONE
        symbols[at] = rules.results[rank]
        after[at] = after[gone]
        inner = after[at] < n
        before[after[at][inner]] = at[inner]
        ranks[at] = _NONE
        enter(np.unique(np.concatenate([before[at], at])))
    return int(alive.sum())


class Counter:
    """Counts the tokens of texts; one per Python worker."""

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        parsed = json.loads(data)
        model, added = parsed["model"], parsed.get("added_tokens", [])
        pre = parsed["pre_tokenizer"]["pretokenizers"][-1]
        plain = not any(
            token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip", "normalized")
        )
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or not plain:
            raise ValueError("only byte-level pair vocabularies with plain special tokens are read")
        tokenizer = Tokenizer.from_buffer(data)
        self.normal = tokenizer.normalizer.normalize_str
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self.fence = self.cut(_FENCE)[0][0]
        self.rules = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        # Longer special strings first, as the library prefers them.
        names = sorted((token["content"] for token in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.known: dict[bytes, int] = {}

    def words(self, text: str) -> list[str]:
        return [word for word, _ in self.cut(self.normal(text))]

    def words_of_each(self, chunks: list[str]) -> list[list[str]]:
        """Pre-tokens of each chunk; many plain chunks pass the library together."""
        groups: list[list[str]] = []
        for start in range(0, len(chunks), _AT_ONCE):
            group: list[str] = []
            groups.append(group)
            for word in self.words(f" {_FENCE} ".join(chunks[start:start + _AT_ONCE])):
                if word == self.fence:
                    group = []
                    groups.append(group)
                else:
                    group.append(word)
        return groups

    def cut_chunks(self, chunks: list[str]) -> tuple[list[list[str]], list[int]]:
        """Pre-tokens of each chunk, and how many special tokens stand between them."""
        odd = [
            i for i, chunk in enumerate(chunks)
            if _FENCE in chunk or (self.special and self.special.search(chunk))
        ]
        special = [0] * len(chunks)
        plain = chunks.copy()
        for i in odd:
            plain[i] = ""
        words = self.words_of_each(plain)
        for i in odd:
            parts = self.special.split(chunks[i]) if self.special else [chunks[i]]
            words[i] = [word for part in parts if part for word in self.words(part)]
            special[i] = len(parts) - 1
        return words, special

    def count_words(self, words: list[str]) -> np.ndarray:
        counts = np.zeros(len(words), dtype=np.int64)
        if not words:
            return counts
        symbols, lengths = self.rules.symbols(words)
        starts = np.cumsum(lengths) - lengths
        long = lengths > LONG
        for i in np.flatnonzero(long):
            counts[i] = count_by_places(self.rules, symbols[starts[i]:starts[i] + lengths[i]])
        if not long.all():
            short = symbols[~np.repeat(long, lengths)]
            counts[~long] = count_in_rounds(self.rules, short, lengths[~long])
        return counts

    def count_chunks(self, chunks: list[bytes]) -> list[int]:
        words, special = self.cut_chunks([chunk.decode("utf-8", "replace") for chunk in chunks])
        distinct = list({word for group in words for word in group})
        counts = dict(zip(distinct, self.count_words(distinct).tolist()))
        return [n + sum(map(counts.__getitem__, group)) for group, n in zip(words, special)]

    def count(self, texts: list[bytes | None]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        split = [text.split() if text else [] for text in texts]
        new = list(set().union(*split).difference(known))
        known.update(zip(new, self.count_chunks(new)))
        totals = [sum(map(known.__getitem__, chunks)) for chunks in split]
        for chunk in new:
            if len(chunk) > REMEMBERED_BYTES:
                del known[chunk]
        return totals


_counters: dict[str, Counter] = {}


def _made(vocabulary: Broadcast):
    path, data = vocabulary.value
    if path not in _counters:
        _counters[path] = Counter(data)
    counter = _counters[path]

    def columns(texts: list[bytes | None]) -> list[pa.Array]:
        sizes = [len(text or b"") for text in texts]
        return [pa.array(sizes, pa.int64()), pa.array(counter.count(texts), pa.int64())]

    return columns


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def counted(
    docs: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Bytes and tokens of each document, and whether it is longer than ``limit`` tokens."""
    vocabulary = broadcast_vocabulary(docs.sparkSession, path or vocabulary_path())
    packed = whole(picked(docs, doc_id=doc_id, text=text))
    return with_columns_of_text(packed, "text", partial(_made, vocabulary), _ADDED, ["doc_id"]).select(
        F.col("doc.doc_id").alias("doc_id"), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
