"""Phrases of words that occur together far more than apart, mined level by level.

Set-oriented mining (SETM): the occurrences of frequent phrases of one length are a
stored relation, sorted by piece and position. A merge join of the relation with
itself at neighbouring positions gives the occurrences of phrases one word longer;
these are counted by groups, and the next relation keeps only occurrences of groups
that are frequent (a semi-join). A longer phrase is the pair of its first and its
last phrase of the length before, so phrases are exact pairs of numbers, not hashes.

A *block* is the part of the relation that one task holds at a time, about
``BLOCK_WORDS`` positions: an array with the number of the phrase that starts at
each position, or -1 (no frequent phrase, or the end of a piece). As it is sorted,
the merge join is a comparison of the array with itself, moved by one, and nothing
is shuffled for it. A block that ends inside a piece repeats the first words of the
next, so no phrase is lost, and counts only the positions that it owns. Only one row
per different phrase of a block is shuffled for the counts. Frequent phrases are
broadcast below the measured bound; beyond it they meet the different phrases of
each block in a shuffle join, in which adaptive execution splits hot keys.
Blocks go to Python one at a time (``BATCH_BYTES``) and pairs come back in short batches
(``BATCH_ROWS``): Spark holds each batch several times over outside the heap, and what
large batches leave there adds up from stage to stage.

All counts are per language. Nulls: a null text has no words, a null language is
``und``. Repeated rows count each time. An empty table gives no rows. Texts are read
whole; a long one spreads over several blocks. Only the named columns are read, so
further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldrank.llm.common import LOWER_BYTES, join_measured, picked
from fieldrank.materialise import Stored, materialise

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
WITHIN_PERCENT = 80
FIRST = 2000
NO_LANGUAGE = "und"

# Codec of the stored relations.
_ZSTD = "zstd"

BLOCK_WORDS = 1 << 19
# Bytes of a text that are cut into words at once.
_PART = 1 << 18

# A batch for Python ends at the row that reaches so many bytes, one of pairs from it
# at so many rows.
BATCH_BYTES = 1 << 20
BATCH_ROWS = 1 << 15
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# Up to so many phrases of a length, a pair of their numbers is one number.
ONE_NUMBER = 3_000_000_000
# monotonically_increasing_id() keeps the task above this bit, the row below it.
_TASK_SHIFT = 33

# A-Z lower-cased, the ends of pieces (".,;:!?" and line breaks) as dots.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_CLEAN = bytes(46 if c in _ENDS else LOWER_BYTES[c] for c in range(256))

_BLOCKS = "block long, owned long, codes binary, langs array<string>, words array<string>, counts array<long>"
_RELATION = "block long, owned long, codes binary, ids array<long>"
_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("owned", pa.int64()), ("codes", pa.binary()),
    ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
_RELATION_ARROW = pa.schema([
    ("block", pa.int64()), ("owned", pa.int64()), ("codes", pa.binary()), ("ids", pa.list_(pa.int64())),
])
_LOCAL_PAIRS = {True: "pair long, n long", False: "first long, last long, n long"}
_LOCAL = "block long, code long, first long, last long"


def tokens(text: bytes, part: int = _PART) -> Iterator[list[bytes]]:
    """Words of a text, with b"." between pieces, in lists of bounded size."""
    start = 0
    while start < len(text):
        found = _BREAK.search(text, start + part)
        stop = found.start() if found else len(text)
        yield text[start:stop].translate(_CLEAN).replace(b".", b" . ").split()
        start = stop


class _Codes(dict):
    """Numbers words of one language, in a numbering that all languages of a block share."""

    def __init__(self, names: list[tuple[str, bytes]], lang: str):
        super().__init__({b".": -1})
        self.names, self.lang = names, lang

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.names)
        self.names.append((self.lang, word))
        return code


class _Builder:
    """Collects words until a block is full."""

    def __init__(self, size: int, context: int):
        self.size, self.context = size, context
        self.parts: list[np.ndarray] = []
        self.length = 0
        self.clear([])

    def clear(self, carried: list[tuple[str, bytes] | None]) -> None:
        self.names: list[tuple[str, bytes]] = []
        self.langs: dict[str, _Codes] = {}
        codes = [-1 if name is None else self.codes(name[0])[name[1]] for name in carried]
        self.parts = [np.array(codes, dtype=np.int32)]
        self.length = len(codes)

    def codes(self, lang: str) -> _Codes:
        if lang not in self.langs:
            self.langs[lang] = _Codes(self.names, lang)
        return self.langs[lang]

    def add(self, lang: str, words: list[bytes]) -> Iterator[tuple]:
        for start in range(0, len(words), self.size):
            some = words[start:start + self.size]
            codes = self.codes(lang)
            self.parts.append(np.fromiter(map(codes.__getitem__, some), np.int32, len(some)))
            self.length += len(some)
            if self.length >= self.size + self.context:
                yield self.block(self.length - self.context)

    def block(self, owned: int) -> tuple:
        """The block of what was collected; the positions not owned open the next one."""
        all_codes = np.concatenate(self.parts)
        mine = all_codes[:owned]
        counts = np.bincount(mine[mine >= 0], minlength=len(self.names))
        names = self.names
        self.clear([None if c < 0 else names[c] for c in all_codes[owned:].tolist()])
        return owned, all_codes, [n for n, _ in names], [w.decode() for _, w in names], counts


def _record(schema: pa.Schema, values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([value], field.type) for value, field in zip(values, schema)], schema=schema
    )


def word_blocks(docs: DataFrame, size: int = BLOCK_WORDS, context: int = LONGEST - 1) -> DataFrame:
    """Blocks of the words of ``text``, with the different words and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        builder = _Builder(size, context)

        def record(block: tuple) -> pa.RecordBatch:
            nonlocal made
            owned, codes, langs, words, counts = block
            made += 1
            number = (task << 32) + made
            return _record(_BLOCK_ARROW, [number, owned, codes.tobytes(), langs, words, counts])

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for text, lang in zip(texts, batch.column("lang")):
                for words in tokens(text.as_py()):
                    for block in builder.add(lang.as_py(), [*words]):
                        yield record(block)
                for block in builder.add(lang.as_py(), [b"."]):
                    yield record(block)
        if builder.length:
            yield record(builder.block(builder.length))

    rows = docs.select(
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"),
    )
    return rows.where("text <> ''").mapInArrow(run, _BLOCKS)


def _array(value: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=kind)


def _numbers(value: pa.Scalar) -> np.ndarray:
    return value.values.to_numpy(zero_copy_only=False)


def neighbours(codes: np.ndarray, n_local: int) -> tuple[np.ndarray, np.ndarray]:
    """The merge join of a relation with itself at the next position.

    Returns the positions where a frequent phrase is followed by one, and both
    local numbers there as one.
    """
    here, after = codes[:-1], codes[1:]
    places = np.flatnonzero((here >= 0) & (after >= 0))
    return places, here[places].astype(np.int64) * n_local + after[places]


def _short(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of ``BATCH_ROWS``."""
    for start in range(0, len(columns[0]), BATCH_ROWS):
        yield pa.RecordBatch.from_arrays(
            [pa.array(column[start:start + BATCH_ROWS]) for column in columns], names
        )


def pair_counts(relation: DataFrame, n_phrases: int, one_number: int = ONE_NUMBER) -> DataFrame:
    """Each pair of neighbouring phrases with its count.

    A block sends one row per different pair, sorted, so that they compress well.
    """
    packed = n_phrases <= one_number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = _numbers(batch.column("ids")[i])
                codes = _array(batch.column("codes")[i], np.int32)
                places, pairs = neighbours(codes, len(ids))
                pairs = pairs[places < batch.column("owned")[i].as_py()]
                if not len(pairs):
                    continue
                if packed:
                    pairs = ids[pairs // len(ids)] * n_phrases + ids[pairs % len(ids)]
                known, n = np.unique(pairs, return_counts=True)
                columns = [known] if packed else [ids[known // len(ids)], ids[known % len(ids)]]
                names = ["pair", "n"] if packed else ["first", "last", "n"]
                yield from _short([*columns, n], names)

    rows = relation.mapInArrow(run, _LOCAL_PAIRS[packed])
    if not packed:
        return rows.groupBy("first", "last").agg(F.sum("n").alias("a"))
    first = F.expr(f"pair div {max(n_phrases, 1)}L").alias("first")
    last = F.expr(f"pair % {max(n_phrases, 1)}L").alias("last")
    return rows.groupBy("pair").agg(F.sum("n").alias("a")).select(first, last, "a")


def local_pairs(relation: DataFrame) -> DataFrame:
    """The different pairs of each block, for the join with frequent phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = _numbers(batch.column("ids")[i])
                _, pairs = neighbours(_array(batch.column("codes")[i], np.int32), len(ids))
                known = np.unique(pairs)
                if len(known):
                    block = np.full(len(known), batch.column("block")[i].as_py())
                    columns = [block, np.arange(len(known)), ids[known // len(ids)], ids[known % len(ids)]]
                    yield from _short(columns, ["block", "code", "first", "last"])

    return relation.mapInArrow(run, _LOCAL)


def kept(codes: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A relation less the phrases that are not frequent, renumbered.

    ``found`` has the number of each local phrase, or -1.
    """
    frequent = found >= 0
    local = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
    out = np.full(len(codes), -1, dtype=np.int32)
    some = codes >= 0
    out[some] = local[codes[some]]
    return out, found[frequent]


def longer(codes: np.ndarray, n_local: int) -> tuple[np.ndarray, np.ndarray]:
    """The relation of pairs (local numbers), and the different pairs."""
    places, pairs = neighbours(codes, n_local)
    out = np.full(len(codes), -1, dtype=np.int32)
    known, inverse = np.unique(pairs, return_inverse=True)
    out[places] = inverse
    return out, known


def _relation_row(block: int, owned: int, codes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return _record(_RELATION_ARROW, [block, owned, codes.tobytes(), ids])


class _Frequent:
    """Looks up the numbers of frequent pairs, given sorted by first and last."""

    def __init__(self, first: np.ndarray, last: np.ndarray, numbers: np.ndarray):
        # Two numbers of 64 bits do not fit one: both are renumbered densely.
        self.first, self.last, self.numbers = np.unique(first), np.unique(last), numbers
        self.pairs = self._packed(np.searchsorted(self.first, first), np.searchsorted(self.last, last))

    def _packed(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return first * len(self.last) + last

    def find(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(first), -1, dtype=np.int64)
        at_first, has_first = _places(self.first, first)
        at_last, has_last = _places(self.last, last)
        at, has = _places(self.pairs, self._packed(at_first, at_last))
        return np.where(has & has_first & has_last, self.numbers[at], -1)


def _places(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _broadcast_rows(stored: Stored, names: list[str], order: list[str]) -> Broadcast:
    """A side below the measured bound, as arrays sorted by ``order``; texts stay in Arrow."""
    data = stored.df.select(*names).orderBy(*order).toArrow()
    arrays = [
        column.to_numpy() if pa.types.is_integer(column.type) else column.combine_chunks()
        for column in data.columns
    ]
    return stored.df.sparkSession.sparkContext.broadcast(arrays)


def _named(langs: pa.Array, words: pa.Array) -> pa.Array:
    """A word and its language as one text: no word holds a tab."""
    return pc.binary_join_element_wise(words.cast(pa.string()), langs.cast(pa.string()), "\t")


def word_relation(blocks: DataFrame, words: Stored, broadcast: bool) -> DataFrame:
    """Occurrences of frequent words. ``words`` has lang, word, id."""
    if broadcast:
        known = _broadcast_rows(words, ["lang", "word", "id"], ["id"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            langs, words, numbers = known.value
            # One further place, for words that are not found.
            numbers, frequent = np.append(numbers, -1), _named(langs, words)
            for batch in batches:
                for i in range(batch.num_rows):
                    names = _named(batch.column("langs")[i].values, batch.column("words")[i].values)
                    at = pc.fill_null(pc.index_in(names, frequent), -1)
                    codes, ids = kept(_array(batch.column("codes")[i], np.int32), numbers[at.to_numpy()])
                    yield _relation_row(
                        batch.column("block")[i].as_py(), batch.column("owned")[i].as_py(), codes, ids
                    )

        return blocks.mapInArrow(run, _RELATION)

    local = blocks.select(
        "block", F.posexplode(F.arrays_zip("langs", "words")).alias("code", "name")
    ).select("block", "code", F.col("name.langs").alias("lang"), F.col("name.words").alias("word"))
    found = local.join(words.df.select("lang", "word", "id"), ["lang", "word"])
    return _resolved(blocks.select("block", "owned", "codes"), found, None)


def phrase_relation(relation: DataFrame, phrases: Stored, broadcast: bool) -> DataFrame:
    """Occurrences of frequent phrases one word longer: the semi-join with the counts."""
    if broadcast:
        known = _broadcast_rows(phrases, ["first", "last", "id"], ["first", "last"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequent = _Frequent(*known.value)
            for batch in batches:
                for i in range(batch.num_rows):
                    ids = _numbers(batch.column("ids")[i])
                    codes, pairs = longer(_array(batch.column("codes")[i], np.int32), len(ids))
                    found = frequent.find(ids[pairs // max(len(ids), 1)], ids[pairs % max(len(ids), 1)])
                    codes, ids = kept(codes, found)
                    yield _relation_row(
                        batch.column("block")[i].as_py(), batch.column("owned")[i].as_py(), codes, ids
                    )

        return relation.mapInArrow(run, _RELATION)

    found = local_pairs(relation).join(phrases.df.select("first", "last", "id"), ["first", "last"])
    return _resolved(relation, found, longer)


def _resolved(blocks: DataFrame, found: DataFrame, extend) -> DataFrame:
    """Blocks with the numbers that a join found for their local phrases.

    A block's numbers meet it by a shuffle; both are as long as a block at most.
    """
    lists = found.groupBy("block").agg(
        F.collect_list("code").alias("found_code"), F.collect_list("id").alias("found_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes = _array(batch.column("codes")[i], np.int32)
                if extend:
                    codes, known = extend(codes, len(_numbers(batch.column("ids")[i])))
                    size = len(known)
                else:
                    size = int(codes.max(initial=-1)) + 1
                numbers = np.full(size, -1, dtype=np.int64)
                if batch.column("found_code")[i].is_valid:
                    numbers[_numbers(batch.column("found_code")[i])] = _numbers(batch.column("found_id")[i])
                codes, ids = kept(codes, numbers)
                yield _relation_row(
                    batch.column("block")[i].as_py(), batch.column("owned")[i].as_py(), codes, ids
                )

    return blocks.join(lists, "block", "left").mapInArrow(run, _RELATION)


def _stored(rows: DataFrame) -> Stored:
    """Rows written while the session hands rows to Python in batches of ``BATCH_BYTES``."""
    conf = rows.sparkSession.conf
    before = conf.get(_BATCH_BYTES)
    conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    try:
        return materialise(rows, _ZSTD)
    finally:
        conf.set(_BATCH_BYTES, before)


def _numbered(rows: DataFrame) -> Stored:
    """Rows written, with numbers from 0 on without gaps.

    The files fix the order; what lies before a file is added to the numbers in it.
    """
    stored = _stored(rows.withColumn("id", F.monotonically_increasing_id()))
    task = F.shiftright("id", _TASK_SHIFT)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.df.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
        .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.col("id") - F.shiftleft("_task", _TASK_SHIFT)
    dense = (
        stored.df.withColumn("_task", task).join(F.broadcast(starts), "_task")
        .withColumn("id", inside + F.col("_before")).drop("_task", "_before")
    )
    return Stored(dense, stored.rows, stored.nbytes)


def _described(counts: Stored, shorter: Stored) -> Stored:
    """Phrases with their words and with the counts of all their beginnings and ends."""
    head = shorter.df.select(
        F.col("id").alias("first"), "lang", F.col("words").alias("first_words"),
        F.col("begins").alias("first_begins"),
    )
    tail = shorter.df.select(
        F.col("id").alias("last"), F.element_at("words", -1).alias("last_word"),
        F.col("ends").alias("last_ends"),
    )
    fits = {"rows": shorter.rows, "nbytes": shorter.nbytes}
    joined = join_measured(counts.df, Stored(head, **fits), ["first"], "inner")
    joined = join_measured(joined, Stored(tail, **fits), ["last"], "inner")
    count = F.array("a")
    return materialise(joined.select(
        "id", "first", "last", "lang", "a",
        F.concat("first_words", F.array("last_word")).alias("words"),
        F.concat("first_begins", count).alias("begins"),
        F.concat("last_ends", count).alias("ends"),
    ))


def _best_cut(length: int) -> Column:
    """The cut of the lowest score, with ``l``, ``r`` and ``score``; the first of ties."""
    def cut(k: int) -> Column:
        left, right = f"element_at(begins, {k})", f"element_at(ends, {length - k})"
        score = (
            f"cast({SCALE} as decimal(18, 0)) * cast(a as decimal(20, 0))"
            f" div (cast({left} as decimal(20, 0)) + cast({right} as decimal(20, 0)))"
        )
        return F.struct(
            F.expr(score).alias("score"), F.lit(k).alias("k"),
            F.expr(left).alias("l"), F.expr(right).alias("r"),
        )

    return F.array_min(F.array(*[cut(k) for k in range(1, length)]))


def _outside(phrases: DataFrame, longer_ones: DataFrame, within_percent: int) -> DataFrame:
    """Phrases that are not mostly part of one word more.

    A phrase within a still longer one is within one of the next length that is at
    least as frequent, so the next length decides.
    """
    parts = longer_ones.select(F.col("first").alias("id"), "a").union(
        longer_ones.select(F.col("last").alias("id"), "a")
    )
    inside = parts.groupBy("id").agg(F.max("a").alias("inside"))
    wide = "decimal(20,0)"
    mostly = 100 * F.col("inside").cast(wide) >= within_percent * F.col("a").cast(wide)
    return phrases.join(inside, "id", "left").where(F.col("inside").isNull() | ~mostly).drop("inside")


def _top(rows: DataFrame, first: int) -> DataFrame:
    """The first rows of each language with their ``rank``.

    A language may hold all rows: they are cut by parts, a few parts at a time.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    while parts > 1:
        spot = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
        parts = -(-parts // 16)
        rows = (
            rows.withColumn("_spot", spot).where(F.col("_spot") <= first)
            .withColumn("_part", F.pmod("_part", F.lit(parts))).drop("_spot")
        )
    spot = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return rows.withColumn("rank", spot.cast("long")).where(F.col("rank") <= first)


def phrases(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    broadcast: bool = True,
    block_words: int = BLOCK_WORDS,
    one_number: int = ONE_NUMBER,
) -> tuple[list[Stored], DataFrame]:
    """Frequent phrases of ``text`` by length, from single words on, and the words of
    each language (``lang``, ``n``). ``broadcast=False`` joins by shuffle always."""
    blocks = _stored(word_blocks(docs, block_words, longest - 1)).df
    words = blocks.select(F.inline(F.arrays_zip("langs", "words", "counts"))).select(
        F.col("langs").alias("lang"), F.col("words").alias("word"), F.col("counts").alias("n")
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = _numbered(
        words.groupBy("lang", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    )
    level = Stored(
        frequent.df.select(
            "id", "lang", "a", F.array("word").alias("words"),
            F.array("a").alias("begins"), F.array("a").alias("ends"),
        ),
        frequent.rows, frequent.nbytes,
    )
    levels = [level]
    relation = _stored(word_relation(blocks, frequent, broadcast and frequent.fits_broadcast)).df
    for length in range(2, longest + 1):
        counts = pair_counts(relation, frequent.rows, one_number)
        frequent = _numbered(counts.where(F.col("a") >= least))
        level = _described(frequent, level)
        levels.append(level)
        if length < longest:
            fits = broadcast and frequent.fits_broadcast
            relation = _stored(phrase_relation(relation, frequent, fits)).df
    return levels, totals


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    within_percent: int = WITHIN_PERCENT,
    first: int = FIRST,
    broadcast: bool = True,
    block_words: int = BLOCK_WORDS,
    one_number: int = ONE_NUMBER,
) -> DataFrame:
    """The phrases of each language whose weakest cut has the highest score."""
    rows = picked(docs, text=text, lang=lang)
    levels, totals = phrases(rows, least, longest, broadcast, block_words, one_number)
    out = None
    for length in range(2, longest + 1):
        found = levels[length - 1].df
        if length < longest:
            found = _outside(found, levels[length].df, within_percent)
        scored = found.withColumn("cut", _best_cut(length)).select(
            "lang", F.concat_ws(" ", "words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"
        )
        out = scored if out is None else out.union(scored)
    return _top(out, first).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
