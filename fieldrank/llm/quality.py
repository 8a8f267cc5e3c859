"""Quality rules: counts within a document, and line frequency across documents.

A line is lower-cased (A-Z), its white space turned into single spaces, and
hashed. Per host (the ``source``) the distinct documents that hold a line are
counted; copies and near copies (a SimHash component, as near-dedup groups them)
are one document, so that a family of copies makes none of its lines common. A line found in more than
``LINE_DOCS`` documents and more than ``LINE_SHARE`` of the host's is removed. A
document is rejected when the base rules fail, or when removal leaves less than
``LEFT_WORDS`` words or ``LEFT_SHARE`` of its words.

The text is read once; what follows works on line hashes. Counts are aggregated
on the map side before they are shuffled, so a very common line or a large host
moves few rows.

Nulls: a null text has no words and is rejected; a null host is a host of its
own. Repeated rows get a result each. An empty table gives no rows. Texts are
read whole. Only the named columns are used; others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.llm.common import (
    LOWER_BYTES, join_measured, picked, quoted, unpacked, whole, with_columns_of_text,
)
from fieldrank.llm.simhash import _signed, families, fingerprint
from fieldrank.materialise import materialise

MIN_WORDS = 10
REPEAT_WINDOW = 5
REPEAT_PERCENT = 20

LINE_DOCS = 20
LINE_SHARE = 0.01
LEFT_WORDS = 10
LEFT_SHARE = 0.3

# The characters that count as symbols.
_SYMBOLS = b"#*$%&|<>"

# The seed of Spark's xxhash64, so that both sides hash a line alike.
_SEED = 42

_LINE = T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.LongType())])
STATS = [
    *[T.StructField(name, T.LongType()) for name in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fp",
    )],
    T.StructField("lines", T.ArrayType(_LINE)),
]


def _hash(data: bytes) -> int:
    number = xxhash.xxh64_intdigest(data, _SEED)
    return number - (1 << 64) if number >> 63 else number


def repeat_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``width`` words that the text has twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    windows, distinct = ids[:n], len(numbers)
    for i in range(1, width):
        if distinct * len(numbers) >= 1 << 62:
            known, windows = np.unique(windows, return_inverse=True)
            distinct = len(known)
        windows = windows * len(numbers) + ids[i:i + n]
        distinct *= len(numbers)
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for i in range(width):
        covered[i:i + n] |= twice
    return int(covered.sum())


def line_stats(text: bytes) -> tuple[int, dict[bytes, int]]:
    """Lines equal to an earlier one, and the words of each normalised line."""
    seen, repeated, lines = set(), 0, {}
    for line in text.split(b"\n"):
        words = line.split()
        if words:
            repeated += line in seen
            seen.add(line)
            normal = b" ".join(words).translate(LOWER_BYTES)
            lines[normal] = lines.get(normal, 0) + len(words)
    return repeated, lines


def _stats(texts: list[bytes | None]) -> list[pa.Array]:
    rows = []
    for text in texts:
        text = text or b""
        words = text.split()
        letters = b"".join(words)
        chars = len(letters.decode())
        symbols = len(text) - len(text.translate(None, _SYMBOLS))
        repeated, lines = line_stats(text)
        rows.append((
            len(words), chars, symbols, repeated, repeat_words(words),
            _signed(fingerprint(text)),
            [{"line": _hash(line), "words": n} for line, n in lines.items()],
        ))
    columns = list(zip(*rows)) or [[]] * 7
    line = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
    return [*[pa.array(c, pa.int64()) for c in columns[:6]], pa.array(columns[6], line)]


def with_stats(packed: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return with_columns_of_text(packed, text, lambda: _stats, STATS, keep)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )


def host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), host.cast("string")), F.lit("n"))


def frequent_lines(rows: DataFrame, line_docs: int, line_share: float) -> DataFrame:
    """``host`` and ``line`` of the lines above both limits."""
    grouped = join_measured(
        rows.select("host", "fp", "lines"), families(rows.select("fp")), ["fp"], "left"
    ).withColumn("family", F.coalesce("family", "fp"))
    texts = grouped.select("host", "family").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs")
    )
    counts = (
        grouped.select("host", "family", F.explode("lines.line").alias("line"))
        .groupBy("host", "line").agg(F.count_distinct("family").alias("docs"))
        .where(F.col("docs") > line_docs)
    )
    return (
        join_measured(counts, materialise(texts), ["host"], "inner")
        .where(F.col("docs") > line_share * F.col("host_docs"))
        .select("host", "line")
    )


def judged(
    packed: DataFrame, text: str, host: str, keep: list[str],
    line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE,
    left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE,
) -> DataFrame:
    """Rows packed by ``whole`` with their counts, ``frequent`` line hashes and ``kept``."""
    stats = with_stats(packed, text, list(dict.fromkeys([*keep, host])))
    rows = materialise(
        stats.withColumn("host", host_key(F.col("doc").getField(host)))
        .withColumn("_row", F.monotonically_increasing_id())
    ).df
    frequent = materialise(frequent_lines(rows, line_docs, line_share))
    removed = join_measured(
        rows.select("_row", "host", F.inline("lines")), frequent, ["host", "line"], "inner"
    ).groupBy("_row").agg(
        F.sum("words").alias("n_removed"), F.collect_list("line").alias("frequent")
    )
    left = F.col("n_words") - F.coalesce(F.col("n_removed"), F.lit(0))
    depleted = (left < left_words) | (left < left_share * F.col("n_words"))
    return (
        join_measured(rows.drop("lines", "fp", "host"), materialise(removed), ["_row"], "left")
        .withColumn("base_failed", base_failed())
        .withColumn("n_left", left)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .drop("_row")
    )


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
           **limits) -> DataFrame:
    """One row per document with its counts and the verdict."""
    packed = whole(picked(docs, doc_id=doc_id, text=text, host=host))
    return judged(packed, "text", "host", ["doc_id"], **limits).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "n_left",
    )


def line_hash(line: Column) -> Column:
    """The hash of a line, as in ``line_stats``; null for a line without words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    spaced = F.trim(F.regexp_replace(F.translate(line, upper, lower), r"[\x20\x09-\x0D]+", " "))
    return F.when(spaced != "", F.xxhash64(spaced))


def filtered(docs: DataFrame, text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The documents kept, less their frequent lines. A text without any stays as it is."""
    packed = whole(docs)
    rows = judged(packed, text, host, docs.columns, **limits).where("kept")
    lines = F.split(F.col("doc").getField(text), "\n", -1)
    rest = F.filter(
        lines, lambda line: ~F.coalesce(F.array_contains("frequent", line_hash(line)), F.lit(False))
    )
    changed = F.when(F.col("frequent").isNull(), F.col("doc").getField(text)).otherwise(
        F.array_join(rest, "\n")
    )
    return unpacked(rows.withColumn("doc", F.col("doc").withField(quoted(text), changed)))
