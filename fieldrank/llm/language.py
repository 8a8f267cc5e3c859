"""Language of pages by fusing four kinds of evidence.

1. Text: byte trigrams of the article's text under a naive Bayes model, whose counts
   are summed per language over all labelled documents. Trigrams share
   ``BUCKETS`` buckets, and pages meet ``LANGUAGES`` languages of the model at a time,
   so what is broadcast has a proven size; any number of languages is learnt.
2. Declared language (``lang`` of the page): how often pages of each language,
   judged by text, declare it.
3. Address suffix (last label of the host), in the same way.
4. Host prior: the languages of the host's other pages, smoothed towards those of
   its site (the last two labels), and these towards those of all pages. A page
   does not vote for itself.

2 to 4 are sums of text posteriors by grouped aggregation over all pages; each
group leaves a map task as one row. The scores are added and normalised.

Nulls and empty pages have no text evidence and are judged by the rest; a missing
declaration is a declaration of its own; pages without an address are one host.
Repeated rows vote for each other. Documents without a label or text teach
nothing. Labels count by their primary part (``en-US`` is ``en``). Without pages there are no rows, without labelled documents no
languages: ``lang`` is null. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.llm.common import LOWER_BYTES, join_measured, picked, slices
from fieldrank.llm.html_tree import article_text, parse
from fieldrank.llm.wrappers import host_of
from fieldrank.materialise import materialise

BUCKETS = 1 << 15
LANGUAGES = 64

# Added to the count of every trigram, declaration and suffix.
SMOOTHING = 0.5
# Trigrams overlap, so a third of their log likelihood is evidence.
OVERLAP = 3.0
# Pages' worth of trust in the next wider group.
SITE_TRUST, HOST_TRUST = 20.0, 10.0

_DECLARED = re.compile(r"""<html\b[^>]*?\s(?:xml:)?lang\s*=\s*["']?\s*([a-zA-Z]+)""", re.I)


def trigrams(text: bytes) -> np.ndarray:
    """Bucket of each byte trigram; A-Z lower-cased, white space runs one space."""
    data = np.frombuffer(b" " + b" ".join(text.translate(LOWER_BYTES).split()) + b" ", dtype=np.uint8)
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64)
    code = (data[:-2].astype(np.uint32) << 16) | (data[1:-1].astype(np.uint32) << 8) | data[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        pairs = (
            pair for part, texts in slices(batch, batch.column("text"))
            for pair in zip(part.column("lang").to_pylist(), texts)
        )
        for lang, text in pairs:
            if lang not in counts:
                if len(counts) == LANGUAGES:
                    yield from _counted(counts)
                    counts.clear()
                counts[lang] = np.zeros(BUCKETS, dtype=np.int64)
            found = trigrams(text)
            if len(found) > BUCKETS:
                counts[lang] += np.bincount(found, minlength=BUCKETS)
            else:
                np.add.at(counts[lang], found, 1)
    yield from _counted(counts)


def _counted(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for lang, count in counts.items():
        buckets = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(buckets)), pa.array(buckets, pa.int32()), pa.array(count[buckets])],
            names=["lang", "bucket", "n"],
        )


def primary(label: Column) -> Column:
    """The primary part of a language label, lower-case; null for a label without one."""
    part = F.lower(F.regexp_extract(label, r"^\s*([^\s_-]+)", 1))
    return F.when(part != "", part)


def counted_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language and bucket, how often it occurs in the labelled documents."""
    rows = picked(docs, text=text, lang=lang).withColumn("lang", primary(F.col("lang")))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    return (
        rows.mapInArrow(_count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )


def learnt(counts: DataFrame, names: list[str]) -> np.ndarray:
    """The log likelihood of each bucket under each of the named languages."""
    place = {name: i for i, name in enumerate(names)}
    model = np.full((len(names), BUCKETS), SMOOTHING)
    # At most as many rows as languages named times BUCKETS.
    for row in counts.where(F.col("lang").isin(names)).toLocalIterator():
        model[place[row.lang], row.bucket] += row.n
    return np.log(model / model.sum(axis=1, keepdims=True))


def declared_language(page: str | None) -> str | None:
    """The primary part of the ``lang`` attribute of ``html``, lower-case."""
    found = _DECLARED.search(page or "")
    return found[1].lower() if found else None


def text_likelihood(text: str, model: np.ndarray) -> np.ndarray:
    return model[:, trigrams(text.encode())].sum(axis=1) / OVERLAP


def _scored(rows: DataFrame, model: np.ndarray, last: bool) -> tuple[DataFrame, Broadcast]:
    """Rows with the text's likelihood under the languages of ``model`` appended.

    The ``last`` pass leaves the page out. The broadcast may go once the rows are written.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = ["page_id", "url", "host", *([] if last else ["html"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            likelihood, declared = [], []
            before = batch.column("likelihood").to_pylist()
            for page, earlier in zip(batch.column("html").to_pylist(), before):
                text = article_text(parse(page), set()) if page else ""
                likelihood.append([*earlier, *text_likelihood(text, held)])
                declared.append(declared_language(page))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in names],
                    pa.array(declared, pa.string()), pa.array(likelihood, pa.list_(pa.float64())),
                ],
                names=[*names, "declared", "likelihood"],
            )

    schema = T.StructType([
        *[rows.schema[name] for name in names],
        T.StructField("declared", T.StringType()),
        T.StructField("likelihood", T.ArrayType(T.DoubleType())),
    ])
    return rows.mapInArrow(run, schema), shared


def normalised(scores: Column) -> Column:
    """Probabilities of log scores."""
    shifted = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b)
    return F.transform(shifted, lambda x: x / total)


def _sums(rows: DataFrame, key: str, n: int, out: str) -> DataFrame:
    """Summed text posteriors by language of each group."""
    total = F.array(*[F.sum(F.col("posterior")[i]) for i in range(n)])
    return rows.groupBy(key).agg(total.alias(out))


def _evidence(scored: DataFrame, key: str, out: str, n: int) -> DataFrame:
    """The log likelihood of each value of ``key`` under each language."""
    sums = materialise(_sums(scored, key, n, "sums")).df
    kinds, *totals = sums.agg(
        F.count(F.lit(1)), *[F.sum(F.col("sums")[i]) for i in range(n)]
    ).first()
    every = F.array(*[F.lit((total or 0.0) + SMOOTHING * kinds) for total in totals])
    return sums.select(
        key, F.zip_with("sums", every, lambda x, y: F.ln((x + SMOOTHING) / y)).alias(out)
    )


def _smoothed(sums: Column, own: Column, wider: Column, trust: float) -> Column:
    """Counts of a group less the page's own, smoothed towards probabilities of a wider one."""
    rest = F.zip_with(sums, own, lambda x, y: F.greatest(x - y, F.lit(0.0)))
    held = F.aggregate(rest, F.lit(0.0), lambda a, b: a + b) + trust
    return F.zip_with(rest, wider, lambda x, p: (x + trust * p) / held)


def identified(pages: DataFrame, labelled: DataFrame, page_id: str = "page_id", url: str = "url",
               html: str = "html", text: str = "text", lang: str = "lang") -> DataFrame:
    """Each page's language, how sure that is, and what each evidence says."""
    counts = materialise(counted_trigrams(labelled, text, lang)).df
    names = sorted(row.lang for row in counts.select("lang").distinct().toLocalIterator())
    n = len(names)
    rows = picked(pages, page_id=page_id, url=url, html=html).withColumn("host", host_of(F.col("url")))
    if not n:
        none = F.lit(None).cast("string")
        return rows.select("page_id", "url", none.alias("lang"), F.lit(0.0).alias("confidence"),
                           none.alias("text_lang"), none.alias("declared"), none.alias("suffix"))
    listed = F.array(*[F.lit(name) for name in names])
    labels = F.split(F.regexp_replace("host", r":\d*$", ""), r"\.")
    known = F.when(F.col("declared").isNull(), "none").when(
        F.array_contains(listed, F.col("declared")), F.col("declared")
    ).otherwise("other")
    scored = rows.withColumn("likelihood", F.array().cast("array<double>"))
    for start in range(0, n, LANGUAGES):
        last = start + LANGUAGES >= n
        found, shared = _scored(scored, learnt(counts, names[start:start + LANGUAGES]), last)
        if not last:
            scored = materialise(found.drop("declared")).df
            shared.unpersist()
    scored = materialise(
        found.withColumns({
            "posterior": normalised(F.col("likelihood")),
            "suffix": F.element_at(labels, -1),
            "site": F.concat_ws(".", F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2)),
            "said": known,
        })
    ).df
    by_host, by_site = _sums(scored, "host", n, "of_host"), _sums(scored, "site", n, "of_site")
    pages_seen, *totals = scored.agg(
        F.count(F.lit(1)), *[F.sum(F.col("posterior")[i]) for i in range(n)]
    ).first()
    overall = [((total or 0.0) + 1.0) / (pages_seen + n) for total in totals]
    said = _evidence(scored, "said", "of_said", n)
    suffix = _evidence(scored, "suffix", "of_suffix", n)
    for side, key in ((by_host, "host"), (by_site, "site"), (said, "said"), (suffix, "suffix")):
        scored = join_measured(scored, materialise(side), [key], "left")
    site = _smoothed(
        F.col("of_site"), F.col("posterior"), F.array(*[F.lit(x) for x in overall]), SITE_TRUST
    )
    prior = _smoothed(F.col("of_host"), F.col("posterior"), site, HOST_TRUST)

    def plus(a, b):
        return F.zip_with(a, b, lambda x, y: x + y)

    fused = plus(plus(plus("likelihood", "of_said"), "of_suffix"), F.transform(prior, F.ln))
    return (
        scored.withColumn("fused", fused).withColumn("fused", normalised(F.col("fused")))
        .select(
            "page_id", "url",
            F.element_at(listed, F.array_position("fused", F.array_max("fused")).cast("int")).alias("lang"),
            F.round(F.array_max("fused"), 6).alias("confidence"),
            F.element_at(
                listed, F.array_position("posterior", F.array_max("posterior")).cast("int")
            ).alias("text_lang"),
            "declared", "suffix",
        )
    )
