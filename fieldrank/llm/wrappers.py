"""Main text of pages by wrapper induction.

Per host one page is the seed (the one whose hash is smallest). Every page of the
host is aligned with the seed by simple tree matching: two elements match if they
have the same name, and their children are matched in order so that most
elements match. Aligned elements whose text is the same on nearly all pages are
template; the others are slots whose text varies, the content. A page that shares
more than nine tenths of the seed's article is a copy of it and no evidence, so an
article that a host repeats under other menus is no template; nor is a template
that would leave a page without any text.

Children are matched by the same rule however many there are: equal children at
both ends are matched first (no better matching exists), and the rest by dynamic
programming, in halves where a table would be larger than ``_CELLS``. Elements are
matched at any depth.

What varies but is no article (menus, adverts, comments and so on) is left out
by element, role and class; see ``html_tree``.

Counts of equal texts are summed per task before they are shuffled, so a host
with a third of all pages moves a few rows per task. Alignments depend on the
structure only and are kept by pair of structures.

Nulls and empty pages have an empty text; pages without an address are one host.
Repeated rows count as copies. An empty table gives no rows. Only the named
columns are read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.llm.common import join_measured, picked
from fieldrank.llm.html_tree import Node, article_elements, article_text, own_text, parse
from fieldrank.materialise import materialise

# An element is template if its text is equal on this share of the pages that give
# evidence, of which there must be so many.
EQUAL_SHARE = 0.9
LEAST_PAGES = 4

# A page with a larger share of its article in common with the seed is a copy.
COPY_SHARE = 0.9

# Largest table of children that is held at once.
_CELLS = 1_000_000

# Structures, or hosts, that a task remembers.
_REMEMBERED = 100_000
_HOSTS = 500


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def _equal_ends(a: tuple, b: tuple) -> tuple[int, int]:
    """How many children are equal from the start, and how many of the rest from the end."""
    most = min(len(a), len(b))
    start = 0
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[-1 - end] == b[-1 - end]:
        end += 1
    return start, end


def _places(kinds: list[int], items: tuple) -> np.ndarray:
    known = {kind: i for i, kind in enumerate(kinds)}
    return np.array([known[item] for item in items])


def _scores(kinds: np.ndarray, rows: np.ndarray, columns: np.ndarray, every: bool) -> np.ndarray:
    """The best totals of all beginnings of both lists; only those of all rows unless ``every``."""
    best = np.zeros((len(rows) + 1 if every else 1, len(columns) + 1), dtype=np.int64)
    now = best[0]
    for i, row in enumerate(rows):
        after = best[i + 1] if every else np.zeros_like(now)
        after[1:] = np.maximum.accumulate(np.maximum(now[1:], now[:-1] + kinds[row][columns]))
        now = after
    return best if every else now


def _best_pairs(kinds: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Pairs in order of both lists with the highest total of ``kinds``.

    A large table is never held: the rows are halved, and the columns where the best
    totals of both halves meet (Hirschberg).
    """
    out, waiting = [], [(0, len(rows), 0, len(columns))]
    while waiting:
        top, bottom, left, right = waiting.pop()
        m, n = bottom - top, right - left
        if not m or not n:
            continue
        if m > 1 and m * n > _CELLS:
            half = (top + bottom) // 2
            above = _scores(kinds, rows[top:half], columns[left:right], False)
            below = _scores(kinds, rows[half:bottom][::-1], columns[left:right][::-1], False)
            cut = left + int(np.argmax(above + below[::-1]))
            waiting += [(top, half, left, cut), (half, bottom, cut, right)]
            continue
        best = _scores(kinds, rows[top:bottom], columns[left:right], True)
        i, j = m, n
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((top + i, left + j))
    return sorted(out)


class Matcher:
    """Simple tree matching on interned structures."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.structures: list[tuple] = []
        self.elements: list[int] = []
        self.sizes: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def full(self) -> bool:
        return len(self.structures) > _REMEMBERED or len(self.sizes) > 10 * _REMEMBERED

    def structure(self, nodes: list[Node]) -> list[int]:
        """A number for the structure below each element, equal for equal ones."""
        out = [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            node = nodes[i]
            key = (node.tag, node.names, tuple(out[c] for c in node.children))
            if key not in self.numbers:
                self.numbers[key] = len(self.structures)
                self.structures.append(key)
                self.elements.append(1 + sum(self.elements[c] for c in key[2]))
            out[i] = self.numbers[key]
        return out

    def _known(self, a: int, b: int) -> int | None:
        """The size where no matching of children is needed for it."""
        if a == b:
            return self.elements[a]
        if self.structures[a][:2] != self.structures[b][:2]:
            return 0
        return self.sizes.get((a, b))

    def size(self, a: int, b: int) -> int:
        """The number of matching elements of two structures.

        Children come before their parents, without recursion: pages nest deeply.
        """
        waiting = [(a, b)]
        while waiting:
            now = waiting[-1]
            if self._known(*now) is not None:
                waiting.pop()
                continue
            below_a, below_b = self.structures[now[0]][2], self.structures[now[1]][2]
            start, end = _equal_ends(below_a, below_b)
            middle_a, middle_b = below_a[start:len(below_a) - end], below_b[start:len(below_b) - end]
            kinds_a, kinds_b = list(dict.fromkeys(middle_a)), list(dict.fromkeys(middle_b))
            open_ones = [(x, y) for x in kinds_a for y in kinds_b if self._known(x, y) is None]
            if open_ones:
                waiting += open_ones
                continue
            waiting.pop()
            pairs = [(i, i) for i in range(start)]
            if middle_a and middle_b:
                kinds = np.array([[self._known(x, y) for y in kinds_b] for x in kinds_a])
                rows, columns = _places(kinds_a, middle_a), _places(kinds_b, middle_b)
                pairs += [(start + i, start + j) for i, j in _best_pairs(kinds, rows, columns)]
            pairs += [(len(below_a) - k, len(below_b) - k) for k in range(end, 0, -1)]
            self.pairs[now] = pairs
            self.sizes[now] = 1 + sum(self._known(below_a[i], below_b[j]) for i, j in pairs)
        return self._known(a, b)

    def matched(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places of matching children of two structures whose size is known."""
        if a == b:
            return [(i, i) for i in range(len(self.structures[a][2]))]
        return self.pairs[a, b]

    def align(self, seed: list[Node], seed_ids: list[int], page: list[Node], ids: list[int]):
        """Pairs of aligned elements, seed and page."""
        waiting = [(0, 0)]
        while waiting:
            a, b = waiting.pop()
            if not self.size(seed_ids[a], ids[b]):
                continue
            yield a, b
            waiting += [
                (seed[a].children[i], page[b].children[j])
                for i, j in self.matched(seed_ids[a], ids[b])
            ]


class Aligner:
    """Aligns pages with the seeds of their hosts; a task has one."""

    def __init__(self):
        self.matcher, self.seeds = Matcher(), {}

    def __call__(self, host: str, seed_html: str, page: list[Node]) -> tuple[list, dict[int, int]]:
        """(seed element, page element, equal texts) where the seed has text, and the
        lengths of the texts of the seed's article."""
        if self.matcher.full() or len(self.seeds) > _HOSTS:
            self.matcher.forget()
            self.seeds.clear()
        if host not in self.seeds:
            seed = parse(seed_html)
            texts = [own_text(n) for n in seed]
            article = {a: len(texts[a]) for a in article_elements(seed) if texts[a]}
            self.seeds[host] = seed, self.matcher.structure(seed), texts, article
        seed, seed_ids, seed_texts, article = self.seeds[host]
        ids = self.matcher.structure(page)
        return [
            (a, b, seed_texts[a] == own_text(page[b]))
            for a, b in self.matcher.align(seed, seed_ids, page, ids) if seed_texts[a]
        ], article


def _is_copy(aligned: list, article: dict[int, int]) -> bool:
    equal = sum(article.get(a, 0) for a, _, same in aligned if same)
    return equal > COPY_SHARE * sum(article.values())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and seed element: pages aligned there, and those with an equal text."""
    aligner = Aligner()
    counts: dict[tuple[str, int], list[int]] = {}

    def result():
        rows = [(host, element, *n) for (host, element), n in counts.items()]
        counts.clear()
        columns = list(zip(*rows)) or [[]] * 4
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["host", "element", "pages", "equal"],
        )

    for batch in batches:
        for host, seed, page in zip(*(batch.column(n).to_pylist() for n in ("host", "seed", "html"))):
            if not page or not seed or page == seed:
                continue
            aligned, article = aligner(host, seed, parse(page))
            if _is_copy(aligned, article):
                continue
            for a, _, equal in aligned:
                seen = counts.setdefault((host, a), [0, 0])
                seen[0] += 1
                seen[1] += equal
        if len(counts) > _REMEMBERED:
            yield result()
    yield result()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner = Aligner()
    for batch in batches:
        texts = []
        columns = (batch.column(n).to_pylist() for n in ("host", "seed", "template", "html"))
        for host, seed, template, page in zip(*columns):
            if not page:
                texts.append("")
                continue
            nodes, dropped = parse(page), set()
            if template:
                constant = set(map(int, template.split(",")))
                aligned, _ = aligner(host, seed, nodes)
                dropped = {b for a, b, equal in aligned if equal and a in constant}
            texts.append(article_text(nodes, dropped) or (article_text(nodes, set()) if dropped else ""))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
              equal_share: float = EQUAL_SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each page."""
    rows = picked(pages, page_id=page_id, url=url, html=html).withColumn("host", host_of(F.col("url")))
    rows = rows.withColumn("_draw", F.xxhash64("page_id", "url"))
    drawn = materialise(
        rows.where(F.length("html") > 0).groupBy("host").agg(F.min("_draw").alias("_draw"))
    )
    # Equal draws are repeated rows, or nearly never others: the smallest page of them.
    seeds = materialise(
        join_measured(rows.where(F.length("html") > 0), drawn, ["host", "_draw"], "inner")
        .groupBy("host").agg(F.min("html").alias("seed"))
    )
    counted = (
        join_measured(rows.select("host", "html"), seeds, ["host"], "inner")
        .mapInArrow(_count, "host string, element int, pages long, equal long")
        .groupBy("host", "element").agg(F.sum("pages").alias("pages"), F.sum("equal").alias("equal"))
        .where((F.col("pages") >= least_pages) & (F.col("equal") >= equal_share * F.col("pages")))
        .groupBy("host")
        .agg(F.array_join(F.array_sort(F.collect_list("element")).cast("array<string>"), ",").alias("template"))
    )
    wrappers = materialise(seeds.df.join(counted, "host"))
    found = join_measured(rows.drop("_draw"), wrappers, ["host"], "left")
    return found.mapInArrow(
        _extract,
        T.StructType([
            rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]),
    )
