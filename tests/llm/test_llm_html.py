import random
from functools import cache

import pytest

from fieldrank.llm import wrappers
from fieldrank.llm.html_tree import article_text, parse
from fieldrank.llm.wrappers import Matcher, extracted

PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize("page, text", [
    ("<p>One<p>Two <i>it</i>al&nbsp; x &amp; &copy<ul><li>a<li>b</ul>", "One Two ital x & © a b"),
    ("plain &lt;text&gt;  here", "plain <text> here"),
    ("<article><h1>T</h1><p>a\n\tb<br>c</article><p>outside", "T a b c"),
    ("<nav>n</nav><div id=main>x</div><footer>f</footer><aside>s</aside>", "x"),
    ("<div class='cookie-notice'>c</div><div class='ad'>a</div><p class='lead'>x</p>", "x"),
    ("<div class=topnav>n</div><div id=cookieBar>c</div><p class=commentary>x</p><p class=footnote>y</p>", "x y"),
    ("<header><a>Home</a></header><article><header><h1>T</h1></header>x</article>", "T x"),
    ("<article>x<div id='comments'><p>nice</div><section class='related-posts'>r</section></article>", "x"),
    ("<form><p>in</p></form><script>if (a<b) '</p>'</script><style>p{}</style>x<noscript>n</noscript>", "x"),
    ("<!-- <p>no</p> -->x<!-- open", "x"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "a b c"),
    ("<p>a</b>b</p></div>c", "ab c"),
    ('<p title="a > b">x</p><img alt="<p>">y', "x y"),
    ("<script>never ends <p>x", ""),
    ("<p>cut <b", "cut"),
    ("", ""),
])
def test_text_by_rule(page, text):
    assert article_text(parse(page), set()) == text


@pytest.mark.parametrize("page, text", [
    ("<article>one</article><article>the longer two</article>", "one the longer two"),
    ("<main><h1>T</h1><p>Lead</p><article>a</article><div class=ad>x</div><article>b</article></main>", "T Lead a b"),
    ("<div><h1>T</h1><article>a</article></div><p>outside", "T a"),
    ("<header><h1>Site</h1></header><article>a</article><article class=related>r</article>", "a"),
    ("<nav><h2>n</h2></nav><main>a</main><main>b</main>", "a b"),
    ("<article>a<article>nested</article>b</article>", "a nested b"),
    ("<p>no article", "no article"),
])
def test_article_text_holds_all_parts(page, text):
    assert article_text(parse(page), set()) == text


def test_pages_of_several_articles_stay_whole(spark):
    page = "<main><h1>Live</h1><article>first part</article><article>second, longer part</article></main>"
    row = extracted(spark.createDataFrame([(1, "http://h/1", page)], PAGE)).first()
    assert (row.text, row.n_chars) == ("Live first part second, longer part", 35)


def test_deep_and_odd_pages_end():
    assert article_text(parse("<div>" * 30_000 + "deep"), set()) == "deep"
    assert article_text(parse("<b>x" * 20_000), set()) == "x" * 20_000
    assert article_text(parse("<p a=\"" * 20_000), set()) == ""
    assert len(article_text(parse("<li>x" * 20_000), set())) == 39_999


def tree_page(rng, depth=0):
    tag = rng.choice(["div", "section", "ul"])
    inner = "".join(tree_page(rng, depth + 1) for _ in range(rng.randint(0, 3 if depth < 3 else 0)))
    return f"<{tag}>{inner}</{tag}>"


@pytest.mark.parametrize("seed", range(8))
def test_simple_tree_matching(seed):
    rng = random.Random(seed)
    a, b = parse(tree_page(rng)), parse(tree_page(rng))

    @cache
    def size(i, j):
        if a[i].tag != b[j].tag:
            return 0
        x, y = a[i].children, b[j].children

        @cache
        def best(m, n):
            if not m or not n:
                return 0
            return max(best(m - 1, n), best(m, n - 1), best(m - 1, n - 1) + size(x[m - 1], y[n - 1]))

        return 1 + best(len(x), len(y))

    matcher = Matcher()
    ids_a, ids_b = matcher.structure(a), matcher.structure(b)
    assert matcher.size(ids_a[0], ids_b[0]) == size(0, 0)
    pairs = list(matcher.align(a, ids_a, b, ids_b))
    assert len(pairs) == size(0, 0)
    assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
    assert all(a[i].tag == b[j].tag for i, j in pairs)


def site(n, host="h.example", copies=0):
    """Pages without semantic elements: only their text tells content from frame."""
    def page(k):
        return (
            "<div><div>Site name</div><div>Read our terms</div></div>"
            f"<div><h1>Title {k}</h1><p>Story {k} {'word ' * (k % 7)}</p><p>Signed, the editors</p></div>"
            "<div>All rights reserved</div>"
        )
    rows = [(i, f"http://{host}/{i}", page(i)) for i in range(n)]
    return rows + [(1000 + i, f"http://{host}/c{i}", page(3)) for i in range(copies)]


def test_constant_nodes_are_template_and_slots_are_content(spark):
    for copies in (0, 40):
        pages = spark.createDataFrame(site(12, copies=copies), PAGE)
        rows = {r.page_id: r for r in extracted(pages).collect()}
        assert len(rows) == 12 + copies
        for k in range(12):
            words = " ".join(["word"] * (k % 7))
            assert rows[k].text == f"Title {k} Story {k} {words}".strip()
            assert rows[k].n_chars == len(rows[k].text)
        assert {r.text for i, r in rows.items() if i >= 1000} <= {"Title 3 Story 3 word word word"}


def test_few_pages_lose_nothing(spark):
    rows = extracted(spark.createDataFrame(site(2), PAGE)).collect()
    assert all("Signed, the editors" in r.text for r in rows)


def test_odd_pages(spark, clashing):
    odd = [(1, None, None), (2, "", ""), (None, "http://h/x", "<p>x</p>"), (4, "no address", "<p>y"),
           (5, "http://h/x", "<p>x</p>"), (5, "http://h/x", "<p>x</p>"), (6, "HTTP://H/z", "z " * 100_000)]
    pages = spark.createDataFrame(odd, PAGE)
    rows = extracted(clashing(pages)).collect()
    assert sorted((r.page_id or 0, r.text.strip()) for r in rows) == [
        (0, "x"), (1, ""), (2, ""), (4, "y"), (5, "x"), (5, "x"), (6, " ".join(["z"] * 100_000)),
    ]
    assert extracted(pages.limit(0)).collect() == []


def wide(k, rows, extra=0):
    """Flat pages whose constant footer and frame stand beside ``rows`` own paragraphs."""
    body = "".join(f"<p>Own {k} {i}</p>" for i in range(rows + extra))
    return f"<div><b>Frame</b>{'<i>n</i>' * extra}{body}<u>All rights reserved</u></div>"


@pytest.mark.parametrize("rows", [30, 300, 600, 5000])
def test_one_rule_for_any_number_of_siblings(spark, rows):
    pages = [(k, f"http://w/{k}", wide(k, rows, k % 3)) for k in range(8)]
    found = extracted(spark.createDataFrame(pages, PAGE)).collect()
    assert len(found) == 8
    for row in found:
        assert "All rights reserved" not in row.text and "Frame" not in row.text
        assert row.text.count("Own") == rows + row.page_id % 3


def test_halved_tables_match_as_much(monkeypatch):
    rng = random.Random(5)
    tags = ["div", "p", "ul", "b"]
    def page():
        return parse("".join(f"<{t}></{t}>" for t in rng.choices(tags, k=rng.randint(40, 70))))
    for _ in range(10):
        a, b = page(), page()
        sizes = []
        for cells in (10_000, 40, 1):
            monkeypatch.setattr(wrappers, "_CELLS", cells)
            matcher = Matcher()
            ids_a, ids_b = matcher.structure(a), matcher.structure(b)
            sizes.append(matcher.size(ids_a[0], ids_b[0]))
            pairs = list(matcher.align(a, ids_a, b, ids_b))
            assert len(pairs) == sizes[-1]
            assert [i for i, _ in sorted(pairs)] == sorted(i for i, _ in pairs)
        assert len(set(sizes)) == 1


def test_constant_text_is_found_at_any_depth(spark):
    def page(k):
        return "<div>" * 500 + f"<p>Own {k}</p>" * (1 + k % 2) + "<u>Signed, the editors</u>" + "</div>" * 500

    pages = [(k, f"http://d/{k}", page(k)) for k in range(8)]
    assert all("Signed" not in r.text and "Own" in r.text
               for r in extracted(spark.createDataFrame(pages, PAGE)).collect())


def test_a_repeated_article_stays_on_all_its_pages(spark):
    article = "<article>" + "".join(f"<p>Sentence {i} of the story.</p>" for i in range(17)) + "</article>"
    def page(k):
        menu = "".join(f"<li>Menu {k} entry {i} with quite some text" for i in range(20))
        return f"<body><ul class=links>{menu}</ul>{article}<p class=sponsored>Advert {k}</p></body>"

    pages = [(k, f"http://r/{k}", page(k)) for k in range(8)]
    texts = {r.text for r in extracted(spark.createDataFrame(pages, PAGE)).collect()}
    assert texts == {" ".join(f"Sentence {i} of the story." for i in range(17))}
