import math

import numpy as np
import pytest

from fieldrank.llm import language

PAGE = "page_id long, url string, html string"
TEXT = "doc_id long, text string, lang string"
SF_DIR = "/root/testdata/sf0.01"


def trained(docs):
    counts = language.counted_trigrams(docs)
    names = sorted({row.lang for row in counts.select("lang").collect()})
    return names, language.learnt(counts, names)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) > 50")
    names, model = trained(docs.where("doc_id % 2 = 0"))
    held_out = docs.where("doc_id % 2 = 1").collect()
    right = sum(
        names[int(np.argmax(language.text_likelihood(r.text, model)))] == r.lang for r in held_out
    )
    assert right / len(held_out) > 0.97


def test_pages_are_judged_right(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = language.identified(pages, docs).collect()
    # The address of a page names the language it was made in.
    right = sum(f"/{r.lang}/" in r.url for r in rows)
    assert len(rows) == 250 and right / len(rows) > 0.97


def small(spark):
    texts = {"en": "the house and the garden of the king", "de": "das haus und der garten und der hof"}
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts.items())], TEXT)
    def page(text, lang=None):
        return f"<html{f' lang={lang}' if lang else ''}><body><p>{text}</p></body></html>"
    pages = [(i, f"http://www.a.de/{i}", page(texts["de"], "de-AT")) for i in range(6)]
    pages += [(10 + i, f"http://b.com/{i}", page(texts["en"], "en")) for i in range(5)]
    pages += [(20, "http://www.a.de/x", page("", "de")), (21, "http://b.com/y", page("")),
              (22, "http://x.a.de/z", page("42")), (23, "http://other.org/z", page("", "xx"))]
    return docs, pages


def test_other_evidence_decides_without_text(spark):
    docs, pages = small(spark)
    rows = {r.page_id: r for r in language.identified(spark.createDataFrame(pages, PAGE), docs).collect()}
    assert all(rows[i].lang == "de" for i in range(6)) and all(rows[10 + i].lang == "en" for i in range(5))
    assert (rows[20].lang, rows[21].lang, rows[22].lang) == ("de", "en", "de")
    assert rows[20].confidence < rows[0].confidence
    assert (rows[0].declared, rows[0].suffix, rows[21].declared) == ("de", "de", None)


def test_equals_a_plain_computation(spark):
    docs, pages = small(spark)
    found = {r.page_id: r for r in language.identified(spark.createDataFrame(pages, PAGE), docs).collect()}
    names, model = trained(docs)

    def soft(scores):
        e = np.exp(scores - np.max(scores))
        return e / e.sum()

    like, keys = {}, {}
    for i, url, html in pages:
        like[i] = language.text_likelihood(html.split("<p>")[1].split("</p>")[0], model)
        host = url.split("/")[2]
        lang = language.declared_language(html)
        said = "none" if lang is None else lang if lang in names else "other"
        keys[i] = {"host": host, "site": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1], "said": said}
    post = {i: soft(s) for i, s in like.items()}

    def total(kind, value):
        return sum(post[i] for i in post if keys[i][kind] == value)

    every = (sum(post.values()) + 1) / (len(post) + len(names))
    for i in post:
        fused = like[i].copy()
        for kind in ("said", "suffix"):
            kinds = {k[kind] for k in keys.values()}
            fused += np.log((total(kind, keys[i][kind]) + 0.5) / (sum(post.values()) + 0.5 * len(kinds)))
        site = np.maximum(total("site", keys[i]["site"]) - post[i], 0)
        site = (site + language.SITE_TRUST * every) / (site.sum() + language.SITE_TRUST)
        host = np.maximum(total("host", keys[i]["host"]) - post[i], 0)
        host = (host + language.HOST_TRUST * site) / (host.sum() + language.HOST_TRUST)
        expected = soft(fused + np.log(host))
        assert found[i].lang == names[int(np.argmax(expected))]
        assert math.isclose(found[i].confidence, expected.max(), abs_tol=2e-6)


@pytest.mark.parametrize("page, lang", [
    ('<!-- x --><HTML class="a" lang="EN-us">', "en"), ("<html xml:lang=fr>", "fr"), ("<p lang=de>", None),
    ("<html>", None), (None, None), ("<html lang=''>", None),
])
def test_declared_language(page, lang):
    assert language.declared_language(page) == lang


def test_odd_pages(spark, clashing):
    docs, _ = small(spark)
    odd = spark.createDataFrame(
        [(1, None, None), (2, "", ""), (None, "http://h/x", "<p>das haus"), (4, "x", "<p>the garden " * 9000),
         (5, "http://1.2.3.4:80/", "<p>x"), (5, "http://1.2.3.4:80/", "<p>x")], PAGE)
    rows = language.identified(clashing(odd), clashing(docs)).collect()
    assert len(rows) == 6 and {r.lang for r in rows} <= {"de", "en"}
    assert language.identified(odd.limit(0), docs).collect() == []
    untaught = language.identified(odd, spark.createDataFrame([(1, None, "en"), (2, "x", None)], TEXT))
    assert {r.lang for r in untaught.collect()} == {None}


def test_any_number_of_languages(spark):
    docs = [(i, f"w{i}a w{i}b w{i}c" * 3, f"l{i}-XX") for i in range(500)]
    pages = [(i, f"http://h{i}.org/", f"<p>{text}</p>") for i, text, _ in docs[::50]]
    rows = language.identified(
        spark.createDataFrame(pages, PAGE), spark.createDataFrame(docs, TEXT)
    ).collect()
    assert {r.page_id: r.text_lang for r in rows} == {i: f"l{i}" for i in range(0, 500, 50)}


def test_passes_over_the_languages_give_the_same(spark, monkeypatch):
    docs, pages = small(spark)
    docs = docs.union(spark.createDataFrame([(9, "le roi et la maison du jardin", "FR")], TEXT))
    pages = spark.createDataFrame(pages, PAGE)
    one = sorted(map(repr, language.identified(pages, docs).collect()))
    monkeypatch.setattr(language, "LANGUAGES", 1)
    assert sorted(map(repr, language.identified(pages, docs).collect())) == one


def test_all_articles_of_a_page_count(spark):
    docs, _ = small(spark)
    english = "<article>the house and the garden</article>" * 5
    page = f"{english}<article>das haus und der garten und der hof das haus</article>"
    row = language.identified(spark.createDataFrame([(1, "http://x.org/", page)], PAGE), docs).first()
    assert row.lang == "en"
