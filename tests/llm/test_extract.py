"""Operator 9 on pages with known articles."""

import random
import re

import pytest

from marketlake.llm import extract
from marketlake.llm.dom import Page


@pytest.fixture(scope="module")
def model():
    return extract.Extractor()


def test_given_pages_exactly(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        inner = Page(r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")])
        assert model.texts([r["html"]])[0] == inner.text([True] * len(inner.tag))


def test_unseen_layouts(model):
    rng, exact = random.Random(77), 0
    for _ in range(150):
        page, labels = extract._labelled(html := extract.training_page(rng))
        exact += model.texts([re.sub(r' y="[cbs]"', "", html)])[0] == page.text([y == extract.C for y in labels])
    assert exact > 0.85 * 150


def test_parts_of_a_page(model):
    html = """<html><head><title>T</title><style>x{}</style></head><body><header class="site-header"><a href="/">Home</a></header>
    <nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav><div class="cookie-notice">We use cookies. <button>OK</button></div>
    <article><h1>A &amp; B</h1><p>First <em>para</em>\n\n with &eacute;&#233; and 1 &lt; 2.<p>Second one, rather longer, ends here.<script>var a = "<p>no</p>";</script>
    <div class="ad"><p>Buy now!</p></div><p>Third paragraph, after the advert.</p></article><section class="comments"><h3>Comments</h3><div class="comment">
    <p>Nice read, thanks!</p></div><form><textarea>say</textarea></form></section><aside class="sidebar"><h3>Related</h3><a href="/c">More</a></aside>
    <footer>&copy; 2020 us</footer></body></html>"""
    assert model.texts([html])[0] == "A & B\nFirst para with éé and 1 < 2.\nSecond one, rather longer, ends here.\nThird paragraph, after the advert."


def test_decoding_has_no_contradictions(model):
    rng = random.Random(3)
    for _ in range(40):
        page, _ = extract._labelled(extract.training_page(rng))
        labels = extract.decode(page, model.trees.log_proba(extract.features(page, model.words)))
        for i in range(1, len(labels)):
            up = labels[page.parent[i]]
            assert not (up == extract.B and labels[i] != extract.B) and not (up == extract.C and labels[i] == extract.S)


def test_odd_rows(docs_df, model):
    rows = [(1, None), (2, ""), (3, "<p"), (4, "<div><p>cut off <b>he"), (5, "<!-- x"), (6, "<a href='\"<\"<\"<"), (None, "</p></div>"), (7, "<p>" * 3000 + "deep")]
    out = extract.extract(docs_df([(i, h, 5) for i, h in rows], "page_id long, html string, text int"), extractor=model)
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert len(got) == len(rows) and got[1] == "" and got[2] == "" and got[3] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    assert extract.extract(docs_df([], "page_id long, html string"), extractor=model).count() == 0
