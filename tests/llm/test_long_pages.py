"""Operator 9 on pages whose elements have very many siblings."""

import pytest

from marketlake.llm import extract
from marketlake.llm.dom import Page

TEXT = "Paragraph number {} tells how the river rose again, and what the town did about it. Nobody had seen such a spring, they said."


@pytest.fixture(scope="module")
def model():
    return extract.Extractor()


def flat(n, every):
    """(html, article) of n paragraphs directly in the body, an advert after each ``every``."""
    paragraphs = [TEXT.format(i) for i in range(n)]
    parts = [f"<p>{t}</p>" + ('<div class="ad"><p>Buy now!</p></div>' if i % every == every - 1 else "") for i, t in enumerate(paragraphs)]
    nav = '<nav class="menu"><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>'
    html = f'<html><body><h1>The river</h1>{nav}{"".join(parts)}<footer class="footer">&copy; 2020 us</footer></body></html>'
    return html, "\n".join(["The river", *paragraphs])


def test_flat_page_with_adverts(model):
    for n, every in ((30, 10), (100, 10), (150, 30)):
        html, article = flat(n, every)
        assert model.texts([html])[0] == article


def test_sibling_features_do_not_depend_on_their_number(model):
    x, page = {}, {}
    for n in (30, 120):
        page[n] = Page(flat(n, 10)[0])
        x[n] = extract.features(page[n], model.words)
    rows = {n: [i for i in range(len(page[n].tag)) if page[n].tag[page[n].parent[i]] == "body" and page[n].parent[i] >= 0] for n in page}
    for n in page:
        # positions run from 0 to 1 and neighbours are the elements before and after
        assert x[n][rows[n], 20].tolist() == [k / (len(rows[n]) - 1) for k in range(len(rows[n]))]
        paragraphs = sum(page[n].tag[i] == "p" for i in rows[n])
        assert paragraphs == n and all(x[n][i, 30] == n for i in rows[n] if page[n].tag[i] == "p")
    # the first paragraphs, the advert among them, have the same neighbours on both pages
    assert (x[30][rows[30][:25], 24:28] == x[120][rows[120][:25], 24:28]).all()
