"""Operator 9: main text of web pages by gradient-boosted trees over DOM nodes.

Every element gets features of itself, its subtree, its ancestors and its siblings, and trees give
it a probability of being article (C), boilerplate (B) or neither, a wrapper (S).  Decoding picks the
likeliest labelling of the whole tree without contradictions: all below boilerplate is boilerplate,
below article is article or boilerplate, below a wrapper is anything.

Nobody labelled pages here, so the trees are trained on pages written by ``training_page``, whose
labels are known.
"""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.llm.boosting import Boosted
from marketlake.llm.common import map_batches
from marketlake.llm.dom import Page

C, B, S = 0, 1, 2
#: Training pages, written anew from SEED at each fit.
PAGES, SEED = 700, 5
_CONTROLS = frozenset("input button select textarea label option".split())
_SENTENCE = frozenset(".!?,;:")


class Words:
    """How much a tag or an attribute token speaks for article and for boilerplate, from training pages."""

    def __init__(self, pages: list[tuple[Page, list[int]]]):
        count = defaultdict(lambda: np.full(3, 0.5))
        for page, labels in pages:
            for tag, tokens, y in zip(page.tag, page.tokens, labels):
                for w in ("<" + tag, *tokens):
                    count[w][y] += 1
        self.odds = {w: (float(np.log(n[C] / n[B])), float(np.log(n[S] / (n[C] + n[B])))) for w, n in count.items() if n.sum() >= 4}

    def of(self, words: list[str]) -> tuple[float, float, float]:
        """(most against, most for article, most for wrapper) among some words."""
        known = [self.odds[w] for w in words if w in self.odds]
        if not known:
            return 0.0, 0.0, 0.0
        return min(0.0, min(k[0] for k in known)), max(0.0, max(k[0] for k in known)), max(k[1] for k in known)


def features(page: Page, words: Words) -> np.ndarray:
    """One row per element."""
    n, tag, parent = len(page.tag), page.tag, page.parent
    own, marks, symbols = [0] * n, [0] * n, [0] * n
    before, total = [-1] * n, 0
    blocks: list[set] = [set() for _ in range(n)]
    for i, b, t in page.pieces:
        size = len(t) - t.count(" ")
        if size and not t.isspace():
            own[i] += size
            marks[i] += sum(map(t.count, _SENTENCE))
            symbols[i] += t.count("©") + t.count("|") + t.count("»") + t.count("·")
            blocks[i].add(b)
            if before[i] < 0:
                before[i] = total
            total += size
    chars, sent, sym, links = own[:], marks[:], symbols[:], [0] * n
    nodes, paras, items, controls, heads = [1] * n, [0] * n, [0] * n, [0] * n, [0] * n
    kids: list[list[int]] = [[] for _ in range(n)]
    place, alike = [0] * n, [defaultdict(int) for _ in range(n)]  # among its parent's children; children by tag
    for i in range(n):
        t = tag[i]
        if parent[i] >= 0:
            place[i] = len(kids[parent[i]])
            kids[parent[i]].append(i)
            alike[parent[i]][t] += 1
        paras[i], items[i], controls[i], heads[i] = t == "p", t == "li", t in _CONTROLS, t in ("h1", "h2")
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        if tag[i] == "a":
            links[i] = chars[i]
        if before[i] >= 0 and (before[p] < 0 or before[i] < before[p]):
            before[p] = before[i]
        chars[p] += chars[i]
        sent[p] += sent[i]
        sym[p] += sym[i]
        links[p] += links[i]
        nodes[p] += nodes[i]
        paras[p] += paras[i]
        items[p] += items[i]
        controls[p] += controls[i]
        heads[p] += heads[i]
    out = np.zeros((n, 31), np.float64)
    path = [(0.0, 0.0)] * n
    both = [words.of(["<" + tag[i]] + page.tokens[i]) for i in range(n)]
    for i in range(n):
        p = parent[i]
        by_tag, by_attr = words.of(["<" + tag[i]]), words.of(page.tokens[i])
        above = path[p] if p >= 0 else (0.0, 0.0)
        path[i] = (min(above[0], by_tag[0], by_attr[0]), max(above[1], by_tag[1], by_attr[1]))
        sib = kids[p] if p >= 0 else [i]
        at = place[i]
        near = [both[s] if s >= 0 else (0.0, 0.0, 0.0) for s in (sib[at - 1] if at else -1, sib[at + 1] if at + 1 < len(sib) else -1)]
        c, whole = chars[i], max(1, total)
        out[i] = (*by_tag, *by_attr, *above, page.depth[i], np.log1p(c), links[i] / max(1, c), c / nodes[i], np.log1p(own[i]), c / whole, sent[i] / max(1, c),
                  np.log1p(nodes[i]), np.log1p(paras[i]), np.log1p(items[i]), controls[i], np.log1p(heads[i]), at / max(1, len(sib) - 1), np.log1p(len(sib)),
                  c / max(1, chars[p] if p >= 0 else c), max(0, before[i]) / whole, near[0][0], near[0][1], near[1][0], near[1][1],
                  sym[i], len(page.tokens[i]), alike[p][tag[i]] if p >= 0 else 1)
    return out


def decode(page: Page, logp: np.ndarray) -> list[int]:
    """The likeliest labels without contradictions, by dynamic programming over the tree."""
    n, parent = len(page.tag), page.parent
    best = logp.copy()  # of the subtree, by the label of its root
    for i in range(n - 1, 0, -1):
        c, b, s = best[i]
        p = parent[i]
        best[p, B] += b
        best[p, C] += max(c, b)
        best[p, S] += max(c, b, s)
    out = [int(best[0].argmax())]
    for i in range(1, n):
        up = out[parent[i]]
        allowed = (B,) if up == B else (C, B) if up == C else (C, B, S)
        out.append(max(allowed, key=lambda y: best[i, y]))
    return out


class Extractor:
    """Boosted trees with the word table that their features use."""

    def __init__(self, pages: int = PAGES, seed: int = SEED):
        rng = random.Random(seed)
        written = [training_page(rng) for _ in range(pages)]
        known = [(page, labels) for page, labels in map(_labelled, written)]
        half = len(known) // 2
        # words are weighed on one half and their weights used on the other, as on unseen pages
        rows, y = [], []
        for words, part in ((Words(known[:half]), known[half:]), (Words(known[half:]), known[:half])):
            for page, labels in part:
                rows.append(features(page, words))
                y += labels
        self.words = Words(known)
        self.trees = Boosted(3).fit(np.concatenate(rows), np.array(y))

    def texts(self, htmls: list[str | None]) -> list[str]:
        pages = [Page(h) for h in htmls]
        x = [features(p, self.words) for p in pages]
        logp = self.trees.log_proba(np.concatenate(x)) if x else None
        out, at = [], 0
        for p in pages:
            n = len(p.tag)
            labels = decode(p, logp[at:at + n])
            at += n
            out.append(p.text([y == C for y in labels]))
        return out


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None, extractor: Extractor | None = None) -> DataFrame:
    """``pages`` with text (the article's blocks, one a line) and n_chars (its code points).

    Null and empty html give an empty text; malformed and cut-off html is read as far as it goes;
    repeated rows repeat their result; input columns named text or n_chars are replaced."""
    box = pages.sparkSession.sparkContext.broadcast(extractor or Extractor())  # a few hundred small trees

    def make():
        model = box.value

        def f(htmls):
            out = []
            for i in range(0, len(htmls), 64):
                out += model.texts(htmls[i:i + 64])
            return [out, [len(t) for t in out]]

        return f

    return map_batches(pages, keep or pages.columns, [html_col], [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())], make)


# --- training pages -------------------------------------------------------------------------------
# fixed values: usual names of page parts
_PARTS = {
    "nav": (["nav", "div", "ul"], "nav menu navbar navigation breadcrumb breadcrumbs topnav links tabs toc pagination pager skip"),
    "header": (["header", "div"], "header masthead top site branding logo banner"),
    "footer": (["footer", "div"], "footer foot bottom copyright legal colophon site"),
    "aside": (["aside", "div", "section"], "sidebar side aside widget widgets related popular trending recommended archive tags more rail"),
    "ad": (["div", "aside", "ins", "section"], "ad ads advert advertisement adsense sponsor sponsored promo promotion banner"),
    "notice": (["div", "section", "p", "dialog"], "notice cookie cookies consent gdpr alert banner popup modal newsletter subscribe paywall message"),
    "form": (["form", "div"], "form search login signup contact newsletter subscribe"),
    "comments": (["section", "div", "ol", "aside"], "comments comment comment-list replies responses discussion disqus respond thread"),
    "share": (["div", "ul", "p"], "share social sharing follow buttons byline-links tags"),
}
_MAIN = "content main article post entry story body text page single blog entry-content post-content article-body prose news"
_WRAP = "wrapper container page site layout row col outer inner root app wrap grid main-wrap"


def training_page(rng: random.Random) -> str:
    """A page whose elements say in an attribute ``y`` what they are: c, b or s."""
    syllables = [rng.choice("bcdfghjklmnprstvwzaeiouéüñ") + rng.choice("aeiouäéónrstl") + rng.choice(["", "n", "r", "ch", "s"]) for _ in range(60)]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def phrase(lo, hi):
        return " ".join(word() + (rng.choice([",", "", "", "", "%%%", "&amp;", "***"]) if rng.random() < 0.15 else "") for _ in range(rng.randint(lo, hi)))

    def sentences(lo, hi):
        return " ".join(phrase(1, 18).capitalize() + rng.choice([".", ".", ".", "!", "?"]) for _ in range(rng.randint(lo, hi)))

    def attr(names, chance=0.75):
        if rng.random() > chance:
            return rng.choice(["", "", f' class="{word()}"'])
        picked = rng.sample(names.split(), min(len(names.split()), rng.choice([1, 1, 1, 2])))
        value = rng.choice(["-", "_", " "]).join(picked) + rng.choice(["", "", "", f"-{rng.randint(1, 9)}", " " + word()])
        return f' {rng.choice(["class", "class", "id", "role"])}="{value}"'

    def el(tag, y, inner, attrs=""):
        return f'<{tag}{attrs} y="{y}">{inner}</{tag}>'

    def links(n, y="b"):
        if rng.random() < 0.7:
            return el("ul", y, "".join(el("li", y, el("a", y, phrase(1, 4), ' href="/x"')) for _ in range(n)))
        return rng.choice([" ", " | ", " &middot; "]).join(el("a", y, phrase(1, 4), ' href="/x"') for _ in range(n))

    def fields():
        return "".join(rng.choice([el("label", "b", phrase(1, 3)), '<input type="text" y="b">', el("button", "b", phrase(1, 2)), el("textarea", "b", phrase(0, 3)),
                                   el("select", "b", el("option", "b", phrase(1, 2)) * 2)]) for _ in range(rng.randint(1, 5)))

    def boiler(kind):
        tags, names = _PARTS[kind]
        tag = rng.choice(tags)
        if kind == "nav":
            inner = links(rng.randint(2, 9))
        elif kind == "form":
            inner = rng.choice(["", el("h3", "b", phrase(1, 4))]) + fields()
        elif kind == "comments":
            one = lambda: rng.choice([el("li", "b", el("p", "b", sentences(1, 4))), el("div", "b", el("b", "b", phrase(1, 2)) + el("p", "b", sentences(1, 4)), attr("comment reply")),
                                      el("p", "b", sentences(1, 3))])
            inner = rng.choice(["", el("h3", "b", phrase(1, 3))]) + "".join(one() for _ in range(rng.choice([rng.randint(1, 7)] * 9 + [rng.randint(20, 90)]))) + rng.choice(["", el("form", "b", fields())])
        elif kind == "aside":
            inner = rng.choice([lambda: el("h3", "b", phrase(1, 3)) + links(rng.randint(2, 6)), lambda: el("p", "b", sentences(1, 3)), lambda: sentences(1, 2)])()
        elif kind == "header":
            inner = rng.choice([lambda: el("a", "b", phrase(1, 3), ' href="/"') + links(3), lambda: el("h1", "b", phrase(1, 3)) + el("p", "b", phrase(2, 6)), lambda: phrase(1, 5), lambda: el("span", "b", phrase(1, 4))])()
        elif kind == "footer":
            inner = rng.choice([lambda: "&copy; " + phrase(1, 6), lambda: "&copy; " + word() + ".example.com &middot; " + sentences(1, 3), lambda: el("p", "b", "&copy; 2020 " + phrase(2, 8)) + links(3), lambda: links(4), lambda: sentences(1, 2)])()
        elif kind == "share":
            inner = links(rng.randint(1, 4))
        else:
            inner = rng.choice([lambda: sentences(1, 3), lambda: el("p", "b", sentences(1, 2)), lambda: el("a", "b", phrase(2, 6), ' href="/x"'), lambda: el("p", "b", phrase(2, 9)) + el("button", "b", phrase(1, 2)), lambda: el("span", "b", phrase(1, 6))])()
        sure = 1.0 if tag in ("div", "section", "p", "ul", "ol", "ins", "dialog") else 0.4
        return el(tag, "b", inner, attr(names, sure))

    def paragraph():
        r = rng.random()
        if r < 0.12:
            return f'<p y="c"><b y="c">{sentences(1, 2)}<br y="c">'  # left open
        if r < 0.25:
            return el("p", "c", sentences(0, 2) + " " + el(rng.choice(["a", "b", "em", "span", "i", "strong", "code"]), "c", phrase(1, 5)) + " " + sentences(0, 2))
        if r < 0.4:
            return el("p", "c", phrase(1, 2).capitalize() + ".")
        if r < 0.46:
            return f'<p y="c">{sentences(1, 3)}'
        return el("p", "c", sentences(1, 9))

    def body(flat=False):
        out = []
        if rng.random() < 0.8:
            h = el("h1", "c", phrase(1, 9).capitalize())
            out.append(el("header", "c", h) if rng.random() < 0.08 else h)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9, 20] * (1 if flat else 3) + [rng.randint(50, 160)] * (4 if flat else 1))):
            r = rng.random()
            if r < 0.8:
                out.append(paragraph())
            elif r < 0.85:
                out.append(el(rng.choice(["h2", "h3"]), "c", phrase(1, 6)))
            elif r < 0.89:
                out.append(el(rng.choice(["ul", "ol"]), "c", "".join(el("li", "c", sentences(1, 1)) for _ in range(rng.randint(1, 5)))))
            elif r < 0.91:
                out.append(el("blockquote", "c", rng.choice([sentences(1, 3), el("p", "c", sentences(1, 3))])))
            elif r < 0.92:
                out.append(el("pre", "c", phrase(3, 20)))
            elif r < 0.935:
                out.append(el("table", "c", el("tr", "c", el("td", "c", phrase(1, 4)) + el("td", "c", phrase(1, 4)))))
            elif r < 0.95:
                out.append(el("figure", "c", '<img src="a.png" y="c">' + el("figcaption", "c", phrase(2, 9))))
            elif r < 0.96:
                out.append(el("div", "c", el("p", "c", sentences(1, 4))))
            else:
                out.append(boiler(rng.choice(["ad", "share", "aside", "notice", "form", "nav"])))
        if not any('y="c"' in x for x in out):
            out.append(paragraph())
        return "".join(out)

    r = rng.random()
    if r < 0.5:
        main = el("article", "c", body(), attr(_MAIN, 0.3))
    elif r < 0.62:
        main = el("main", rng.choice("cs"), el("article", "c", body(), attr(_MAIN, 0.3)))
        main = main.replace('<main y="c"', '<main y="s"')
    elif r < 0.72:
        main = el("main", "c", body(), attr(_MAIN, 0.3))
    elif r < 0.92:
        main = el(rng.choice(["div", "section"]), "c", body(), attr(_MAIN, 1.0))
    else:
        main = body(flat=True)
    if rng.random() < 0.12:
        main = el(rng.choice(["main", "div", "section"]), "s", main + "".join(boiler(rng.choice(["comments", "aside", "share"])) for _ in range(rng.randint(1, 2))), attr(_WRAP, 0.7))
    top = [boiler(k) for k in ("notice", "header", "nav", "ad", "form") if rng.random() < 0.45]
    end = [boiler(k) for k in ("ad", "share", "comments", "aside", "form", "nav", "notice", "footer") if rng.random() < 0.4]
    rng.shuffle(top)
    parts = "".join(top) + rng.choice(["", "<!-- x -->"]) + main + "".join(end)
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        parts = el("div", "s", parts, attr(_WRAP, 0.8))
    head = el("head", "b", f'<meta charset="utf-8" y="b">{el("title", "b", phrase(1, 9))}<style y="b">p{{margin:0}}</style><script y="b">var t="</p>";</script>')
    html = f'<!DOCTYPE html><html lang="en" y="s">{head}<body y="s">{parts}'
    return html + rng.choice(["</body></html>", "</body></html>", "", ""])


def _labelled(html: str) -> tuple[Page, list[int]]:
    """A training page's tree without the label attributes, and its labels."""
    from re import findall, sub

    marks = [m for m in findall(r' y="([cbs])"', html)]
    page = Page(sub(r' y="[cbs]"', "", html))
    labels = [S] + [{"c": C, "b": B, "s": S}[m] for m in marks]
    assert len(labels) == len(page.tag), html
    return page, labels
