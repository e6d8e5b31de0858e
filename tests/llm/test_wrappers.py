"""The labeller on the stored pages, wrapped: containers of any number and name leave the article as it is."""

import re

import pyarrow.parquet as pq
import pytest

from deliverylens.llm import html_labeller
from tests.conftest import DATA

NAMES = {"plain": [], "layout": ["container", "row"], "parts": ["content", "main"], "page": ["wrap", "body"], "odd": ["zzqx", "page-inner"]}


def nested(part: str, n: int, names: list[str]) -> str:
    for k in range(n):
        name = f' class="{names[k % len(names)]}"' if names else ""
        part = f"<div{name}>{part}</div>"
    return part


@pytest.fixture(scope="module")
def pages():
    """Stored pages, each with the text of its article element."""
    out = []
    for page in pq.read_table(f"{DATA}/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist():
        inside = page[page.index("<article>") : page.rindex("</article>")]
        out.append((page, "\n".join(b.text for b in html_labeller.leaves(inside))))
    return out


def same(pages, change) -> float:
    cut = [html_labeller.leaves(change(page)) for page, _ in pages]
    kept = html_labeller.label(cut, html_labeller.trained())
    got = ["\n".join(b.text for b, k in zip(bs, ks) if k) for bs, ks in zip(cut, kept)]
    return sum(g == w for g, (_, w) in zip(got, pages)) / len(pages)


@pytest.mark.parametrize("name", sorted(NAMES))
def test_wrappers_leave_the_article_as_it_is(pages, name):
    names = NAMES[name]
    least = 0.98 if name == "odd" else 0.99  # a name never seen may share its slot with one that speaks
    for n in (1, 2, 10, 500):
        assert same(pages, lambda p: re.sub(r"(<article>.*</article>)", lambda m: nested(m[1], n, names), p, flags=re.S)) >= least
        assert same(pages, lambda p: re.sub(r"<article>(.*)</article>", lambda m: "<article>" + nested(m[1], n, names) + "</article>", p, flags=re.S)) >= least
        assert same(pages, lambda p: re.sub(r"<body>(.*)</body>", lambda m: "<body>" + nested(m[1], n, names) + "</body>", p, flags=re.S)) >= least


def test_articles_without_the_element(pages):
    assert same(pages, lambda p: p) == 1
    assert same(pages, lambda p: p.replace("<article>", '<div class="post">').replace("</article>", "</div>")) >= 0.99
    assert same(pages, lambda p: p.replace("<article>", "<div>").replace("</article>", "</div>")) >= 0.9


def test_a_slash_closes_no_element_of_html():
    found = html_labeller.leaves("<script/>alert(1)</script><a href=http://x/>link</a><p>one<noscript><p>two</p></noscript><svg/><p>three")
    assert [(b.text, b.link) for b in found] == [("link", 4), ("one", 0), ("two", 0), ("three", 0)]


def test_paths_have_no_bound():
    deep = "<article>" + "".join(f'<div class="c{k}">' for k in range(300)) + "<p>text"
    assert html_labeller._slot("<article") in html_labeller.leaves(deep)[0].path
