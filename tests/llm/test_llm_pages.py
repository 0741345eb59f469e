"""Tag-path ratios: the scores by plain loops, pages whose names say nothing, and what happens without the ratios."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF0001

from folio.llm import tagpath

ARTICLE = [f"Paragraph {i}, with some words of it, and more. It goes on; quite long, as text does. " * (1 + i % 4) for i in range(12)]
PARTS = {"menu": "".join(f"<div><a href=/{i}>Entry number {i}</a></div>" for i in range(90)), "advert": "<span>Buy it now</span>",
         "foot": "All rights with us", "article": "".join(f"<p>{p}</p>" for p in ARTICLE)}


def neutral_page(names=iter(range(10**9))):
    part = lambda x: f'<div class="x{next(names)}">{PARTS[x]}</div>'
    return f'<html><body><div class="q">{part("menu")}{part("advert")}<div class="z">{part("article")}</div>{part("foot")}</div></body></html>'


WANT = "\n\n".join(p.strip() for p in ARTICLE)


def test_page_of_neutral_names():
    assert tagpath.main_text(neutral_page()) == WANT


def test_short_blocks_stay_in_a_neutral_content_node():
    extra = "<h2>Head</h2><ul><li>a<li>b</ul><table><tr><td>1<td>2</table>"
    page = f'<div class="k">{PARTS["menu"]}</div><div class="j">{PARTS["article"]}{extra}{PARTS["article"]}</div>'
    assert tagpath.main_text(page) == "\n\n".join([WANT, "Head", "a", "b", "1", "2", WANT])


def test_without_ratios_the_neutral_page_is_lost(monkeypatch):
    """With every path scored alike the menu and the foot come along: the ratios decide."""
    monkeypatch.setattr(tagpath, "path_scores", lambda found: (np.ones(len(found)), np.ones(len(found)), np.zeros(len(found))))
    assert "Entry number 3" in tagpath.main_text(neutral_page())


@pytest.mark.parametrize("page", [neutral_page(), '<nav>m, n</nav><article class="post b"><h1>T</h1><p>One, two. <a>l</a><p>Three!</article><footer>(c)</footer>', "text"])
def test_scores_by_plain_loops(page):
    found, _ = tagpath.blocks(page)
    by = defaultdict(list)
    for b in found:
        by[b.path].append(b)
    ratio, linked = {}, {}
    for path, some in by.items():
        chars = sum(len(b.text) for b in some)
        marks = sum(sum(c in ".,;:!?" for c in b.text) for b in some)
        linked[path] = sum(b.links for b in some) / chars
        ratio[path] = math.log2(1 + chars / len(some)) * (0.5 + math.log2(1 + marks / len(some))) * (1 - linked[path]) ** 2
    row = [ratio[b.path] for b in found]
    near = []
    for i in range(len(row)):
        total = weight = 0.0
        for d in range(-3, 4):
            w = math.exp(-d * d / 2)
            total += w * row[min(max(i + d, 0), len(row) - 1)]
            weight += w
        near.append(total / weight)
    want = [max(ratio[b.path], sum(n for n, x in zip(near, found) if x.path == b.path) / len(by[b.path]) * (1 - linked[b.path]) ** 2) for b in found]
    plain, weighted, links = tagpath.path_scores(found)
    assert np.allclose(plain, want) and np.allclose(links, [linked[b.path] for b in found])
    assert np.allclose(weighted, [w * tagpath.WEIGHTS[b.place] for w, b in zip(want, found)])


def token_f1(got, want):
    a, b = Counter(got.split()), Counter(want.split())
    return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values())) if a or b else 1.0


def test_given_pages_stripped_of_their_names(spark):
    """The given pages with every element a bare div: nearly what their own names give."""
    figures = []
    for r in spark.read.parquet(f"{SF0001.replace('0.001', '0.01')}/pages.parquet").select("html").collect():
        bare = re.sub(r'\s(class|id|role)="[^"]*"', "", re.sub(r"<(/?)(nav|article|footer|aside|header|main|section|form)\b[^>]*>", r"<\1div>", r["html"] or ""))
        figures.append(token_f1(tagpath.main_text(bare), tagpath.main_text(r["html"])))
    assert np.mean(figures) > 0.95
