"""Main text of web pages by tag-path ratios.

A page becomes a list of text blocks, each with its path of tags and class names from the root. Per path the
characters and punctuation marks are added up and divided by its blocks; the two ratios are fused into one score, which
link text lowers, and the scores are smoothed over neighbouring blocks in page order. Paths that reach a share of the
page's mean score are content, and their characters times their scores are the mass of the nodes above them. From the
root the page's content node is found: the way goes down into a container as long as that one holds nearly all the mass.
Below that node every block stays, however short, except subtrees that their own ratios show to be something else: paths
of link text, and containers whose score is far below the node's.

What tags, classes, ids and roles say (nav, comments, article ...) is a weight on the scores: a page of bare ``div``s with
unknown names is extracted by its ratios alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.common import ship

#: A path is content from this share of the mean score of the page's characters.
THRESHOLD = 0.25
#: Width (blocks) of the Gaussian that smooths scores.
SIGMA = 1.0
#: A container that holds this share of the mass is where the content is.
DOMINANT = 0.9
#: Below the content node, a container without this share of its score leaves, and a path with this share of link text.
FAR_BELOW = 0.3
LINKED = 0.8
#: Weights of what names say about a block's place, and the weighted score below which no path is content.
WEIGHTS = {"other": 0.005, "named": 0.01, "back": 0.25, "": 1.0, "head": 1.0, "main": 1.5, "article": 2.0}
LEAST_SCORE = 0.4
#: Elements that may hold a page's content as a whole. Others (a quotation, a list) are parts of it, however long.
CONTAINERS = frozenset("html body div section article main center td aside form fieldset dialog header footer nav details".split())

BLOCK_TAGS = frozenset(
    "html body article main section div header footer nav aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody "
    "tfoot tr td th blockquote pre figure figcaption details summary address center menu dialog hgroup search noscript template head button "
    "select option optgroup label legend".split())
VOID_TAGS = frozenset("br hr img input meta link area base col embed source track wbr param".split())
#: Elements that are not shown.
UNSEEN_TAGS = frozenset("head noscript template option".split())
#: Elements that seldom hold content.
OTHER_TAGS = frozenset("nav aside footer form fieldset menu dialog button select label legend search".split())
#: Words of class, id and role that name something else than content.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall nav navbar navigation menu breadcrumb "
    "breadcrumbs pagination pager sidebar side rail aside complementary widget widgets related recommended recommendations trending share sharing "
    "social comment comments commentlist disqus respond reply replies discussion footer foot contentinfo header masthead topbar toolbar search "
    "skip hidden copyright disclaimer".split())
ARTICLE_TAGS = frozenset(["article", "main"])
#: Words that name the content itself. In one name with a word of HEADS (entry-header) they name its title.
ARTICLE_WORDS = frozenset("article articlebody post postbody entry maincontent".split())
HEADS = frozenset(["header", "masthead"])
#: Words that make a name tell how a page is laid out (has-sidebar, search-off), not what an element holds.
LAYOUT_WORDS = frozenset(
    "has no not with without off on enabled disabled open opened closed collapsed expanded layout overflow template supports".split())
#: An open element of the value is closed by the start of the key.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe|xmp|noembed|noframes|svg|math|object|audio|video|canvas)\b(?:=\s*\"[^\"]*+\"|=\s*'[^']*+'|[^>])*+>"
    r".*?(?:</(?P=raw)\s*[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attributes>(?:=\s*\"[^\"]*+\"|=\s*'[^']*+'|[^>])*+)(?:>|\Z)", re.I | re.S)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")


def _kind(name: str, attributes: str, in_article: bool) -> str:
    """"unseen", "other" (by its tag), "named" (named as other than content), "article", "head" (an article's title) or "" for an element."""
    if name in UNSEEN_TAGS:
        return "unseen"
    if name in OTHER_TAGS:
        return "other"
    article = head = other = False
    for key, *values in _NAMED.findall(attributes) if attributes else ():
        value = "".join(values).lower()
        if key.lower() in ("class", "id", "role", "itemprop"):
            for token in value.split():
                words = set(_WORD.findall(token))
                if words & LAYOUT_WORDS:
                    continue
                if words & ARTICLE_WORDS and words & HEADS and words & OTHER_WORDS <= HEADS:
                    head = True
                elif words & OTHER_WORDS:
                    other = True
                elif words & ARTICLE_WORDS:
                    article = True
        elif key.lower() == "hidden" or key.lower() == "aria-hidden" and value == "true" or "display:none" in value.replace(" ", ""):
            return "unseen"
    if name in ("html", "body"):
        return ""
    if name in ARTICLE_TAGS:
        return "article"
    if other:
        return "named"
    if head:
        return "head"
    if name == "header" and not in_article:
        return "other"
    return "article" if article else ""


def _place(outer: str, name: str, kind: str) -> str:
    """Where the text of an element stands, from where the element around it stands: "main" and "article" are inside
    an article, "back" is inside an article below "named", "head" is a title outside of them; see WEIGHTS."""
    if outer == "unseen" or kind == "unseen":
        return "unseen"
    if outer == "other" or kind == "other":
        return "other"
    if kind == "article":
        return "back" if outer in ("named", "back") else "article" if outer == "article" or name != "main" else "main"
    if kind == "named":
        return "other" if outer in ("article", "back") else "named"
    return outer or kind


@dataclass
class Block:
    path: str  # tags with their classes, and the place
    nodes: tuple[int, ...]  # elements from the root on
    place: str
    text: str
    links: int  # characters of link text


def blocks(page: str) -> tuple[list[Block], list[str]]:
    """The text blocks of a page in order, and the tag of every element."""
    out, tags, parts, links, in_link, at = [], [], [], 0, False, 0
    stack: list[tuple[str, str, str, int]] = []  # tag, tag with classes, place, element

    def text(piece: str) -> None:
        nonlocal links
        piece = html.unescape(piece)
        parts.append(piece)
        if in_link:
            links += len(piece.strip())

    def flush() -> None:
        nonlocal parts, links
        place = stack[-1][2] if stack else ""
        if parts and place != "unseen" and (whole := " ".join("".join(parts).split())):
            out.append(Block("/".join(x[1] for x in stack) + " " + place, tuple(x[3] for x in stack), place, whole, min(links, len(whole))))
        parts, links = [], 0

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            in_link = not m["end"]
        elif name == "br":
            parts.append("\n")
        elif name == "hr":
            flush()
        elif name in VOID_TAGS or name not in BLOCK_TAGS and not _marked(name, m["attributes"], stack):
            continue
        elif m["end"]:
            if any(x[0] == name for x in stack):
                flush()
                while stack.pop()[0] != name:
                    pass
        else:
            flush()
            closes = CLOSES.get(name, ())
            while stack and (stack[-1][0] == "p" or stack[-1][0] in closes):
                stack.pop()
            if not m["attributes"].endswith("/") or name in BLOCK_TAGS:
                outer = stack[-1][2] if stack else ""
                place = _place(outer, name, _kind(name, m["attributes"], outer in ("main", "article", "back")))
                classes = "".join(sorted("." + c for k, *v in _NAMED.findall(m["attributes"]) if k.lower() == "class" for c in "".join(v).lower().split()))
                stack.append((name, name + classes, place, len(tags)))
                tags.append(name)
    if at < len(page):
        text(page[at:])
    flush()
    return out, tags


def _marked(name: str, attributes: str, stack: list) -> bool:
    """An unknown or inline element that its attributes name as other than content, or the end of one."""
    return any(x[0] == name for x in stack) or bool(attributes) and _kind(name, attributes, False) in ("unseen", "other", "named")


def path_scores(found: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block its path's smoothed score, without and with the weight of its place, and its path's share of link text."""
    number = {p: i for i, p in enumerate(dict.fromkeys(b.path for b in found))}
    of = np.array([number[b.path] for b in found])
    length = np.array([len(b.text) for b in found], float)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in found], float)
    n, chars = np.bincount(of), np.bincount(of, length)
    linked = np.bincount(of, [b.links for b in found]) / chars
    fused = np.log2(1 + chars / n) * (0.5 + np.log2(1 + np.bincount(of, marks) / n)) * (1 - linked) ** 2
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    smooth = np.convolve(np.pad(fused[of], reach, mode="edge"), kernel / kernel.sum(), mode="valid")
    # A neighbour lifts a path, as a heading stands beside paragraphs, but lowers none.
    score = np.maximum(fused, np.bincount(of, smooth) / n * (1 - linked) ** 2)[of]
    return score, score * np.array([WEIGHTS[b.place] for b in found]), linked[of]


def content_node(found: list[Block], tags: list[str], mass: np.ndarray) -> int:
    """The element that holds the page's content (-1: the whole page)."""
    held: dict[int, float] = {-1: float(mass.sum())}
    below: dict[int, set[int]] = {}
    for b, m in zip(found, mass):
        for outer, node in zip((-1, *b.nodes), b.nodes):
            held[node] = held.get(node, 0.0) + m
            below.setdefault(outer, set()).add(node)
    places = {node: b.place for b in found for node in b.nodes[-1:]}
    node = -1
    while True:
        best = max((x for x in below.get(node, ()) if tags[x] in CONTAINERS or tags[x] not in BLOCK_TAGS), key=lambda x: (held[x], -x), default=None)
        if best is None or held[best] < DOMINANT * held[node] or not held[best]:
            return node
        if node >= 0 and places.get(node) in ("article", "back") and places.get(best, places[node]) == places[node]:
            return node  # an article that has text of its own is whole
        node = best


def main_text(page: str | None) -> str:
    """The blocks of the content node, in page order, with an empty line between."""
    found, tags = blocks(page) if page else ([], [])
    if not found:
        return ""
    length = np.array([len(b.text) for b in found], float)
    plain, score, linked = path_scores(found)
    mean = (score * length).sum() / length.sum()
    content = (score >= THRESHOLD * mean) & (score >= LEAST_SCORE)
    if not content.any():
        return ""
    mass = score * length * content
    node = content_node(found, tags, mass)
    inside = np.array([node < 0 or node in b.nodes for b in found])
    weight = np.array([WEIGHTS[b.place] for b in found])
    heaviest = weight[inside & content].max()
    own = (plain * length)[inside & content].sum() / length[inside & content].sum()

    # Containers below the node by their own ratios: score a character, against the node's.
    total: dict[int, list[float]] = {}
    for b, s, c, i in zip(found, plain, length, inside):
        for x in b.nodes[b.nodes.index(node) + 1 if node >= 0 else 0:] if i else ():
            if tags[x] in CONTAINERS or tags[x] not in BLOCK_TAGS:
                t = total.setdefault(x, [0.0, 0.0])
                t[0] += s * c
                t[1] += c
    poor = {x for x, (s, c) in total.items() if s < FAR_BELOW * own * c}

    def stays(i: int) -> bool:
        b = found[i]
        if b.place == "head":
            return True
        if not inside[i] or weight[i] < 0.2 * heaviest or linked[i] >= LINKED:
            return False
        return weight[i] > 1 or tags[b.nodes[-1]] in ("td", "th") or not poor.intersection(b.nodes) if b.nodes else True

    return "\n\n".join(b.text for i, b in enumerate(found) if stays(i))


@F.pandas_udf(T.StringType())
def extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in pages:
        yield pd.Series([main_text(p if isinstance(p, str) else None) for p in part], dtype=object)


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Defined cases: a null or empty page, and one without content (text in menus, forms or comments alone), has the empty text; an unclosed
    element ends with the page; repeated rows are extracted alike; a long page is read whole; an empty
    table gives no rows; other columns are ignored.
    """
    return (pages.select("page_id", "url", extract("html").alias("text"))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


def op6_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ship(__name__)
