"""Operator 8: main text of web pages by composite text density.

A page is parsed into a tree (implied end tags, unclosed and misnested tags as browsers
recover them; an unfinished tag, comment or script at the end is dropped). Elements that
never hold article text are cut off: scripts, styles, forms, menus, asides, footers,
headers outside an article, hidden elements, and elements whose class, id or role names
such a part (adverts, notices, sidebars, reader comments, ...; not ``with-sidebar`` and the
like). If that leaves no ``article`` or ``main`` with text besides its titles, an element so
named stays that holds one, or more than half of the characters (links and reader comments
aside) of the page, or of the article it is in; the named elements inside it are tested alike.

Every node gets its composite density: characters per tag, scaled by how few of the
characters and tags are links, with the page's own share of link characters in the
logarithm's base. The subtree with the largest sum of its children's densities is the
article; the smallest density on the path from there to the body is the threshold, and
the choice climbs to a parent while all that joins reaches the threshold, or to an
enclosing ``article`` or ``main`` element.

The text keeps everything in that subtree: character references decoded, white space
inside a block turned into one space, blocks in page order joined by a blank line. A
null, empty or text-free page gives an empty text; ties go to the earlier node.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from civic_indicators.llm.common import q

_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+|\d+")
_BESIDE = re.compile(r"(?<![^\s_-])(?:has|with|no|without)[-_]\S*")  # says what an element goes with, not what it is
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template"))
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
                    "tfoot thead tr ul").split())
_CLOSES_P = _BLOCK - {"html", "body", "caption", "tbody", "tfoot", "thead", "tr", "legend"}
_CUT = frozenset(("head script style noscript template iframe object embed svg math canvas audio video form button select textarea "
                  "fieldset nav footer aside dialog menu title noembed noframes xmp").split())
_WHOLE = frozenset(("html", "body", "article", "main", "h1"))
# Words in a class, id or role that name a part outside the article.
_PARTS = frozenset(("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                    "notice notices alert popup modal overlay newsletter subscribe subscription signup menu nav navbar navigation "
                    "breadcrumb breadcrumbs sidebar aside widget related recommended share sharing social comment comments "
                    "disqus reply replies discussion footer header masthead pagination pager toolbar login search complementary contentinfo "
                    "disclaimer copyright").split())
_TITLES = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
_TALK = frozenset("comment comments disqus reply replies discussion".split())
# Implied ends: a start tag of the key closes an open element of the set, up to the barrier.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
            "tfoot": ({"tbody", "thead", "tfoot", "tr"}, {"table"}), "option": ({"option"}, {"select"})}
_SCOPE = frozenset(("table", "td", "th", "caption", "button", "object", "html"))


class Node:
    __slots__ = ("tag", "up", "cut", "parts", "chars", "links", "tags", "link_tags", "kids", "density", "total", "in_link", "in_article", "named")

    def __init__(self, tag: str, up: "Node | None", cut: bool):
        self.tag, self.up, self.cut = tag, up, cut
        self.named: set = set()  # words of its class, id and role that name a part outside the article
        self.parts: list = []  # text and child nodes, in order
        self.in_link = tag == "a" or (up is not None and up.in_link)
        self.in_article = tag == "article" or (up is not None and up.in_article)


def _is_cut(tag: str, attrs: str, up: Node) -> tuple[bool, set]:
    """Whether an element is cut for what it is; else the words by which it is named as a part to cut."""
    named: set = set()
    if up.cut or tag in _CUT or (tag == "header" and not up.in_article):
        return True, named
    if not attrs.strip():
        return False, named
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, named
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, named
        if name in ("class", "id", "role") and tag not in _WHOLE:
            own = _NAME.findall(_BESIDE.sub(" ", html.unescape(value)))
            if _PARTS.intersection(own) and not (tag == "header" or ("header" in own and up.in_article and not _PARTS.difference({"header"}).intersection(own))):
                named |= _PARTS.intersection(own)
    return False, named


def _settle(root: Node) -> None:
    """Cut the elements named as parts, but none that holds the article."""
    nodes = _order(root)
    marked = {n for n in nodes if n.named}
    if not marked:
        return
    heads = {up for n in nodes if n.tag in ("main", "h1") for up in _line(n)}

    def sizes(skip: set) -> dict:
        """Characters outside links, below each node, without those of the nodes to skip."""
        out: dict = {}
        for n in reversed(nodes):
            own = 0 if n.in_link else sum(len("".join(html.unescape(t).split())) for t in n.parts if isinstance(t, str))
            out[n] = 0 if n in skip else own + sum(out[k] for k in n.kids)
        return out

    size = sizes({n for n in marked if n.named <= _TALK and n not in heads})
    if not size[root]:
        size = sizes(set())
    wholes = [n for n in nodes if n.tag in ("article", "main") and size[n]]
    titles = {n for n in nodes if n.tag in _TITLES}
    while marked:
        top = _outermost(nodes, marked)
        own = [w for w in wholes if top[w] is None]
        if own:
            bare = sizes(marked | titles)
            if any(bare[w] for w in own):
                break
        keep = set() if own else {top[w] for w in wholes}
        for n in marked:
            if top[n] is not n:
                continue
            line = set(_line(n))
            around = [w for w in own if w in line] if own else [root]
            if any(2 * size[n] > size[w] for w in around):
                keep.add(n)
        if not keep:
            break
        marked -= keep
    for n in marked:
        n.cut = True


def _outermost(nodes: list[Node], marked: set) -> dict:
    """For each node the outermost marked one among itself and those above it, else None; parents come first."""
    top: dict = {}
    for n in nodes:
        top[n] = top.get(n.up) or (n if n in marked else None)
    return top


def _line(n: Node | None):
    """A node and all above it."""
    while n is not None:
        yield n
        n = n.up


def parse(page: str) -> Node:
    root = Node("#root", None, False)
    at = root
    pos, end = 0, len(page)
    scan = _TOKEN.search
    while pos < end:
        m = scan(page, pos)
        if m is None:
            tail = page[pos:]
            cut = re.search(r"<(?=[a-zA-Z/!?])", tail)  # an unfinished tag
            tail = tail[:cut.start()] if cut else tail
            if tail and not at.cut:
                at.parts.append(tail)
            break
        s = m.start()
        if s > pos and not at.cut:
            at.parts.append(page[pos:s])
        pos = m.end()
        if m.group(2) is None:
            if m.group(0) == "<!--":
                stop = page.find("-->", s + 2)
                pos = end if stop < 0 else stop + 3
            continue
        tag = m.group(2).lower()
        if m.group(1):  # end tag
            n = at
            while n is not root and n.tag != tag:
                if tag not in _BLOCK and tag not in ("td", "th") and (n.tag in _BLOCK or n.tag in ("td", "th")):
                    n = root  # an inline end tag does not close a block
                    break
                n = n.up
            if n is not root and tag not in ("html", "body"):
                at = n.up
            continue
        if tag in ("html", "body") and any(True for _ in _above(at, tag)):
            continue
        if tag in _CLOSES_P or tag in _IMPLIED:
            n = at
            while n is not root and n.tag not in _SCOPE:
                if n.tag == "p":
                    at = n.up
                    break
                n = n.up
        if tag in _IMPLIED:
            shut, barrier = _IMPLIED[tag]
            n, last = at, None
            while n is not root and n.tag not in barrier:
                if n.tag in shut:
                    last = n
                n = n.up
            if last is not None:
                at = last.up
        if at.tag == "head" and tag == "body":
            at = at.up
        cut, named = _is_cut(tag, m.group(3), at)
        node = Node(tag, at, cut)
        node.named = named
        at.parts.append(node)
        if tag in _RAW:
            stop = _RAW_END[tag].search(page, pos)
            pos = stop.end() if stop else end
        elif tag not in _VOID and not (m.group(3).endswith("/") and tag not in _BLOCK):
            at = node
    return root


def _above(n: Node | None, tag: str):
    while n is not None:
        if n.tag == tag:
            yield n
        n = n.up


def _order(root: Node) -> list[Node]:
    """All nodes that are not cut, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        n.kids = [k for k in n.parts if isinstance(k, Node) and not k.cut]
        out.append(n)
        todo.extend(reversed(n.kids))
    return out


def _measure(root: Node) -> list[Node]:
    nodes = _order(root)
    for n in reversed(nodes):
        n.chars = sum(len("".join(html.unescape(t).split())) for t in n.parts if isinstance(t, str)) + sum(k.chars for k in n.kids)
        n.links = n.chars if n.tag == "a" else sum(k.links for k in n.kids)
        n.tags = sum(k.tags + 1 for k in n.kids)
        n.link_tags = sum(k.link_tags + (k.tag == "a") for k in n.kids)
    page = root.links / root.chars if root.chars else 0.0
    for n in nodes:
        if not n.chars:
            n.density = 0.0
            continue
        rest = max(n.chars - n.links, 1)
        base = math.log(n.chars / rest * n.links + page * n.chars + math.e)
        scale = math.log(n.chars / max(n.links, 1) * max(n.tags, 1) / max(n.link_tags, 1)) / max(math.log(base), 1.0) if base > 1 else 1.0
        n.density = n.chars / max(n.tags, 1) * max(scale, 0.0)
    for n in nodes:
        n.total = sum(k.density for k in n.kids)
    return nodes


def blocks(top: Node) -> list[str]:
    """The texts of the blocks below a node, in page order."""
    out: list[str] = []
    now: list[str] = []

    def flush() -> None:
        s = " ".join(html.unescape("".join(now)).split())
        if s:
            out.append(s)
        now.clear()

    todo: list = [top]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            now.append(x)
        elif not x.cut:
            block = x.tag in _BLOCK
            if block:
                flush()
                todo.append(None)
            elif x.tag in ("br", "td", "th", "img"):
                now.append(" ")
            todo.extend(reversed(x.parts))
    flush()
    return out


def main_text(page: str | None) -> str:
    root = parse(page or "")
    _settle(root)
    nodes = _measure(root)
    body = next((n for n in nodes if n.tag == "body"), root)
    inside = [n for n in nodes if n.chars]
    if not inside:
        return ""
    best = max(inside, key=lambda n: (n.total or n.density * 1e-9))
    threshold, n = best.density, best
    while n is not None and n is not body:
        n = n.up
        if n is not None:
            threshold = min(threshold, n.density)
    article = [n for t in ("article", "main") for n in _above(best, t)]
    if article:
        best = article[-1] if article[-1].tag == "article" else article[0]
    else:
        while best is not body and best.up is not None and best.up is not body and all(k.density >= threshold for k in best.up.kids if k.chars):
            best = best.up
        if best.up is not None and best.tag not in _BLOCK:
            best = best.up
    return "\n\n".join(blocks(best))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    def run(batches):
        for b in batches:
            for i in range(0, len(b), 200):
                part = b.slice(i, 200)
                t = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.record_batch({"page_id": part.column(0), "url": part.column(1), "text": pa.array(t, pa.string()),
                                       "n_chars": pa.array(list(map(len, t)), pa.int64())})

    return pages.select(q(page_id).cast("bigint"), q(url).cast("string"), q(page)).mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
