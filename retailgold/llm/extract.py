"""Main text of web pages by consensus of their host.

Each page's containers are scored by the text of the blocks below them; a page votes for the generalised tag-class path
of its best container.  The votes are added up per host in Spark, and the pages are extracted again from the containers
on their host's winning path.  A page without such a container, or without a host, is extracted from its own best one.

Elements that are never content (menus, forms, scripts) are left out by what they are.  A word in a class or an id, such as
``sidebar``, only suggests it: an element that holds most of what the page says outside such elements is a wrapper and stays,
and the elements inside it are looked at in turn (``wrappers``).

Null and empty pages give an empty text.  Ties between paths go to the one that sorts first.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailgold.llm.frames import by_batch

# What elements mean.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article body div main section td".split())
DROP_TAG = frozenset(
    "aside button canvas datalist dialog footer form head header iframe input menu nav noscript object option script select style svg "
    "template textarea title video audio".split()
)
DROP_ROLE = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
DROP_WORD = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies responses "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
# A start tag of a name in the value's tags ends an open element of the key.
CLOSES = {
    "p": BLOCK - {"br"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
# An element that an implied end does not reach over.
FENCE = frozenset("ul ol dl table article section div main body html td th blockquote".split())

WRAPS = 20
LEAST_WRAPPED = 140
LEAST_ARTICLE = 200

_MARK = re.compile(
    r"<!--(?:.*?-->|[^>]*>?)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_DIGITS = re.compile(r"\d+")
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


@dataclass
class Node:
    tag: str
    label: str  # tag and generalised classes
    dropped: bool
    parent: Node | None
    path: str = ""
    score: float = 0.0
    link: bool = False
    named: bool = False  # a word in a class or id suggests that it is not content
    outright: bool = False  # a class or id is such a word


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0


def attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)} if "=" in rest else {}


def _node(tag: str, rest: str, parent: Node | None) -> Node:
    a = attributes(rest)
    classes = sorted({_DIGITS.sub("#", c.lower()) for c in a.get("class", "").split()})
    words = {w for v in (a.get("class", ""), a.get("id", "")) for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", v).lower())}
    dropped = bool(parent and parent.dropped) or tag in DROP_TAG or a.get("role", "").lower() in DROP_ROLE or "hidden" in rest.split()
    named = bool(words & DROP_WORD) and tag not in ("html", "body", "article", "main")
    outright = named and any(c.lower() in DROP_WORD for v in (a.get("class", ""), a.get("id", "")) for c in v.split())
    label = ".".join([tag, *classes])
    return Node(tag, label, dropped, parent, f"{parent.path}>{label}" if parent else label, link=tag == "a" or bool(parent and parent.link), named=named, outright=outright)


def _up(node: Node | None):
    while node:
        yield node
        node = node.parent


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in its order, each with the element it lies in; those that are dropped are left out."""
    top = Node("", "", False, None)
    node, out, now = top, [], None
    at, size = 0, len(page)

    def say(text: str):
        nonlocal now
        if node.dropped or not text:
            return
        if now is None:
            if text.isspace():
                return
            holder = node
            while holder.parent and holder.tag not in BLOCK:
                holder = holder.parent
            now = Block(holder)
            out.append(now)
        now.parts.append(text)
        if node.link:
            now.linked += len(text)

    for mark in iter(lambda: _MARK.search(page, at), None):
        say(page[at : mark.start()])
        at = mark.end()
        if not mark["name"]:
            continue
        tag = mark["name"].lower()
        if tag in BLOCK:
            now = None
        if mark["end"]:
            here = next((n for n in _up(node) if n.tag == tag), None)
            if here is not None:
                node = here.parent
            continue
        for n in _up(node):
            if tag in CLOSES.get(n.tag, ()):
                node = n.parent
                break
            if n.tag in FENCE:
                break
        if tag in VOID:
            continue
        child = _node(tag, mark["rest"], node if node is not top else None)
        child.parent = node
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else size
            if close and (end := page.find(">", at)) >= 0:
                at = end + 1
            continue
        node = child
    say(page[at:])
    return unnamed(out)


def unnamed(found: list[Block]) -> list[Block]:
    """The blocks that lie in no named element but wrappers."""
    inside = [[n for n in _up(b.node) if n.named][::-1] for b in found]  # from the outermost on
    if not any(inside):
        return found
    kept = wrappers(found, inside)
    return [b for b, named in zip(found, inside) if all(id(n) in kept for n in named)]


def wrappers(found: list[Block], inside: list[list[Node]]) -> set[int]:
    """Named elements that are content all the same.

    Of the page, and then of each wrapper, what it says itself is compared with the named element in it that says most, links
    aside.  If that is long enough and mostly not links, it is a wrapper where there is no article outside it (less than
    ``LEAST_ARTICLE`` characters), or, unless its class is such a word outright, where it says ``WRAPS`` times as much.  So
    comments that are longer than the article still go.
    """
    kept: set[int] = set()
    level = list(range(len(found)))
    depth = 0
    while True:
        own, each = 0, {}
        for i in level:
            plain = max(0, sum(map(len, found[i].parts)) - found[i].linked)
            if len(inside[i]) <= depth:
                own += plain
            else:
                entry = each.setdefault(id(inside[i][depth]), [0, 0])
                entry[0] += plain
                entry[1] += found[i].linked
        if not each:
            return kept
        most = max(each, key=lambda k: each[k][0])
        plain, linked = each[most]
        node = next(inside[i][depth] for i in level if len(inside[i]) > depth and id(inside[i][depth]) == most)
        alone = own < LEAST_ARTICLE or (plain >= WRAPS * own and not node.outright)
        if plain < LEAST_WRAPPED or 2 * linked > plain or not alone:
            return kept
        kept.add(most)
        level = [i for i in level if len(inside[i]) > depth and id(inside[i][depth]) == most]
        depth += 1


def block_text(block: Block) -> str:
    return " ".join(html.unescape("".join(block.parts)).split())


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else None


def best_path(found: list[Block]) -> str | None:
    """The path of the container with the highest score.

    A block's unlinked characters count in full for its nearest container and half for each container further out.
    """
    scores: dict[int, list] = {}
    for b in found:
        weight = float(max(0, len("".join(b.parts).strip()) - 2 * b.linked))
        for n in _up(b.node):
            if n.tag in CONTAINER:
                entry = scores.setdefault(id(n), [n, 0.0])
                entry[1] += weight
                weight /= 2
    if not scores:
        return None
    best = max(s for _, s in scores.values())
    return min(n.path for n, s in scores.values() if s == best)


def main_text(found: list[Block], path: str | None) -> str:
    """The blocks below the containers on a path, or below the page's own best one, joined by line feeds."""
    if path is not None:
        below = [b for b in found if any(n.path == path for n in _up(b.node))]
        if below:
            return "\n".join(t for t in map(block_text, below) if t)
    own = best_path(found)
    # a page without any container is all blocks that were not dropped
    return "\n".join(t for t in (block_text(b) for b in found if own is None or any(n.path == own for n in _up(b.node))) if t)


def votes(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, path): the winning path of each host."""

    def make():
        def work(urls, pages):
            cast = [(h, p) for u, x in zip(urls, pages) if (h := host_of(u)) and (p := best_path(blocks(x or "")))]
            return [[h for h, _ in cast], [p for _, p in cast]]

        return work

    cast = by_batch(pages.select(url, page), make, "host string, path string", text=1)
    counted = cast.groupBy("host", "path").agg(F.count("*").alias("n"))
    # the most votes; of equal ones the path that sorts first
    best = counted.groupBy("host").agg(F.max("n").alias("n"))
    return counted.join(best, ["host", "n"]).groupBy("host").agg(F.min("path").alias("path"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    winners = votes(pages, url, page)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("page"), host.alias("host"))
    rows = rows.join(winners, "host", "left").select("key", "url", "page", "path")

    def make():
        def work(keys, urls, pages, paths):
            texts = [main_text(blocks(p or ""), path) for p, path in zip(pages, paths)]
            return keys, urls, texts, [len(t) for t in texts]

        return work

    kind = pages.schema[key].dataType.simpleString()
    return by_batch(rows, make, f"`{key}` {kind}, url string, text string, n_chars bigint", text=2)
