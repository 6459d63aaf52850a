"""Main text of web pages by composite text density.

A page becomes a tree of elements. Parts that are never article text (scripts, styles, forms, menus, headers and
footers of the page, and hidden elements) are left out with all below them. For every node that is left, the density
is its characters per tag, adjusted for links:

    C / T * log(C / Cn * Cl + Cb' / Cb * C + e)-based(C / Cl * T / Tl)

with C characters, T tags, Cl and Tl those of links below the node, Cn characters outside links, and Cb and Cb' the
body's characters and link characters. A node's score is the sum of the densities of its block-level children; inline
mark-up is part of the block that holds it. The threshold is the least density on the path from the node of largest
score up to the body; every node at or above it gives the node of largest score in its subtree, itself included, and
the text is that of all nodes so given.

White space inside a block becomes one blank; blocks are trimmed and joined in page order by one line feed; a block
is what block-level tags enclose. Character references are decoded. Nothing else is dropped or capped.

A role, class or id may name a part that is not the article, but is only evidence. It must name such a part as a whole:
every word of `site-sidebar` does, not so `has-sidebar` or `related-work`. Elements so named are left out unless

- they hold `main`, or an `article` without such a name while none stands outside named parts (or, if the name has
  other meanings, the longest `article`);
- they hold more than half of the body's text outside links (for SURE names only if no `article` or `main` with text
  stands outside named parts);
- they lie in an `article` (or in `main`, if the page has no `article`), less than a third of their text is links, and
  the name is not a SURE one, or only an id;
- on pages without `article` and `main`, the name is none of SURE and PLACES, less than a third of their text is links,
  and they lie in a node given by density other than the body, or are a `section` in the body.

If no text is left otherwise, no names but SURE ones count. Headings, `html`, `body`, `main` and `article` are not left
out by name.

Null and empty pages give the empty text, and so do pages without text outside the parts that are left out. Markup that
is cut off or not closed is closed at its end. Pages of any length are read whole in time that grows with their
length. Repeated rows are treated alike; an empty table gives an empty result. Columns other than page_id, url and
html are not read.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shipping import ship

# Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul caption").split())
LEFT_OUT = frozenset(("script style noscript template iframe head title nav footer aside form button select "
                      "textarea input option svg canvas object embed menu dialog audio video noembed noframes "
                      "xmp math map").split())
CLOSED_BY = {  # an open element of this name ends when one of these begins
    "p": BLOCK - {"body", "html"}, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option"]), "thead": frozenset(["tbody", "tfoot"]), "tbody": frozenset(["tbody", "tfoot"]),
}
# Words in a role, class or id that name a part which is not the article: whatever it stands in,
SURE = frozenset((
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation "
    "menubar breadcrumb breadcrumbs toolbar cookie cookies consent gdpr popup modal overlay newsletter subscribe "
    "subscription signup login comment comments commentlist disqus respond replies share sharing recommended "
    "recommendations pagination pager").split())
# by its place on the page,
PLACES = frozenset("banner sidebar aside footer masthead topbar widget contentinfo complementary".split())
# or where the word is not a topic or a remark.
PART_NAMES = SURE | PLACES | frozenset((
    "menu notice notices alert reply social related copyright legal disclaimer skip search").split())
# Words that may stand in such a name without changing what it names.
COMPANIONS = frozenset((
    "site page main left right top bottom primary secondary global list box bar block container wrap wrapper inner "
    "section area link links item items group body title button buttons icons form thread post posts article articles "
    "story stories").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that are the article, or hold it, whatever else their names say.
HOLDERS = frozenset("html body main article".split())
MOST_LINKS = 1 / 3  # share of links in the text of a part that may yet belong to the article

_TAG = re.compile(r"<(?:!--(?P<note>.*?)(?:--!?>|\Z)|(?P<mark>[!?])[^>]*(?:>|\Z)"
                  r"|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                  r"|(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?P<shut>>|\Z)"
                  r"|(?P<broken>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_PARTS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_BLANKS = re.compile(r"\s+")


class Node:
    __slots__ = ("name", "parts", "chars", "tags", "link_chars", "link_tags", "density", "score", "out", "named",
                 "by_id", "holder")

    def __init__(self, name: str, out: bool):
        self.name, self.out = name, out
        self.parts: list = []  # texts and nodes, in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.score = 0.0
        self.named: frozenset = frozenset()  # words of its names that name a part which is not the article
        self.by_id = False  # whether it is so named by its id only
        self.holder = name if name in ("main", "article") else ""


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def _part_words(name: str) -> frozenset:
    """The words by which a role, class or id names a part as a whole; none if any other word stands in it."""
    words = _PARTS.findall(_CAMEL.sub(" ", name).lower())
    if all(word in PART_NAMES or word in COMPANIONS or word[0].isdigit() for word in words):
        return PART_NAMES.intersection(words)
    return frozenset()


def _describe(node: Node, rest: str, inside_article: bool) -> None:
    """Whether the node is left out, and what its attributes say of it."""
    if node.name in LEFT_OUT or node.name == "header" and not inside_article:  # an article's own holds its title
        node.out = True
    if node.out or not rest:
        return
    told = _attributes(rest)
    roles = told.get("role", "").lower().split()
    node.holder = next((role for role in roles if role in ("main", "article")), node.holder)
    if node.name not in HOLDERS and node.name != "header" and (
            told.get("hidden", "until-found").lower() != "until-found"
            or told.get("aria-hidden", "").strip().lower() == "true" or _NOT_SHOWN.search(told.get("style", ""))):
        node.out = True
    if node.name not in HEADINGS and node.name not in ("html", "body", "header"):
        named = frozenset().union(*map(_part_words, roles + told.get("class", "").split()))
        node.by_id = not named
        node.named = named or _part_words(told.get("id", ""))


def parse(html: str) -> Node:
    """The tree of a page. Parts that are left out are there as empty nodes."""
    root = Node("html", False)
    stack = [root]
    depth: dict[str, int] = {"html": 1}  # open elements by name
    dropped = 0  # depth in the stack at which a part that is left out began; 0: none
    at, end = 0, len(html)
    find = _TAG.search
    while at < end:
        found = find(html, at)
        if found is None:
            if not dropped:
                stack[-1].parts.append(html[at:])
            break
        if found.start() > at and not dropped:
            stack[-1].parts.append(html[at:found.start()])
        at = found.end()
        name = found["name"] or found["broken"]
        if name:
            name = name.lower()
            if name in ("html", "body", "head") and depth.get(name):
                continue
            while len(stack) > 1 and name in CLOSED_BY.get(stack[-1].name, ()):
                dropped = _pop(stack, depth, dropped)
            if name in BLOCK and depth.get("p") and name not in ("html", "body"):
                # A block also ends a paragraph that unclosed inline elements still hold open.
                level = len(stack) - 1
                while level and stack[level].name not in BLOCK:
                    level -= 1
                if stack[level].name == "p":
                    while len(stack) > level:
                        dropped = _pop(stack, depth, dropped)
            rest = found["rest"] or ""
            node = Node(name, bool(dropped))
            _describe(node, rest, bool(depth.get("article") or depth.get("main")))
            if not dropped:
                stack[-1].parts.append(node)
            if name in VOID or rest.endswith("/") and name not in BLOCK:
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else end
                continue
            stack.append(node)
            depth[name] = depth.get(name, 0) + 1
            if node.out and not dropped:
                dropped = len(stack)
        elif found["end"]:
            name = found["end"].lower()
            if depth.get(name) and name not in ("html", "body"):
                while True:
                    last = stack[-1].name
                    dropped = _pop(stack, depth, dropped)
                    if last == name:
                        break
            elif name == "p" and not dropped:
                stack[-1].parts.append(Node("p", False))
    return root


def _pop(stack: list[Node], depth: dict[str, int], dropped: int) -> int:
    depth[stack.pop().name] -= 1
    return 0 if dropped > len(stack) else dropped


def _in_order(root: Node) -> list[Node]:
    """All nodes that are kept, parents before children, without recursion."""
    nodes, at = [root], 0
    while at < len(nodes):
        nodes += [part for part in nodes[at].parts if type(part) is Node and not part.out]
        at += 1
    return nodes


def _count(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for part in node.parts:
            if type(part) is str:
                node.chars += len("".join(part.split()))
            elif not part.out:
                node.chars += part.chars
                node.tags += part.tags + 1
                link = part.name == "a"
                node.link_chars += part.chars if link else part.link_chars
                node.link_tags += part.tags + 1 if link else part.link_tags
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.tags


def _measure(nodes: list[Node], body: Node) -> None:
    _count(nodes)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        chars, tags = node.chars, max(1, node.tags)
        if chars:
            links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
            outside = max(1, chars - node.link_chars)
            base = log(chars / outside * node.link_chars + share * chars + e)
            node.density = max(0.0, chars / tags * log(chars / links * tags / link_tags) / log(base)
                               if base > 1.0000001 else chars / tags * log(max(1.0, chars / links * tags / link_tags)))
    for node in nodes:
        node.score = sum([part.density for part in node.parts
                          if type(part) is Node and not part.out and part.name in BLOCK])


def _parents(nodes: list[Node]) -> dict[int, Node]:
    return {id(part): node for node in nodes for part in node.parts if type(part) is Node and not part.out}


def _own(node: Node) -> int:
    return node.chars - node.link_chars


def _few_links(node: Node) -> bool:
    return node.chars > 0 and node.link_chars < MOST_LINKS * node.chars


def _above(nodes: list[Node], parent: dict[int, Node]) -> list[Node]:
    found, seen = [], set()
    for node in nodes:
        while id(node) in parent and id(parent[id(node)]) not in seen:
            node = parent[id(node)]
            seen.add(id(node))
            found.append(node)
    return found


def _leave_out_named(body: Node) -> tuple[list[Node], list[Node], dict[int, Node]]:
    """Leaves out the named parts for which nothing speaks. Gives those which may yet turn out to lie in the article,
    and all nodes as they were, parents first, with their parents."""
    nodes = _in_order(body)
    if not any(node.named for node in nodes):
        return [], [], {}
    _count(nodes)
    parent = _parents(nodes)
    inside = {}  # per node, whether it is or lies in a named part, in `article`, in `main`
    for node in nodes:
        above = inside[id(parent[id(node)])] if node is not body else (False, False, False)
        inside[id(node)] = (above[0] or bool(node.named), above[1] or node.holder == "article",
                            above[2] or node.holder == "main")
    holders = [node for node in nodes if node.holder and node.chars]
    articles = [node for node in holders if node.holder == "article" and not node.named]
    free = any(not inside[id(node)][0] for node in holders)
    free_article = any(not inside[id(node)][0] for node in articles)
    longest = max(articles, key=_own, default=None)
    # The nodes above `main` or the only articles there are, and those above the longest article.
    speaking = [node for node in holders if node.holder == "main"] + ([] if free_article else articles)
    above_holder = {id(up) for up in _above(speaking, parent)}
    above_longest = {id(up) for up in _above([longest] if longest else [], parent)}
    out, pending = [], []
    for node in nodes:
        if not node.named or node.holder or node is body:
            continue
        sure = not SURE.isdisjoint(node.named)
        _, in_article, in_main = inside[id(node)]
        if (id(node) in above_holder or not sure and id(node) in above_longest
                or 2 * _own(node) > _own(body) and not (sure and free)
                or (in_article or in_main and not articles) and _few_links(node) and (not sure or node.by_id)):
            continue
        out.append(node)
        if not holders and not sure and PLACES.isdisjoint(node.named) and _few_links(node):
            pending.append(node)
    for node in out:
        node.out = True
    _count(_in_order(body))
    if not body.chars:
        for node in out:
            node.out = not SURE.isdisjoint(node.named)
    return pending, nodes, parent


def main_nodes(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order; none lies within another."""
    body = next((part for part in root.parts if type(part) is Node and part.name == "body"), root)
    undecided, before, parent_before = _leave_out_named(body)
    nodes = _in_order(body)
    _measure(nodes, body)
    if not body.chars:
        return []
    parent = _parents(nodes)
    best = max(nodes, key=lambda node: node.score)  # of equal scores the one nearest the body
    threshold, up = best.density, best
    while up is not body:
        up = parent[id(up)]
        threshold = min(threshold, up.density)
    # The node of largest score in every subtree, found from the leaves up.
    top = {}
    for node in reversed(nodes):
        chosen = node
        for part in node.parts:
            if type(part) is Node and not part.out and top[id(part)].score > chosen.score:
                chosen = top[id(part)]
        top[id(node)] = chosen
    marked = {id(top[id(node)]) for node in nodes if node.density >= threshold and node.chars}
    found, pending = [], [body]
    while pending:
        node = pending.pop()
        if id(node) in marked:
            found.append(node)
        else:
            pending += [part for part in reversed(node.parts) if type(part) is Node and not part.out]
    if undecided:
        # What lies below a node that is given, told on from parent to child.
        given, below = {id(node) for node in found}, set()
        for node in before:
            up = parent_before.get(id(node), body)
            if up is not body and (id(up) in given or id(up) in below):
                below.add(id(node))
        for node in undecided:
            if id(node) in below or id(body) in given and node.name == "section":
                node.out = False
    return found


def text_of_nodes(nodes: list[Node]) -> str:
    blocks, run = [], []

    def flush():
        text = _BLANKS.sub(" ", unescape("".join(run))).strip()
        if text:
            blocks.append(text)
        run.clear()

    for top in nodes:
        pending: list = [top]
        while pending:
            part = pending.pop()
            if part is None:
                flush()
            elif type(part) is str:
                run.append(part)
            elif part.out:
                if part.name in BLOCK:
                    flush()
            elif part.name == "br":
                run.append(" ")
            elif part.name in BLOCK:
                flush()
                pending.append(None)
                pending += reversed(part.parts)
            else:
                pending += reversed(part.parts)
        flush()
    return "\n".join(blocks)


def main_text(html: str | None) -> str:
    return text_of_nodes(main_nodes(parse(html))) if html else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points)."""
    ship(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = rows.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches):
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(text) for text in texts], pa.int64())})

    return rows.mapInArrow(run, kinds)
