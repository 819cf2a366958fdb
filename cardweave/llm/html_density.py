"""Main text of web pages by composite text density.

A page becomes a tree of elements. Parts that are never the article (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments)
are cut off. Every element that is left has a density, its characters per tag
adjusted for links, and a density sum, that of its children's densities. The
element with the largest sum is the centre; the least density on the path from
it up to the body is the threshold above which further elements are searched
for their own centres. Where the centre lies in no article or main, all other
blocks of the body stay as well, apart from those that are mostly links.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardweave.llm.store import shipped, slices

# Element kinds of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split())
#: Start tags that end an open paragraph.
_END_PARAGRAPH = _BLOCKS - frozenset("body caption dd dt html legend li optgroup option tbody td tfoot th thead tr".split())
#: Start tag -> open elements that it ends, and elements at which the search for them stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "option": ({"option"}, {"select"}),
}

#: Elements that are never part of the article.
_OUTSIDE = frozenset("nav footer aside form script style noscript template iframe object embed svg canvas select "
                     "button textarea title head dialog menu search".split())
_OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words that mark such parts in class and id names, and words that only say where or what kind of box they are.
_OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice alert popup modal newsletter "
    "subscribe signup login share sharing social related recommended comment comments disqus pagination pager "
    "toolbar widget skip adsbygoogle advertising".split())
_BOX_WORDS = frozenset(
    "site main top bottom left right primary secondary global header page bar box area list link links item items "
    "container wrap wrapper block section inner outer button buttons icons posts form unit slot title large small "
    "medium wide narrow mini".split())
_COMMENTS = frozenset("comment comments disqus".split())
# Words before such a word that make it tell how the page is laid out, not what the element is.
_LAYOUT_WORDS = frozenset("has have no not with without hide hides show shows is content article post entry".split())
# What a header may be called that is the page's and not the article's.
_PAGE_WORDS = frozenset("site page main global top app web mobile desktop sticky fixed primary secondary".split())
# The kinds of elements that are cut.
_FORM, _NAMED, _REMARKS, _CERTAIN = 1, 2, 3, 4

# Only a quote right after "=" opens a value; elsewhere it is an ordinary character.
_VALUE = r"\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)"
    rf"|<(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:{_VALUE})?+)?+)*+)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE})?+)?+")
_BLANKS = re.compile(r"\s+")


class Node:
    """An element; ``items`` are its texts and elements in page order."""

    __slots__ = ("tag", "attributes", "items", "parent", "chars", "tags", "link_chars", "link_tags", "density", "sum",
                 "best", "whole")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.items: list[str | Node] = []


class _Stack:
    """The open elements. Counts them by tag, so that only tags that are open are looked for."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.open: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.nodes.append(node)
        self.open[node.tag] += 1

    def cut(self, keep: int) -> None:
        for node in self.nodes[keep:]:
            self.open[node.tag] -= 1
        del self.nodes[keep:]

    def end(self, tags: set[str], bounds: set[str]) -> None:
        """Close the innermost open element of ``tags``, unless one of ``bounds`` is nearer."""
        if not any(self.open[t] for t in tags):
            return
        for k in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[k].tag in tags:
                return self.cut(k)
            if self.nodes[k].tag in bounds:
                return


def parse(page: str) -> Node:
    """The page as a tree, with the end tags that HTML lets a page leave out."""
    root = Node("html", "", None)
    stack, at = _Stack(root), 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            stack.nodes[-1].items.append(page[at:])
            break
        if found.start() > at:
            stack.nodes[-1].items.append(page[at:found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            # An inline end tag closes no block.
            stack.end({tag}, set() if tag in _BLOCKS else _BLOCKS - {tag})
            continue
        if tag == "html" or tag == "body" and stack.open["body"]:
            continue
        if tag in _END_PARAGRAPH:
            stack.end({"p"}, {"td", "th", "caption", "button", "object", "table"})
        if tag in _ENDS:
            stack.end(*_ENDS[tag])
        if tag == "body":
            stack.cut(1)
        node = Node(tag, found[3], stack.nodes[-1])
        stack.nodes[-1].items.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            stop = end.start() if end else len(page)
            node.items.append(page[at:stop])
            at = stop
            if end:
                close = page.find(">", end.end())
                at = len(page) if close < 0 else close + 1
        elif tag not in _VOID:
            stack.push(node)
    return root


def _names(value: str, in_article: bool) -> int:
    """The kind that class or id names tell.

    A name counts if all its parts are known words, or if the last one that is no word for a box is
    one of such a part (``reader-comments``, ``google-ad-slot``), unless a word before it tells of a
    layout (``has-sidebar``). ``header`` counts outside articles, if the words before it are the page's.
    """
    kind = 0
    for name in value.split():
        parts = [x.lower() for x in re.split("[-_]+|(?<=[a-z])(?=[A-Z])", name) if x]
        own = set(parts)
        if parts[-1:] == ["header"] and not in_article and own - {"header"} <= _PAGE_WORDS:
            kind = max(kind, _NAMED)
        whole = own & _OUTSIDE_WORDS and own <= _OUTSIDE_WORDS | _BOX_WORDS and own != {"skip"}
        while parts and parts[-1] in _BOX_WORDS:
            parts.pop()
        if whole or parts and parts[-1] in _OUTSIDE_WORDS and not _LAYOUT_WORDS & set(parts[:-1]) and own != {"skip"}:
            kind = max(kind, _REMARKS if own & _COMMENTS else _NAMED)
    return kind


def _kind(node: Node, in_article: bool) -> int:
    """How an element shows that it is not part of the article, or 0. An article has a header of its own."""
    if node.tag in _OUTSIDE and node.tag != "form" or node.tag == "header" and not in_article:
        return _CERTAIN
    kind = _FORM if node.tag == "form" else 0
    if not node.attributes.strip() or node.tag in ("body", "article", "main"):
        return kind
    for name, value in _ATTRIBUTE.findall(node.attributes):
        if value[:1] in ("'", '"'):
            value = value[1:].removesuffix(value[0])
        name, given = name.lower(), html.unescape(value)
        value = given.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _CERTAIN
        if name == "role" and _OUTSIDE_ROLES & set(value.split()):
            kind = max(kind, _NAMED)
        elif name in ("class", "id"):
            kind = max(kind, _names(given, in_article))
    return kind


def _prune(root: Node) -> list[Node]:
    """Cut off what is never part of the article; the elements left, parents first.

    Names, roles and forms are no reason to cut an element that holds a main or the
    longest article, nor, where the page has neither, one with half of the body's
    text outside links; its children are judged instead. For a form half of the text
    is always enough. Comments are often longer than the article, so for them only
    a main or an article counts, and they are not part of the body's text.
    """
    seen, todo = [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        kind = _kind(node, inside)
        seen.append((node, kind))
        if kind != _CERTAIN:
            inside = inside or node.tag in ("article", "main")
            todo += [(x, inside) for x in reversed(node.items) if not isinstance(x, str)]
    # For each element: text outside links, the longest article inside, whether a main is inside.
    plain: dict[int, int] = {}
    longest: dict[int, int] = {}
    mains: dict[int, bool] = {}
    for node, kind in reversed(seen):
        inner = [id(x) for x in node.items if not isinstance(x, str)] if kind != _CERTAIN else []
        size = sum(plain[x] for x in inner)
        if kind != _CERTAIN and node.tag != "a":
            size += sum(len(x.strip()) for x in node.items if isinstance(x, str))
        most = max((longest[x] for x in inner), default=0)
        if node.tag == "article" and "comment" not in node.attributes.lower():
            most = max(most, size)
        mains[id(node)] = kind != _CERTAIN and (node.tag == "main" or any(mains[x] for x in inner))
        longest[id(node)] = most
        remark = kind == _REMARKS and not most and not mains[id(node)]
        plain[id(node)] = 0 if kind == _CERTAIN or node.tag == "a" or remark else size
    kinds = {id(node): kind for node, kind in seen}
    total, article = plain[id(root)], longest[id(root)]
    by_size = {_FORM} if article or mains[id(root)] else {_FORM, _NAMED}

    def stays(node: Node) -> bool:
        key = id(node)
        return not kinds[key] or kinds[key] != _CERTAIN and (
            mains[key] or 0 < article == longest[key] or kinds[key] in by_size and 2 * plain[key] >= max(1, total))

    order, left = [], [root]
    while left:
        node = left.pop()
        order.append(node)
        node.items = [x for x in node.items if isinstance(x, str) or stays(x)]
        left += [x for x in reversed(node.items) if not isinstance(x, str)]
    return order


def _measure(order: list[Node], body: Node) -> None:
    """Characters, tags and link shares from the leaves up, then densities and their sums."""
    for node in reversed(order):
        texts = [x for x in node.items if isinstance(x, str)]
        inner = [x for x in node.items if not isinstance(x, str)]
        node.chars = sum(len(_BLANKS.sub(" ", html.unescape(x)).strip()) for x in texts) + sum(x.chars for x in inner)
        node.tags = sum(1 + x.tags for x in inner)
        node.link_tags = sum((x.tag == "a") + x.link_tags for x in inner)
        node.link_chars = node.chars if node.tag == "a" else sum(x.link_chars for x in inner)
    linked = body.link_chars / max(1, body.chars)
    for node in order:
        chars, plain = max(1, node.chars), max(1, node.chars - node.link_chars)
        links, tags, link_tags = max(1, node.link_chars), max(1, node.tags), max(1, node.link_tags)
        scale = math.log(chars / plain * links + linked * chars + math.e)
        ratio = math.log(max(math.e, chars / links * tags / link_tags)) / scale
        node.density = node.chars / tags * ratio
    for node in order:
        inner = [x for x in node.items if not isinstance(x, str)]
        # Text that stands in an element itself counts as a child without tags.
        own = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        node.sum = sum(x.density for x in inner) + own


def _choose(order: list[Node], body: Node) -> set[int]:
    """Ids of the elements whose whole subtrees are the article."""
    for node in order:  # what the page itself calls its article is taken whole
        above = node.parent.whole if node.parent is not None else None
        node.whole = above or (node if node.tag in ("article", "main") else None)
    for node in reversed(order):  # of equal sums the outermost, then the first
        node.best = max([node, *(x.best for x in node.items if not isinstance(x, str))], key=lambda n: n.sum)
    centre = up = body.best
    threshold = min(centre.density, body.density)
    while up is not None and up is not body:
        threshold, up = min(threshold, up.density), up.parent
    chosen, todo = set(), [body]
    while todo:
        node = todo.pop()
        if node.density >= threshold:
            chosen.add(id(node.best.whole or node.best))
            todo += [x for x in node.items if not isinstance(x, str)]
    return chosen if centre.whole else _beside(order, body, chosen)


def _poor(items: list[str | Node]) -> bool:
    """Whether at most half of the text is links."""
    chars = sum(len(x.strip()) if isinstance(x, str) else x.chars for x in items)
    return 2 * sum(x.link_chars for x in items if not isinstance(x, str)) <= chars


def _beside(order: list[Node], body: Node, chosen: set[int]) -> set[int]:
    """Where the page names no article: all of the body but the links around what is chosen.

    Blocks that are mostly links are searched for blocks that are not. Texts and
    inline elements in a row are judged together, as one paragraph.
    """
    above, todo = set(), [(body, [])]
    while todo:  # elements that hold a chosen one
        node, path = todo.pop()
        if id(node) in chosen:
            while path and id(path[0]) not in above:
                above.add(id(path[0]))
                path = path[1]
        else:
            todo += [(x, [node, path]) for x in node.items if not isinstance(x, str)]
    apart = chosen | above
    for node in reversed(order):
        if node.tag in _BLOCKS or any(not isinstance(x, str) and id(x) in apart for x in node.items):
            apart.add(id(node))
    search = [] if id(body) in chosen else [body]
    while search:
        node = search.pop()
        kept, run = [], []
        for x in [*node.items, None]:
            alone = x is not None and not isinstance(x, str) and id(x) in apart
            if x is not None and not alone:
                run.append(x)
                continue
            if run and _poor(run):
                kept += run
            run = []
            if x is not None:
                kept.append(x)
                if id(x) not in chosen and (id(x) in above or not _poor([x])):
                    search.append(x)
        node.items = kept
    return {id(body)}


def _blocks(body: Node, chosen: set[int]) -> list[str]:
    """Texts of the blocks in page order; white space inside a block is one blank."""
    blocks: list[list[str]] = [[]]
    todo: list = [(body, id(body) in chosen, False)]
    while todo:
        item, inside, end = todo.pop()
        if isinstance(item, str):
            if inside:
                blocks[-1].append(item)
            continue
        if item.tag in _BLOCKS and blocks[-1]:
            blocks.append([])
        if item.tag == "br":
            blocks[-1].append(" ")
        if end:
            continue
        inside = inside or id(item) in chosen
        todo.append((item, inside, True))
        todo += [(x, inside or not isinstance(x, str) and id(x) in chosen, False) for x in reversed(item.items)]
    texts = (_BLANKS.sub(" ", html.unescape("".join(parts))).strip() for parts in blocks)
    return [t for t in texts if t]


def main_text(page: str | None) -> str:
    """The article of a page, blocks joined by an empty line; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    order = _prune(root)
    body = next((n for n in order if n.tag == "body"), root)
    _measure(order, body)
    return "\n\n".join(_blocks(body, _choose(order, body)))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [main_text(p.as_py()) for p in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=[*batch.schema.names[1:], "text", "n_chars"])


def extract_main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url",
                      page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row; no shuffle.

    Null and empty pages and pages without an article give an empty text. Pages
    that break off are read as far as they go. Repeated rows and null ids give a
    row each. Other columns are ignored.
    """
    rows = pages.select(F.col(page).alias("page"), F.col(page_id).cast("long").alias("page_id"),
                        F.col(url).cast("string").alias("url"))
    return shipped(rows).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
