"""Main text of web pages by composite text density.

For every DOM node the characters per tag are weighed down by its links; a
node's density sum adds its children's. The densest sum marks the article, the
smallest density on its path from the body is the threshold, and every subtree
under the body that reaches it gives its own best part. Elements that are never
part of an article (menus, forms, adverts and the like) are left out first.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose boxes count as tags; formatting inside a line does not, but
#: links do.
BOXES = (BLOCK - {"br"}) | {"a", "img"}
#: What an opening tag closes when it is still open inside the nearest container.
CLOSES = {
    **{t: {"p"} for t in BLOCK - {"br", "body", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}},
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "tbody": {"tbody", "thead", "tr", "td", "th", "p"}, "tfoot": {"tbody", "thead", "tr", "td", "th", "p"},
}
#: A closing search does not look beyond these.
HOLDERS = set("article aside blockquote body div dl fieldset figure footer form header html main nav ol section table ul".split())
NEVER = RAW | set("head nav aside form button select footer menu dialog svg math object canvas audio video input label".split())
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adsense|banners?|breadcrumbs?|captcha|comments?|consent|cookies?|copyright|disclaimer|disqus|"
    r"footer|gdpr|header|login|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promos?|promoted|"
    r"recommended|related|replies|reply|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|subscription|tags|toolbar|"
    r"topbar|widgets?|alert|respond|discussion|responses)(?:$|[\s_-])",
    re.I,
)
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar note status".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


class Node:
    __slots__ = ("best", "chars", "density", "items", "link_chars", "link_tags", "skip", "sum", "tag", "tags")

    def __init__(self, tag: str, skip: bool = False):
        self.tag, self.skip, self.items = tag, skip, []


def _noise(tag: str, attrs: str, inside: bool) -> bool:
    if tag in NEVER or (tag == "header" and not inside):
        return True
    if not attrs.strip() or tag in ("html", "body", "article", "main"):
        return False
    for name, value in ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id") and NOISE.search(value):
            return True
        if (name == "role" and value.lower() in ROLES) or (name == "hidden" and value.lower() != "until-found") or (name == "aria-hidden" and value.lower() == "true"):
            return True
    return False


def parse(page: str) -> Node:
    """A tree of Nodes and strings; unclosed and misnested tags are tolerated."""
    root = Node("body")
    stack = [root]
    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            stack[-1].items.append(page[at:])
            break
        if m.start() > at:
            stack[-1].items.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in ("html", "body"):
            continue
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in HOLDERS and tag not in HOLDERS:
                    break
            continue
        closes = CLOSES.get(tag)
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    del stack[i:]
                elif stack[i].tag in HOLDERS:
                    break
        inside = any(x.tag in ("article", "main") for x in stack) if tag == "header" else False
        node = Node(tag, _noise(tag, m[3], inside))
        stack[-1].items.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not m[0].endswith("/>"):
            stack.append(node)
    return root


def measure(root: Node) -> None:
    """Characters, tags and links of every node, then densities and their sums.
    Iterative, for pages nest arbitrarily deep."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [x for x in node.items if type(x) is Node and not x.skip]
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for x in node.items:
            if type(x) is Node:
                if not x.skip:
                    node.chars += x.chars
                    node.tags += x.tags + (x.tag in BOXES)
                    node.link_chars += x.link_chars
                    node.link_tags += x.link_tags
            else:
                node.chars += len("".join(x.split()))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    page_links = root.link_chars / max(1, root.chars)
    for node in reversed(order):
        c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        if c == 0:
            node.density = 0.0
        else:
            base = math.log(c / max(1, c - node.link_chars) * node.link_chars + page_links * c + math.e)
            # Few links make the logarithm's argument large and its base small.
            node.density = c / t * max(0.0, math.log(max(1.0, c / lc * t / lt)) / max(base, 1.0) if base > 1 else math.log(max(1.0, c / lc * t / lt)))
        # A line's formatting passes its parts' sums on and is never chosen.
        parts = [x for x in node.items if type(x) is Node and not x.skip]
        node.sum = sum((x.density if x.tag in BOXES else x.sum for x in parts), 0.0)
        node.best = node if node.tag in BOXES else None
        for x in parts:
            if x.best is not None and (node.best is None or x.best.sum > node.best.sum):
                node.best = x.best


def chosen(root: Node) -> list[Node]:
    """Subtrees that hold the article, in page order."""
    measure(root)
    target = root.best
    path: dict[int, Node] = {}
    todo = [(root, None)]
    parent: dict[int, Node | None] = {}
    while todo:
        node, up = todo.pop()
        parent[id(node)] = up
        if node is target:
            break
        todo += [(x, node) for x in node.items if type(x) is Node and not x.skip]
    threshold, node = target.density, target
    while node is not None:
        path[id(node)] = node
        threshold, node = min(threshold, node.density), parent[id(node)]
    out: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node is target:
            out.append(node)
        elif id(node) in path:
            todo += [x for x in reversed(node.items) if type(x) is Node and not x.skip]
        elif node.chars and node.density >= threshold:
            out.append(node)
    return out


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, white space collapsed."""
    out, now = [], []

    def close():
        text = " ".join(html.unescape("".join(now)).split())
        now.clear()
        if text:
            out.append(text)

    todo = [node]
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif type(x) is str:
            now.append(x)
        elif not x.skip:
            if x.tag in BLOCK:
                close()
                todo.append(None)
            todo += reversed(x.items)
    close()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(b for node in chosen(parse(page)) for b in blocks(node))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col``, plus ``main_text``: the article's blocks in
    page order, one per line.

    NULL and empty html, and pages without text, give "". Pages that end early,
    unclosed and misnested tags are read as far as they go. Rows are independent
    of each other: no shuffle, equal rows give equal results. An input column
    named main_text is replaced.
    """
    keep = [c for c in pages.columns if c not in (html_col, "main_text")]
    d = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").alias("main_text"))

    def run(batches):
        for batch in batches:
            text = pa.array([main_text(x) for x in batch.column("main_text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], text], names=[*keep, "main_text"])

    return d.mapInArrow(run, d.schema)
