"""Main text of web pages by composite text density.

Every node of the page's tree gets its characters per tag, adjusted by the share of link characters and link tags. The
node whose children's densities have the largest sum holds the article. The least density on its way up to the body is
the threshold that other parts must reach to count as article too, anywhere on the page where all above them reach it.

An article or main element around that node is taken whole. Inside an enclosing main (or article) other parts join by the
threshold, and so do other articles of the page, from ``PART`` of it on. Headings go with the parts that they stand between
or right before, in a main with all parts behind them.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element and attribute names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
DROPPED = frozenset(
    "script style noscript template head title nav aside footer button select option datalist textarea input iframe object embed"
    " svg math canvas audio video map dialog menu noembed noframes".split()
)
ROLES = frozenset("navigation banner complementary contentinfo search alert alertdialog dialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion sidebar menu nav navbar navigation"
    " breadcrumb breadcrumbs footer cookie cookies consent notice notices popup modal newsletter subscribe subscription signup"
    " share sharing social related recommended comment comments disqus reply replies respond widget masthead toolbar login"
    " copyright".split()
)
#: A name of these is never that of a layout around the article, however much text the element holds.
REMARKS = frozenset("comment comments disqus reply replies respond".split())
#: Share of the threshold for other articles: where nothing else stands beside them it is the mean of all of them.
PART = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = BLOCK - {"body", "html"}
_CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "dropped", "chars", "tags", "link_chars", "link_tags", "density", "total", "article", "heading", "named", "held", "parts")

    def __init__(self, tag: str, parent: "Node | None") -> None:
        self.tag, self.parent = tag, parent
        self.dropped = parent is not None and parent.dropped
        self.article = parent is not None and parent.article
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.heading = self.named = False
        self.held = self.parts = 0


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)}


def _is_other(tag: str, source: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is none of the article by what it is, and whether by a name that a layout may have too."""
    if tag in DROPPED or (tag == "header" and not inside):
        return True, False
    if not source or tag in ("html", "body", "main"):
        return False, False
    found = _attributes(source)
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return True, False
    if found.get("role", "").lower() in ROLES:
        return True, False
    names = {n.lower() for n in _NAME.findall(found.get("class", "") + " " + found.get("id", ""))}
    hit = names.intersection(("comment", "comments") if tag == "article" else NAMES)
    return not hit.isdisjoint(REMARKS), bool(hit)


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Nodes in page order, the root first, and pieces of text with their node; a block break is a piece ''."""
    root = Node("", None)
    nodes, pieces, stack = [root], [], [root]
    open_tags: Counter[str] = Counter()
    at, n = 0, len(page)

    def close(k: int) -> None:
        """Close the open nodes from place ``k`` on."""
        for node in stack[k:]:
            open_tags[node.tag] -= 1
        del stack[k:]

    def text(upto: int) -> None:
        if upto > at:
            pieces.append((stack[-1], page[at:upto]))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(n)
            break
        mark = page[lt + 1 : lt + 2]
        if mark == "!" or mark == "?":
            text(lt)
            stop = page.find("-->", lt + 4) + 3 if page.startswith("<!--", lt) else page.find(">", lt) + 1
            at = stop if stop > 2 or (stop and mark == "?") else n
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            text(lt + 1)
            at = lt + 1
            continue
        text(lt)
        at = m.end()
        tag = m[2].lower()
        if m[1]:  # an end tag closes up to its start; without one it is ignored
            if open_tags[tag] > 0:
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            if tag in BLOCK:
                pieces.append((stack[-1], ""))
            continue
        if tag == "br":
            pieces.append((stack[-1], " "))
        if tag in _CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in BLOCK:
                    break
        limits = _CLOSED_BY_SAME.get(tag)
        if limits:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in limits:
                    break
                if stack[k].tag == tag or (tag in ("dt", "dd") and stack[k].tag in ("dt", "dd")):
                    close(k)
                    break
        node = Node(tag, stack[-1])
        other, node.named = _is_other(tag, m[3], node.article)
        node.dropped = node.dropped or other
        node.article = node.article or tag in ("article", "main")
        nodes.append(node)
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            up = node.parent
            while up is not None and up.tag == "header":
                up.heading, up = True, up.parent
        if tag in BLOCK:
            pieces.append((node, ""))
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            at = stop.start() if stop else n
        stack.append(node)
        open_tags[tag] += 1
    return nodes, pieces


def _size(text: str) -> int:
    return len("".join(text.split()))


def _subtree_sums(nodes: list[Node], own: dict[int, int]) -> dict[int, int]:
    """Sum of ``own`` (by identity) over each node and all below it; children come after their parents."""
    total = dict(own)
    for node in reversed(nodes):
        if (got := total.get(id(node))) and node.parent is not None:
            total[id(node.parent)] = total.get(id(node.parent), 0) + got
    return total


def _own(pairs: Iterable[tuple[Node, int]]) -> dict[int, int]:
    out: dict[int, int] = {}
    for node, n in pairs:
        out[id(node)] = out.get(id(node), 0) + n
    return out


def _measure(nodes: list[Node], pieces: list[tuple[Node, str]]) -> None:
    """Characters, tags and densities of every node that may belong to the article."""
    linked: set[int] = set()
    for node in nodes:
        if node.tag == "a" or id(node.parent) in linked:
            linked.add(id(node))
    for node, text in pieces:
        if text and not node.dropped:
            size = _size(text)
            node.chars += size
            if id(node) in linked:
                node.link_chars += size
    for node in reversed(nodes):
        up = node.parent
        if up is not None and not node.dropped:
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags + (node.tag == "a")
    root = nodes[0]
    share = root.link_chars / max(root.chars, 1)
    for node in nodes:
        if node.dropped or not node.chars:
            continue
        c, lc = node.chars, node.link_chars
        base = log(c / max(c - lc, 1) * lc + share * c + e)
        ratio = c / max(lc, 1) * max(node.tags, 1) / max(node.link_tags, 1)
        node.density = c / max(node.tags, 1) * log(max(ratio, 1.0)) / log(max(base, 1 + 1e-9)) if base > 1 else c / max(node.tags, 1) * log(max(ratio, 1.0))
    for node in nodes[1:]:
        if not node.dropped:
            node.parent.total += node.density


def _content(nodes: list[Node]) -> set[int]:
    """Identities of the roots of the subtrees that are the article."""
    best = max(nodes, key=lambda x: x.total)
    if best.total <= 0:
        best = max(nodes, key=lambda x: x.density)
        if best.density <= 0:
            return set()
    threshold, up, outer, scope = best.density, best, None, None
    while up is not None:
        if up.density > 0 and up.tag not in ("html", ""):
            threshold = min(threshold, up.density)
        if up.tag in ("article", "main"):
            outer, scope = outer or up, up
        up = up.parent
    core = outer or best
    above, up = set(), core.parent
    while up is not None:
        above.add(id(up))
        up = up.parent
    chosen, open_, below = {id(core)}, {id(nodes[0])}, {id(core)}
    within = {id(scope)}
    for node in nodes[1:]:  # parents come first
        up = node.parent
        if id(up) in within:
            within.add(id(node))
        if id(up) in below:
            below.add(id(node))
        if node.dropped or id(node) in below or id(up) not in open_:
            continue
        if id(node) in above:
            open_.add(id(node))
        elif node.tag == "article" and node.density >= PART * threshold:
            chosen.add(id(node))
            below.add(id(node))
        elif node.density >= threshold:
            if node.tag in BLOCK and node.tag not in ("html", "body") and (outer is None or (id(node) in within and scope is not outer)):
                chosen.add(id(node))
                below.add(id(node))
            else:
                open_.add(id(node))
        elif outer is not None and node.tag in BLOCK:
            open_.add(id(node))  # an article may stand in a thin wrapper
    return chosen | _headings(nodes, chosen, id(scope) if scope is not outer else None)


def _headings(nodes: list[Node], chosen: set[int], scope: int | None) -> set[int]:
    """Headings between the chosen nodes, right before one of them, or in ``scope`` and before the last of them."""
    around: set[int] = set()
    for node in nodes:
        if id(node) in chosen:
            up = node.parent
            while up is not None and id(up) not in around:
                around.add(id(up))
                up = up.parent
    found: set[int] = set()
    waiting: list[tuple[Node, bool]] = []
    covered, within, started = set(), {scope}, False
    for node in nodes:
        up = id(node.parent)
        if up in within:
            within.add(id(node))
        if up in covered or id(node) in chosen:
            covered.add(id(node))
            if id(node) in chosen:
                found |= {id(h) for h, free in waiting if free or h.parent is node.parent and h.tag in HEADINGS}
                waiting, started = [], True
        elif node.dropped:
            continue
        elif node.tag in HEADINGS:
            waiting.append((node, started or id(node) in within))
        elif id(node) not in around and node.chars and node.tag in BLOCK and (up not in within) and node.parent.tag not in HEADINGS:
            waiting = [w for w in waiting if w[1]]  # other text between: not right before
    return found


def main_text(page: str) -> str:
    """The article's blocks, one per line, with references decoded and white space made single."""
    nodes, pieces = parse(page)
    total = sum(_size(t) for x, t in pieces if t and not x.dropped)
    held = _subtree_sums(nodes, _own((x, _size(t)) for x, t in pieces if t and not x.dropped))
    for node in nodes:
        if node.named:
            node.held = held.get(id(node), 0)
    parts = [node for node in nodes if node.tag in ("article", "main") and not node.dropped]
    below = _subtree_sums(nodes, _own((node.parent, 1) for node in parts))
    for node in nodes:
        node.parts = below.get(id(node), 0)
    for node in nodes[1:]:
        # a name as of a side part is that of a layout on an element that holds most of the page and all its articles
        side = node.named and (2 * node.held < total or node.parts < len(parts) or node.tag in ("article", "p"))
        node.dropped = node.dropped or node.parent.dropped or side
    total = sum(_size(t) for x, t in pieces if t and not x.dropped) or 1
    # a form that wraps most of the page is layout; any other is none of the article
    forms = _subtree_sums(nodes, _own((x, _size(t)) for x, t in pieces if t))
    for node in nodes[1:]:
        node.dropped = node.dropped or node.parent.dropped or (node.tag == "form" and 2 * forms.get(id(node), 0) < total) or (node.tag == "header" and not node.heading)
    _measure(nodes, pieces)
    chosen = _content(nodes)
    inside: dict[int, bool] = {}
    for node in nodes:
        inside[id(node)] = not node.dropped and (id(node) in chosen or (node.parent is not None and inside[id(node.parent)]))
    blocks: list[list[str]] = [[]]
    for node, text in pieces:
        if not text:
            blocks.append([])
        elif inside[id(node)]:
            blocks[-1].append(text)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks if b)
    return "\n".join(line for line in lines if line)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            texts = [main_text(p.as_py() or "") for p in part.column(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*batch.schema.names[:-1], "text", "n_chars"])


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, ``text`` and ``n_chars`` (code points) of each page.

    A null or empty page, one without an article and one that is all markup give an empty text. What is no HTML at all is
    text of one block. Rows are independent, so repeated rows and null keys do not matter; other columns are not read.
    """
    narrow = pages.select(*keep, F.col(html_column).cast("string").alias("_html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(_extract, f"{fields}, text string, n_chars long")
