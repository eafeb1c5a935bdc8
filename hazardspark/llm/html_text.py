"""Main text of web pages by consensus of a host's pages.

Every page scores its containers (block sections): from the body down, the container goes on to a child that holds most of
the text that is neither boilerplate nor links. It does not go into the parts of an article or main, nor past headings and
paragraphs that lie beside its children. The page votes for the generalised path of that container (tags and classes from the
root, digits in classes as #). Spark adds up the votes by host, and the path with the most votes wins. Each page is then
extracted anew from the containers on its host's winning path; a page without such a container, or a winning path with
no text on the page, falls back to the page's own container.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are left out wherever they are,
by element, role, and the words of class and id. Character references are decoded, white space inside a block becomes
one space, blocks are joined by a line feed in page order.

Defined results: a null or empty page has the empty text; a page without a readable url votes under the empty host;
markup that is never closed ends with the page; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardspark.llm.common import bounded_batches, record
from hazardspark.session import cut_lineage

#: Hosts whose winners (a path each) may be broadcast; more hosts meet their pages by a shuffle, with the same rows.
FEW = 100_000
#: One of several articles with this share of their text is the page's.
MOST = 0.75
#: A path of more characters is replaced by its digest, and goes on from there.
LONG = 1024

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noscript", "xmp", "noembed", "noframes")}
# Fixed values of the language: elements without content, block elements, what a start tag closes.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, {"html"}),
}
_P_STAYS = frozenset("td th caption button object table html body div article section main li blockquote".split())
_CONTAINERS = frozenset("body main article section div center".split())
#: Containers that are taken whole.
_WHOLE = frozenset("main article".split())
_DROPPED = frozenset(
    "nav header footer aside form script style noscript template iframe head title select textarea button dialog svg math canvas object "
    "audio video menu search datalist xmp noembed noframes".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside comment comments disqus discussion replies "
    "respond menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert notification "
    "newsletter subscribe subscription signup login popup modal overlay share sharing social related recommended recommendations pagination pager "
    "toolbar widget paywall disclaimer copyright toc skip".split()
)
_SPLIT = re.compile(r"[^a-z]+|(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"[0-9]+")


_COMMENTS = frozenset("comment comments disqus discussion replies reply respond".split())
#: A block whose name is only in part a listed word goes if so many hundredths of it are links, or if it holds fewer
#: hundredths of the page's text than this.
LINKED, SLIGHT = 33, 15


class Node:
    __slots__ = ("tag", "path", "parent", "skip", "doubt", "text", "links", "children", "first", "last")

    def __init__(self, tag: str, path: str, parent: Node | None, skip: bool, doubt: int, first: int):
        self.tag, self.path, self.parent, self.skip, self.doubt, self.first, self.last = tag, path, parent, skip, doubt, first, -1
        self.text, self.links, self.children = 0, 0, []


def _boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    if tag in _DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in _ROLES:
        return True
    if "style" in attributes and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes["style"], re.I):
        return True
    if tag == "article":
        return bool({"comment", "comments", "reply"} & set(_SPLIT.split(attributes.get("class", "").lower())))
    return False


def _words_of(name: str) -> list[str]:
    return [w.lower() for w in _SPLIT.split(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name)) if w]


def _doubt(tag: str, attributes: dict[str, str]) -> int:
    """What an element's names say: 3 reader comments, 2 a name that is a listed word throughout, 1 in part, 0 nothing."""
    if tag in ("html", "body", "article", "main"):
        return 0
    names = [_words_of(n) for n in (*attributes.get("class", "").split(), attributes.get("id", ""))]
    listed = [n for n in names if n and not _WORDS.isdisjoint(n)]
    if not listed:
        return 0
    whole = [n for n in listed if _WORDS.issuperset(n)]
    return 3 if any(_COMMENTS & set(n) for n in whole) else 2 if whole else 1


def _settle(root: Node, blocks: list[str | None], nodes: list[Node], doubted: list[Node]) -> None:
    """Take out the doubted blocks, given in page order, that the page's text speaks against.

    A name alone drops no block that holds the page's main article, or, on a page without one, most of its text that is
    not links (reader comments apart). A name that is a listed word only in part drops a block only if it is
    mostly links or slight. A page does not come out empty while a doubted block has text.
    """
    page = weight(root)
    main = max((n for n in nodes if n.tag in _WHOLE and weight(n)), key=weight, default=None)
    gone, end = [], 0
    for node in doubted:
        if node.first < end or node.first == node.last:
            continue
        if main is not None and node.first <= main.first and main.last <= node.last:
            continue
        mine = weight(node)
        if main is None and node.doubt < 3 and mine >= (MOST if node.doubt == 2 else 0.5) * page:
            continue
        if node.doubt == 1 and 100 * node.links < LINKED * node.text and 100 * mine >= SLIGHT * page:
            continue
        gone.append(node)
        end = node.last
    if gone and page == sum(map(weight, gone)):
        gone.remove(max(gone, key=weight))
    for node in gone:
        blocks[node.first : node.last] = [None] * (node.last - node.first)
        above, text, links = node, node.text, node.links
        while above is not None:
            above.text -= text
            above.links -= links
            above = above.parent
    starts = [n.first for n in gone]
    for node in nodes:
        k = bisect_right(starts, node.first) - 1
        if k >= 0 and node.last <= gone[k].last and node is not gone[k]:
            node.text = node.links = 0


def parse(page: str) -> tuple[Node, list[str | None], list[Node]]:
    """The root, the blocks of text in page order (None: taken out), and all container nodes. A node's blocks are first to last - 1."""
    root = Node("", "", None, False, 0, 0)
    stack, blocks, nodes, parts, doubted = [root], [], [], [], []
    is_open: Counter = Counter()
    last_end = page.rfind(">")

    def add(text: str) -> None:
        if not stack[-1].skip and text:
            parts.append(text)

    def flush() -> None:
        if parts:
            block = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if block:
                blocks.append(block)
                stack[-1].text += len(block)

    def close(to: int) -> None:
        while len(stack) > to:
            node = stack[-1]
            if node.tag in _BLOCKS:
                flush()
            stack.pop()
            is_open[node.tag] -= 1
            node.last = len(blocks)
            if not node.skip:
                stack[-1].text += node.text
                stack[-1].links += node.links

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at, last_end + 1) if at <= last_end else None
        if not m:
            # No markup ends any more; what is left is text, up to a comment that is never closed.
            open_comment = page.find("<!--", at)
            add(page[at : open_comment if open_comment >= 0 else size])
            break
        if m.start() > at:
            add(page[at : m.start()])
            if len(stack) > 1 and not stack[-1].skip and any(n.tag == "a" for n in stack[-3:]):
                stack[-1].links += m.start() - at
        at = m.end()
        end, tag, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag == "br":
                add(" ")
                continue
            for k in range(len(stack) - 1 if is_open[tag] else 0, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in _BLOCKS and stack[k].tag in _BLOCKS:
                    # An inline end tag does not close a block around it; the inline element below it ends there.
                    break
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "img", "input"):
                add(" ")
            continue
        if tag in _CLOSES:
            closed, stops = _CLOSES[tag]
            for k in range(len(stack) - 1 if any(is_open[t] for t in closed) else 0, 0, -1):
                if stack[k].tag in stops:
                    break
                if stack[k].tag in closed:
                    close(k)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
        if tag in _BLOCKS:
            for k in range(len(stack) - 1 if is_open["p"] else 0, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in _P_STAYS:
                    break
            flush()
        attributes = {}
        if "=" in rest or "hidden" in rest:
            attributes = {a[1].lower(): html.unescape(a[2] or a[3] or a[4] or "") for a in _ATTRIBUTE.finditer(rest)}
        above = stack[-1]
        skip = above.skip or _boilerplate(tag, attributes)
        doubt = _doubt(tag, attributes) if attributes and not skip else 0
        # What is inside a line of text is not weighed.
        skip = skip or doubt > 0 and tag not in _BLOCKS
        names = ".".join(sorted(set(_DIGITS.sub("#", attributes.get("class", "")).split())))
        path = f"{above.path}>{tag}.{names}" if names else f"{above.path}>{tag}"
        if len(path) > LONG:
            path = hashlib.md5(path.encode("utf-8", "replace")).hexdigest()
        node = Node(tag, path, above, skip, doubt, len(blocks))
        if doubt and not skip:
            doubted.append(node)
        if not rest.endswith("/") or tag in _BLOCKS or tag in _RAW:
            stack.append(node)
            is_open[tag] += 1
        if tag in _CONTAINERS and not skip:
            nodes.append(node)
            above.children.append(node)
        elif not skip:
            node.children = above.children  # containers below a plain element count as its parent's
        if tag in _RAW:
            found = _RAW[tag].search(page, at)
            if tag not in _DROPPED:
                add(page[at : found.start() if found else size])
            at = found.end() if found else size
            if stack[-1] is node:
                close(len(stack) - 1)
    close(1)
    flush()
    root.last = len(blocks)
    if doubted:
        _settle(root, blocks, nodes, doubted)
    return root, blocks, nodes


def weight(node: Node) -> int:
    """Text that is not links."""
    return max(node.text - node.links, 0)


def own_container(root: Node, nodes: list[Node]) -> Node:
    """The page's article or main if one has most of the text of all of these; else from the root down while one child
    has all the text that is not links."""
    whole, end = [], 0
    for node in nodes:
        if node.tag in _WHOLE and node.first >= end and weight(node):
            whole.append(node)
            end = node.last
    if whole:
        best = max(whole, key=weight)
        if weight(best) >= MOST * sum(map(weight, whole)):
            return best
    now = root
    while now.children:
        best = max(now.children, key=weight)
        if not weight(best) or weight(best) < weight(now):
            break
        now = best
    return now


def text_of(page: str, path: str | None) -> str:
    """Blocks of the containers on ``path``; of the page's own container if that has more than twice their text."""
    root, blocks, nodes = parse(page)
    chosen, end = [], -1
    for node in nodes:
        if node.path == path and node.first >= end and weight(node):
            chosen.append(node)
            end = node.last
    own = own_container(root, nodes)
    if 2 * sum(map(weight, chosen)) <= weight(own) or not chosen:
        chosen = [own]
    return "\n".join(b for n in chosen for b in blocks[n.first : n.last] if b is not None)


def host_of(url) -> F.Column:
    """Host of a url in lower case, empty where there is none."""
    found = F.regexp_extract(F.lower(F.coalesce(url.cast("string"), F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def winners(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host and path: the container path with the most votes (then the most text, then the first by name)."""
    bounded_batches(pages.sparkSession)
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64()), ("text", pa.int64())])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, text = Counter(), Counter()
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                root, _, nodes = parse(page)
                node = own_container(root, nodes)
                if weight(node):
                    votes[host, node.path] += 1
                    text[host, node.path] += weight(node)
            yield record(schema, [h for h, _ in votes], [p for _, p in votes], list(votes.values()), [text[k] for k in votes])

    read = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    counted = read.mapInArrow(vote, "host string, path string, votes long, text long")
    counted = counted.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("text").alias("text"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("votes", "text", "path")).alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""
    bounded_batches(pages.sparkSession)
    won = cut_lineage(winners(pages, url_col, html_col))
    if won.count() <= FEW:
        won = F.broadcast(won)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text_of(page, path) for page, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield record(schema, batch.column("page_id"), batch.column("url"), texts, [len(t) for t in texts])

    read = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"),
    )
    return read.join(won, "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
