"""Main text of web pages: site templates found per host, then the article's blocks.

Every element subtree of a page is hashed from its tag, text and children. In Spark, subtrees
are counted per host over pages of different content, so copies of one article count once. A
subtree that recurs across many such pages is part of the site's template and is deleted.
Articles quote each other, so a text block inside the article must recur on a far larger share of
the host's pages, and on more of them (``MIN_TEXT_SHARE``, ``MIN_TEXT_PAGES``). Templates cannot tell what changes from page to page
(adverts, comments) nor what a host of few pages repeats, so elements that are boilerplate by tag,
role, class or id go as well.

The parser is tolerant: no markup makes it fail, and its work grows with the page, however deep
or broken. A page is parsed once to count and once to extract; html is never shuffled. The set of
templates is broadcast only up to ``MAX_TEMPLATES`` entries (8 bytes each); beyond that, each
page's own templates reach it by a join.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, row_key
from .urlfilter import host_and_path

MIN_PAGES, MIN_SHARE = 5, 0.005
MIN_TEXT_PAGES, MIN_TEXT_SHARE = 20, 0.3
MAX_TEMPLATES = 1 << 20

# HTML element classes, and names that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("dd dt legend li option optgroup summary tbody td tfoot th thead tr body html".split())
SIBLINGS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"), "thead": ("thead tbody tfoot tr td th", "table"), "tbody": ("thead tbody tfoot tr td th", "table"), "tfoot": ("thead tbody tfoot tr td th", "table")}
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li ol ul dl dt dd table thead tbody tfoot tr td th figcaption summary details hr br".split())
INNER_BLOCKS = frozenset("p pre blockquote ul ol dl table".split())
RAW_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())
DROPPED_TAGS = frozenset("script style noscript template head title nav footer aside form button select textarea input iframe svg canvas object menu dialog audio video math".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
DROPPED_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert sidebar sidebars aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer foot masthead topbar toolbar share sharing social related recommended newsletter subscribe subscription comment comments commentlist disqus reply replies respond popup modal overlay login signup search pagination pager skip".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_ATTRIBUTE = re.compile(r"[\s/]*(?:(>)|([^\s/>=][^\s/>=]*|=)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?)")
_ENDS = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.I) for tag in RAW_TAGS}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "key", "dropped", "article", "names", "hard", "own", "good", "holds", "size", "heads")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.key, self.dropped, self.article = 0, False, False


class _Builder:
    """A tolerant tree: implied ends of paragraphs, items and cells; stray end tags do nothing.

    ``open`` has, for each tag, the places of its open elements in the stack, so that the nearest
    one is found without a walk, however deep the page.
    """

    def __init__(self):
        self.root = Node("#root", {}, None)
        self.stack, self.open = [self.root], {}

    def nearest(self, names) -> int:
        return max((places[-1] for n in names if (places := self.open.get(n))), default=0)

    def close(self, names, stop=()) -> None:
        """Ends the nearest open element of these names, unless one of ``stop`` is nearer."""
        at = self.nearest(names)
        if at and (not stop or self.nearest(stop) < at):
            while len(self.stack) > at:
                self.open[self.stack.pop().tag].pop()

    def start(self, tag: str, attrs: dict) -> None:
        if tag in CLOSES_P and self.open.get("p"):
            self.close(("p",), ("td", "th", "li", "button", "table"))
        if tag in SIBLINGS:
            same, stop = SIBLINGS[tag]
            for _ in range(3):
                self.close(same.split(), stop.split())
        node = Node(tag, attrs, self.stack[-1])
        node.parent.children.append(node)
        if tag not in VOID:
            self.open.setdefault(tag, []).append(len(self.stack))
            self.stack.append(node)

    def text(self, raw: str) -> None:
        if raw:
            self.stack[-1].children.append(unescape(raw) if "&" in raw else raw)


def _attributes(html: str, at: int) -> tuple[dict, int]:
    """Attributes of the start tag whose name ends at ``at`` (the first of a name counts), and where the tag ends; -1 if it does not."""
    out: dict = {}
    while True:
        m = _ATTRIBUTE.match(html, at)
        if m is None:
            return out, -1
        at = m.end()
        if m.group(1):
            return out, at
        value = next((v for v in m.group(3, 4, 5) if v is not None), None)
        out.setdefault(m.group(2).lower(), unescape(value) if value and "&" in value else value)


def parse(html: str) -> Node:
    """Comments, declarations and tags that do not end take the rest of the page with them."""
    builder, at = _Builder(), 0
    while at >= 0:
        m = _TAG.search(html, at)
        builder.text(html[at : m.start() if m else len(html)])
        if m is None:
            break
        if m.group(1):  # a comment; "<!-->" is one, too
            end = html.find("-->", m.end() - 2)
            at = end + 3 if end >= 0 else -1
            continue
        if m.group(2) or m.group(3):
            end = html.find(">", m.end())
            if m.group(3) and end >= 0:
                builder.close((m.group(4).lower(),))
            at = end + 1 if end >= 0 else -1
            continue
        tag = m.group(4).lower()
        attrs, at = _attributes(html, m.end())
        if at < 0:
            break
        builder.start(tag, attrs)
        if tag in RAW_TAGS:
            end = _ENDS[tag].search(html, at)
            builder.text(html[at : end.start() if end else len(html)])
            builder.close((tag,))
            at = html.find(">", end.end()) + 1 or -1 if end else -1
        elif html[at - 2] == "/" and tag not in VOID:
            builder.close((tag,))
    return builder.root


def nodes(root: Node) -> list[Node]:
    """All elements, parents before children, in page order."""
    out, work = [], [root]
    while work:
        node = work.pop()
        out.append(node)
        work.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def hash_subtrees(order: list[Node]) -> None:
    for node in reversed(order):
        digest = hashlib.blake2b(node.tag.encode("utf-8", "replace"), digest_size=8)
        for child in node.children:
            if isinstance(child, Node):
                digest.update(b"\x00" + child.key.to_bytes(8, "little"))
            else:
                digest.update(b"\x01" + " ".join(child.split()).encode("utf-8", "replace"))
        node.key = int.from_bytes(digest.digest(), "little")


_NO_NAMES: frozenset = frozenset()


def _names(node: Node) -> frozenset:
    if not node.attrs:
        return _NO_NAMES
    text = f"{node.attrs.get('class') or ''} {node.attrs.get('id') or ''}".lower()
    return frozenset("".join(c if c.isalnum() else " " for c in text).split())


def _boilerplate(node: Node) -> bool:
    if node.tag in DROPPED_TAGS:
        return True
    if not node.attrs:
        return False
    role = (node.attrs.get("role") or "").lower()
    hidden = "hidden" in node.attrs or (node.attrs.get("aria-hidden") or "").lower() == "true" or "display:none" in (node.attrs.get("style") or "").replace(" ", "").lower()
    return hidden or role in DROPPED_ROLES or bool(node.names & DROPPED_NAMES)


_HELD = (lambda n: n.tag == "article", lambda n: n.tag == "main" or (n.attrs.get("role") or "").lower() in ("main", "article") or n.attrs.get("itemprop") == "articleBody", lambda n: n.tag == "body", lambda n: n.parent is None)


def prepare(html: str) -> tuple[list[Node], list[Node]]:
    """Elements in page order with hashes and structural marks, and those that hold the article.

    All outermost elements of the first kind that has any text count: articles, main parts, bodies.
    A wrapper is no boilerplate by its name alone if it holds an article, unless it is named for
    comments. Three passes, each over all elements once.
    """
    root = parse(html)
    order = nodes(root)
    hash_subtrees(order)
    for node in order:
        above = node.parent
        node.names = _names(node)
        node.hard = node.tag in DROPPED_TAGS or bool(node.names & COMMENT_NAMES) or (above is not None and above.hard)
        node.own = bool(node.names & DROPPED_NAMES) if node.tag == "article" else node.tag not in ("html", "body", "main", "#root") and _boilerplate(node)
        node.good = node.tag in ("article", "main") and not node.names & DROPPED_NAMES and not node.hard
    for node in reversed(order):
        inside = [c for c in node.children if isinstance(c, Node)]
        node.holds = node.good or any(c.holds for c in inside)
        node.heads = node.tag in ("h1", "h2") or any(c.heads for c in inside)
    for node in order:
        node.dropped = node.parent is not None and not node.holds and (node.parent.dropped or node.own)
    for node in reversed(order):
        node.size = sum(len(c.strip()) if isinstance(c, str) else 0 if c.dropped else c.size for c in node.children)
    held: list[Node] = []
    for wanted in _HELD:
        found = {id(n) for n in order if not n.dropped and n.size and wanted(n)}
        if found:
            inner: set[int] = set()  # what lies in one of them
            for node in order:
                if node.parent is not None and (id(node.parent) in found or id(node.parent) in inner):
                    inner.add(id(node))
            held = [n for n in order if id(n) in found and id(n) not in inner]
            break
    chosen = {id(n) for n in held}
    for node in order:
        node.article = id(node) in chosen or (node.parent is not None and node.parent.article)
        # a site's header is boilerplate, an article's own header holds its title
        if node.tag == "header" and not (node.article and node.heads):
            node.dropped = True
    return order, held


def deletable(order: list[Node], held: list[Node]) -> list[tuple[Node, bool]]:
    """Subtrees that may be a template: blocks that do not hold the article, and whether they are text blocks of it."""
    above: set[int] = set()
    for node in held:
        while node is not None and id(node) not in above:
            above.add(id(node))
            node = node.parent
    whole = not any(n.tag in ("article", "main") for n in held)
    out = []
    for n in order:
        if n.tag in BLOCK and id(n) not in above:
            inner = not whole and n.article and n.tag in TEXT_BLOCKS
            if not inner or n.tag in INNER_BLOCKS:
                out.append((n, inner))
    return out


def main_text(held: list[Node], templates=frozenset()) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    chosen = {id(n) for n in held}
    work: list = list(reversed(held))
    while work:
        item = work.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif id(item) in chosen or not (item.dropped or id(item) in templates):
            inner = list(reversed(item.children))
            if item.tag in BLOCK or id(item) in chosen:
                flush()
                work.append(None)
            work.extend(inner)
    flush()
    return "\n".join(blocks)


def _host_key(host: str, key: int, inner: bool) -> int:
    return int.from_bytes(hashlib.blake2b(host.encode() + key.to_bytes(8, "little") + (b"t" if inner else b""), digest_size=8).digest(), "little", signed=True)


_SEEN = "host string, subtree long, inner boolean, article long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows: list[tuple] = []
            for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                order, held = prepare(html or "")
                article = int.from_bytes(hashlib.blake2b(b"".join(n.key.to_bytes(8, "little") for n in held), digest_size=8).digest(), "little", signed=True)
                rows.append((host, 0, False, article))
                rows += [(host, k, inner, article) for k, inner in {(_host_key(host, n.key, inner), inner) for n, inner in deletable(order, held)}]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.int64()), strict=True)], names=["host", "subtree", "inner", "article"])


def templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``subtree`` keys (host included) that recur across many pages of different content of a host."""
    seen = pages.where("host <> ''").select("host", "html").mapInArrow(_count, _SEEN).distinct()
    counted = seen.groupBy("host", "subtree").agg(F.count("*").alias("n"), F.max("inner").alias("inner"))
    counted = scratch.save(counted.where(f"subtree = 0 or n >= {MIN_PAGES}"), "counted")
    whole = counted.where("subtree = 0").select(F.col("host").alias("of"), F.col("n").alias("all"))
    often = counted.where("subtree <> 0")
    return often.join(whole, F.col("host") == F.col("of")).where(f"n >= if(inner, greatest({MIN_TEXT_PAGES}, {MIN_TEXT_SHARE} * all), {MIN_SHARE} * all)").select("host", "subtree")


_TEXT = "page_id long, url string, text string, n_chars long, n_templates long"


def _extract(known):
    """``known``: a broadcast sorted array of template keys, or None if each row brings its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None if known is None else known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = part.column("own").to_pylist() if held is None else None
                texts, removed = [], []
                for i, (host, html) in enumerate(zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True)):
                    order, article = prepare(html or "")
                    found = deletable(order, article) if host else []
                    keys = np.array([_host_key(host, n.key, inner) for n, inner in found], np.int64)
                    if held is None:
                        hit = np.isin(keys, np.array(own[i] or [], np.int64))
                    elif len(held):
                        hit = held[np.minimum(np.searchsorted(held, keys), len(held) - 1)] == keys
                    else:
                        hit = np.zeros(len(keys), bool)
                    gone = {id(n) for (n, _), h in zip(found, hit, strict=True) if h}
                    texts.append(main_text(article, gone))
                    removed.append(len(gone))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64())], names=[f.split()[0] for f in _TEXT.split(", ")])

    return run


def extract(pages: DataFrame, max_templates: int = MAX_TEMPLATES) -> DataFrame:
    """``page_id, url, text, n_chars, n_templates`` for every row of ``pages(page_id, url, html, ...)``.

    White space inside a block becomes one space and blocks are joined by a line feed. A null or
    empty html, or one without text, gives an empty text; a null URL, or one without ``://``, has
    no host, so only structure decides; repeated rows and null ids are extracted each, repeats
    count as one page; broken or cut markup is read tolerantly; further columns are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "html")
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    hosted = narrow.withColumn("__url", F.col("url"))
    hosted = hosted.withColumn("host", F.coalesce(host_and_path(F.col("__url"))[0], F.lit(""))).drop("__url")
    found = scratch.save(templates(hosted, scratch), "templates")
    if found.count() <= max_templates:
        keys = np.sort(np.array([r["subtree"] for r in found.select("subtree").collect()], np.int64))
        return hosted.mapInArrow(_extract(spark.sparkContext.broadcast(keys)), _TEXT)
    keyed = hosted.withColumn("row", row_key("page_id", "url", "html"))

    def own(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [(r, _host_key(h, n.key, inner)) for r, h, x in zip(*(part.column(c).to_pylist() for c in ("row", "host", "html")), strict=True) if h for n, inner in deletable(*prepare(x or ""))]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.binary()), pa.array([k for _, k in rows], pa.int64())], names=["of", "subtree"])

    mine = keyed.mapInArrow(own, "of binary, subtree long").distinct().join(found.select("subtree"), "subtree").groupBy("of").agg(F.collect_set("subtree").alias("own"))
    return keyed.join(mine, keyed["row"] == mine["of"], "left").select("page_id", "url", "html", "host", "own").mapInArrow(_extract(None), _TEXT)
