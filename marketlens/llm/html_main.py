"""Main text of web pages by site template removal (operator 1).

Every element subtree of a page is hashed (tags and normalised text). Spark
counts, for each host, the distinct pages on which a subtree stands; subtrees
that recur across many pages of their host are the site's template and are
deleted. What no count can show, since it differs on every page or the host has
few pages, goes by its element or class name (menus, notices, adverts, forms,
comments, scripts). Of what is left, the article is taken where a page marks one.
The two parts can be told apart: ``n_counted`` and ``n_named`` are the code points
that each removes, and ``by_name=False`` leaves the work to the counts alone.

Paragraphs, headings, lists and tables inside a marked article are never
template: authors quote the same passage on many pages. Pages count once for
each article: those of equal paragraphs and headings in the marked article, or
else of equal title, heading and long blocks (half the longest at least), are one
page, so copies of an article under differing menus don't make it a template.

Names: a whole class or id name, or a compound of such a name and layout words
(``site-footer``, not ``social-history``). Inside an article only whole names
count, and never for an element that holds a first heading.

Text: character references are decoded in each piece of text by itself, white
space in a block becomes one space, blocks are trimmed and joined by a line
break in page order.

Edge cases: null or empty html has the empty text; unclosed elements, stray end
tags, pages cut off in a tag or reference and elements nested without end are read as
far as they go, in time that grows with the page; a null url has the host ''.
Repeated rows give one row each; empty tables no rows; other columns are not
read. Pages are read whole.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.textops import slices

#: A subtree is template on at least this many distinct pages of the host, and this share of them.
MIN_PAGES, MIN_SHARE = 5, 0.02
#: Template keys up to this many are broadcast (8 bytes each); more are joined by host.
BROADCAST_KEYS = 2_000_000

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote table thead tbody tfoot tr td th caption figure figcaption hr".split()) | INLINE
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
                     "section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
# Elements, roles and class names that are never main text.
CHROME = RAW | frozenset("head nav footer aside form script style button select dialog menu svg math canvas object audio video input".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
BARRIERS = frozenset({"article", "main", "body"})
NAMES = frozenset("ad ads advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
                  "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager "
                  "pagination popup promo promotion related replies reply respond share sharing sidebar signup social sponsor sponsored "
                  "subscribe subscription toolbar widget widgets".split())
# Words that stand beside such a name in a compound, and names of articles that aren't the page's own.
LAYOUT = frozenset("site page main top bottom left right global primary secondary mobile desktop list lists item items entry post posts article articles "
                   "wrap wrapper container box block bar button buttons link links form section area inner outer content slot unit row col "
                   "text icon icons panel block group strip message info legal social blog the js u c".split())
OTHER_ARTICLES = frozenset("comment comments reply replies respond teaser related promo promotion sponsor sponsored advert advertisement ad".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|[^<]+|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_BLANK = re.compile(r"\s+")


class Node:
    """An element: its name, attributes, where it stands, and what the page's reading found out about it."""

    __slots__ = ("tag", "attrs", "parent", "number", "flow", "frame", "scope", "holds_article", "holds_heading", "inside")

    def __init__(self, tag, attrs, parent, number):
        self.tag, self.attrs, self.parent, self.number = tag, attrs, parent, number
        self.holds_article = self.holds_heading = False
        inline = tag in INLINE
        self.flow = parent.flow if parent is not None and inline else self                       # nearest that isn't inline
        self.frame = parent.frame if parent is not None and (inline or tag == "p") else self     # nor a paragraph
        self.scope = {} if parent is None or tag in BARRIERS else parent.scope                   # open elements inside, by name
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))


class Page:
    """A page as read: its nodes in order, its title, and events in page order: a node that opens, (text, node) or
    (None, node) where it closes."""

    def __init__(self, source: str):
        root = Node("#page", {}, None, 0)
        self.nodes, self.events, self.title = [root], [root], ""
        self._open: dict[str, int] = {}
        at, i, n = root, 0, len(source)
        while i < n:
            m = _TOKEN.match(source, i)
            piece, i = m[0], m.end()
            if piece[0] != "<" or piece == "<":
                self.events.append((piece, at))
                continue
            name = _NAME.match(piece)
            if not name:
                continue                                     # comments, declarations
            if not piece.endswith(">"):
                break                                        # the page ends within a tag
            tag = name[1].lower()
            if piece[1] == "/":
                among = at.scope if tag in INLINE or tag == "p" else self._open
                if among.get(tag, 0):                        # else a stray end tag
                    while at.tag != tag:
                        at = self._close(at)
                    at = self._close(at)
                continue
            rest = piece[name.end():-1]
            attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(rest)} if rest.strip("/ ") else {}
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(source, i)
                node = self._new(tag, attrs, at)
                if tag == "title" and not self.title:
                    self.title = source[i:end.start() if end else n]
                self.events.append((None, node))
                i = end.end() if end else n
                continue
            if tag in CLOSES_P:
                if at.flow.tag == "p":
                    at = self._up(at, at.flow.parent)
            elif tag in SIBLINGS:
                up = at.frame
                while up.tag in SIBLINGS[tag]:
                    at = self._up(at, up.parent)
                    up = up.parent
            node = self._new(tag, attrs, at)
            if tag in VOID or rest.endswith("/"):
                self.events.append((None, node))
            else:
                self._open[tag] = self._open.get(tag, 0) + 1
                at.scope[tag] = at.scope.get(tag, 0) + 1
                at = node
        while at is not None:
            at = self._close(at)

    def _new(self, tag, attrs, parent) -> Node:
        node = Node(tag, attrs, parent, len(self.nodes))
        self.nodes.append(node)
        self.events.append(node)
        for flag in ("holds_article",) * (tag in ("article", "main")) + ("holds_heading",) * (tag == "h1"):
            up = parent
            while up is not None and not getattr(up, flag):
                setattr(up, flag, True)
                up = up.parent
        return node

    def _close(self, node: Node) -> Node | None:
        self.events.append((None, node))
        if node.parent is not None:
            self._open[node.tag] -= 1
            node.parent.scope[node.tag] -= 1
        return node.parent

    def _up(self, at: Node, to: Node) -> Node:
        while at is not to:
            at = self._close(at)
        return at

    def blocks(self, keep) -> list[str]:
        """The text blocks of the nodes of which ``keep`` (by number) holds true."""
        out, run = [], []

        def flush():
            t = _BLANK.sub(" ", "".join(run)).strip()
            if t:
                out.append(t)
            run.clear()

        for e in self.events:
            if isinstance(e, Node):
                if e.tag == "br":
                    run.append(" ")
                elif e.tag not in INLINE:
                    flush()
            elif e[0] is None:
                if e[1].tag not in INLINE and e[1].tag != "br":
                    flush()
            elif keep[e[1].number]:
                run.append(html.unescape(e[0]))
        flush()
        return out


def _is_name(name: str, whole: bool) -> bool:
    if name in NAMES:
        return True
    parts = [x for x in re.split(r"[-_]+", name) if x and not x.isdigit()]
    return not whole and any(x in NAMES for x in parts) and all(x in NAMES or x in LAYOUT for x in parts)


def chrome(node: Node) -> bool:
    """Whether an element goes by its name."""
    if node.tag in CHROME or node.tag == "header" and not node.inside:
        return True
    a = node.attrs
    if not a or node.tag in ("body", "html", "main", "#page"):
        return False
    names = f"{a.get('class', '')} {a.get('id', '')}".lower().split()
    if node.tag == "article":
        return any(x in OTHER_ARTICLES for name in names for x in re.split(r"[-_]+", name)[:1] + re.split(r"[-_]+", name)[-1:])
    if node.holds_article:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES:
        return True
    if node.holds_heading:
        return not node.inside and any(name in NAMES for name in names)
    return any(_is_name(name, node.inside) for name in names)


def _digest(*parts: bytes) -> bytes:
    h = hashlib.blake2b(digest_size=8)
    for x in parts:
        h.update(x)
    return h.digest()


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def subtree_digests(page: Page) -> list[bytes]:
    """The hash of each node's subtree: its name, its texts with white space made even, and its children."""
    open_: dict[int, object] = {}
    out: list[bytes] = [b""] * len(page.nodes)
    for e in page.events:                                    # a node closes after all that it holds
        if isinstance(e, Node):
            open_[e.number] = hashlib.blake2b(_bytes(e.tag), digest_size=8)
        elif e[0] is not None:
            open_[e[1].number].update(b"\1" + _bytes(" ".join(e[0].split())))
        else:
            number = e[1].number
            out[number] = open_.pop(number).digest()
            if e[1].parent is not None:
                open_[e[1].parent.number].update(out[number])
    return out


def candidate_keys(page: Page, host: str) -> tuple[list[int], np.ndarray]:
    """(numbers of the nodes that could be template, their keys of host and subtree)."""
    salt = hashlib.blake2b(_bytes(host), digest_size=16).digest()
    digests = subtree_digests(page)
    own = [v.number for v in page.nodes if v.tag not in ("#page", "html", "body", "article", "main") and not (v.inside and v.tag in PROSE)]
    keys = b"".join(hashlib.blake2b(digests[i], digest_size=8, key=salt).digest() for i in own)
    return own, np.frombuffer(keys, "<i8")


def article_identity(page: Page) -> int:
    """The same for pages of one article: a hash of the paragraphs and headings in the marked article, or of all its text if
    it has none; without a marked article of title, first heading and the blocks at least half as long as the longest."""
    inside = [v.inside or v.tag in ("article", "main") for v in page.nodes]
    if any(inside):
        prose = [False] * len(inside)
        for v in page.nodes:
            prose[v.number] = inside[v.number] and (v.tag in PROSE and v.tag not in INLINE or v.parent is not None and prose[v.parent.number])
        parts = page.blocks(prose) or page.blocks(inside)
    else:
        heading = [False] * len(inside)
        for v in page.nodes:
            heading[v.number] = v.tag == "h1" or v.parent is not None and heading[v.parent.number]
        raw = [v.tag not in RAW for v in page.nodes]
        blocks = page.blocks(raw)
        longest = max(map(len, blocks), default=0)
        parts = [page.title, *page.blocks(heading)[:1], *[b for b in blocks if 2 * len(b) >= longest]]
    return int.from_bytes(_digest(*[_bytes(x) + b"\1" for x in parts]), "little", signed=True)


def main_text(source: str | None, host: str, template: np.ndarray, by_name: bool = True) -> tuple[str, int, int]:
    """(main text, code points in subtrees deleted by count, code points in those deleted by name only), given the sorted
    template keys. Without ``by_name`` only scripts and the like go by name, and no article is chosen."""
    if not source:
        return "", 0, 0
    page = Page(source)
    own, keys = candidate_keys(page, host)
    counted = [False] * len(page.nodes)
    if len(template) and len(keys):
        at = np.minimum(np.searchsorted(template, keys), len(template) - 1)
        for i in np.flatnonzero(template[at] == keys):
            counted[own[i]] = True
    named = [False] * len(page.nodes)
    for v in page.nodes:
        up = v.parent.number if v.parent is not None else 0
        counted[v.number] = counted[v.number] or counted[up]
        named[v.number] = named[up] or (chrome(v) if by_name else v.tag in RAW or v.tag == "head")
    kept = [not (a or b) for a, b in zip(counted, named, strict=True)]
    size = lambda keep: sum(len(b) for b in page.blocks(keep))
    n_counted = size(counted)
    n_named = size([a and not b for a, b in zip(named, counted, strict=True)])
    for tag in ("article", "main") if by_name else ():
        if any(v.tag == tag and kept[v.number] for v in page.nodes):
            below = [False] * len(page.nodes)
            for v in page.nodes:
                below[v.number] = v.tag == tag or v.parent is not None and below[v.parent.number]
            kept = [a and b for a, b in zip(kept, below, strict=True)]
            break
    return "\n".join(page.blocks(kept)), n_counted, n_named


def page_rows(pages: DataFrame, key: str, url: str, source: str) -> DataFrame:
    from marketlens.llm.url_rules import host_path
    host, _ = host_path(F.col(url))
    return pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(source).alias("html"))


def template_keys(rows: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, key): the subtrees that recur across many pages, of different articles, of their host. Counting is by key, so a host with
    most of the pages spreads over all tasks; sums are made in the tasks first."""

    def hashes(batches):
        for b in slices(batches, 200):
            host_out, keys_out, page_out = [], [], []
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if source:
                    page = Page(source)
                    own = np.unique(candidate_keys(page, host)[1])
                    host_out += [host] * len(own)
                    keys_out.append(own)
                    page_out.append(np.full(len(own), article_identity(page)))
            keys, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys_out, page_out))
            yield pa.RecordBatch.from_arrays([pa.array(host_out, pa.string()), pa.array(keys, pa.int64()), pa.array(ids, pa.int64())],
                                             ["host", "key", "page"])

    found = rows.select("host", "html").mapInArrow(hashes, "host string, key bigint, page bigint")
    per_key = found.groupBy("key", "page").agg(F.first("host").alias("host")).groupBy("key").agg(
        F.count("*").alias("n"), F.first("host").alias("host")).where(F.col("n") >= min_pages)
    per_host = rows.groupBy("host").agg(F.count("*").alias("pages"))
    return per_key.join(per_host, "host").where(F.col("n") >= min_share * F.col("pages")).select("host", "key")


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", min_pages: int = MIN_PAGES,
                      min_share: float = MIN_SHARE, broadcast_keys: int = BROADCAST_KEYS, by_name: bool = True) -> DataFrame:
    """(page_id, url, text, n_counted, n_named) for every row."""
    from marketlens.session import cut_lineage
    spark = pages.sparkSession
    rows = page_rows(pages, key, url, source)
    keys = cut_lineage(template_keys(rows, min_pages, min_share))
    few = keys.count() <= broadcast_keys
    if few:
        known = np.sort(np.array([r["key"] for r in keys.select("key").toLocalIterator()], np.int64))
        shared = spark.sparkContext.broadcast(known)
    else:                                                    # a host's list is short: each entry stands on min_share of its pages
        rows = rows.join(keys.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("keys")), "host", "left")

    def extract(batches):
        for b in slices(batches, 200):
            c = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            own = [shared.value] * len(b) if few else [np.array(k or (), np.int64) for k in c["keys"].to_pylist()]
            found = [main_text(s, h, t, by_name) for s, h, t in zip(c["html"].to_pylist(), c["host"].to_pylist(), own, strict=True)]
            texts, counted, named = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([c["page_id"], c["url"], pa.array(texts, pa.string()), pa.array(counted, pa.int64()), pa.array(named, pa.int64())],
                                             ["page_id", "url", "text", "n_counted", "n_named"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(extract, f"page_id {kind}, url string, text string, n_counted bigint, n_named bigint")
