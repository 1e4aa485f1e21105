"""Main-text extraction by consensus: pages vote for their best container's path, hosts decide.

1. Every page's containers are scored: the length of their own text blocks, less that of links, with half
   weight handed up for each level; containers that are menus, headers, footers, asides, forms, adverts, notices or
   comments by tag, role, class or id score nothing, and nor does what they hold. A name rules out no container that
   has most of a page's unlinked text (100 characters at least, or an article element) and five times as much as is left. Of an article's own header the
   headlines and longer paragraphs count.
2. A page votes for the path of its best container: tags with classes and ids from the body down, digits
   generalised; an article or main element around it stands for it, else the outermost container named as an
   article, and what then holds besides it only headings (plain text, too, where no name tells). Votes are counted for each host in Spark.
3. Every page is read again by the most voted path of its host that it has, however many its host has; a page whose
   path has no text there is read by its own best container.

Text: blocks in page order joined by one line feed; white space within a block is one space; character
references are decoded; a line-break tag counts as white space. Nothing else is dropped.

Defined cases: a null or empty html, and one without text, gives the empty text; a null url has the empty host; repeated
rows each vote and are each extracted; unclosed tags end with their parent; an empty table gives an
empty result; only page_id, url and html are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomtide.llm.support import column_rows, ship, stored

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "script style noscript template iframe svg math canvas object audio video head title nav aside form button select "
    "textarea fieldset dialog menu footer".split()
)
# Words in class, id or role that tell what is not the article.
OUTSIDE = frozenset(
    "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs topbar footer sidebar sidebars aside "
    "complementary widget widgets ad ads adv advert adverts advertisement advertising advertorial adsense sponsor sponsored sponsors "
    "promo promos promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup signin login share sharing social related recommended recommendations "
    "comment comments commentlist disqus respond reply replies discussion form search searchform toolbar pagination pager "
    "contentinfo skip hidden "
    "menue seitenleiste fusszeile werbung anzeige anzeigen kommentar kommentare antworten teilen anmeldung suche "
    "publicite pub commentaire commentaires partager recherche inscription "
    "publicidad anuncio anuncios comentario comentarios compartir buscar registro".split()
)
# A class such as has-sidebar tells of a layout and not of the element.
MODIFIERS = frozenset(["has", "with", "no", "without"])
HEADER = frozenset(["header", "masthead"])
ARTICLE = frozenset("article post entry story artikel beitrag articulo noticia".split())
INSIDE = frozenset("article main content body post entry story text page".split())
CLOSED_BY = {
    "p": frozenset(
        "p div article section ul ol dl table blockquote pre h1 h2 h3 h4 h5 h6 header footer nav aside form main hr address "
        "figure fieldset details li".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option", "optgroup"]),
}
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
HANDED_UP = 0.5
MOST_LINKED = 0.3  # of a plain block's text
LEFT_OVER = 5  # a container ruled out by name comes back if it has this many times what is left
LEAST_TEXT = 100  # characters, less than which no such container comes back
LEAD = 60  # characters of a paragraph that belongs to the article though it stands in the article's header
BROADCAST_VOTES = 1_000_000  # 16 bytes each in every Python worker; beyond it a shuffled join


@lru_cache(maxsize=4096)
def _words(names: str) -> frozenset[str]:
    return frozenset(w.lower() for w in WORDS.findall(names))


@lru_cache(maxsize=4096)
def _names_outside(names: str) -> bool:
    return any(w & OUTSIDE and not w & MODIFIERS for w in map(_words, names.split()))


@lru_cache(maxsize=4096)
def _step(tag: str, names: str) -> str:
    """A path's step: tag, classes and id, digits generalised."""
    general = ".".join(sorted(set(re.sub(r"\d+", "#", names).split())))
    return f"{tag}.{general}" if general else tag


class Node:
    __slots__ = ("tag", "path", "dropped", "by_name", "outside", "hint", "score", "parent", "header", "article", "named", "held")

    def __init__(self, tag: str, path: str, parent: Node | None, dropped: bool, by_name: bool, hint: float, header: bool,
                 article: bool, named: bool = False):
        self.tag, self.path, self.parent, self.dropped, self.by_name, self.hint = tag, path, parent, dropped, by_name, hint
        self.header, self.article, self.named = header, article, named
        self.outside, self.score, self.held = False, 0.0, 0


class Page(HTMLParser):
    """A page's text blocks in order, each under its innermost container."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        root = Node("", "", None, False, False, 0.0, False, False)
        self.stack, self.nodes, self.blocks = [root], [root], []
        self.pieces, self.linked, self.in_link, self.skipped = [], 0, 0, 0
        self.feed(html)
        self.close()
        self._end_block()
        self._rule_out()

    def _rule_out(self):
        """Settle which containers are outside, and keep the other ones' blocks."""
        for node, text, linked in self.blocks:
            while node is not None:
                node.held += len(text) - linked
                node = node.parent
        total, around = self.nodes[0].held, set()
        for node in self.nodes:
            while node.held and node.parent is not None and (node.tag in ("article", "main") or id(node) in around):
                around.add(id(node))
                node = node.parent
                around.add(id(node))
        while True:
            for node in self.nodes[1:]:  # parents come first
                node.outside = node.dropped or node.by_name or node.parent.outside
            left = sum(len(text) - linked for node, text, linked in self.blocks if not node.outside)
            named = [n for n in self.nodes[1:] if n.by_name and not n.dropped and not n.parent.outside]
            largest = max(named, key=lambda n: n.held, default=None)
            if largest is None or largest.held < LEFT_OVER * left or 2 * largest.held <= total:
                break
            if largest.held < LEAST_TEXT and id(largest) not in around:
                break
            largest.by_name = False
        self.blocks = [block for block in self.blocks if not block[0].outside]

    def _end_block(self):
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((self.stack[-1], text, min(self.linked, len(text))))
            self.pieces, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            if tag == "br":
                self.pieces.append(" ")
            elif tag == "a":
                self.in_link += 1
            if not any(n in ("hidden", "class", "id", "role", "style") for n, _ in attrs) or tag == "br":
                return
            if not any(self._outside(tag, attrs)):
                return
            # An inline element that is no part of the article is a container of its own.
        while len(self.stack) > 1 and tag in CLOSED_BY.get(self.stack[-1].tag, ()):
            self._pop()
        self._end_block()
        if tag in VOID or tag in ("html", "body"):
            return
        parent = self.stack[-1]
        given = {n: v or "" for n, v in attrs if n in ("class", "id")}
        names = f"{given.get('class', '')} {given.get('id', '')}".strip()
        dropped, by_name = self._outside(tag, attrs)
        words = _words(names)
        hint = 2.0 if tag in ("article", "main") else 1.3 if words & INSIDE else 1.0
        header = parent.header or tag == "header" or (bool(words & HEADER) and tag not in HEADINGS and tag not in ("article", "main"))
        article = parent.article or tag in ("article", "main") or bool(words & ARTICLE)
        node = Node(tag, f"{parent.path}>{_step(tag, names)}", parent, parent.dropped or dropped, by_name, hint, header, article, bool(words & ARTICLE))
        self.stack.append(node)
        self.nodes.append(node)

    def _outside(self, tag, attrs) -> tuple[bool, bool]:
        """Whether an element is outside for certain, by its tag or because it is hidden, and whether by a name."""
        if tag in DROPPED:
            return True, False
        by_name = False
        for name, value in attrs:
            value = value or ""
            if name in ("class", "id", "role") and _names_outside(value):
                # A headline's or an article's own class may carry such a word; a container's decides.
                by_name = by_name or tag not in HEADINGS and tag not in ("main",) and not (tag == "article" and not _words(value) & {"comment", "comments", "reply", "related", "ad", "ads", "advert", "sponsored", "promo", "widget"})
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True, False
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True, False
        return False, by_name

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def _pop(self):
        self._end_block()
        self.stack.pop()

    def handle_endtag(self, tag):
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in INLINE:
            if self.stack[-1].tag == tag:
                self._pop()
            return
        if tag == "br":
            self.pieces.append(" ")
        elif tag in ("html", "body"):
            self._end_block()
        elif any(n.tag == tag for n in self.stack[1:]):
            while self.stack[-1].tag != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        if not self.stack[-1].dropped:
            self.pieces.append(data)
            if self.in_link:
                self.linked += len(data)

    @staticmethod
    def _counts(node: Node, text: str, linked: int) -> bool:
        """A page's header is outside the article; of an article's header the headlines and lead paragraphs belong to it."""
        if not node.header:
            return True
        lead = node.tag == "p" and len(text) >= LEAD and linked <= MOST_LINKED * len(text)
        return node.article and (node.tag in HEADINGS or lead)

    def best_path(self) -> str | None:
        """The path of the best container; None for a page without text. The root's path is empty."""
        top = None
        for node, text, linked in self.blocks:
            if not self._counts(node, text, linked):
                continue
            worth = (len(text) - linked) * (1.0 if len(text) >= 25 else 0.3)
            if node.tag in ("p", "li", "pre", "blockquote", "td", "th", "dt", "dd", "tr", "ul", "ol", "table", "tbody") or node.tag in HEADINGS:
                node = node.parent
            while node:
                node.score += worth
                worth *= HANDED_UP if node.tag not in ("ul", "ol", "table", "tbody", "tr", "dl", "blockquote", "figure") else 1.0
                node = node.parent
        for node in self.nodes:
            if node.score > 0 and (top is None or node.score * max(node.hint, 1.0) > top.score * max(top.hint, 1.0)):
                top = node
        # A container within an article is a part of it: a headline may stand beside it.
        for tag in ("article", "main"):
            node = top
            while node is not None:
                if node.tag == tag:
                    return node.path
                node = node.parent
        return None if top is None else self._whole(top).path

    def _whole(self, top: Node) -> Node:
        """The container that has the rest of the article whose largest part is ``top``."""
        chain = [top]
        while chain[-1].parent is not None:
            chain.append(chain[-1].parent)
        named = [level for level, node in enumerate(chain) if node.named]
        level = named[-1] if named else 0
        levels = {id(node): k for k, node in enumerate(chain)}
        rest: dict[int, list] = {}
        for node, text, linked in self.blocks:
            if self._counts(node, text, linked):
                at = node
                while id(at) not in levels:
                    at = at.parent
                rest.setdefault(levels[id(at)], []).append((node, text, linked))
        # The root is no container: beside it stands all that the page has.
        for above in range(level + 1, len(chain) - 1):
            beside = rest.get(above, ())
            if any(
                node.tag not in HEADINGS and (named or node.article or linked > MOST_LINKED * len(text))
                for node, text, linked in beside
            ):
                break
            if beside:
                level = above
        return chain[level]

    def text_under(self, path: str) -> str:
        """Blocks of all containers of this path."""
        out = []
        for node, text, linked in self.blocks:
            if self._counts(node, text, linked):
                at = node
                while at is not None and at.path != path:
                    at = at.parent
                if at is not None:
                    out.append(text)
        return "\n".join(out)

    def paths(self) -> set[str]:
        return {n.path for n in self.nodes if not n.outside}


def _host(url: str | None) -> str:
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return found[1].rpartition("@")[2].lower() if found else ""


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes): each page votes once, counted within each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for urls, htmls in column_rows(batches, "url", "html"):
            cast = [(_host(u), Page(h).best_path()) for u, h in zip(urls, htmls) if h]
            cast = [c for c in cast if c[1] is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in cast], pa.string()), pa.array([c[1] for c in cast], pa.string())], ["host", "path"]
            )

    ship(pages.sparkSession)
    counted = pages.select("url", "html").mapInArrow(run, "host string, path string")
    return counted.groupBy("host", "path").agg(F.count("*").alias("votes"))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): all voted paths of a host, the most voted first, of equal ones the most specific."""
    order = F.struct((-F.col("votes")).alias("votes"), (-F.length("path")).alias("length"), "path")
    listed = F.array_sort(F.collect_list(order))
    return votes(pages).groupBy("host").agg(F.transform(listed, lambda p: p["path"]).alias("paths"))


def _mark(host: str, path: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{host}\n{path}")


def _by_marks(counted: DataFrame):
    """A function (host, paths) -> the best voted of these paths or None, from all votes as two sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hosts, paths, given in column_rows(batches, "host", "path", "votes"):
            marks = np.array([_mark(h, p) for h, p in zip(hosts, paths)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(marks), pa.array(given, pa.int64())], ["mark", "votes"])

    table = counted.mapInArrow(run, "mark long, votes long").toArrow()
    marks = table["mark"].to_numpy().view(np.uint64)
    order = np.argsort(marks)
    held = counted.sparkSession.sparkContext.broadcast((marks[order], table["votes"].to_numpy()[order]))

    def choose(host: str, paths: set[str]) -> str | None:
        marks, given = held.value
        there = list(paths)
        if not len(marks) or not there:
            return None
        wanted = np.array([_mark(host, p) for p in there], np.uint64)
        at = np.minimum(np.searchsorted(marks, wanted), len(marks) - 1)
        voted = [(-int(given[k]), -len(p), p) for k, p, known in zip(at, there, marks[at] == wanted) if known]
        return min(voted)[2] if voted else None

    return choose


def _by_join(pages: DataFrame, counted: DataFrame) -> DataFrame:
    """(host, key, path) of each host and html: of the paths that the html has, the best voted one of the host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, hosts, htmls in column_rows(batches, "key", "host", "html"):
            rows = [(k, h, p) for k, h, html in zip(keys, hosts, htmls) if html for p in Page(html).paths()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.string())], ["key", "host", "path"]
            )

    own = pages.select("key", "host", "html").mapInArrow(run, "key long, host string, path string")
    order = F.struct((-F.col("votes")).alias("votes"), (-F.length("path")).alias("length"), "path")
    return own.join(counted, ["host", "path"]).groupBy("host", "key").agg(F.min(order)["path"].alias("chosen"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship(pages.sparkSession)
    counted = stored(votes(pages), "votes")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#]*@)?([^/?#@]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn("host", host)
    choose = None
    if counted.limit(BROADCAST_VOTES + 1).count() <= BROADCAST_VOTES:
        choose = _by_marks(counted)
        rows = rows.withColumn("chosen", F.lit(None).cast("string"))
    else:
        rows = rows.withColumn("key", F.xxhash64("html"))
        rows = rows.join(stored(_by_join(rows, counted), "chosen-paths"), ["host", "key"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, htmls, hosts, chosen in column_rows(batches, "page_id", "url", "html", "host", "chosen"):
            texts = []
            for html, host, path in zip(htmls, hosts, chosen):
                page = Page(html) if html else None
                if page is None:
                    texts.append("")
                    continue
                if choose is not None:
                    path = choose(host, page.paths())
                text = page.text_under(path) if path is not None else ""
                if not text:
                    own = page.best_path()
                    text = page.text_under(own) if own is not None else ""
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.select("page_id", "url", "html", "host", "chosen").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
