"""Main text of web pages by a style tree per site.

Each page is read into a tree of elements; an element's style is its chain of tags and
classes from the body down. The trees of a host are merged by style: for every style the
pages that have it are counted, how their child lists differ (presentation) and how the
texts below differ (content). Entropy turns both into an importance: a branch that shows
the same on most pages of the site scores near 0, one that is new on every page near 1.
Branches of low importance go from each page, and so do those whose element says what
they are: menus, headers, footers, sidebars, notices, adverts, forms, reader comments.
What stays inside the article (or, without one, the element with most of the paragraphs'
text) is the main text.
"""

from __future__ import annotations

import html
import re
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conduit.llm.common import batch, ship
from conduit.session import cut_lineage

LEAST_PAGES = 5  # of a host, before its repeated texts mean anything
LOW = 0.2  # importance below which a branch goes
PRESENTATION = 0.1  # its share in a branch's importance

DEEPEST = 512  # open elements; what opens beyond hangs on the last of them, or on the first menu or the like beyond

# Element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg annotation canvas textarea title select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
NOISE_TAGS = frozenset("nav footer aside form dialog menu button label search head".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adsense adslot banner promo promoted promotion sponsor sponsored "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer footers "
    "masthead topbar toolbar cookie cookies consent gdpr notice notices alert alerts notification popup modal "
    "overlay newsletter subscribe subscription signup login search share sharing social related recommended "
    "recommendations comment comments commentlist disqus reply replies respond pagination pager copyright "
    "disclaimer".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MAIN_WORDS = frozenset("article content post entry story main".split())
# Of an element that lays out a page, such words tell what it has, not what it is.
LAYOUT_WORDS = frozenset("wrapper container layout page content main row grid has with without no".split())
HEADER_WORDS = frozenset("header headers".split())
# An open element of the key is closed by the start of one of the values.
CLOSED_BY = {
    "p": BLOCK,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
# What an end tag, or the implied end of an element, does not reach beyond.
WALLS = frozenset("html body table td th ul ol dl article main section div".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}


class _Beyond:
    """The open elements beyond DEEPEST, with places of tags, walls, blocks and noise at hand."""

    def __init__(self):
        self.open: list[tuple[int, list[list[int]]]] = []  # element and the lists that hold its place
        self.by_tag: dict[str, list[int]] = {}
        self.walls, self.blocks, self.noise = [], [], []

    def push(self, node: int, tag: str, noise: bool) -> None:
        lists = [self.by_tag.setdefault(tag, [])]
        lists += [x for x, is_in in ((self.walls, tag in WALLS), (self.blocks, tag in BLOCK), (self.noise, noise)) if is_in]
        for x in lists:
            x.append(len(self.open))
        self.open.append((node, lists))

    def cut(self, place: int = 0) -> None:
        while len(self.open) > place:
            for x in self.open.pop()[1]:
                x.pop()

    def close(self, tag: str) -> bool:
        """Whether an end tag ends here: at its own element, or at a wall it doesn't reach beyond."""
        wall = self.walls[-1] if self.walls else -1
        places = self.by_tag.get(tag)
        if places and (tag in WALLS or places[-1] >= wall):
            self.cut(places[-1])
            return True
        return wall >= 0 and tag not in WALLS


class Page:
    """A page's elements, as lists by number, and its blocks of text."""

    def __init__(self, source: str):
        self.parent, self.tag, self.noise, self.style = [-1], ["html"], [False], [0]
        self.main, self.children, self.header = [False], [[]], [False]
        self.blocks: list[tuple[int, str]] = []  # element and text
        self._read(source)

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        look = tag
        noise = tag in NOISE_TAGS
        header = tag == "header"
        main = tag in ("article", "main")
        if attributes and not attributes.isspace():
            words: set[str] = set()
            for name, *values in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name in ("class", "id"):
                    words.update(w.lower() for w in _WORD.findall(value))
                    if name == "class":
                        look += "." + value
                elif name == "role":
                    noise |= value.lower() in NOISE_ROLES
                    main |= value.lower() == "main"
                elif name == "style":
                    noise |= "display:none" in value.replace(" ", "").lower()
                elif name == "hidden" or value.lower() == "true":
                    noise = True
            if tag not in ("body", "html"):
                noise |= bool(words & NOISE_WORDS) and not words & LAYOUT_WORDS and tag not in ("article", "main")
                header |= bool(words & HEADER_WORDS)
                if tag == "article" and words & {"comment", "reply", "ad", "promo", "sponsored"}:
                    noise = True
            main |= bool(words & MAIN_WORDS) and tag in ("div", "section", "td")
        self.parent.append(parent)
        self.tag.append(tag)
        self.noise.append(noise)
        self.header.append(header)
        self.main.append(main)
        self.style.append(zlib.crc32(look.encode(), self.style[parent]))
        self.children.append([])
        self.children[parent].append(tag)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack, held, at = [0], [], 0
        tags = self.tag
        beyond = _Beyond()

        def flush():
            if held:
                text = " ".join(html.unescape("".join(held)).split())
                held.clear()
                if text and beyond.blocks:
                    self.blocks.append((beyond.open[beyond.blocks[-1]][0], text))
                elif text and beyond.noise:
                    self.blocks.append((beyond.open[beyond.noise[0]][0], text))
                elif text:
                    k = len(stack) - 1
                    while k and tags[stack[k]] not in BLOCK:
                        k -= 1
                    self.blocks.append((stack[k], text))

        for_token = _TOKEN.search
        while True:
            found = for_token(source, at)
            if not found:
                held.append(source[at:])
                break
            begin, end = found.span()
            if begin > at:
                held.append(source[at:begin])
            at = end
            tag = found[2] or found[5]
            if not tag:
                continue
            tag, closing = tag.lower(), found[1] or found[4]
            if closing:
                if tag in BLOCK:
                    flush()
                if beyond.close(tag):
                    continue
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] == tag:
                        del stack[k:]
                        beyond.cut()
                        break
                    if tags[stack[k]] in WALLS and tag not in WALLS:
                        break
                continue
            attributes = found[3] if found[2] else found[6]
            if tag in RAW:
                if not attributes.endswith("/"):
                    stop = _RAW_END[tag].search(source, at)
                    at = stop.end() if stop else len(source)
                continue
            if tag in ("br", "hr"):
                held.append(" ")
                if tag == "br":
                    continue
            if tag in BLOCK:
                flush()
            if tag in VOID:
                continue
            if beyond.open and tag in CLOSED_BY.get(tags[beyond.open[-1][0]], ()):
                beyond.cut(len(beyond.open) - 1)
            for k in range(len(stack) - 1, 0, -1):
                if beyond.walls:
                    break
                open_tag = tags[stack[k]]
                if tag in CLOSED_BY.get(open_tag, ()):
                    del stack[k:]
                    beyond.cut()
                    break
                if open_tag in WALLS:
                    break
            if len(stack) >= DEEPEST:
                if not attributes.endswith("/") or tag in BLOCK:
                    parent = beyond.open[beyond.noise[0]][0] if beyond.noise else stack[-1]
                    node = self._open(parent, tag, attributes)
                    beyond.push(node, tag, self.noise[node])
                continue
            stack.append(self._open(stack[-1], tag, attributes))
            if attributes.endswith("/") and tag not in BLOCK:
                stack.pop()
        flush()

    def shown(self) -> list[bool]:
        """Which elements lie in no branch that says it is none of the article's."""
        size = [0] * len(self.tag)
        for node, text in self.blocks:
            size[node] += len(text)
        whole = [False] * len(self.tag)  # elements that hold an article
        for node in range(len(self.tag) - 1, 0, -1):
            size[self.parent[node]] += size[node]
            whole[self.parent[node]] |= whole[node] or self.tag[node] in ("article", "main")
        out = [True] * len(self.tag)
        inside = [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            above = self.parent[node]
            inside[node] = inside[above] or self.tag[node] in ("article", "main")
            noise = self.noise[node] and not (whole[node] and self.tag[node] not in NOISE_TAGS)
            # a header is the site's outside an article; the article's own has its title
            noise |= self.header[node] and not inside[node] and not whole[node]
            out[node] = out[above] and not noise
        return out

    def text(self, low: frozenset = frozenset()) -> str:
        """The blocks of the article, in page order, without those of unimportant styles."""
        shown = self.shown()
        blocks = [(n, t) for n, t in self.blocks if shown[n]]
        kept = [(n, t) for n, t in blocks if self.style[n] not in low]
        if sum(len(t) for _, t in kept) * 2 >= sum(len(t) for _, t in blocks):
            blocks = kept  # a style that holds most of a page is no decoration of it
        root = self._root(blocks, shown)
        return "\n".join(t for n, t in blocks if self._below(n, root))

    def _below(self, node: int, root: int) -> bool:
        while node > root:
            node = self.parent[node]
        return node == root

    def _root(self, blocks, shown) -> int:
        size = [0] * len(self.tag)
        prose = [0] * len(self.tag)
        for node, text in blocks:
            size[node] += len(text)
            if self.tag[node] in ("p", "pre", "blockquote", "li", "td"):
                prose[node] += len(text)
        for node in range(len(self.tag) - 1, 0, -1):
            size[self.parent[node]] += size[node]
            prose[self.parent[node]] += prose[node]
        for tags in (("article",), ("main",)):
            found = [n for n in range(1, len(self.tag)) if self.tag[n] in tags and shown[n] and size[n]]
            if found:
                return max(found, key=lambda n: (size[n], -n))
        held = prose if prose[0] * 2 >= size[0] else size
        found = [n for n in range(1, len(self.tag)) if self.main[n] and shown[n] and held[n] * 2 > held[0]]
        if found:
            return min(found, key=lambda n: (held[n], -n))
        root = 0
        for node in range(1, len(self.tag)):  # the deepest element with most of it all
            if held[node] * 10 >= held[0] * 7 and self.tag[node] not in ("p", "li", "td", "tr", "pre", "blockquote"):
                if held[node] and self._below(node, root):
                    root = node
        return root


def host_of(url: str | None) -> str:
    found = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


_SEEN = pa.schema(
    [
        ("host", pa.string()),
        ("page", pa.int64()),
        ("styles", pa.list_(pa.int64())),
        ("texts", pa.list_(pa.int64())),
        ("shapes", pa.list_(pa.int64())),
    ]
)


def _seen_batches(batches):
    """A page's styles with the texts they show (a hash) and the child lists they have."""
    for found in batches:
        out = []
        for url, source in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
            page = Page(source or "")
            rows = dict.fromkeys(
                (page.style[n], xxhash.xxh64_intdigest(t) >> 1, zlib.crc32(",".join(page.children[page.parent[n]]).encode()))
                for n, t in page.blocks
            )
            styles, texts, shapes = zip(*rows) if rows else ((), (), ())
            name = xxhash.xxh64_intdigest(repr(list(rows))) >> 1
            out.append((host_of(url), name, list(styles), list(texts), list(shapes)))
        if out:
            yield batch(_SEEN, **dict(zip(_SEEN.names, zip(*out))))


def importance(pages: DataFrame) -> DataFrame:
    """``(host, style, importance)`` of the merged tree of each host, 0 to 1.

    Copies of a page count once. A style's content is new to the extent that its texts
    stand on few pages: the entropy of a text over the pages that show it, in units of
    the largest possible, averaged over all showings and taken from 1. Its presentation
    is the entropy of the child lists it stands in.
    """
    ship(pages.sparkSession)
    seen = pages.select("url", "html").mapInArrow(
        _seen_batches, "host string, page long, styles array<long>, texts array<long>, shapes array<long>"
    )
    one = seen.groupBy("host", "page").agg(
        F.first("styles").alias("styles"), F.first("texts").alias("texts"), F.first("shapes").alias("shapes")
    )
    one = cut_lineage(one, "styles")
    hosts = one.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST_PAGES)
    rows = one.select("host", "page", F.explode(F.arrays_zip("styles", "texts", "shapes")).alias("x"))
    rows = rows.select("host", "page", F.col("x.styles").alias("style"), F.col("x.texts").alias("text"), F.col("x.shapes").alias("shape"))
    k = F.col("k")
    content = rows.groupBy("host", "style", "text").agg(F.count("*").alias("k"))
    content = content.groupBy("host", "style").agg((F.sum(k * F.log(k)) / F.sum(k)).alias("same"))
    shapes = rows.groupBy("host", "style", "shape").agg(F.count("*").alias("k"))
    shapes = shapes.groupBy("host", "style").agg(F.sum(k).alias("n"), F.sum(k * F.log(k)).alias("s"))
    shapes = shapes.select("host", "style", (F.log("n") - F.col("s") / F.col("n")).alias("varied"))
    whole = F.log(F.col("pages"))
    new = F.lit(1.0) - F.least(F.col("same") / whole, F.lit(1.0))
    looks = F.least(F.col("varied") / whole, F.lit(1.0))
    return (
        content.join(shapes, ["host", "style"])
        .join(hosts, "host")
        .select("host", "style", ((1 - PRESENTATION) * new + PRESENTATION * looks).alias("importance"))
    )


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _text_batches(batches):
    for found in batches:
        texts = [
            Page(source or "").text(frozenset(low or ()))
            for source, low in zip(found.column(2).to_pylist(), found.column(3).to_pylist())
        ]
        yield batch(
            _TEXTS,
            page_id=found.column(0),
            url=found.column(1).cast(pa.string()),
            text=texts,
            n_chars=[len(t) for t in texts],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages``.

    Null and empty html gives an empty text, and so does a page without any text of an
    article. Null urls are one host without a name. Repeated rows come out alike; other
    columns play no part; an empty table gives an empty result.
    """
    ship(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    low = importance(pages).where(F.col("importance") < LOW)
    # written, so that a few sites are broadcast and many are a side that can be split
    low = cut_lineage(low.groupBy(F.col("host").alias("site")).agg(F.collect_set("style").alias("low")), "low")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.join(low, host == F.col("site"), "left").select("page_id", "url", "html", "low")
    return rows.mapInArrow(_text_batches, "page_id long, url string, text string, n_chars long")
