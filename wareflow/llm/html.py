"""Main text of HTML pages: element rules, and removal of subtrees that recur across a site's pages."""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Marks, Scratch, bounded, read
from .words import parts

#: A subtree is part of a site's template if so many of its pages with different contents have it, and so large a part of them ...
LEAST_PAGES, LEAST_PART = 10, 0.3
#: ... or so many, whatever the site's size (boxes that rotate); on a site with fewer than LEAST_PAGES pages: so many, and so large a part.
MANY_PAGES, FEW_PAGES, FEW_PART = 100, 3, 0.8
#: So many template subtrees are broadcast as sorted keys (8 MB); beyond that a bitmap picks the pages that are joined with them.
EXACT = 1_000_000

# What these elements hold is never main text.
DROPPED = frozenset("head title script style noscript template nav header footer aside button select option textarea input iframe svg canvas audio video object embed dialog menu map".split())
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe"])
BLOCK = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre address figure figcaption details summary hr form fieldset legend center".split()
) | DROPPED - frozenset(["button", "input", "option", "svg", "map"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that a template can hold inside an article; paragraphs and headings stay whatever recurs.
BOXES = frozenset("section div ul ol dl table figure details fieldset center".split())
CLOSES_P = BLOCK - frozenset("html body".split())
ENDS = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}

_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)(>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
_TOLD = re.compile(r"class|id|role|hidden|style", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_SPACE = re.compile(r"\s+")
#: What names of classes and ids hint at. A name that begins with one of WORDS_BEFORE says what an element has or has not, not what it is.
COMMENTS = frozenset("comment comments disqus respond replies".split())
STRONG = frozenset("ad ads adv advert adverts advertisement sponsor sponsored cookie cookies consent gdpr popup modal overlay".split())
LAYOUT = frozenset("sidebar banner promo promotion notice notices alert footer masthead share sharing social related recommended newsletter subscribe signup widget".split())
LINKS = frozenset("nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar".split())
WORDS_BEFORE = frozenset("with without has have no not non is show hide after before".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar alert dialog alertdialog".split())
#: What is known of an element: no main text for sure, or a hint of one of four kinds.
SURE, HINT_COMMENT, HINT_STRONG, HINT_LAYOUT, HINT_LINKS = 1, 2, 3, 4, 5


class Node:
    """An element: its parts in order (texts and elements), what its names hint at, and what lies in it."""

    __slots__ = ("tag", "hint", "up", "key", "parts", "noise", "article", "soft", "gone", "seen", "size", "links", "paragraphs", "holds")

    def __init__(self, tag: str, hint: int, up: "Node | None"):
        self.tag, self.hint, self.up, self.parts, self.key = tag, hint, up, [], 0
        self.noise = self.article = self.soft = self.gone = self.seen = False
        self.size = self.links = self.paragraphs = self.holds = 0


def _named(value: str) -> int:
    """What the names in a class or id attribute hint at, the surest first (0: nothing)."""
    found = 9
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        if words and words[0] not in WORDS_BEFORE:
            for kind, known in ((HINT_COMMENT, COMMENTS), (HINT_STRONG, STRONG), (HINT_LAYOUT, LAYOUT), (HINT_LINKS, LINKS)):
                if kind < found and not known.isdisjoint(words):
                    found = kind
    return found % 9


def hint_of(tag: str, attributes: str) -> int:
    """SURE if an element is no main text by its tag, role or state; else what its names hint at."""
    if tag in DROPPED:
        return SURE
    found = HINT_LAYOUT if tag == "form" else 0
    if not _TOLD.search(attributes):
        return found
    for m in _ATTR.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return SURE
        if name == "role" and value.strip().lower() in NOISE_ROLES:
            return SURE
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            kind = _named(value)
            found = min(found or 9, kind or 9) % 9
    return found


def parse(page: str | None) -> tuple[list[tuple[str, Node]], list[Node]]:
    """The page's blocks in order, each with its innermost element, and its elements (parents first).

    Markup need not be well formed: block elements end an open paragraph, list items, rows and cells end
    their like, inline elements leave no trace, an article ends a menu left open, and an unclosed
    tag or comment at the end is markup. A quote opens an attribute's value only after its equals sign. Character references are
    decoded after tags are told. Inline elements that are no main text go with all that stands in them, and do not end their block.
    Time is linear in the page's length.
    """
    source = page or ""
    now = root = Node("", 0, None)
    blocks: list[tuple[str, Node]] = []
    nodes, text, at, link, linked, skip = [root], [], 0, 0, 0, []
    count: dict[str, int] = {}
    closes: dict[str, re.Pattern] = {}
    ended: dict[str, int] = {}  # where the last end tag of an inline element stands

    def end_block() -> None:
        nonlocal link, linked
        if text:
            said = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if said:
                blocks.append((said, now))
                now.parts.append(said)
                now.size += len(said)
                now.links += min(linked, len(said))
            text.clear()
        link = linked = 0

    def close(to: Node) -> None:
        """End all elements up to `to`, which stays open."""
        nonlocal now
        end_block()
        skip.clear()
        while now is not to:
            count[now.tag] -= 1
            now = now.up

    def opened(tags, stop=()):
        if not any(count.get(t) for t in tags):
            return None
        n = now
        while n.up is not None and n.tag not in stop:
            if n.tag in tags:
                return n
            n = n.up
        return None

    while m := _TAG.search(source, at):
        if m.start() > at and not skip:
            text.append(source[at : m.start()])
            if link:
                linked += m.start() - at
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag not in BLOCK:
            if skip:  # inside an inline element that goes: only its own kind counts
                if tag == skip[0]:
                    skip[1] += -1 if m[1] else 1
                    if not skip[1]:
                        skip.clear()
                continue
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                link = 0 if m[1] else 1
            if not m[1] and tag not in VOID and not m[3].endswith("/") and (tag in DROPPED or hint_of(tag, m[3]) in (SURE, HINT_STRONG, HINT_LAYOUT, HINT_COMMENT)):
                if tag not in ended:  # what isn't closed once isn't closed further on
                    last = source.lower().rfind(f"</{tag}")
                    ended[tag] = last
                if ended[tag] >= at:
                    skip[:] = [tag, 1]
                    text.append(" ")
            continue
        if m[1]:
            if n := opened((tag,)):
                close(n.up)
            elif tag == "p":
                end_block()
            continue
        if tag in RAW:
            end_block()
            done = closes.setdefault(tag, re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)).search(source, at)
            at = done.end() if done else len(source)
            continue
        if tag == "hr":
            end_block()
            continue
        if tag in CLOSES_P and (n := opened(("p",), ("article", "section", "div", "td", "li", "body"))):
            close(n.up)
        if tag in HEADINGS and (n := opened(tuple(HEADINGS), ("article", "section", "div", "td", "li", "body"))):
            close(n.up)
        if tag in ENDS:
            tags, stop = ENDS[tag]
            while n := opened(tuple(tags.split()), stop):
                close(n.up)
        if tag in ("article", "main") and not (count.get("article") or count.get("main")) and (n := opened(("nav", "head", "header", "footer", "aside", "form"))):
            close(n.up)
        end_block()
        skip.clear()
        new = Node(tag, hint_of(tag, m[3]), now)
        now.parts.append(new)
        nodes.append(new)
        now = new
        count[tag] = count.get(tag, 0) + 1
    if at < len(source) and not skip:
        text.append(source[at:])
    end_block()
    decide(nodes)
    return blocks, nodes


def decide(nodes: list[Node]) -> None:
    """Which elements are noise, and which lie in an article.

    Names are hints only. An element that holds the main element, an article of its own or the page's first-rank heading is never noise by its name,
    nor is one of a layout's name that holds most of the text in several paragraphs; a menu by name is one only if most of its text
    is links. An article is noise by its name only inside another one (a reader's comment, say).
    """
    for n in reversed(nodes):
        n.paragraphs += n.tag == "p" and n.size > 0
        if n.hint != SURE and not (n.tag == "article" and n.hint):
            n.holds |= 2 if n.tag == "main" else 4 if n.tag == "article" else 1 if n.tag == "h1" and n.size else 0
        if n.up is not None and n.hint != SURE:
            n.up.size += n.size
            n.up.links += n.links
            n.up.paragraphs += n.paragraphs
            n.up.holds |= n.holds
    most = nodes[0].size / 2
    for n in nodes[1:]:
        up = n.up
        inside = n.holds & ~4 if n.tag == "article" else n.holds
        noise = n.hint == SURE
        if n.hint == HINT_COMMENT:
            noise = not inside & 3
        elif n.hint == HINT_STRONG:
            noise = not inside
        elif n.hint == HINT_LAYOUT:
            noise = not inside and not (n.size > most and n.paragraphs > 1)
        elif n.hint == HINT_LINKS:
            noise = not inside and 2 * n.links >= n.size
        if n.tag == "article" and n.hint != SURE and not up.article:
            noise = False
        n.soft = up.soft or (n.tag == "header" and up.article and not up.noise)  # an article's own heading may stand in a header of its own
        n.noise = (up.noise or noise) and not (n.tag in HEADINGS and up.soft and not noise)
        n.article = up.article or (n.tag in ("article", "main") and not n.noise)


def hash_subtrees(host: str, nodes: list[Node]) -> None:
    """Give each element a key of host, tag and all that stands below it."""
    for n in reversed(nodes):
        h = xxhash.xxh3_64(f"{host}\n{n.tag}\n")
        for p in n.parts:
            h.update(p.key.to_bytes(8, "little") if isinstance(p, Node) else p.encode("utf-8", "surrogatepass"))
            h.update(b"\0")
        n.key = h.intdigest()


def kept_blocks(blocks: list[tuple[str, Node]]) -> tuple[list[tuple[str, Node]], bool]:
    """The blocks that are no noise, those in an article only if the page has one; and whether it has."""
    whole = any(n.article for _, n in blocks if not n.noise)
    return [(said, n) for said, n in blocks if not n.noise and (n.article or not whole)], whole


def candidates(blocks: list[tuple[str, Node]]) -> list[Node]:
    """The elements whose recurrence could change a page's text: boxes that hold kept blocks."""
    kept, whole = kept_blocks(blocks)
    found = []
    for _, n in kept:
        while n.up is not None and not n.seen:
            n.seen = True
            if n.tag in BOXES or (not whole and n.tag in ("p", *HEADINGS)):
                found.append(n)
            n = n.up
    return found


def main_text(blocks: list[tuple[str, Node]], nodes: list[Node], template: set[int]) -> str:
    """The kept blocks that lie in no template subtree, joined by an empty line."""
    for n in nodes[1:]:
        n.gone = n.up.gone or n.key in template
    return "\n\n".join(said for said, n in kept_blocks(blocks)[0] if not n.gone)


def host_of(url):
    """Host of a URL column, lower-cased; null and odd URLs share the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _signed(keys) -> pa.Array:
    return pa.array(np.array(keys, dtype=np.uint64).view(np.int64))


def template_keys(pages: DataFrame, kept: Scratch, least_pages: int = LEAST_PAGES, least_part: float = LEAST_PART) -> DataFrame:
    """The keys of the subtrees that recur across the pages of a host (host and html), a row a key.

    Each page gives its boxes once; copies of a page count once. Counts are aggregates by host and subtree.
    """

    def subtrees(batches):
        for b in parts(batches, "html"):
            hosts, keys, contents = [], [], []
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                blocks, nodes = parse(page)
                hash_subtrees(host, nodes)
                found = candidates(blocks)
                hosts += [host] * (len(found) + 1)
                keys += [nodes[0].key] + [n.key for n in found]
                contents += [nodes[0].key] * (len(found) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), _signed(keys), _signed(contents)], names=["host", "key", "content"])

    seen = kept.save(pages.select("host", "html").mapInArrow(subtrees, "host string, key long, content long").distinct(), "html-subtrees")
    pages_of = seen.filter("key = content").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    n, whole = F.col("n"), F.col("pages")
    counts = seen.filter("key <> content").groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(n >= FEW_PAGES)
    often = (n >= MANY_PAGES) | ((n >= least_pages) & (n >= least_part * whole)) | ((whole < least_pages) & (n >= FEW_PART * whole))
    template = kept.save(counts.join(pages_of, "host").filter(often).select("key").distinct(), "html-template")
    kept.drop(seen)
    return template


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_part: float = LEAST_PART, exact: int = EXACT) -> DataFrame:
    """page_id, url and text of every page.

    An element goes if its tag, role or state says that it is no main text, or its names do (see decide()); if a page has an
    article or main element, only what lies in it counts. Of what is left, boxes go whose subtree (tag
    and all text below) recurs across the host, counted in Spark: in `least_pages` pages with different contents and `least_part` of
    them, or in MANY_PAGES, or in nearly all of a host's few pages. Copies of a page count once. In an article, paragraphs and
    headings stay even if they recur. Null and empty html gives an empty text, and so does a page without
    main text. Rows that repeat are extracted alike. Up to `exact` template subtrees are broadcast, and no page is shuffled; beyond that, pages that a
    bitmap marks are joined with them, to the same result.
    """
    bounded(pages.sparkSession)
    kept, send = Scratch(), pages.sparkSession.sparkContext.broadcast
    slim = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    template = template_keys(slim, kept, least_pages, least_part)

    if template.count() <= exact:
        sent = send(np.sort(np.array([r["key"] for r in template.collect()], dtype=np.int64)))
        kept.drop(template)

        def texts(batches):
            known = sent.value
            for b in parts(batches, "html"):
                said = []
                for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                    blocks, nodes = parse(page)
                    hash_subtrees(host, nodes)
                    keys = np.array([n.key for n in nodes], dtype=np.uint64).view(np.int64)
                    hit = known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool)
                    said.append(main_text(blocks, nodes, {nodes[i].key for i in np.flatnonzero(hit)}))
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(said, pa.string())], names=["page_id", "url", "text"])

        return slim.mapInArrow(texts, schema)

    marks = send(Marks(template))

    def first(batches):
        for b in parts(batches, "html"):
            said, marked = [], []
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                blocks, nodes = parse(page)
                hash_subtrees(host, nodes)
                keys = np.array([n.key for n in candidates(blocks)], dtype=np.uint64).view(np.int64)
                marked.append(keys[marks.value.hit(keys)].tolist())
                said.append(main_text(blocks, nodes, set()))
            html = pa.array([h if m else None for h, m in zip(b.column("html").to_pylist(), marked, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(x) for x in ("page_id", "url", "host")], html, pa.array(said, pa.string()), pa.array(marked, pa.list_(pa.int64()))], names=["page_id", "url", "host", "html", "text", "marked"])

    told = kept.save(slim.mapInArrow(first, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, html string, text string, marked array<long>"), "html-first")
    odd = told.filter(F.size("marked") > 0).withColumn("row", F.xxhash64("page_id", "url", "html"))
    true = odd.select("row", F.explode("marked").alias("key")).distinct().join(template, "key").groupBy("row").agg(F.collect_set("key").alias("drop"))  # elements of one page

    def again(batches):
        for b in parts(batches, "html"):
            out = []
            for host, page, gone in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), b.column("drop").to_pylist(), strict=True):
                blocks, nodes = parse(page)
                hash_subtrees(host, nodes)
                out.append(main_text(blocks, nodes, {x % (1 << 64) for x in gone or []}))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    mended = odd.join(true, "row", "left").select("page_id", "url", "host", "html", "drop").mapInArrow(again, schema)
    return kept.result(told.filter(F.size("marked") == 0).select("page_id", "url", "text").unionByName(mended), "html-texts")


def op7_main_text(spark, sf_dir):
    """Main text of every page: page_id, url, text (empty if none), n_chars (long, code points); a row a row of pages."""
    found = extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
