"""Main text of web pages: what is in the article, without what its site repeats.

First pass: each page's element subtrees are hashed, and Spark counts by host on how many different pages a subtree stands.  Second
pass: subtrees that recur on a large share of their host's pages are deleted, and the blocks that remain are the text.  Menus, footers,
adverts, forms and the like go by their tags, roles and names in both passes, whether or not their site repeats them.

Copies of one page are no site template: pages of a host count once for each different longest block.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limes.llm.common import columns, few, join_counted, stored

#: A subtree is a template if it stands on so many different pages of its host, and on this share of them.
LEAST, SHARE = 5, 0.25

TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?![A-Za-z])[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)", re.DOTALL)
QUOTE = re.compile(r"=\s*([\"'])")
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"

#: Kinds of elements. Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: A tag that begins ends these elements, up to those at which it stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
ENDS |= {k: ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}) for k in ("thead", "tbody", "tfoot")}

#: What is no article, by tag, by role, and by a word in its class or id.
NO_TAGS = frozenset("nav footer aside form script style noscript template iframe object svg canvas audio video button select textarea dialog menu head title xmp noembed noframes".split())
NO_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NO_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments disqus respond reply replies pagination pager skip toolbar widget".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def tag_end(html: str, at: int) -> int:
    """Where the tag ends whose attributes begin at `at`: at the first > outside quoted values, at the first of all if a value never ends, or -1."""
    first = end = html.find(">", at)
    while end >= 0 and (m := QUOTE.search(html, at, end)):
        at = html.find(m[1], m.end()) + 1
        if not at:
            return first
        if at > end:
            end = html.find(">", at)
    return end


class Page:
    """A page's elements in page order: tag, attributes, parent, and children, which are elements' numbers or texts; 0 is the page itself."""

    def __init__(self, html: str):
        self.tag, self.attributes, self.parent, self.children = [""], [{}], [-1], [[]]
        self.open, self.names = [0], Counter()
        at = 0
        while m := TOKEN.search(html, at):
            if m.start() > at:
                self.children[self.open[-1]].append(html[at : m.start()])
            at = m.end()
            if m[1]:
                self.children[self.open[-1]].append(m[1].replace("&", "&amp;"))
            if m[3] is None:
                continue
            end = at if html.startswith(">", at) else tag_end(html, at)
            if end < 0:  # a tag that never ends is no tag
                self.children[self.open[-1]].append(html[m.start() :])
                return
            name, rest, at = m[3].lower(), html[at:end], end + 1
            if m[2]:
                self.close(name)
            else:
                at = self.begin(name, rest, html, at)
        if at < len(html):
            self.children[self.open[-1]].append(html[at:])

    def begin(self, name: str, rest: str, html: str, at: int) -> int:
        self.make_room(name)
        number, up = len(self.tag), self.open[-1]
        self.tag.append(name)
        self.attributes.append({k.lower(): markup.unescape(a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(rest)} if rest.strip(" /") else {})
        self.parent.append(up)
        self.children.append([])
        self.children[up].append(number)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
            self.children[number].append(html[at : end.start() if end else len(html)])
            return end.end() if end else len(html)
        if name not in VOID:
            self.open.append(number)
            self.names[name] += 1
        return at

    def cut(self, k: int) -> None:
        """End the open elements from the k-th on."""
        self.names.subtract(self.tag[x] for x in self.open[k:])
        del self.open[k:]

    def close(self, name: str) -> None:
        """End the innermost open element of that name; an inline one only within its block."""
        if self.names[name]:
            for k in range(len(self.open) - 1, 0, -1):
                here = self.tag[self.open[k]]
                if here == name:
                    return self.cut(k)
                if name not in BLOCK and here in BLOCK:
                    return

    def make_room(self, name: str) -> None:
        """End what may not hold an element of that name: a paragraph, an item before the next one."""
        if name in BLOCK and self.names["p"]:
            for k in range(len(self.open) - 1, 0, -1):
                here = self.tag[self.open[k]]
                if here == "p":
                    self.cut(k)
                    break
                if here in BLOCK:
                    break
        ended, stops = ENDS.get(name, ((), ()))
        if any(self.names[x] for x in ended):
            cut = 0
            for k in range(len(self.open) - 1, 0, -1):
                here = self.tag[self.open[k]]
                if here in stops:
                    break
                if here in ended:
                    cut = k
            if cut:
                self.cut(cut)

    def below(self, own: list[bool]) -> list[bool]:
        """Whether an element or one within it is marked."""
        own = list(own)
        for k in range(len(own) - 1, 0, -1):
            own[self.parent[k]] |= own[k]
        return own

    def above(self, own: list[bool]) -> list[bool]:
        """Whether an element or one around it is marked."""
        own = list(own)
        for k in range(1, len(own)):
            own[k] |= own[self.parent[k]]
        return own

    def unwanted(self) -> list[bool]:
        """Of each element, whether it or what holds it is no article."""
        n = len(self.tag)
        holds = self.below([t in ("article", "main", "body") for t in self.tag])
        article = self.above([t in ("article", "main") for t in self.tag])
        words = [{w.lower() for c in ("class", "id") for w in WORD.findall(a.get(c, ""))} if a else frozenset() for a in self.attributes]
        header = [t == "header" or "header" in w and not h for t, w, h in zip(self.tag, words, holds)]
        heading = [t in HEADINGS for t in self.tag]
        in_head, of_heading = self.above(header), [a or b for a, b in zip(self.above(heading), self.below(heading))]
        out = [False] * n
        for k in range(1, n):
            tag, a = self.tag[k], self.attributes[k]
            out[k] = (
                tag in NO_TAGS and not (tag == "form" and holds[k])  # some sites wrap all in a form
                or bool(a) and (a.get("role", "").lower() in NO_ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(HIDDEN.search(a.get("style", ""))))
                or tag == "article" and not NO_WORDS.isdisjoint(words[k])
                or not holds[k] and (not NO_WORDS.isdisjoint(words[k]) or header[k] and not article[k])
                or in_head[k] and article[k] and not of_heading[k]  # of an article's head only headings are text
            )
        return self.above(out)

    def roots(self, out: list[bool]) -> list[int]:
        """The outermost articles, or else the main parts, or else the page."""
        for tag in ("article", "main"):
            marked = [t == tag and not o for t, o in zip(self.tag, out)]
            around = self.above(marked)
            if found := [k for k, x in enumerate(marked) if x and not around[self.parent[k]]]:
                return found
        return [0]

    def hashes(self) -> list[int]:
        """A hash of each element with its names and all that it holds; 0 for one without text."""
        n = len(self.tag)
        out = [0] * n
        for k in range(n - 1, -1, -1):
            parts = [str(out[c]) if not isinstance(c, str) else squashed(c) for c in self.children[k]]
            if any(p and p != "0" for p in parts):
                a = self.attributes[k]
                out[k] = xxhash.xxh64_intdigest("\x1f".join([self.tag[k], a.get("class", ""), a.get("id", ""), *(p for p in parts if p)]).encode("utf-8", "replace")) - (1 << 63) or 1
        return out

    def blocks(self, roots: list[int], out: list[bool], also: set[int] = frozenset()) -> list[str]:
        """The texts of the blocks in page order, without elements that are out or in also."""
        found, held = [], []

        def flush() -> None:
            text = squashed("".join(held))
            held.clear()
            if text:
                found.append(text)

        for root in roots:
            stack: list[tuple[int, int]] = [(root, 0)]
            while stack:
                k, c = stack.pop()
                if c == 0 and self.tag[k] in BLOCK:
                    flush()
                kids = self.children[k]
                while c < len(kids):
                    kid = kids[c]
                    c += 1
                    if isinstance(kid, str):
                        held.append(kid)
                    elif self.tag[kid] == "br":
                        held.append(" ")
                    elif not out[kid] and kid not in also:
                        stack += [(k, c), (kid, 0)]
                        break
                    elif self.tag[kid] in BLOCK:
                        flush()
                else:
                    if self.tag[k] in BLOCK:
                        flush()
            flush()
        return found


def squashed(text: str) -> str:
    return " ".join(markup.unescape(text).split())


def subtrees(html: str) -> tuple[set[int], int]:
    """The hashes of a page's subtrees that could be its text, and the hash of its longest block."""
    page = Page(html)
    out = page.unwanted()
    roots = page.roots(out)
    hashes = page.hashes()
    own = set(roots)
    inside = page.above([k in own for k in range(len(page.tag))])
    found = {h for k, h in enumerate(hashes) if h and k not in own and inside[k] and not out[k]}
    longest = max(page.blocks(roots, out), key=lambda b: (len(b), b), default="")
    return found, xxhash.xxh64_intdigest(longest.encode("utf-8", "replace")) - (1 << 63)


def text_of(html: str, templates: set[int] = frozenset()) -> str:
    """The blocks of a page, a line each, without its site's templates.

    Where templates hold most of an article it is itself what recurs, in copies that differ in their longest blocks, and stays.
    """
    page = Page(html)
    out = page.unwanted()
    roots = page.roots(out)
    whole = "\n".join(page.blocks(roots, out))
    if not templates:
        return whole
    less = "\n".join(page.blocks(roots, out, {k for k, h in enumerate(page.hashes()) if h in templates and k not in roots}))
    return whole if roots != [0] and 2 * len(less) < len(whole) else less


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page, a line per block, empty if there is none.

    Character references are decoded, white space in a block becomes one space, and blocks are joined by line feeds.  A null html is
    empty; a page without a host in its url has no site, so that only its markup tells what goes; rows that repeat stay; an empty table
    stays empty; other columns are left out.
    """
    rows = columns(pages, page_id=pages.schema["page_id"].dataType.simpleString(), url="string", html="string").withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            host, tree, page = [], [], []
            for h, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, longest = subtrees(html)
                host += [h] * len(found)
                tree += found
                page += [longest] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(tree, pa.int64()), pa.array(page, pa.int64())], names=["host", "tree", "page"])

    trees = rows.filter("host <> '' AND html IS NOT NULL").select("host", "html").mapInArrow(hashed, "host string, tree long, page long")
    on = trees.groupBy("host", "tree").agg(F.count_distinct("page").alias("pages")).filter(F.col("pages") >= LEAST)
    every = trees.groupBy("host").agg(F.count_distinct("page").alias("all"), F.count("*").alias("n"))
    found = stored(on.join(few(stored(every.filter(F.col("all") >= LEAST))), "host").filter(F.col("pages") >= SHARE * F.col("all")))
    # templates of a host are at most 1 / SHARE times the subtrees of a page
    sites = stored(found.groupBy("host").agg(F.collect_list("tree").alias("trees"), F.max("n").alias("n")))
    total = sites.agg(F.sum("n")).first()[0] or 0
    rows = rows.select("page_id", "url", "html", "host")
    plain = rows.join(few(sites.select("host")), "host", "left_anti").withColumn("trees", F.lit(None).cast("array<long>"))
    rows = plain.unionByName(join_counted(rows, sites, "host", total).drop("n")) if total else plain

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [text_of(html, set(t or ())) if html else "" for html, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url", "html", "trees").mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")
