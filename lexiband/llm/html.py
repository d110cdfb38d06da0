"""Main text of web pages by removal of site templates.

Every element of a page is hashed with all it holds, one within an article apart from others. Spark
counts on how many pages of a host each hash occurs, copies of a page, told by all its text,
as one; a hash on at least LEAST_PAGES pages, and of a host with more pages on LEAST_SHARE of
them or on the square root of their number, whichever is less, is a template, and its subtree is deleted wherever it occurs, but for an article in it. Within an article that
holds for boxes of at most SMALL characters on at least LEAST_INSIDE pages, not for single
paragraphs, headings, list items or table cells. Only then what a page repeats of no other page (an
advert seen once, a menu that marks the page it is on, the footer of a host with two pages) is caught
by what an element is: by its tag, its role, its class and id. All that remains is the text, also
beside an article, on every host alike. `Page` counts the blocks that each of the two deletes.

A host's templates travel as one array per host, broadcast, if they are at most HOST_HASHES
for every host and BROADCAST_HASHES in all, hosts without any not among them. Else the templates are
joined by host and hash to the hashes of each page, and a page meets those of its own by host and
digest, in joins that AQE splits for a host with many pages. Hashes meet in the shuffle by host,
hash and page, so that a hash on all pages of a host is in many tasks.

Defined results: null html is empty and gives an empty text. A null or broken url is of the
host "". Pages are read row by row, so repeated and null ids do no harm. Unclosed and
misplaced tags, comments and character references are read as browsers do in the plain cases. A
page is read in one pass, and what an element takes does not depend on how deep it lies, so that
neither the length of a tag nor the number of open elements or quotes holds a reader up. Other
columns are not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiband.llm.common import kept
from lexiband.llm.common import pieces as smaller

LEAST_PAGES, LEAST_SHARE, BROADCAST_HASHES = 5, 0.02, 1_000_000
HOST_HASHES = 5_000
LEAST_INSIDE, SMALL = 10, 400

# Fixed values of the HTML standard: elements without content, with raw text, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre search section"
    " summary table tbody td tfoot th thead tr ul caption".split()
)
SCOPES = frozenset("html body table td th caption article section main div aside nav ul ol form".split())
ENDED_BY = {  # an open element of the key is ended by the start of one of these
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
# What is no main text by what it is.
FURNITURE = frozenset(
    "head script style noscript template nav footer aside form iframe button select textarea input object embed"
    " svg canvas dialog menu title audio video map noframes noembed search".split()
)
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form status".split()
)
FURNITURE_NAMES = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|nav(?:bar|igation|links?)?|menu\w*|breadcrumbs?|sidebar\w*|footer\w*"
    r"|masthead|cookies?|consent|gdpr|notices?|alerts?|comments?|disqus|repl(?:y|ies)|newsletter|subscribe"
    r"|share|sharing|social|related|popups?|modal|widgets?|pagination|pager|toolbar|skip"
)
PAGE_NAMES = frozenset(["header", "topbar"])  # furniture outside an article; inside, its heading
ABOUT = frozenset("has have with without no not".split())  # "has-sidebar" tells of a sidebar and is none
CONTENT = frozenset(["article", "main"])
INSIDE = frozenset("div section ul ol aside address figure center details".split())  # may be templates in an article

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
TAG_PART = re.compile(r">|=\s*[\"']")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def host(url: str) -> Column:
    found = F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes) and ("close", tag, "") in page order."""
    at, end = 0, len(page)
    last = {quote: page.rfind(quote) for quote in "\"'"}
    while at < end:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        if start > at:
            yield "text", page[at:start], ""
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = end if close < 0 else close + 3
        elif page.startswith(("<!", "<?"), start):
            close = page.find(">", start)
            at = end if close < 0 else close + 1
        elif found := TAG.match(page, start):
            close = tag_end(page, found.end(), last)
            if close < 0:  # a tag that the page's end cuts off
                return
            tag, at = found[2].lower(), close + 1
            if found[1]:
                yield "close", tag, ""
                continue
            yield "open", tag, page[found.end() : close]
            if tag in RAW:  # up to its end tag, whatever is between
                raw_end = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
                stop = raw_end.start() if raw_end else end
                yield "text", page[at:stop], ""
                at = stop
        else:
            yield "text", "<", ""
            at = start + 1


def tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Where the tag ends that `at` is in, -1 if it does not. A value may have > in quotes; a quote
    that is not closed, `last` having the last of each kind, is none."""
    while found := TAG_PART.search(page, at):
        quote, at = found[0][-1], found.end()
        if quote == ">":
            return found.start()
        if at <= last[quote]:
            at = page.find(quote, at) + 1
    return -1


class Element:
    __slots__ = ("tag", "furniture", "content", "hash", "first", "outside", "chars", "block", "start")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag = tag
        self.furniture = is_furniture(tag, attributes, parent)
        self.content = tag in CONTENT or (parent is not None and parent.content)
        self.hash = xxhash.xxh64(f"<{tag} {attributes.strip()}>".encode("utf-8", "surrogatepass"))
        # How much there was when it was opened: blocks, those outside articles, characters of
        # articles; the open block and the parts of it.
        self.first = self.outside = self.chars = self.block = self.start = 0


class Block(NamedTuple):
    text: str
    inside: bool  # an article
    listed: bool  # furniture by what it is


def is_furniture(tag: str, attributes: str, parent: Element | None) -> bool:
    inside = parent is not None and parent.content
    if tag in FURNITURE or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), values[0] or values[1] or values[2]
        if name == "hidden" or (name == "style" and UNSEEN.search(value)):
            return True
        if name == "role" and value.lower() in FURNITURE_ROLES:
            return True
        if name in ("class", "id") and any(named_furniture(word, tag, inside) for word in value.split()):
            return True
    return False


def named_furniture(word: str, tag: str, inside: bool) -> bool:
    """Whether one class or id names furniture. An article may be named for what goes with it,
    "post comment-open" say, so only a whole name counts there, and only within another."""
    if tag in CONTENT:
        return inside and FURNITURE_NAMES.fullmatch(word.lower()) is not None
    parts = [part.lower() for part in NAME_PARTS.findall(word)]
    if not ABOUT.isdisjoint(parts):
        return False
    return any(FURNITURE_NAMES.fullmatch(part) or (part in PAGE_NAMES and not inside) for part in parts)


def signed(digest: xxhash.xxh64) -> int:
    return int.from_bytes(digest.digest(), "big", signed=True)


class Page:
    """One reading of a page: the hashes of its elements, its text, and how many blocks, or inline
    elements of one, were deleted `by_counts` and, of the others, how many blocks `by_lists`."""

    def __init__(self, page: str, templates: frozenset[int] = frozenset()):
        self.templates, self.hashes = templates, set()
        self.all_text = xxhash.xxh64()
        self.stack = [Element("#page", "", None)]
        self.places: dict[str, list[int]] = {}  # of the open elements of a tag in the stack
        self.scopes: list[int] = []
        self.enders: list[int] = []  # of scopes and of elements that the start of another ends
        self.inline: list[tuple[str, bool]] = []
        self.blocks: list[Block] = []
        self.outside = self.chars = self.block = self.by_counts = 0
        for kind, value, attributes in tokens(page):
            if kind == "text":
                self._text(value)
            elif kind == "open":
                self._open(value, attributes)
            else:
                self._close(value)
        self._pop_to(1)
        self._end_block()
        self.digest = signed(self.all_text)
        self.by_lists = sum(block.listed for block in self.blocks)
        self.text = "\n".join(block.text for block in self.blocks if not block.listed)

    def _text(self, value: str) -> None:
        top = self.stack[-1]
        words = " ".join(value.split()).encode("utf-8", "surrogatepass")
        top.hash.update(words)
        raw = top.tag in RAW
        if words and not raw:
            self.all_text.update(words + b"\n")
        if not (raw and top.furniture):
            self.inline.append((value if raw else references.unescape(value), top.furniture))

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._end_block()
            self._end_implied(tag)
        if tag in VOID:
            self.stack[-1].hash.update(f"<{tag}>".encode())
            if tag == "br":
                self.inline.append((" ", False))
            return
        parent, place = self.stack[-1], len(self.stack)
        element = Element(tag, attributes, parent)
        element.furniture |= parent.furniture
        element.first, element.outside, element.chars = len(self.blocks), self.outside, self.chars
        element.block, element.start = self.block, len(self.inline)
        self.stack.append(element)
        self.places.setdefault(tag, []).append(place)
        if tag in SCOPES:
            self.scopes.append(place)
        if tag in SCOPES or tag == "p" or tag in ENDED_BY:
            self.enders.append(place)

    def _end_implied(self, tag: str) -> None:
        # Between two scopes there is at most one of each kind.
        for place in reversed(self.enders):
            open_tag = self.stack[place].tag
            if open_tag == "p" or tag in ENDED_BY.get(open_tag, ()):
                self._pop_to(place)
                return
            if open_tag in SCOPES:
                return

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_block()
        places = self.places.get(tag)
        if places and (tag in SCOPES or not self.scopes or self.scopes[-1] < places[-1]):
            self._pop_to(places[-1])

    def _end_block(self) -> None:
        if not self.inline:
            return
        inside = self.stack[-1].content
        for listed in (False, True):
            text = " ".join("".join([part for part, marked in self.inline if marked == listed]).split())
            if text:
                self.blocks.append(Block(text, inside, listed))
                self.outside += not inside
                self.chars += len(text) if inside and not listed else 0
        self.inline.clear()
        self.block += 1

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self._pop()

    def _pop(self) -> None:
        if self.stack[-1].tag in BLOCKS:
            self._end_block()
        element = self.stack.pop()
        place = len(self.stack)
        self.places[element.tag].pop()
        for some in (self.scopes, self.enders):
            if some and some[-1] == place:
                some.pop()
        key = signed(element.hash)
        self.stack[-1].hash.update(element.hash.digest())
        if element.content:
            chars = self.chars - element.chars
            if element.tag in INSIDE and 0 < chars <= SMALL:
                self.hashes.add(key | 1)
                if key | 1 in self.templates:
                    self.by_counts += len(self.blocks) - element.first
                    del self.blocks[element.first :]
                    self.chars = element.chars
        elif element.tag not in ("html", "body"):
            self.hashes.add(key & ~1)
            if key & ~1 in self.templates:
                self._delete(element)

    def _delete(self, element: Element) -> None:
        """A template outside articles goes with all it holds but articles."""
        if self.outside > element.outside:
            held = self.blocks[element.first :]
            self.blocks[element.first :] = [block for block in held if block.inside]
            self.by_counts += self.outside - element.outside
            self.outside = element.outside
        if element.tag not in BLOCKS:
            start = element.start if element.block == self.block else 0
            self.by_counts += any(not part.isspace() for part, _ in self.inline[start:])
            del self.inline[start:]


def page_hashes(pages: DataFrame, html: str, url: str) -> DataFrame:
    """host, hash and page, the digest of its text, once for each; a null hash stands for the page.
    Hashes within an article are odd, others even."""

    def hashed(batches):
        for batch in smaller(batches):
            hosts, rows, values, digests = batch.column("host").to_pylist(), [], [], []
            for row, html_ in enumerate(batch.column("html").to_pylist()):
                page = Page(html_ or "")
                found = [None, *page.hashes]  # the null one stands for the page
                rows += [hosts[row]] * len(found)
                values += found
                digests += [page.digest] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.string()), pa.array(values, pa.int64()), pa.array(digests, pa.int64())],
                names=["host", "hash", "page"],
            )

    rows = pages.select(host(url).alias("host"), F.col(html).alias("html"))
    return rows.mapInArrow(hashed, "host string, hash bigint, page bigint").distinct()


def templates(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """host and hash of the subtrees that recur on the pages of their host."""
    counts = kept(page_hashes(pages, html, url).groupBy("host", "hash").agg(F.count("*").alias("n")).where(
        F.col("n") >= LEAST_PAGES
    ))
    sizes = counts.where("hash IS NULL").select("host", F.col("n").alias("pages"))
    least = F.when(F.col("hash").bitwiseAND(F.lit(1)) == 1, LEAST_INSIDE).otherwise(LEAST_PAGES)
    enough = F.greatest(least, F.least(F.col("pages") * LEAST_SHARE, F.sqrt("pages")))
    return counts.where("hash IS NOT NULL").join(sizes, "host").where(F.col("n") >= enough).select("host", "hash")


def with_digests(rows: DataFrame) -> DataFrame:
    """`rows` with the digests by which `page_hashes` tells pages."""

    def digested(batches):
        for batch in smaller(batches):
            digests = [Page(html_ or "").digest for html_ in batch.column("html").to_pylist()]
            yield batch.append_column("digest", pa.array(digests, pa.int64()))

    return rows.mapInArrow(digested, T.StructType([*rows.schema.fields, T.StructField("digest", T.LongType())]))


def broadcast_bound(known: DataFrame) -> bool:
    """Whether the templates are few enough, for every host and in all; a host has one at least."""
    found = known.groupBy("host").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return (found["most"] or 0) <= HOST_HASHES and (found["all"] or 0) <= BROADCAST_HASHES


def main_text(pages: DataFrame, html: str = "html", url: str = "url", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep`, `text` and `n_chars` of every page."""
    known = kept(templates(pages, html, url))
    rows = pages.select(
        F.struct(*(F.col(name) for name in keep)).alias("page"), host(url).alias("host"), F.col(html).alias("html")
    )
    if broadcast_bound(known):
        hashes = known.groupBy("host").agg(F.collect_list("hash").alias("hashes"))
        rows = rows.join(F.broadcast(hashes), "host", "left")
    else:
        seen = page_hashes(pages, html, url).alias("seen")
        same = (F.col("seen.host") == F.col("known.host")) & (F.col("seen.hash") == F.col("known.hash"))
        own = seen.join(known.alias("known"), same).groupBy("seen.host", F.col("seen.page").alias("digest"))
        rows = with_digests(rows).join(own.agg(F.collect_list("known.hash").alias("hashes")), ["host", "digest"], "left")
    by_host = "digest" not in rows.columns
    schema = T.StructType([rows.schema["page"], T.StructField("text", T.StringType())])

    def extracted(batches):
        sets: dict[str, frozenset[int]] = {}
        for batch in smaller(batches):
            hosts, found = batch.column("host").to_pylist(), batch.column("hashes")
            texts = []
            for row, page in enumerate(batch.column("html").to_pylist()):
                if not by_host or hosts[row] not in sets:
                    if len(sets) > 1_000:
                        sets.clear()
                    sets[hosts[row]] = frozenset(found[row].as_py() or ())
                texts.append(Page(page or "", sets[hosts[row]]).text)
            yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(texts, pa.string())], names=["page", "text"])

    texts = rows.select("page", "host", "html", "hashes").mapInArrow(extracted, schema)
    return texts.select("page.*", "text", F.char_length("text").cast("bigint").alias("n_chars"))
