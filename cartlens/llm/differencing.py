"""Main text of web pages by differencing pages of near URLs.

Pages of a host are put in the order of their URL paths, and each is paired with the neighbour
whose path begins like its own for longer (ties: the one before). The text lines of both pages,
one per block element, are aligned by a longest common subsequence. Lines that both share are the
host's template and are deleted, lines of its own are a page's text.

Differencing alone is wrong for two kinds of page, so markup has its say first:

- What is marked as menu, header, footer, sidebar, notice, advert, form, script, style or reader
  comments never becomes a line, because such parts often differ between pages.
- If a page marks its article (``article``, else ``main``), its lines are the text, and shared
  lines are deleted from all that stands outside only: copies of an article, and sentences that
  several articles quote, are not template. If nothing is marked, shared lines go, unless more than
  half of the page's text is shared: then the pair are copies of each other and both stay whole.

Within a block, white space becomes one space and character references are decoded; blocks are
joined by a line feed. ``header`` counts as a page's header outside an article only. An element that
is never closed ends with its parent; an unclosed script, style or comment runs to the end.

Cases: null html is empty, null url has an empty host and path (such pages are one host); a page
alone on its host loses nothing; pages of equal path follow by page_id (null first), repeated ones as
they are read, and are pages of their own; very long pages are aligned in memory that grows with their lines, not their square; an
empty table gives no rows. Only page_id, url and html are read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import NO_ID
from cartlens.llm.spelling import common_prefix
from cartlens.llm.urls import host_of, path_of

#: Share of a page's characters that may be shared before the pair counts as copies.
MOST_SHARED = 0.5
#: Cells of a table of common subsequences that are kept at once.
CELLS = 2**28
#: Pages of a range of the URL order, if there are more of them than tasks.
RANGE = 100_000
#: Bytes of a line's digest.
WIDTH = 16

# Names of elements, attributes and words by the HTML standard and common use.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = set(
    "head nav footer aside menu form button select dialog template noscript svg math object canvas audio "
    "video search".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer comment comments disqus respond share sharing social related popup modal".split()
)
COMMENT_WORDS = set("comment comments disqus respond".split())
#: Elements that end an open one of the same group, and the elements that keep groups apart.
GROUP = {"li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td", "option": "option", "p": "p"}
SCOPES = {"ul": ["li"], "ol": ["li"], "menu": ["li"], "dl": ["dd"], "table": ["tr", "td"], "tr": ["td"]}

TAG = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
TAG_END = re.compile(r"=\s*([\"'])|>")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[^a-z0-9]+")


def tag_end(html: str, at: int) -> int:
    """Where the tag that is open at this place ends, -1 if nowhere."""
    while (found := TAG_END.search(html, at)) is not None:
        if not found.group(1):
            return found.start()
        at = html.find(found.group(1), found.end()) + 1
        if not at:
            break
    return -1


def dropped_by_name(name: str, attributes: str, in_article: bool) -> bool:
    """Whether the element is none of the article's text."""
    if name in DROPPED or (name == "header" and not in_article):
        return True
    if name in ("html", "body", "main") or not attributes:
        return False
    words: set[str] = set()
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "role" and value.strip() in DROPPED_ROLES):
            return True
        if key in ("class", "id"):
            words.update(WORD.split(value))
    return not words.isdisjoint(COMMENT_WORDS if name == "article" else DROPPED_WORDS)


class Page:
    """The open elements and the lines of a page while it is read."""

    def __init__(self):
        self.open: list[tuple[str, bool, int]] = []  # name, dropped, what it marks
        self.count: dict[str, int] = {}
        self.groups: dict[str, list[int]] = {group: [-1] for group in set(GROUP.values())}
        self.dropped = 0
        self.marked = [0, 0, 0]  # open elements that mark: nothing, main, article
        self.lines: list[tuple[str, int]] = []
        self.pending: list[str] = []

    def flush(self):
        text = " ".join("".join(self.pending).split())
        if text:
            self.lines.append((text, 2 if self.marked[2] else 1 if self.marked[1] else 0))
        self.pending.clear()

    def text(self, text: str):
        if not self.dropped and text:
            self.pending.append(unescape(text))

    def pop(self):
        name, dropped, marks = self.open.pop()
        self.count[name] -= 1
        self.dropped -= dropped
        self.marked[marks] -= 1
        for group in SCOPES.get(name, ()):
            self.groups[group].pop()
        if name in GROUP:
            self.groups[GROUP[name]].pop()

    def close_group(self, group: str):
        at = self.groups[group][-1]
        while 0 <= at < len(self.open):
            self.pop()

    def start(self, name: str, attributes: str):
        if name == "br":
            return self.text(" ")
        block = name in BLOCKS
        if block:
            self.flush()
            self.close_group("p")
            if name in GROUP:
                self.close_group(GROUP[name])
        if name in VOID:
            return None
        drops = dropped_by_name(name, attributes, self.marked[2] > 0)
        # an inline element matters only if it is dropped
        if block or drops:
            marks = 0 if self.dropped or drops else {"article": 2, "main": 1}.get(name, 0)
            if name in GROUP:
                self.groups[GROUP[name]].append(len(self.open))
            for group in SCOPES.get(name, ()):
                self.groups[group].append(-1)
            self.open.append((name, drops, marks))
            self.count[name] = self.count.get(name, 0) + 1
            self.dropped += drops
            self.marked[marks] += 1
        return None

    def end(self, name: str):
        if name in BLOCKS:
            self.flush()
        if self.count.get(name):
            while self.open[-1][0] != name:
                self.pop()
            self.pop()


def lines_of(html: str) -> list[tuple[str, int]]:
    """The lines of a page's text in order, each with 2 in an article, 1 in the main part, else 0."""
    page, at, size = Page(), 0, len(html)
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            page.text(html[at:])
            break
        page.text(html[at:mark])
        tag = TAG.match(html, mark + 1)
        if tag is None:
            if html.startswith("<!--", mark):
                # a comment may be empty and end in its own opening
                end = html.find("-->", mark + 2)
                at = size if end < 0 else end + 3
            elif html.startswith(("<!", "<?", "</"), mark):
                end = html.find(">", mark)
                at = size if end < 0 else end + 1
            else:
                page.text("<")
                at = mark + 1
            continue
        end = tag_end(html, tag.end())
        if end < 0:  # a tag without end takes the rest with it
            break
        name, at = tag.group(2).lower(), end + 1
        if tag.group(1):
            page.end(name)
            continue
        page.start(name, html[tag.end() : end])
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
            at = size if close is None else close.start()
    page.flush()
    return page.lines


def common_lines(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by bit rows.

    Bit j of row i is 0 where the subsequence of a[:i+1] and b[:j+1] is longer than that of b[:j].
    Halves are aligned on their own where all rows together would be large.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    known_a, known_b = set(a[head : len(a) - tail]), set(b[head : len(b) - tail])
    places = [i for i in range(head, len(a) - tail) if a[i] in known_b]
    inner = [x for x in b[head : len(b) - tail] if x in known_a]
    found = _aligned([a[i] for i in places], inner)
    return [*range(head), *(places[i] for i in found), *range(len(a) - tail, len(a))]


def _rows(a: list, b: list) -> Iterator[int]:
    masks: dict = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(row: int, size: int) -> np.ndarray:
    """Length of the subsequence for each prefix of b, the empty one included."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(size // 8 + 1, "little"), np.uint8), bitorder="little")[:size]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _aligned(a: list, b: list) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > CELLS and len(a) > 1:
        half = len(a) // 2
        for upper in _rows(a[:half], b):
            pass
        for lower in _rows(a[: half - 1 : -1], b[::-1]):
            pass
        split = int(np.argmax(_lengths(upper, len(b)) + _lengths(lower, len(b))[::-1]))
        return [*_aligned(a[:half], b[:split]), *(half + i for i in _aligned(a[half:], b[split:]))]
    rows = list(_rows(a, b))
    found, j = [], len(b)

    def length(i: int, j: int) -> int:
        return j - (rows[i] & ((1 << j) - 1)).bit_count() if i >= 0 else 0

    i, here = len(a) - 1, length(len(a) - 1, j)
    while i >= 0 and j > 0 and here:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif length(i - 1, j) == here:
            i -= 1
        else:
            found.append(i)
            i, j, here = i - 1, j - 1, here - 1
    return found[::-1]


def main_text(lines: list[str], places: list[int], shared: list[int]) -> tuple[list[str], int]:
    """The lines that are the page's text, and how many were deleted because they are shared."""
    best = max(places, default=0)
    if best:
        outside = sum(places[i] < best for i in shared)
        return [x for x, place in zip(lines, places, strict=True) if place == best], outside
    if sum(len(lines[i]) for i in shared) > MOST_SHARED * sum(map(len, lines)):
        return list(lines), 0
    gone = set(shared)
    return [x for i, x in enumerate(lines) if i not in gone], len(gone)


class Seen(NamedTuple):
    """A page of the order: its key, what is returned with it, its lines and their digests."""

    host: bytes
    path: bytes
    guest: bool
    page_id: object
    url: bytes | None
    lines: list[str]
    places: list[int]
    digests: list[bytes]


def compared(page: Seen, before: Seen | None, after: Seen | None) -> tuple:
    """page_id, url, partner, text, n_shared, n_deleted of a page between its neighbours in the order."""
    near = [x for x in (before, after) if x is not None and x.host == page.host]
    # of equal ones the first
    partner = max(near, key=lambda x: common_prefix(page.path, x.path), default=None)
    shared = common_lines(page.digests, partner.digests) if partner else []
    text, deleted = main_text(page.lines, page.places, shared)
    return (page.page_id, page.url, partner.page_id if partner else None, "\n".join(text), len(shared), deleted)


def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of sorted pages; three pages are held at a time."""
    part, before, page, kinds = None, None, None, {}

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds.values(), strict=True)], list(kinds))

    for batch in batches:
        kind = batch.schema.field("page_id").type
        kinds = {"page_id": kind, "url": pa.binary(), "partner": kind, "text": pa.string(), "n_shared": pa.int64(), "n_deleted": pa.int64()}
        out = []
        for row in zip(*(batch[x] for x in ("part", "host", "path", "guest", "page_id", "url", "html")), strict=True):
            here, host, path, guest, page_id, url, html = (x.as_py() for x in row)
            lines = lines_of(html.decode("utf-8", "replace"))
            texts = [text for text, _ in lines]
            digests = [hashlib.blake2b(text.encode(), digest_size=WIDTH).digest() for text in texts]
            after = Seen(host, path, guest, page_id, url, texts, [place for _, place in lines], digests)
            if page is not None and not page.guest:
                out.append(compared(page, before, after if here == part else None))
            before, page, part = page if here == part else None, after, here
        yield batch_of(out)
    if page is not None and not page.guest:
        yield batch_of([compared(page, before, None)])


def _sortable(key) -> tuple:
    host, path, place = key
    return bytes(host), bytes(path), int(place)


def ordered(pages: DataFrame, ranges: int) -> DataFrame:
    """Pages (host, path, place, row and more) by ranges of the order of their URLs.

    Sorted by part and order; pages of one key, which repeat host, path and page_id, are not parted. The keys alone are sorted first, and the driver sees the first and last
    key of each range. The last page of a range is a guest in the next one and the first one in
    the range before it, so that every page stands between its neighbours.
    """
    names = ["host", "path", "place"]
    key = F.struct(*names)
    ranged = pages.select(*names).repartitionByRange(ranges, *names)
    ends = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("first"), F.max(key).alias("last")).collect()
    firsts, lasts = (sorted(_sortable(end[x]) for end in ends) for x in ("first", "last"))

    @F.pandas_udf("array<int>")
    def parts(host: pd.Series, path: pd.Series, place: pd.Series) -> pd.Series:
        out = []
        for x in zip(host, path, place, strict=True):
            here = _sortable(x)
            # a key before the first one belongs to the first range
            own = max(bisect.bisect_right(firsts, here) - 1, 0)
            found = [own]
            if here == firsts[own] and own > 0:
                found.append(own - 1)
            if here == lasts[own] and own + 1 < len(firsts):
                found.append(own + 1)
            out.append(found)
        return pd.Series(out)

    sent = pages.withColumn("parts", parts(*names))
    return (
        sent.select(*pages.columns, F.posexplode("parts").alias("guest", "part"))
        .withColumn("guest", F.col("guest") > 0)
        .repartitionById(ranges, F.col("part"))
        .sortWithinPartitions("part", *names, "row")
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page; also partner (its page_id), n_shared and n_deleted lines."""
    url = F.col("url")
    rows = pages.select(
        "page_id",
        url.cast("binary").alias("url"),
        host_of(url).cast("binary").alias("host"),
        path_of(url).cast("binary").alias("path"),
        F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("place"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"),
    )
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema["page_id"].dataType.simpleString()
    result = ordered(rows, max(tasks, pages.count() // RANGE)).mapInArrow(
        differenced, f"page_id {kind}, url binary, partner {kind}, text string, n_shared long, n_deleted long"
    )
    n_chars = F.length("text").cast("long").alias("n_chars")
    return result.select("page_id", F.col("url").cast("string").alias("url"), "text", n_chars, "partner", "n_shared", "n_deleted")
