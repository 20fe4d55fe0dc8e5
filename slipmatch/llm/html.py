"""Main text of web pages: markup first, then what repeats over the pages of each host.

Markup settles most pages: what stands in menus, headers, footers, asides, forms, adverts,
notices, comments, scripts and styles goes, and where a page names its article the rest of the
page goes too. Pages that name none lose what their host's pages repeat: runs of ``LONG`` or more
tokens, and shorter blocks as a whole, that stand on ``PAGES`` or more pages of different text, unless
they stand in an article that some page of the host names.

These are found in the order of each host's suffixes: every token of a page begins a suffix, and all
suffixes of a host are sorted as texts, so that repeats stand next to each other. The least length is
fixed, so suffixes are cut after LONG tokens: a token lies in a repeat of at least LONG tokens just if a
suffix that begins at most LONG - 1 tokens before it shares its first LONG tokens with another page's,
and a longer repeat is the union of such stretches. Texts are compared and not hashes of them.
Pages of one host with the same text are copies and count as one page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from itertools import accumulate, groupby, islice
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from slipmatch.llm.url_filter import host_and_path
from slipmatch.sources.shared import written

LONG, PAGES = 8, 2
# Of a frame that leaves a task.
ROWS = 20_000

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|noscript|textarea|title|iframe|svg|select|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^<>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head nav header footer aside form button menu dialog fieldset video audio canvas".split())
ARTICLE = frozenset(["article", "main"])
# What the start of an element ends: the open elements of these tags that no bound stands in.
_ITEM_BOUNDS = tuple(
    "ul ol menu dir dl table td th caption article main aside nav section header footer form fieldset dialog "
    "blockquote figure details".split()
)
IMPLIED = {
    "li": (("li",), _ITEM_BOUNDS),
    **dict.fromkeys(("dt", "dd"), (("dt", "dd"), _ITEM_BOUNDS)),
    **dict.fromkeys(("td", "th"), (("td", "th"), ("table",))),
    "tr": (("tr", "td", "th"), ("table",)),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",))),
    "option": (("option",), ("datalist", "optgroup")),
}
# Words of class and id names.
DROPPED_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments "
    "disqus respond related recommended share sharing social toolbar pagination pager widget".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def _dropped(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True
        if name in ("class", "id"):
            words = {w.lower() for w in CAMEL.findall(value)}
            if words & DROPPED_WORDS or ("header" in words and not words & {"article", "entry", "post", "content"}):
                return True
    return False


def _is_article(tag: str, attributes: str) -> bool:
    return tag in ARTICLE or bool(re.search(r"role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articleBody", attributes or "", re.I))


def _tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, tag name, attributes and kind (``<``, ``>`` or empty) of all markup."""
    for m in MARKUP.finditer(page):
        tag = m["tag"] or m["tag2"]
        if tag is None:
            yield m.start(), m.end(), m["raw"] or "", "", ""
        else:
            closes = m["end"] or m["end2"]
            yield m.start(), m.end(), tag.lower(), m["attrs"] or m["attrs2"] or "", ">" if closes else "<"


class _Open:
    """The open elements, tag first; the last one of a tag is found at once, however deep it is."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.places: dict[str, list[int]] = {}

    def last(self, tag: str) -> int:
        own = self.places.get(tag)
        return own[-1] if own else -1

    def push(self, *row) -> None:
        self.places.setdefault(row[0], []).append(len(self.rows))
        self.rows.append(row)

    def cut(self, k: int) -> None:
        while len(self.rows) > k:
            self.places[self.rows.pop()[0]].pop()

    def ended_by(self, tag: str) -> int:
        """The first element that the start of ``tag`` ends with all in it, or -1."""
        if tag not in IMPLIED:
            return -1
        ends, bounds = IMPLIED[tag]
        own = [k for k in map(self.last, ends) if k >= 0]
        bound = max(map(self.last, bounds)) if own else -1
        return min((k for k in own if k > bound), default=-1)


def blocks(page: str) -> tuple[list[str], bool]:
    """Blocks of text in page order, and whether the page names its article.

    A dropped element that is never closed ends where its parent or the article begins anew.
    """
    own, _, named = streams(page)
    return own, named


def streams(page: str) -> tuple[list[str], list[str], bool]:
    """The same, with the blocks outside the article, if there is one, in between."""
    tags = list(_tags(page))
    closed: set[int] = set()
    opened = _Open()
    for i, (_, _, tag, _, kind) in enumerate(tags):
        if kind == "<" and tag not in VOID:
            if (k := opened.ended_by(tag)) >= 0:
                opened.cut(k)
            opened.push(tag, i)
        elif kind == ">" and (k := opened.last(tag)) >= 0:
            closed.add(opened.rows[k][1])
            opened.cut(k)
    out: list[tuple[str, bool]] = []
    text: list[str] = []
    opened = _Open()  # tag, dropped, in an article, closed later
    stack = opened.rows
    dropped = within = named = False
    at = 0

    def end_block() -> None:
        words = html.unescape("".join(text)).split()
        if words:
            out.append((" ".join(words), within))
        text.clear()

    for i, (start, end, tag, attributes, kind) in enumerate(tags):
        if not dropped:
            text.append(page[at:start])
        at = end
        if not kind:
            if tag and tag.lower() not in ("script", "style", "template", "noscript"):
                end_block()
            continue
        if tag not in INLINE:
            end_block()
        if kind == "<" and tag not in VOID:
            article = _is_article(tag, attributes)
            if article:
                while stack and stack[-1][1] and not stack[-1][3]:
                    opened.cut(len(stack) - 1)
                dropped, within = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            if stack and stack[-1][0] == "p" and tag not in INLINE:
                opened.cut(len(stack) - 1)
                dropped, within = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            if (k := opened.ended_by(tag)) >= 0:
                opened.cut(k)
                dropped, within = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            drops = dropped or _dropped(tag, attributes)
            if drops and not dropped:
                end_block()
            within = within or (article and not drops)
            named = named or within
            dropped = drops
            opened.push(tag, dropped, within, i in closed)
        elif kind == ">" and (k := opened.last(tag)) >= 0:
            if stack[k][1]:
                end_block()
            opened.cut(k)
            dropped, within = (stack[-1][1], stack[-1][2]) if stack else (False, False)
    if not dropped:
        text.append(page[at:])
    end_block()
    own = [b for b, inside in out if inside or not named]
    return own, [b for b, inside in out if named and not inside], named


def _split(batches):
    for frame in batches:
        found = [streams(page or "") for page in frame["html"]]
        for k, column in enumerate(("blocks", "outside", "named")):
            frame[column] = [x[k] for x in found]
        yield frame.drop(columns="html")


def suffixes(parts) -> dict[str, list[int]]:
    """The first LONG tokens of every suffix, and blocks that are shorter as a whole, with the tokens
    they begin at; A-Z in lower case."""
    sizes = [len(part.split()) for part in parts]
    tokens = [t for part in parts for t in part.encode().lower().decode().split()]
    found: dict[str, list[int]] = {}
    for at in range(len(tokens) - LONG + 1):
        found.setdefault(" ".join(tokens[at : at + LONG]), []).append(at)
    for at, size in zip(accumulate(sizes, initial=0), sizes):
        if 0 < size < LONG:
            found.setdefault(" ".join(tokens[at : at + size]), []).append(at)
    return found


def _frames(rows: Iterable[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    rows = iter(rows)
    while some := list(islice(rows, ROWS)):
        yield pd.DataFrame(some, columns=columns)


def _suffix_rows(batches):
    def rows():
        for frame in batches:
            for page, host, parts in zip(frame["page"], frame["host"], frame["blocks"], strict=True):
                for suffix, starts in suffixes(parts).items():
                    yield host, suffix, page, starts

    return _frames(rows(), ["host", "suffix", "page", "starts"])


def shared(ordered: Iterable[tuple]) -> Iterator[tuple]:
    """Page, starts and number of tokens of the suffixes that stand on PAGES or more pages.

    ``ordered`` holds host, suffix, page and starts, in the order of the first three; of equal suffixes
    no more than the first PAGES - 1 rows wait. Articles have negative pages and so come first: what
    stands in one is no boilerplate of its host, which a negative number of tokens tells.
    """
    for (_, suffix), same in groupby(ordered, key=itemgetter(0, 1)):
        pages = (next(rows) for _, rows in groupby(same, key=itemgetter(2)))
        first = list(islice(pages, PAGES - 1))
        size = (suffix.count(" ") + 1) * (-1 if first[0][2] < 0 else 1)
        for k, row in enumerate(pages):
            for *_, page, starts in ([*first, row] if k == 0 else [row]):
                yield page, starts, size


def _shared_rows(batches):
    columns = ["host", "suffix", "page", "starts"]
    rows = (row for frame in batches for row in zip(*[frame[c] for c in columns], strict=True))
    return _frames(shared(rows), ["page", "starts", "size"])


def unrepeated(parts, repeated) -> tuple[str, int]:
    """The blocks without the tokens that only repeated suffixes of no article cover, and how many of
    those that stay are repeated, too."""
    if repeated is None:
        return " ".join(parts), 0
    tokens = [t for part in parts for t in part.split()]
    taken, found = np.zeros((2, len(tokens)), dtype=bool)
    for row in repeated:
        size = abs(row["size"])
        for first in row["starts"]:
            (taken if row["size"] > 0 else found)[first : first + size] = True
    return " ".join(t for t, gone in zip(tokens, taken, strict=True) if not gone), int((found & ~taken).sum())


def _told(batches):
    for frame in batches:
        told = [unrepeated(*x) for x in zip(frame["blocks"], frame["repeated"], strict=True)]
        for k, column in enumerate(("text", "n_repeated")):
            frame[column] = [x[k] for x in told]
        yield frame[["page_id", "url", "text", "n_repeated"]]


def suffix_order(pages: DataFrame) -> DataFrame:
    """All suffixes of each host in their order, a row for each different one of a page.

    Ranges of the order are dealt over the tasks; equal suffixes of a host meet in one.
    """
    rows = pages.select("host", "page", "blocks").mapInPandas(
        _suffix_rows, "host string, suffix string, page long, starts array<int>"
    )
    return rows.repartitionByRange("host", "suffix").sortWithinPartitions("host", "suffix", "page")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, and n_repeated, the tokens of its text that other
    pages of the host have; further columns are left out.

    A null or empty page has an empty text. A page whose url has no host shares no host's
    repeats: its blocks all stay. Pages of a host that have the same text count as one page.

    All text of every page is put in the order: of pages that name their article, the article and
    what stands outside of it apart. An article keeps what repeats, as suffixes that stand in one
    are taken from no page; what stands outside is evidence against the same text elsewhere.
    """
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), "html")
    schema = rows.drop("html").schema
    for column in ("blocks", "outside"):
        schema = schema.add(column, T.ArrayType(T.StringType()))
    parsed = written(rows.mapInPandas(_split, schema.add("named", "boolean")), "page-blocks", "zstd")
    joined = F.array_join("blocks", " ")
    on_host = F.col("host") != ""
    page = F.shiftrightunsigned(F.xxhash64("host", joined), 1)
    hosted = parsed.where(on_host)
    loose = F.when(F.col("named"), F.col("outside")).otherwise(F.col("blocks")).alias("blocks")
    # Copies may be cut into blocks in different ways.
    open_pages = (
        hosted.select("host", loose)
        .where(F.size("blocks") > 0)
        .groupBy("host", page.alias("page"))
        .agg(F.min("blocks").alias("blocks"))
    )
    articles = hosted.where("named").select("host", F.bitwise_not(page).alias("page"), "blocks")
    order = suffix_order(open_pages.unionByName(articles))
    repeated = order.mapInPandas(_shared_rows, "page long, starts array<int>, size int")
    # A page's list is no longer than the page.
    listed = repeated.groupBy("page").agg(F.collect_list(F.struct("starts", "size")).alias("repeated"))
    told = (
        hosted.select("page_id", "url", "blocks", F.when(F.col("named"), F.bitwise_not(page)).otherwise(page).alias("page"))
        .join(listed, "page", "left")
        .select("page_id", "url", "blocks", "repeated")
        .mapInPandas(_told, parsed.select("page_id", "url").schema.add("text", "string").add("n_repeated", "long"))
    )
    alone = parsed.where(~F.coalesce(on_host, F.lit(False))).select(
        "page_id", "url", joined.alias("text"), F.lit(0).cast("long").alias("n_repeated")
    )
    n_chars = F.length("text").cast("long").alias("n_chars")
    return told.unionByName(alone).select("page_id", "url", "text", n_chars, "n_repeated")
