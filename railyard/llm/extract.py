"""Main text of web pages by nearest-URL page differencing.

A page becomes lines, one per block, those of its menus and footers among them. Pages of one
host with the same text lines are copies of
each other, whatever their URLs, and the first of them stands for all, so that no page is
compared with its own copy. These pages are ordered by host and path, and every one is paired with
the neighbour of its host that shares the longer start of the path; where that one has all of
the page's lines, with the other neighbour if that has not. The lines of the two are aligned by
a longest common subsequence; shared lines are the site's, not the page's, and go. A line in an
``article`` or ``main`` element is the page's own and takes no part in this: copies of one article
would otherwise delete each other. An exact check by the elements follows: lines of those that name
themselves as menus, headers, footers, sidebars, notices, adverts, forms or comments go although
no other page has them, and with an ``article`` or ``main`` so does what stands beside it. Scripts,
styles and the like are no lines.
"""

from __future__ import annotations

import hashlib
import html
import os
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.common import small_batches, text_of
from railyard.llm.ordering import with_neighbours
from railyard.llm.url_filter import host_of, path_of
from railyard.plans.checkpoints import cut

# fixed values
RAW = "script style noscript template textarea select svg iframe object canvas"
UNTEXT = frozenset("nav footer aside form head button dialog menu".split())
OWN = frozenset(("article", "main"))
# kinds of lines: text, text in an article or main element, and what an element names as no text
TEXT, OWN_TEXT, NAMED_LINE = 0, 1, 2
RECORD = 9  # bytes of a line that is compared: its kind and a hash
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
NOTED = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs "
    "comment comments consent contentinfo cookie cookies disqus footer gdpr header login "
    "masthead menu modal nav navbar navigation navigations newsletter notice notices popup "
    "promo related search share sharing sidebar signup skyscraper social sponsor sponsored "
    "subscribe toolbar widget".split()
)
RAW_NAME = re.compile(rf"(?:{'|'.join(RAW.split())})\b", re.I)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>\"']*)")
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
# what stands before the slash of an element without a closing tag: the last slash of an unquoted address closes none
BEFORE_SLASH = re.compile(r"(?:^|[\s\"']|\s[^\s=<>\"'/]+)\Z")
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split()}
# words that end the name of a container whose first word tells what it contains
HOLDERS = frozenset(
    "area bar block body box button buttons container content form icons inner item items label line links list "
    "message overlay panel posts row section slot text title unit wrap wrapper".split()
)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LOOSE = frozenset("p b i em strong li tr td th dt dd option a span font u".split())


def _untext(tag: str, attributes: str, own: bool) -> bool:
    if tag in UNTEXT or (tag == "header" and not own):
        return True
    if tag in ("main", "body", "html") or "=" not in attributes:
        return False
    for name in " ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if not words or (own and words[-1] == "header"):  # a heading within an article belongs to it
            continue
        if words[-1] in NOTED or (words[0] in NOTED and words[-1] in HOLDERS):
            return True
    return False


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, closing, name, attributes) of each tag; comments, declarations and elements
    whose content is no text have no name. Quotes hide what ends a tag.

    Each part of the page is looked at a bounded number of times: what follows a quote is worked
    out once, and past the last ``>`` only a comment can begin.
    """
    events = [m.start() for m in re.finditer("[>\"']", page)]
    last = page.rfind(">")
    known: dict[int, int] = {}  # end of a tag by the place in ``events`` that comes next in it

    def end_from(at: int) -> int:
        k, met, end = bisect_left(events, at), [], -1
        while k < len(events):
            if k in known:
                end = known[k]
                break
            met.append(k)
            if page[events[k]] == ">":
                end = events[k] + 1
                break
            shut = page.find(page[events[k]], events[k] + 1)
            if shut < 0:
                break
            k = bisect_left(events, shut + 1)
        known.update(dict.fromkeys(met, end))
        return end

    start = page.find("<")
    while start >= 0:
        end, named = -1, ("", False, "")
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4) + 3
            end = end if end > 2 else len(page)
        elif start > last:
            start = page.find("<!--", start)
            continue
        elif page.startswith(("<!", "<?"), start):
            end = page.find(">", start) + 1
        elif m := NAME.match(page, start):
            name, end = m[2].lower(), end_from(m.end())
            attributes = page[m.end() : end - 1] if end > 0 else ""
            raw = RAW_NAME.match(name) if not m[1] else None
            if raw:
                inner = attributes[:-1]
                empty = end > 0 and attributes.endswith("/") and "<" not in QUOTED.sub("", attributes)
                if not (empty and (raw[0] == "svg" or BEFORE_SLASH.search(inner))):
                    shut = CLOSING[raw[0]].search(page, page.find(">", start) + 1)
                    end = shut.end() if shut else len(page)
            else:
                named = (name, bool(m[1]), attributes)
        if end > 0:
            yield start, end, named[1], named[0], named[2]
        start = page.find("<", max(end, start + 1))


def all_lines(page: str) -> tuple[list[str], list[int]]:
    """The lines of a page and their kinds."""
    lines, kinds, parts, unseen = [], [], [], []
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, no text, own
    held: Counter[str] = Counter()  # how many of a name are open
    hidden = own = 0
    last = 0

    def end_line():
        for pieces, kind in ((parts, OWN_TEXT if own > 0 else TEXT), (unseen, NAMED_LINE)):
            text = " ".join("".join(pieces).split())
            if text:
                lines.append(text)
                kinds.append(kind)
            pieces.clear()

    def close(tag):
        nonlocal hidden, own
        while held[tag]:
            name, no_text, is_own = stack.pop()
            held[name] -= 1
            hidden -= no_text
            own -= is_own
            if name == tag:
                break

    for start, end, closing, tag, attributes in tags(page):
        if start > last:
            (unseen if hidden else parts).append(html.unescape(page[last:start]))
        last = end
        if not tag:
            continue
        if tag not in INLINE:
            end_line()
        if closing:
            close(tag)
        elif tag not in VOID and not attributes.endswith("/"):
            if tag == "body":  # a head that was left open
                stack.clear()
                held.clear()
                hidden = own = 0
            if tag == "a":  # never within another
                close(tag)
            no_text = _untext(tag, attributes, own > 0)
            if not no_text:
                # often left open, and never of importance; inline ones but for their closing tags
                if tag in LOOSE and tag not in INLINE:
                    continue
                if tag in INLINE and not held[tag]:
                    continue
            is_own = tag in OWN
            stack.append((tag, no_text, is_own))
            held[tag] += 1
            hidden += no_text
            own += is_own
    (unseen if hidden else parts).append(html.unescape(page[last:]))
    end_line()
    return lines, kinds


def lines_of(page: str) -> tuple[list[str], list[bool]]:
    """The text lines of a page, and whether each is in an article or main element."""
    seen = [(line, kind == OWN_TEXT) for line, kind in zip(*all_lines(page)) if kind != NAMED_LINE]
    return [line for line, _ in seen], [own for _, own in seen]


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b`` (by Hunt and Szymanski)."""
    where: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        where.setdefault(line, []).append(j)
    ends: list[int] = []  # least end in b of a common subsequence by its length
    chains: list[tuple] = []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(link)
            else:
                ends[k], chains[k] = j, link
    found, chain = set(), chains[-1] if chains else None
    while chain:
        found.add(chain[0])
        chain = chain[1]
    return found


def site_lines(records: bytes, partners: list[bytes]) -> tuple[list[int], int]:
    """(places among the text lines, number) of the lines shared with the first partner that has
    not all text of the page; where each has all, with the last. Own lines are not compared."""

    def cut_up(records):
        return [records[i : i + RECORD] for i in range(0, len(records), RECORD)]

    lines = cut_up(records)
    compared = [i for i, line in enumerate(lines) if line[0] != OWN_TEXT]
    text = {i for i in compared if lines[i][0] == TEXT}
    shared: set[int] = set()
    for partner in partners:
        others = [line for line in cut_up(partner) if line[0] != OWN_TEXT]
        shared = {compared[k] for k in shared_lines([lines[i] for i in compared], others)}
        if not text or text - shared:
            break
    seen = [i for i, line in enumerate(lines) if line[0] != NAMED_LINE]
    return [place for place, i in enumerate(seen) if i in shared], len(shared)


def checked_text(lines: list[str], own: bytes, shared: list[int]) -> str:
    """The lines that differencing leaves, but those beside an article or main element."""
    site = set(shared)
    left = [i for i in range(len(lines)) if i not in site]
    if any(own):
        left = [i for i in left if own[i]]
    return " ".join(lines[i] for i in left)


def _records(lines: list[str], kinds: list[int]) -> bytes:
    """The lines as ``RECORD`` bytes each, which are equal for equal lines of one kind."""
    return b"".join(
        bytes((kind,)) + (hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                          if kind != OWN_TEXT else bytes(8))
        for line, kind in zip(lines, kinds)
    )


def _copy_of(lines: list[str], own: list[bool]) -> bytes:
    """Equal for equal lines. No line holds a line end, as white space in lines is one blank."""
    text = "\n".join(f"{o:d}{t}" for t, o in zip(lines, own))
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_site_lines of every page.

    A null or empty page has an empty text. A page whose host has no page with other lines, or
    without host, is not compared. Copies have one text. Rows of one URL are ordered by page_id,
    and equal rows stay. Other columns are not read. ``n_site_lines``: how many lines of the page,
    menus and footers included, differencing found to be its site's.
    """
    url = F.col("url")
    order = F.concat_ws(
        "\x00", host_of(url), path_of(url), F.lpad(F.coalesce(F.col("page_id"), F.lit(0)).cast("string"), 20, "0")
    )
    source = small_batches(pages).select("page_id", "url", order.alias("at"), text_of("html").alias("html"))

    # what is compared, a few bytes a line; the texts themselves are not written
    def to_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records, copies = [], []
            for page in batch.column(1).to_pylist():
                lines, kinds = all_lines(page)
                records.append(_records(lines, kinds))
                seen = [(line, kind == OWN_TEXT) for line, kind in zip(lines, kinds) if kind != NAMED_LINE]
                copies.append(_copy_of([line for line, _ in seen], [own for _, own in seen]))
            columns = [batch.column(0), pa.array(records, pa.binary()), pa.array(copies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["at", "records", "copy"])

    lined = source.select("at", "html").mapInArrow(to_records, "at string, records binary, copy binary")
    lined = cut(lined.withColumn("host", F.substring_index("at", "\x00", 1)).filter("host != ''"))
    apart = (
        lined.groupBy("host", "copy").agg(F.min(F.struct("at", "records")).alias("first"))
        .select("host", "copy", "first.*")
    )
    near = with_neighbours(apart, "at", ["at", "host", "copy", "records"], ["copy"], before=True)

    def records_if(side: str) -> Column:
        fits = (F.col(f"{side}_host") == F.col("host")) & (F.col(f"{side}_copy") != F.col("copy"))
        return F.when(fits, F.col(f"{side}_records")).alias(f"{side}_records")

    near = near.select(
        "host", "copy", "at", "records", "next_at", "previous_at", records_if("next"), records_if("previous")
    )

    def to_site_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, counts = batch.to_pydict(), [], []
            for i, records in enumerate(rows["records"]):
                sides = [
                    (len(os.path.commonprefix([rows["at"][i], rows[f"{s}_at"][i]])), rows[f"{s}_records"][i])
                    for s in ("next", "previous")
                    if rows[f"{s}_records"][i] is not None
                ]
                sides.sort(key=lambda x: -x[0])
                shared, n = site_lines(records, [x for _, x in sides])
                places.append(shared)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.int64())],
                ["host", "copy", "shared", "n_site_lines"],
            )

    compared = near.mapInArrow(to_site_lines, "host string, copy binary, shared array<int>, n_site_lines bigint")
    # one narrow row for each page, so that copies do not bring their texts to one task
    verdicts = cut(lined.select("host", "at", "copy").distinct().join(compared, ["host", "copy"]).drop("host"))

    def to_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, owns, copies = [], [], []
            for page in batch.column(3).to_pylist():
                lines, own = lines_of(page)
                texts.append("\n".join(lines))
                owns.append(bytes(own))
                copies.append(_copy_of(lines, own))
            columns = [pa.array(texts, pa.string()), pa.array(owns, pa.binary()), pa.array(copies, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *columns], ["page_id", "url", "at", "lines", "own", "copy"]
            )

    schema = source.drop("html").schema.simpleString()[len("struct<") : -1]
    texts = source.mapInArrow(to_lines, f"{schema}, lines string, own binary, copy binary")
    judged = texts.join(verdicts, ["at", "copy"], "left").select("page_id", "url", "lines", "own", "shared", "n_site_lines")

    def to_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            texts = [
                checked_text(lines.split("\n") if own else [], own, shared or ())
                for lines, own, shared in zip(rows["lines"], rows["own"], rows["shared"])
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), batch.column(5)],
                ["page_id", "url", "text", "n_site_lines"],
            )

    kinds = source.select("page_id", "url").schema.simpleString()[len("struct<") : -1]
    out = judged.mapInArrow(to_text, f"{kinds}, text string, n_site_lines bigint")
    return out.select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"),
        F.coalesce("n_site_lines", F.lit(0)).alias("n_site_lines"),
    )
