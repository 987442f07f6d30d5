"""Main text of HTML pages with a host suffix array.

Markup gives each block of a page a zone: ``main`` inside an article (or, without one, the
page's main container), ``frame`` inside menus, headers, footers, sidebars, notices,
adverts, forms or reader comments, ``open`` where markup does not tell. Scripts, styles,
comments and hidden elements give no block.

The token streams of a host's pages, articles and frames included, are searched for long
repeats. A suffix array of the concatenated streams, cut off at depth ``MIN_TOKENS``, puts
suffixes with a common prefix of that many tokens next to each other; such an interval with
suffixes of two or more pages of different content is a repeated substring, and the union of
these windows is exactly what all longer repeats cover. A page's content is its article or,
without one, its undecided stream, so copies of a page under several ids count as one page.
The intervals are found as groups of equal (host, window) ranks, the rank being a 64-bit hash
of the window: a lot of some hundred pages sends each of its distinct windows once, with the
bounds of the pages and contents it stands for, so a menu that every page of a hot host shares
reaches its group as one entry per lot. Few windows of an article repeat, so a filter comes first:
every window has a seed that equal windows share, seeds meet in packs, and only windows whose
seed another row has are ranked and grouped. Covered tokens are boilerplate and go; unique
runs stay. The texts are written once, in buckets of lots, and never shuffled: seeds, windows and
flags travel as compressed packs and meet the texts lot by lot.

Two exact checks follow, for every page. Covered text in a page's article (``article``
zones or, without any, ``main`` zones) is put back (quoted passages, licence lines), and so
is text of an undecided page that repeats only what stands in articles. Where a page has an
article, or markup names a block ``frame``, unique runs outside the article go as well. So
the repeats are found on all pages, and have the last word where markup does not tell.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by one newline. Nothing else is dropped or capped, and whole pages are read.

Null or empty html gives an empty text of length 0; broken or unclosed markup ends at the
end of the page. The host is the url's, lower-cased; a page without one is searched with no
other page and keeps its undecided text. Repeated pages get a row each, and rows of one
page_id count as one page too, so neither a repeated row nor a copy makes its own text
boilerplate. A passage that pages of different content share still goes from all of them. Empty tables give empty tables, other
columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.bloom_urls import split_url
from adlift.llm.common import save, save_bucketed, shuffles_released
from adlift.llm.runs import groups

MIN_TOKENS = 8
# The filter before the search: tokens of a seed, and how many of a seed's 42 bits name its shelf.
GRAM, SHELF_BITS = 4, 10
# A lot: pages that are searched at once; its characters bound a task's memory.
ROW_BITS = 10
LOT_ROWS, LOT_CHARS = 1 << ROW_BITS, 2 << 20

TAG = re.compile(r"<!--(?:.*?-->|.*+)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*+>?|"
                 r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
                 r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Elements by what the HTML standard says of them.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes", "svg",
       "math", "select", "object", "video", "audio", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "img", "br", "ruby", "rb", "rt", "rp", "picture", "source", "embed"}
# Inline elements that go on in the next block when a block closes around them.
FORMATTING = {"a", "b", "big", "code", "em", "font", "i", "s", "small", "strike", "strong", "tt", "u"}
FRAME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "head", "map"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
            "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
            "main", "menu", "nav", "ol", "p", "pre", "search", "section", "table", "ul"}
FRAME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog",
               "menu", "menubar", "toolbar", "alert"}
FRAME_WORDS = {"nav", "navbar", "navigation", "menu", "submenu", "breadcrumb", "breadcrumbs", "sidebar", "aside",
               "footer", "foot", "header", "masthead", "banner", "cookie", "cookies", "consent", "gdpr", "notice",
               "notices", "notification", "alert", "ad", "ads", "advert", "adverts", "advertisement", "advertising",
               "adsense", "promo", "promotion", "sponsor", "sponsored", "comment", "comments", "commentlist", "reply",
               "replies", "respond", "disqus", "share", "sharing", "social", "related", "recommended", "newsletter",
               "subscribe", "subscription", "popup", "modal", "overlay", "widget", "widgets", "toolbar", "pagination",
               "pager", "login", "signup", "signin", "search", "skip", "topbar", "paywall", "disclaimer"}
# Words that stand beside a frame word in the name of a part of a page ("ad-box", "site-header"):
# a name of such words alone is one; "social-policy" and "ad-hoc-report" are not.
PART_WORDS = {"area", "article", "articles", "bar", "bottom", "block", "box", "button", "buttons", "col", "column", "container",
              "content", "desktop", "entry", "fixed", "form", "global", "group", "holder", "home", "inner", "item", "items",
              "js", "left", "link", "links", "list", "local", "main", "mobile", "module", "outer", "page", "panel", "post",
              "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "small", "sticky", "story",
              "tertiary", "text", "title", "toggle", "top", "unit", "wp", "wrap", "wrapper", "zone"}
MAIN_WORDS = ({"article", "body"}, {"article", "content"}, {"article", "text"}, {"post", "content"}, {"post", "body"},
              {"entry", "content"}, {"entry", "body"}, {"story", "body"}, {"story", "content"}, {"main", "content"},
              {"page", "content"}, {"content", "body"}, {"article"}, {"content"}, {"main"}, {"story"}, {"post"})


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): htmllib.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(text)}


def _words(value: str) -> set[str]:
    value = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
    return {w for w in re.split(r"[^a-z]+", value.lower()) if w}


def _zone_of(tag: str, attr_text: str, inside: str) -> str | None:
    """The zone an element opens, or None where it keeps that around it."""
    attrs = _attributes(attr_text) if attr_text.strip() else {}
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" \
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return "hidden"
    role = attrs.get("role", "").lower()
    if tag in FRAME or role in FRAME_ROLES:
        return "frame"
    if tag in ("html", "body"):
        return None
    named = [_words(x) for x in re.split(r"\s+", attrs.get("class", "")) + [attrs.get("id", "")]]
    if tag not in HEADINGS:
        # "has-sidebar" and the like tell of a wrapper; an article must be named for one thing only.
        framed = [w for w in named if w & FRAME_WORDS and w <= FRAME_WORDS | PART_WORDS
                  and (tag not in ("article", "main") or w <= FRAME_WORDS)]
        if framed:
            return "byline" if inside == "article" and all(w & FRAME_WORDS <= {"header"} for w in framed) else "frame"
    if tag == "header":
        return "byline" if inside == "article" else "frame"
    if tag == "article" or role == "article" or attrs.get("itemprop", "").lower() == "articlebody":
        return "article"
    if tag == "main" or role == "main":
        return "main"
    if tag in ("div", "section", "td") and any(want <= w for w in named for want in MAIN_WORDS):
        return "main"
    return None


def blocks_of(page: str) -> list[tuple[str, str, bool]]:
    """(zone, text, mostly link text) of every block in page order.

    Zones: article, main, open, frame. A heading in an article's own header belongs to
    the article; what else stands there is frame.
    """
    out: list[tuple[str, str, bool]] = []
    # Open elements, each with its zone; inline ones only from a framed one on. A framed inline
    # element sets aside what its block has said so far, which goes on after it.
    stack: list[tuple[str, str, tuple[list[str], int] | None]] = []
    zone, pos, link, heading = "open", 0, 0, 0
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        words = " ".join("".join(text).split())
        if words:
            own = "article" if zone == "byline" and heading else "frame" if zone == "byline" else zone
            if own != "hidden":
                out.append((own, words, 2 * linked > len(words)))
        text.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            t = htmllib.unescape(raw) if "&" in raw else raw
            text.append(t)
            if link:
                linked += len(t.strip())

    def pop_to(depth: int) -> None:
        nonlocal zone, linked
        while len(stack) > depth:
            aside = stack.pop()[2]
            if aside is not None:
                flush()
                text.extend(aside[0])
                linked = aside[1]
            zone = stack[-1][1] if stack else "open"
            if len(stack) > depth:
                flush()

    while True:
        m = TAG.search(page, pos)
        if m is None:
            say(page[pos:])
            break
        say(page[pos:m.start()])
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        closing, tag, attrs = bool(m[1] or m[4]), name.lower(), (m[3] if m[2] else m[6]) or ""
        if tag in RAW:
            if not closing and not attrs.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[^>]*+>", re.I).search(page, pos)
                if tag not in INLINE:
                    text.append(" ")
                pos = end.end() if end else len(page)
            continue
        if tag == "a":
            link = 0 if closing else 1
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        pop_to(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
            elif tag not in VOID:
                own = _zone_of(tag, attrs, zone) if attrs.strip() else None
                if own in ("hidden", "frame") and zone not in ("hidden", "frame"):
                    stack.append((tag, own, (text[:], linked)))
                    text.clear()
                    linked, zone = 0, own
                elif own == "hidden" or (stack and stack[-1][0] in INLINE):
                    flush()
                    zone = "hidden" if own == "hidden" else zone
                    stack.append((tag, zone, None))
            continue
        flush()
        link = 0
        if closing:
            if tag in HEADINGS:
                heading = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
            flush()
            continue
        if tag in CLOSES_P:
            heading = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    going_on = [(t, z) for t, z, _ in stack[k + 1:] if t in FORMATTING]
                    pop_to(k)
                    flush()
                    for t, z in going_on:
                        stack.append((t, z, ([], 0)))
                        zone = z
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            pop_to(len(stack) - 1)
        if tag in HEADINGS:
            heading = 1
        if tag in VOID or attrs.rstrip().endswith("/"):
            continue
        opened = _zone_of(tag, attrs, zone)
        if zone in ("frame", "hidden") or opened is None or (zone == "article" and opened == "main") \
                or (zone == "byline" and opened not in ("frame", "hidden")):
            opened = zone
        stack.append((tag, opened, None))
        zone = opened
    flush()
    pop_to(0)
    flush()
    return out


def _split_blocks(blocks: list[tuple[str, str, bool]]) -> tuple[list[str], list[str], list[str]]:
    """(article, undecided, frame): every block of the page, by what markup says of it.

    Beside a named article nothing is undecided; without one the repeats decide on the open blocks.
    """
    for zone in ("article", "main"):
        if any(z == zone for z, _, _ in blocks):
            return [t for z, t, _ in blocks if z == zone], [], [t for z, t, _ in blocks if z != zone]
    return [], [t for z, t, _ in blocks if z == "open"], [t for z, t, _ in blocks if z == "frame"]


BYTES = np.array([xxhash.xxh64_intdigest(bytes([i])) for i in range(256)], dtype=np.uint64)


def _token_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per token of a text whose tokens one space parts: bytes by place, summed and mixed."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(b" " + text.encode(), dtype=np.uint8)
    gaps = np.flatnonzero(raw == 32)
    lengths = np.diff(np.r_[gaps, len(raw)])
    powers = np.cumprod(np.full(lengths.max(), 0x9E3779B97F4A7C15, dtype=np.uint64))
    h = np.add.reduceat(BYTES[raw] * powers[np.arange(len(raw)) - np.repeat(gaps, lengths)], gaps)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def window_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """The rank of the suffix at each position, cut off at ``depth`` tokens (none for shorter ones)."""
    n = len(tokens) - depth + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(depth):
        h = (h ^ tokens[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _joined(blocks: list[str]) -> str:
    """Blocks as one string. No block is empty or holds a newline."""
    return "\n".join(blocks)


def _blocks(joined: str) -> list[str]:
    return joined.split("\n") if joined else []


def parse_pages(pages: DataFrame) -> DataFrame:
    """Per page row: ids, host, lot and row number, all blocks (article, undecided, frame) and a hash of its content.

    A lot is up to ``LOT_ROWS`` rows of one task, fewer where their text is long; its number is ``row >> ROW_BITS``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lot = TaskContext.get().partitionId() << 32
        ids, out, size = [], [], 0

        def frame() -> pd.DataFrame:
            return pd.DataFrame([(*i, lot, (lot << ROW_BITS) + k, *x) for k, (i, x) in enumerate(zip(ids, out))], columns=names)

        names = ["page_id", "url", "host", "lot", "row", "article", "undecided", "frame", "content"]
        for b in batches:
            for *own, page in zip(b["page_id"], b["url"], b["host"], b["html"]):
                article, undecided, rest = _split_blocks(blocks_of(page) if page else [])
                content = xxhash.xxh64_intdigest(" ".join(article or undecided)) - (1 << 63)
                ids.append(own)
                out.append((*map(_joined, (article, undecided, rest)), content))
                size += sum(map(len, out[-1][:3]))
                if len(out) == LOT_ROWS or size > LOT_CHARS:
                    yield frame()
                    ids, out, size, lot = [], [], 0, lot + 1
        if out:
            yield frame()

    host, _ = split_url(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"),
                        host.alias("host"), F.col("html").cast("string").alias("html"))
    return rows.mapInPandas(run, "page_id string, url string, host string, lot long, row long, article string, "
                                 "undecided string, frame string, content long")


def page_windows(pages: pd.DataFrame, depth: int) -> tuple[np.ndarray, ...]:
    """(member, starts, ranks, inside, seeds): all windows of the pages' streams.

    A stream is the article, then the other blocks; no window reaches from the article (``inside``) into the
    rest. ``member`` is the page's place in the frame. A window's seed is the smallest hash of the runs of
    ``GRAM`` tokens in it and the host, cut to ``SHELF_BITS`` + 32 bits: equal windows have equal seeds, and
    neighbours mostly share one.
    """
    gram = min(GRAM, depth)
    texts, counts, owner, offset, main, salts = [], [], [], [], [], []
    for i, (host, a, u, f) in enumerate(zip(pages["host"], pages["article"], pages["undecided"], pages["frame"])):
        at, salt = 0, xxhash.xxh64_intdigest(host)
        for in_article, text in ((True, a), (False, "\n".join(x for x in (u, f) if x))):
            if text:
                texts.append(text.replace("\n", " "))
                counts.append(texts[-1].count(" ") + 1)
                owner.append(i)
                offset.append(at)
                main.append(in_article)
                salts.append(salt)
                at += counts[-1]
    tokens = _token_hashes(" ".join(texts))
    counts = np.array(counts, dtype=np.int64)
    ends = np.cumsum(counts)
    whole = np.maximum(counts - depth + 1, 0)
    # The windows that lie within one text: where each begins among all tokens.
    first = np.repeat(ends - counts, whole)
    within = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    place = first + within
    ranks = window_ranks(tokens, depth)[place]
    salt = np.repeat(np.array(salts, dtype=np.uint64), counts)
    grams = (window_ranks(tokens, gram).view(np.uint64) ^ salt[:max(len(tokens) - gram + 1, 0)]) * np.uint64(0x9E3779B97F4A7C15)
    least = np.full(len(place), np.iinfo(np.uint64).max, dtype=np.uint64)
    for j in range(depth - gram + 1):
        np.minimum(least, grams[place + j], out=least)
    # The least of several hashes is small; mixed again, its high bits spread over the shelves.
    least = (least ^ (least >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    seeds = (least >> np.uint64(32 - SHELF_BITS)).view(np.int64)
    member = np.repeat(np.array(owner, dtype=np.int64), whole)
    starts = np.repeat(np.array(offset, dtype=np.int64), whole) + within
    inside = np.repeat(np.array(main, dtype=bool), whole)
    return member, starts, ranks, inside, seeds


def _edges(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    n = len(sorted_keys[0])
    changed = np.zeros(max(n - 1, 0), dtype=bool)
    for k in sorted_keys:
        changed |= k[1:] != k[:-1]
    return np.r_[0, np.flatnonzero(changed) + 1, n] if n else np.zeros(1, dtype=np.int64)


def _squeezed(*columns: np.ndarray) -> bytes:
    """Columns of numbers for a shuffle: byte by byte, so that the high bytes of small numbers take next to nothing."""
    return zlib.compress(b"".join(np.ascontiguousarray(c).view("u1").reshape(len(c), c.itemsize).T.tobytes() for c in columns), 1)


def _objects(values: list) -> pd.Series:
    """A column of arrays or bytes, also where there are none."""
    return pd.Series(values, dtype=object)


def _loosened(packs: Iterable[bytes], *types: str) -> tuple[list[np.ndarray], np.ndarray]:
    """(columns of all packs, rows of each pack)."""
    kinds = [np.dtype(t) for t in types]
    columns, sizes = [[np.empty(0, dtype=k)] for k in kinds], []
    for pack in packs:
        raw, at = np.frombuffer(zlib.decompress(pack), dtype="u1"), 0
        sizes.append(len(raw) // sum(k.itemsize for k in kinds))
        for column, k in zip(columns, kinds):
            end = at + sizes[-1] * k.itemsize
            column.append(np.ascontiguousarray(raw[at:end].reshape(k.itemsize, -1).T).view(k).ravel())
            at = end
    return [np.concatenate(c) for c in columns], np.array(sizes, dtype=np.int64)


def shared_seeds(parsed: DataFrame, depth: int) -> DataFrame:
    """``lot, shelf, low``: the seeds of a lot that rows of other lots have too.

    Seeds travel in packs, one per lot and shelf (their high bits): the sorted low bits of the lot's distinct
    seeds, as differences. A shelf meets in one task and holds one in 1,024 of all seeds; a seed that every
    page of a hot host has adds one number per lot to its shelf.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lot, rows in b.groupby("lot", sort=False):
                seeds = np.unique(page_windows(rows, depth)[-1])
                shelf, low = seeds >> 32, (seeds & 0xFFFFFFFF).astype("<u4")
                cuts = _edges(shelf)
                yield pd.DataFrame({"lot": lot, "shelf": shelf[cuts[:-1]].astype("int32"),
                                    "low": _objects([_squeezed(np.diff(low[i:j], prepend=low.dtype.type(0)))
                                                    for i, j in zip(cuts, cuts[1:])])})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (shelf,), packs in groups(batches, ["shelf"]):
            (steps,), sizes = _loosened(packs["low"], "<u4")
            ends = np.cumsum(sizes)
            # Sums within a pack: the sum over all packs wraps around, and so does what it is lessened by.
            total = np.cumsum(steps, dtype=np.uint32)
            before = np.r_[np.uint32(0), total[ends[:-1] - 1]].astype(np.uint32)
            low, pack_of = total - np.repeat(before, sizes), np.repeat(np.arange(len(packs)), sizes)
            order = np.argsort(low, kind="stable")
            same = low[order[1:]] == low[order[:-1]]
            shared = np.zeros(len(low), dtype=bool)
            shared[order] = np.r_[False, same] | np.r_[same, False]
            found = np.split(low[shared], np.cumsum(np.bincount(pack_of[shared], minlength=len(packs)))[:-1])
            out = pd.DataFrame({"lot": packs["lot"], "shelf": shelf, "low": [_squeezed(x) for x in found]})
            yield out[[len(x) > 0 for x in found]]

    schema = "lot long, shelf int, low binary"
    packs = parsed.where("host != ''").select("lot", "host", "article", "undecided", "frame").mapInPandas(pack, schema)
    return packs.repartition("shelf").sortWithinPartitions("shelf").mapInPandas(meet, schema)


def twins(parsed: DataFrame) -> DataFrame:
    """``lot, row, kind, first``: rows that share their page id (kind 0) or a host's content (kind 1) with an earlier row.

    ``first`` is the earliest such row. It stands for the id or content, as a row's own number does for all others.
    """
    rows = parsed.where("host != ''").select("lot", "row", F.xxhash64(F.coalesce("page_id", F.col("row").cast("string"))).alias("page"),
                                             F.xxhash64("host", "content").alias("said"))
    found = []
    for kind, key in enumerate(("page", "said")):
        first = rows.groupBy(key).agg(F.min("row").alias("first"), F.max("row").alias("last")).where("first < last")
        found.append(rows.join(first.select(key, "first"), key).where("first < row").select("lot", "row", F.lit(kind).alias("kind"), "first"))
    return found[0].unionAll(found[1])


def search_windows(parsed: DataFrame, depth: int) -> DataFrame:
    """Per row, the windows that may repeat: ``starts``, ``ranks``, ``inside`` (the article); ``page`` and
    ``content`` stand for the row's page id and content (:func:`twins`).

    Equal windows share their seed, so no repeat is among the windows left out.
    """
    found = save(shared_seeds(parsed, depth).select("lot", "shelf", "low", F.lit(0).cast("long").alias("row"),
                                                    F.lit(0).cast("long").alias("first")).unionAll(
        twins(parsed).select("lot", -1 - F.col("kind"), F.lit(b""), "row", "first")), "html-seeds")

    def run(pages: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows = pages["row"].to_numpy(dtype=np.int64)
        member, starts, ranks, inside, seeds = page_windows(pages, depth)
        packs = found[found["shelf"] >= 0]
        (low,), sizes = _loosened(packs["low"], "<u4")
        elsewhere = (np.repeat(packs["shelf"].to_numpy(dtype=np.int64), sizes) << 32) | low.astype(np.int64)
        pairs = np.unique((seeds << ROW_BITS) | member) >> ROW_BITS
        asked = np.isin(seeds, np.r_[elsewhere, pairs[1:][pairs[1:] == pairs[:-1]]])
        cuts = np.cumsum(np.bincount(member[asked], minlength=len(rows)))[:-1]
        out = pd.DataFrame({"lot": pages["lot"].iloc[0], "row": rows, "host": pages["host"].to_numpy(), "page": rows, "content": rows,
                            "starts": np.split(starts[asked].astype(np.int32), cuts),
                            "ranks": np.split(ranks[asked], cuts), "inside": np.split(inside[asked], cuts)})
        place = {r: i for i, r in enumerate(rows)}
        for shelf, row, first in zip(found["shelf"], found["row"], found["first"]):
            if shelf < 0:
                out.iat[place[row], 3 if shelf == -1 else 4] = first
        return out[[len(x) > 0 for x in out["starts"]]]

    pages = parsed.where("host != ''").select("lot", "row", "host", "article", "undecided", "frame")
    return pages.groupBy("lot").cogroup(found.groupBy("lot")).applyInPandas(
        run, "lot long, row long, host string, page long, content long, starts array<int>, ranks array<long>, inside array<boolean>")


def _lot_windows(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """(place of the row, start, inside, hash of host and window) for all windows of a lot's rows."""
    sizes = rows["ranks"].map(len).to_numpy(dtype=np.int64)
    joined = lambda arrays, kind: np.concatenate([np.empty(0, dtype=kind), *arrays]).astype(kind)
    starts = joined(rows["starts"] if "starts" in rows else [np.arange(n) for n in sizes], np.int32)
    inside = joined(rows["inside"], bool) if "inside" in rows else np.zeros(len(starts), dtype=bool)
    salt = np.array([xxhash.xxh64_intdigest(h) for h in rows["host"]], dtype=np.uint64)
    window = (joined(rows["ranks"], np.int64).view(np.uint64) ^ np.repeat(salt, sizes)) * np.uint64(0x9E3779B97F4A7C15)
    window = (window ^ (window >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.repeat(np.arange(len(rows)), sizes), starts, inside, window


def covered_positions(searched: DataFrame, *differ: str) -> DataFrame:
    """``row, covered, lost``: sorted stream positions at which a repeated window begins.

    A window repeats where rows of one host differ in page id (its number ``page``, where there is that column)
    and in the columns ``differ``. It is ``lost`` where it stands outside an article and repeats without the
    articles that hold it. ``ranks`` are those of the positions ``starts`` (without that column: of all, in order).

    A lot's distinct windows travel in packs, one per shelf (high bits of the window's hash), each window with the
    bounds of what its rows differ in. A shelf meets in one task and holds one in 1,024 of them; a window that every
    page of a hot host has adds one entry per lot. Two flags per window come back to the lot, in the same order.
    """
    names = ["page", *differ]
    types = ["<u8", "<u2", "?", *["<i8"] * 4 * len(names)]
    least, most = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    page = F.col("page") if "page" in searched.columns else F.xxhash64(F.coalesce("page_id", F.col("row").cast("string")))
    lot = F.col("lot") if "lot" in searched.columns else F.shiftright("row", ROW_BITS)
    held = [c for c in ("row", "host", "ranks", "starts", "inside") if c in searched.columns]
    searched = searched.where("host != ''").select(lot.alias("lot"), *held, page.alias("page"), *differ)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        place, _, inside, window = _lot_windows(rows)
        order = np.argsort(window, kind="stable")
        edge = _edges(window[order])
        first, member, out = edge[:-1], place[order], ~inside[order]
        window = window[order][first]
        own = rows["row"].to_numpy(dtype=np.int64)[member]
        columns = [(np.minimum.reduceat(own, first) & (LOT_ROWS - 1)).astype("<u2"), np.logical_or.reduceat(out, first)] if len(first) else []
        for k in names if len(first) else ():
            k = rows[k].to_numpy(dtype=np.int64)[member]
            low, high = np.minimum.reduceat(k, first), np.maximum.reduceat(k, first)
            out_low = np.minimum.reduceat(np.where(out, k, least), first)
            out_high = np.maximum.reduceat(np.where(out, k, most), first)
            # As differences, which are mostly zero (and may wrap around).
            columns += [low - np.minimum.reduceat(own, first), high - low,
                        np.where(columns[1], out_low - low, 0), np.where(columns[1], high - out_high, 0)]
        shelf = window >> np.uint64(64 - SHELF_BITS)
        cuts = _edges(shelf)
        return pd.DataFrame({"lot": rows["lot"].iloc[0], "shelf": shelf[cuts[:-1]].astype("int32"),
                             "data": _objects([_squeezed(np.diff(window[i:j], prepend=np.uint64(0)), *(c[i:j] for c in columns))
                                               for i, j in zip(cuts, cuts[1:])])})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (shelf,), packs in groups(batches, ["shelf"]):
            (steps, member, some_out, *bounds), sizes = _loosened(packs["data"], *types)
            ends = np.cumsum(sizes)
            total = np.cumsum(steps, dtype=np.uint64)
            window = total - np.repeat(np.r_[np.uint64(0), total[ends[:-1] - 1]], sizes)
            own = np.repeat(packs["lot"].to_numpy(dtype=np.int64) << ROW_BITS, sizes) | member
            order = np.argsort(window, kind="stable")
            edge = _edges(window[order])
            first, runs = edge[:-1], np.diff(edge)
            repeats, outside = np.ones(len(runs), dtype=bool), np.ones(len(runs), dtype=bool)
            for i in range(0, len(bounds), 4):
                low = own + bounds[i]
                high = low + bounds[i + 1]
                repeats &= np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
                low, high = np.where(some_out, low + bounds[i + 2], least), np.where(some_out, high - bounds[i + 3], most)
                outside &= np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
            flags = np.empty(len(window), dtype="u1")
            flags[order] = np.repeat(repeats + 2 * (repeats & outside), runs)
            yield pd.DataFrame({"lot": packs["lot"], "shelf": shelf,
                                "data": [_squeezed(x) for x in np.split(flags, ends[:-1])]})

    def mark(rows: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        place, starts, inside, window = _lot_windows(rows)
        (flag,), _ = _loosened(flags.sort_values("shelf")["data"], "u1")
        flag = flag[np.unique(window, return_inverse=True)[1]]
        lost = (flag > 1) & ~inside
        order = np.lexsort((starts, place))
        order = order[flag[order] > 0]
        place, starts, lost = place[order], starts[order], lost[order]
        cuts = _edges(place)
        return pd.DataFrame({"row": rows["row"].to_numpy(dtype=np.int64)[place[cuts[:-1]]],
                             "covered": _objects([starts[i:j] for i, j in zip(cuts, cuts[1:])]),
                             "lost": _objects([starts[i:j][lost[i:j]] for i, j in zip(cuts, cuts[1:])])})

    schema = "lot long, shelf int, data binary"
    packs = searched.groupBy("lot").applyInPandas(pack, schema)
    flags = packs.repartition("shelf").sortWithinPartitions("shelf").mapInPandas(meet, schema)
    return searched.drop("page", *differ).groupBy("lot").cogroup(flags.groupBy("lot")).applyInPandas(
        mark, "row long, covered array<int>, lost array<int>")


def unique_runs(blocks: list[str], covered: list[int], depth: int) -> str:
    """The blocks without the tokens that the repeated windows cover; emptied blocks go.

    A window may reach a few tokens into the block beside a repeated one; a covered run
    shorter than ``depth`` goes only where it is the whole block.
    """
    end = sum(t.count(" ") + 1 for t in blocks)
    lost = {i for p in covered if p < end for i in range(p, p + depth)}
    if not lost:
        return "\n".join(blocks)
    out, at = [], 0
    for text in blocks:
        words = text.split(" ")
        kept, run = [], []
        for i, w in enumerate(words, at):
            if i in lost:
                run.append(w)
                continue
            if len(run) < depth:
                kept += run
            run = []
            kept.append(w)
        if kept and len(run) < depth:
            kept += run
        at += len(words)
        if kept:
            out.append(" ".join(kept))
    return "\n".join(out)


def extract_main_text(pages: DataFrame, depth: int = MIN_TOKENS) -> DataFrame:
    """``page_id, url, text, n_chars, n_covered`` for every row; ``n_covered``: covered windows."""
    with shuffles_released(pages.sparkSession):
        parsed = save_bucketed(parse_pages(pages), "html-blocks", "lot")
        searched = save_bucketed(search_windows(parsed, depth), "html-windows", "lot")
        covered = save(covered_positions(searched, "content"), "html-covered")
    covered = covered.select(F.shiftright("row", ROW_BITS).alias("lot"), "row", F.size("covered").cast("long").alias("n_covered"), "lost")

    def run(pages: pd.DataFrame, covered: pd.DataFrame) -> pd.DataFrame:
        # Unique runs stay. The check by markup has put back what repeats in an article
        # (such windows are not lost), and takes the frame, unique runs or not.
        found = {row: (n, lost) for row, n, lost in zip(covered["row"], covered["n_covered"], covered["lost"])}
        hits = [found.get(row, (0, ())) for row in pages["row"]]
        texts = [unique_runs(_blocks(a) + _blocks(u), list(lost), depth)
                 for a, u, (_, lost) in zip(pages["article"], pages["undecided"], hits)]
        return pd.DataFrame({"page_id": pages["page_id"], "url": pages["url"], "text": texts, "n_chars": [len(t) for t in texts],
                             "n_covered": [n for n, _ in hits]})

    rows = parsed.select("lot", "row", "page_id", "url", "article", "undecided")
    out = rows.groupBy("lot").cogroup(covered.groupBy("lot")).applyInPandas(
        run, "page_id string, url string, text string, n_chars long, n_covered long")
    return out.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
