"""HTML extraction (operator 5): nearest-URL page differencing.

1. Every page becomes lines: the text of its blocks in page order, character
   references decoded, white space inside a block one space.  Markup gives each
   line a zone: chrome (menus, page headers, footers, sidebars, notices,
   adverts, forms, comments, hidden parts), main (inside an article or main
   element or one named so) or open.
2. Distinct URL paths are sorted within their hosts (a range partitioning by
   host and path, so a large host spreads over many tasks); a page's partner is
   the neighbouring path with the longer common prefix (the earlier one on a tie).
3. The lines of page and partner are aligned by their longest common
   subsequence; aligned lines are shared.
4. Shared lines are deleted, with two limits: what the markup declares to be the
   article is never deleted (articles share passages, and copies share all), and
   a page all of whose lines are shared is a copy and keeps them.  Chrome lines
   are deleted shared or not.  Where a page declares an article, lines outside it
   are no part of it.

Defined results: null or empty html has an empty text; pages without ``://`` in
the URL (or a null URL) count to the empty host and path; pages with equal host
and path have the same partner, and the page with the smallest id speaks for
them; repeated rows are extracted one by one.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from poolbook.llm.common import stored
from poolbook.llm.url_filter import with_host_path

CHROME, MAIN, OPEN = 0, 1, 2
#: Bits of alignment state that one LCS step keeps (128 MB); larger inputs are split.
LCS_BITS = 1 << 30

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is no markup, or no text of the page.
_SKIP = frozenset("script style template noscript iframe object svg math title textarea select button canvas audio video noembed noframes xmp".split())
_CHROME_TAG = frozenset("nav aside footer form dialog menu head".split())
_CHROME_ROLE = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status".split())
_CHROME_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright "
    "disqus footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
_MAIN_NAME = frozenset("article content main post entry story".split())
#: What a start tag closes when it is open, up to the elements that fence it off.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}


def _zone(tag: str, attributes: str, outer: int, form: bool) -> int:
    """Zone of an element inside ``outer``; form: the chrome comes from a form only."""
    found = {k.lower(): (a or b or c).lower() for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    declared = tag in ("article", "main") or found.get("role") in ("main", "article")
    if outer == CHROME and not (form and declared):
        return CHROME
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return CHROME
    names = set(re.split(r"[^a-z0-9]+", f"{found.get('class', '')} {found.get('id', '')}"))
    page = tag in ("html", "body")
    if not page and (tag in _CHROME_TAG or found.get("role") in _CHROME_ROLE or names & _CHROME_NAME):
        return CHROME
    if (tag == "header" or "header" in names) and outer != MAIN and not declared and not page:
        return CHROME
    if declared or (not page and names & _MAIN_NAME and tag in ("div", "section", "td")):
        return MAIN
    return OPEN if outer == CHROME else outer


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(text, zone) of the page's blocks, in page order, without empty ones."""
    page = page or ""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool]] = [("", OPEN, False)]  # tag, zone, chrome only by a form
    buffer: list[str] = []

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        if text:
            out.append((text, stack[-1][1]))
        buffer.clear()

    at = 0
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            buffer.append(_html.unescape(text))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                buffer.append(m[0][9:].removesuffix("]]>"))
            continue
        if m[1] or m[4]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if k and (tag in _BLOCK or not any(t in _BLOCK for t, _, _ in stack[k + 1 :])):
                if tag in _BLOCK or any(z != stack[k - 1][1] for _, z, _ in stack[k:]):
                    flush()
                del stack[k:]
            elif tag in _BLOCK:
                flush()
            continue
        if tag in _SKIP:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            if tag == "title":
                flush()
            continue
        if tag == "br":
            buffer.append(" ")
        if tag in _VOID:
            if tag in _BLOCK:
                flush()
            continue
        if tag in _BLOCK:
            flush()
            k = len(stack) - 1  # an open paragraph ends here
            while k and stack[k][0] not in _BLOCK:
                k -= 1
            if stack[k][0] == "p":
                del stack[k:]
        if tag == "body":  # the head ends here, closed or not
            stack[:] = [s for s in stack if s[0] != "head"]
        if tag in _CLOSES:
            these, fence = _CLOSES[tag]
            k = len(stack) - 1
            while k and stack[k][0] not in fence and stack[k][0] not in these:
                k -= 1
            if stack[k][0] in these:
                flush()
                del stack[k:]
        _, outer, form = stack[-1]
        zone = _zone(tag, m[3] or m[6] or "", outer, form)
        if zone != outer and tag not in _BLOCK:
            flush()
        stack.append((tag, zone, zone == CHROME and (form or (tag == "form" and outer != CHROME))))
    flush()
    return out


def line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _states(a: list[int], b: list[int]) -> list[int]:
    """Bit-parallel LCS: after each element of a, bit j is 0 where the length
    of the common subsequence grows at b[j]."""
    mask: dict[int, int] = {}
    for j, x in enumerate(b):
        mask[x] = mask.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, out = full, []
    for x in a:
        u = v & mask.get(x, 0)
        v = ((v + u) | (v - u)) & full
        out.append(v)
    return out


def _lengths(v: int, m: int) -> np.ndarray:
    """LCS length with every prefix of b, 0 .. m, from a state."""
    bits = np.unpackbits(np.frombuffer(v.to_bytes(m // 8 + 1, "little"), np.uint8), bitorder="little")[:m]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def shared(a: list[int], b: list[int]) -> np.ndarray:
    """Flags over ``a``: the elements of one longest common subsequence with ``b``."""
    out = np.zeros(len(a), bool)
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    out[:low] = True
    out[len(a) - high :] = True
    inner = b[low : len(b) - high]
    both = set(a[low : len(a) - high]) & set(inner)
    places = [i for i in range(low, len(a) - high) if a[i] in both]
    x, y = [a[i] for i in places], [v for v in inner if v in both]
    if not x or not y:
        return out
    if len(x) * len(y) > LCS_BITS and len(x) > 1:
        # split a where the two halves' lengths add up to the most (linear memory)
        mid = len(x) // 2
        left = _lengths(_last(x[:mid], y), len(y))
        right = _lengths(_last(x[mid:][::-1], y[::-1]), len(y))[::-1]
        cut = int((left + right).argmax())
        flags = np.concatenate([shared(x[:mid], y[:cut]), shared(x[mid:], y[cut:])])
    else:
        flags = np.zeros(len(x), bool)
        states, i, j = _states(x, y), len(x), len(y)
        while i and j:
            if states[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or states[i - 1] >> (j - 1) & 1:
                    flags[i] = True
                    j -= 1
    out[np.array(places)[flags]] = True
    return out


def _last(a: list[int], b: list[int]) -> int:
    mask: dict[int, int] = {}
    for j, x in enumerate(b):
        mask[x] = mask.get(x, 0) | 1 << j
    full = v = (1 << len(b)) - 1
    for x in a:
        u = v & mask.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return v


def keep_lines(zones: list[int], same: np.ndarray) -> list[bool]:
    """What of a page is text, given its zones and shared lines."""
    if MAIN in zones:
        return [z == MAIN for z in zones]
    mine = [i for i, z in enumerate(zones) if z == OPEN]
    copy = all(same[i] for i in mine)
    return [z == OPEN and (copy or not same[i]) for i, z in enumerate(zones)]


def text_zone(zones: bytes | list[int]) -> int:
    """The only zone of a page whose lines can be text."""
    return MAIN if MAIN in zones else OPEN


def page_lines(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", texts: bool = True) -> DataFrame:
    """page_id, url, host, path, body, zones, keys: zones (a byte) and hashes of
    all lines; body holds the lines of the zone that can be text, one a row,
    compressed, as they are shuffled once (null without ``texts``)."""
    def body(lines: list[tuple[str, int]]) -> bytes | None:
        if not texts:
            return None
        zone = text_zone([z for _, z in lines])
        return zlib.compress("\n".join(t for t, z in lines if z == zone).encode(), 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = [lines_of(p) for p in part.column("html").to_pylist()]
                yield pa.record_batch(
                    [*(part.column(c) for c in ("page_id", "url", "host", "path")),
                     pa.array([body(x) for x in got], pa.binary()), pa.array([bytes(z for _, z in x) for x in got], pa.binary()),
                     pa.array([[line_hash(t) for t, _ in x] for x in got], pa.list_(pa.int64()))],
                    names=["page_id", "url", "host", "path", "body", "zones", "keys"])

    slim = with_host_path(pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    return slim.select("page_id", "url", "host", "path", "html").mapInArrow(
        run, "page_id bigint, url string, host string, path string, body binary, zones binary, keys array<bigint>")


def _nearest(path: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
    """The neighbour with the longer common prefix; null if there is none."""
    def common(a: str, b: str) -> int:
        n = 0
        for x, y in zip(a, b):
            if x != y:
                break
            n += 1
        return n

    return pd.Series([b if a is None or (b is not None and common(p, b) > common(p, a)) else a for p, a, b in zip(path, before, after)], dtype=object)


def partners(lines: DataFrame) -> DataFrame:
    """host, path, partner: the nearest other path of every distinct URL path.

    Sorted ranges are written once; neighbours come from windows inside each
    range, and across their borders from the ranges' first and last rows (one
    row per range)."""
    urls = lines.select("host", "path").distinct().repartitionByRange("host", "path").sortWithinPartitions("host", "path")
    urls = stored(urls.withColumn("part", F.spark_partition_id()), "urls")
    inside = W.partitionBy("part").orderBy("host", "path")
    here = F.struct("host", "path")
    borders = urls.groupBy("part").agg(F.min(here).alias("low"), F.max(here).alias("high"))
    across = W.orderBy("part")
    borders = borders.select("part", F.lag("high").over(across).alias("high"), F.lead("low").over(across).alias("low"))
    df = urls.withColumns({"before": F.lag(here).over(inside), "after": F.lead(here).over(inside)}).join(F.broadcast(borders), "part")
    own = lambda s: F.when(s["host"] == F.col("host"), s["path"])
    nearest = F.pandas_udf(_nearest, "string")
    return df.select("host", "path", nearest(F.col("path"), own(F.coalesce("before", "high")), own(F.coalesce("after", "low"))).alias("partner"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_lines and n_shared (lines that the page has
    in common with its partner) of every page."""
    # Hashes are stored; the texts, most of a page, are read again from the pages
    # where they are needed, so that they go to disk once, in the join's shuffle.
    lines = stored(page_lines(pages, id_col, url_col, html_col, texts=False).select("page_id", "host", "path", "keys"), "lines")
    pair = stored(partners(lines), "partners")
    # The lines that speak for a path; only paths with a partner take part.
    speaker = lines.groupBy("host", "path").agg(F.min_by("keys", F.struct(F.coalesce(F.col("page_id"), F.lit(0)), F.xxhash64("keys"))).alias("others"))
    other = pair.filter("partner IS NOT NULL").select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("partner").alias("path"), F.col("host")) \
        .join(speaker, ["host", "path"]).select("_h", "_p", "others")
    whole = page_lines(pages, id_col, url_col, html_col)
    both = whole.join(other, (whole["host"] == other["_h"]) & (whole["path"] == other["_p"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_shared, n_lines = [], [], []
            for body, zones, keys, others in zip(*(batch.column(c).to_pylist() for c in ("body", "zones", "keys", "others"))):
                same, zone = shared(keys, others or []), text_zone(zones)
                own = zlib.decompress(body).decode().split("\n")
                kept = [on for on, z in zip(keep_lines(list(zones), same), zones) if z == zone]
                texts.append("\n".join(t for t, on in zip(own, kept) if on))
                n_shared.append(int(same.sum()))
                n_lines.append(len(zones))
            yield pa.record_batch({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()), "n_lines": pa.array(n_lines, pa.int64()), "n_shared": pa.array(n_shared, pa.int64()),
            })

    return both.select("page_id", "url", "body", "zones", "keys", "others").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint, n_lines bigint, n_shared bigint")
