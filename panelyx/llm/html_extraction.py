"""Main text of web pages by nearest-URL page differencing (operator 9).

Pages are dealt by range over host and URL path, so that neighbours in the sorted order are the pages of one host
whose paths lie nearest, and no host, however large, has to fit into one task. The ranges are fixed first, over the keys
alone; the REACH pages on either side of a range go to it as well, so that every page meets the same neighbours however
many ranges there are. Each page becomes text lines (one for
each block); lines of elements that the markup itself names as furniture (navigation, footers, asides, forms, scripts,
adverts, notices, comments of readers) go. The lines outside the article element, furniture included, are aligned with
those of the neighbours by longest common subsequence, and shared lines are deleted there. So are the lines inside an
article or main element, with those inside of the REACH nearest pages on either side; there a line goes only if nearly all of
them share it, at the same place in their markup, and if it is no heading: what a host repeats in every article goes, prose that
two articles have in common stays. Copies of the article, and of each other, are not asked. On pages without such an element a neighbour that shares most of the text
counts as a copy and is passed over.

Defined results: null and empty html give an empty text; a null url sorts first, as a host of its own; repeated rows
are extracted one by one; a page that has no neighbour of its host is judged by markup alone; very long pages take time
in proportion to their length, but for alignment of lines that repeat often: that takes (lines of one page) x (lines of
the other) / 64 steps and memory of some rows of that table; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, small_batches

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea iframe svg math object canvas audio video noframes xmp title".split())
_FURNITURE = frozenset("head nav footer aside form button select dialog menu header".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_MAIN = frozenset("article main".split())
#: Neighbours on either side of a page that lines of its article are aligned with.
REACH = 3
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|footer\w*|masthead|topbar|header|"
    r"cookies?|consent|notice|gdpr|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommend\w*|"
    r"comments?|commentlist|disqus|replies|reply|widget|toolbar|pagination|pager|copyright|legal|hidden)(?:$|[\s_-])"
)
#: Names that mark furniture inside an article too; a heading or a legal passage there is the article's own.
_NAMED_INSIDE = re.compile(_NAMED.pattern.replace("masthead|topbar|header|", "").replace("|copyright|legal|", "|"))
#: How many of the innermost elements are a line's place.
PLACE = 4
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Lines inside an article go only where so many neighbours share them, and so large a part of all that have an article of their own.
LEAST_SHARING, SHARING = 2, 0.9
#: Pairs of equal lines up to which the candidates of an alignment are listed one by one.
PAIRS = 200_000
_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
#: An open element of these ends where another of the same set begins.
_ENDS = {"p": frozenset("p".split()), "li": frozenset("li".split()), "dd": frozenset("dd dt".split()), "dt": frozenset("dd dt".split()), "tr": frozenset("tr td th".split()), "td": frozenset("td th".split()), "th": frozenset("td th".split()), "option": frozenset("option".split())}
_WIDE = frozenset("article main section div nav footer header aside form table ul ol dl body html blockquote".split())


def _furniture(tag: str, attributes: str, named: re.Pattern = _NAMED) -> bool:
    if tag in _FURNITURE:
        return True
    if not attributes or tag in ("body", "html"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = (a or b or c).lower()
        if name in ("class", "id") and named.search(value) or name == "role" and value in _ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


Line = tuple[str, bool, bool, str]


def lines_of(html: str | None) -> list[Line]:
    """Text lines of a page in order, with two marks each, inside an article or main element and inside furniture (never both), and their place: the innermost elements."""
    html = html or ""
    out: list[Line] = []
    open_tags: list[tuple[str, bool, bool]] = []  # tag, inside main, inside furniture
    parts: list[str] = []
    depth: Counter = Counter()

    def close(k: int) -> None:
        depth.subtract(t for t, _, _ in open_tags[k:])
        del open_tags[k:]

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            around = open_tags[-PLACE:]
            out.append((text, around[-1][1] if around else False, around[-1][2] if around else False, ">".join(t for t, _, _ in around)))

    at, end = 0, len(html)
    while at < end:
        m = _PIECE.search(html, at)
        if not m:
            parts.append(html[at:])
            break
        parts.append(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _RAW:
            if not m[1] and not m[3].endswith("/"):
                closing = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = closing.end() if closing else end
            continue
        if tag in _BLOCKS:
            flush()
        if m[1]:
            if depth[tag] > 0:
                for k in range(len(open_tags) - 1, -1, -1):
                    if open_tags[k][0] == tag:
                        close(k)
                        break
                    # a stray end tag inside an element that bounds its content closes nothing outside it
                    if tag not in _WIDE and open_tags[k][0] in _WIDE:
                        break
        elif tag not in _VOID and tag in _BLOCKS:
            if tag in _ENDS:
                while open_tags and open_tags[-1][0] in _ENDS[tag]:
                    close(len(open_tags) - 1)
            elif open_tags and open_tags[-1][0] == "p":
                close(len(open_tags) - 1)
            main, furniture = open_tags[-1][1:] if open_tags else (False, False)
            own = _furniture(tag, m[3], _NAMED_INSIDE if main else _NAMED)
            # an article may have a header of its own: its heading belongs to the text
            own = own and not (tag == "header" and main)
            # an article inside furniture is a teaser or a comment, not the page's article
            furniture = furniture or own
            open_tags.append((tag, (main or tag in _MAIN) and not furniture, furniture))
            depth[tag] += 1
    flush()
    return out


def common_lines(a: list[str], b: list[str], pairs: int = PAIRS) -> set[int]:
    """Indices in a of a longest common subsequence of a and b.

    Equal ends first. If the rest has few pairs of equal lines, these are the candidates (Hunt and Szymanski); else rows of the
    table of lengths are bit sets, of which every some hundredth is kept and the others are made again on the way back.
    """
    low, high_a, high_b = 0, len(a), len(b)
    while low < min(high_a, high_b) and a[low] == b[low]:
        low += 1
    while low < min(high_a, high_b) and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
    shared = {*range(low), *range(high_a, len(a))}
    places: dict[str, list[int]] = {}
    for j in range(high_b - 1, low - 1, -1):
        places.setdefault(b[j], []).append(j)
    rows = [i for i in range(low, high_a) if a[i] in places]
    if sum(len(places[a[i]]) for i in rows) > pairs:
        return shared | _common_by_bits(a, rows, places, low, high_b)
    ends: list[int] = []
    links: list[tuple] = []
    for i in rows:
        for j in places[a[i]]:
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        shared.add(link[0])
        link = link[1]
    return shared


def _common_by_bits(a: list[str], rows: list[int], places: dict[str, list[int]], low: int, high: int) -> set[int]:
    """The rows of a longest common subsequence with columns low to high. A bit is 0 where the length grows at its column."""
    width = high - low
    full = (1 << width) - 1
    frequent: dict[str, int] = {}

    def mask(line: str) -> int:
        found = frequent.get(line)
        if found is None:
            data = bytearray(width // 8 + 1)
            for j in places[line]:
                data[(j - low) >> 3] |= 1 << ((j - low) & 7)
            found = int.from_bytes(data, "little")
            if len(places[line]) > 64:
                frequent[line] = found
        return found

    def after(v: int, i: int) -> int:
        u = v & mask(a[i])
        return ((v + u) | (v - u)) & full

    stride = max(1, int(len(rows) ** 0.5))
    kept, v = [], full
    for k, i in enumerate(rows):
        if k % stride == 0:
            kept.append(v)
        v = after(v, i)
    out: set[int] = set()
    column = width
    for block in range(len(kept) - 1, -1, -1):
        first = block * stride
        block_rows = rows[first : first + stride]
        states = [kept[block]]
        for i in block_rows:
            states.append(after(states[-1], i))
        # bytes, as one bit of a long integer costs a copy of it
        tables = [x.to_bytes(width // 8 + 1, "little") for x in states]
        grown = lambda k, c: not tables[k][(c - 1) >> 3] >> ((c - 1) & 7) & 1
        k = len(block_rows)
        while k and column:
            if not grown(k, column):
                column -= 1
            else:
                k -= 1
                if not grown(k, column):
                    out.add(block_rows[k])
                    column -= 1
    return out


def _alike(a: list[str], b: list[str], copy_share: float) -> bool:
    """Whether two articles share more than copy_share of the shorter one's text, wherever it stands."""
    x, y = set(a), set(b)
    return sum(map(len, x & y)) > copy_share * min(sum(map(len, x)), sum(map(len, y)))


def main_text(page: list[Line], near: list[list[Line]], far: list[list[Line]] = (), *, copy_share: float = 0.5) -> tuple[str, int]:
    """Lines left, joined by a line feed, and the number of lines that alignment deleted.

    Lines outside article and main elements are aligned with those of the near neighbours and go where shared. On a
    page without such an element, a neighbour that shares more than copy_share of the free text is a copy and is passed
    over. Lines inside are aligned, together with their place, with those inside of all neighbours, near and far. They go where
    nearly all neighbours share them (LEAST_SHARING of them at least), as what a host sets into every article does and a sentence that
    some articles quote does not; headings never go. A neighbour that shares more than copy_share of the article is a copy of it and
    is passed over, and so is one that is a copy of another neighbour. What alignment leaves goes too if it is furniture by
    its markup, or stands outside the page's article.
    """
    loose = [i for i, line in enumerate(page) if not line[1]]
    inside = [i for i, line in enumerate(page) if line[1]]
    own = [page[i][0] for i in loose]
    size = sum(len(page[i][0]) for i in loose if not page[i][2]) or 1
    gone: set[int] = set()
    for other in near:
        shared = {loose[k] for k in common_lines(own, [line[0] for line in other if not line[1]])}
        if inside or sum(len(page[i][0]) for i in shared if not page[i][2]) <= copy_share * size:
            gone |= shared
    if inside:
        placed = lambda lines: [f"{line[3]}\0{line[0]}" for line in lines if line[1]]
        article = placed(page)
        size = sum(len(page[i][0]) for i in inside)
        sharing: Counter = Counter()
        heard: list[list[str]] = []
        for other in (*near, *far):
            body = [line[0] for line in other if line[1]]
            if not body or any(_alike(body, x, copy_share) for x in heard):
                continue
            shared = {inside[k] for k in common_lines(article, placed(other))}
            if sum(len(page[i][0]) for i in shared) > copy_share * size or _alike([page[i][0] for i in inside], body, copy_share):
                continue
            heard.append(body)
            sharing.update(shared)
        enough = max(LEAST_SHARING, SHARING * len(heard))
        gone |= {i for i, n in sharing.items() if n >= enough and not _HEADINGS & set(page[i][3].split(">"))}
    return "\n".join(line[0] for i, line in enumerate(page) if i not in gone and not line[2] and (line[1] or not inside)), len(gone)


_ORDER = ["host", "path", "link", "id"]


def _edges(keys: DataFrame, ranges: int) -> list[tuple[int, list[tuple]]]:
    """The first and last REACH keys of every range, in order; at most 2 * REACH * ranges keys, whatever the table holds."""

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first: list[tuple] = []
        last: list[tuple] = []
        n = 0
        for pdf in batches:
            rows = list(pdf[_ORDER].itertuples(index=False, name=None))
            n += len(rows)
            first += rows[: REACH - len(first)] if len(first) < REACH else []
            last = (last + rows)[-REACH:]
        rows = first + last[max(0, len(first) + len(last) - n) :]
        if rows:
            yield pd.DataFrame(rows, columns=_ORDER)

    schema = "host string, path string, link string, id long"
    dealt = keys.repartitionByRange(ranges, *_ORDER).sortWithinPartitions(*_ORDER).mapInPandas(ends, schema)
    found: dict[int, list[tuple]] = {}
    for r in dealt.select(F.spark_partition_id().alias("p"), *_ORDER).collect():
        found.setdefault(r["p"], []).append(_key(*r[1:]))
    return sorted(found.items())


def _key(host: str, path: str, link: str, number: int) -> tuple:
    """Spark orders strings by their UTF-8 bytes."""
    return (*(x.encode("utf-8", "surrogatepass") for x in (host, path, link)), number)


class Ranges:
    """Where a key belongs, and which other ranges need it as a neighbour."""

    def __init__(self, edges: list[list[tuple]]):
        self.firsts = [e[0] for e in edges]
        flat = [(k, p) for p, e in enumerate(edges) for k in e]
        place = {p: i for i, (_, p) in reversed(list(enumerate(flat)))}
        stop = {p: i for i, (_, p) in enumerate(flat)}
        self.low = [flat[max(0, place[p] - REACH)][0] for p in range(len(edges))]
        self.high = [flat[min(len(flat) - 1, stop[p] + REACH)][0] for p in range(len(edges))]

    def of(self, key: tuple) -> list[int]:
        home = max(0, bisect_right(self.firsts, key) - 1)
        out = [home]
        for q in range(home + 1, min(home + 1 + REACH, len(self.firsts))):
            if key >= self.low[q]:
                out.append(q)
        for q in range(home - 1, max(home - 1 - REACH, -1), -1):
            if key <= self.high[q]:
                out.append(q)
        return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_shared_lines (lines deleted by alignment) of every row of pages."""
    spark = pages.sparkSession
    small_batches(spark, 200)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"),
        url.alias("link"),
        F.coalesce(F.col("page_id").cast("long"), F.lit(-(2**63))).alias("id"),
    )
    ranges = shuffle_partitions(spark)
    edges = [e for _, e in _edges(keyed.select(*_ORDER), ranges)]
    sent = spark.sparkContext.broadcast(Ranges(edges) if edges else None)

    @F.pandas_udf("array<int>")
    def targets(host: pd.Series, path: pd.Series, link: pd.Series, number: pd.Series) -> pd.Series:
        return pd.Series([sent.value.of(_key(*x)) for x in zip(host, path, link, number.astype(int).tolist(), strict=True)])

    each = keyed.select("page_id", "url", "html", *_ORDER, F.posexplode(targets(*_ORDER)).alias("place", "range"))
    dealt = each.repartitionById(ranges, "range").sortWithinPartitions("range", *_ORDER)

    def differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (host, lines, page_id, url, own); only 2 * REACH + 1 pages are held at a time besides the batch
        at = 0  # the first page of held that is not finished
        done: list[tuple] = []
        now = None  # the range at hand

        def finish() -> None:
            page = held[at]
            if page[4]:
                around = [[x[1] for x in (held[k] for k in (at - d, at + d) if 0 <= k < len(held)) if x[0] == page[0]] for d in range(1, REACH + 1)]
                text, shared = main_text(page[1], around[0], [x for ring in around[1:] for x in ring])
                done.append((page[2], page[3], text, len(text), shared))

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(x, kind) for x, kind in zip(zip(*done, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_shared_lines"])

        for batch in batches:
            for page_id, link, html, host, place, part in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if part != now:
                    while at < len(held):
                        finish()
                        at += 1
                    held.clear()
                    at, now = 0, part
                held.append((host, lines_of(html), page_id, link, place == 0))
                if len(held) > at + REACH:
                    finish()
                    at += 1
                if at > REACH:
                    held.pop(0)
                    at -= 1
            if done:
                yield batch_of()
        while at < len(held):
            finish()
            at += 1
        if done:
            yield batch_of()

    return dealt.select("page_id", "url", "html", "host", "place", "range").mapInArrow(differenced, "page_id long, url string, text string, n_chars long, n_shared_lines long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
