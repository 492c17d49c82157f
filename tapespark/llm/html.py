"""Main text of web pages: markup, and differences between pages of near URLs.

Each page is parsed once into block lines, every one marked by the region it stands in: ``main``
(an article or main element, or a class that names the content), ``chrome`` (menus, headers,
footers, sidebars, notices, adverts, forms, comments and the like) or ``open``.  Lines of a
main region are kept even if shared, as articles do repeat each other's paragraphs (README has
figures); chrome goes; open lines are judged by differencing:

1. Pages of a host with the same open lines are one content, so copies of a page are no
   witnesses against it.  Contents are ordered by host and path.
2. Of the NEAR contents before and behind, the one whose path shares the longest prefix is the
   partner.  A content that shares VERSION or more of the text of the shorter of both is a
   version of the page (a print view, say) and is passed over.
3. The lines of both are aligned by their longest common subsequence, and shared lines are
   deleted as boilerplate; so are lines that WITNESSES or more of those contents hold, versions
   or not.  What no partner shares is kept.
4. Beside a main region, open lines that the page itself repeats are taken for lists' debris.

Null html has no text.  Null urls and urls without host are one host, "".  Pages without a
partner on their host lose no line.  Repeated rows are extracted alike, contents with the same
path are ordered by their digest.  Very long html takes time in proportion to its length, and
differencing in proportion to the product of the lines of two pages.  Empty tables give
empty results; columns other than page_id, url and html are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapespark.llm.components import join_unique
from tapespark.llm.urls import with_parts
from tapespark.session import scratch_path

#: Elements by their part in a page.
SKIPPED = frozenset("script style noscript template svg math head iframe object canvas audio video select option textarea button datalist".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
CHROME = frozenset("nav header footer aside form menu dialog search fieldset".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Words in class, id or role that tell a region as a whole or beside others.
CHROME_NAME = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor(?:ed|s)?|promo(?:tion|tions|s)?|nav(?:bar|igation)?|menus?|"
    r"breadcrumbs?|side-?bar|footer|masthead|cookies?|consent|popup|modal|newsletter|signup|"
    r"comments?|disqus|pagination|pager|toolbar|widgets?|contentinfo|skip-?(?:link|nav|to)\w*)(?:$|[\s_-])"
)
#: Names that tell chrome only where they are the whole name, or with these partners.
WHOLE_NAME = re.compile(
    r"(?i)(?:^|\s)(?:aside|header|notices?|subscri(?:be|ption)|login|reply|replies|respond|share|sharing|social|related|"
    r"recommended|search|form|copyright|complementary|hidden|"
    r"(?:site|page|main|top|global)[_-]header|(?:site|legal|cookie)[_-]notices?|"
    r"(?:share|sharing|social)[_-](?:buttons?|bar|links?|icons?|this|media)|(?:related|recommended)[_-](?:posts?|articles?|links?|stories|content)|"
    r"(?:search|login|contact|comment|signup|subscribe)[_-](?:form|box|bar))(?:$|\s)"
)
MAIN_NAME = re.compile(
    r"(?i)(?:^|[\s_-])(?:article(?:-?(?:body|content|text))?|post-?(?:body|content|text)|entry-?content|"
    r"main-?(?:content|text)|story-?(?:body|text)|content-?body|body-?text)(?:$|[\s_-])"
)
#: A tag ends at its bracket, or unclosed where the next one begins.
TAG = re.compile(
    r"<(?:!--.*?(?:-->|$)|(/?)([A-Za-z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|(?=[<\"'])|$)|[!?][^>]*>?)", re.S
)
#: Names and values, taken whole, so that no value is searched for names.
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?|[\"'=/]")
TOLD = frozenset(("class", "id", "role", "hidden", "style"))
#: A paragraph or item is closed by the next one's start.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def _region(tag: str, attributes: str, above: str) -> str:
    """The region inside an element: main, chrome, open or skipped."""
    if above == "skipped" or tag in SKIPPED:
        return "skipped"
    told = {}
    for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
        if name.lower() in TOLD:
            told.setdefault(name.lower(), a or b or c or "")
    if "hidden" in told or re.search(r"display\s*:\s*none", told.get("style", "")):
        return "skipped"
    names = " ".join(told.get(n, "") for n in ("class", "id", "role"))
    if above == "chrome":
        return "chrome"
    # A page's own header inside its article holds the headline, not the site's menu.
    if tag in CHROME and not (tag == "header" and above == "main"):
        return "chrome"
    if tag not in ("html", "body") and not MAIN_NAME.search(names):
        if CHROME_NAME.search(names) or any(WHOLE_NAME.search(told.get(n, "")) for n in ("class", "id", "role")):
            return "chrome"
    if tag in MAIN or MAIN_NAME.search(names) or told.get("role") == "main":
        return "main"
    return above


def parse(html: str | None) -> list[tuple[str, str]]:
    """(region, line) of every non-empty block, in page order; what is skipped is left out."""
    lines: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []

    def region() -> str:
        return stack[-1][1] if stack else "open"

    def flush() -> None:
        line = " ".join(unescape("".join(parts)).split())
        if line and region() != "skipped":
            lines.append((region(), line))
        parts.clear()

    html = html or ""
    at = 0
    while at < len(html):
        begin = html.find("<", at)
        begin = len(html) if begin < 0 else begin
        parts.append(html[at:begin])
        found = TAG.match(html, begin) if begin < len(html) else None
        if begin == len(html):
            break
        if not found:
            parts.append("<")
            at = begin + 1
            continue
        at = found.end()
        if not found[2]:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS or tag in SKIPPED:
            flush()
        if closing:
            while opened[tag]:
                gone = stack.pop()[0]
                opened[gone] -= 1
                if gone == tag:
                    break
            continue
        if tag in VOID:
            continue
        for name in CLOSES.get(tag, ()):
            last = [n for n, _ in stack[-3:]]
            if name in last:
                # Only what was opened since, so an outer list's item stays open.
                since = last[len(last) - last[::-1].index(name):]
                if not any(n in BLOCKS and n not in CLOSES for n in since):
                    for _ in range(len(since) + 1):
                        opened[stack.pop()[0]] -= 1
        inside = _region(tag, found[3] or "", region())
        if tag in RAW:
            # Raw text runs to its own end tag; what looks like markup in it is not.
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        stack.append((tag, inside))
        opened[tag] += 1
    flush()
    return lines


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Rows of the length table are kept as bits of integers (a 0 where the length grows), so
    the time is the product of the lengths over the machine's word; large tables are halved
    as Hirschberg did, so the memory is bounded.
    """
    shared: set[int] = set()
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        shared.add(head)
        head += 1
    tail = 0
    while tail < len(a) - head and tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        shared.add(len(a) - 1 - tail)
        tail += 1
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    shared |= {head + k for k in _common(a, b)}
    return shared


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    places: dict[str, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row = full
    yield row
    for line in a:
        met = row & places.get(line, 0)
        row = ((row + met) | (row - met)) & full
        yield row


def _lengths(row: int, width: int) -> list[int]:
    found, total = [0], 0
    for j in range(width):
        total += not (row >> j) & 1
        found.append(total)
    return found


def _common(a: list[str], b: list[str]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > 1 << 28 and len(a) > 1:
        half = len(a) // 2
        *_, left = _rows(a[:half], b)
        *_, right = _rows(a[half:][::-1], b[::-1])
        ahead, behind = _lengths(left, len(b)), _lengths(right, len(b))
        cut = max(range(len(b) + 1), key=lambda j: ahead[j] + behind[len(b) - j])
        return _common(a[:half], b[:cut]) + [half + k for k in _common(a[half:], b[cut:])]
    rows = list(_rows(a, b))
    found, j = [], len(b)
    for i in range(len(a), 0, -1):
        # The last place up to j where row i has grown and the row above has not.
        below = rows[i] | ~((1 << j) - 1)
        above = rows[i - 1] | ~((1 << j) - 1)
        grown = ~below & above & ((1 << j) - 1)
        if grown and (~below).bit_count() > (~above).bit_count():
            place = next(k for k in range(j - 1, -1, -1) if b[k] == a[i - 1]) if a[i - 1] in b[:j] else None
            if place is not None:
                found.append(i - 1)
                j = place
    return found[::-1]


#: Contents before and behind a page that may be its partner.
NEAR = 3
#: Share of the shorter text from which on two contents are versions of one page.
VERSION = 0.9
#: Contents that make a line boilerplate whatever else they share.
WITNESSES = 3

#: Lines in page order, each with its number among the page's open lines, -1 in a main region.
PARSED = "page_id long, url string, lines array<struct<line:string,open:int>>, opened int"
_LINES = pa.list_(pa.struct([("line", pa.string()), ("open", pa.int32())]))


def judged_lines(html: str | None) -> list[tuple[str, int]]:
    """(line, number among the open lines or -1) of what may be a page's text."""
    lines = [(region, line) for region, line in parse(html) if region in ("main", "open")]
    if any(region == "main" for region, _ in lines):
        often = Counter(line for region, line in lines if region == "open")
        lines = [(region, line) for region, line in lines if region == "main" or often[line] == 1]
    found, opened = [], 0
    for region, line in lines:
        found.append((line, opened if region == "open" else -1))
        opened += region == "open"
    return found


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [judged_lines(html.as_py()) for html in batch.column("html")]
        opened = [sum(number >= 0 for _, number in lines) for lines in pages]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"),
             pa.array([[{"line": line, "open": n} for line, n in lines] for lines in pages], _LINES),
             pa.array(opened, pa.int32())],
            names=["page_id", "url", "lines", "opened"],
        )


def deleted(opened: list[str], near: list[list[str]]) -> list[int]:
    """Places of the open lines that near contents, the likeliest partner first, tell as boilerplate."""
    size = sum(map(len, opened))
    gone: set[int] = set()
    for other in near:
        shared = common_lines(opened, other)
        together = sum(len(opened[k]) for k in shared)
        if together < VERSION * min(size, sum(map(len, other))):
            gone = shared
            break
    held = Counter(line for other in near for line in set(other))
    return sorted(gone | {k for k, line in enumerate(opened) if held[line] >= WITNESSES})


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = [deleted(a, b) for a, b in zip(batch.column("opened").to_pylist(), batch.column("near").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("content"), pa.array(gone, pa.list_(pa.int32()))], names=["content", "gone"]
        )


def _shared_prefix(a, b):
    """Length of the common start of two paths, by halving."""
    low = F.least(F.length(a), F.length(b))
    bits = F.sequence(F.lit(24), F.lit(0), F.lit(-1))

    def grow(best, k):
        more = best + F.pow(F.lit(2.0), k).cast("int")
        return F.when((more <= low) & (F.substring(a, F.lit(1), more) == F.substring(b, F.lit(1), more)), more).otherwise(best)

    return F.aggregate(bits, F.lit(0), grow)


def _lent(sizes: list[tuple[int, int]]) -> list[tuple[int, bool, int, int]]:
    """(part, at its end, how many, to part): the contents that stand beside other parts' ends.

    ``sizes``: (part, contents) in order.  A part smaller than NEAR is reached across.
    """
    lent = []
    for at, (to, _) in enumerate(sizes):
        for at_end, others in ((True, sizes[:at][::-1]), (False, sizes[at + 1:])):
            wanted = NEAR
            for part, size in others:
                if wanted <= 0:
                    break
                lent.append((part, at_end, min(wanted, size), to))
                wanted -= size
    return lent


def _neighbours(contents: DataFrame) -> DataFrame:
    """(content, opened, near): the open lines of each content's neighbours, the nearest by path first."""
    spark = contents.sparkSession
    root = scratch_path(spark, "html-placed")
    # Ranges of host and path are sorted runs of even size, however large one host is.
    keys = ("host", "path", "content")
    contents.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "part", F.spark_partition_id()
    ).withColumn("place", F.monotonically_increasing_id()).write.parquet(f"{root}/placed")
    schema = "content string, host string, path string, opened array<string>, part int, place long"
    placed = spark.read.schema(schema).parquet(f"{root}/placed")
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect())
    lends = spark.createDataFrame(_lent(sizes), "part int, at_end boolean, many int, to int")
    run = Window.partitionBy("part").orderBy("place")
    back = Window.partitionBy("part").orderBy(F.col("place").desc())
    ends = placed.select("*", F.row_number().over(run).alias("first"), F.row_number().over(back).alias("last")).where(
        (F.col("first") <= NEAR) | (F.col("last") <= NEAR)
    )
    copies = ends.join(F.broadcast(lends), "part").where(
        F.when(F.col("at_end"), F.col("last") <= F.col("many")).otherwise(F.col("first") <= F.col("many"))
    ).select("content", "host", "path", "opened", F.col("to").alias("part"), "place", F.lit(True).alias("lent"))
    beside = F.struct("host", "path", "opened")
    steps = [(k, F.lag(beside, k).over(run)) for k in range(1, NEAR + 1)]
    steps += [(k, F.lead(beside, k).over(run)) for k in range(1, NEAR + 1)]
    # Nearer paths first, then nearer places; before goes before behind.
    order = [
        F.when(F.col(f"n{at}.host") == F.col("host"), F.struct(
            -_shared_prefix(F.col("path"), F.col(f"n{at}.path")), F.lit(k), F.lit(at), F.col(f"n{at}.opened").alias("opened")
        ))
        for at, (k, _) in enumerate(steps)
    ]
    return (
        placed.select("content", "host", "path", "opened", "part", "place", F.lit(False).alias("lent")).union(copies)
        .select("content", "host", "path", "opened", "lent", *(step.alias(f"n{at}") for at, (_, step) in enumerate(steps)))
        .where("not lent")
        .select("content", "opened", F.transform(F.array_sort(F.array_compact(F.array(*order))), lambda n: n["opened"]).alias("near"))
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    spark = pages.sparkSession
    root = scratch_path(spark, "html")
    pages.select("page_id", "url", "html").mapInArrow(_parsed, PARSED).write.parquet(f"{root}/parsed")
    parsed = spark.read.schema(PARSED).parquet(f"{root}/parsed")

    def told(rows: DataFrame, lines) -> DataFrame:
        return rows.select("page_id", "url", F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("text"))

    # Pages whose markup tells all there is go straight to the result, without a shuffle.
    whole = told(parsed.where("opened = 0"), F.col("lines"))
    if parsed.where("opened > 0").take(1):
        opened = F.transform(F.filter("lines", lambda x: x["open"] >= 0), lambda x: x["line"])
        judged = with_parts(parsed.where("opened > 0")).withColumn("own", opened)
        # Neither hosts nor lines hold a line feed.
        judged = judged.withColumn("content", F.sha2(F.concat_ws("\n", "host", F.array_join("own", "\n")), 256))
        contents = judged.groupBy("content").agg(
            F.first("host").alias("host"), F.min("path").alias("path"), F.first("own").alias("opened")
        )
        _neighbours(contents).mapInArrow(_differenced, "content string, gone array<int>").write.parquet(f"{root}/gone")
        gone = spark.read.schema("content string, gone array<int>").parquet(f"{root}/gone")
        judged.select("page_id", "url", "content", "lines").write.parquet(f"{root}/judged")
        judged = spark.read.schema(
            "page_id long, url string, content string, lines array<struct<line:string,open:int>>"
        ).parquet(f"{root}/judged")
        # Copies of a page may be many: their content's answer is sent to them.
        kept = F.filter("lines", lambda x: ~F.array_contains("gone", x["open"]))
        whole = whole.union(told(join_unique(judged, gone, "content"), kept))
    return whole.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
