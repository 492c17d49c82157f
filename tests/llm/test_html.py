import hashlib
import html as escapes
import os
import random
import re
import time
from collections import Counter

import pytest

from tapespark.llm import html, queries


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b, 1):
            row.append(last[j - 1] + 1 if x == y else max(last[j], row[-1]))
    return row[-1]


def test_common_lines_are_a_longest_common_subsequence():
    draw = random.Random(1)
    for _ in range(2000):
        a, b = ([draw.choice("abcd") for _ in range(draw.randint(0, 12))] for _ in range(2))
        places = sorted(html.common_lines(a, b))
        rest = iter(b)
        assert all(a[k] in rest for k in places)
        assert len(places) == longest(a, b)


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu<li>Two</ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<div class=ad>Buy</div><aside>Side</aside><form><label>Name<input></label></form><!-- <p>no</p> -->
<article><header><h1>Head&shy;line &amp; more</h1></header><p>First <b>bold<br>line
 two<p>Second &lt;p&gt; 1 < 2</p><ul><li>item one<li>item two</ul><table><tr><td>c1<td>c2</table>
<div class="share-buttons">Share</div><noscript>no</noscript><section class="comments"><p>Reader says</p></section></article>
<section id="comments"><p>More comments</p></section><footer>&copy; no"""


def test_main_text_of_a_page():
    lines = [line for region, line in html.parse(PAGE) if region == "main"]
    assert lines == ["Head\xadline & more", "First bold line two", "Second <p> 1 < 2", "item one", "item two", "c1", "c2"]


def test_pages_without_main_region_lose_what_they_share_with_their_neighbour(spark):
    frame = "<html><body><div class=menu>Home</div><div>Site name</div><p>{}</p><p>Subscribe now</p></body>"
    rows = [
        (0, "http://a.b/x/1", frame.format("Real one é &amp; two")), (1, "http://a.b/x/2", frame.format("Other text")),
        (2, None, None), (3, "http://a.b/x/2", ""), (4, "http://z/", "<div>Site name</div><p>alone"), (5, "http://a.b/y/9", "<p>Unlike</p>"),
        (4, "http://z/", "<div>Site name</div><p>alone"), (None, "http://q/", "<article>a<br>b</article>" + "<p>x" * 20_000),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int").repartition(3)
    got = sorted((r.page_id if r.page_id is not None else -1, r.text, r.n_chars) for r in html.extract(pages).collect())
    texts = {0: "Real one é & two", 1: "Other text", 2: "", 3: "", 5: "Unlike", -1: "a b"}
    assert {k: t for k, t, _ in got if k != 4} == texts
    assert [t for k, t, _ in got if k == 4] == ["Site name\nalone"] * 2  # a copy is no witness against a page
    assert all(n == len(t) for _, t, n in got)
    assert html.extract(pages.limit(0)).count() == 0


def text_of(page):
    return "\n".join(line for line, _ in html.judged_lines(page))


def test_attributes_are_taken_whole():
    for attribute in (
        'title="a hidden truth"', 'aria-hidden="false"', 'data-hidden="0"', 'data-id="menu"', 'class="share-price"',
        'class="long-form"', "title='class=menu'", 'alt="x" data-class="nav"', 'class="reform"', 'id="information"',
    ):
        assert text_of(f"<article><p {attribute}>kept</p></article>") == "kept", attribute
    for attribute in (
        "hidden", 'hidden=""', 'style="display: none"', 'class="menu"', 'id=nav', 'role="navigation"', 'class="x cookie-notice"',
        'class="share-buttons"', 'class="search-form"', 'class="form"', "class='site_footer'", 'data-x="1" class="comments"',
    ):
        assert text_of(f"<article><p {attribute}>gone</p><p>kept</p></article>") == "kept", attribute


def test_open_lines_beside_a_main_region_are_judged():
    assert text_of("<article>teaser</article><p>whole body") == "teaser\nwhole body"
    assert text_of("<p>before</p><article>text</article><nav>menu</nav>") == "before\ntext"


def test_long_and_broken_markup_takes_time_in_proportion():
    begin = time.perf_counter()
    for piece in ("<a x", "<a 'x", "<b>", "<p>x<i>", "</i>", "<!--", "<li><ul>", "<title>", "< ", '<a "'):
        html.parse(piece * 100_000)
        html.parse("<b>" * 100_000 + piece * 100_000)
    assert time.perf_counter() - begin < 60
    assert text_of("<p>a <b class=x <i>c") == "a c"


def plain_deleted(opened, near):
    """Lines shared with the first neighbour that is no version, and those of three neighbours."""
    gone = set()
    for other in near:
        n = [[0] * (len(other) + 1) for _ in range(len(opened) + 1)]
        for i in range(len(opened)):
            for j in range(len(other)):
                n[i + 1][j + 1] = n[i][j] + 1 if opened[i] == other[j] else max(n[i][j + 1], n[i + 1][j])
        shared = Counter(opened) & Counter(other)
        if sum(len(k) * c for k, c in shared.items()) < html.VERSION * min(sum(map(len, opened)), sum(map(len, other))):
            gone = {k for k, line in enumerate(opened) if line in shared}
            break
    return gone | {k for k, line in enumerate(opened) if sum(line in other for other in near) >= html.WITNESSES}


def site(draw, host, n):
    frame = [f"{host} name", "Home of all news", "Subscribe to our letter"]
    rows = []
    for k in range(n):
        article = [" ".join(f"w{draw.randrange(5000)}" for _ in range(draw.randint(8, 60))) for _ in range(draw.randint(1, 5))]
        lines = [*frame[:2], *article, *frame[2:]]
        markup = "".join(f"<div>{line}</div>" for line in lines)
        rows.append((f"http://{host}/{'ab'[k % 2]}/{k}", f"<body><nav>Menu</nav>{markup}<footer>f</footer>", "\n".join(article)))
        if draw.random() < 0.3:
            # A copy at another path, or a print version with less around the article.
            rows.append((f"http://{host}/copy/{k}", rows[-1][1], rows[-1][2]))
            rows.append((f"http://{host}/{'ab'[k % 2]}/{k}/print", "".join(f"<p>{line}" for line in [*article, "Print"]), "\n".join(article)))
    return rows


@pytest.mark.parametrize("parts", ["2", "40"])
def test_pages_without_article_keep_their_text(spark, parts):
    draw = random.Random(12)
    rows = [(k, *r) for k, r in enumerate(row for h in range(6) for row in site(draw, f"h{h}.org", 9))]
    pages = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.page_id: r.text for r in html.extract(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    right = wrong = true = 0
    for page_id, _, _, article in rows:
        want, have = Counter(article.split("\n")), Counter(got[page_id].split("\n"))
        right, true, wrong = right + (want & have).total(), true + want.total(), wrong + (have - want).total()
    assert right >= 0.9 * true and wrong <= 0.1 * true
    # Brute force: neighbours by host, path and content, from all pages at once.
    contents = {}
    for page_id, url, page, _ in rows:
        host, path = url.removeprefix("http://").split("/", 1)
        opened = [line for line, _ in html.judged_lines(page)]
        key = hashlib.sha256("\n".join([host, *opened]).encode()).hexdigest()
        entry = contents.setdefault(key, [host, "/" + path, opened, []])
        entry[1] = min(entry[1], "/" + path)
        entry[3].append(page_id)
    order = sorted((host, path, key) for key, (host, path, _, _) in contents.items())
    for at, (host, path, key) in enumerate(order):
        near = []
        for k in range(1, 4):
            for side, other in ((0, at - k), (1, at + k)):
                if 0 <= other < len(order) and order[other][0] == host:
                    near.append((-len(os.path.commonprefix([path, order[other][1]])), k, 3 * side + k - 1, contents[order[other][2]][2]))
        opened = contents[key][2]
        gone = plain_deleted(opened, [n[3] for n in sorted(near, key=lambda n: n[:3])])
        for page_id in contents[key][3]:
            assert got[page_id] == "\n".join(line for k, line in enumerate(opened) if k not in gone)


def test_query_finds_every_article(spark):
    path = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    rows = queries.QUERIES["op5_html"](spark, path).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = (" ".join(escapes.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b)
