import random
import time

import pytest

from checker import compare, connect
from tapespark.llm import queries, urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("odd.org", "/fr/x", "block"), ("odd.org", "/fr/x", "allow")]
URLS = [
    None, "", "no scheme", "http://", "http://x.net", "http://x.net/", "HTTP://A.Example.NET/en/1?q=/de/",
    "http://example.net/en", "https://b.example.com/de/1#top", "http://notexample.com/de/", "http://net./a",
    "ftp://x.org/fr/xy", "ftp://odd.org/fr/xyz", "http://u@x.net:80/a", "http://ÄX.net/ä", "x://..net/", "http://a.net?x/", "http://" + "a." * 500 + "net/" + "b/" * 5000,
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_verdicts_match_a_plain_search(spark):
    rows = [(k, url) for k, url in enumerate(URLS)] + [(4, URLS[4]), (None, URLS[5])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"row": urls.F.lit(1), "rule": urls.F.lit("x")})
    rules = spark.createDataFrame(RULES + [(None, "/", "block"), ("a", "/", "else")], "rule_host string, rule_path string, rule_verdict string")
    got = urls.judge(pages, rules).collect()
    assert len(got) == len(rows)
    for row in got:
        assert tuple(row)[1:] == brute(URLS[5 if row.page_id is None else row.page_id])


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    rules = urls.standing_rules(spark)
    assert urls.judge(pages, rules.limit(0), default="block").first().verdict == "block"
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_many_rules_of_many_shapes(spark, monkeypatch):
    draw = random.Random(3)
    names = [f"h{k}.org" for k in range(40)]
    rules = {(("a." * draw.randint(0, 8)) + draw.choice(names), "/" + "p" * k, draw.choice(["allow", "block"])) for k in range(700) for _ in range(3)}
    pages = [(k, f"http://{'a.' * draw.randint(0, 9)}{draw.choice(names)}/{'p' * draw.randint(0, 800)}x") for k in range(300)]
    begin = time.perf_counter()
    for most in (urls.BROADCAST_BYTES, 0):
        monkeypatch.setattr(urls, "BROADCAST_BYTES", most)
        table = spark.createDataFrame(sorted(rules), "rule_host string, rule_path string, rule_verdict string")
        got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), table).collect()
        for r in got:
            host, path = pages[r.page_id][1].removeprefix("http://").split("/", 1)
            fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules
                    if (host == h or host.endswith("." + h)) and f"/{path}".startswith(p)]
            best = max(fits, default=None)
            assert (r.rule, r.verdict) == ((best[2], best[3]) if best else (None, "allow"))
    assert time.perf_counter() - begin < 60


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    assert compare(queries.QUERIES["op7_urls"](spark, path), connect(path), queries.ORACLES["op7_urls"]) == []
