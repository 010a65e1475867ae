"""Parts of URLs, rules, splits and odds."""

from __future__ import annotations

import itertools
import math

from brute import by_id

from feedloom.llm import urls

SCHEMA = "page_id bigint, url string, html string, host string, path int, token int"


def judge(spark, given, html="<p>cheap pills cheap pills win</p>"):
    rows = [(i, url, html, "x", 1, 2) for i, url in enumerate(given)]
    pages = spark.createDataFrame(rows, SCHEMA)
    return by_id(urls.judged(pages, pages), "page_id", "host", "path", "rule", "verdict", "host_words", "log_odds")


def test_parts_and_rules(spark):
    given = [
        "http://A.Example.COM/en/1?x=/y#z", "https://www.example.com/en/", "ftp://x.com", "http://com/", "http://com/?://u/",
        "http://notexample.com/en/", "https://q.net/es/1", "https://net/fr/", "https://q.net/fr", None, "", "no scheme/en/",
        "http://É.com/ÀB", "x://?q", "x:///p/q", "a://b://c/d",
    ]
    found = {k: v[:3] for k, v in judge(spark, given).items()}
    assert found == dict(
        enumerate(
            [
                ("a.example.com", "/en/1", "example.com/en/"), ("www.example.com", "/en/", "www.example.com/en/"), ("x.com", "", None),
                ("com", "/", "com/"), ("com", "/", "com/"), ("notexample.com", "/en/", "com/"), ("q.net", "/es/1", "net/es/"),
                ("net", "/fr/", "net/fr/"), ("q.net", "/fr", None), ("", "", None), ("", "", None), ("", "", None),
                ("É.com", "/ÀB", "com/"), ("", "", None), ("", "/p/q", None), ("b:", "//c/d", None),
            ]
        )
    )


def test_splits_are_the_best_ones():
    words = {"a": 3, "ab": 5, "b": 1, "ba": 4, "c": 2, "abc": 1}
    total = sum(words.values())
    price = lambda word: math.log(words[word] / total) if word in words else -math.log(total) - len(word) * math.log(10)
    for label in map("".join, itertools.product("abc", repeat=5)):
        known = [(i, j, price(label[i:j])) for i in range(5) for j in range(i + 1, 6) if label[i:j] in words]
        cuts = [[label[i:j] for i, j in itertools.pairwise([0, *c, 5])] for n in range(5) for c in itertools.combinations(range(1, 5), n)]
        best = max(sum(map(price, cut)) for cut in cuts)
        found = urls.best_split(label, sorted(known), -math.log(total))
        assert "".join(found) == label and math.isclose(sum(map(price, found)), best)


def test_long_words(spark):
    """Words of any length are in the dictionary, and runs longer than a host's label are split too."""
    long = "donaudampfschifffahrtsgesellschaft"
    html = f"<p>{(long + ' kapitän see ') * 50} {'x' * 500}</p>"
    given = [f"http://{long}.de/", f"http://see{long}kapitän.de/", f"http://{'see' * 40}.de/", f"http://see{'x' * 500}see.de/"]
    judged = judge(spark, given, html)
    found = [judged[i][4].split() for i in range(4)]
    assert found[0][0] == long and found[1][:3] == ["see", long, "kapitän"]
    assert found[2][:40] == ["see"] * 40 and found[3][:3] == ["see", "x" * 500, "see"]


def test_pages_of_open_tags_are_read_once(spark):
    """Patterns that search to the end from every place would take hours here."""
    pages = ["<b " * 350_000, "<!-- " * 200_000, "<script> " * 120_000, "&a" * 500_000, "</script  " * 100_000, "< " * 500_000]
    rows = [(i, "http://a.b/", page + "<i>word</i>", "x", 1, 2) for i, page in enumerate(pages)]
    counts = urls.word_counts(spark.createDataFrame(rows, SCHEMA).select("html"), "html")
    assert {r["word"]: r["n"] for r in counts.collect()}["word"] >= 3


def test_odds(spark):
    given = ["http://cheappills.net/es/1", "http://cheappills.net/es/1", "http://good.com/ok", "http://cheappills.org/x", "http://good.org/ok", "http://q.org/z"]
    found = judge(spark, given)
    assert found[0][4] == "cheap pills net" and [found[i][3] for i in range(6)] == ["block", "block", "allow", "block", "allow", "block"]
    # judged: block twice (cheap pills net es 1), allow once (good com ok); 8 tokens
    one = math.log((0 + 1) / (2 + 1)) - math.log((3 + 8) / (10 + 8))
    assert math.isclose(found[3][5], math.log(2 / 3) + 2 * one, abs_tol=1e-6)
    assert found[5][5] == round(math.log(2 / 3), 9)


def test_rows(spark):
    long = "http://" + "a" * 70 + "." + "b" * 100_000 + "/" + "p/" * 1000
    rows = [(None, "http://a.org/", None, "", 0, 0), (1, "http://a.org/", "", "", 0, 0), (1, "http://a.org/", "<b>a", "", 0, 0), (2, long, "a", "", 0, 0)]
    pages = spark.createDataFrame(rows, SCHEMA)
    found = urls.judged(pages, pages)
    assert found.count() == 4 and found.where("verdict IS NULL").isEmpty()
    assert found.where("page_id = 2").first()["host_words"] == "a " * 70 + "b" * 100_000  # a is a word, and no other
    assert urls.judged(pages.limit(0), pages).count() == 0 and urls.judged(pages, pages.limit(0)).count() == 4
