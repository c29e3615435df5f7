"""URL verdicts against a plain version: no row is lost, whatever rows have in common."""

import random
import re

from corpusloom.llm.url_filter import RULES, judge_urls, op1_url_filters


def plain(rows, rules):
    out = []
    for page, url in rows:
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1], found[2]) if found else ("", "")
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
        out.append((page, host, path, best and best[0] + best[1], best[2] if best else "allow"))
    return sorted(out, key=str)


def judged(spark, rows):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, copies string")
    return sorted(map(tuple, judge_urls(df, rules).collect()), key=str)


def test_rows_that_differ_after_the_path(spark):
    rows = [(1, "http://a.com/x?1"), (1, "http://a.com/x?2"), (1, "http://a.com/x#f"), (2, None), (2, "foo"), (2, None), (2, ""), (None, "http://b.net/es/?"), (None, "http://b.net/es/")]
    assert judged(spark, rows) == plain(rows, RULES)


def test_many_rows(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(1500):
        host = rng.choice(["", "www.", "Sub.", "a.b."]) + rng.choice(["example.com", "EXAMPLE.com", "x.net", "net", "other.org", "fooexample.com"])
        path = rng.choice(["", "/", "/en/", "/en/a", "/en", "/es/", "/fr/x/y", "/EN/", "//en/"])
        url = rng.choice(["http://", "https://", "", "//", "a://b://"]) + host + path + rng.choice(["", "?q=/en/", "#/es/", "?"])
        rows.append((rng.choice([None, *range(40)]), url))
    rows += [(7, "http://hot.example.com/en/")] * 500 + [(8, "http://a.net/es/" + "p/" * 50_000)]
    assert judged(spark, rows) == plain(rows, RULES)


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in judge_urls(pages, rules.limit(0)).collect()] == [(1, "a.com", "/", None, "allow")]


def test_query(spark, sf):
    rows = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, op1_url_filters(spark, sf).collect()), key=str) == plain(rows, RULES)
