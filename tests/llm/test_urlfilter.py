"""URL rules against a plain Python version that tries every rule on every URL."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from martloom.llm import urlfilter
from martloom.llm.common import table
from martloom.llm.urlfilter import ALLOW, BLOCK, Rule, host_rule, pattern


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    low = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    found = []
    for r in rules:
        if r.host:
            h, _, p = r.text.partition("/")
            fits = (low == h or low.endswith("." + h)) and path.startswith("/" + p)
        else:
            form = ".*".join(re.escape(x) for x in r.text.split("*"))
            fits = re.search(form, low + rest[len(host):], re.S) is not None
        if fits:
            found.append((r.host, len(r.text), r.verdict == BLOCK, r.text))
    best = max(found, default=(None, 0, False, None))
    return (low, path, best[3] if best[0] else None, BLOCK if best[2] else ALLOW, best[3] if best[0] is False else None)


URLS = [
    None, "", "://", "no scheme/at all", "http://", "http://org", "http://org/", "HTTP://ORG/x", "http://a.org?x=/es/", "http://example.org/es",
    "http://example.org/es/", "http://www.EXAMPLE.org/es/1", "http://badexample.org/es/", "http://example.org/en/1", "http://example.org/en/17?a",
    "http://example.org/en/2#1", "http://.org/a", "http://x.com/fr/?page=1&ref=2", "http://x.com/FR/?page=1&ref=2", "http://com/de/",
    "http://com:80/de/", "a://b://com/de/", "http://x.net/feed/a/b.xml", "http://x.net/feed/about.xml", "http://x.net/?print=", "http://é.org/ü",
    "http://x.net/\n/cart/\n", "http://x.net/login", "http://x.net/login/" + "z" * 50_000, "http://x.net/?page=&page=&ref=", "http://u@com/fr/é",
    "http://x.com/de/\U0001f600", "http://x.net/search?" + "a" * 20_000, "http://x.net/calendar/2/day/", "http://x.net/%2Fcart%2F",
]


def rows_of(df):
    return sorted(map(repr, ((r.page_id, r.host, r.path, r.rule, r.verdict, r.pattern) for r in df.collect())))


def frame(spark, urls):
    wide = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return wide.selectExpr("*", "url AS host", "url AS path", "page_id AS rule", "page_id AS best", "url AS token", "url AS subject")


def want(urls, rules):
    return sorted(repr((k, *plain(u, rules))) for k, u in enumerate(urls))


@pytest.mark.parametrize("in_plan", [urlfilter.RULES_IN_PLAN, 0])
def test_every_url_gets_the_longest_rule(spark, in_plan):
    rules = urlfilter.HOST_RULES + urlfilter.PATTERNS
    assert rows_of(urlfilter.judge(frame(spark, URLS), rules, in_plan)) == want(URLS, rules)


@pytest.mark.parametrize("in_plan", [urlfilter.RULES_IN_PLAN, 0])
def test_random_rules_with_and_without_whole_tokens(spark, in_plan):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("ab1.-/?&=") for _ in range(draw.randint(1, 5)))
    rules = {pattern(draw.choice((ALLOW, BLOCK)), "*".join(word() for _ in range(draw.randint(1, 3)))) for _ in range(200)}
    rules |= {host_rule(draw.choice((ALLOW, BLOCK)), h, "/" + word().strip("?")) for h in ("a", "b.a", "1.b.a", "a-1")}
    rules |= {host_rule(v, "b.a", "/same") for v in (ALLOW, BLOCK)}
    urls = [f"x://{draw.choice(('a', 'b.a', 'A', '1.b.a', 'c.1.b.a', 'a-1', 'x'))}/{word()}{word()}" for _ in range(200)]
    urls += ["x://b.a/same"] * 3
    assert rows_of(urlfilter.judge(frame(spark, urls), list(rules), in_plan)) == want(urls, rules)


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = [host_rule(BLOCK, "rare.com", "/a/"), pattern(BLOCK, "/a/b/*com."), pattern(BLOCK, "ab")]
    urls = spark.createDataFrame([("http://x.com/a/",)] * 3 + [("http://x.com/b/",)], "url string")
    seen = urlfilter._frequencies(urls, ["rare", "com", "a", "b"])
    assert seen == {"com": 4, "a": 3, "b": 1}
    filed, loose = urlfilter._filed(rules, seen)
    assert [(r["text"], r["token"]) for r in filed] == [("rare.com/a/", "rare"), ("/a/b/*com.", "b")]
    assert [r["text"] for r in loose] == ["ab"]


def test_no_rows_no_rules_and_wrong_rules(spark):
    none = frame(spark, URLS).limit(0)
    assert urlfilter.judge(none).count() == 0 and urlfilter.judge(none, in_plan=0).count() == 0
    assert {r.verdict for r in urlfilter.judge(frame(spark, URLS), []).collect()} == {ALLOW}
    for verdict, text, host in (("deny", "org/", True), (BLOCK, "Org/", True), (BLOCK, "org", True), (BLOCK, "**", False)):
        with pytest.raises(ValueError):
            Rule(verdict, text, host)


def test_a_pattern_of_many_parts_stays_linear(spark):
    urls = ["http://x/" + "a" * 100_000]
    rules = [pattern(BLOCK, "*".join("a" * 8) + "*b")]
    assert rows_of(urlfilter.judge(frame(spark, urls), rules)) == want(urls, [])


def test_judging_takes_no_shuffle(spark, small):
    df = urlfilter.judge(table(spark, small, "pages"))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_sql_on_awkward_urls(spark, tmp_path):
    # the SQL knows no ties between rules, and the fixed rules hold none
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("html", F.lit("")).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{path}/*.parquet'")
    got = con.execute(f"SELECT page_id, host, path, rule, verdict, pattern FROM ({urlfilter.ORACLE})").fetchall()
    assert sorted(map(repr, got)) == want(URLS, urlfilter.HOST_RULES + urlfilter.PATTERNS)
