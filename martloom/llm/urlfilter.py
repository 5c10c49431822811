"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule can only match a URL that holds every literal token of the rule. Each rule is
filed under the one of its tokens that the fewest URLs hold; the tokens of a URL fetch
the rules filed under them, and only these run their regular expressions. The index is
a constant of the plan while the rules are few, so that judging is one pass without a
shuffle; a longer list is joined by token.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import let
from martloom.session import materialize

ALLOW, BLOCK = "allow", "block"
#: Characters of a token. A token is a longest run of them.
TOKEN = "A-Za-z0-9"
#: Rules, and characters of all rules, that a plan carries as a constant; more are joined.
RULES_IN_PLAN = 20_000
CHARS_IN_PLAN = 2_000_000
_CANDIDATE = "struct<token:string,host:int,length:int,block:int,text:string,regex:string>"


@dataclass(frozen=True)
class Rule:
    """A host rule (`host/path`: the host and all its subdomains, paths that start with `/path`)
    or a pattern (literal text and `*` for any run of characters, anywhere in the URL after its scheme)."""

    verdict: str
    text: str
    host: bool

    def __post_init__(self) -> None:
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"a verdict is {ALLOW} or {BLOCK}, not {self.verdict!r}")
        if self.host and not re.fullmatch(r"[^/?#A-Z]+/[^?#]*", self.text):
            raise ValueError(f"a host rule is a lower-case host, '/' and the start of a path, not {self.text!r}")
        if not self.text.strip("*"):
            raise ValueError("a pattern needs some literal text")

    @property
    def regex(self) -> str:
        if self.host:
            return rf"(?s)\A(?:[^/?#]*\.)?{_quoted(self.text)}"
        # the first place of a part leaves the most text to the next one, so no part is tried again
        return r"(?s)\A" + "".join(rf"(?>.*?{_quoted(part)})" for part in self.text.split("*") if part)

    def tokens(self) -> set[str]:
        """Tokens that every matching URL holds whole: those with another literal character on both sides."""
        if self.host:
            return set(re.findall(rf"(?<![{TOKEN}])[{TOKEN}]+(?=[^{TOKEN}])", self.text))
        whole = rf"(?<=[^{TOKEN}])[{TOKEN}]+(?=[^{TOKEN}])"
        return {t for part in self.text.split("*") for t in re.findall(whole, part)}


def _quoted(text: str) -> str:
    # a literal for Java's regular expressions
    return "".join(c if c.isalnum() else rf"\x{{{ord(c):x}}}" for c in text)


def host_rule(verdict: str, host: str, path: str = "/") -> Rule:
    return Rule(verdict, host + path, True)


def pattern(verdict: str, text: str) -> Rule:
    return Rule(verdict, text, False)


#: The host rules of the registered query.
HOST_RULES = (
    host_rule(ALLOW, "org", "/"),
    host_rule(BLOCK, "example.org", "/es/"),
    host_rule(BLOCK, "example.org", "/en/1"),
    host_rule(ALLOW, "com", "/fr/"),
    host_rule(BLOCK, "com", "/de/"),
)
#: Pages that repeat others or hold no prose. They decide where no host rule fits.
PATTERNS = tuple(
    pattern(BLOCK, text)
    for text in (
        "?page=*&ref=", "?replytocom=", "&replytocom=", "?sessionid=", "&sessionid=", "/wp-login.", "/wp-admin/", "/login/",
        "/cart/", "/search?*q=", "/calendar/*/day/", "/tag/*/page/", "?print=", "&print=", "/feed/*.xml",
    )
) + (pattern(ALLOW, "/feed/about.xml"),)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; '' without `://` and for null."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))


def _subject(url: Column) -> Column:
    # what the regular expressions see: lower-cased host, path, query and fragment
    return F.concat(host_of(url), F.regexp_replace(_rest(url), r"\A[^/?#]*", ""))


def _tokens(subject: Column) -> Column:
    return F.array_distinct(F.split(subject, f"[^{TOKEN}]+"))


def _rows(values: Sequence[dict], schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"array<{schema}>")


def _row(rule: Rule, token: str = "") -> dict:
    return {"token": token, "host": int(rule.host), "length": len(rule.text), "block": int(rule.verdict == BLOCK),
            "text": rule.text, "regex": rule.regex}


class _Shelves:
    """Entries by token, found in constant time: a constant array of short arrays, addressed by the token's hash."""

    def __init__(self, entries: Sequence[dict], schema: str) -> None:
        self.size = max(16, 2 * len(entries))
        shelves: list[list[dict]] = [[] for _ in range(self.size)]
        self.schema = schema
        for e in entries:
            shelves[self._place(e["token"])].append(e)
        self.constant = F.from_json(F.lit(json.dumps(shelves)), f"array<array<{schema}>>")

    def _place(self, token: str) -> int:
        return zlib.crc32(token.encode()) % self.size

    def of(self, token: Column) -> Column:
        place = (F.crc32(token.cast("binary")) % self.size + 1).cast("int")
        return F.filter(F.element_at(self.constant, place), lambda e: e["token"] == token)


def _frequencies(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """How many rows hold each of the rules' tokens; one row a token reaches the driver."""
    shelves = _Shelves([{"token": t} for t in tokens], "struct<token:string>")
    held = let(_tokens(_subject(F.col("url"))), lambda ts: F.filter(ts, lambda t: F.size(shelves.of(t)) > 0))
    counted = urls.select(F.explode(held).alias("token")).groupBy("token").count()
    return {r["token"]: r["count"] for r in counted.collect()}


def _filed(rules: Sequence[Rule], seen: dict[str, int]) -> tuple[list[dict], list[dict]]:
    """Rules under their rarest token (ties: first by code point), and those without a whole token."""
    filed, loose = [], []
    for rule in rules:
        tokens = rule.tokens()
        if tokens:
            filed.append(_row(rule, min(tokens, key=lambda t: (seen.get(t, 0), t))))
        else:
            loose.append(_row(rule))
    return filed, loose


def _fitting(candidates: Column, subject: Column) -> Column:
    fits = F.filter(candidates, lambda e: F.regexp_like(subject, e["regex"]))
    return F.transform(fits, lambda e: F.struct(*[e[k].alias(k) for k in ("host", "length", "block", "text")]))


def judge(pages: DataFrame, rules: Sequence[Rule] = HOST_RULES + PATTERNS, in_plan: int = RULES_IN_PLAN) -> DataFrame:
    """page_id, host, path, rule, verdict and pattern of every row of `pages`.

    The longest host rule that fits decides; where none fits, the longest pattern; where
    none matches either, the page is allowed. Of rules of the same length a blocking one
    wins, then the greater text. `rule` is the host rule or null, `pattern` the pattern
    that decided or null.

    A null URL and one without `://` have an empty host and path and are allowed, unless a
    rule matches the empty text (none can). Repeated rows and null ids are judged each for
    itself. An empty table gives no rows; without rules everything is allowed. Other
    columns of `pages` are not read.
    """
    rules = sorted(set(rules), key=lambda r: (r.text, r.host, r.verdict))
    rows = pages.select("page_id", "url")
    if len(rules) <= in_plan and sum(len(r.text) for r in rules) <= CHARS_IN_PLAN:
        judged = rows.withColumn("best", _judged_in_plan(rows, rules))
    else:
        judged = _judged_by_join(rows, rules)
    best = F.col("best")
    return judged.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.when(best["host"] == 1, best["text"]).alias("rule"),
        F.when(best["block"] == 1, BLOCK).otherwise(ALLOW).alias("verdict"),
        F.when(best["host"] == 0, best["text"]).alias("pattern"),
    )


def _judged_in_plan(rows: DataFrame, rules: Sequence[Rule]) -> Column:
    tokens = sorted(set().union(*[r.tokens() for r in rules]))
    filed, loose = _filed(rules, _frequencies(rows, tokens) if tokens else {})
    shelves, always = _Shelves(filed, _CANDIDATE), _rows(loose, _CANDIDATE)

    def best(subject: Column) -> Column:
        fetched = F.flatten(F.transform(_tokens(subject), shelves.of))
        return F.array_max(_fitting(F.concat(fetched, always), subject))

    return let(_subject(F.col("url")), best)


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules with each of their whole tokens (null: none), written in slices that a plan can carry."""
    schema = "struct<id:bigint,tokens:array<string>,host:int,length:int,block:int,text:string,regex:string>"
    parts = []
    for k in range(0, max(1, len(rules)), RULES_IN_PLAN):
        values = [_row(r) | {"id": k + i, "tokens": sorted(r.tokens())} for i, r in enumerate(rules[k : k + RULES_IN_PLAN])]
        one = spark.range(1).select(F.explode(_rows(values, schema)).alias("r")).select("r.*")
        parts.append(materialize(one, "rules"))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table.select("*", F.explode_outer("tokens").alias("token")).drop("tokens")


def _judged_by_join(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The same for any number of rules: distinct URLs meet the rules by token, AQE splits hot tokens and URLs."""
    spark = rows.sparkSession
    table = materialize(rule_table(spark, rules), "rule_tokens")
    urls = rows.where("url IS NOT NULL").select("url").distinct().withColumn("subject", _subject(F.col("url")))
    held = urls.select("url", "subject", F.explode(_tokens(F.col("subject"))).alias("token"))
    known = table.where("token IS NOT NULL").select("token").distinct()
    met = materialize(held.join(known, "token", "left_semi"), "url_tokens")
    seen = met.groupBy("token").agg(F.count("*").alias("seen"))
    rarest = (
        table.join(seen, "token", "left")
        .groupBy("id", "host", "length", "block", "text", "regex")
        .agg(F.min(F.when(F.col("token").isNotNull(), F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "token"))).alias("t"))
        .select("host", "length", "block", "text", "regex", F.col("t.token").alias("token"))
    )
    rarest = materialize(rarest, "rule_index")
    loose = [_row(r) for r in rules if not r.tokens()]
    fetched = met.join(rarest.where("token IS NOT NULL"), "token").where(F.regexp_like("subject", "regex"))
    fields = F.struct("host", "length", "block", "text")
    found = fetched.select("url", fields.alias("best"))
    for k in range(0, len(loose), RULES_IN_PLAN):
        always = _rows(loose[k : k + RULES_IN_PLAN], _CANDIDATE)
        found = found.unionByName(urls.select("url", F.explode(_fitting(always, F.col("subject"))).alias("best")))
    best = materialize(found.groupBy("url").agg(F.max("best").alias("best")), "verdicts")
    # a null key meets nothing: such rows are spread by their id instead of sharing one partition
    joined = rows.where("url IS NOT NULL").join(best, "url", "left").select("page_id", "url", "best")
    blank = rows.where("url IS NULL").withColumn("best", F.lit(None).cast(best.schema["best"].dataType))
    return joined.unionByName(blank)


def _contract_sql() -> str:
    def q(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def rows(rules: Sequence[Rule]) -> str:
        return ", ".join(f"({q(r.text.partition('/')[0])}, {q('/' + r.text.partition('/')[2])}, {q(r.verdict)})" for r in rules)

    def like(rule: Rule) -> str:
        escaped = rule.text.replace("!", "!!").replace("%", "!%").replace("_", "!_").replace("*", "%")
        return f"({q(rule.text)}, {q('%' + escaped + '%')}, {q(rule.verdict)})"

    return rf"""
WITH rules(h, p, v) AS (VALUES {rows(HOST_RULES)}),
patterns(text, form, v) AS (VALUES {", ".join(map(like, PATTERNS))}),
cut AS (SELECT row_number() OVER () AS rid, page_id,
               CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT rid, page_id, rest,
                 translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
hit AS (SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM parts, rules
        WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid),
other AS (SELECT rid, arg_max(text, length(text)) AS pattern, arg_max(v, length(text)) AS v FROM parts, patterns
          WHERE host || substring(rest, length(host) + 1) LIKE form ESCAPE '!' GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(hit.v, other.v, 'allow') AS verdict,
       CASE WHEN rule IS NULL THEN pattern END AS pattern
FROM parts LEFT JOIN hit USING (rid) LEFT JOIN other USING (rid)
"""


ORACLE = _contract_sql()
