"""URL filtering by pattern rules that are indexed by their rarest literal token, in DataFrame functions only.

A rule becomes a regular expression and a list of *literal tokens*, runs of a-z and 0-9 that stand whole in every URL it
fits.  Over the given pages each token's URLs are counted, and a rule is indexed under its rarest token.  A URL is cut to
tokens as well, these fetch candidate rules from the index, and only candidates run their expressions.  A rule without any
such token would be a candidate for all URLs, under the empty token.

Two kinds of rule: *host rules* (host and path prefix, fitting the host and all its subdomains; the longest that fits
decides, and is named), and *patterns*, which decide where no host rule fits: "*" stands for anything, "^" for one
character that is no letter or digit (or the end), all else for itself in either case.  Where nothing fits: allow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import ascii_lower

#: Most rules that are broadcast as one table; more go by a shuffled join.
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str | None  # of a host rule, like "example.org/es/"
    regex: str  # of a host rule on host + path, of a pattern on the lower-cased URL
    tokens: tuple[str, ...]


def host_rule(verdict: str, text: str) -> Rule:
    """A rule written as host/path; the path may go on after its end."""
    host, _, path = text.partition("/")
    ended = [*re.findall("[a-z0-9]+", host), *(t.lower() for t in re.findall("[a-zA-Z0-9]+(?=[^a-zA-Z0-9])", path))]
    return Rule(verdict, text, "\\A(?:[^/]*\\.)?" + re.escape(host) + re.escape("/" + path), tuple(ended))


def pattern(text: str, verdict: str = "block") -> Rule:
    whole = [m[0] for m in re.finditer("[a-z0-9]+", text) if text[: m.start()][-1:] not in ("", "*") and text[m.end() :][:1] not in ("", "*")]
    regex = "".join({"*": ".*", "^": "(?:[^a-z0-9]|\\z)"}.get(c, re.escape(c)) for c in text)
    return Rule(verdict, None, "(?s)" + regex, tuple(whole))


#: The rules of the task, and patterns of hosts and paths that training corpora are commonly kept clear of.
HOST_RULES = tuple(host_rule(*r.split(" ")) for r in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"))
PATTERNS = tuple(pattern(p) for p in (
    "^casino^", "^casinos^", "^poker^", "^slots^", "^betting^", "^free-bets^", "^sports-bets^", "^lottery^", "^jackpot^",
    "^cheap-pills^", "^pills^", "^pharmacy^", "^viagra^", "^payday-loans^", "^adult^", "^adult-*^", "^porn^", "^xxx^", "^sex^", "^escort^",
    "^warez^", "^torrent^", "^cracked^", "^keygen^", "^phishing^", "^malware^", "^replica-watches^", "^spam^",
    "^doubleclick^", "^adserver^", "/wp-login.php^", "/cgi-bin/*^login^", "^captcha^",
))


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path: both empty for a null URL or one without "://"."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, "\\A([^/?#]*)", 1))
    return host, F.regexp_extract(rest, "(?s)\\A[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """In the letters that the rules run on: lower case of A to Z only. The empty token is among them where a URL begins or ends without."""
    return F.array_distinct(F.split(ascii_lower(url), "[^a-z0-9]+"))


def judge(pages: DataFrame, host_rules: tuple[Rule, ...] = HOST_RULES, patterns: tuple[Rule, ...] = PATTERNS) -> DataFrame:
    """page_id, host, path, rule (the deciding host rule, else null), verdict of every row of pages.

    A null URL, and one without "://", has an empty host and path; the latter is still held against the patterns, the former is allowed. Among
    host rules the longest wins (ties: the longer host, then the text); one blocking pattern is enough. Rows repeating a
    page_id are judged each for itself. Empty tables give empty results. Other columns are not looked at.
    """
    spark, rules = pages.sparkSession, [*host_rules, *patterns]
    table = spark.createDataFrame([(k, r.verdict, r.name, r.regex, len(r.name or ""), list(r.tokens)) for k, r in enumerate(rules)], "rule_no int, says string, name string, regex string, size int, tokens array<string>")
    bounded = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    urls = pages.select("url").filter(F.col("url").isNotNull()).distinct()
    words = urls.select("url", F.explode(tokens(F.col("url"))).alias("token"))
    literal = table.select("rule_no", F.explode("tokens").alias("token"))
    counts = words.join(bounded(literal.select("token").distinct()), "token").groupBy("token").count()
    rarest = literal.join(counts, "token", "left").groupBy("rule_no").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token"))["token"].alias("token"))
    index = table.join(rarest, "rule_no", "left").select(F.coalesce("token", F.lit("")).alias("token"), "rule_no", "says", "name", "regex", "size")
    # every URL offers the empty token once, for rules that have no other
    offered = urls.select("url", F.explode(F.array_union(tokens(F.col("url")), F.array(F.lit("")))).alias("token"))
    host, path = parts(F.col("url"))
    fits = F.when(F.col("name").isNotNull(), F.rlike(F.concat(host, path), F.col("regex"))).otherwise(F.rlike(ascii_lower(F.col("url")), F.col("regex")))
    found = offered.join(bounded(index), "token").filter(fits)
    order = F.struct(F.col("name").isNotNull().alias("is_host"), "size", F.length(F.substring_index("name", "/", 1)).alias("host_size"), (F.col("says") == "block").alias("blocks"), "name", "says")
    best = found.groupBy("url").agg(F.max(order).alias("best"))
    host, path = parts(F.col("url"))
    return pages.select("page_id", "url").join(best, "url", "left").select("page_id", host.alias("host"), path.alias("path"), F.col("best.name").alias("rule"), F.coalesce("best.says", F.lit("allow")).alias("verdict"))


def oracle_sql(host_rules: tuple[Rule, ...] = HOST_RULES, patterns: tuple[Rule, ...] = PATTERNS) -> str:
    """All rules against all URLs, for DuckDB."""
    text = lambda x: "'" + x.replace("'", "''") + "'"
    hosts = ", ".join(f"({text(r.name)}, {text(r.name.partition('/')[0])}, {text('/' + r.name.partition('/')[2])}, {text(r.verdict)})" for r in host_rules if r.name)
    blocked = " OR ".join(f"regexp_matches(url_lower, {text(r.regex)})" for r in patterns)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH rules(name, rule_host, rule_path, says) AS (VALUES {hosts}),
u AS (SELECT row_number() OVER () AS row, page_id, coalesce({lower.format("url")}, '') AS url_lower, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT row, page_id, url_lower, {lower.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
fits AS (SELECT row, arg_max(name, length(name)) AS name, arg_max(says, length(name)) AS says FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row)
SELECT page_id, host, path, name AS rule, coalesce(says, CASE WHEN {blocked} THEN 'block' ELSE 'allow' END) AS verdict FROM p LEFT JOIN fits USING (row)
"""
