r"""URL filter: pattern rules indexed by their rarest literal token.

A rule is (name, verdict, pattern, tokens): a regular expression over
``host + path`` and literal tokens that every matching URL contains. Each rule
is filed under the token that occurs in the fewest URLs of the corpus. The
tokens of a URL fetch its candidate rules, and only those candidates run their
regular expression. All of it is DataFrame code.

* Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
  lower-cased. Path: from there up to ``?``, ``#`` or the end. Null, or no
  ``://``: both are empty, and no rule fits.
* Tokens: maximal runs of characters other than ``. / _ -`` in host and path,
  with A-Z lower-cased, so a host label or a path segment is one or several tokens.
* Site rules (host, path, verdict) fit the host and its subdomains when the
  URL's path starts with the rule's path, letter by letter; the longest rule wins,
  then the first by name. Where none fits, a URL is blocked if a keyword (a chain
  of whole tokens) or a pattern of unwanted pages matches, whatever the case of
  A-Z, and else allowed.

Rows are independent: repeated rows repeat their result, a null id is kept, an
empty table gives an empty result, very long URLs are judged whole. Extra input
columns are kept unless the output has a column of that name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tavolo.llm.shared import table, without

#: A rule list of up to this many characters is broadcast; a longer one is joined by token.
BROADCAST_RULE_CHARS = 4_000_000

#: Characters between tokens, as a regular expression class.
TOKEN_BREAK = r"[./_-]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict). Fixed by the query's contract.
SITE_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

#: Words that mark unwanted hosts or pages; each is a chain of whole tokens.
KEYWORD_RULES = [
    # gambling
    "bet", "betting", "bets", "bingo", "blackjack", "casino", "casinos", "gambling", "jackpot", "lottery", "poker", "roulette", "slots", "sportsbook", "wager",
    # drugs sold without prescription
    "cheap-pills", "cialis", "pharmacy", "pills", "viagra",
    # adult pages
    "adult", "escort", "porn", "xxx",
    # copied software
    "crack", "keygen", "torrent", "warez",
    # advertising and tracking
    "ads", "adserver", "adverts", "affiliate", "popunder", "popup", "tracker", "tracking",
    # money and link schemes
    "free-money", "get-rich", "link-farm", "payday", "spam",
]

#: (pattern, literal tokens of every match), on lower-cased host and path, between token borders.
PATTERN_RULES = [
    (r"buy[_-](?:[a-z]+[_-])?(?:drugs|meds|steroids|tramadol|xanax)", ("buy",)),
    (r"free[_-](?:[a-z0-9]+[_-])?(?:download|ringtone|spin)s?", ("free",)),
    (r"live[_-](?:[a-z]+[_-])?sex", ("live", "sex")),
    (r"make[_-]money[_-](?:fast|now|online)", ("make", "money")),
    (r"no[_-]deposit[_-]bonus(?:es)?", ("no", "deposit")),
    (r"sex[_-](?:cam|chat|video)s?", ("sex",)),
    (r"win[_-](?:a[_-])?(?:big|cash|iphone|prize)s?", ("win",)),
]


@dataclass(frozen=True)
class Rule:
    """``literals`` are tokens that any matching ``host + path`` contains; ``folded`` rules see it lower-cased."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    rank: int
    folded: bool


def folded(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def tokens_of(text: str) -> tuple[str, ...]:
    return tuple(t for t in re.split(TOKEN_BREAK, text.translate(str.maketrans(UPPER, LOWER))) if t)


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """Host and subdomains, path prefix. The last path token may go on in the URL, so it is no literal."""
    whole = re.sub(r"[^./_-]*$", "", path)
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}" if path else rf"^(?:[^/]*\.)?{re.escape(host)}(?:/|\z)"
    return Rule(host + path, verdict, pattern, tokens_of(host) + tokens_of(whole), len(host + path), False)


def pattern_rule(pattern: str, literals: tuple[str, ...]) -> Rule:
    return Rule(f"*{pattern}*", "block", rf"(?:^|[./_-])(?:{pattern})(?:[./_-]|\z)", literals, 0, True)


def keyword_rule(word: str) -> Rule:
    return pattern_rule(re.escape(word), tokens_of(word))


def all_rules(sites=None, keywords=None, patterns=None) -> list[Rule]:
    return ([site_rule(*r) for r in (SITE_RULES if sites is None else sites)]
            + [keyword_rule(w) for w in (KEYWORD_RULES if keywords is None else keywords)]
            + [pattern_rule(*p) for p in (PATTERN_RULES if patterns is None else patterns)])


def host_of(url: Column) -> Column:
    """Empty for null and for URLs without ``://``."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(folded(raw), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.split(folded(text), TOKEN_BREAK))


def rule_index(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """(token, name, verdict, pattern, rank, folded): each rule under its rarest literal token.

    Token frequencies are counted over all URLs (partial aggregation); only
    the tokens that rules use are counted. The index has one row per rule.
    """
    listed = urls.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.pattern).alias("pattern"),
                 F.lit(t).alias("token"), F.lit(r.rank).alias("rank"), F.lit(r.folded).alias("folded")) for r in rules for t in r.literals])))
    words = sorted({t for r in rules for t in r.literals})
    used = F.array(*[F.lit(w) for w in words])
    counts = (urls.select(F.explode(F.array_intersect(_tokens(F.col("__site")), used)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    return (listed.join(counts, "token", "left")
            .groupBy("name", "verdict", "pattern", "rank", "folded")
            .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token")).alias("least"))
            .select(F.col("least.token").alias("token"), "name", "verdict", "pattern", "rank", "folded"))


def filter_urls(pages: DataFrame, url: str = "url", sites: list[tuple[str, str, str]] | None = None,
                keywords: list[str] | None = None, patterns: list[tuple[str, tuple[str, ...]]] | None = None) -> DataFrame:
    """Input columns plus host, path, rule and verdict (allow or block).

    ``rule`` names the site rule that decides, else null; then a keyword or
    pattern rule blocks, and everything else is allowed. ``rule_hit`` is the
    rule that gave the verdict, one of the latter included.
    """
    rules = all_rules(sites, keywords, patterns)
    urls = (without(pages, "host", "path", "rule", "verdict", "rule_hit", "__best", "__host", "__path")
            .withColumn("host", host_of(F.col(f"`{url}`"))).withColumn("path", path_of(F.col(f"`{url}`"))))
    # Each different URL is judged once, so a hot URL costs one candidate search.
    sites_seen = urls.select("host", "path").distinct().withColumn("__site", F.concat("host", "path"))
    index = rule_index(sites_seen, rules)
    if sum(len(r.pattern) + len(r.name) for r in rules) <= BROADCAST_RULE_CHARS:
        index = F.broadcast(index)
    seen = F.when(F.col("folded"), folded(F.col("__site"))).otherwise(F.col("__site"))
    hits = (sites_seen.withColumn("token", F.explode(_tokens(F.col("__site"))))
            .join(index, "token").where(F.regexp_like(seen, F.col("pattern"))))
    best = (hits.groupBy(F.col("host").alias("__host"), F.col("path").alias("__path"))
            .agg(F.min(F.struct((-F.col("rank")).alias("rank"), "name", "verdict")).alias("__best")))
    return (urls.join(best, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
            .withColumn("rule", F.when(F.col("__best.rank") < 0, F.col("__best.name")))
            .withColumn("verdict", F.coalesce("__best.verdict", F.lit("allow")))
            .withColumn("rule_hit", F.col("__best.name")).drop("__best", "__host", "__path"))


def op9_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "rule_hit")


def _oracle() -> str:
    """Every rule is tried on every URL: no index, no tokens."""
    quoted = ", ".join("('{}', '{}', '{}', {}, {})".format(r.name, r.verdict, r.pattern, r.rank, r.folded) for r in all_rules())
    return f"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                           '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
r(name, verdict, pattern, len, folded) AS (VALUES {quoted}),
best AS (
  SELECT host, path, min(struct_pack(l := -len, n := name, v := verdict)) AS b
  FROM (SELECT DISTINCT host, path, translate(host || path, '{UPPER}', '{LOWER}') AS low FROM u) s
  JOIN r ON regexp_matches(CASE WHEN r.folded THEN s.low ELSE s.host || s.path END, r.pattern)
  GROUP BY host, path)
SELECT page_id, u.host, u.path, CASE WHEN b.l < 0 THEN b.n END AS rule,
       coalesce(b.v, 'allow') AS verdict, b.n AS rule_hit
FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path"""


ORACLE = {"op9_url_filters": _oracle()}
