"""URL rules: against DuckDB over whole tables, and small cases."""

import random
import re

from tavolo.llm import urlrules as U
from tavolo.plans.check import compare, duck

SF = "/root/testdata/sf0.001"


def test_matches_sql(spark):
    r = compare(spark, SF, "op9", U.op9_url_filters, U.ORACLE["op9_url_filters"], duck(SF))
    assert r["status"] == "match", r


def _plain(url):
    """Every rule tried in turn."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("", "") if m is None else (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2])
    fit = [(h + p, v) for h, p, v in U.SITE_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        rule, verdict = max(fit, key=lambda r: len(r[0]))
        return host, path, rule, verdict
    low = re.sub("[A-Z]", lambda c: c[0].lower(), host + path)
    wanted = [re.escape(k) for k in U.KEYWORD_RULES] + [p for p, _ in U.PATTERN_RULES]
    hit = any(re.search(rf"(?:^|[./_-])(?:{k})(?:[./_-]|\Z)", low) for k in wanted)
    return host, path, None, "block" if hit else "allow"


def test_cases(spark):
    rng = random.Random(2)
    hosts = ["a.net", "NET", "x.example.net", "example.net", "notexample.net", "example.com", "b.Example.COM", "org", "my.org", "casino.com",
             "cheap-pills.shop.com", "cheappills.com", "xcasino.com", "a.net:80", "", "É.net"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/de/y", "/fr/z", "/fr", "/poker/1", "/EN/", "/a-spam-b", "\n/en/", "/Casino/", "/x_POKER_y", "/Win-Cash", "/window-cash", "/buy_cheap-meds.html", "/buy-medals", "/free-x-Downloads/",
             "/no-deposit_bonus", "/livesex", "/live-hot-sex/", "/ads_x"]
    tails = ["", "?q=/en/", "#x", "?a#b"]
    urls = [None, "", "no scheme", "://", "http://a.org?x://casino.com/", "x" * 100_000, "http://" + "a." * 20_000 + "net/"]
    urls += [s + "://" + h + p + t for s in ("http", "") for h in hosts for p in paths for t in rng.sample(tails, 2)]
    rows = [(i if i % 7 else None, u, "h") for i, u in enumerate(urls)] + [(1, urls[20], "h")] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = U.filter_urls(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == _plain(r["url"]), r
    assert U.filter_urls(pages.limit(0)).count() == 0


def test_names_of_helper_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/Casino/")], "page_id long, url string")
    names = ("best", "__best", "__site", "__host", "__path", "token", "name", "pattern", "rank", "df", "folded", "rule", "verdict")
    got = U.filter_urls(pages.select("*", *[U.F.lit(3).alias(c) for c in names]))
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got.collect()} == {1: ("net/", "block"), 2: (None, "block")}
    assert got.where("best = 3 and token = 3 and name = 3 and pattern = 3 and rank = 3 and df = 3 and folded = 3").count() == 2


def test_literals_stand_in_every_match():
    for pattern, literals in U.PATTERN_RULES:
        assert literals and all(re.search(rf"(?:^|[_\]?)-]){t}(?:[\[_\\(]|$)", pattern) for t in literals), pattern


def test_rarest_token_files_each_rule_once(spark):
    pages = spark.createDataFrame([(f"http://h{i}.example.net/en/",) for i in range(5)] + [("http://x.net/de/",)], "url string")
    seen = pages.select(U.F.concat(U.host_of(U.F.col("url")), U.path_of(U.F.col("url"))).alias("__site"))
    index = {r["name"]: r["token"] for r in U.rule_index(seen, [U.site_rule(*r) for r in U.SITE_RULES]).collect()}
    assert index["net/"] == "net" and index["example.com/de/"] == "com" and len(index) == 4
