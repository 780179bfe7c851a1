"""URL rules against a loop over all rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from seriesmill.llm import urlrules


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    return host, m[2] if m else ""


def plain(url, rules):
    host, path = split(url)
    best = None
    for rule_host, rule_path, verdict in rules:
        rule_host, rule_path = (rule_host or "").lower(), rule_path or ""
        if rule_host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rank = (len(rule_host) + len(rule_path), len(rule_host), verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, rule_host + rule_path, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


def judged(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumns({"host": F.lit(1), "key": F.lit(2)})
    rs = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.judged(df, rs).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_against_all_rules(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(urlrules, "RANGE_ROWS", 40)
    rng = random.Random(7)
    label = lambda: rng.choice(["a", "b", "com", "net", "www", "x-y", "é", "A"])
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda: "".join(rng.choice(["/", "/en/", "/es", "a", "b.html"]) for _ in range(rng.randint(0, 4)))
    urls = [f"{rng.choice(['http', 'https', ''])}://{host(4)}{path() and '/' + path()}{rng.choice(['', '?q=://a.com/', '#x'])}" for _ in range(1500)]
    urls += ["http://hot.a.com/en/"] * 700 + [None, "", "no scheme", "://", "http://a.com", "http://COM/", "x://a\x01b.com/", "http://u@a.com:80/p", "http://" + "s." * 3000 + "com/"]
    rules = [(host(3), rng.choice(["", "/", "/en/", "/es", "//"]), rng.choice(["allow", "block"])) for _ in range(60)]
    rules = list({(h.lower(), p): (h, p, v) for h, p, v in rules}.values()) + [("", "/", "block"), (None, None, "block"), ("a.com", None, "block")]
    got = judged(spark, urls, rules)
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_same_rule_twice_blocks(spark):
    assert judged(spark, ["http://a.com/"], [("a.com", "/", "block"), ("a.com", "/", "allow"), ("A.com", "/", "allow")])[0][2:] == ("a.com/", "block")


def test_no_rules_and_no_urls(spark):
    df = spark.createDataFrame([], "host string, path string, verdict string")
    urls = spark.createDataFrame([(1, "http://a/b"), (1, "http://a/b"), (None, None)], "page_id bigint, url string")
    assert sorted((r["host"], r["verdict"]) for r in urlrules.judged(urls, df).collect()) == [("", "allow"), ("a", "allow"), ("a", "allow")]
    assert urlrules.judged(urls.where("false"), df).count() == 0
