"""Filter lists: syntax against a plain matcher, both index paths, many rules."""

import random

import pytest
from pyspark.sql import functions as F

from tradeledger.llm import urlrules

SEPARATES = set("abcdefghijklmnopqrstuvwxyz0123456789_-.%")


def fits(rule, text):
    """Whether the host and path hold the rule: characters one by one, without tokens or regular expressions."""
    text, rule = text.lower(), rule.lower()
    slash = text.find("/") if "/" in text else len(text)
    if rule.startswith("||"):
        rule = rule[2:]
        starts = [0, *(i + 1 for i in range(slash) if text[i] == ".")]
    elif rule.startswith("|"):
        rule, starts = rule[1:], [0]
    else:
        starts = range(len(text) + 1)
    closed = rule.endswith("|")
    rule = rule.removesuffix("|")

    def rest(r, t):
        if r == len(rule):
            return not closed or t == len(text)
        if rule[r] == "*":
            return any(rest(r + 1, u) for u in range(t, len(text) + 1))
        if rule[r] == "^":
            return (t == len(text) and rest(r + 1, t)) or (t < len(text) and text[t] not in SEPARATES and rest(r + 1, t + 1))
        return t < len(text) and text[t] == rule[r] and rest(r + 1, t + 1)

    return any(rest(0, s) for s in starts)


def judged(text, lines):
    names = sorted(x for x in lines if fits(x.removeprefix("@@"), text))
    blocks = [x for x in names if not x.startswith("@@")]
    return names, "block" if blocks and len(blocks) == len(names) else "allow"


def some_rules(pick, n):
    parts = ["ad", "ads", "x1", "b.c", "shop", ".com", "/p/", "^", "*", "-", "_", "é", "+", "(a)", "img", "."]
    made = set()
    while len(made) < n:
        body = "".join(pick.choice(parts) for _ in range(pick.randint(1, 4))).strip("|")
        if body.strip("*"):
            made.add(pick.choice(["", "", "@@"]) + pick.choice(["", "|", "||"]) + body + pick.choice(["", "", "|"]))
    return sorted(made)


@pytest.mark.parametrize("broadcast_rules", [50_000, 0])
def test_filter_syntax_against_a_plain_matcher(spark, broadcast_rules):
    pick = random.Random(4)
    lines = some_rules(pick, 150)
    hosts = ["ads.shop.com", "x1.b.c", "badads.com", "ad-x1.com:80", "b.c", "img.shop", "a_ads.b.com"]
    paths = ["", "/", "/p/ads.img", "/P/x1/img+(a)", "/é-ad", "/p/(A)_b.c", "/img/ad"]
    urls = [f"{pick.choice(['http', 'https'])}://{h}{p}" for h in hosts for p in paths] + [None, "", "ads.shop.com"]
    listed = spark.createDataFrame([(x,) for x in [*lines, *lines[:9], None, "", "  ", "! ads", "*", "||", "@@|*|"]], "value string")
    rules = urlrules.parse_filters(listed)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    found = {r.page_id: r for r in urlrules.judge_urls(pages, rules, broadcast_rules=broadcast_rules).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        text = url.split("://", 1)[1] if url and "://" in url else ""
        assert (found[i].pattern_rules, found[i].verdict) == judged(text, lines), url


def test_tokens_of_a_rule_are_whole_words_of_what_it_matches(spark):
    lines = ["||ads.example^", "banner", "/banner/", "*-track.*/click^now", "|www.x|", "@@||a1.b2"]
    rules = urlrules.parse_filters(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {r.rule: sorted(r.tokens) for r in rules.collect()} == {
        "||ads.example^": ["ads", "example"], "banner": [], "/banner/": ["banner"], "*-track.*/click^now": ["click", "track"],
        "|www.x|": ["www", "x"], "@@||a1.b2": ["a1"],
    }


@pytest.mark.parametrize("broadcast_rules", [50_000, 200_000])
def test_a_hundred_thousand_rules(spark, broadcast_rules):
    """Hosts 0 to 99,999 are blocked below /x<i mod 7>/, every tenth has an exception; joined and broadcast."""
    one = spark.range(100_000).select(F.concat(F.lit("||s"), "id", F.lit(".example^x"), F.col("id") % 7, F.lit("/")).alias("value"))
    two = spark.range(0, 100_000, 10).select(F.concat(F.lit("@@||s"), "id", F.lit(".example^*/ok|")).alias("value"))
    rules = urlrules.parse_filters(one.union(two))
    asked = [(i, f"https://{'www.' * (i % 2)}s{i * 37}.example/x{i % 5}/{'ok' if i % 3 else 'page'}") for i in range(3000)]
    found = urlrules.judge_urls(spark.createDataFrame(asked, "page_id int, url string"), rules, broadcast_rules=broadcast_rules)
    blocked = {r.page_id for r in found.where("verdict = 'block'").collect()}
    want = {
        i for i, _ in asked
        if i * 37 < 100_000 and (i * 37) % 7 == i % 5 and not (i * 37 % 10 == 0 and i % 3)
    }
    assert blocked == want and len(want) > 100


def test_no_rules_allow_everything(spark):
    pages = spark.createDataFrame([(1, "https://ads.example/x.exe"), (2, None), (3, "x://" + "a." * 50_000 + "b/")], "page_id int, url string")
    rules = spark.createDataFrame([], urlrules.RULE_SCHEMA)
    assert [tuple(r) for r in urlrules.judge_urls(pages, rules).select("page_id", "verdict", "pattern_rules").orderBy("page_id").collect()] == [
        (1, "allow", []), (2, "allow", []), (3, "allow", [])
    ]
    assert {r.verdict for r in urlrules.judge_urls(pages).collect()} == {"allow", "block"}
