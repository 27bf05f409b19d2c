"""URL filters: pattern rules indexed by their rarest literal token.

Every rule names literal tokens that a matching URL must hold. The rarest of them over all URLs is
the rule's key in the index; the tokens of a URL fetch the rules to try, and only those run their
regular expression. Rules come from lines of a filter list, whose patterns and tokens are derived here,
and from host rules. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick

#: Rules up to this number are broadcast, more are joined by token.
BROADCAST_RULES = 50_000

# Host and path rules with their verdicts.
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Words that name adult sites, advertising, tracking, betting, sham medicine and mass mail as a part of a host's
#: label, between dots and hyphens, before another part.
HOST_WORDS = (
    "adult", "ads", "advert", "affiliate", "bet", "bets", "betting", "casino", "escort", "malware", "payday", "phishing", "pill",
    "pills", "poker", "popunder", "porn", "sex", "spam", "tracker", "tracking", "viagra", "warez", "webcam", "xxx",
)

#: Lines of the default list; see ``parse_filters`` for their syntax.
FILTERS = (
    "! Programs and archives to download", *(f".{kind}|" for kind in ("apk", "bat", "cab", "dmg", "exe", "iso", "msi", "rar", "scr", "zip")),
    "! Advertising, counting and forwarding", "||xxx^", "||adserver.", "||doubleclick.", "||pagead*.", "/adclick^", "/banners/*/click^",
    "/pixel.gif|", "/redirect.php|", "/track/*/click^", "/wp-login.php|",
    "! Pages that talk about the above", "@@||wikipedia.org^", "@@/robots.txt|", "@@/security.txt|",
)


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Between the first :// and the next of / ? #, A-Z lowered; empty without ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(column: Column) -> Column:
    """Distinct runs of letters and digits, lowered."""
    return F.array_distinct(F.filter(F.split(ascii_lower(column), "[^a-z0-9]+"), lambda t: t != ""))


RULE_SCHEMA = "rule string, verdict string, tokens array<string>, pattern string, place int, is_host boolean"


def host_table(spark: SparkSession, host_rules: Sequence = HOST_RULES, host_words: Sequence[str] = HOST_WORDS) -> DataFrame:
    """Host rules and host words as rows of rules.

    A host rule ``host/path`` is a pattern as well: its host or a subdomain, then its path as a prefix.
    """
    rows = []
    for name, verdict in host_rules:
        host, path = name.split("/", 1)
        literal = "".join(c if c.isalnum() else f"\\{c}" for c in f"{host}/{path}")
        tokens = [t for t in "".join(c if c.isalnum() else " " for c in host).lower().split()]
        rows.append((name, verdict, tokens, rf"(?s)^([^/]*\.)?{literal}", len(name), True))
    rows += [(f"host word {w}", "block", [w], rf"^([^/]*[.-])?{w}[.-][^/]*", 0, False) for w in host_words]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def parse_filters(lines: DataFrame) -> DataFrame:
    """Rules from the lines of a filter list (column ``value``), one row per distinct rule.

    A rule is text that host and path hold somewhere, letters in either case. In it ``*`` stands for any
    characters, ``^`` for one character other than A-Z, 0-9, ``_ - . %``, or for the end; ``||`` in front
    for the begin of the host or of one of its labels, ``|`` in front for the begin of the host, and at the
    end for the end of the path. ``@@`` before all that makes an exception. Lines that are empty or NULL
    or begin with ``!`` are passed over, as are rules of nothing but wildcards. Other signs are ordinary
    ones: there are no options and no regular expressions in a list.

    The tokens of a rule are its runs of letters and digits that no wildcard or open end can prolong:
    every URL that it matches holds them as whole tokens. A rule may have none.
    """
    text = F.btrim("value", F.lit(" \t\r\n"))
    rules = pick(lines, "value").select(text.alias("rule")).where((F.col("rule") != "") & ~F.startswith("rule", F.lit("!"))).distinct()
    allowed = F.startswith("rule", F.lit("@@"))
    body = F.when(allowed, F.substring("rule", 3, 2**31 - 1)).otherwise(F.col("rule"))
    form = r"(?s)^(\|\|?)?(.*?)(\|)?$"
    pieces = [F.regexp_extract("body", form, i).alias(name) for i, name in enumerate(("front", "middle", "end"), 1)]
    parts = rules.select("rule", allowed.alias("allowed"), body.alias("body")).select("rule", "allowed", *pieces)
    parts = parts.where(F.translate("middle", "*", "") != "")
    escaped = F.regexp_replace("middle", r"([\\.+?{}()|\[\]$])", r"\\$1")
    inner = F.replace(F.replace(escaped, F.lit("^"), F.lit("([^a-z0-9_.%-]|$)")), F.lit("*"), F.lit(".*"))
    begin = F.when(F.col("front") == "||", r"^([^/]*\.)?").when(F.col("front") == "|", "^").otherwise("")
    end = F.when(F.col("end") == "|", r"\z").otherwise("")
    closed = F.concat(
        F.when(F.col("front") == "", "*").otherwise(""), ascii_lower(F.col("middle")), F.when(F.col("end") == "", "*").otherwise("")
    )
    return parts.select(
        "rule",
        F.when(F.col("allowed"), "allow").otherwise("block").alias("verdict"),
        F.array_distinct(F.regexp_extract_all(closed, F.lit("(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])"), F.lit(0))).alias("tokens"),
        F.concat(F.lit("(?is)"), begin, inner, end).alias("pattern"),
        F.lit(0).alias("place"),
        F.lit(False).alias("is_host"),
    )


def default_rules(spark: SparkSession) -> DataFrame:
    lines = spark.createDataFrame([(line,) for line in FILTERS], "value string")
    return host_table(spark).unionByName(parse_filters(lines))


def rule_index(rules: DataFrame, tokens: DataFrame, few: bool) -> DataFrame:
    """Each rule with the literal token that the fewest URLs hold; ``tokens`` has a row per URL and token.

    A rule without tokens stands under the empty token, which every URL has. ``few`` rules are sent to the
    tokens before these are counted; otherwise all tokens are counted, task by task before the shuffle.
    """
    wanted = rules.select("rule", F.explode(F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token"))
    seen = tokens.select("token")
    if few:
        seen = seen.join(F.broadcast(wanted.select("token").distinct()), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    by_rule = wanted.join(counts, "token", "left").groupBy("rule").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0).cast("bigint")).alias("urls"), "token")).alias("rarest")
    )
    # A rule whose rarest token no URL has matches nothing.
    held = by_rule.where("rarest.urls > 0").select("rule", F.col("rarest.token").alias("token"))
    return rules.drop("tokens").join(held, "rule")


def judge_urls(
    pages: DataFrame, rules: DataFrame | None = None, id_column: str = "page_id", broadcast_rules: int = BROADCAST_RULES
) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, pattern_rules.

    ``rules`` are rows of ``RULE_SCHEMA`` (distinct names), those of ``default_rules`` without it. ``rule`` is
    the longest host rule that fits, whose verdict holds; else NULL, and the URL is blocked if a pattern
    rule with that verdict matches and no exception does, else allowed. ``pattern_rules`` names all pattern
    rules that match, sorted. Patterns see the lowered host and the path as it is; a rule is found through
    tokens, so its tokens must be whole words of every URL it matches. A NULL URL or one without ://
    has an empty host and path, and only rules without tokens can match it. Repeated URLs are judged
    once, every row gets its result. Without rules every URL is allowed.

    Up to ``broadcast_rules`` rules are sent to the URLs; more are joined with them by token, where
    rules that no URL has the rarest token of are left out first.
    """
    rows = pick(pages, id_column, "url")
    rules = default_rules(pages.sparkSession) if rules is None else rules
    few = rules.count() <= broadcast_rules
    known = rules.drop("tokens").columns
    urls = rows.select("url").distinct()
    urls = urls.select("url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("place_text"))
    every = F.concat(tokens_of(F.col("place_text")), F.array(F.lit("")))
    tokens = urls.select("url", "place_text", F.explode(every).alias("token"))
    index = rule_index(rules, tokens, few)
    tried = tokens.join(F.broadcast(index) if few else index, "token")
    matched = tried.where(F.expr("place_text rlike pattern")).select("url", *known)
    best = F.max(F.when(F.col("is_host"), F.struct("place", "rule", "verdict")))
    others = F.collect_set(F.when(~F.col("is_host"), F.col("rule")))
    said = [F.max(F.when(~F.col("is_host"), F.col("verdict") == v)).alias(name) for v, name in (("block", "blocks"), ("allow", "excepts"))]
    by_url = matched.groupBy("url").agg(best.alias("best"), F.sort_array(others).alias("names"), *said)
    out = rows.join(by_url.withColumnRenamed("url", "u"), F.col("url").eqNullSafe(F.col("u")), "left")
    blocked = F.coalesce("blocks", F.lit(False)) & ~F.coalesce("excepts", F.lit(False))
    method = F.when(blocked, "block").otherwise("allow")
    return out.select(
        id_column,
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", method).alias("verdict"),
        F.coalesce("names", F.array().cast("array<string>")).alias("pattern_rules"),
    )
