"""Allow and block rules over URLs, found through their rarest literal token.

Every rule names literal tokens that each matching URL must contain. The rule
is indexed by the one that the fewest URLs contain, so a URL fetches few rules
and only those run their regular expression. Only DataFrame functions are used.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.llm.common import ascii_lower


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is searched in host and path together, as in ``site.org/en/1``.

    A ``scoped`` rule names a host and a path; the longest one that fits
    decides. Other rules count only where none fits: an allowing one beats a
    blocking one. Each of ``tokens`` (lower case, ``[a-z0-9]+``) is a whole
    token of every URL that the pattern finds; none means that the pattern
    runs on every URL.
    """

    rule: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    scoped: bool = False


def scope_rule(verdict: str, rule: str) -> UrlRule:
    """A rule such as ``example.net/en/``: the host with its subdomains, and a path prefix."""
    host, slash, path = rule.partition("/")
    host = ascii_lower_text(host)
    # the last token of a path prefix may go on in the URL, unless something else ends it
    tokens = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", ascii_lower_text(f"{host}/{path}"))
    pattern = rf"\A(?:[^/]*\.)?{re.escape(host)}(?=/|\z){re.escape(slash + path)}"
    return UrlRule(rule, verdict, pattern, tuple(tokens), True)


def host_word_rule(verdict: str, word: str) -> UrlRule:
    """A word between dots or hyphens of the host."""
    pattern = rf"\A(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|\z)"
    return UrlRule(f"host word {word}", verdict, pattern, tuple(re.findall("[a-z0-9]+", word)))


def ascii_lower_text(text: str) -> str:
    return text.encode().lower().decode()


SCOPE_RULES = (
    scope_rule("block", "net/"),
    scope_rule("allow", "example.net/en/"),
    scope_rule("block", "example.com/de/"),
    scope_rule("allow", "org/fr/"),
)
#: Host words that stand for advertising, tracking, adult, gambling and junk sites.
BLOCKED_HOST_WORDS = (
    "ad", "adult", "ads", "adserver", "affiliate", "banner", "bet", "betting", "casino", "clickbait",
    "content-farm", "doubleclick", "escort", "gambling", "link-farm", "malware", "payday", "phishing",
    "popup", "porn", "porno", "sex", "spam", "spam-farm", "track", "tracker", "tracking", "viagra",
    "warez", "xxx",
)
#: Words that make a host one about the matter, not one of the kind.
ALLOWED_HOST_WORDS = ("education", "health", "research", "wiki")
RULES = (
    *SCOPE_RULES,
    *(host_word_rule("block", w) for w in BLOCKED_HOST_WORDS),
    *(host_word_rule("allow", w) for w in ALLOWED_HOST_WORDS),
)


def rule_table(spark: SparkSession, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    schema = (
        "rule string, rule_verdict string, pattern string, rule_tokens array<string>, scoped boolean"
    )
    rows = [(r.rule, r.verdict, r.pattern, sorted(set(r.tokens)), r.scoped) for r in rules]
    return spark.createDataFrame(rows, schema)


def url_host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return ascii_lower(F.coalesce(found, F.lit("")))


def url_path(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def url_tokens(targets: DataFrame) -> DataFrame:
    """The distinct tokens of each target; the empty token stands for every target."""
    tokens = F.regexp_extract_all(ascii_lower(F.col("target")), F.lit("[a-z0-9]+"), F.lit(0))
    distinct = F.array_distinct(F.array_append(tokens, F.lit("")))
    return targets.select("target", F.explode(distinct).alias("token"))


def rule_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule with the one of its tokens that the fewest targets contain; ties by token."""
    whole = F.when(F.size("rule_tokens") > 0, F.col("rule_tokens")).otherwise(F.array(F.lit("")))
    wanted = rules.withColumn("token", F.explode(whole))
    counts = (
        tokens.join(wanted.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("seen"))
    )
    ranked = wanted.join(counts, "token", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    return ranked.groupBy("rule", "rule_verdict", "pattern", "scoped").agg(
        F.min_by("token", F.struct("seen", "token")).alias("token")
    )


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] | DataFrame = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``rules`` may be a table of any size, with the columns of ``rule_table``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end; both are empty
    if the url is null or has no ``://``. The longest scoped rule that fits
    gives ``rule`` and ``verdict`` (equally long ones: the greatest text). With
    none, ``rule`` is null and the verdict is block if a blocking pattern and no
    allowing one is found, else allow. Each distinct host and path is judged
    once; repeated rows stay, an empty table gives none, and other columns than
    ``page_id`` and ``url`` aren't read.
    """
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    parsed = parsed.withColumn("target", F.concat("host", "path"))
    tokens = url_tokens(parsed.select("target").distinct())
    listed = rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules)
    index = rule_index(listed, tokens)
    found = tokens.join(index, "token").filter("target rlike pattern")
    order = F.struct(F.length("rule").alias("size"), "rule", "rule_verdict")
    judged = found.groupBy("target").agg(
        F.max(F.when(F.col("scoped"), order)).alias("best"),
        F.max(~F.col("scoped") & (F.col("rule_verdict") == "allow")).alias("allowed"),
        F.max(~F.col("scoped") & (F.col("rule_verdict") == "block")).alias("blocked"),
    )
    own = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")
    return parsed.join(judged, "target", "left").select(
        "page_id", "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", own).alias("verdict"),
    )
