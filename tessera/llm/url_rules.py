"""URL filters (operator 6): host rules and pattern rules found by token.

Pattern rules are texts such as ``||cheap-pills.``: ``||`` at the start stands
for the start of the host or of one of its labels, ``^`` for one separator
(anything but a letter, a digit or one of ``_-.%``) or the end, ``*`` for any
text, everything else for itself.  A pattern is tried on the lower-cased url.

A rule's literal tokens are the runs of letters and digits that every matching
url must hold as whole tokens.  Each rule is indexed by the one that is rarest
among the tokens of all urls; a url's tokens fetch the rules indexed by them,
and only those rules run their regular expression.  Rules with no such token
are indexed by the empty token, which every url has, in salted forms.  Rules
may be a table: they are indexed by joins, and none of them is in a plan.

Host rules (``host/path``) are fetched the same way, by the last labels of the
host; the longest that fits decides before any pattern does.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, stage

#: (verdict, host and path prefix); the longest that fits wins.
HOST_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

#: (verdict, pattern); an allow pattern beats the block patterns.
PATTERN_RULES = [
    ("block", "||cheap-pills."), ("block", "||spam-farm."), ("block", "||casino-bonus."), ("block", "||free-movies."),
    ("block", "^adult^"), ("block", "^xxx^"), ("block", "/wp-login.php"), ("block", "^viagra^"),
    ("block", "/porn/"), ("block", "^torrent^download^"), ("block", "||click*.example.org^"),
    ("allow", "||spam-farm.*/about/"),
]

SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\z)"


def pattern_regex(pattern: str) -> str:
    """Regular expression (the same for Java and RE2) of a pattern rule."""
    anchored = pattern.startswith("||")
    body = pattern[2:] if anchored else pattern
    parts = {"^": SEPARATOR, "*": "(?s:.*)"}
    out = "".join(parts.get(c) or re.sub(r"([^A-Za-z0-9])", r"\\\1", c) for c in body)
    return (r"^[^:/?#]*://(?:[^/?#]*\.)?" if anchored else "") + out


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that a url must hold whole to match: runs of letters and digits
    with ``||`` or a literal or separator other than ``*`` on both sides."""
    body = pattern.replace("||", "\n", 1) if pattern.startswith("||") else pattern
    return sorted(set(re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", body)))


def url_parts(url) -> dict:
    """Columns ``host`` (A-Z lower-cased) and ``path``; both empty for a null
    url or one without ``://``."""
    text = F.coalesce(url, F.lit(""))
    return {
        "host": lower_ascii(F.regexp_extract(text, r"^(?s:.*?)://([^/?#]*)", 1)),
        "path": F.regexp_extract(text, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1),
    }


def _tokens(url):
    """Distinct tokens of a lower-cased url."""
    return F.array_distinct(F.split(F.regexp_replace(url, "[^a-z0-9]+", " "), " "))


def _empty_token(url, salts: int):
    """The salted empty token of a url, which fetches rules without tokens."""
    return F.concat(F.lit("#"), F.pmod(F.xxhash64(url), F.lit(salts)).cast("string"))


def pattern_rules(spark: SparkSession, patterns: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """Rows ``rule_no, verdict, regex, tokens`` of a table (or list) of
    ``verdict, pattern``: what :func:`pattern_regex` and :func:`literal_tokens`
    say of a pattern, by column expressions.  Null patterns are no rules."""
    table = patterns if isinstance(patterns, DataFrame) else spark.createDataFrame(list(patterns), "verdict string, pattern string")
    pattern = F.col("pattern")
    anchored = pattern.startswith("||")
    body = F.when(anchored, F.substring(pattern, 3, 1 << 30)).otherwise(pattern)
    letters = F.filter(F.split(body, ""), lambda c: c != "")
    regex = F.array_join(F.transform(letters, lambda c: F.when(c == "^", SEPARATOR).when(c == "*", "(?s:.*)")
                                     .when(c.rlike("^[A-Za-z0-9]$"), c).otherwise(F.concat(F.lit("\\"), c))), "")
    framed = F.when(anchored, F.concat(F.lit("\n"), body)).otherwise(pattern)
    tokens = F.array_distinct(F.regexp_extract_all(framed, F.lit("(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])"), F.lit(1)))
    return table.filter(pattern.isNotNull()).select(
        F.monotonically_increasing_id().alias("rule_no"), "verdict",
        F.concat(F.when(anchored, r"^[^:/?#]*://(?:[^/?#]*\.)?").otherwise(""), regex).alias("regex"), tokens.alias("tokens"))


def pattern_index(urls: DataFrame, patterns: Sequence[tuple[str, str]] | DataFrame, salts: int = 16) -> DataFrame:
    """Rows ``token, regex, verdict``: each pattern under its rarest token, by
    the number of rows of ``urls`` (column ``u``) that hold the token; patterns
    without a token under every salted empty one."""
    rules = stage(pattern_rules(urls.sparkSession, patterns), "pattern_rules")
    counts = urls.select(F.explode(_tokens(F.col("u"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    each = rules.filter(F.size("tokens") > 0).select("rule_no", "regex", "verdict", F.explode("tokens").alias("token"))
    rarest = each.join(counts, "token", "left").groupBy("rule_no").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "regex", "verdict")).alias("r"))
    without = rules.filter(F.size("tokens") == 0).select(F.explode(F.array(*[F.lit(f"#{k}") for k in range(salts)])).alias("token"), "regex", "verdict")
    return rarest.select("r.token", "r.regex", "r.verdict").unionByName(without)


def judge_urls(pages: DataFrame, host_rules: Sequence[tuple[str, str]] | DataFrame = HOST_RULES,
               patterns: Sequence[tuple[str, str]] | DataFrame = PATTERN_RULES, url: str = "url", salts: int = 16) -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict`` and ``n_blocking`` (block
    patterns that match).

    The verdict is that of the longest host rule that fits (ties: allow); else
    allow if an allow pattern matches or no block pattern does, else block.  A
    null or malformed url has empty parts and no rule; patterns see it as it
    is, null as the empty text.  Each distinct url is judged once; the verdicts
    meet the rows again by url, in ``salts`` parts a url so that a url of many
    rows does not meet in one task.  Columns of ``pages`` with one of the
    result names are replaced; an empty table gives an empty table.  Host rules
    are a list, or a table ``verdict, rule``; pattern rules a list, or a table
    ``verdict, pattern``."""
    spark = pages.sparkSession
    parts = url_parts(F.col("raw"))
    distinct = pages.select(F.coalesce(F.col(url), F.lit("")).alias("raw")).distinct()
    urls = distinct.select("raw", lower_ascii(F.col("raw")).alias("u"))

    held = F.array_append(_tokens(F.col("u")), _empty_token(F.col("u"), salts))
    found = (urls.select("raw", "u", F.explode(held).alias("token"))
             .join(pattern_index(urls, patterns, salts), "token")
             .filter(F.expr("u RLIKE regex"))
             .select("raw", F.col("verdict").alias("pattern_verdict"), F.lit(None).cast("string").alias("rule"),
                     F.lit(None).cast("string").alias("rule_verdict")))

    hosts = host_rules if isinstance(host_rules, DataFrame) else spark.createDataFrame(list(host_rules), "verdict string, rule string")
    rules = hosts.select(F.substring_index("rule", "/", 1).alias("suffix"), F.col("verdict").alias("rule_verdict"), "rule",
                         F.expr("concat('/', substring(rule, length(substring_index(rule, '/', 1)) + 2))").alias("prefix"))
    labels = rules.agg(F.max(F.size(F.split("suffix", r"\.")))).first()[0] or 1
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in range(1, labels + 1)]))
    fitting = (distinct.select("raw", *[c.alias(n) for n, c in parts.items()])
               .select("raw", "path", F.explode(suffixes).alias("suffix"))
               .join(rules, "suffix").filter(F.col("path").startswith(F.col("prefix")))
               .select("raw", F.lit(None).cast("string").alias("pattern_verdict"), "rule", "rule_verdict"))

    longest = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule"), -F.ascii("rule_verdict"), "rule", "rule_verdict")))
    verdicts = (found.unionByName(fitting).groupBy("raw").agg(
        longest.alias("best"),
        F.count_if(F.col("pattern_verdict") == "block").alias("n_blocking"),
        F.count_if(F.col("pattern_verdict") == "allow").alias("n_allowing"))
        .select(F.col("raw").alias("__key"), "best", "n_blocking", "n_allowing",
                F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")))

    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "n_blocking")]
    rows = pages.select(*kept).withColumns({
        "__key": F.coalesce(F.col(url), F.lit("")),
        "__salt": F.pmod(F.xxhash64(*[F.col(c) for c in kept if c != url] or [F.lit(0)]), F.lit(salts)).cast("int")})
    joined = rows.join(verdicts.withColumnsRenamed({"n_blocking": "__n_blocking", "n_allowing": "__n_allowing", "best": "__best"}),
                       ["__key", "__salt"], "left")
    n_block = F.coalesce("__n_blocking", F.lit(0)).cast("long")
    own = url_parts(F.col(url))
    return joined.select(
        *kept, own["host"].alias("host"), own["path"].alias("path"), F.col("__best.rule").alias("rule"),
        F.coalesce(F.col("__best.rule_verdict"),
                   F.when((n_block > 0) & (F.coalesce("__n_allowing", F.lit(0)) == 0), "block").otherwise("allow")).alias("verdict"),
        n_block.alias("n_blocking"))
