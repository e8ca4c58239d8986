"""URL filter: pattern rules indexed by their rarest literal token, in DataFrame functions only.

Every rule has a regular expression and the literal tokens that any URL it fits must contain. A rule is filed under the
one of its tokens that the fewest URLs have. The tokens of a URL fetch candidate rules, and only those run their
expression. A rule without tokens would have to be tried on every URL, so it is refused.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[^a-z0-9]+"
#: Rules that place a URL: host, path, verdict.
SITE_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Words of a host or path that block a URL which no site rule fits.
BLOCKED_TERMS = ("cheap-pills", "spam-farm", "casino", "viagra", "porn", "payday-loan", "lottery", "torrent", "warez", "escort")
DEFAULT_VERDICT = "allow"

RULE_TYPES = "rule string, host_pattern string, pattern string, verdict string, length int, tokens array<string>"


def lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; empty without one."""
    return F.coalesce(lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(text: str) -> list[str]:
    return sorted({t for t in re.split(TOKEN, text.lower()) if t})


def site_rule(host: str, path: str, verdict: str) -> tuple:
    """Fits the host and its subdomains where the path starts with ``path``, whose first and last words end at a ``/``.

    The last word of a path may go on in a URL unless the rule's path ends with a separator, so it is no token then.
    """
    ends = not path or not path[-1].isalnum()
    literal = tokens_of(host) + (tokens_of(path) if ends else tokens_of(path)[:0])
    return (host + path, rf"(?s)\A(?:.*\.)?{re.escape(host)}\z", rf"\A{re.escape(path)}", verdict, len(host + path), literal)


def term_rule(term: str) -> tuple:
    """Fits where the term stands in host or path between non-alphanumeric characters."""
    return (term, None, rf"(?i)(?<![a-z0-9]){re.escape(term)}(?![a-z0-9])", "block", len(term), tokens_of(term))


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*(site_rule(*r) for r in SITE_RULES), *map(term_rule, BLOCKED_TERMS)], RULE_TYPES)


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``, repeated rows too.

    The longest site rule that fits gives rule and verdict (of equal length, the last by code point); else the rule is
    null, and the verdict is block if a term rule fits, the default if not. Null URLs and URLs without ``://`` have
    empty host and path, and the default. Empty table: no rows. Other columns are not read.
    """
    if rules.where(F.size("tokens") < 1).head(1):
        raise ValueError("every rule needs a literal token")
    places = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    distinct = places.select("host", "path").distinct()
    tokens = distinct.select("host", "path", F.explode(F.array_distinct(F.split(lower(F.concat_ws(" ", "host", "path")), TOKEN))).alias("token")).where(F.col("token") != "")
    filed = rules.select("rule", "host_pattern", "pattern", "verdict", "length", F.explode("tokens").alias("token"))
    # Only tokens that some rule has are counted; a token that no URL has makes its rule the rarest of all.
    often = tokens.join(filed.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    index = (
        filed.join(often, "token", "left")
        .groupBy("rule", "host_pattern", "pattern", "verdict", "length")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token"))["token"].alias("token"))
    )
    fits = (
        tokens.join(index, "token")
        .where(
            F.expr("CASE WHEN host_pattern IS NULL THEN rlike(concat(host, ' ', path), pattern) ELSE rlike(host, host_pattern) AND rlike(path, pattern) END")
        )
        .groupBy("host", "path")
        .agg(
            F.max(F.when(F.col("host_pattern").isNotNull(), F.struct("length", "rule", "verdict"))).alias("site"),
            F.max(F.when(F.col("host_pattern").isNull(), F.lit("block"))).alias("term"),
        )
    )
    return places.join(fits, ["host", "path"], "left").select(
        F.col("page_id"), "host", "path", F.col("site.rule").alias("rule"), F.coalesce("site.verdict", "term", F.lit(DEFAULT_VERDICT)).alias("verdict")
    )
