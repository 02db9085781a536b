"""URL filter: pattern rules found through their rarest literal token (native).

A rule is a regular expression with a verdict, a name, and the literal tokens
that every match has.  Each rule is filed under the one of its tokens that the
fewest URLs of the table have.  The tokens of a URL fetch the rules filed under
them; only those rules run their expression.  Rules without a token are tried
on every URL.

The verdict of a URL is that of the longest host rule that fits; if none fits,
that of the longest pattern rule that matches; else ``allow``.  A URL without
``://`` (or null) has an empty host and path and is blocked: it cannot be
fetched.  Ties of length go to the smaller name.

Plan: tokens and candidate rules stay with the row; matches are combined per
URL before they are shuffled, and join the pages by URL.  The rule index is
broadcast if the rules are few (counted), else joined by token.

Defined results: null, empty and very long URLs are judged like others;
repeated rows are judged each; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

HOST_RULE, PATTERN_RULE = 1, 0
MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path (host rules) or in the whole URL."""
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    kind: int


def _literal(s: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in s)


def host_rule(verdict: str, where: str) -> Rule:
    """Fits the host of ``where``, its subdomains and the paths that start as
    its path does.  The last path part is a token only if a slash ends it."""
    host, slash, path = where.partition("/")
    parts = path.split("/")[:-1]
    tokens = {t for p in [*host.split("."), *parts] for t in _ascii_tokens(p)}
    return Rule(where, verdict, f"^([^/]*\\.)?{_literal(host)}{_literal(slash + path)}", tuple(sorted(tokens)), HOST_RULE)


def _ascii_tokens(s: str) -> list[str]:
    return "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in s).split()


# The rules of the query, and the patterns tried where none fits.
HOST_RULES = [host_rule("allow", "com/"), host_rule("block", "example.com/en/"), host_rule("allow", "www.example.com/en/"),
              host_rule("block", "net/es/"), host_rule("block", "net/fr/")]
PATTERN_RULES = [
    Rule("casino", "block", "(?i)[/.-]casino[/.-]", ("casino",), PATTERN_RULE),
    Rule("porn", "block", "(?i)[/.-]porn[/.-]", ("porn",), PATTERN_RULE),
    Rule("ads", "block", "(?i)[/.-]ads[/.-]", ("ads",), PATTERN_RULE),
    Rule("login", "block", "(?i)/login([/?#.]|$)", ("login",), PATTERN_RULE),
    Rule("cart", "block", "(?i)/cart([/?#]|$)", ("cart",), PATTERN_RULE),
    Rule("session", "block", "(?i)[?&]sessionid=", ("sessionid",), PATTERN_RULE),
    Rule("feed", "block", "[?&]utm_source=feed(&|#|$)", ("utm", "source", "feed"), PATTERN_RULE),
    Rule("late-page", "block", "[?&]page=[0-9]+&ref=", ("page", "ref"), PATTERN_RULE),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = "(?s)^.*?://([^/?#]*)"
PATH = "(?s)^.*?://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct runs of ASCII letters and digits, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.translate(url, _UPPER, _LOWER), F.lit("[a-z0-9]+"), 0))


def rule_index(rules: DataFrame, url_tokens: DataFrame, small: bool) -> DataFrame:
    """Rules with the token that they are filed under: the rarest of theirs in
    ``url_tokens`` (one row per URL and token); null if a rule has none."""
    filed = rules.select("name", F.explode_outer("tokens").alias("token"))
    wanted = filed.select("token").distinct()
    df = (url_tokens.join(F.broadcast(wanted) if small else wanted, "token")
          .groupBy("token").agg(F.count(F.lit(1)).alias("df")))
    rarest = (filed.join(df, "token", "left").groupBy("name")
              .agg(F.min_by("token", F.struct(F.coalesce("df", F.lit(0)), "token")).alias("token")))
    return rules.drop("tokens").join(rarest, "name")


def judge(pages: DataFrame, rules: list[Rule] | DataFrame = tuple(HOST_RULES + PATTERN_RULES),
          max_broadcast: int = MAX_BROADCAST_RULES) -> DataFrame:
    """page_id, host, path, rule (host rule that fits, else null), verdict,
    pattern (pattern rule that decided, else null).

    ``rules``: ``Rule`` objects, or a table of their fields with unique names."""
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.name, r.verdict, r.pattern, list(r.tokens), r.kind) for r in rules],
                                      "name string, verdict string, pattern string, tokens array<string>, kind int")
    small = rules.count() <= max_broadcast
    urls = pages.select("url").where("url is not null").select(
        "url", tokens(F.col("url")).alias("ts"), F.concat(host(F.col("url")), path(F.col("url"))).alias("place"))
    exploded = urls.select("url", "place", F.explode("ts").alias("token"))
    index = materialize(rule_index(rules, exploded, small), "rule-index")
    near = F.broadcast if small else (lambda x: x)
    fetched = exploded.join(near(index.where("token is not null")), "token")
    always = index.where("token is null").select("verdict", "pattern", "kind", "name")
    if not always.isEmpty():
        # Few by nature: a pattern without one literal token is tried on every URL.
        each = always.agg(F.collect_list(F.struct("verdict", "pattern", "kind", "name")).alias("rs"))
        spread = urls.join(F.broadcast(each)).select("url", "place", F.explode("rs").alias("r")).select("url", "place", "r.*")
        fetched = fetched.select(*spread.columns).unionByName(spread)
    where = F.when(F.col("kind") == HOST_RULE, F.col("place")).otherwise(F.col("url"))
    best = (fetched.where(F.regexp(where, F.col("pattern")))
            .groupBy(F.col("url").alias("u"))
            .agg(F.min(F.struct((-F.col("kind")).alias("k"), (-F.length("name")).alias("l"), "name", "verdict")).alias("b")))
    out = pages.select("page_id", "url").join(best, F.col("url") == F.col("u"), "left")
    by_host = F.col("b.k") == -HOST_RULE
    fetchable = F.coalesce(F.col("url").contains("://"), F.lit(False))
    return out.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
                      F.when(by_host, F.col("b.name")).alias("rule"),
                      F.when(~fetchable, "block").otherwise(F.coalesce("b.verdict", F.lit("allow"))).alias("verdict"),
                      F.when(~by_host, F.col("b.name")).alias("pattern"))
