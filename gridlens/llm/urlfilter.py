"""URL filtering by pattern rules that are indexed by their rarest literal token.

The literal tokens (runs of letters and digits) that a rule's regular expression cannot match
without are read off the expression itself, which is made of plain text and a few joints that
no token reaches across.  Token counts over all URLs pick each rule's rarest one; the tokens
of a URL fetch the rules filed under them, and only those rules' expressions run.  Built-in
functions throughout.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import staged

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_TOKEN = "[^a-z0-9]+"


#: What an expression may hold besides plain text: any case, subdomains, and what parts words.
ANY_CASE, SUBDOMAINS, BEFORE, BETWEEN, AFTER = "(?i)", r"^([^/]*\.)?", "(^|[^a-z0-9])", "[^a-z0-9]+", "([^a-z0-9]|$)"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host + path; ``exact`` rules override the others, the longest name first.

    A pattern of anything but plain text (escaped) and joints, without a token, or whose first or last token
    could go on in a URL would be missed by the index: ValueError.
    """

    name: str
    verdict: str
    pattern: str
    exact: bool

    def __post_init__(self) -> None:
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"rule {self.name!r}: the verdict is allow or block")
        if not self.literals:
            raise ValueError(f"rule {self.name!r} has no literal token to be found by")

    @property
    def literals(self) -> list[str]:
        """The tokens that every URL holds which the pattern fits."""
        text = self.pattern
        for joint in (ANY_CASE, SUBDOMAINS, BEFORE, BETWEEN, AFTER):
            text = text.replace(joint, " ")
        if re.search(r"\\[A-Za-z0-9]|[][(){}*+?|^$.]", re.sub(r"\\[^A-Za-z0-9]", "", text)):
            raise ValueError(f"rule {self.name!r}: only plain text and the joints can be indexed")
        text = re.sub(r"\\(.)", r"\1", text).lower()
        if re.search(r"^[a-z0-9]|[a-z0-9]$", text):
            raise ValueError(f"rule {self.name!r}: its first and last token must be whole")
        return [t for t in re.split(NOT_TOKEN, text) if t]


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, its subdomains and the paths that start with ``path`` (given with its closing slash)."""
    if not path.endswith("/"):
        raise ValueError("a rule's path ends with a slash, so that its last token is whole")
    return Rule(f"{host}{path}", verdict, SUBDOMAINS + re.escape(host + path), True)


def word_rule(words: str) -> Rule:
    """A block rule for words that stand in a row anywhere in host or path, joined by anything but letters and digits."""
    return Rule(words, "block", ANY_CASE + BEFORE + BETWEEN.join(re.escape(w) for w in words.split()) + AFTER, False)


HOST_RULES = [host_rule("block", "net", "/"), host_rule("allow", "example.net", "/en/"),
              host_rule("block", "example.com", "/de/"), host_rule("allow", "org", "/fr/")]
#: Words of hosts and paths that are never wanted in a text corpus.
WORD_RULES = [word_rule(w) for w in (
    "spam farm", "spam", "cheap pills", "pills", "viagra", "casino", "poker", "betting", "payday loan", "porn", "xxx",
    "escort", "warez", "torrent", "crack serial", "replica watches", "free download now", "click here")]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host follows the first ``://``, A-Z lower-cased; both empty without one or for null."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, SMALL), F.regexp_extract(text, pattern, 2)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.split(F.translate(text, UPPER, SMALL), NOT_TOKEN))


def filter_urls(pages: DataFrame, rules: list[Rule], *, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``pages``.

    ``rule`` is the longest exact rule that fits (null if none) and gives the verdict;
    otherwise the verdict is block if a pattern rule fits, else allow.  Null urls and
    urls without ``://`` have an empty host and path and are allowed.  Rows are judged
    one by one, whatever keys they repeat or lack; other columns are not read.
    """
    spark = pages.sparkSession
    host, path = split_url(F.col(f"`{url}`"))
    urls = staged(pages.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{key}`").alias(key),
                               host.alias("host"), path.alias("path")), "urls")
    seen = urls.select("uid", F.concat("host", "path").alias("where")).where("`where` <> ''")
    tokens = seen.select("uid", "where", F.explode(_tokens(F.col("where"))).alias("token"))
    listed = spark.createDataFrame(
        [(i, t, r.name, r.verdict, r.pattern, r.exact) for i, r in enumerate(rules) for t in r.literals],
        "rule_id int, token string, name string, verdict string, pattern string, exact boolean")
    counts = tokens.join(listed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count("*").alias("n"))
    index = listed.join(counts, "token", "left").groupBy("rule_id", "name", "verdict", "pattern", "exact").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    fits = tokens.join(index, "token").where(F.expr("`where` rlike pattern"))
    best = fits.groupBy("uid").agg(
        F.max(F.when(F.col("exact"), F.struct(F.length("name"), "name", "verdict"))).alias("exact"),
        F.bool_or(~F.col("exact") & (F.col("verdict") == "block")).alias("blocked"))
    return urls.join(best, "uid", "left").select(
        key, "host", "path", F.col("exact.name").alias("rule"),
        F.coalesce("exact.verdict", F.when(F.coalesce("blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def sql_twin() -> str:
    split = "regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', {})"
    exact = ", ".join(
        f"CASE WHEN regexp_matches(spot, '{r.pattern}') THEN {{'size': {len(r.name)}, 'name': '{r.name}', 'verdict': '{r.verdict}'}} END"
        for r in rules_of(True))
    words = " OR ".join(f"regexp_matches(spot, '{r.pattern}')" for r in rules_of(False))
    return f"""
WITH parts AS (SELECT page_id, translate({split.format(1)}, '{UPPER}', '{SMALL}') AS host, {split.format(2)} AS path FROM pages),
spots AS (SELECT *, host || path AS spot FROM parts),
judged AS (SELECT *, list_max([{exact}]) AS best, ({words}) AS listed FROM spots)
SELECT page_id, host, path, best.name AS rule,
       coalesce(best.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict FROM judged
"""


def rules_of(exact: bool) -> list[Rule]:
    return HOST_RULES if exact else WORD_RULES
