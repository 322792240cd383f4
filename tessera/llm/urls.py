"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression plus the literal tokens (``[a-z0-9]+``) that
any address it fits must contain as whole tokens.  The rule is indexed under
the one of these that the fewest addresses of the table contain; the tokens of
an address fetch its candidate rules by an equi-join, and only those run their
expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rules are broadcast; a rule set is a parameter, and larger ones are refused.
MAX_RULES = 50_000


@dataclass(frozen=True)
class HostRule:
    """``verdict`` for a host with its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        return rf"\A(?:[^/?#]*\.)?{_quoted(self.host)}{_quoted(self.path)}"

    @property
    def tokens(self) -> list[str]:
        # the last token of a path that ends inside a name need not be whole
        whole = self.path if not self.path or not self.path[-1].isalnum() else \
            re.sub(r"[a-z0-9]+\Z", "", self.path.lower())
        return re.findall(r"[a-z0-9]+", f"{self.host}{whole}".lower())


@dataclass(frozen=True)
class PatternRule:
    """``block`` for addresses (in lower case) that fit an expression; ``tokens``
    must stand in each of them as whole tokens (so not the last one of an
    expression that may end inside a token)."""

    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str = "block"


BASE_RULES = [
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
]

PATTERN_RULES = [
    PatternRule("login-form", r"/wp-login\.php", ("wp", "login")),
    PatternRule("script-login", r"/cgi-bin/login", ("cgi", "bin")),
    PatternRule("session-id", r"[?&;]phpsessid=[0-9a-z]+", ("phpsessid",)),
    PatternRule("redirect", r"[?&]redirect=https?://", ("redirect",)),
    PatternRule("casino", r"://([^/?#]*[.-])?online[.-]casino[.-]", ("online", "casino")),
    PatternRule("adult", r"[./-]xxx([./?#-]|$)", ("xxx",)),
    PatternRule("pills", r"[./-]viagra([./?#-]|$)", ("viagra",)),
    PatternRule("cart", r"/cart/(add|checkout)([/?#]|$)", ("cart",)),
]


def _quoted(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", s)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host in lower case (A-Z), both empty without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"\A[^?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def url_tokens(url: Column) -> Column:
    return F.array_remove(F.array_distinct(
        F.split(F.lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+")), "")


def rule_index(urls: DataFrame, rules: list[HostRule | PatternRule]) -> DataFrame:
    """(token, rule columns): each rule once, under its rarest literal token in
    ``urls`` (column ``_url``); ties go to the first token in the alphabet."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    if not rules or not all(r.tokens for r in rules):
        raise ValueError("rules are needed, each with at least one literal token")
    spark = urls.sparkSession
    table = spark.createDataFrame(
        [(i, isinstance(r, HostRule), r.name, r.regex, r.verdict, t)
         for i, r in enumerate(rules) for t in dict.fromkeys(r.tokens)],
        "rid int, is_host boolean, rule string, regex string, verdict string, token string")
    counts = (urls.select(F.explode(url_tokens(F.col("_url"))).alias("token"))
              .join(F.broadcast(table.select("token").distinct()), "token", "left_semi")
              .groupBy("token").agg(F.count("*").alias("n")))
    w = Window.partitionBy("rid").orderBy(F.coalesce("n", F.lit(0)), "token")
    return (table.join(counts, "token", "left").withColumn("k", F.row_number().over(w))
            .filter("k = 1").drop("k", "n"))


def judge_urls(df: DataFrame, url_col: str = "url", id_col: str = "page_id",
               host_rules: list[HostRule] = BASE_RULES,
               patterns: list[PatternRule] = PATTERN_RULES) -> DataFrame:
    """(``id_col``, host, path, rule, pattern, verdict), one row per row of ``df``.

    ``rule`` is the longest host rule that fits, ``pattern`` the first pattern
    rule in the order given (both null if none fits); the verdict is the host
    rule's, else the pattern's, else ``allow``.  A null or empty address, and
    one without ``://``, has an empty host and path and fits no host rule.
    Repeated rows are each judged; an empty table gives an empty result.  Other
    columns of ``df`` play no part.
    """
    urls = df.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    index = rule_index(urls, [*host_rules, *patterns])
    host, path = split_url(F.col("_url"))
    # one judgement per distinct address: repeated addresses meet before the rules
    fetched = (urls.filter(F.col("_url").isNotNull()).select("_url").distinct()
               .select("_url", F.explode(url_tokens(F.col("_url"))).alias("token"))
               .join(F.broadcast(index), "token"))
    target = F.when(F.col("is_host"), F.concat(host, path)).otherwise(F.lower("_url"))
    length = F.length("rule")
    best = (fetched.filter(F.rlike(target, F.col("regex")))
            .groupBy("_url").agg(
                F.max(F.when(F.col("is_host"), F.struct(length.alias("n"), "rule", "verdict")))
                .alias("h"),
                F.min(F.when(~F.col("is_host"), F.struct("rid", "rule", "verdict"))).alias("p"))
            .withColumnRenamed("_url", "_hit"))
    return (urls.join(best, F.col("_url") == F.col("_hit"), "left")
            .select(F.col("_id").alias(id_col), F.coalesce(host, F.lit("")).alias("host"),
                    F.coalesce(path, F.lit("")).alias("path"), F.col("h.rule").alias("rule"),
                    F.col("p.rule").alias("pattern"),
                    F.coalesce("h.verdict", "p.verdict", F.lit("allow")).alias("verdict")))
