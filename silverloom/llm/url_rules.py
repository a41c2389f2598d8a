"""URL filter: many pattern rules, each found by its rarest literal token.

A rule is a regular expression with the literal tokens every URL it fits must contain. The rule is filed under the one of
them that fewest URLs hold; a URL's tokens fetch its candidate rules, and only those run.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000  # rules shared with every task; more have to be split over several calls

_token = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``rank`` settles which of several fitting rules decides: the greatest, then the first by name."""

    name: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    rank: int = 0


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains where the path starts with ``path``; the longer rule ranks higher. Paths are as
    they stand, hosts in lower case. Tokens of the path count up to the last sign that ends one."""
    whole = re.sub(r"[A-Za-z0-9]+$", "", path)
    tokens = _token.findall(host) + _token.findall(whole.lower())
    return Rule(host + path, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", verdict, tuple(tokens), 1000 + len(host + path))


def word_rule(verdict: str, word: str) -> Rule:
    """Fits where the word stands as a token of the host."""
    return Rule(word, rf"^(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?![a-z0-9])", verdict, (word,))


#: The rules asked for, and words of hosts that are blocked.
SITE_RULES = (
    site_rule("allow", "org", "/"), site_rule("block", "example.org", "/es/"), site_rule("block", "example.org", "/en/1"),
    site_rule("allow", "com", "/fr/"), site_rule("block", "com", "/de/"),
)
BLOCKED_WORDS = (
    "adult", "bet", "bets", "betting", "casino", "gambling", "malware", "phishing", "pills", "poker", "porn", "sex", "spam",
    "torrent", "viagra", "warez", "xxx", "ads", "track", "tracker",
)
RULES = SITE_RULES + tuple(word_rule("block", w) for w in BLOCKED_WORDS)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lowered. Path: from there up to ``? #`` or the end.
    Null urls and those without ``://`` have empty ones."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url")))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)


def token_counts(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many rows of (host, path) hold each token that a rule has. The tokens of other words are dropped before they are
    counted, so the result is bounded by the rules."""
    wanted = urls.sparkSession.createDataFrame([(t,) for t in sorted({t for r in rules for t in r.tokens})] or [("",)], "token string")
    held = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(F.concat("host", F.lit(" "), "path")), F.lit("([a-z0-9]+)"), F.lit(1)))).alias("token"))
    return {r["token"]: r["count"] for r in held.join(F.broadcast(wanted), "token").groupBy("token").count().collect()}


class Index:
    """Rules by their rarest token."""

    def __init__(self, rules: tuple[Rule, ...], counts: dict[str, int]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")
        self._by_token = defaultdict(list)
        for rule in rules:
            if not rule.tokens:
                raise ValueError(f"rule {rule.name} has no literal token")
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            self._by_token[rarest].append((-rule.rank, rule.name, re.compile(rule.pattern), rule.verdict))

    def __call__(self, host: str, path: str) -> tuple[str, str] | None:
        """(name, verdict) of the deciding rule."""
        found = None
        for token in set(_token.findall(f"{host} {path.lower()}")) & self._by_token.keys():
            for rank, name, pattern, verdict in self._by_token[token]:
                if (found is None or (rank, name) < found[:2]) and pattern.match(host + path):
                    found = rank, name, verdict
        return found and found[1:]


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """(page_id, host, path, fits, verdict) of every row; ``fits`` names the deciding rule, null where none fits and the
    default holds. Repeated rows stay as they are."""
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = host_and_path(F.col("url"))
    split = urls.select("page_id", host.alias("host"), path.alias("path"))
    shared = split.sparkSession.sparkContext.broadcast((rules, token_counts(split, rules)))

    @F.pandas_udf("fits string, verdict string")
    def decided(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = Index(*shared.value)
        for hosts, paths in batches:
            yield pd.DataFrame([index(h, p) or (None, default) for h, p in zip(hosts, paths)], columns=["fits", "verdict"])

    return split.withColumn("_j", decided("host", "path")).select("page_id", "host", "path", "_j.fits", "_j.verdict")
