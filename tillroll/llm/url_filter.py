"""URL filters: every rule is filed under the rarest literal token it needs, the tokens of a
URL fetch their rules, and only those run their regular expressions. Spark SQL functions
only; two scans of the URL column, no shuffle of URLs."""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = re.compile("[a-z0-9]+")
_BUCKET = "array<array<struct<token:string,regex:string,site:boolean,size:int,allow:boolean,name:string>>>"


def lowered(text: str) -> str:
    """A-Z in lower case, nothing else."""
    return text.translate(str.maketrans(_UPPER, _LOWER))


@dataclass(frozen=True)
class Rule:
    """``site``: ``text`` is a host, at once followed by the start of a path (``net/``,
    ``example.net/en/``); it fits that host and its subdomains. Otherwise ``text`` is a
    pattern over host, path and query in lower case: ``*`` stands for any characters, ``^``
    for one that is neither letter nor digit, or for either end."""

    action: str  # allow or block
    text: str
    site: bool = False

    def regex(self) -> str:
        if self.site:
            host, slash, path = self.text.partition("/")
            end = "" if slash else r"(?:[/?#]|\z)"
            return rf"^(?:[^/?#]*\.)?{re.escape(lowered(host))}{re.escape(slash + path)}{end}"
        text, parts = lowered(self.text), []
        for at, char in enumerate(text):
            if char == "*":
                parts.append(".*")
            elif char != "^":
                parts.append(re.escape(char))
            elif at == 0:
                parts.append("(?:^|[^a-z0-9])")
            elif at == len(text) - 1:
                parts.append(r"(?:[^a-z0-9]|\z)")
            else:
                parts.append("[^a-z0-9]")
        return "(?s)" + "".join(parts)

    def tokens(self) -> list[str]:
        """The runs of a-z and 0-9 that stand alone in every URL the rule fits."""
        text = lowered(self.text)
        ends = "/" not in text if self.site else False
        found = []
        for run in _RUN.finditer(text):
            before = text[run.start() - 1] if run.start() else ("." if self.site else "*")
            after = text[run.end()] if run.end() < len(text) else ("/" if ends else "*")
            if before != "*" and after != "*":
                found.append(run.group())
        return sorted(set(found))


#: Unwanted kinds of sites and pages, and the wanted ones that look alike.
PATTERNS = tuple(
    Rule(action, f"^{words}^")
    for action, listed in (
        (
            "block",
            "casino poker betting bets jackpot slots porn xxx adult escort camgirls "
            "spam phishing malware ads adserver doubleclick track tracker popunder "
            "pills viagra replica warez torrent keygen login signup wp-admin cgi-bin",
        ),
        ("allow", "adult-education adult-learning spam-filter track-and-field"),
    )
    for words in (words.replace("-", "^") for words in listed.split())
)


def _tokens(low: Column) -> Column:
    return F.array_distinct(F.filter(F.split(low, "[^a-z0-9]+", -1), lambda t: t != ""))


def _folded(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _addresses(pages: DataFrame, url: str) -> DataFrame:
    """Adds ``__address`` (what follows ``://``, host in lower case), ``__host``, ``__path``."""
    whole = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.contains(whole, F.lit("://")), F.regexp_replace(whole, r"(?s)^.*?://", ""))
    pages = pages.withColumn("__rest", F.coalesce(rest, F.lit("")))
    host = F.regexp_extract("__rest", "^[^/?#]*", 0)
    pages = pages.withColumn("__host", _folded(host))
    tail = F.substring("__rest", F.length("__host") + 1, F.length("__rest"))
    pages = pages.withColumn("__path", F.regexp_extract(tail, "^[^?#]*", 0))
    return pages.withColumn("__address", F.concat("__host", tail))


def _index(rules: Sequence[Rule], seen: dict[str, int]) -> tuple[Column, int]:
    """The rules as a hash table of buckets, each rule under its rarest token (of equally
    rare ones the longest, then the least); rules without a token are under ''."""
    size = max(len(rules), 1)
    buckets: dict[int, list[dict]] = defaultdict(list)
    for rule in rules:
        token = min(rule.tokens(), key=lambda t: (seen.get(t, 0), -len(t), t), default="")
        entry = {"token": token, "regex": rule.regex(), "site": rule.site, "size": len(rule.text)}
        entry |= {"allow": rule.action == "allow", "name": rule.text}
        buckets[zlib.crc32(token.encode()) % size].append(entry)
    table = json.dumps([buckets[k] for k in range(size)])
    return F.from_json(F.lit(table), _BUCKET), size


def token_counts(pages: DataFrame, url: str, tokens: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each of ``tokens``: at most one row per token reaches the driver."""
    if not tokens:
        return {}
    known = F.from_json(F.lit(json.dumps(sorted(tokens))), "array<string>")
    held = _addresses(pages.select(url), url).select(
        F.explode(F.array_intersect(_tokens(_folded(F.col("__address"))), known)).alias("token")
    )
    return {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (the site rule
    that decides), ``pattern`` (the pattern that decides where no site rule fits) and
    ``verdict`` (allow or block).

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; the path goes from there up to ``?``, ``#`` or the end, as it is written.
    Among the fitting site rules the longest decides, else among the fitting patterns the
    longest; of equally long ones allow goes before block, then the greater text. A URL that
    no rule fits is allowed.

    A null or empty URL, or one without ``://``, has an empty host and path and is allowed.
    Ids may be null or repeat; every row is judged alone, and long URLs whole. Other columns,
    whatever their names, are not read. Without rules all is allowed.

    The list of rules is the caller's and travels with every task, some 200 bytes a rule.
    What a URL costs does not grow with it: each of its tokens is one look into the table.
    """
    rules = list(dict.fromkeys(rules))
    seen = token_counts(pages, url, sorted({t for rule in rules for t in rule.tokens()}))
    table, size = _index(rules, seen)
    df = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("__url"))
    df = _addresses(df, "__url")
    df = df.withColumn("__low", _folded(F.col("__address")))
    df = df.withColumn("__tokens", F.array_append(_tokens(F.col("__low")), F.lit("")))
    bucket = lambda t: F.get(table, F.pmod(F.crc32(t), F.lit(size)).cast("int"))
    fetched = F.flatten(
        F.transform("__tokens", lambda t: F.filter(bucket(t), lambda r: r["token"] == t))
    )
    df = df.withColumn("__rules", fetched)
    where = lambda r: F.when(r["site"], F.col("__address")).otherwise(F.col("__low"))
    fits = F.filter("__rules", lambda r: F.rlike(where(r), r["regex"]))
    ranked = F.transform(fits, lambda r: F.struct(r["site"], r["size"], r["allow"], r["name"]))
    df = df.withColumn("__best", F.array_max(ranked))
    best = F.col("__best")
    return df.select(
        "page_id",
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.when(best["site"], best["name"]).alias("rule"),
        F.when(~best["site"], best["name"]).alias("pattern"),
        F.when(F.coalesce(best["allow"], F.lit(True)), "allow").otherwise("block").alias("verdict"),
    )
