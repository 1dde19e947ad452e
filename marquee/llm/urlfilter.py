"""URL filter: pattern rules indexed by their rarest literal token.

A rule is text such as ``example.net/en/`` (a host with its subdomains, then a path prefix)
or a pattern with ``*`` (any characters) and ``^`` (a separator or the end).  Every rule has
literal tokens (runs of letters and digits that must occur whole in a matching URL); the one
that is rarest among the URLs indexes it.  The tokens of a URL fetch its candidate rules, and
only their regular expressions run.  Everything is DataFrame expressions: no Python on the
executors, no shuffle of the URLs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``kind``: ``host`` (host and path prefix, case of the path matters; wins over every
    pattern, the longest first) or ``pattern`` (lower-cased URL without its scheme)."""
    verdict: str
    text: str
    kind: str = "host"

    def regex(self) -> str:
        if self.kind == "host":
            return r"^([^/]*\.)?" + _quoted(self.text)
        out = "".join({"*": ".*", "^": "([^a-z0-9_.%-]|$)"}.get(p) or _quoted(p)
                      for p in re.split(r"([*^])", self.text.removeprefix("|")) if p)
        return ("^" if self.text.startswith("|") else "") + out

    def tokens(self) -> list[str]:
        """Literal tokens that any matching URL holds whole: bounded by a literal separator,
        ``^`` or an anchored start (a host rule's start is one: a subdomain ends in a dot)."""
        text = self.text.lower() if self.kind == "host" else self.text.removeprefix("|")
        anchored = self.kind == "host" or self.text.startswith("|")
        return [m.group() for m in re.finditer("[a-z0-9]+", text)
                if (text[m.start() - 1] != "*" if m.start() else anchored) and m.end() < len(text) and text[m.end()] != "*"]


def _quoted(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", s)


# The given host and path rules.
HOST_RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)
# Pattern rules for pages that hold no usable article: adult, betting and spam hosts, adverts, accounts, shops, listings, files.
PATTERN_RULES = tuple(Rule("block", t, "pattern") for t in (
    ".adult-", "|adult-", ".adult.", ".porn.", ".casino.", ".casino-", "|casino-", "-casino.", "-bets.", ".bets.", "-pills.", ".pills.", "-farm.", ".spam-", "|spam-", ".ads-", "|ads-", "|ads.", "|adserver.", "|tracker.", "/adserver/", "/doubleclick/", "/banners/", "/popup/",
    "/login^", "/signin^", "/signup^", "/register^", "/logout^", "/account/", "/wp-login.",
    "/cart^", "/checkout^", "/basket^", "/wishlist^", "/search?", "/tag/", "/tags/", "/feed^",
    "/print^", "?sessionid=", "&sessionid=", ".jpg^", ".jpeg^", ".png^", ".gif^", ".pdf^", ".zip^", ".exe^", ".mp4^",
))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty
    for NULL or without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(url, UPPER, LOWER), F.lit("([a-z0-9]+)"), F.lit(1)))


def rarest_tokens(urls: DataFrame, url: str, rules: Sequence[Rule]) -> dict[int, str | None]:
    """For each rule (by position) its token that the fewest URLs hold, ``None`` without one.
    One aggregate over all URLs; its result has at most a row per literal token of a rule."""
    words = sorted({t for r in rules for t in r.tokens()})
    counts = {r["t"]: r["n"] for r in
              urls.select(F.explode(F.filter(url_tokens(F.col(url)), lambda t: t.isin(words))).alias("t"))
                  .groupBy("t").agg(F.count("*").alias("n")).collect()}
    return {i: min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default=None) for i, r in enumerate(rules)}


def judge_urls(df: DataFrame, url: str = "url", rules: Sequence[Rule] = HOST_RULES + PATTERN_RULES,
               default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (text of the longest host rule that fits, else
    NULL) and ``verdict`` (that rule's; else ``block`` when a pattern rule matches; else
    ``default``).

    NULL, empty or scheme-less URLs have an empty host and path, match no host rule and get
    ``default``.  Repeated rows stay, each judged alone; other columns are carried, but one
    named like an output is replaced.  The rules are a bounded parameter written into the
    plan; the URLs are not shuffled.
    """
    rare = rarest_tokens(df, url, rules)
    entry = [F.struct(F.lit(i).alias("i"), F.lit(r.kind == "host").alias("host"), F.lit(r.regex()).alias("regex"),
                      F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")) for i, r in enumerate(rules)]
    index = {t: [i for i in rare if rare[i] == t] for t in sorted({t for t in rare.values() if t})}
    always = F.array(*[entry[i] for i in rare if rare[i] is None]) if None in rare.values() else None
    lookup = F.create_map(*[x for t, ids in index.items() for x in (F.lit(t), F.array(*[entry[i] for i in ids]))])
    fetched = F.flatten(F.transform(F.filter(url_tokens(_rest(F.col(url))), lambda t: t.isin(*index)),
                                    lambda t: F.element_at(lookup, t)))
    fetched = F.concat(fetched, always) if always is not None else fetched
    names = ("host", "path", "rule", "verdict", "__fits")
    out = df.select(*[F.col(c) for c in df.columns if c not in names or c == url],
                    host_of(F.col(url)).alias("__host"), path_of(F.col(url)).alias("__path"))
    whole = F.concat("__host", "__path")
    rest = F.translate(_rest(F.col(url)), UPPER, LOWER)
    fits = F.filter(fetched, lambda r: F.when(r["host"], F.rlike(whole, r["regex"])).otherwise(F.rlike(rest, r["regex"])))
    out = out.withColumn("__fits", fits)
    best = F.try_element_at(F.array_sort(
        F.filter("__fits", lambda r: r["host"]),
        lambda a, b: F.when(F.length(a["text"]) != F.length(b["text"]), F.length(b["text"]) - F.length(a["text"]))
        .otherwise(a["i"] - b["i"])), F.lit(1))
    pattern = F.try_element_at(F.filter("__fits", lambda r: ~r["host"]), F.lit(1))
    keep = [c for c in df.columns if c not in names]
    return out.withColumn("__best", best).select(
        *keep, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__best.text").alias("rule"),
        F.coalesce(F.col("__best.verdict"), pattern["verdict"], F.lit(default)).alias("verdict"))
