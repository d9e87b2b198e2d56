"""URL verdicts from host rules and a weighted vocabulary of URL terms.

``judge_urls`` first looks for a host and path rule; the longest that fits
decides. Otherwise an Aho-Corasick automaton finds vocabulary terms in host and
path. A hit counts only between boundaries (no letter or digit right before or
after it). One strict hit, or ``soft_needed`` different soft hits, block.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is allowed; repeated rows are judged alike; an empty table gives an empty
result; columns of the input that are not named are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRICT_TERMS = (
    "porn", "xxx", "casino", "casino-win", "free-bets", "cheap-pills", "viagra", "warez", "torrent", "escort",
)
SOFT_TERMS = ("adult", "bet", "bets", "betting", "pills", "cheap", "free", "win", "loan", "hack", "crack", "dating")


@dataclass(frozen=True)
class UrlRules:
    """``rules``: (verdict, "host/path"), for the host and all its subdomains."""

    rules: tuple[tuple[str, str], ...] = ()
    strict: tuple[str, ...] = STRICT_TERMS
    soft: tuple[str, ...] = SOFT_TERMS
    soft_needed: int = 2
    by_host: dict = field(default_factory=dict, compare=False)

    def __post_init__(self):
        for verdict, rule in self.rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.lower(), []).append((len(rule), slash + path, rule, verdict))
        for found in self.by_host.values():
            found.sort(reverse=True)

    def rule_for(self, host: str, path: str) -> tuple[str | None, str | None]:
        best = (0, "", None, None)
        while host:
            fits = next((r for r in self.by_host.get(host, ()) if path.startswith(r[1])), best)
            best = max(best, fits, key=lambda r: r[0])
            host = host.partition(".")[2]
        return best[2], best[3]


def _automaton(rules: UrlRules) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in (("soft", rules.soft), ("strict", rules.strict)):
        for term in terms:
            found.add_word(term.lower(), (weight, term.lower()))
    if len(found):
        found.make_automaton()
    return found


def _hits(automaton, text: str) -> dict[str, set[str]]:
    hits = {"strict": set(), "soft": set()}
    if not len(automaton):
        return hits
    for last, (weight, term) in automaton.iter(text):
        before, after = last - len(term), last + 1
        if (before < 0 or not text[before].isalnum()) and (after == len(text) or not text[after].isalnum()):
            hits[weight].add(term)
    return hits


def judge_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: UrlRules = UrlRules()) -> DataFrame:
    """id, host, path, rule, verdict, strict_hits, soft_hits (different terms, sorted) for each row."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    # A-Z alone: other letters keep their case
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    known = df.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(rules)
        for frame in frames:
            out = []
            for h, p in zip(frame["host"], frame["path"]):
                rule, verdict = rules.rule_for(h, p)
                hits = _hits(automaton, (h + p).lower())
                bad = bool(hits["strict"]) or len(hits["soft"]) >= rules.soft_needed
                out.append((rule, verdict or ("block" if bad else "allow"), sorted(hits["strict"]), sorted(hits["soft"])))
            more = pd.DataFrame(out, columns=["rule", "verdict", "strict_hits", "soft_hits"], dtype=object)
            yield pd.concat([frame.reset_index(drop=True), more], axis=1)

    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]
    schema = f"id {kind}, host string, path string, rule string, verdict string, strict_hits array<string>, soft_hits array<string>"
    return known.mapInPandas(judge, schema).withColumnRenamed("id", id_col)
