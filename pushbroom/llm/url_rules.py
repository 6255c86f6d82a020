"""URL filter: rules indexed by their rarest literal token.

A rule is host + path, like ``example.org/es/``. It fits its host and every
subdomain where the URL's path starts with the rule's path; of the rules that fit,
the longest decides. Each rule is filed under the one of its whole tokens that the
corpus of URLs holds least often, so a URL's tokens fetch few candidate rules, and only
those run their regular expressions.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import bound_arrow

_TOKEN = "[0-9A-Za-z]+"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def pattern(self) -> re.Pattern:
        """Matches host + path of the URLs that the rule fits; no host holds a slash."""
        return re.compile(rf"(?:[^/]*\.)?{re.escape(self.host)}(?=/|$){re.escape(self.path)}")

    def tokens(self) -> list[str]:
        """Tokens that every fitting URL holds whole: the last is left out where the path could go on inside it."""
        found = re.findall(_TOKEN, self.text)
        return found[:-1] if self.path and re.search(f"{_TOKEN}$", self.path) else found


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host.lower(), slash + path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and where no ``://`` stands."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def index(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[int]]:
    """Rule numbers by rarest token; rules without a whole token are under the empty string, which every URL asks for."""
    filed = defaultdict(list)
    for n, r in enumerate(rules):
        filed[min(r.tokens(), key=lambda t: (counts.get(t, 0), t), default="")].append(n)
    return dict(filed)


def judge(urls: DataFrame, rules: list[Rule], column: str = "url", default: str = "allow", block: int = 200_000) -> DataFrame:
    """``urls`` with host, path, rule (text of the deciding rule, or null), verdict and tried (rules whose pattern ran).

    Where no rule fits, the verdict is ``default`` and rule is null. Of equally long
    rules that fit, the first listed decides. Columns of those names are replaced; all others stay. Null URLs
    have an empty host and path, which no rule with a path fits. Rules come from the caller's list; more than
    ``block`` of them are matched in several passes over the same rows, each holding one block in memory. URLs of any length are judged whole, rows that repeat
    are judged alike, and an empty table gives an empty result.
    """
    bound_arrow(urls.sparkSession)
    wanted = sorted({t for r in rules for t in r.tokens()})
    host, path = host_and_path(F.col(column).cast("string"))
    base = urls.withColumns({"host": host, "path": path})
    counts: dict[str, int] = {}
    for k in range(0, len(wanted), block):
        some = urls.sparkSession.createDataFrame([(t,) for t in wanted[k : k + block]], "token string")
        held = base.select(F.explode(F.array_distinct(F.regexp_extract_all(F.concat("host", "path"), F.lit(f"({_TOKEN})")))).alias("token"))
        counts |= dict(held.join(F.broadcast(some), "token").groupBy("token").count().collect())
    out = base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default), "tried": F.lit(0).cast("long")})
    for k in range(0, len(rules), block):
        found = _matcher(rules[k : k + block], index(rules[k : k + block], counts))("host", "path")
        out = out.withColumn("_m", found)
        better = F.col("_m.rule").isNotNull() & (F.col("rule").isNull() | (F.length("_m.rule") > F.length("rule")))
        out = out.withColumns({"verdict": F.when(better, F.col("_m.verdict")).otherwise(F.col("verdict")), "tried": F.col("tried") + F.col("_m.tried"), "rule": F.when(better, F.col("_m.rule")).otherwise(F.col("rule"))}).drop("_m")
    return out


def _matcher(rules: list[Rule], filed: dict[str, list[int]]):
    @F.pandas_udf("rule string, verdict string, tried long")
    def match(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        patterns, find = {}, re.compile(_TOKEN).findall
        always = filed.get("", [])
        for hosts, paths in parts:
            out = []
            for url in hosts + paths:
                tries = {n for t in set(find(url)) for n in filed.get(t, ())}.union(always)
                best = None
                for n in sorted(tries):
                    if n not in patterns:
                        patterns[n] = rules[n].pattern()
                    if patterns[n].match(url) and (best is None or len(rules[n].text) > len(best.text)):
                        best = rules[n]
                out.append((best and best.text, best and best.verdict, len(tries)))
            yield pd.DataFrame(out, columns=["rule", "verdict", "tried"])

    return match
