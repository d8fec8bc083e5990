"""URL rules found by their rarest literal token.

A rule is a regular expression with literal tokens that every address it fits
must hold. The index keeps it under the token that is rarest among all
addresses; the tokens of an address fetch the rules to try, and only those run.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm import words as W

TOKEN = "[A-Za-z0-9]+"
_A_Z, _a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``tokens`` are whole tokens of every address (host and path) that ``pattern`` fits at its start."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...] = ()
    rank: int = 0


def place_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits a host, its subdomains, and paths that begin with ``path``. The longest such rule wins."""
    closed = path if re.search("[^A-Za-z0-9]$", path) else re.sub("[A-Za-z0-9]+$", "", path)
    tokens = re.findall(TOKEN, host) if path[:1] == "/" else re.findall(TOKEN, host)[:-1]
    return Rule(
        host + path, verdict, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}",
        tuple(dict.fromkeys(tokens + re.findall(TOKEN, closed))), len(host + path),
    )


def word_rule(verdict: str, word: str) -> Rule:
    """Fits addresses that hold a word as a whole token."""
    return Rule(f"word:{word}", verdict, rf"(?s:.*?)(?<![A-Za-z0-9]){re.escape(word)}(?![A-Za-z0-9])", (word,))


#: Rules of the method, for addresses that no other rule fits.
GENERAL = (
    *(word_rule("block", w) for w in ("casino", "poker", "porn", "xxx", "viagra", "torrent", "warez")),
    Rule("download", "block", r"(?s:.*)/download/(?s:.*)\.(?:exe|msi|apk|zip|rar|iso)\Z", ("download",)),
    Rule("number host", "block", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+(?::[0-9]+)?(?:/|\Z)"),
)


def split_url(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty without ``://``."""
    rest = F.expr(f"substring({url}, instr({url}, '://') + 3)")
    found = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.when(found, F.regexp_extract(rest, r"^[^/?#]*", 0)).otherwise(F.lit(""))
    path = F.when(found, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))
    return F.translate(host, _A_Z, _a_z), path


def token_counts(addresses: DataFrame, address: str, rules: Iterable[Rule]) -> dict[str, int]:
    """How many addresses hold each token of the rules; a number per token of a rule is all that is collected."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    found = addresses.select(F.explode(F.array_distinct(F.regexp_extract_all(F.col(address), F.lit(f"({TOKEN})"), F.lit(1)))).alias("token"))
    counted = found.filter(F.col("token").isin(wanted)).groupBy("token").count()
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in counted.collect()}


class RuleIndex:
    """Rules by their rarest token; those without one are always tried."""

    def __init__(self, rules: tuple[Rule, ...], counts: dict[str, int]):
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        self.rules = [(r, re.compile(r.pattern)) for r in rules]
        for i, r in enumerate(rules):
            if r.tokens:
                self.by_token.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
            else:
                self.always.append(i)

    def best(self, address: str) -> Rule | None:
        """The fitting rule of highest rank, then the first one."""
        tried = set(self.always)
        for token in set(re.findall(TOKEN, address)):
            tried.update(self.by_token.get(token, ()))
        fits = [i for i in tried if self.rules[i][1].match(address)]
        return self.rules[min(fits, key=lambda i: (-self.rules[i][0].rank, i))][0] if fits else None


@lru_cache(maxsize=8)
def _index(rules: tuple[Rule, ...], counts: tuple[tuple[str, int], ...]) -> RuleIndex:
    return RuleIndex(rules, dict(counts))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...], url: str = "url", general: tuple[Rule, ...] = GENERAL) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to each row, without a shuffle of the pages.

    The rule is the best of ``rules``, or null; the verdict is its own, else
    that of the best general rule, else "block" without a host and "allow"
    with one. Rules are a list the caller holds; they go to every task.
    Null and empty addresses have an empty host. Columns named like a result
    are replaced.
    """
    made = ("host", "path", "rule", "verdict")
    host, path = split_url(url)
    kept = [c for c in pages.columns if c.lower() not in made or c == url]
    own_host, own_path, address = (W.private(pages.columns) + c for c in ("host", "path", "address"))
    split = pages.select(*kept, host.alias(own_host), path.alias(own_path)).withColumn(address, F.concat(own_host, own_path))
    counts = tuple(sorted(token_counts(split, address, [*rules, *general]).items()))

    def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
        own, other = _index(rules, counts), _index(general, counts)
        known: dict[str, tuple[str | None, str]] = {}
        for a in set(batch.column(address).to_pylist()):
            rule = own.best(a)
            known[a] = (rule.name, rule.verdict) if rule else (None, (other.best(a) or Rule("", "allow", "")).verdict)
        out = [known[a] for a in batch.column(address).to_pylist()]
        hosts = batch.column(own_host).to_pylist()
        verdicts = [v if h or r else "block" for (r, v), h in zip(out, hosts, strict=True)]
        return [batch.column(own_host), batch.column(own_path), pa.array([r for r, _ in out], pa.string()), pa.array(verdicts, pa.string())]

    fields = [T.StructField(c, T.StringType(), True) for c in made]
    return W.map_texts(split, address, fields, kernel, drop=(own_host, own_path, address))
