"""URL filters: a cascade of Bloom filters that answers exactly for every key of the corpus, without a join.

A rule is a host and a path prefix; its key is host + path. The key universe of the corpus is every
(host suffix at a dot, path prefix) of every URL, with the path lengths that rules have. Level 1 holds
the listed keys; level 2 the universe's keys that level 1 wrongly holds; level 3 the listed keys that
level 2 holds; and so on until a level errs nowhere. A key is listed if the first level that does not
hold it is an even one.

Level 1 is sized from the (estimated) size of the universe so that the false positives expected are
fewer than the listed keys; only those come to the driver. Their number is checked and the level drawn
again, larger and under another seed, if it is above ``FALSE_LIMIT`` times the list, so what is broadcast is
bounded by the list and the logarithm of the universe.

Cases: NULL url or one without ``://`` has empty host and path and fits no rule; of two fitting rules of
equal length the one with the longer host wins; a key listed both ways blocks; repeated rows are judged
one by one; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FALSE_LIMIT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


class Bloom:
    """Bits of the given keys; ``rate`` is the share of other keys that it wrongly holds."""

    def __init__(self, keys: Sequence[str], rate: float, seed: int):
        n = max(1, len(keys))
        self.size = max(8, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        self.hashes = max(1, round(self.size / n * math.log(2)))
        self.seed, bits = seed, bytearray((self.size + 7) // 8)
        for key in keys:
            for p in self._places(key):
                bits[p >> 3] |= 1 << (p & 7)
        self.bits = bytes(bits)

    def _places(self, key: str):
        # A hash for each bit: in filters this small, steps of one hash would often meet again.
        data = key.encode()
        return (xxhash.xxh3_64_intdigest(data, (self.seed << 8) + i) % self.size for i in range(self.hashes))

    def __contains__(self, key: str) -> bool:
        return all(self.bits[p >> 3] >> (p & 7) & 1 for p in self._places(key))


@dataclass
class Cascade:
    levels: list[Bloom] = field(default_factory=list)

    def __contains__(self, key: str) -> bool:
        for n, level in enumerate(self.levels):
            if key not in level:
                return n % 2 == 1
        return len(self.levels) % 2 == 1


def url_host(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def candidates(host: str, path: str, lengths: Sequence[int]) -> list[tuple[str, str]]:
    """(host suffix, path prefix) that a rule may have, the longest key first."""
    hosts, at = [host], host.find(".")
    while at >= 0:
        hosts.append(host[at + 1:])
        at = host.find(".", at + 1)
    found = [(h, path[:n]) for h in hosts for n in lengths if n <= len(path)]
    return sorted(found, key=lambda c: (-len(c[0]) - len(c[1]), -len(c[0])))


def build_cascade(urls: DataFrame, listed: Iterable[str], lengths: Sequence[int], universe_size: int, seed: int = 1) -> Cascade:
    """``urls`` has (host, path). Exact for every candidate key of its rows."""
    listed = sorted(set(listed))
    if not listed:
        return Cascade()
    rate = min(0.5, math.sqrt(0.5) * len(listed) / max(1, universe_size))
    limit = FALSE_LIMIT * len(listed) + 16
    schema = pa.schema([("key", pa.string())])
    for attempt in range(32):
        first, known = Bloom(listed, rate / 2**attempt, seed + 1000 * attempt), frozenset(listed)

        def wrong(batches, first=first, known=known):
            for b in batches:
                found = set()
                for host, path in zip(b["host"].to_pylist(), b["path"].to_pylist()):
                    found.update(k for k in (h + p for h, p in candidates(host, path, lengths)) if k not in known and k in first)
                yield pa.record_batch([pa.array(sorted(found), pa.string())], schema=schema)

        rows = urls.mapInArrow(wrong, "key string").distinct().limit(limit + 1).collect()
        if len(rows) <= limit:
            break
    else:
        raise RuntimeError(f"level 1 held more than {limit} false keys under every seed")
    levels, inside, outside, seed = [first], listed, sorted(r["key"] for r in rows), first.seed
    while outside:
        seed += 1
        levels.append(Bloom(outside, 0.5, seed))
        inside, outside = outside, [k for k in inside if k in levels[-1]]
    return Cascade(levels)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], otherwise: str = "allow") -> DataFrame:
    """Per row: page_id, host, path, rule (key of the longest fitting one, or NULL), verdict."""
    rules = list(rules)
    lengths = sorted({len(r.path) for r in rules})
    urls = pages.select("page_id", url_host("url").alias("host"), url_path("url").alias("path"))
    estimate = urls.agg(F.approx_count_distinct(F.struct("host", "path"))).first()[0]
    suffixes = urls.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    universe = estimate * suffixes * max(1, len(lengths))
    cascades = {
        verdict: build_cascade(urls.select("host", "path"), [r.key for r in rules if r.verdict == verdict], lengths, universe, seed)
        for seed, verdict in enumerate(sorted({r.verdict for r in rules}, reverse=True), 1)
    }
    order = sorted(cascades, key=lambda v: v != "block")
    out = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])

    def decide(batches):
        for b in batches:
            rule, verdict = [], []
            for host, path in zip(b["host"].to_pylist(), b["path"].to_pylist()):
                hit = next(((h + p, v) for h, p in candidates(host, path, lengths) for v in order if h + p in cascades[v]), (None, otherwise))
                rule.append(hit[0])
                verdict.append(hit[1])
            yield pa.record_batch([b["page_id"].cast(pa.int64()), b["host"].cast(pa.string()), b["path"].cast(pa.string()),
                                   pa.array(rule, pa.string()), pa.array(verdict, pa.string())], schema=out)

    return urls.mapInArrow(decide, "page_id long, host string, path string, rule string, verdict string")
