"""SimHash near-duplicates by vantage-point trees over the fingerprints.

A pair within ``max_bits`` of 64 bits differs by at most max_bits / blocks bits, rounded down, in one of
``blocks`` equal parts of the fingerprint, and the Hamming distance on a part is a metric of its own. So
each part gets a tree, searched with the smaller radius: with 3 bits and 2 parts the radius is 1.

* The upper levels are grown from a sample of about ``SAMPLE`` distinct fingerprints, by their hashes. The
  sample shapes the shards only, never the result. Each fingerprint goes home to one leaf and visits every
  other leaf that the triangle bound cannot exclude (the leaves whose boundary its ball overlaps).
* Each shard grows its own tree below that, prunes the same way, and compares whole fingerprints exactly.
* A shard returns a spanning forest of its links instead of all of them, so a group of thousands of near
  copies gives as many edges as it has members. Equal fingerprints are one node throughout.
* Components come from alternating stars over the edges; nothing of all documents passes the driver.

Cases: NULL, empty or blank text has fingerprint zero and links like any other; a NULL id is kept, and a
component's id is its smallest non-NULL one (NULL if it has none); repeated rows and ids are judged row by
row; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import connected_components, lowest_hashes, text_key, utf8_texts
from fieldloom.session import materialise

#: Fingerprints whose shape the upper levels follow, and those wanted in a shard.
SAMPLE, SHARD = 1 << 16, 1 << 12
#: Pairs compared at once, and home fingerprints below which a branch is compared whole.
PAIRS, SMALL = 1 << 20, 48
_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """64 bits, each the majority of that bit over the hashes of all shingles; zero without a word."""
    parts = text.lower().split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), seed)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[: -words] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())], dtype=np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """Eight one-byte counters side by side in a word hold up to 255 rows before they are spread out."""
    n = len(hashes)
    lanes = _LANES[hashes.view(np.uint8).reshape(n, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0)
    counts = sums.view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, text_key and ``fp``, the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            found = np.fromiter((fingerprint(t, words, seed) for t in utf8_texts(b["text"])), np.uint64, b.num_rows)
            yield pa.record_batch([b["doc_id"], b["text_key"], pa.array(found.view(np.int64))], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _distance(x: np.ndarray, y: np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """A vantage point and a distance that halve ``points`` best of a few tries; None if none splits them."""
    best = None
    for vantage in points[rng.integers(0, len(points), 6)]:
        d = _distance(points, vantage)
        for bar in {int(np.median(d)), int(np.median(d)) - 1}:
            inner = int(np.count_nonzero(d <= bar))
            gap = abs(2 * inner - len(points))
            if 0 < inner < len(points) and (best is None or gap < best[0]):
                best = gap, vantage, bar
    return best and best[1:]


def grow(points: np.ndarray, depth: int, rng: np.random.Generator):
    """Nested (vantage, bar, inner, outer); a leaf is None."""
    found = _split(points, rng) if depth and len(points) > 1 else None
    if not found:
        return None
    vantage, bar = found
    near = _distance(points, vantage) <= bar
    return vantage, bar, grow(points[near], depth - 1, rng), grow(points[~near], depth - 1, rng)


def route(tree, points: np.ndarray, radius: int):
    """Yield (leaf, indexes, home mask): home is where a point belongs, else its ball overlaps the leaf."""
    stack = [(tree, 1, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        node, leaf, rows, home = stack.pop()
        if not len(rows):
            continue
        if node is None:
            yield leaf, rows, home
            continue
        vantage, bar, inner, outer = node
        d = _distance(points[rows], vantage).astype(np.int64)
        a, b = d <= bar + radius, d > bar - radius
        stack.append((inner, 2 * leaf, rows[a], home[a] & (d[a] <= bar)))
        stack.append((outer, 2 * leaf + 1, rows[b], home[b] & (d[b] > bar)))


class Forest:
    """Spanning forest of the links seen so far: each point's smallest known companion."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def search(points: np.ndarray, home: np.ndarray, mask: np.uint64, radius: int, max_bits: int, seed: int = 0) -> np.ndarray:
    """Links between home points and all points, as the root of each point; the local tree prunes."""
    rng, forest, part = np.random.default_rng(seed), Forest(len(points)), points & mask
    stack = [(np.flatnonzero(home), np.arange(len(points)))]
    while stack:
        own, visiting = stack.pop()
        if not len(own) or not len(visiting):
            continue
        found = _split(part[own], rng) if len(own) > SMALL else None
        if found:
            vantage, bar = found
            d, e = _distance(part[own], vantage).astype(np.int64), _distance(part[visiting], vantage).astype(np.int64)
            stack.append((own[d <= bar], visiting[e <= bar + radius]))
            stack.append((own[d > bar], visiting[e > bar - radius]))
            continue
        for i in range(0, len(own), SMALL):
            some = own[i: i + SMALL]
            for j in range(0, len(visiting), PAIRS // SMALL):
                others = visiting[j: j + PAIRS // SMALL]
                a, b = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[others][None, :]) <= max_bits)
                forest.link(some[a], others[b])
    return forest.root


def near_links(nodes: DataFrame, max_bits: int = 3, blocks: int = 2) -> DataFrame:
    """Edges (src, dst) over the distinct fingerprints ``fp`` that connect whatever links within ``max_bits`` connect."""
    spark, radius, width = nodes.sparkSession, max_bits // blocks, 64 // blocks
    masks = [np.uint64(((1 << width) - 1) << (width * i)) for i in range(blocks)]
    masks[-1] |= np.uint64((1 << 64) - (1 << (width * blocks)))  # what the division left over
    total = max(1, nodes.count())
    sample = np.array([r["fp"] for r in lowest_hashes(nodes.select("fp"), "fp", 7, SAMPLE / total).collect()], np.int64).view(np.uint64)
    depth = max(0, math.ceil(math.log2(total / SHARD)))
    trees = spark.sparkContext.broadcast([grow(np.unique(sample & m), depth, np.random.default_rng(i)) for i, m in enumerate(masks)])

    def place(batches):
        for b in batches:
            points = np.asarray(b["fp"]).view(np.uint64)
            for k, m in enumerate(masks):
                for leaf, rows, home in route(trees.value[k], points & m, radius):
                    yield pa.record_batch([pa.array(np.full(len(rows), k, np.int32)), pa.array(np.full(len(rows), leaf, np.int64)), pa.array(points[rows].view(np.int64)), pa.array(home)],
                                          names=["block", "leaf", "fp", "home"])

    def links(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        points = shard["fp"].to_numpy().view(np.uint64)
        root = search(points, shard["home"].to_numpy(), masks[key[0]], radius, max_bits)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"src": points[linked].view(np.int64), "dst": points[root[linked]].view(np.int64)})

    placed = nodes.select("fp").mapInArrow(place, "block int, leaf long, fp long, home boolean")
    return placed.groupBy("block", "leaf").applyInPandas(links, "src long, dst long")


def linked(docs: DataFrame, words: int, max_bits: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints by row, and one row for each fingerprint: fp, its rows ``n``, its first row, its component."""
    rows = materialise(fingerprints(docs, words, seed))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"), first.alias("first")))
    roots = materialise(connected_components(materialise(near_links(nodes, max_bits))))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left")
    return rows, named.select("fp", "low", "n", "first", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id)."""
    rows, named = linked(docs, words, max_bits, seed)
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = materialise(named.join(lows, "component").select("fp", "n", "component_id"))
    # Fingerprints of more than a thousandth of all rows are a thousand at most: these are broadcast, the others meet by key.
    bar = rows.count() // 1000 + 1
    hot = F.broadcast(ids.where(F.col("n") > bar).select("fp", "component_id"))
    common = rows.join(hot, "fp").select(*rows.columns, "component_id").union(rows.join(hot, "fp", "left_anti").join(ids.where(F.col("n") <= bar).select("fp", "component_id"), "fp").select(*rows.columns, "component_id"))
    return common.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, words: int = 3, max_bits: int = 3, seed: int = 42) -> DataFrame:
    """One row of ``docs`` for each component, that with the smallest id (NULL last), with all its columns."""
    _, named = linked(docs, words, max_bits, seed)
    kept = materialise(named.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("id"), F.col("first.text_key").alias("key")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("_id"), text_key().alias("_key"))
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["_id", "_key"]).select("row.*")
