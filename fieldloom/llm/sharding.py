"""Uniform shuffle of a table into shards of exact sizes, by a hypergeometric communication matrix.

Every order of the rows is as likely as any other, and shards differ by one row at most.

* The rows are written once with their partition and place, so that lost executors find the same places again. Partitions
  are cut into units of at most ``UNIT`` rows.
* Matrix: how many rows of each unit go to each shard is what a uniform permutation would give: multivariate
  hypergeometric draws with the units' sizes and the shards' sizes as margins. The draws follow a binary tree over the
  units, each node with its own seed, so a task finds the row of its unit along one path of the tree, by itself; the
  matrix is nowhere as a whole. The driver sees one row count for each partition.
* Permute locally: a unit's rows are permuted; the first so many go to the first shard, and so on.
* Exchange and permute again: rows go by (shard, random key) to range partitions, as many as the session has shuffle
  partitions, so a shard never has to fit one task; the order of the keys is the second permutation, and a row's
  slot its place in it.

A run over the same stored rows, cut into the same partitions, gives the same result. Equal rows or texts are not kept
together: a uniform shuffle knows no groups.

Cases: NULLs, empty and long texts and repeated rows are rows like any other, each with a slot of its own; a table without
rows gives none; fewer rows than shards leave shards empty. Columns named ``shard`` or ``slot`` are replaced, all
others are carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.order import running_totals
from fieldloom.session import materialise

UNIT = 1 << 20
#: ``monotonically_increasing_id`` has the partition above this bit and the place below.
PLACE_BITS = 33


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good: inversion over all values that doubles can tell from impossible.

    The probabilities come from the ratios of neighbours, so they stay exact for any number of rows.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = (draws + 1) * (good + 1) // (total + 2)
    spread = math.sqrt(draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1)))
    reach = int(12 * spread) + 32
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    ratio = (good - k) / (k + 1) * ((draws - k) / (bad - draws + k + 1))
    weight = np.concatenate(([0.0], np.cumsum(np.log(ratio))))
    until = np.cumsum(np.exp(weight - weight.max()))
    return low + min(int(np.searchsorted(until, rng.random() * until[-1], "right")), high - low)


def split_counts(rng: np.random.Generator, counts: np.ndarray, draws: int) -> np.ndarray:
    """How many of ``draws`` without replacement are of each kind, given how many there are."""
    taken, rest = [], int(counts.sum())
    for count in map(int, counts):
        rest -= count
        taken.append(hypergeometric(rng, count, rest, draws))
        draws -= taken[-1]
    return np.array(taken, np.int64)


class Matrix:
    """Rows of the communication matrix, each found by itself."""

    def __init__(self, partitions: dict[int, int], shards: int, seed: int, unit: int = UNIT):
        self.first: dict[int, int] = {}
        sizes: list[int] = []
        for partition, rows in sorted(partitions.items()):
            self.first[partition] = len(sizes)
            sizes += [min(unit, rows - at) for at in range(0, rows, unit)]
        self.until = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64)))).astype(np.int64)
        total = int(self.until[-1])
        self.shards = np.array([total // shards + (j < total % shards) for j in range(shards)], np.int64)
        self.seed, self.unit = seed, unit

    def size(self, number: int) -> int:
        return int(self.until[number + 1] - self.until[number])

    def row(self, number: int) -> np.ndarray:
        """Rows of unit ``number`` that go to each shard."""
        a, b, counts = 0, len(self.until) - 1, self.shards
        while b - a > 1:
            middle = (a + b) // 2
            left = split_counts(np.random.default_rng([self.seed, 0, a, b]), counts, int(self.until[middle] - self.until[a]))
            a, b, counts = (a, middle, left) if number < middle else (middle, b, counts - left)
        return counts

    def dealt(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard and random key of each place of unit ``number``."""
        rng = np.random.default_rng([self.seed, 1, number])
        order = rng.permutation(self.size(number))
        return np.searchsorted(np.cumsum(self.row(number)), order, "right").astype(np.int32), rng.integers(0, 2**63 - 1, len(order))


def shuffle(rows: DataFrame, shards: int = 16, seed: int = 42, unit: int = UNIT) -> DataFrame:
    """The columns of ``rows`` with ``shard`` (from 0) and ``slot``, the row's place in its shard (from 0)."""
    if shards < 1 or seed < 0 or unit < 1:
        raise ValueError("shards and unit must be 1 or more, seed 0 or more")
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.monotonically_increasing_id().alias("place"))
    stored = materialise(held)
    sizes = stored.groupBy(F.shiftright("place", PLACE_BITS).alias("partition")).agg(F.count("*").alias("n")).collect()
    shared = rows.sparkSession.sparkContext.broadcast(Matrix({r["partition"]: r["n"] for r in sizes}, shards, seed, unit))

    @F.pandas_udf("shard int, key long")
    def deal(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matrix, known, number = shared.value, None, -1
        for places in batches:
            at = places.to_numpy()
            partition, place = at >> PLACE_BITS, at & ((1 << PLACE_BITS) - 1)
            present, which = np.unique(partition, return_inverse=True)
            units = np.array([matrix.first[p] for p in present.tolist()], np.int64)[which] + place // matrix.unit
            shard, key = np.empty(len(at), np.int32), np.empty(len(at), np.int64)
            for u in np.unique(units).tolist():
                if u != number:
                    known, number = matrix.dealt(u), u
                own = units == u
                shard[own], key[own] = (x[place[own] % matrix.unit] for x in known)
            yield pd.DataFrame({"shard": shard, "key": key})

    dealt = stored.withColumn("to", deal("place"))
    keyed = dealt.select("row", F.col("to.shard").alias("shard"), F.struct(F.col("to.key"), F.col("place")).alias("key"), F.lit(1).cast("long").alias("one"))
    slotted = running_totals(keyed, "key", ["one"], by=["shard"])
    return slotted.select("row.*", "shard", F.col("one_before").alias("slot"))


def write_shards(rows: DataFrame, path: str, shards: int = 16, seed: int = 42) -> DataFrame:
    """The shuffled table as one Parquet folder for each shard under ``path``, files in the order of the slots; read back."""
    dealt = shuffle(rows, shards, seed)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return rows.sparkSession.read.parquet(path)
