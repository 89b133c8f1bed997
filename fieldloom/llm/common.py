"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.session import materialise

#: Words are runs of anything but ASCII white space; ``bytes.split()`` cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Number of words; NULL text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: str = "text") -> Column:
    """With the id, the name of a row whose id may not be its own; NULL counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def utf8_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each value of a string array, NULL as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def merge_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of half-open intervals; touching ones join."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], starts[1:] > ends[:-1]))
    last = np.concatenate((first[1:], [True]))
    return starts[first], ends[last]


def lowest_hashes(df: DataFrame, column: str, seed: int, share: float) -> DataFrame:
    """The rows whose hash lies in the lowest ``share`` of all hashes: a sample that no task has to send beyond its part."""
    if share >= 1:
        return df
    return df.where(F.xxhash64(column, F.lit(seed)) < F.lit(int(share * 2**64) - 2**63))


#: Bits of a key filter: 8 MB, whatever the table; more keys only mean more false positives.
FILTER_BITS, FILTER_HASHES = 1 << 26, 4


class KeyFilter:
    """A Bloom filter over the 64-bit ``column`` of ``keys``; ``holds`` is false only for keys that are not there.

    The bits are set in Spark, a word of 64 for each row of an aggregate, and broadcast as one array of fixed size.
    """

    def __init__(self, keys: DataFrame, column: str):
        at = keys.select(F.explode(F.array(*self.places(F.col(column)))).alias("at"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))
        words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
        table = np.zeros(FILTER_BITS // 64, np.int64)
        table[words["word"].to_numpy()] = words["bits"].to_numpy()
        self.shared = keys.sparkSession.sparkContext.broadcast(table)

    @staticmethod
    def places(key: Column) -> list[Column]:
        """The bits of a key, as columns p0, p1 and so on."""
        return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(FILTER_BITS)).alias(f"_p{i}") for i in range(FILTER_HASHES)]

    def holds(self, batch: pa.RecordBatch) -> np.ndarray:
        """For each row of a batch with the columns of ``places`` whether its key may be among the keys."""
        bits, out = self.shared.value, np.ones(len(batch), bool)
        for i in range(FILTER_HASHES):
            at = batch[f"_p{i}"].to_numpy()
            out &= (bits[at >> 6] >> (at & 63)) & 1 == 1
        return out


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst), component = smallest reachable node.

    Alternating stars: every node links its larger neighbours, then all its smaller ones, to the
    smallest neighbour. Each round halves the depth of the stars and is written to the shared folder, so
    no lineage grows and no node, edge or label passes the driver (it sees one count and one sum a
    round). A hub's edges meet in the aggregate of its minimum, which combines before the shuffle, and in
    a join whose other side has one row for each node, which adaptive execution may split.
    Stops when the edges stay the same; raises after ``max_rounds``.
    """
    both = edges.where("src <> dst")
    state, seen = materialise(_oriented(both)), None
    for _ in range(max_rounds):
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        large = _star(state.union(state.select("dst", "src")), larger_only=True)
        state = materialise(_oriented(_star(_oriented(large), larger_only=False)))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = state.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return roots.union(roots.select("component", "component")).distinct()


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst").distinct()


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    low = edges.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
    joined = edges.join(low, "src")
    if larger_only:
        return joined.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).union(low.select("src", F.col("low").alias("dst")))
