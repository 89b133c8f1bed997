"""Exact top-k search by inner product over a vector-approximation file.

Vectors become whole numbers floor(scale * x). Rows with the same vector form a class that keeps its k + 1
smallest ids: no result needs more, so a vector that fills a third of the table is one entry. The file
holds for each class the cell of each component (``bits`` bits on a grid over that component's range) next
to the exact vector; being columnar, a scan of the cells does not read the vectors.

1. Scan: blocks of queries meet shards of cells. Each pair of blocks gives every score's lower and upper
   bound in two matrix products and keeps the candidates whose upper bound reaches the shard's k-th lower
   bound. Over all shards only candidates reaching the query's k-th lower bound stay.
2. Read: exact vectors are fetched in the order of the bounds, first ``2 (k + 1)`` for each query; then those
   whose bound still reaches the k-th exact score. After that no other vector can be in the result.

A query whose id has one vector asks for k + 1, so that its own row can be left out afterwards. Where the id has
several, it is a search of its own (``own``), and classes that hold no other id are left out before any bound is
taken; its id leaves the other classes before the last cut. Blocks have fixed sizes, so memory does not grow; work is queries x rows, as exact search with a weak bound must be.

Cases: rows with NULL id, NULL vector, or a NULL or non-finite component take no part; exact repeats of a
row count once; one id with several vectors is a candidate by each and a query by each; only vectors of
equal length are compared; ties go to the smaller id; an empty table gives an empty result; extra columns
are not looked at. Scaled components beyond 2^20 raise, since scores would not be exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.session import materialise

LIMIT = 1 << 20
SHARD_ROWS, QUERY_ROWS = 4096, 1024


def scaled_rows(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, vector array<long>) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    wide = F.exists("vector", lambda x: F.abs(x) > LIMIT)
    checked = F.when(wide, F.raise_error(F.lit(f"a scaled component is beyond {LIMIT}")).cast("array<bigint>")).otherwise(F.col("vector"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).withColumn("vector", checked).distinct()


def vector_key(vector: str) -> Column:
    return F.unhex(F.sha2(F.array_join(vector, ",").cast("binary"), 256))


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """At most ``n`` rows for each key; Spark limits each task's groups before the shuffle."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n)


def component_ranges(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length -> smallest and largest value of each component; one row of two arrays per length and component."""

    def partial(batches):
        low: dict[int, np.ndarray] = {}
        high: dict[int, np.ndarray] = {}
        for b in batches:
            for v in b["vector"]:
                x = np.asarray(v.values, dtype=np.int64)
                d = len(x)
                low[d] = np.minimum(low[d], x) if d in low else x
                high[d] = np.maximum(high[d], x) if d in high else x
        rows = [(d, i, int(a), int(b)) for d in low for i, (a, b) in enumerate(zip(low[d], high[d]))]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["d", "i", "low", "high"]).astype("int64"), preserve_index=False)

    rows = classes.select("vector").mapInArrow(partial, "d long, i long, low long, high long").groupBy("d", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {0: (np.zeros(0, np.int64), np.zeros(0, np.int64))}
    for d in {r["d"] for r in rows}:
        own = sorted((r["i"], r["low"], r["high"]) for r in rows if r["d"] == d)
        out[d] = np.array([r[1] for r in own]), np.array([r[2] for r in own])
    return out


class Grid:
    """Cells of equal width over each component's range."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int):
        self.low, self.high, self.width = low, high, np.maximum(1, -(-(high - low + 1) // (1 << bits)))

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.low) // self.width).astype(np.uint8)

    def edges(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest whole number of each cell."""
        low = self.low + cells * self.width
        return low.astype(np.float64), np.minimum(low + self.width - 1, self.high).astype(np.float64)


def top_k(rows: DataFrame, is_query: Column, k: int = 5, scale: int = 256, bits: int = 6) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best other rows for each row (vec_id, embedding) with ``is_query``."""
    if not 1 <= bits <= 8:
        raise ValueError("bits must be 1 to 8")
    want = k + 1
    spark = rows.sparkSession
    every = materialise(scaled_rows(rows, scale).withColumn("key", vector_key("vector")))
    classes = (
        first_rows(every, ["key"], [F.col("vec_id")], want).groupBy("key")
        .agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    queries = every.where(is_query).select(F.col("vec_id").alias("query_id"), "key")
    several = every.join(queries.select(F.col("query_id").alias("vec_id")).distinct(), "vec_id", "left_semi").groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1")
    several = materialise(several.select(F.col("vec_id").alias("query_id"), F.col("vec_id").alias("own")))
    name = F.when(F.col("own").isNull(), F.col("key")).otherwise(F.concat("key", F.col("own").cast("string").cast("binary")))
    queries = materialise(queries.join(several, "query_id", "left").withColumn("query", name))
    grids = {d: Grid(low, high, bits) for d, (low, high) in component_ranges(every).items()}

    def code(batches):
        for b in batches:
            cells, packed = [], []
            for v in b["vector"]:
                x = np.asarray(v.values, dtype=np.int64)
                cells.append(grids[len(x)].cells(x).tobytes())
                packed.append(x.astype(np.int32).tobytes())
            yield pa.record_batch([b["key"].cast(pa.binary()), pa.array([len(c) for c in cells], pa.int32()), pa.array(cells, pa.binary()), pa.array(packed, pa.binary()), b["vector"], b["ids"]],
                                  names=["key", "d", "cells", "packed", "vector", "ids"])

    file = materialise(classes.mapInArrow(code, "key binary, d int, cells binary, packed binary, vector array<bigint>, ids array<bigint>"))
    asked = materialise(file.join(queries.select("key", "query", "own").distinct(), "key").select("query", "own", "d", "packed", "vector"))
    shards, blocks = max(1, math.ceil(file.count() / SHARD_ROWS)), max(1, math.ceil(asked.count() / QUERY_ROWS))

    def every_number(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    sole = F.when(F.size("ids") == 1, F.col("ids")[0])
    left = asked.select("query", F.col("own").cast("string").alias("own"), "d", "packed", part("query", blocks).alias("block"), every_number(shards).alias("shard"))
    right = file.select("key", sole.cast("string").alias("sole"), "d", "cells", part("key", shards).alias("shard"), every_number(blocks).alias("block"))

    def scan(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query": [], "key": [], "low": [], "high": []})
        d = int(q["d"].iloc[0])
        asked = np.frombuffer(b"".join(q["packed"]), np.int32).reshape(len(q), d).astype(np.float64)
        low, high = grids[d].edges(np.frombuffer(b"".join(c["cells"]), np.uint8).reshape(len(c), d).astype(np.int64))
        plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
        least = plus @ low.T + minus @ high.T
        most = plus @ high.T + minus @ low.T
        # Classes of nobody but the query's id: ids as numbers, those of no such query or class apart.
        ids = {x: i for i, x in enumerate(q["own"].dropna().unique())}
        out = np.array([ids.get(x, -1) for x in q["own"]])[:, None] == np.array([ids.get(x, -2) for x in c["sole"]])
        least[out] = most[out] = -np.inf
        n = min(want, len(c))
        bar = -np.partition(-least, n - 1, axis=1)[:, n - 1: n] if len(c) >= want else np.full((len(q), 1), -np.inf)
        i, j = np.nonzero((most >= bar) & ~out)
        return pd.DataFrame({"query": q["query"].to_numpy()[i], "key": c["key"].to_numpy()[j], "low": least[i, j], "high": most[i, j]})

    by = ["d", "block", "shard"]
    found = materialise(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(scan, "query binary, key binary, low double, high double"))
    bars = first_rows(found, ["query"], [F.col("low").desc()], want).groupBy("query").agg(F.count("*").alias("n"), F.min("low").alias("low"))
    bars = bars.select("query", F.when(F.col("n") == want, F.col("low")).otherwise(F.lit(float("-inf"))).alias("bar"))
    kept = found.join(bars, "query").where("high >= bar").select("query", "key", "high")
    kept = materialise(kept.withColumn("at", F.row_number().over(W.partitionBy("query").orderBy(F.col("high").desc(), "key"))))

    def score(pairs: DataFrame) -> DataFrame:
        exact = F.aggregate(F.zip_with("asked", "vector", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return (
            pairs.join(file.select("key", "vector", "ids"), "key").join(asked.select("query", "own", F.col("vector").alias("asked")), "query")
            .select("query", "own", exact.alias("score"), "ids")
        )

    near = materialise(score(kept.where(F.col("at") <= 2 * want)))
    sure = first_rows(near, ["query"], [F.col("score").desc()], want).groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    sure = sure.select("query", F.when(F.col("n") == want, F.col("score").cast("double")).otherwise(F.lit(float("-inf"))).alias("bar"))
    far = score(kept.where(F.col("at") > 2 * want).join(sure, "query").where("high >= bar"))
    rows_found = near.union(far).select("query", "own", "score", F.explode("ids").alias("vec_id")).where("own IS NULL OR vec_id <> own")
    best = first_rows(rows_found, ["query"], [F.col("score").desc(), F.col("vec_id")], want).select("query", "vec_id", "score")
    pairs = queries.join(best, "query").where("vec_id <> query_id")
    ranked = first_rows(pairs, ["query_id", "query"], [F.col("score").desc(), F.col("vec_id")], k)
    return ranked.select("query_id", F.col("_n").alias("rank"), "vec_id", "score")
