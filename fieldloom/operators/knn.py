"""Exact nearest neighbours.

Training rows are grouped around pivots and cut into blocks of bounded size. The
triangle inequality gives every query an upper bound on its k-th distance before any
training row is read; a query visits only the blocks that could hold something nearer.
A task holds one block and streams queries past it in matrices of bounded size, keeping k rows per
query, so no table of pairs exists anywhere. In high dimensions the triangle inequality excludes
little: then nearly every query visits every block, which is the cost of an exact answer
there. ``approximate_neighbours`` is the other choice, by name. (Lu et al., Efficient Processing of k Nearest Neighbor
Joins using MapReduce, 2012.)
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions.scalars import order_hash
from fieldloom.session import materialise

METRICS = ("euclidean", "manhattan", "chebyshev", "cosine")
MAX_PIVOTS = 256
BLOCK_ROWS = 4_096
QUERIES_PER_TASK = 200_000
# Cells of a matrix of distances, and of the vectors that travel as one row.
CELLS, PACKED_CELLS = 1 << 20, 1 << 10
PACKED = ["cell", "block", "salt", "kind", "ids", "lens", "ixs", "vxs", "payloads"]


def dense_parts(features: str | Column) -> list[Column]:
    c = F.col(features) if isinstance(features, str) else features
    return [F.lit(None).cast("array<int>").alias("ix"), c.cast("array<double>").alias("vx")]


def sparse_parts(weights: str) -> list[Column]:
    """From a struct of indices and values, as the TF-IDF model leaves it."""
    return [F.col(f"{weights}.indices").cast("array<int>").alias("ix"), F.col(f"{weights}.values").cast("array<double>").alias("vx")]


def _matrix(frame: pd.DataFrame, size: int) -> np.ndarray:
    out = np.zeros((len(frame), size))
    for r, (ix, vx) in enumerate(zip(frame["ix"], frame["vx"])):
        if ix is None:
            out[r, : len(vx)] = vx
        elif len(vx):
            out[r, np.asarray(ix, dtype=int)] = vx
    return out


def _prepared(x: np.ndarray, metric: str, is_query: bool) -> np.ndarray:
    """Cosine becomes Euclidean on unit rows; an all-zero row becomes a unit row orthogonal to
    everything on the other side, which keeps its cosine distance of 1 to every row."""
    if metric != "cosine":
        return x
    norms = np.sqrt((x * x).sum(axis=1))
    zero = norms == 0
    extra = np.zeros((len(x), 2))
    extra[zero, 0 if is_query else 1] = 1.0
    return np.hstack([x / np.where(zero, 1.0, norms)[:, None], extra])


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distances between all rows of two small matrices."""
    if metric in ("euclidean", "cosine"):
        return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T, 0.0))
    out = np.empty((len(a), len(b)))
    for i, q in enumerate(a):  # one row's differences at a time
        d = np.abs(b - q)
        out[i] = d.sum(axis=1) if metric == "manhattan" else d.max(axis=1)
    return out


def _exact(q: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    d = rows - q
    if metric in ("euclidean", "cosine"):
        return np.sqrt((d * d).sum(axis=1))
    return np.abs(d).sum(axis=1) if metric == "manhattan" else np.abs(d).max(axis=1)


def neighbours(queries: DataFrame, train: DataFrame, k: int = 5, metric: str = "euclidean", size: int | None = None) -> DataFrame:
    """(query_id, rank, train_id, distance, payload) for the k nearest training rows of every query.

    ``queries`` has (id long, ix, vx); ``train`` has (id long, ix, vx, payload string), see
    ``dense_parts`` and ``sparse_parts``. Ties go to the smaller training id. The payload
    (a label, a target) travels with its row, so no join on popular neighbours is needed.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    spark = train.sparkSession
    if size is None:
        size = train.agg(F.max(F.size("vx"))).first()[0] or 0
    n_train, n_queries = train.count(), queries.count()
    if n_train == 0:
        raise ValueError("no training rows")

    chosen = train.orderBy(order_hash("id"), "id").limit(max(1, min(MAX_PIVOTS, math.isqrt(n_train) // 4))).toPandas()
    pivots = _prepared(_matrix(chosen, size), metric, False)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(batches, max(1, CELLS // max(len(pivots), size))):
            d = _distances(_prepared(_matrix(frame, size), metric, False), pivots, metric)
            cell = d.argmin(axis=1)
            yield frame.assign(cell=cell.astype("int32"), r=d[np.arange(len(d)), cell])

    placed = materialise(train.select("id", "ix", "vx", "payload").mapInPandas(
        place, "id long, ix array<int>, vx array<double>, payload string, cell int, r double"))
    # One row per pivot, and k rows per pivot.
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high")).collect()}
    nearest = placed.select("cell", "r").withColumn("i", F.row_number().over(W.partitionBy("cell").orderBy("r"))).where(
        F.col("i") <= k).collect()
    present = sorted(cells)
    low, high = (np.array([cells[c][f] for c in present]) for f in ("low", "high"))
    blocks = np.array([math.ceil(cells[c]["n"] / BLOCK_ROWS) for c in present])
    centres = pivots[present]
    owner = np.array([present.index(r["cell"]) for r in nearest])
    reach = np.array([r["r"] for r in nearest])
    salts = max(1, math.ceil(n_queries / QUERIES_PER_TASK))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(batches, max(1, CELLS // max(len(owner), size))):
            ids, x = frame["id"].to_numpy(), _matrix(frame, size)
            d = _distances(_prepared(x, metric, True), centres, metric)
            upper = d[:, owner] + reach[None, :]
            bound = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(d), np.inf)
            # Room for rounding in the matrix form of the distance.
            slack = 1e-6 * (1.0 + np.where(np.isfinite(bound), bound, 0.0))
            needed = np.maximum(d - high[None, :], low[None, :] - d) <= (bound + slack)[:, None]
            lines = []
            for col in np.flatnonzero(needed.any(axis=0)):
                own = np.flatnonzero(needed[:, col])
                for salt in range(salts):
                    for part in _cut(own[ids[own] % salts == salt], size):
                        packed = (1, *_pack(frame.iloc[part]), None)
                        lines += [(present[col], block, salt, *packed) for block in range(blocks[col])]
                        if len(lines) >= 1_024:
                            yield pd.DataFrame(lines, columns=PACKED)
                            lines = []
            if lines:
                yield pd.DataFrame(lines, columns=PACKED)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _slices(batches, max(1, CELLS // size)):
            lines = []
            for (cell, block), group in frame.groupby(["cell", "block"]):
                for part in _cut(np.arange(len(group)), size):
                    own = group.iloc[part]
                    packed = (0, *_pack(own), own["payload"].to_list())
                    lines += [(cell, block, salt, *packed) for salt in range(salts)]
            yield pd.DataFrame(lines, columns=PACKED)

    schema = "cell int, block int, salt int, kind int, ids binary, lens binary, ixs binary, vxs binary, payloads array<string>"
    per_cell = spark.createDataFrame([(int(c), int(b)) for c, b in zip(present, blocks)], "cell int, blocks int")
    side_q = queries.select("id", "ix", "vx").mapInPandas(visit, schema)
    side_t = placed.join(F.broadcast(per_cell), "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "ix", "vx", "payload").mapInPandas(settle, schema)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, block, rows, waiting, n = None, None, [], [], 0
        for frame in batches:
            for line in frame.itertuples(index=False):
                if line[:3] != key:
                    if waiting:
                        yield _nearest_in_block(waiting, *block, k, metric, size)
                    key, block, rows, waiting, n = line[:3], None, [], [], 0
                if line.kind == 0:
                    rows.append(line)
                elif rows or block:
                    if block is None:
                        block = _block(rows, metric, size)
                        rows = []
                    waiting.append(line)
                    n += len(line.ids) // 8
                    if n * len(block[0]) >= CELLS:
                        yield _nearest_in_block(waiting, *block, k, metric, size)
                        waiting, n = [], 0
        if waiting:
            yield _nearest_in_block(waiting, *block, k, metric, size)

    keys = ["cell", "block", "salt"]
    found = (
        side_t.unionByName(side_q).repartition(*keys).sortWithinPartitions(*keys, "kind")
        .mapInPandas(search, "query_id long, train_id long, distance double, payload string")
    )
    order = W.partitionBy("query_id").orderBy("distance", "train_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    distance = F.col("distance") * F.col("distance") / 2 if metric == "cosine" else F.col("distance")
    return best.select("query_id", "rank", "train_id", distance.alias("distance"), "payload")


def _slices(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for start in range(0, len(frame), rows):
            yield frame.iloc[start:start + rows]


def _cut(places: np.ndarray, size: int) -> list[np.ndarray]:
    """Pieces of a few KB, so that no batch of packed rows is large."""
    step = max(1, PACKED_CELLS // size)
    return [places[i:i + step] for i in range(0, len(places), step)]


def _pack(frame: pd.DataFrame) -> tuple[bytes, bytes, bytes, bytes]:
    """Ids, lengths, places (none if all rows are dense) and values of some rows."""
    values = [np.asarray(v, dtype=float) for v in frame["vx"]]
    places = b""
    if any(ix is not None for ix in frame["ix"]):
        places = np.concatenate([np.arange(len(v)) if ix is None else np.asarray(ix, dtype=int) for ix, v in zip(frame["ix"], values)]).astype(np.int32).tobytes()
    return frame["id"].to_numpy().astype(np.int64).tobytes(), np.array([len(v) for v in values], np.int32).tobytes(), places, np.concatenate(values).tobytes()


def _unpack(lines: list, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and a dense matrix of packed rows."""
    ids = np.frombuffer(b"".join(line.ids for line in lines), np.int64)
    out, at = np.zeros((len(ids), size)), 0
    for line in lines:
        lens = np.frombuffer(line.lens, np.int32)
        row = np.repeat(np.arange(at, at + len(lens)), lens)
        place = np.frombuffer(line.ixs, np.int32) if line.ixs else np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
        out[row, place] = np.frombuffer(line.vxs, np.float64)
        at += len(lens)
    return ids, out


def _block(lines: list, metric: str, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, rows = _unpack(lines, size)
    return ids, _prepared(rows, metric, False), np.concatenate([np.array(line.payloads, dtype=object) for line in lines])


def _nearest_in_block(lines: list, ids, rows, payloads, k, metric, size) -> pd.DataFrame:
    query_ids, queries = _unpack(lines, size)
    queries = _prepared(queries, metric, True)
    take = min(k, len(ids))
    picks, distances = [], []
    step = max(1, CELLS // len(ids))
    for start in range(0, len(queries), step):
        rough = _distances(queries[start:start + step], rows, metric)
        limit = np.partition(rough, take - 1, axis=1)[:, take - 1]
        for i, q in enumerate(queries[start:start + step]):
            near = np.nonzero(rough[i] <= limit[i] + 1e-6 * (1 + limit[i]))[0]
            # Distances are rounded far below any tolerance so that equal distances tie by id.
            exact = np.round(_exact(q, rows[near], metric), 12)
            first = np.lexsort((ids[near], exact))[:take]
            picks.append(near[first])
            distances.append(exact[first])
    lengths, pick = [len(p) for p in picks], np.concatenate(picks)
    return pd.DataFrame({"query_id": np.repeat(query_ids, lengths), "train_id": ids[pick], "distance": np.concatenate(distances), "payload": payloads[pick]})


def approximate_neighbours(queries: DataFrame, train: DataFrame, k: int, radius: float, bucket: float, tables: int = 8, seed: int = 42) -> DataFrame:
    """(query_id, rank, train_id, distance) among training rows within ``radius``, by random projections: some may be missed.

    Both sides have (id, features vector). Rows meet only if they share a bucket of width
    ``bucket`` in one of ``tables`` projections, so no block of all rows is visited; more tables
    find more. Measure the recall against ``neighbours`` before relying on it.
    """
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="_hashes", bucketLength=bucket, numHashTables=tables, seed=seed).fit(train)
    pairs = lsh.approxSimilarityJoin(queries.select("id", "features"), train.select("id", "features"), radius, "distance")
    found = pairs.select(F.col("datasetA.id").alias("query_id"), F.col("datasetB.id").alias("train_id"), "distance")
    order = W.partitionBy("query_id").orderBy("distance", "train_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "train_id", "distance")


def _weights(weighting: str) -> Column:
    """Uniform, or inverse distance with exact matches taking all."""
    if weighting == "uniform":
        return F.lit(1.0)
    exact = F.min("distance").over(W.partitionBy("query_id")) == 0
    return F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(1 / F.col("distance"))


def knn_regress(found: DataFrame, weighting: str = "uniform") -> DataFrame:
    """Mean target of the neighbours; the payload is the target."""
    w = found.withColumn("_w", _weights(weighting))
    return w.groupBy("query_id").agg((F.sum(F.col("_w") * F.col("payload").cast("double")) / F.sum("_w")).alias("prediction"))


def knn_shares(found: DataFrame, weighting: str = "uniform") -> DataFrame:
    """Share of each class among the neighbours; the payload is the class."""
    w = found.withColumn("_w", _weights(weighting))
    votes = w.groupBy("query_id", F.col("payload").alias("label")).agg(F.sum("_w").alias("votes"))
    return votes.select("query_id", "label", (F.col("votes") / F.sum("votes").over(W.partitionBy("query_id"))).alias("share"))


def knn_classify(found: DataFrame, weighting: str = "uniform") -> DataFrame:
    """The class with the largest share, the smallest name among equals."""
    return knn_shares(found, weighting).groupBy("query_id").agg(
        F.min_by("label", F.struct(-F.col("share"), F.col("label"))).alias("prediction"), F.max("share").alias("share"))


def empty_neighbour_share(found: DataFrame) -> DataFrame:
    """Payload 'empty' marks all-zero training rows: share of queries with one, and with nothing else."""
    per_query = found.groupBy("query_id").agg(F.max((F.col("payload") == "empty").cast("int")).alias("any"),
                                              F.min((F.col("payload") == "empty").cast("int")).alias("all"))
    return per_query.agg(F.avg("any").alias("share_any"), F.avg("all").alias("share_all"))
