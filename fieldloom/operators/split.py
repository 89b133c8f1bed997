"""Quantile strata, seeded splits and folds, and the checks on them.

A split is decided by an md5 order over (seed, row id). Instead of sorting a stratum,
the hash values at which it is cut are found first: counting rows per hash prefix
tells which prefix holds each cut, and only the rows of that prefix are ordered.
Assigning rows is then a map against a table of a few cut values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions.scalars import normalised_text, order_hash
from fieldloom.operators.duplicates import key_columns
from fieldloom.operators.order import WINDOW_ROWS, exact_quantiles
from fieldloom.session import materialise

# Share of test rows, seed, number of folds, number of target strata.
TEST_SIZE = 0.20
SEED = 42
FOLDS = 5
STRATIFY_BINS = 10

MAX_STRATA = 10_000
# Hex digits of the hash examined per round: 4,096 prefixes.
PREFIX = 3
# Up to this many prefixes are a plain test of each row before the join that also asks for its stratum.
MAX_PREFIXES = 1_000


def bin_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Quantile edges with equal ones merged."""
    edges = exact_quantiles(df, {column: [k / bins for k in range(bins + 1)]})[column]
    return sorted({e for e in edges if e is not None})


def bin_of(column: str, edges: Sequence[float]) -> Column:
    """Number of interior edges below the value: bins closed on the right."""
    x = F.col(column).cast("double")
    number = F.lit(0).cast("long")
    for e in edges[1:-1]:
        number = number + (x > F.lit(e)).cast("long")
    return F.when(x.isNotNull() & ~F.isnan(x), number)


def quantile_bins(df: DataFrame, column: str, bins: int = STRATIFY_BINS, name: str = "bin") -> DataFrame:
    return df.withColumn(name, bin_of(column, bin_edges(df, column, bins)))


def test_quotas(sizes: Mapping, test_size: float = TEST_SIZE) -> dict:
    """Test rows per stratum by largest remainder, ties to the smaller stratum."""
    n = sum(sizes.values())
    n_test = math.ceil(test_size * n - 1e-9)
    exact = {s: n_test * c / n for s, c in sizes.items()}
    quota = {s: math.floor(e + 1e-9) for s, e in exact.items()}
    order = sorted(sizes, key=lambda s: (-(round(exact[s] - quota[s], 9)), s is None, s))
    for s in order[: n_test - sum(quota.values())]:
        quota[s] += 1
    return quota


def stored_hash(key: str, seed: int = SEED) -> Column:
    """The 16 bytes of a row's place in hash order, for tables that several splits or folds read."""
    return F.unhex(order_hash(key, seed))


def _cut_by_hash(
    df: DataFrame, key: str, stratum: str | None, seed: int, plan: Callable[[dict], dict[object, list[int]]], name: str,
    hashed: str | None = None,
) -> DataFrame:
    """Add ``name``: how many cuts of its stratum lie below each row in hash order.

    ``plan`` turns the stratum sizes into the ranks (1-based, the last row before the
    cut) at which each stratum is cut. ``hashed`` names a column that holds ``stored_hash``
    of the same key and seed; the hash is then read instead of computed in every pass.
    """
    spark = df.sparkSession
    s = F.col(stratum) if stratum else F.lit(0)
    h = F.hex(hashed) if hashed else order_hash(key, seed)
    rows = df.select(s.alias("s"), h.alias("h"))
    stype = rows.schema["s"].dataType.simpleString()

    counts = materialise(rows.groupBy("s", F.left("h", F.lit(PREFIX)).alias("p")).agg(F.count("*").alias("n")))
    sizes = counts.groupBy("s").agg(F.sum("n").alias("n")).limit(MAX_STRATA + 1).collect()
    if len(sizes) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata; stratify on classes or bins")
    cuts = plan({r["s"]: r["n"] for r in sizes})
    wanted = [(v, "", i, r) for v, ranks in cuts.items() for i, r in enumerate(ranks) if r > 0]

    # Follow the prefix that holds each cut until few enough rows share it.
    digits, candidates, found = PREFIX, rows, {}
    while wanted:
        targets = F.broadcast(spark.createDataFrame(wanted, f"ts {stype}, parent string, cut int, rank long"))
        upto = W.partitionBy("s", "parent").orderBy("p").rowsBetween(W.unboundedPreceding, 0)
        levels = counts.withColumn("parent", F.left("p", F.lit(digits - PREFIX))).withColumn(
            "last", F.sum("n").over(upto))
        # One row per cut.
        places = levels.join(targets.withColumnRenamed("parent", "tp"), F.col("s").eqNullSafe(F.col("ts"))
                             & (F.col("parent") == F.col("tp")) & (F.col("rank") <= F.col("last"))
                             & (F.col("rank") > F.col("last") - F.col("n"))).select(
            "s", "p", "cut", (F.col("rank") - F.col("last") + F.col("n")).alias("nth"), "n").collect()
        keys = sorted({(r["s"], r["p"]) for r in places}, key=lambda k: (k[0] is None, k))
        edge = F.broadcast(spark.createDataFrame(keys, f"ts {stype}, tp string"))
        candidates, prefixes = candidates.withColumn("p", F.left("h", F.lit(digits))), sorted({p for _, p in keys})
        if len(prefixes) <= MAX_PREFIXES:
            candidates = candidates.where(F.col("p").isin(prefixes))
        candidates = candidates.join(
            edge, F.col("s").eqNullSafe(F.col("ts")) & (F.col("p") == F.col("tp")), "left_semi")
        if max(r["n"] for r in places) <= WINDOW_ROWS:
            ordered = candidates.withColumn("nth", F.row_number().over(W.partitionBy("s", "p").orderBy("h")))
            picks = F.broadcast(spark.createDataFrame(
                [(r["s"], r["p"], r["cut"], r["nth"]) for r in places], f"ts {stype}, tp string, cut int, tn long"))
            hit = ordered.join(picks, F.col("s").eqNullSafe(F.col("ts")) & (F.col("p") == F.col("tp")) & (F.col("nth") == F.col("tn")))
            found = {(r["s"], r["cut"]): r["h"] for r in hit.select("s", "cut", "h").collect()}
            break
        wanted = [(r["s"], r["p"], r["cut"], r["nth"]) for r in places]
        digits += PREFIX
        candidates = candidates.drop("p")
        counts = materialise(candidates.groupBy("s", F.left("h", F.lit(digits)).alias("p")).agg(F.count("*").alias("n")))

    # A rank of 0 cuts before the first row: every hash lies above the empty text.
    table = [(v, [found.get((v, i), "") for i in range(len(ranks))]) for v, ranks in cuts.items()]
    width = max((len(c) for _, c in table), default=0)
    known = df.withColumn("_h", h)
    # Plain comparisons with one cut a column run in generated code; a stratum without a further cut has NULL there.
    if stratum is None:
        marked, ends = known, [F.lit(c) for _, own in table for c in own]
    else:
        lookup = F.broadcast(spark.createDataFrame([(v, *c, *[None] * (width - len(c))) for v, c in table],
                                                   f"_s {stype}" + "".join(f", _c{i} string" for i in range(width))))
        marked = known.withColumn("_stratum_key", s).join(lookup, F.col("_stratum_key").eqNullSafe(F.col("_s")), "left")
        ends = [F.col(f"_c{i}") for i in range(width)]
    past = F.lit(0)
    for end in ends:
        past = past + F.when(end < F.col("_h"), 1).otherwise(0)
    return marked.withColumn(name, past).drop("_h", "_s", "_stratum_key", *[f"_c{i}" for i in range(width)])


def require_row_key(df: DataFrame, key: str) -> None:
    """The key must be there and differ in every row; its digests are counted, which combines before the shuffle."""
    bad = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where(F.col("key").isNull() | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"{key} = {bad[0]['key']!r} is in {bad[0]['n']} rows; a row key is never NULL and never repeated")


def train_test_split(
    df: DataFrame, key: str, stratum: str | None = None, test_size: float = TEST_SIZE, seed: int = SEED, checked: bool = False,
    hashed: str | None = None,
) -> DataFrame:
    """Add ``split`` ('train' or 'test'); a ``key`` that is NULL or repeated raises, since rows are told apart by it.

    ``checked`` says that the caller has made sure of the key; ``hashed`` names its ``stored_hash``.
    """
    if not checked:
        require_row_key(df, key)
    plan = lambda sizes: {s: [q] for s, q in test_quotas(sizes, test_size).items()}
    marked = _cut_by_hash(df, key, stratum, seed, plan, "_past", hashed)
    return marked.withColumn("split", F.when(F.col("_past") == 0, "test").otherwise("train")).drop("_past")


def split_on_target(
    df: DataFrame, key: str, target: str, bins: int | None = STRATIFY_BINS, test_size: float = TEST_SIZE, seed: int = SEED,
    checked: bool = False, hashed: str | None = None,
) -> DataFrame:
    """Split stratified on quantile bins of the target; ``bins`` 0 or None splits plainly.

    The bins exist for the split only and are not among the returned columns.
    """
    if not bins:
        return train_test_split(df, key, None, test_size, seed, checked, hashed)
    binned = quantile_bins(df, target, bins, "_stratum")
    return train_test_split(binned, key, "_stratum", test_size, seed, checked, hashed).drop("_stratum")


def kfold(
    df: DataFrame, key: str, folds: int = FOLDS, stratum: str | None = None, seed: int = SEED, checked: bool = False, hashed: str | None = None
) -> DataFrame:
    """Add ``fold`` 1..k; the first n mod k folds hold one row more.

    ``checked`` says that the rows are part of a table whose key a split has checked; ``hashed`` names the key's ``stored_hash``.
    """
    if not checked:
        require_row_key(df, key)

    def plan(sizes):
        cuts = {}
        for value, n in sizes.items():
            ends = [n // folds * (i + 1) + min(i + 1, n % folds) for i in range(folds - 1)]
            cuts[value] = ends
        return cuts

    return _cut_by_hash(df, key, stratum, seed, plan, "fold", hashed).withColumn("fold", F.col("fold") + 1)


def split_balance(df: DataFrame, stratum: str) -> DataFrame:
    """Share of every stratum within train and within test."""
    counts = df.groupBy(F.col(stratum).alias("stratum")).agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    sums = df.agg(F.count_if(F.col("split") == "train").alias("a"), F.count_if(F.col("split") == "test").alias("b"))
    return counts.select(
        "stratum", "n_train", "n_test",
        (F.col("n_train") / sums.select("a").scalar()).alias("share_train"),
        (F.col("n_test") / sums.select("b").scalar()).alias("share_test"))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(target).alias("n"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
        F.min(target).cast("double").alias("min"), F.max(target).cast("double").alias("max"))


def _overlap(seen: DataFrame) -> DataFrame:
    """``seen``: one row per distinct key with its train and test counts."""
    return seen.agg(
        F.coalesce(F.sum("n_test"), F.lit(0)).alias("test_rows"),
        F.coalesce(F.sum(F.when(F.col("n_train") > 0, F.col("n_test"))), F.lit(0)).alias("test_rows_seen_in_train"),
    ).withColumn("pct_test_rows_seen_in_train",
                 F.bround(100 * F.col("test_rows_seen_in_train") / F.greatest("test_rows", F.lit(1)), 2))


def _sides(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(F.col("split") == "train").alias("n_train"),
                                 F.count_if(F.col("split") == "test").alias("n_test"))


def row_overlap(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Test rows whose whole feature tuple also occurs in train; one grouping, no join."""
    return _overlap(_sides(df, key_columns(df, features)))


def text_overlap(df: DataFrame, text: str) -> DataFrame:
    return _overlap(_sides(df, [F.sha2(F.coalesce(normalised_text(text), F.lit("")), 256).alias("k")]))


def id_overlap(df: DataFrame, key: str) -> DataFrame:
    """Ids that are in train and in test; 0 for a sound split."""
    return _sides(df, [F.col(key)]).agg(F.count_if((F.col("n_train") > 0) & (F.col("n_test") > 0)).alias("n_shared"))


def split_fingerprint(df: DataFrame, key: str) -> DataFrame:
    """Order-free digest per side: rows, and the sums of two 32-bit slices of md5(id).

    Sums of a row hash merge in any order, so no id list is ever assembled. The exact
    digest of a short id list is ``id_list_digest``.
    """
    h = F.md5(F.col(key).cast("string"))
    part = lambda start: F.sum(F.conv(F.substring(h, start, 8), 16, 10).cast("decimal(38,0)")).cast("string")
    return df.groupBy("split").agg(F.count("*").alias("n"), part(1).alias("sum_a"), part(9).alias("sum_b"))


def id_list_digest(df: DataFrame, key: str, max_ids: int = 1_000_000) -> str:
    """SHA-256 of the sorted test ids joined by commas; for lists of checked length."""
    test = df.where(F.col("split") == "test").select(key)
    n = test.count()
    if n > max_ids:
        raise ValueError(f"{n} ids; use split_fingerprint for tables of this size")
    return test.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.col(key))), ","), 256).alias("d")).first()["d"]
