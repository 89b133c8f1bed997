"""Pearson and Spearman matrices, correlation with the target, leakage flags."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.scalars import nan_to_null
from fieldloom.operators.gram import grams, r2_from_others
from fieldloom.operators.order import average_ranks, distinct_counts
from fieldloom.session import materialise

# From these limits on a column counts as identifier, leak or redundant.
IDENTIFIER_RATIO = 0.95
LEAKAGE_R = 0.99
REDUNDANT_R2 = 0.99


def _both_ways(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    spark = pairs.sparkSession
    diagonal = spark.createDataFrame([(c, c, 1.0) for c in columns], "a string, b string, r double")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")).unionByName(diagonal)


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (a, b, r) of the full matrix; one pass, pairs with a NULL left out pairwise."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(nan_to_null(a), nan_to_null(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)])))
    return _both_ways(long, columns)


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation, pairwise complete, ties averaged.

    Works on distinct value pairs with their counts, and on ranks from range-partitioned
    running totals. A column without missing values is ranked once for all its pairs; only
    pairs with a missing value on some side are ranked over the rows they share.
    """
    pairs = list(combinations(columns, 2))
    holes = df.agg(*[F.count_if(nan_to_null(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    whole = [c for i, c in enumerate(columns) if holes[f"n{i}"] == 0]
    shared = [i for i, p in enumerate(pairs) if set(p) <= set(whole)]
    apart = [i for i in range(len(pairs)) if i not in shared]

    def values(numbers):
        return F.inline(F.array(*[F.struct(F.lit(i).alias("pair"), nan_to_null(pairs[i][0]).alias("x"), nan_to_null(pairs[i][1]).alias("y")) for i in numbers]))

    cells = (
        df.select(values(range(len(pairs)))).where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("pair", "x", "y").agg(F.count("*").alias("n"))
    )
    ranks = []
    if shared:
        used = [c for c in whole if any(c in pairs[i] for i in shared)]
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), nan_to_null(c).alias("v")) for c in used])))
        places = [(i, side, c) for i in shared for side, c in zip("xy", pairs[i])]
        where = df.sparkSession.createDataFrame(places, "pair int, side string, column string")
        ranks.append(average_ranks(long, "v", ["column"]).join(F.broadcast(where), "column").select("pair", "side", "v", "avg_rank"))
    if apart:
        sides = df.select(values(apart)).where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(
            "pair", F.inline(F.array(F.struct(F.lit("x").alias("side"), F.col("x").alias("v")),
                                     F.struct(F.lit("y").alias("side"), F.col("y").alias("v")))))
        ranks.append(average_ranks(sides, "v", ["pair", "side"]).select("pair", "side", "v", "avg_rank"))
    ranks = materialise(ranks[0] if len(ranks) == 1 else ranks[0].unionByName(ranks[1]))
    rank_of = lambda side: ranks.where(F.col("side") == side).select(
        "pair", F.col("v").alias(side), F.col("avg_rank").alias(f"r{side}"))
    cells = materialise(cells)
    placed = cells.join(rank_of("x"), ["pair", "x"]).join(rank_of("y"), ["pair", "y"])
    totals = cells.groupBy("pair").agg(F.sum("n").alias("total"))
    centred = placed.join(F.broadcast(totals), "pair").select(
        "pair", "n", (F.col("rx") - (F.col("total") + 1) / 2).alias("x"), (F.col("ry") - (F.col("total") + 1) / 2).alias("y"))
    n = F.col("n")
    result = centred.groupBy("pair").agg(
        (F.sum(n * F.col("x") * F.col("y"))
         / F.sqrt(F.sum(n * F.col("x") * F.col("x")) * F.sum(n * F.col("y") * F.col("y")))).alias("r"))
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, a string, b string")
    return _both_ways(result.join(F.broadcast(names), "pair").select("a", "b", "r"), columns)


def corr_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    wide = df.agg(*[F.corr(nan_to_null(c), nan_to_null(target)).alias(f"r{i}") for i, c in enumerate(columns)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r"), F.abs(F.col(f"r{i}")).alias("abs_r"))
        for i, c in enumerate(columns)]))).orderBy(F.col("abs_r").desc_nulls_last(), "column")


def strongest_pair(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The two columns with the largest |r|."""
    return (
        pearson_matrix(df, columns).where(F.col("a") < F.col("b"))
        .orderBy(F.abs("r").desc_nulls_last(), "a", "b").limit(1)
    )


def leakage_check(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Identifier, leakage and redundancy flags per numeric feature."""
    gram, unique = grams(df, columns, target)[None], distinct_counts(df, {c: F.col(c) for c in columns})
    aggregates = [F.count("*").alias("n")]
    for i, c in enumerate(columns):
        aggregates.append(F.corr(nan_to_null(c), nan_to_null(target)).alias(f"r{i}"))
    structs = []
    for i, c in enumerate(columns):
        r2 = r2_from_others(gram, i)
        ratio, r = F.lit(unique[c]) / F.col("n"), F.abs(F.col(f"r{i}"))
        structs.append(F.struct(
            F.lit(c).alias("column"), F.lit(unique[c]).cast("long").alias("n_unique"), ratio.alias("unique_ratio"), r.alias("abs_r"),
            F.lit(r2).alias("r2_from_others"), (ratio > IDENTIFIER_RATIO).alias("identifier"),
            (r >= LEAKAGE_R).alias("leakage"), F.lit(r2 >= REDUNDANT_R2).alias("redundant")))
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))
