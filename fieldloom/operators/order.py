"""Global order without a global task: running totals, average ranks, exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions.scalars import nan_to_null
from fieldloom.session import materialise

# Up to this many rows one window task sorts comfortably; beyond it the range-partitioned form is used.
WINDOW_ROWS = 200_000
SKETCH_ACCURACY = 10_000


def running_totals(
    totals: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``<s>_before`` for each column of ``sums``: its total over all smaller values.

    ``totals`` has one row per (by, value), as a group-by leaves it, so a value that
    fills a third of the table is one row here. The rows are range-partitioned by
    (by, value); each partition needs only the totals of the partitions before it, a
    table of one row per (partition, by) pair. The partition number is stored with the
    rows because range bounds come from a sample and may differ if computed again.
    """
    by = list(by)
    order = F.col(value).desc() if descending else F.col(value).asc()
    spark = totals.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        totals.repartitionByRange(parts, *[F.col(b) for b in by], order).withColumn("_part", F.spark_partition_id())
    )
    groups = [*by, "_part"]
    part_totals = placed.groupBy(*groups).agg(*[F.sum(s).alias(f"_{s}_part") for s in sums])
    earlier = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = part_totals.select(
        *groups, *[F.coalesce(F.sum(f"_{s}_part").over(earlier), F.lit(0)).alias(f"_{s}_offset") for s in sums]
    )
    inside = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    local = placed.select("*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_{s}_local") for s in sums])
    joined = local.join(offsets.select(*[F.col(c).alias(f"_o_{c}") for c in offsets.columns]),
                        _same(groups, [f"_o_{c}" for c in groups]), "inner")
    return joined.select(
        *totals.columns,
        *[(F.col(f"_{s}_local") + F.col(f"_o__{s}_offset")).alias(f"{s}_before") for s in sums],
    )


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def distinct_counts(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, int]:
    """Exact number of distinct non-NULL values of each column, apart from other aggregates.

    (position, value) pairs are grouped, which combines before the shuffle, and then
    counted by position; the moments of the same rows need no copy of them for it.
    """
    counts = dict.fromkeys(columns, 0)
    kinds: dict[str, list[str]] = {}
    for name, c in columns.items():
        kinds.setdefault(df.select(c.alias("v")).schema["v"].dataType.simpleString(), []).append(name)
    for names in kinds.values():  # one pass for the columns of each type
        pairs = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), columns[n].alias("v")) for i, n in enumerate(names)])))
        rows = pairs.where(F.col("v").isNotNull()).groupBy("i", "v").agg(F.lit(1).alias("one")).groupBy("i").agg(F.count("*").alias("n"))
        counts.update({names[r["i"]]: r["n"] for r in rows.collect()})
    return counts


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, value) with its count ``n`` and tie-averaged rank ``avg_rank``."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    return running_totals(counts, value, ["n"], by).select(
        *by, value, "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("avg_rank")
    )


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of several columns.

    1. One pass builds mergeable sketches and gives, per target, a bracket of values.
    2. One pass counts, per target, the rows below and inside its bracket.
    3. One pass with the brackets as pushed-down filters counts the distinct values
       inside them, a few rows in ten thousand, and picks the wanted ranks.
    No step moves the column itself, and the counts of step 2 prove each bracket.
    """
    columns = list(wanted)
    # Plain columns, so that the brackets reach the scan; NaN lies outside every bracket.
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    margin = 3.0 / accuracy
    sketches = []
    for i, c in enumerate(columns):
        edges = [max(0.0, p - margin) for p in wanted[c]] + [min(1.0, p + margin) for p in wanted[c]]
        x = nan_to_null(f"c{i}")
        sketches += [F.count(x).alias(f"n{i}"), F.percentile_approx(x, edges, accuracy).alias(f"q{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    sketch = numbers.agg(*sketches).first()

    targets = []
    for i, c in enumerate(columns):
        n, edges = sketch[f"n{i}"], sketch[f"q{i}"]
        for j, p in enumerate(wanted[c]):
            if n == 0:
                targets.append(None)
                continue
            position = (n - 1) * p
            first = min(math.floor(position + 1e-9), n - 1)
            share = max(position - first, 0.0)
            small = n <= accuracy
            known = {0.0: {0: sketch[f"lo{i}"]}, 1.0: {n - 1: sketch[f"hi{i}"]}}.get(p)
            if known:
                targets.append({"first": first, "second": min(first + 1, n - 1), "share": 0.0, "values": known})
                targets[-1]["second"] = first
                continue
            targets.append({
                "column": i, "first": first, "second": min(first + 1, n - 1), "share": share,
                "low": -math.inf if small else edges[j], "high": math.inf if small else edges[len(wanted[c]) + j],
                "size": n if small else None, "values": {},
            })
    live = [t for t in targets if t is not None and "column" in t]
    if live:
        _locate(numbers, live)
    results, k = {}, 0
    for c in columns:
        results[c] = []
        for _ in wanted[c]:
            t = targets[k]
            k += 1
            if t is None:
                results[c].append(None)
            else:
                a, b = t["values"][t["first"]], t["values"][t["second"]]
                results[c].append(a + (b - a) * t["share"])
    return results


def _locate(numbers: DataFrame, targets: list[dict]) -> None:
    """Fill ``values`` (rank -> value) of every target."""
    # A short column is searched whole, and its size is known from the sketch pass.
    below = {(t["column"], -math.inf, math.inf): 0 for t in targets if t.get("size")}
    inside = {(t["column"], -math.inf, math.inf): t["size"] for t in targets if t.get("size")}
    brackets = sorted({(t["column"], t["low"], t["high"]) for t in targets} - set(inside))
    if brackets:
        measured = numbers.agg(*[
            agg
            for k, (i, low, high) in enumerate(brackets)
            for agg in (
                F.count_if(F.col(f"c{i}") < low).alias(f"below{k}"),
                F.count_if(F.col(f"c{i}").between(low, high)).alias(f"inside{k}"),
            )
        ]).first()
        below.update({b: measured[f"below{k}"] for k, b in enumerate(brackets)})
        inside.update({b: measured[f"inside{k}"] for k, b in enumerate(brackets)})

    again, open_brackets = [], {}
    for t in targets:
        bracket = (t["column"], t["low"], t["high"])
        start, stop = below[bracket], below[bracket] + inside[bracket]
        if not (start <= t["first"] and t["second"] < stop):
            # The sketch promised more than it kept: search everything on the side that is missing.
            if t["first"] < start:
                t["low"] = -math.inf
            if t["second"] >= stop:
                t["high"] = math.inf
            again.append(t)
        elif t["low"] == t["high"]:
            t["values"] = {t["first"]: t["low"], t["second"]: t["low"]}
        else:
            open_brackets.setdefault(bracket, []).append(t)
    if open_brackets:
        keys = list(open_brackets)
        matches = F.array(*[
            F.when(F.col(f"c{i}").between(low, high), F.struct(F.lit(k).alias("bracket"), F.col(f"c{i}").alias("value")))
            for k, (i, low, high) in enumerate(keys)
        ])
        in_any = F.lit(False)
        for i, low, high in keys:
            in_any = in_any | F.col(f"c{i}").between(low, high)
        counts = (
            numbers.where(in_any)
            .select(F.inline(F.filter(matches, lambda m: m.isNotNull())))
            .groupBy("bracket", "value")
            .agg(F.count("*").alias("n"))
        )
        if max(inside[b] for b in keys) <= WINDOW_ROWS:
            earlier = W.partitionBy("bracket").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
            ranked = counts.withColumn("n_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        else:
            ranked = running_totals(counts, "value", ["n"], ["bracket"])
        hit = F.lit(False)
        for k, b in enumerate(keys):
            for r in sorted({r for t in open_brackets[b] for r in (t["first"], t["second"])}):
                rank = r - below[b]
                hit = hit | ((F.col("bracket") == k) & (F.col("n_before") <= rank) & (F.col("n_before") + F.col("n") > rank))
        # At most two rows per target pass this filter.
        for row in ranked.where(hit).collect():
            b = keys[row["bracket"]]
            for t in open_brackets[b]:
                for r in (t["first"], t["second"]):
                    if row["n_before"] <= r - below[b] < row["n_before"] + row["n"]:
                        t["values"][r] = row["value"]
    if again:
        _locate(numbers, again)


def grouped_quantiles(df: DataFrame, by: Sequence[str], column: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact quantiles per group, one column per entry of ``probs`` (name -> probability).

    Works on the distinct values of each group, so a group holding a third of the
    table spreads over many range partitions instead of filling one task.
    """
    by = list(by)
    values = df.select(*by, nan_to_null(column).alias("_value")).where(F.col("_value").isNotNull())
    counts = values.groupBy(*by, "_value").agg(F.count("*").alias("n"))
    ranked = running_totals(counts, "_value", ["n"], by)
    sizes = values.groupBy(*by).agg(F.count("*").alias("_size"))
    placed = ranked.join(sizes.select(*[F.col(c).alias(f"_s_{c}") for c in by], "_size"),
                         _same(by, [f"_s_{c}" for c in by]))
    aggregates = []
    for name, p in probs.items():
        position = (F.col("_size") - 1) * F.lit(float(p))
        for tag, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            covers = (F.col("n_before") <= rank) & (F.col("n_before") + F.col("n") > rank)
            aggregates.append(F.max(F.when(covers, F.col("_value"))).alias(f"_{name}_{tag}"))
    picked = placed.groupBy(*by, "_size").agg(*aggregates)
    return picked.select(*by, *[
        (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo"))
         * ((F.col("_size") - 1) * F.lit(float(p)) - F.floor((F.col("_size") - 1) * F.lit(float(p))))).alias(n)
        for n, p in probs.items()
    ])


def ranked(df: DataFrame, metric: str, tie: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Number the rows of a small result table by a metric, ties by a second column."""
    order = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()
    return df.withColumn(name, F.row_number().over(W.orderBy(order, F.col(tie).asc())).cast("long"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the seeded hash order; a distributed top-n, the same rows on any layout."""
    from fieldloom.functions.scalars import order_hash

    return df.orderBy(order_hash(key, seed), F.col(key)).limit(n)


def top_and_bottom(df: DataFrame, metric: str, tie: str, n: int) -> DataFrame:
    """The n largest and n smallest rows with a ``direction`` column."""
    top = df.orderBy(F.col(metric).desc_nulls_last(), tie).limit(n).withColumn("direction", F.lit("top"))
    bottom = df.orderBy(F.col(metric).asc_nulls_last(), tie).limit(n).withColumn("direction", F.lit("bottom"))
    return top.unionByName(bottom)
