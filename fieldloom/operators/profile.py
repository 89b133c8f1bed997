"""Column audits, summaries, missing values, types, distributions, quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions import scalars as S
from fieldloom.operators.duplicates import duplicate_rows
from fieldloom.operators.order import distinct_counts, exact_quantiles, grouped_quantiles


def _rows(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn one wide aggregate row into one row per struct."""
    return one_row.select(F.inline(F.array(*structs)))


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def audit_columns(df: DataFrame, distinct: str = "exact") -> DataFrame:
    """Per column: type, missing count and share, distinct values, smallest value as example.

    ``distinct="approx"`` uses a mergeable sketch and drops the shuffle of distinct values.
    """
    # Two aggregates: the smallest text cannot live in a hash table, the distinct counts can.
    facts, uniques = [F.count("*").alias("n")], []
    for i, c in enumerate(df.columns):
        key = S.content_key(F.col(f"`{c}`"), _is_text(df, c))
        facts += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}"), F.min(F.col(f"`{c}`")).alias(f"e{i}")]
        uniques.append((F.count_distinct(key) if distinct == "exact" else F.approx_count_distinct(key)).alias(f"u{i}"))
    counted = _rows(df.agg(*uniques), [
        F.struct(F.lit(i).cast("long").alias("position"), F.col(f"u{i}").alias("n_unique")) for i in range(len(df.columns))])
    return _rows(df.agg(*facts), [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.col(f"m{i}").alias("n_missing"),
            F.bround(100 * F.col(f"m{i}") / F.col("n"), 2).alias("pct_missing"),
            S.clip_example(F.col(f"e{i}").cast("string")).alias("example"),
        )
        for i, c in enumerate(df.columns)
    ]).join(counted, "position").select("position", "column", "dtype", "n_missing", "pct_missing", "n_unique", "example")


def dataset_summary(df: DataFrame, name: str, target: str | None = None, synthetic: bool | None = None) -> DataFrame:
    """Rows, columns, missing cells and repeated rows in one line."""
    missing = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    facts = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(missing), F.lit(0)).alias("missing_cells"))
    repeats = duplicate_rows(df, df.columns)
    return facts.select(
        F.lit(name).alias("dataset"),
        "rows",
        F.lit(len(df.columns)).cast("long").alias("columns"),
        "missing_cells",
        repeats.scalar().alias("exact_duplicate_rows"),
        F.lit(target).cast("string").alias("target_column"),
        F.lit(synthetic).cast("boolean").alias("synthetic"),
    )


def missing_report(df: DataFrame, columns: Sequence[str], jointly: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Missing count and share per column, and for named column sets the rows missing all of them."""
    checks = [(c, F.col(c).isNull()) for c in columns]
    for name, together in (jointly or {}).items():
        all_null = F.lit(True)
        for c in together:
            all_null = all_null & F.col(c).isNull()
        checks.append((name, all_null))
    wide = df.agg(F.count("*").alias("n"), *[F.count_if(test).alias(f"m{i}") for i, (_, test) in enumerate(checks)])
    return _rows(wide, [
        F.struct(F.lit(name).alias("column"), F.col(f"m{i}").alias("n_missing"),
                 (F.col(f"m{i}") / F.col("n")).alias("share_missing"))
        for i, (name, _) in enumerate(checks)
    ])


def type_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type, range and whole-number flag of numeric columns in schema order."""
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.min(c).cast("double").alias(f"lo{i}"),
            F.max(c).cast("double").alias(f"hi{i}"),
            F.bool_and(S.is_whole(c)).alias(f"w{i}"),
        ]
    return _rows(df.agg(*aggregates), [
        F.struct(
            F.lit(df.columns.index(c)).cast("long").alias("position"), F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"), F.col(f"w{i}").alias("whole_numbers"),
        )
        for i, c in enumerate(columns)
    ])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values as text with a flag for those that are no number."""
    text = F.col(column).cast("string")
    return (
        df.where(F.col(column).isNotNull()).select(text.alias("value")).distinct()
        .withColumn("non_numeric", S.to_number("value").isNull())
        .orderBy("value")
    )


def marker_counts(df: DataFrame, columns: Sequence[str], markers: Sequence[str] = S.MISSING_MARKERS) -> DataFrame:
    """Values that only look present, per column."""
    wide = df.agg(*[F.count_if(S.is_missing_marker(c, markers)).alias(f"m{i}") for i, c in enumerate(columns)])
    return _rows(wide, [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_markers")) for i, c in enumerate(columns)])


def product_share(df: DataFrame, total: Column, product: Column, tolerance: float = 1e-9) -> Column:
    """Share of rows on which a stored total equals the product it should be."""
    return F.avg((F.abs(total - product) < tolerance).cast("int"))


def mean_filled(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is exactly the column mean, the trace of mean imputation."""
    mean = df.agg(F.avg(column)).scalar()
    return df.agg(F.count_if(F.col(column) == mean).alias("n_equal_to_mean"))


def multi_valued(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that carry more than one value."""
    return (
        df.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where(F.col("n_values") > 1)
    )


# ---------------------------------------------------------------- distributions

def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments, exact quartiles, sample skewness and excess kurtosis, distinct values."""
    quartiles = exact_quantiles(df, {c: (0.25, 0.5, 0.75) for c in columns})
    unique = distinct_counts(df, {c: S.nan_to_null(c) for c in columns})
    aggregates = []
    for i, c in enumerate(columns):
        x = S.nan_to_null(c)
        aggregates += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
            F.skewness(x).alias(f"g1_{i}"), F.kurtosis(x).alias(f"g2_{i}"),
        ]
    structs = []
    for i, c in enumerate(columns):
        n = F.col(f"n{i}").cast("double")
        skew = F.sqrt(n * (n - 1)) / (n - 2) * F.col(f"g1_{i}")
        kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col(f"g2_{i}") + 6)
        q1, q2, q3 = quartiles[c]
        flat = F.col(f"lo{i}") == F.col(f"hi{i}")
        structs.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"mean{i}").alias("mean"),
            F.col(f"std{i}").alias("std"), F.col(f"lo{i}").alias("min"),
            F.lit(q1).cast("double").alias("q1"), F.lit(q2).cast("double").alias("median"),
            F.lit(q3).cast("double").alias("q3"), F.col(f"hi{i}").alias("max"),
            F.when(n > 2, F.when(flat, F.lit(0.0)).otherwise(skew)).alias("skew"),
            F.when(n > 3, F.when(flat, F.lit(0.0)).otherwise(kurt)).alias("excess_kurtosis"),
            F.lit(unique[c]).cast("long").alias("n_unique"),
        ))
    return _rows(df.agg(*aggregates), structs)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share per value, NULL included."""
    total = df.agg(F.count("*")).scalar()
    return (
        df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        .select("value", "n", (F.col("n") / total).alias("share"))
    )


def extreme_counts(df: DataFrame, column: str) -> DataFrame:
    """The most and the least common value (ties to the smaller value) with their counts."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("n_values"),
        F.max(F.col("n")).alias("most_common_n"),
        F.min(F.col("n")).alias("least_common_n"),
        F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias("most_common"),
        F.min_by(column, F.struct(F.col("n"), F.col(column))).alias("least_common"),
    )


def group_stats(df: DataFrame, by: str, column: str, quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """Count, mean, sample deviation and exact quantiles of a column per category."""
    quantiles = {"median": 0.5, "p90": 0.9} if quantiles is None else dict(quantiles)
    x = S.nan_to_null(column)
    moments = df.groupBy(by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    q = grouped_quantiles(df, [by], column, quantiles).withColumnRenamed(by, "_by")
    return moments.join(q, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Share per class and how many times larger the biggest class is."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    largest = counts.agg(F.max("n")).scalar()
    return counts.select("label", "n", (F.col("n") / total).alias("share"), (largest / F.col("n")).alias("majority_ratio"))


def outliers(df: DataFrame, columns: Sequence[str], fence: float = 1.5, z_limit: float = 3.0) -> DataFrame:
    """Quartile fences, values outside them, and values beyond ``z_limit`` sample deviations."""
    quartiles = exact_quantiles(df, {c: (0.25, 0.75) for c in columns})
    moments = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.avg(S.nan_to_null(c)).alias(f"mean{i}"), F.stddev_samp(S.nan_to_null(c)).alias(f"std{i}"))]).first()
    aggregates, structs = [], []
    for i, c in enumerate(columns):
        x = S.nan_to_null(c)
        q1, q3 = quartiles[c]
        if q1 is None:
            q1 = q3 = float("nan")
        low, high = q1 - fence * (q3 - q1), q3 + fence * (q3 - q1)
        aggregates += [
            F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
            F.count_if(S.outside(x, low, high)).alias(f"f{i}"),
            F.count_if(F.abs(S.zscore(x, F.lit(moments[f"mean{i}"]), F.lit(moments[f"std{i}"] or None).cast("double")))
                       > z_limit).alias(f"z{i}"),
        ]
        structs.append(F.struct(
            F.lit(c).alias("column"), F.lit(q1).alias("q1"), F.lit(q3).alias("q3"), F.lit(q3 - q1).alias("iqr"),
            F.lit(low).alias("lower_fence"), F.lit(high).alias("upper_fence"),
            F.col(f"lo{i}").alias("observed_min"), F.col(f"hi{i}").alias("observed_max"),
            F.col(f"f{i}").alias("n_outside"), F.col(f"z{i}").alias("n_beyond_z"),
        ))
    return _rows(df.agg(*aggregates), structs)


def histogram(df: DataFrame, column: str, bins: int, scale: str = "linear") -> DataFrame:
    """Equal-width bins over the observed range; ``scale`` is linear, log (log-spaced) or log1p."""
    x = S.nan_to_null(column)
    x = {"linear": x, "log": F.log10(x), "log1p": F.log1p(x)}[scale]
    values = df.select(x.alias("x")).where(F.col("x").isNotNull())
    low, high = values.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return values.select(F.lit(0).cast("long").alias("bin"), "x", "x", F.lit(0).cast("long").alias("n")).limit(0).toDF(
            "bin", "bin_low", "bin_high", "n")
    width = (high - low) / bins or 1.0
    # The last bin is closed on the right.
    index = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("long")
    return values.groupBy(index.alias("bin")).agg(F.count("*").alias("n")).select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high"), "n",
    )


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """Five numbers plus the whisker ends and the points beyond them."""
    q1, q2, q3 = exact_quantiles(df, {column: (0.25, 0.5, 0.75)})[column]
    x = S.nan_to_null(column)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = F.when(~S.outside(x, low, high), x)
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), F.min(inside).alias("whisker_low"),
                  F.max(inside).alias("whisker_high"), F.count_if(S.outside(x, low, high)).alias("n_beyond")).select(
        F.lit(column).alias("column"), "min", F.lit(q1).alias("q1"), F.lit(q2).alias("median"),
        F.lit(q3).alias("q3"), "max", "whisker_low", "whisker_high", "n_beyond")


def mean_per_value(df: DataFrame, by: str, target: str) -> DataFrame:
    return df.groupBy(F.col(by).alias("value")).agg(F.avg(target).alias("mean_target"), F.count(target).alias("n"))


def unpivot(df: DataFrame, key: str, name: str = "statistic", value: str = "value") -> DataFrame:
    """Long form (key, name, value) of a table of numbers."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, *[F.col(c).cast("double") for c in rest]).unpivot(key, rest, name, value)
