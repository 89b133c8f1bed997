"""Repeated rows: counts, members, removal, conflicting targets.

Every operator here aggregates per key before it shuffles, so a key that fills a
third of the table arrives at its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldloom.functions.scalars import content_key, normalised_text


def key_columns(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [content_key(F.col(f"`{c}`"), isinstance(df.schema[c].dataType, T.StringType)).alias(c) for c in columns]


def key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per key; NULL is a key value like any other."""
    return df.groupBy(*key_columns(df, columns)).agg(F.count("*").alias("n"))


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One number: rows that repeat an earlier row under the key."""
    return key_counts(df, columns).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def duplicate_report(df: DataFrame, keys: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """Repeated rows under several candidate keys (None = the whole row)."""
    report = None
    for name, columns in keys.items():
        line = duplicate_rows(df, columns or df.columns).select(
            F.lit(name).alias("key"),
            F.lit("all columns" if columns is None else ", ".join(columns)).alias("columns"),
            "n_duplicates",
        )
        report = line if report is None else report.unionByName(line)
    return report


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of every key, first meaning smallest in ``order_by``.

    The smallest (order values, digest, row) of each key is one aggregate, which combines before the
    shuffle: a hot key's rows other than its first are gone by then, and whole rows travel once and
    meet no join. Rows that tie in the order are settled by the digest of the row. Whole-number keys
    are read from the group and travel once.
    """
    if subset is None:
        return df.distinct()
    if not order_by:
        raise ValueError("order_by decides which row is first; a key alone leaves that to chance")
    keys = key_columns(df, list(subset))
    whole = {c: f"_k{i}" for i, c in enumerate(subset) if isinstance(df.schema[c].dataType, T.IntegralType)}
    rest = [c for c in df.columns if c not in order_by and c not in whole]
    place = {c: f"o{i}" for i, c in reversed(list(enumerate(order_by)))} | {c: f"c{i}" for i, c in enumerate(rest)}
    digest = F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    row = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order_by)], digest.alias("digest"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    first = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(row).alias("_first"))
    return first.select(*[F.col(f"_first.{place[c]}" if c in place else whole[c]).alias(c) for c in df.columns])


def drop_duplicates_report(df: DataFrame, cleaned: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows before and after removal and the repeats that are left (0 when it worked)."""
    before = key_counts(df, subset or df.columns).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed"),
    )
    after = key_counts(cleaned, subset or df.columns).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("a"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("left"))
    return before.select(
        F.lit("all columns" if subset is None else ", ".join(subset)).alias("key"), "rows_before", "duplicates_removed",
        after.select("a").scalar().alias("rows_after"),
        after.select("left").scalar().alias("duplicates_remaining_under_key"),
    )


def duplicate_members(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once, the first ones included.

    The repeated keys are one row each, so the semi join has a unique side; adaptive
    skew handling splits the row side of a hot key.
    """
    repeated = key_counts(df, subset).where(F.col("n") > 1).select(*[F.col(c).alias(f"_k_{c}") for c in subset])
    condition = F.lit(True)
    for key, c in zip(key_columns(df, subset), subset):
        condition = condition & key.eqNullSafe(F.col(f"_k_{c}"))
    return df.join(repeated, condition, "left_semi")


def differing_columns(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Per other column: the number of repeated keys whose rows do not all agree on it.

    Two aggregate values tell whether a group agrees: its smallest and its largest
    value, plus whether NULL is one of them. No distinct sets are built.
    """
    rest = [c for c in df.columns if c not in subset]
    aggregates = [F.count("*").alias("_n")]
    for i, c in enumerate(rest):
        v = content_key(F.col(f"`{c}`"), isinstance(df.schema[c].dataType, T.StringType))
        aggregates.append((
            (F.count_if(v.isNull()) > 0).cast("int") + F.when(F.min(v) < F.max(v), 2).otherwise((F.count(v) > 0).cast("int")) > 1
        ).alias(f"d{i}"))
    groups = df.groupBy(*key_columns(df, subset)).agg(*aggregates).where(F.col("_n") > 1)
    wide = groups.agg(F.count("*").alias("g"), *[F.count_if(f"d{i}").alias(f"d{i}") for i in range(len(rest))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n_groups_differing"), F.col("g").alias("n_groups"))
        for i, c in enumerate(rest)
    ])))


def conflicting_targets(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Feature combinations that occur again, and those seen with different targets."""
    groups = df.groupBy(*key_columns(df, features)).agg(
        F.count("*").alias("n"), (F.min(target) < F.max(target)).alias("conflict"))
    return groups.agg(
        F.count("*").alias("n_combinations"),
        F.count_if(F.col("n") > 1).alias("n_repeated"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_repeat_rows"),
        F.count_if("conflict").alias("n_conflicting"),
    )


def duplicate_texts(df: DataFrame, text: str, label: str) -> DataFrame:
    """Texts equal after trimming and lower-casing: groups, rows in them, groups with both labels."""
    groups = df.groupBy(content_key(normalised_text(text), True).alias("k")).agg(
        F.count("*").alias("n"), (F.min(label) < F.max(label)).alias("mixed"))
    return groups.where(F.col("n") > 1).agg(
        F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if("mixed").alias("n_groups_with_both_labels"))
