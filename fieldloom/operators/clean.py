"""Label derivation and the cleaning sequence with its step counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions import scalars as S
from fieldloom.operators.duplicates import drop_duplicates, key_columns


def derive_label(df: DataFrame, score: str, name: str = "label", **thresholds: float) -> DataFrame:
    return df.withColumn(name, S.label_from_score(score, **thresholds))


def label_report(df: DataFrame, score: str, **thresholds: float) -> DataFrame:
    """How every raw value was handled, sorted by outcome and value."""
    raw = F.col(score).cast("string")
    return (
        df.groupBy(F.coalesce(raw, F.lit("<missing>")).alias("raw_value"),
                   S.label_outcome(raw, **thresholds).alias("outcome"))
        .agg(F.count("*").alias("n")).orderBy("outcome", "raw_value")
    )


def clean_labelled_text(
    df: DataFrame, text: str, score: str, key: Sequence[str], order_by: Sequence[str], drop: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows with text and a label, re-posts removed, plus the row count after each step.

    All step counts come from one pass over the source.
    """
    labelled = derive_label(df, score)
    has_text, has_label = F.col(text).isNotNull(), F.col("label").isNotNull()
    kept = has_text & has_label
    cleaned = drop_duplicates(labelled.where(kept), key, order_by).drop(*drop)
    counts = labelled.agg(
        F.count("*").alias("s0"), F.count_if(has_text).alias("s1"), F.count_if(kept).alias("s2"),
        F.count_distinct(F.when(kept, F.struct(*key_columns(df, key)))).alias("s3"),
    )
    names = ["raw table", f"drop rows without {text}", "keep rows with a label", f"drop re-posts ({' + '.join(key)})"]
    steps = counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).cast("long").alias("step"), F.lit(n).alias("description"), F.col(f"s{i}").alias("rows"))
        for i, n in enumerate(names)
    ])))
    return cleaned, step_differences(steps)


def step_differences(steps: DataFrame) -> DataFrame:
    """Rows removed by each step; the table has one row per step."""
    return steps.withColumn("removed", F.coalesce(F.lag("rows").over(W.orderBy("step")) - F.col("rows"), F.lit(0)))


def label_source_leakage(df: DataFrame, rederived: Column, label: str, group: str) -> DataFrame:
    """Share of rows whose label follows from another column, and the spread of the label over groups."""
    per_group = df.groupBy(group).agg(F.avg((F.col(label) == S.LABEL_NEGATIVE).cast("int")).alias("share"))
    spread = per_group.agg(F.count("*").alias("n_groups"), F.min("share").alias("min_share"), F.max("share").alias("max_share"))
    return spread.select(
        df.agg(S.agreement(rederived, F.col(label))).scalar().alias("share_rederived"), "n_groups", "min_share", "max_share")
