"""Mixing sources to target weights: whole copies plus one hash-seeded coin for each document.

Sizes are words. Targets share the total size by weight; a target stops at ``max_repeats`` times its
source's size and the excess is shared again by weight, which is one water level over the sources: with
sources ordered by cap over weight, the first whose cap is above the level ends the capped part. Sums and
order over the sources are range-partitioned running totals, so sources may be many; one row (the level)
comes to the driver.

Cases: NULL text has size 0; NULL source is a source of its own, ordered last; a source of size 0 has
target 0 and takes nothing; repeated rows count and are judged one by one, repeated ids share their coin
(NULL ids too); an empty table gives an empty result; extra columns are carried by ``mix`` and never
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import word_count
from fieldloom.operators.order import running_totals
from fieldloom.session import materialise

#: Copies of the small table of sources in the join, so that a source with a third of all rows is dealt to as many tasks.
SALTS = 16


def source_key(source: str | Column) -> Column:
    """Never NULL; its code point order is that of the sources, with NULL last."""
    source = F.col(source) if isinstance(source, str) else source
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def coin(doc_id: str | Column, seed: int) -> Column:
    """Uniform in [0, 1) from the id: the first 52 bits of an MD5."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """One row per source: key, source_size, target, rate. ``sizes`` has (key, size)."""
    sums = sizes.groupBy("key").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1))
    index = F.pmod(F.col("one_before"), F.lit(len(weights))) + 1
    common = math.lcm(*weights)
    weighed = materialise(
        running_totals(sums, "key", ["one"])
        .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), index.cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("level", F.col("cap").cast("decimal(38,0)") * (F.lit(common) / F.col("weight")).cast("decimal(10,0)"))
        .withColumn("level", F.col("level").cast("decimal(38,0)"))
    )
    total, total_weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return weighed.select("key", "source_size", F.lit(0.0).alias("target"), F.lit(0.0).alias("rate"))
    levels = running_totals(weighed.groupBy("level").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight")), "level", ["cap", "weight"])
    rest, rest_weight = F.lit(total) - F.col("cap_before"), F.lit(total_weight) - F.col("weight_before")
    first = (
        levels.where(F.col("level").cast("double") * rest_weight > rest * F.lit(float(common)))
        .agg(F.min(F.struct("level", rest.alias("rest"), rest_weight.alias("rest_weight"))).alias("f")).first()["f"]
    )
    target = F.col("cap").cast("double")
    if first is not None:
        share = F.col("weight") * F.lit(first["rest"]) / F.lit(first["rest_weight"])
        target = F.when(F.col("level") < F.lit(first["level"]), target).otherwise(share.cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return weighed.withColumn("target", target).select("key", "source_size", "target", rate.alias("rate"))


def with_copies(rows: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """Add source_size, target and copies to ``rows`` (key, coin, ...): floor(rate) and one more with the rest as probability."""
    dealt = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("coin", F.lit(seed)), F.lit(SALTS)).cast("int"))
    whole = F.floor("rate")
    extra = F.when(F.col("coin") < F.col("rate") - whole, F.lit(1)).otherwise(F.lit(0))
    return rows.join(dealt, ["key", "salt"]).withColumn("copies", (whole + extra).cast("long")).drop("salt")


def mixture(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, seed: int = 42) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words taken, repeats counted)."""
    rows = materialise(docs.select("doc_id", source_key("source").alias("key"), word_count("text").alias("size"), coin("doc_id", seed).alias("coin")))
    out = with_copies(rows, source_targets(rows, weights, max_repeats), seed)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, seed: int = 42) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as its copies say, with all its columns, and ``copy`` from 1."""
    sizes = materialise(docs.select(source_key("source").alias("key"), word_count("text").alias("size")).groupBy("key").agg(F.sum("size").alias("size")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), source_key("source").alias("key"), coin("doc_id", seed).alias("coin"))
    out = with_copies(rows, source_targets(sizes, weights, max_repeats), seed)
    copy = "copy" if "copy" not in docs.columns else "copy_number"
    return out.where("copies > 0").select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy))
