"""Statistics learned from training rows, and the columns built with them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations, combinations_with_replacement

from pyspark import keyword_only
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.functions.scalars import nan_to_null
from fieldloom.operators.order import exact_quantiles

MAX_LEVELS = 1_000


class LeakageError(ValueError):
    """Statistics were about to be learned from rows outside the training split."""


def require_training_rows(df: DataFrame, split: str | None = "split") -> None:
    """Every row must say 'train' in the column ``split``; None means that the caller vouches for the rows."""
    if split is None:
        return
    if split not in df.columns:
        raise LeakageError(f"no column {split!r} tells training rows from others; pass split=None to vouch for these rows")
    if not df.where(F.col(split).isNull() | (F.col(split) != "train")).isEmpty():
        raise LeakageError("fit on df.where(split = 'train'); other rows must not be learned from")


# ---------------------------------------------------------------- learned statistics

@dataclass
class Learned:
    """What a tabular preprocessor knows: a handful of numbers and level names."""

    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)

    def filled(self, column: str) -> Column:
        if column in self.medians:
            return F.coalesce(nan_to_null(column), F.lit(self.medians[column]).cast("double"))
        return F.coalesce(F.col(column).cast("string"), F.lit(self.modes[column]))

    def standardised(self, column: str) -> Column:
        return (self.filled(column) - F.lit(self.means[column])) / F.lit(self.stds[column] or 1.0)

    def encoded(self, column: str) -> list[tuple[str, Column]]:
        """0/1 columns: one for a two-level column, one per level otherwise, none set for unknown levels."""
        levels = self.levels[column]
        shown = levels[1:] if len(levels) == 2 else levels
        return [(f"{column}_{v}", (self.filled(column) == F.lit(v)).cast("double")) for v in shown]

    def columns(self, scale: bool = True) -> list[tuple[str, Column]]:
        numeric = [(c, self.standardised(c) if scale else self.filled(c)) for c in self.medians]
        return numeric + [pair for c in self.levels for pair in self.encoded(c)]


def learn(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), split: str | None = "split", max_levels: int = MAX_LEVELS) -> Learned:
    """Medians, then means and population deviations of the filled columns, modes and levels (as text).

    A column of more than ``max_levels`` levels raises: its levels become columns and come to the driver.
    """
    require_training_rows(train, split)
    known = Learned()
    if numeric:
        for c, (m,) in exact_quantiles(train, {c: (0.5,) for c in numeric}).items():
            known.medians[c] = m if m is not None else 0.0
        moments = train.agg(*[a for i, c in enumerate(numeric) for a in (
            F.avg(known.filled(c)).alias(f"m{i}"), F.stddev_pop(known.filled(c)).alias(f"s{i}"))]).first()
        for i, c in enumerate(numeric):
            known.means[c], known.stds[c] = moments[f"m{i}"], moments[f"s{i}"]
    for c in categorical:
        counts = train.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("level")).agg(F.count("*").alias("n"))
        rows = counts.orderBy(F.col("n").desc(), "level").limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels; it is not a category")
        known.modes[c] = rows[0]["level"] if rows else None
        known.levels[c] = sorted(r["level"] for r in rows)
    return known


def impute(df: DataFrame, known: Learned) -> DataFrame:
    return df.withColumns({c: known.filled(c) for c in [*known.medians, *known.modes]})


def most_frequent(train: DataFrame, column: str) -> DataFrame:
    """The most frequent value, the smallest of several; a distributed top-1."""
    return (
        train.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "value").limit(1))


def learned_statistics(full: DataFrame, train: DataFrame, known: Learned) -> DataFrame:
    """Training mean, full-table mean and learned mean side by side: the last equals the first."""
    numeric = list(known.medians)
    wide = full.agg(*[F.avg(c).alias(f"f{i}") for i, c in enumerate(numeric)])
    wide_train = train.agg(*[F.avg(known.filled(c)).alias(f"t{i}") for i, c in enumerate(numeric)])
    row = wide_train.first()
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(row[f"t{i}"]).alias("train_mean"), F.col(f"f{i}").alias("full_mean"),
                 F.lit(known.means[c]).alias("learned_mean"), F.lit(known.stds[c]).alias("learned_std"))
        for i, c in enumerate(numeric)])))


class TabularPreprocessor(Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Fill, encode, optionally scale, assemble.

    Fitting yields built-in stages only (one SQL projection and an assembler), so the
    fitted pipeline is saved and loaded without this library.
    """

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "categorical columns", TypeConverters.toListString)
    scale = Param(Params._dummy(), "scale", "standardise numeric columns", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    splitCol = Param(Params._dummy(), "splitCol", "column that marks training rows; empty: the caller vouches for them", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None, scale=True, outputCol="features", splitCol="split"):
        super().__init__()
        self._setDefault(numeric=[], categorical=[], scale=True, outputCol="features", splitCol="split")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        known = learn(dataset, self.getOrDefault("numeric"), self.getOrDefault("categorical"), self.getOrDefault("splitCol") or None)
        return assembled(known, self.getOrDefault("scale"), self.getOrDefault("outputCol"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def assembled(known: Learned, scale: bool = True, output: str = "features") -> PipelineModel:
    """The learned statistics as a pipeline of built-in stages.

    A part is named by its position and, for reading, by column and level with every sign
    but letters and digits replaced: a dot would be read as a path into a struct.
    """
    parts, names = [], []

    def name(*words: str) -> str:
        return f"_x{len(names)}_" + re.sub(r"[^0-9A-Za-z_]", "_", "_".join(words))

    for c, m in known.medians.items():
        filled = f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {m!r}D)"
        mean, std = known.means[c], known.stds[c] or 1.0
        parts.append(f"({filled} - ({mean!r}D)) / {std!r}D" if scale else filled)
        names.append(name(c))
    for c, levels in known.levels.items():
        for v in levels[1:] if len(levels) == 2 else levels:
            parts.append(f"CAST(coalesce(CAST(`{c}` AS STRING), {_sql_text(known.modes[c])}) = {_sql_text(v)} AS DOUBLE)")
            names.append(name(c, v))
    select = ", ".join(f"{p} AS `{n}`" for p, n in zip(parts, names))
    return PipelineModel([
        SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol=output),
        SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{n}`' for n in names)}) FROM __THIS__"),
    ])


# ---------------------------------------------------------------- further columns

def polynomial_terms(names: Sequence[str], degree: int, interaction_only: bool = False) -> list[tuple[str, ...]]:
    """Products of up to ``degree`` inputs, no constant."""
    pick = combinations if interaction_only else combinations_with_replacement
    return [t for d in range(1, degree + 1) for t in pick(names, d)]


def polynomial(df: DataFrame, names: Sequence[str], degree: int, interaction_only: bool = False) -> tuple[DataFrame, list[str]]:
    added = {}
    terms = polynomial_terms(names, degree, interaction_only)
    for t in terms:
        if len(t) > 1:
            value = F.col(t[0]).cast("double")
            for c in t[1:]:
                value = value * F.col(c)
            added[" ".join(t)] = value
    return df.withColumns(added), [" ".join(t) for t in terms]


def max_abs_scaled(train: DataFrame, columns: Sequence[str], split: str | None = "split") -> dict[str, Column]:
    """Each column divided by its largest absolute training value; zeros stay zero."""
    require_training_rows(train, split)
    top = train.agg(*[F.max(F.abs(c)).cast("double").alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: F.col(c) / F.lit(top[f"m{i}"] or 1.0) for i, c in enumerate(columns)}


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k n_c), one row per class."""
    counts = train.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count("*")).scalar()
    return counts.select("label", "n", (total / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, weights: DataFrame, label: str, name: str = "weight") -> DataFrame:
    rows = weights.limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} classes")
    value = F.lit(None).cast("double")
    for r in rows:
        value = F.when(F.col(label) == F.lit(r["label"]), F.lit(r["weight"])).otherwise(value)
    return df.withColumn(name, value)


# ---------------------------------------------------------------- user features

def check_row_wise(df: DataFrame, name: str, text: str) -> None:
    """Raise unless ``text`` computes a value from its own row of ``df``.

    A filter takes exactly such expressions: the analyser refuses aggregates, windows and
    generators there. Subqueries it would take, so they are refused by their keyword.
    """
    if re.search(r"\bselect\b", re.sub(r"'(?:[^'\\]|\\.)*'", "", text), re.IGNORECASE):
        raise ValueError(f"{name} holds a subquery; statistics over other rows belong in an Estimator")
    try:
        df.where(F.expr(f"({text}) IS NULL"))
    except AnalysisException as e:
        raise ValueError(f"{name} is no expression over a single row: {text}") from e


class UserColumns(Transformer, DefaultParamsWritable, DefaultParamsReadable):
    """Adds user-written columns, name -> SQL expression, in order; later ones may use earlier ones.

    The expressions are a parameter of the stage, so a stored pipeline carries them. A
    name that the table already has, or an expression that reads other rows, is an error.
    """

    expressions = Param(Params._dummy(), "expressions", "name -> SQL expression over one row", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, expressions=None):
        super().__init__()
        self._set(expressions=dict(expressions or {}))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for name, text in self.getOrDefault("expressions").items():
            if name in dataset.columns:
                raise ValueError(f"the table already has a column {name!r}")
            check_row_wise(dataset, name, text)
            dataset = dataset.withColumn(name, F.expr(text))
        return dataset
