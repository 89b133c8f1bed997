"""TF-IDF with a vocabulary learned from training rows.

Terms are counted inside each row, so learning shuffles one row per term and map task,
and weighting shuffles nothing: counts, weights and the norm of a text are row-local.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.functions import text as X
from fieldloom.operators.features import require_training_rows

# Vocabulary cap, smallest document count of a term, sizes of the vocabulary study.
MAX_FEATURES = 5_000
MIN_DF = 2
STUDY_CAPS = (1_000, 2_000, 5_000, 10_000, 20_000)
MAX_DENSE_MB = 400

# A driver-side vocabulary is refused beyond this many terms; the long form has no such limit.
MAX_MODEL_TERMS = 1_000_000


def with_terms(df: DataFrame, text: str, ngrams: int = 2, fold: bool = True, stop_words: Sequence[str] = ()) -> DataFrame:
    """Add ``terms``: the words, or words and neighbour pairs, of each text; stop words go first."""
    words = df.withColumn("_words", X.tokens(text, fold))
    if stop_words:
        stops = F.lit(np.array(sorted(stop_words)))
        words = words.withColumn("_words", F.filter("_words", lambda w: ~F.array_contains(stops, w)))
    words = words.withColumn("terms", X.with_bigrams("_words") if ngrams == 2 else F.col("_words"))
    return words.withColumn("terms", F.coalesce("terms", F.array().cast("array<string>"))).drop("_words")


def term_frequencies(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., term, tf) of a frame with ``terms``; no shuffle.

    The outer generator keeps the optimizer from inferring a filter on the array, which
    it would push below the sort and so evaluate the sort once per element.
    """
    ordered = df.withColumn("_sorted", F.sort_array("terms"))
    counted = ordered.withColumn("_counts", X.term_counts("_sorted"))
    return counted.select(*keep, F.inline_outer("_counts")).where(F.col("term").isNotNull())


def distinct_terms(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long form (keep..., term): every term of a text once."""
    return df.select(*keep, F.explode_outer(F.array_distinct("terms")).alias("term")).where(F.col("term").isNotNull())


def term_totals(df: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """Per term the texts it occurs in (``df``) and its occurrences (``total``)."""
    return term_frequencies(df).groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_df)


def vocabulary(df: DataFrame, max_features: int | None = MAX_FEATURES, min_df: int = MIN_DF) -> DataFrame:
    """Terms (term, df, total, idf) learned from ``df``: the most frequent ones, ties to the smaller term."""
    n = df.agg(F.count("*")).scalar()
    terms = term_totals(df, min_df)
    if max_features is not None:
        terms = terms.orderBy(F.col("total").desc(), F.col("term")).limit(max_features)
    return terms.select("term", "df", "total", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def weights_long(df: DataFrame, vocab: DataFrame, key: str, sublinear: bool = True) -> DataFrame:
    """(key, term, weight) with unit rows, for a vocabulary of any size.

    A vocabulary that fits a broadcast is broadcast by the planner's own size check;
    a larger one is shuffled on the term, and frequent terms are split as skewed.
    """
    tf = F.col("tf").cast("double")
    raw = term_frequencies(df, [key]).join(vocab.select("term", "idf"), "term").select(
        key, "term", ((1 + F.log(tf) if sublinear else tf) * F.col("idf")).alias("raw"))
    # One text is one bounded group: at most its own distinct terms.
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / norm).alias("weight"))


@F.udf(returnType=VectorUDT(), useArrow=True)
def _sparse(size, indices, values):
    return SparseVector(size, list(indices), list(values))


class TfidfModel(Model, DefaultParamsWritable, DefaultParamsReadable):
    """Fitted vocabulary; adds a sparse unit vector per text without a shuffle."""

    inputCol = Param(Params._dummy(), "inputCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    vocabulary = Param(Params._dummy(), "vocabulary", "terms in index order", TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "inverse document frequencies", TypeConverters.toListFloat)
    ngrams = Param(Params._dummy(), "ngrams", "1 words, 2 words and pairs", TypeConverters.toInt)
    foldAccents = Param(Params._dummy(), "foldAccents", "strip accents", TypeConverters.toBoolean)
    sublinear = Param(Params._dummy(), "sublinear", "1 + ln(tf) in place of tf", TypeConverters.toBoolean)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(ngrams=2, foldAccents=True, sublinear=True, outputCol="features", inputCol="text")
        self._set(**values)

    def weights(self, dataset: DataFrame) -> DataFrame:
        """Add ``_weights``: struct of ascending term indices and unit-length weights."""
        get = self.getOrDefault
        counted = CountVectorizerModel.from_vocabulary(get("vocabulary"), "terms", "_tf").transform(
            with_terms(dataset, get("inputCol"), get("ngrams"), get("foldAccents"))).withColumn("_tf", F.unwrap_udt("_tf"))
        idf = F.lit(np.array(get("idf"), dtype="float64"))
        tf = (lambda c: 1 + F.log(c)) if get("sublinear") else (lambda c: c)
        raw = F.zip_with("_tf.values", "_tf.indices", lambda c, i: tf(c) * F.get(idf, i))
        counted = counted.withColumn("_raw", raw)
        norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda a, w: a + w * w))
        # Bound by an outer transform: as a column the norm would be merged into the inner one and summed anew for every weight.
        values = F.get(F.transform(F.array(norm), lambda n: F.transform("_raw", lambda w: w / n)), 0)
        return counted.withColumn("_weights", F.struct(
            F.col("_tf.indices").alias("indices"), values.alias("values"),
        )).drop("terms", "_tf", "_raw")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size = len(self.getOrDefault("vocabulary"))
        weighed = self.weights(dataset).withColumns({"_indices": F.col("_weights.indices"), "_values": F.col("_weights.values")})
        # Asked for twice, the weights stay a column of their own: Spark may fail to find a Python function with nested lambdas among its arguments.
        vector = F.when(F.col("_values").isNotNull(), _sparse(F.lit(size), "_indices", "_values"))
        return weighed.withColumn(self.getOrDefault("outputCol"), vector).drop("_weights", "_indices", "_values")


class Tfidf(Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Learns a capped vocabulary; lower case, accents folded, words and pairs, no stop words."""

    inputCol = Param(Params._dummy(), "inputCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary cap", TypeConverters.toInt)
    minDf = Param(Params._dummy(), "minDf", "smallest document count of a term", TypeConverters.toInt)
    ngrams = Param(Params._dummy(), "ngrams", "1 words, 2 words and pairs", TypeConverters.toInt)
    foldAccents = Param(Params._dummy(), "foldAccents", "strip accents", TypeConverters.toBoolean)
    sublinear = Param(Params._dummy(), "sublinear", "1 + ln(tf) in place of tf", TypeConverters.toBoolean)
    splitCol = Param(Params._dummy(), "splitCol", "column that marks training rows; empty: the caller vouches for them", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="features", maxFeatures=MAX_FEATURES, minDf=MIN_DF, ngrams=2,
                 foldAccents=True, sublinear=True, splitCol="split"):
        super().__init__()
        self._set(**{**dict(inputCol="text", outputCol="features", maxFeatures=MAX_FEATURES, minDf=MIN_DF, ngrams=2,
                            foldAccents=True, sublinear=True, splitCol="split"), **self._input_kwargs})

    def _fit(self, dataset: DataFrame) -> TfidfModel:
        get = self.getOrDefault
        require_training_rows(dataset, get("splitCol") or None)
        if get("maxFeatures") > MAX_MODEL_TERMS:
            raise ValueError("use vocabulary() and weights_long() for vocabularies of this size")
        terms = with_terms(dataset, get("inputCol"), get("ngrams"), get("foldAccents"))
        rows = sorted(vocabulary(terms, get("maxFeatures"), get("minDf")).select("term", "idf").collect(), key=lambda r: r["term"])
        return TfidfModel(
            inputCol=get("inputCol"), outputCol=get("outputCol"), vocabulary=[r["term"] for r in rows],
            idf=[r["idf"] for r in rows], ngrams=get("ngrams"), foldAccents=get("foldAccents"), sublinear=get("sublinear"))


# ---------------------------------------------------------------- reports

def dense_megabytes(rows: int, columns: int) -> float:
    return rows * columns * 4 / 1e6


def check_dense(rows: int, columns: int, limit: float = MAX_DENSE_MB) -> None:
    """Refuse a dense copy larger than ``limit`` megabytes (2**20 bytes)."""
    needed = rows * columns * 4 / 2**20
    if needed > limit:
        raise MemoryError(f"a dense {rows} x {columns} copy takes {needed:.0f} MB, more than {limit} MB")


def vocabulary_study(df: DataFrame, caps: Sequence[int] = STUDY_CAPS, min_df: int = MIN_DF) -> DataFrame:
    """Share of occurrences kept, and dense size, per vocabulary cap and for the full vocabulary."""
    totals = term_totals(df, min_df)
    n_rows = df.agg(F.count("*")).scalar()
    everything = totals.agg(F.sum("total").alias("all"), F.count("*").alias("size"))
    # The ranked part is at most max(caps) rows.
    head = totals.orderBy(F.col("total").desc(), "term").limit(max(caps)).withColumn(
        "rank", F.row_number().over(W.orderBy(F.col("total").desc(), "term")))
    kept = head.agg(*[F.sum(F.when(F.col("rank") <= c, F.col("total"))).alias(f"k{c}") for c in caps])
    one = kept.select("*", everything.select("all").scalar().alias("all"), everything.select("size").scalar().alias("size"),
                      n_rows.alias("n"))
    lines = [F.struct(F.lit(str(c)).alias("max_features"), (F.col(f"k{c}") / F.col("all")).alias("share_kept"),
                      (F.col("n") * c * 4 / 1e6).alias("dense_mb")) for c in caps]
    lines.append(F.struct(F.lit("full").alias("max_features"), F.lit(1.0).alias("share_kept"),
                          (F.col("n") * F.col("size") * 4 / 1e6).alias("dense_mb")))
    return one.select(F.inline(F.array(*lines)))


def sparsity(df: DataFrame, model: TfidfModel) -> DataFrame:
    """Non-zero entries per row, zero share, norms and rows without any known term; one pass, no shuffle of entries."""
    size = len(model.getOrDefault("vocabulary"))
    w = model.weights(df).select(
        F.size("_weights.indices").alias("nnz"),
        F.sqrt(F.aggregate("_weights.values", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))
    filled = F.when(F.col("nnz") > 0, F.col("norm"))
    return w.agg(
        F.count("*").alias("n_rows"), F.avg("nnz").alias("nnz_per_row"),
        (1 - F.sum("nnz") / (F.count("*") * F.lit(float(size)))).alias("zero_share"),
        F.min(filled).alias("norm_min"), F.max(filled).alias("norm_max"),
        F.count_if(F.col("nnz") == 0).alias("empty_rows")).withColumn("n_terms", F.lit(size).cast("long"))


def top_terms(df: DataFrame, label: str, n: int = 15, min_df: int = 5) -> DataFrame:
    """Terms found in the largest share of each class's texts; ``df`` has ``terms``."""
    sizes = df.groupBy(label).agg(F.count("*").alias("_size"))
    counts = (
        distinct_terms(df, [label]).groupBy(label, "term")
        .agg(F.count("*").alias("df")).where(F.col("df") >= min_df))
    order = W.partitionBy(label).orderBy(F.col("df").desc(), F.col("term"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.join(sizes, label).select(label, "rank", "term", "df", (F.col("df") / F.col("_size")).alias("share"))


def test_only_terms(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """Terms seen in test texts only, and how many of them are in the fitted vocabulary (0 when fitted on train)."""
    sides = distinct_terms(df, ["split"]).groupBy("term").agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    only = sides.where((F.col("n_train") == 0) & (F.col("n_test") > 0)).select("term")
    inside = only.join(vocab.select("term"), "term", "left_semi")
    return only.agg(F.count("*").alias("n_test_only")).select(
        "n_test_only", inside.agg(F.count("*")).scalar().alias("n_in_vocabulary"))


def has_terms(vocab: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Whether given terms, such as negations, are in the vocabulary."""
    found: list[Column] = [F.max((F.col("term") == w).cast("int")).alias(f"t{i}") for i, w in enumerate(wanted)]
    wide = vocab.where(F.col("term").isin(*wanted)).agg(*found)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(w).alias("term"), (F.coalesce(F.col(f"t{i}"), F.lit(0)) == 1).alias("kept")) for i, w in enumerate(wanted)])))
