"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features: densities and counts of insults (a short fixed list, and words and word beginnings that labelled
rows mark), nearness of an insult to a word in the second person, capitals, punctuation, and disguised
spellings. Labels, language, source and id are never features.

Learning takes at most ``max_rows`` labelled training rows (by hash order of the id; an explicit bound, so
that fitting costs the same at every size): the lexicon from all of them, the trees from four fifths, the
calibration from the last fifth. Scoring reads every whole text, inside its own row, without a shuffle.

Cases: NULL and empty texts have all features zero and get a score like any other; rows with a NULL id or a
label other than 0 and 1 are not learned from; of several labels of one id the highest counts; with no
training rows, or only one class, the score is that class's share (0 without rows); repeated rows are
scored one by one; extra columns are carried by ``drop_toxic`` and never looked at.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import lowest_hashes
from fieldloom.session import materialise

# Common English insults, and the second person in four languages.
INSULTS = frozenset("idiot moron stupid dumb fool loser trash garbage scum clown pathetic worthless disgusting ugly jerk creep vermin filth".split())
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre vos tú ti tus usted ustedes vosotros".split())
#: Signs and digits that stand for letters in disguised spellings.
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", **dict.fromkeys("*.-_", None)})
STEMS = (4, 5, 6)
NAMES = ("words", "insult_rate", "insult_count", "learned_rate", "learned_count", "learned_kinds", "learned_weight", "near_you", "nearest_you",
         "capitals", "capital_words", "marks", "exclamations", "runs_of_marks", "mixed_tokens", "disguised")
_RUN = re.compile(r"[^\w\s]{2,}")
_SIGNS = string.punctuation + "“”„‘’‚«»‹›–—…¿¡"


def crc_remainder(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4, F.lit(0))


def pieces(word: str) -> set[str]:
    """The word and its beginnings, as the lexicon holds them."""
    return {word, *(word[:n] + "-" for n in STEMS if len(word) >= n)}


def learn_lexicon(texts: DataFrame, least: int = 3, weight: float = 3.0, max_terms: int = 5000) -> dict[str, float]:
    """Term -> log ratio of its shares among toxic and clean texts (toxic, text); at most ``max_terms``."""

    def count(batches):
        for b in batches:
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for label, text in zip(b["toxic"].to_pylist(), b["text"].to_pylist()):
                found[label].update({p for t in set((text or "").lower().split()) if (w := t.strip(_SIGNS)) for p in pieces(w)})
            terms = sorted(set(found[0]) | set(found[1]))
            yield pa.record_batch([pa.array(terms, pa.string()), pa.array([found[1][t] for t in terms], pa.int64()), pa.array([found[0][t] for t in terms], pa.int64())],
                                  names=["term", "bad", "good"])

    totals = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    counts = texts.mapInArrow(count, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    ratio = F.log((F.col("bad") + 0.5) / (totals.get(1, 0) + 1.0)) - F.log((F.col("good") + 0.5) / (totals.get(0, 0) + 1.0))
    best = counts.where(F.col("bad") >= least).withColumn("weight", ratio).where(F.col("weight") >= weight).orderBy(F.col("weight").desc(), "term").limit(max_terms)
    return {r["term"]: float(r["weight"]) for r in best.collect()}


class Features:
    def __init__(self, lexicon: dict[str, float]):
        self.words = {t: w for t, w in lexicon.items() if not t.endswith("-")}
        self.stems = {t[:-1]: w for t, w in lexicon.items() if t.endswith("-")}
        self.heads = {t[:4] for t in (*self.words, *self.stems)}

    def weight(self, word: str) -> float:
        return max([self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEMS if len(word) >= n)])

    def of(self, text: str | None) -> list[float]:
        if not text:
            return [0.0] * len(NAMES)
        tokens = text.lower().split()
        words = [t.strip(_SIGNS) for t in tokens]
        n = max(1, len(words))
        insults = [i for i, w in enumerate(words) if w in INSULTS]
        heads = self.heads
        learned = [(i, v) for i, w in enumerate(words) if w[:4] in heads and (v := self.weight(w)) > 0]
        hits = sorted({*insults, *(i for i, _ in learned)})
        near, nearest = 0, math.inf
        if hits:
            people = [i for i, w in enumerate(words) if w in SECOND_PERSON]
            if people:
                # Between two sentinels, the nearest place is a neighbour of where the hit would stand.
                places = [-math.inf, *people, math.inf]
                gaps = [min(places[at] - i, i - places[at - 1]) for i in hits for at in (bisect_left(places, i),)]
                near, nearest = sum(g <= 8 for g in gaps), min(gaps)
        letters = sum(map(str.isalpha, text)) if not text.isascii() else len(text) - len(text.translate(_LETTERS))
        upper = len(text) - len(text.translate(_UPPER))
        marks = len(text) - len(text.translate(_MARKS))
        loud = text.count("!") + text.count("?")
        shouted = sum(1 for t in text.split() if t.isupper() and len(t) > 2)
        mixed, disguised = 0, 0
        if not text.isascii() or marks or text.translate(_DIGITS) != text:
            for t, w in zip(tokens, words):
                if not w.isalpha() and w and any(map(str.isalpha, w)):
                    mixed += 1
                    plain = w.translate(PLAIN)
                    disguised += plain != w and (plain in INSULTS or (plain[:4] in heads and self.weight(plain) > 0))
        values = [v for _, v in learned]
        return [math.log1p(len(words)), 100 * len(insults) / n, len(insults), 100 * len(learned) / n, len(learned), len({words[i] for i, _ in learned}),
                sum(values) / math.sqrt(n), near / n * 100, 1 / (1 + nearest), upper / max(1, letters), shouted / n, marks / len(text), loud / n,
                len(_RUN.findall(text)) / n if marks > 1 else 0.0, mixed / n, disguised]


_LETTERS = str.maketrans("", "", string.ascii_letters)
_UPPER = str.maketrans("", "", string.ascii_uppercase)
_MARKS = str.maketrans("", "", string.punctuation)
_DIGITS = str.maketrans("", "", string.digits)


def featurise(shared) -> Column:
    """A vectorised function from text to the feature array; ``shared`` is a broadcast ``Features``."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        found = shared.value
        return pd.Series([[float(x) for x in found.of(t)] for t in texts.tolist()], dtype=object)

    return of


class ToxicityModel:
    """Fitted trees and calibration, or one constant share where there was nothing to tell apart."""

    def __init__(self, spark, lexicon=None, trees=None, isotonic=None, constant=0.0):
        self.spark, self.lexicon, self.trees, self.isotonic, self.constant = spark, lexicon, trees, isotonic, constant

    def score(self, rows: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
        if self.trees is None:
            return rows.withColumn(out, F.lit(float(self.constant)))
        shared = self.spark.sparkContext.broadcast(Features(self.lexicon))
        rows = rows.withColumn("_features", array_to_vector(featurise(shared)(F.col(text))))
        rows = self.trees.transform(rows).withColumn("_raw", vector_to_array("_probability")[1])
        rows = self.isotonic.transform(rows)
        return rows.withColumn(out, F.least(F.greatest(F.col("_calibrated"), F.lit(0.0)), F.lit(1.0))).drop("_features", "_raw", "_calibrated", "_probability", "_margin", "_class")


def fit(docs: DataFrame, labels: DataFrame, training: Column, max_rows: int = 20_000, rounds: int = 20, depth: int = 3, seed: int = 42) -> ToxicityModel:
    """Learn from labelled rows of ``docs`` (doc_id, text) where ``training`` holds; labels (doc_id, toxic)."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = materialise(known.where(training))
    # A tenth more than wanted by hash, then the exact number: few rows meet in the task that orders them.
    likely = lowest_hashes(known, "doc_id", seed, 1.1 * max_rows / max(1, known.count()))
    known = materialise(likely.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_rows))
    rows = materialise(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"))
    share = rows.agg(F.avg("toxic")).first()[0] or 0.0
    if share in (0.0, 1.0):
        return ToxicityModel(spark, constant=share)
    lexicon = learn_lexicon(rows)
    shared = spark.sparkContext.broadcast(Features(lexicon))
    kept = rows.select("toxic", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(5)).alias("fifth"), array_to_vector(featurise(shared)(F.col("text"))).alias("_features"))
    kept = materialise(kept.withColumn("toxic", F.col("toxic").cast("double"))).coalesce(4)
    part = kept.where("fifth > 0")
    if part.agg(F.countDistinct("toxic")).first()[0] < 2:
        part = kept
    weight = F.when(F.col("toxic") == 1, F.lit((1 - share) ** 0.5)).otherwise(F.lit(share ** 0.5))
    learner = GBTClassifier(featuresCol="_features", labelCol="toxic", predictionCol="_class", weightCol="weight", maxIter=rounds, maxDepth=depth, maxBins=32,
                            stepSize=0.2, seed=seed, checkpointInterval=-1).setProbabilityCol("_probability").setRawPredictionCol("_margin")
    trees = learner.fit(part.withColumn("weight", weight))
    rest = kept.where("fifth = 0")
    if rest.agg(F.countDistinct("toxic")).first()[0] < 2:
        rest = kept
    margins = trees.transform(rest).select("toxic", vector_to_array("_probability")[1].alias("_raw"))
    isotonic = IsotonicRegression(featuresCol="_raw", labelCol="toxic", predictionCol="_calibrated").fit(margins)
    return ToxicityModel(spark, lexicon, trees, isotonic)


def held_out(doc_id: str = "doc_id") -> Column:
    return crc_remainder(doc_id) == 2


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, ~held_out())
    rows = model.score(docs.select("doc_id", "text"))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with all their columns."""
    model = fit(docs, labels, ~held_out())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    return model.score(rows, "_text", "_score").where(F.col("_score") < threshold).select("_row.*")
