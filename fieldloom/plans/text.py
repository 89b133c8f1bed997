"""Tokens, vocabulary, TF-IDF and the reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import text as X
from fieldloom.operators import split, tfidf
from fieldloom.plans.registry import query, round_columns, rounded, table
from fieldloom.plans.splitting import REVIEWS_SQL, reviews, split_sql
from fieldloom.session import materialise

WORDS = r"regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}')"
CAP = 5000


def pairs(words: str) -> str:
    return f"list_concat({words}, [{words}[i] || ' ' || {words}[i + 1] for i in range(1, len({words}))])"


# SQL: labelled documents with their split, terms per text, and the vocabulary of the training texts.
SPLIT_SQL = f"{REVIEWS_SQL}, {split_sql('reviews', 'label')}"
TERMS_SQL = f"""{SPLIT_SQL}, worded AS (SELECT id, label, split, {WORDS} AS w FROM split_rows),
termed AS (SELECT id, label, split, {pairs('w')} AS terms FROM worded),
tf AS (SELECT id, split, term, count(*) AS tf FROM (SELECT id, split, unnest(terms) AS term FROM termed) GROUP BY ALL)"""
def vocabulary_sql(cap: int) -> str:
    return f"""{TERMS_SQL}, n AS (SELECT count(*) AS n FROM termed WHERE split = 'train'),
vocab AS (SELECT term, df, total, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf FROM n, (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total FROM tf WHERE split = 'train'
  GROUP BY term HAVING count(*) >= 2) ORDER BY total DESC, term LIMIT {cap})"""


def weights_sql(cap: int) -> str:
    return f"""{vocabulary_sql(cap)}, raw AS (SELECT id, split, term, (1 + ln(tf)) * idf AS raw FROM tf JOIN vocab USING (term)),
weights AS (SELECT id, split, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw)"""


VOCAB_SQL, WEIGHTS_SQL = vocabulary_sql(CAP), weights_sql(CAP)


def split_reviews(spark, sf_dir):
    return materialise(split.train_test_split(reviews(spark, sf_dir), "id", "label"))


def training_reviews(spark, sf_dir):
    return split_reviews(spark, sf_dir).where(F.col("split") == "train")


@query(rf"""SELECT doc_id, len(w) AS n_words, md5(array_to_string(w, ' ')) AS words, md5(array_to_string(t, '|')) AS terms
 FROM (SELECT doc_id, w, {pairs('w')} AS t FROM (SELECT doc_id, {WORDS} AS w FROM documents))""")
def tokens(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", X.tokens("text", fold=True).alias("w"))
    return df.select("doc_id", F.size("w").cast("long").alias("n_words"), F.md5(F.array_join("w", " ")).alias("words"),
                     F.md5(F.array_join(X.with_bigrams("w"), "|")).alias("terms"))


@query(f"""WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents), t AS (SELECT doc_id, unnest({pairs('w')}) AS term FROM w),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL)
SELECT count(*) AS n_entries, count(DISTINCT term) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_occurrences, max(tf) AS max_tf,
 round(sum(1 + ln(tf)), 2) AS sum_sublinear FROM tf""")
def term_frequencies(spark, sf_dir):
    tf = tfidf.term_frequencies(tfidf.with_terms(table(spark, sf_dir, "documents"), "text"), ["doc_id"])
    return tf.agg(F.count("*").alias("n_entries"), F.count_distinct("term").alias("n_terms"), F.sum("tf").alias("n_occurrences"),
                  F.max("tf").alias("max_tf"), rounded(F.sum(1 + F.log("tf")), 2).alias("sum_sublinear"))


@query(f"WITH {VOCAB_SQL} SELECT term, df, total, round(idf, 6) AS idf FROM vocab")
def vocabulary(spark, sf_dir):
    return round_columns(tfidf.vocabulary(tfidf.with_terms(training_reviews(spark, sf_dir), "text"), CAP), ["idf"])


@query(f"WITH {WEIGHTS_SQL} SELECT id, term, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, sf_dir):
    df = split_reviews(spark, sf_dir)
    vocab = tfidf.vocabulary(tfidf.with_terms(df.where(F.col("split") == "train"), "text"), CAP)
    return round_columns(tfidf.weights_long(tfidf.with_terms(df, "text"), vocab, "id"), ["weight"])


@query(f"WITH {WEIGHTS_SQL} SELECT id, term, round(weight, 6) AS weight FROM weights WHERE split = 'test'")
def tfidf_model(spark, sf_dir):
    """The same weights from the fitted pipeline stage, read back from its vectors' parts."""
    df = split_reviews(spark, sf_dir)
    model = tfidf.Tfidf(maxFeatures=CAP).fit(df.where(F.col("split") == "train"))
    names = spark.createDataFrame(list(enumerate(model.getOrDefault("vocabulary"))), "i int, term string")
    long = model.weights(df.where(F.col("split") == "test")).select(
        "id", F.inline(F.arrays_zip(F.col("_weights.indices").alias("i"), F.col("_weights.values").alias("weight"))))
    return round_columns(long.join(F.broadcast(names), "i").select("id", "term", "weight"), ["weight"])


@query(f"""WITH {TERMS_SQL}, t AS (SELECT term, sum(tf) AS total FROM tf WHERE split = 'train' GROUP BY term HAVING count(*) >= 2),
r AS (SELECT total, row_number() OVER (ORDER BY total DESC, term) AS rank FROM t), n AS (SELECT count(*) AS n FROM termed WHERE split = 'train'),
c AS (SELECT unnest([1000, 2000, 5000, 10000, 20000]) AS cap)
SELECT cap::VARCHAR AS max_features, round((SELECT sum(total) FROM r WHERE rank <= cap) / (SELECT sum(total) FROM r)::DOUBLE, 6) AS share_kept,
 round(n * cap * 4 / 1e6::DOUBLE, 6) AS dense_mb FROM c, n
UNION ALL SELECT 'full', 1.0::DOUBLE, round(n * (SELECT count(*) FROM r) * 4 / 1e6::DOUBLE, 6) FROM n""")
def vocabulary_study(spark, sf_dir):
    return round_columns(tfidf.vocabulary_study(tfidf.with_terms(training_reviews(spark, sf_dir), "text")), ["share_kept", "dense_mb"])


@query(f"""WITH {WEIGHTS_SQL}, r AS (SELECT id, count(*) AS nnz, sqrt(sum(weight * weight)) AS norm FROM weights WHERE split = 'train' GROUP BY id),
a AS (SELECT count(*) AS n FROM split_rows WHERE split = 'train')
SELECT n AS n_rows, round(sum(nnz) / n::DOUBLE, 6) AS nnz_per_row, round(1 - sum(nnz) / (n * (SELECT count(*) FROM vocab))::DOUBLE, 6) AS zero_share,
 round(min(norm), 6) AS norm_min, round(max(norm), 6) AS norm_max, n - count(*) AS empty_rows, (SELECT count(*) FROM vocab) AS n_terms FROM r, a GROUP BY n""")
def sparsity(spark, sf_dir):
    train = training_reviews(spark, sf_dir)
    return round_columns(tfidf.sparsity(train, tfidf.Tfidf(maxFeatures=CAP).fit(train)),
                         ["nnz_per_row", "zero_share", "norm_min", "norm_max"])


# Spark's English stop words without those that hold an apostrophe, which no token does.
STOPS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now cannot could ought would
""".split()


@query(f"""WITH {REVIEWS_SQL}, w AS (SELECT id, label, list_filter({WORDS}, lambda x: x NOT IN ({", ".join(f"'{s}'" for s in STOPS)})) AS w FROM reviews),
t AS (SELECT DISTINCT id, label, unnest({pairs('w')}) AS term FROM w), c AS (SELECT label, term, count(*) AS df FROM t GROUP BY ALL HAVING count(*) >= 5),
s AS (SELECT label, count(*) AS n FROM reviews GROUP BY label)
SELECT label, CAST(row_number() OVER (PARTITION BY label ORDER BY df DESC, term) AS INT) AS rank, term, df, round(df / n::DOUBLE, 6) AS share
 FROM c JOIN s USING (label) QUALIFY row_number() OVER (PARTITION BY label ORDER BY df DESC, term) <= 15""")
def top_terms(spark, sf_dir):
    df = tfidf.with_terms(reviews(spark, sf_dir), "text", stop_words=STOPS)
    return round_columns(tfidf.top_terms(df, "label"), ["share"])


@query(f"""WITH {VOCAB_SQL}, s AS (SELECT term FROM tf GROUP BY term HAVING count(*) FILTER (split = 'train') = 0)
SELECT count(*) AS n_test_only, count(*) FILTER (term IN (SELECT term FROM vocab)) AS n_in_vocabulary FROM s""")
def test_only_terms(spark, sf_dir):
    df = split_reviews(spark, sf_dir)
    terms = tfidf.with_terms(df, "text")
    return tfidf.test_only_terms(terms, tfidf.vocabulary(terms.where(F.col("split") == "train"), CAP))


@query(f"""WITH {VOCAB_SQL}, w AS (SELECT unnest(['not', 'no', 'the', 'of the']) AS term)
SELECT term, term IN (SELECT term FROM vocab) AS kept FROM w""")
def has_terms(spark, sf_dir):
    vocab = tfidf.vocabulary(tfidf.with_terms(training_reviews(spark, sf_dir), "text"), CAP)
    return tfidf.has_terms(vocab, ["not", "no", "the", "of the"])
