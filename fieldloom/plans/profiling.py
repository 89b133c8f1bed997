"""Audits, summaries, distributions, outliers, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldloom.functions import scalars as S
from fieldloom.operators import correlation, order, profile
from fieldloom.plans.registry import query, round_columns, rounded, table


def _documents_with_labels(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def _audit_sql(source: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, dtype) in enumerate(columns):
        example = f"CAST(min({c}) AS VARCHAR)"
        parts.append(
            f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{dtype}' AS dtype, "
            f"count(*) - count({c}) AS n_missing, "
            f"round_even(100.0::DOUBLE * (count(*) - count({c})) / count(*), 2) AS pct_missing, "
            f"count(DISTINCT {c}) AS n_unique, "
            f"CASE WHEN length({example}) > 60 THEN left({example}, 57) || '...' ELSE {example} END AS example FROM src")
    return f"WITH src AS ({source}) " + " UNION ALL ".join(parts)


@query(_audit_sql(
    "SELECT doc_id, text, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
    [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
     ("quality", "int"), ("toxic", "int")]))
def column_audit(spark, sf_dir):
    df = _documents_with_labels(spark, sf_dir).select(
        "doc_id", "text", "lang", "source", "n_chars", F.col("quality").cast("int").alias("quality"),
        F.col("toxic").cast("int").alias("toxic"))
    return profile.audit_columns(df)


@query("""
WITH src AS (SELECT d.doc_id, text, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))
SELECT 'documents' AS dataset, count(*) AS "rows", CAST(7 AS BIGINT) AS "columns",
       CAST(sum((text IS NULL)::INT + (quality IS NULL)::INT + (toxic IS NULL)::INT + (lang IS NULL)::INT
            + (source IS NULL)::INT + (n_chars IS NULL)::INT + (doc_id IS NULL)::INT) AS BIGINT) AS missing_cells,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS exact_duplicate_rows,
       'quality' AS target_column, true AS synthetic FROM src""")
def dataset_summary(spark, sf_dir):
    return profile.dataset_summary(_documents_with_labels(spark, sf_dir), "documents", "quality", True)


@query("""
WITH src AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)), t AS (SELECT count(*) AS n FROM src)
SELECT 'text' AS "column", count(*) FILTER (text IS NULL) AS n_missing, round(count(*) FILTER (text IS NULL) / count(*)::DOUBLE, 6) AS share_missing FROM src
UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL), round(count(*) FILTER (quality IS NULL) / count(*)::DOUBLE, 6) FROM src
UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL), round(count(*) FILTER (toxic IS NULL) / count(*)::DOUBLE, 6) FROM src
UNION ALL SELECT 'quality and toxic', count(*) FILTER (quality IS NULL AND toxic IS NULL),
  round(count(*) FILTER (quality IS NULL AND toxic IS NULL) / count(*)::DOUBLE, 6) FROM src""")
def missing_report(spark, sf_dir):
    report = profile.missing_report(_documents_with_labels(spark, sf_dir), ["text", "quality", "toxic"],
                                    {"quality and toxic": ["quality", "toxic"]})
    return round_columns(report, ["share_missing"])


@query(" UNION ALL ".join(
    f"""SELECT CAST({p} AS BIGINT) AS position, '{c}' AS "column", '{t}' AS dtype, CAST(min({c}) AS DOUBLE) AS "min",
        CAST(max({c}) AS DOUBLE) AS "max", bool_and({c} = round({c})) AS whole_numbers FROM lineitem"""
    for p, c, t in [(3, "l_linenumber", "int"), (4, "l_quantity", "double"), (5, "l_extendedprice", "double"),
                    (6, "l_discount", "double")]))
def type_ranges(spark, sf_dir):
    return profile.type_ranges(table(spark, sf_dir, "lineitem"), ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount"])


@query("""SELECT DISTINCT CAST(l_discount AS VARCHAR) AS "value", try_cast(CAST(l_discount AS VARCHAR) AS DOUBLE) IS NULL AS non_numeric
          FROM lineitem WHERE l_discount IS NOT NULL
          UNION ALL SELECT DISTINCT o_orderpriority, try_cast(o_orderpriority AS DOUBLE) IS NULL FROM orders WHERE o_orderpriority IS NOT NULL""")
def distinct_values(spark, sf_dir):
    return profile.distinct_values(table(spark, sf_dir, "lineitem"), "l_discount").unionByName(
        profile.distinct_values(table(spark, sf_dir, "orders"), "o_orderpriority"))


@query("""
WITH s AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT avg(c_acctbal) AS a FROM customer)
SELECT 'marker values in c_mktsegment' AS "check", CAST(count(*) FILTER (lower(trim(c_mktsegment)) IN
   ('','na','n/a','nan','none','null','?','unknown','error','machinery')) AS DOUBLE) AS result FROM customer
UNION ALL SELECT 'share of price = quantity x unit price', round(avg((abs(l_extendedprice - l_quantity * p_retailprice) < 0.01)::INT), 6) FROM s
UNION ALL SELECT 'c_acctbal equal to its mean', CAST(count(*) FILTER (c_acctbal = a) AS DOUBLE) FROM customer, m
UNION ALL SELECT 'brands with several sizes', CAST(count(*) AS DOUBLE) FROM
   (SELECT p_brand FROM part GROUP BY p_brand HAVING count(DISTINCT p_size) > 1)""")
def quality_checks(spark, sf_dir):
    customer, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    priced = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    line = lambda name, df: df.select(F.lit(name).alias("check"), df[df.columns[-1]].cast("double").alias("result"))
    share = priced.agg(rounded(profile.product_share(
        priced, F.col("l_extendedprice"), F.col("l_quantity") * F.col("p_retailprice"), 0.01)).alias("s"))
    several = profile.multi_valued(part, "p_brand", "p_size").agg(F.count("*").alias("n"))
    return (
        line("marker values in c_mktsegment",
             profile.marker_counts(customer, ["c_mktsegment"], [*S.MISSING_MARKERS, "machinery"]))
        .unionByName(line("share of price = quantity x unit price", share))
        .unionByName(line("c_acctbal equal to its mean", profile.mean_filled(customer, "c_acctbal")))
        .unionByName(line("brands with several sizes", several))
    )


def _describe_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,
        CAST(min({c}) AS DOUBLE) AS "min", round(quantile_cont({c}::DOUBLE, 0.25), 5) AS q1, round(quantile_cont({c}::DOUBLE, 0.5), 5) AS median,
        round(quantile_cont({c}::DOUBLE, 0.75), 5) AS q3, CAST(max({c}) AS DOUBLE) AS "max", round(skewness({c}), 5) AS skew,
        round(kurtosis({c}), 5) AS excess_kurtosis, count(DISTINCT {c}) AS n_unique FROM {source}""" for c in columns)


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(_describe_sql("lineitem", _NUMERIC))
def describe(spark, sf_dir):
    df = profile.describe(table(spark, sf_dir, "lineitem"), _NUMERIC)
    return round_columns(df, ["mean", "std", "q1", "median", "q3", "skew", "excess_kurtosis"], 5)


@query(f"""WITH d AS ({_describe_sql("events", ["value"])}),
l AS (SELECT "column", statistic, "value" FROM (SELECT "column", CAST(count AS DOUBLE) AS count, mean, std, "min", q1, median, q3, "max", skew,
  excess_kurtosis, CAST(n_unique AS DOUBLE) AS n_unique FROM d)
  UNPIVOT ("value" FOR statistic IN (count, mean, std, "min", q1, median, q3, "max", skew, excess_kurtosis, n_unique)))
SELECT "column", statistic, round("value", 5) AS "value" FROM l""")
def unpivot_table(spark, sf_dir):
    return round_columns(profile.unpivot(profile.describe(table(spark, sf_dir, "events"), ["value"]), "column"), ["value"], 5)


@query("""SELECT l_returnflag AS "value", count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 6) AS share
          FROM lineitem GROUP BY l_returnflag""")
def value_counts(spark, sf_dir):
    return round_columns(profile.value_counts(table(spark, sf_dir, "lineitem"), "l_returnflag"), ["share"])


@query("""WITH c AS (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity)
SELECT count(*) AS n_values, max(n) AS most_common_n, min(n) AS least_common_n,
  (SELECT l_quantity FROM c ORDER BY n DESC, l_quantity LIMIT 1) AS most_common,
  (SELECT l_quantity FROM c ORDER BY n, l_quantity LIMIT 1) AS least_common FROM c""")
def extreme_counts(spark, sf_dir):
    return profile.extreme_counts(table(spark, sf_dir, "lineitem"), "l_quantity")


@query("""SELECT event_type, count("value") AS n, round(avg("value"), 6) AS mean, round(stddev_samp("value"), 6) AS std,
  round(quantile_cont("value", 0.5), 6) AS median, round(quantile_cont("value", 0.9), 6) AS p90 FROM events GROUP BY event_type""")
def group_stats(spark, sf_dir):
    return round_columns(profile.group_stats(table(spark, sf_dir, "events"), "event_type", "value"),
                         ["mean", "std", "median", "p90"])


@query("""WITH c AS (SELECT CASE WHEN quality = 0 THEN 'negative' ELSE 'positive' END AS label, count(*) AS n FROM labels GROUP BY 1)
SELECT label, n, round(n / (SELECT sum(n) FROM c), 6) AS share, round((SELECT max(n) FROM c) / n, 6) AS majority_ratio FROM c""")
def class_balance(spark, sf_dir):
    df = table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 0, "negative").otherwise("positive").alias("label"))
    return round_columns(profile.class_balance(df, "label"), ["share", "majority_ratio"])


def _outliers_sql(source: str, columns: list[str]) -> str:
    ctes, selects = [], []
    for i, c in enumerate(columns):
        ctes.append(f"""b{i} AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM
          (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3, avg({c}) AS m, stddev_samp({c}) AS s FROM {source}))""")
        selects.append(f"""SELECT '{c}' AS "column", round(q1, 5) AS q1, round(q3, 5) AS q3, round(iqr, 5) AS iqr, round(lo, 5) AS lower_fence,
          round(hi, 5) AS upper_fence, min({c}) AS observed_min, max({c}) AS observed_max, count(*) FILTER ({c} < lo OR {c} > hi) AS n_outside,
          count(*) FILTER (abs(({c} - m) / s) > 3) AS n_beyond_z FROM {source}, b{i} GROUP BY q1, q3, iqr, lo, hi""")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(selects)


@query(_outliers_sql("(SELECT l_quantity, l_extendedprice, l_tax, NULL AS nothing FROM lineitem)", ["l_quantity", "l_extendedprice", "l_tax"]))
def outliers(spark, sf_dir):
    df = profile.outliers(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return round_columns(df, ["q1", "q3", "iqr", "lower_fence", "upper_fence"], 5)


@query(_outliers_sql("events", ['"value"']).replace("'\"value\"'", "'value'"))
def outliers_skewed(spark, sf_dir):
    df = profile.outliers(table(spark, sf_dir, "events"), ["value"])
    return round_columns(df, ["q1", "q3", "iqr", "lower_fence", "upper_fence"], 5)


def _histogram_sql(x: str, bins: int, name: str) -> str:
    return f"""SELECT '{name}' AS scale, bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, n FROM (
      SELECT CAST(least(floor(({x} - lo) / w), {bins - 1}) AS BIGINT) AS bin, lo, w, count(*) AS n
      FROM events, (SELECT min({x}) AS lo, (max({x}) - min({x})) / {bins} AS w FROM events) GROUP BY 1, 2, 3)"""


@query(" UNION ALL ".join([_histogram_sql('"value"', 45, "linear"), _histogram_sql('log10("value")', 40, "log"),
                           _histogram_sql('ln(1 + "value")', 40, "log1p")]))
def histogram(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    result = None
    for scale, bins in (("linear", 45), ("log", 40), ("log1p", 40)):
        part = profile.histogram(events, "value", bins, scale).select(F.lit(scale).alias("scale"), "bin", "bin_low", "bin_high", "n")
        result = part if result is None else result.unionByName(part)
    return round_columns(result, ["bin_low", "bin_high"])


@query("""WITH q AS (SELECT quantile_cont("value", 0.25) AS q1, quantile_cont("value", 0.5) AS q2, quantile_cont("value", 0.75) AS q3 FROM events),
f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM q)
SELECT 'value' AS "column", min("value") AS "min", round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3, max("value") AS "max",
 min("value") FILTER ("value" BETWEEN lo AND hi) AS whisker_low, max("value") FILTER ("value" BETWEEN lo AND hi) AS whisker_high,
 count(*) FILTER ("value" < lo OR "value" > hi) AS n_beyond FROM events, f GROUP BY q1, q2, q3""")
def box_stats(spark, sf_dir):
    return round_columns(profile.box_stats(table(spark, sf_dir, "events"), "value"), ["q1", "median", "q3"])


@query("""SELECT l_quantity AS "value", round(avg(l_extendedprice), 4) AS mean_target, count(l_extendedprice) AS n FROM lineitem GROUP BY 1""")
def mean_per_value(spark, sf_dir):
    return round_columns(profile.mean_per_value(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice"), ["mean_target"], 4)


# ---------------------------------------------------------------- correlation

_PRICE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _priced(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("disc_price", F.expr(_PRICE))


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6) + 0.0")
                          + " AS r FROM lineitem GROUP BY ALL" if a != b else f"SELECT '{a}' AS a, '{a}' AS b, 1.0::DOUBLE AS r"
                          for a in _CORR for b in _CORR))
def pearson_matrix(spark, sf_dir):
    return round_columns(correlation.pearson_matrix(table(spark, sf_dir, "lineitem"), _CORR), ["r"])


_SPEAR = ["l_quantity", "l_extendedprice", "l_discount"]


@query("WITH r AS (SELECT " + ", ".join(
    f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)::DOUBLE AS {c}" for c in _SPEAR) + " FROM lineitem) "
    + " UNION ALL ".join((f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM r" if a != b
                          else f"SELECT '{a}' AS a, '{a}' AS b, 1.0::DOUBLE AS r") for a in _SPEAR for b in _SPEAR))
def spearman_matrix(spark, sf_dir):
    return round_columns(correlation.spearman_matrix(table(spark, sf_dir, "lineitem"), _SPEAR), ["r"])


@query(f"WITH p AS (SELECT *, {_PRICE} AS y FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, y), 6) + 0.0 AS r, abs(round(corr({c}, y), 6)) AS abs_r FROM p" for c in _CORR))
def corr_with_target(spark, sf_dir):
    return round_columns(correlation.corr_with_target(_priced(spark, sf_dir), _CORR, "disc_price"), ["r", "abs_r"])


@query(f"WITH p AS (SELECT *, {_PRICE} AS disc_price FROM lineitem), m AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM p" for a in sorted([*_CORR, "disc_price"])
    for b in sorted([*_CORR, "disc_price"]) if a < b) + ") SELECT a, b, round(r, 6) AS r FROM m ORDER BY abs(r) DESC LIMIT 1")
def strongest_pair(spark, sf_dir):
    return round_columns(correlation.strongest_pair(_priced(spark, sf_dir), [*_CORR, "disc_price"]), ["r"])


@query(f"""WITH p AS (SELECT *, {_PRICE} AS y FROM lineitem),
s AS (SELECT corr(l_extendedprice, l_discount) AS ab, corr(l_extendedprice, l_tax) AS ac, corr(l_discount, l_tax) AS bc FROM p),
r2 AS (SELECT (ab*ab + ac*ac - 2*ab*ac*bc) / (1 - bc*bc) AS r1, (ab*ab + bc*bc - 2*ab*bc*ac) / (1 - ac*ac) AS r2,
  (ac*ac + bc*bc - 2*ac*bc*ab) / (1 - ab*ab) AS r3 FROM s),
f AS (SELECT 'l_extendedprice' AS "column", count(DISTINCT l_extendedprice) AS u, count(*) AS n, abs(corr(l_extendedprice, y)) AS r FROM p
 UNION ALL SELECT 'l_discount', count(DISTINCT l_discount), count(*), abs(corr(l_discount, y)) FROM p
 UNION ALL SELECT 'l_tax', count(DISTINCT l_tax), count(*), abs(corr(l_tax, y)) FROM p),
g AS (SELECT "column", u, n, r, CASE "column" WHEN 'l_extendedprice' THEN r2.r1 WHEN 'l_discount' THEN r2.r2 ELSE r2.r3 END AS o FROM f, r2)
SELECT "column", u AS n_unique, round(u / n::DOUBLE, 6) AS unique_ratio, round(r, 6) AS abs_r, round(o, 8) + 0.0 AS r2_from_others,
 u / n::DOUBLE > 0.95 AS identifier, r >= 0.99 AS leakage, o >= 0.99 AS redundant FROM g""")
def leakage_check(spark, sf_dir):
    df = correlation.leakage_check(_priced(spark, sf_dir), ["l_extendedprice", "l_discount", "l_tax"], "disc_price")
    return round_columns(round_columns(df, ["unique_ratio", "abs_r"]), ["r2_from_others"], 8)


# ---------------------------------------------------------------- scalar functions

@query("""SELECT l_orderkey, l_linenumber, round(ln(1 + l_quantity), 6) AS log1p_quantity, round(sqrt(l_extendedprice), 6) AS root_price,
  round(exp(l_discount), 6) AS exp_discount, abs(l_quantity - 25) AS distance,
  round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) + 0.0 AS z FROM lineitem""")
def scalar_math(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return df.select(
        "l_orderkey", "l_linenumber", rounded(F.log1p("l_quantity")).alias("log1p_quantity"),
        rounded(F.sqrt("l_extendedprice")).alias("root_price"), rounded(F.exp("l_discount")).alias("exp_discount"),
        F.abs(F.col("l_quantity") - 25).alias("distance"),
        rounded(S.zscore("l_quantity", df.agg(F.avg("l_quantity")).scalar(), df.agg(F.stddev_samp("l_quantity")).scalar())).alias("z"))


@query("""SELECT l_linestatus, round(avg((l_returnflag = 'R')::INT), 6) AS share_returned,
  round(avg((l_returnflag IS NOT DISTINCT FROM 'N')::INT), 6) AS agreement, CAST(sum((l_linestatus = 'O')::INT) AS BIGINT) AS n_open
  FROM lineitem GROUP BY l_linestatus""")
def indicator_share(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(
        rounded(F.avg(S.yes_no_flag("l_returnflag", "R"))).alias("share_returned"),
        rounded(S.agreement(F.col("l_returnflag"), F.lit("N"))).alias("agreement"),
        F.sum(S.yes_no_flag("l_linestatus", "O")).alias("n_open"))


@query("""SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice > 100000 THEN 'high' ELSE 'low' END AS band,
 try_cast(left(o_orderpriority, 1) AS DOUBLE) AS priority, try_cast(o_orderpriority AS DOUBLE) AS unparsed
 FROM orders WHERE (o_totalprice < 20000 OR o_totalprice > 200000) AND o_orderpriority IS NOT NULL""")
def project_filter(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders").drop("7514")
        .where(S.outside("o_totalprice", 20000, 200000)).dropna(subset=["o_orderpriority"])
        .select("o_orderkey", "o_totalprice", F.when(F.col("o_totalprice") > 100000, "high").otherwise("low").alias("band"),
                S.to_number(F.left("o_orderpriority", F.lit(1))).alias("priority"), S.to_number("o_orderpriority").alias("unparsed")))


@query("""SELECT c_custkey, '<hidden>' AS c_name, lower(trim(c_mktsegment)) IN ('','na','n/a','nan','none','null','?','unknown','error') AS marker,
 lower(c_mktsegment) AS segment FROM customer""")
def masked_view(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", S.masked("c_name").alias("c_name"), S.is_missing_marker("c_mktsegment").alias("marker"),
        S.normalised_text("c_mktsegment").alias("segment"))


@query(r"""SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS INT) AS words, CAST(length(text) AS INT) AS characters,
 regexp_matches(text, '(?i)\b[1-5](?:\.5)?\s*(?:/\s*5|stars?)\b') AS states_rating FROM documents""")
def text_lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", S.word_count("text").alias("words"), S.char_count("text").alias("characters"), S.states_rating("text").alias("states_rating"))


@query(r"""SELECT count(*) AS n, count(*) FILTER (regexp_matches(text, '(?i)\b[1-5](?:\.5)?\s*(?:/\s*5|stars?)\b')) AS n_rating,
 count(*) FILTER (regexp_matches(text, '(?i)copyright|license')) AS n_license FROM documents""")
def regex_flags(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(
        F.count("*").alias("n"), F.count_if(S.states_rating("text")).alias("n_rating"),
        F.count_if(F.col("text").rlike("(?i)copyright|license")).alias("n_license"))


@query(r"""SELECT event_id, try_cast(regexp_extract(event_type || ' ' || regexp_extract(props, '([0-9]+)', 1) || ' Reviews', '([0-9]+)\s*Review', 1) AS DOUBLE) AS k,
 try_cast(nullif(regexp_extract(props, '([0-9]+)\s*Follower', 1), '') AS DOUBLE) AS nothing FROM events""")
def parse_count(spark, sf_dir):
    written = F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k"), F.lit("Reviews"))
    return table(spark, sf_dir, "events").select(
        "event_id", S.integer_before(written, "Review").alias("k"), S.integer_before("props", "Follower").alias("nothing"))


# ---------------------------------------------------------------- order and limits

@query("""(SELECT d.doc_id, quality FROM documents d LEFT JOIN labels USING (doc_id) ORDER BY quality ASC NULLS LAST, doc_id DESC)""")
def sorted_nulls_last(spark, sf_dir):
    return (
        _documents_with_labels(spark, sf_dir).select("doc_id", "quality")
        .orderBy(F.col("quality").asc_nulls_last(), F.col("doc_id").desc()))


@query("SELECT p_partkey, p_name FROM part ORDER BY md5('42|' || p_partkey), p_partkey LIMIT 5")
def sample_rows(spark, sf_dir):
    return order.seeded_sample(table(spark, sf_dir, "part"), "p_partkey", 5).select("p_partkey", "p_name")


@query("""(SELECT p_partkey, p_retailprice, 'top' AS direction FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 15) UNION ALL
 (SELECT p_partkey, p_retailprice, 'bottom' FROM part ORDER BY p_retailprice ASC NULLS LAST, p_partkey LIMIT 15)""")
def top_n(spark, sf_dir):
    return order.top_and_bottom(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey", 15)


@query("""SELECT p_brand, arg_max(p_partkey, (p_retailprice, -p_partkey)) AS best_part, arg_min(p_partkey, (p_retailprice, p_partkey)) AS cheapest_part
 FROM part GROUP BY p_brand""")
def arg_best(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.max_by("p_partkey", F.struct(F.col("p_retailprice"), -F.col("p_partkey"))).alias("best_part"),
        F.min_by("p_partkey", F.struct("p_retailprice", "p_partkey")).alias("cheapest_part"))


# ---------------------------------------------------------------- sets and joins

@query("""SELECT n_nationkey AS k, 'nation' AS origin FROM nation UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def union_tagged(spark, sf_dir):
    return (
        table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.lit("nation").alias("origin"))
        .unionByName(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("origin"))))


@query("SELECT n_nationkey AS k FROM nation INTERSECT SELECT s_nationkey FROM supplier")
def intersect_sets(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")).intersect(
        table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("""SELECT (SELECT count(*) FROM (SELECT n_nationkey FROM nation EXCEPT SELECT c_nationkey FROM customer)) AS only_left,
 (SELECT count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT n_nationkey FROM nation)) AS only_right""")
def set_equality(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select("n_nationkey")
    b = table(spark, sf_dir, "customer").select("c_nationkey")
    return a.subtract(b).agg(F.count("*").alias("only_left")).select(
        "only_left", b.subtract(a).agg(F.count("*")).scalar().alias("only_right"))


@query("""SELECT o_orderkey, o_totalprice, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def index_join(spark, sf_dir):
    return table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey", "left",
    ).select("o_orderkey", "o_totalprice", "c_mktsegment")


@query("SELECT doc_id, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)")
def label_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(
        table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang", "n_chars", "quality", "toxic")
