"""The dealt queries under their contracts, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import decontaminate, html_extract, hybrid_search, merkle, mixing, secrets, sharding, simhash, substring, suffix, toxicity, url_filter, vafile
from fieldloom.llm.common import table

# The contract's rules of URLs.
URL_RULES = (
    url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"), url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"), url_filter.Rule("com", "/de/", "block"),
)


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3, seed=42)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_windows(table(spark, sf_dir, "documents"), width=13)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_repeats=3, seed=42)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_substrings(table(spark, sf_dir, "documents"), width=100)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    found = secrets.scan_secrets(docs, secrets.ledger_path(spark))
    text = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["rank"] < len(secrets.BASE))
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, lambda x, _i: x == r.kind)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shuffle(docs, shards=16, seed=42).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaf = lambda n_chars: merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, leaf(F.col("n_chars") + 1))
    proved = merkle.proofs(docs, leaf(F.col("n_chars")), "lang", "doc_id", [F.col("doc_id"), tampered.alias("tampered")])
    judged = proved.withColumn("folded_root", merkle.folded("path", F.coalesce("tampered", "leaf")))
    return judged.select("doc_id", "leaf", "subroot", "root", merkle.path_digest("path").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_exact_top_k, op2_simhash, op3_substring_dedup, op4_toxicity, op5_mixing, op6_html_extraction, op7_url_filters, op8_suffix_dedup, op9_secret_scans, op10_decontamination,
                                   op11_ranked_search, op12_sharding, op13_merkle_manifest)}

SQL: dict[str, str] = {}

SQL["op1_exact_top_k"] = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, q.v AS qv, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

SQL["op3_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT n, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d),
h AS (SELECT n, doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM p),
m AS (SELECT k, min(doc_id) AS low FROM h GROUP BY k),
r AS (SELECT h.n, list(DISTINCT j) AS gone FROM (SELECT h.n, unnest(range(i, i + 13)) AS j FROM h JOIN m USING (k) WHERE h.doc_id > m.low) h GROUP BY h.n)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                   ELSE COALESCE(array_to_string(list_transform(list_sort(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(gone, x))), lambda x: w[x]), ' '), '') END) AS kept_sha256
FROM d LEFT JOIN r ON d.n = r.n
"""

SQL["op5_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':42'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS coin
  FROM documents),
s AS (SELECT key, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY key),
w AS (SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY encode(key)) - 1) % 3] AS BIGINT) AS weight FROM s),
l AS (SELECT *, source_size * 3 AS cap, source_size * 3 * (10 // weight) AS level FROM w),
g AS (SELECT level, SUM(cap) AS cap, SUM(weight) AS weight FROM l GROUP BY level),
r AS (
  SELECT level,
         (SELECT SUM(source_size) FROM l) - COALESCE(SUM(cap) OVER before, 0) AS rest,
         (SELECT SUM(weight) FROM l) - COALESCE(SUM(weight) OVER before, 0) AS rest_weight
  FROM g WINDOW before AS (ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level, rest, rest_weight FROM r WHERE CAST(level AS DOUBLE) * rest_weight > rest * 10.0 ORDER BY level LIMIT 1),
t AS (
  SELECT l.key, l.source_size,
         CASE WHEN f.level IS NULL OR l.level < f.level THEN CAST(l.cap AS DOUBLE)
              ELSE CAST(l.weight * f.rest AS DOUBLE) / CAST(f.rest_weight AS DOUBLE) END AS target
  FROM l LEFT JOIN f ON true),
x AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t)
SELECT d.doc_id, d.size, x.source_size, x.target,
       CAST(d.size * (floor(x.rate) + CASE WHEN d.coin < x.rate - floor(x.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN x USING (key)
"""

SQL["op7_url_filters"] = r"""
WITH rules(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
m AS (
  SELECT u.n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY u.n)
SELECT u.page_id, u.host, u.path, m.rule, COALESCE(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m ON u.n = m.n
"""


def _span_sql(rule: secrets.Rule, rank: int) -> str:
    """A list of (start, rank, kind, end) of one rule, the way the operator finds it: gaps and matches by length."""
    pattern = rule.pattern.replace("'", "''")
    kept = f"regexp_extract_all(t, '{pattern}', {rule.kept})" if rule.kept else f"regexp_extract_all(t, '{pattern}')"
    return f"""
  SELECT n, unnest(list_filter(list_transform(range(1, len(h) + 1), lambda i: {{
      's': list_sum(list_transform(g[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0){" + length(h[i]) - length(q[i])" * rule.led},
      'r': {rank}, 'k': '{rule.kind}', 'l': length({"q" if rule.led else "h"}[i]), 'kept': length(q[i])}}), lambda x: x.kept >= {rule.least})) AS s
  FROM (SELECT n, regexp_split_to_array(t, '{pattern}') AS g, regexp_extract_all(t, '{pattern}') AS h, {kept} AS q FROM d WHERE regexp_matches(t, '{pattern}'))"""


SQL["op9_secret_scans"] = (
    "WITH d AS (SELECT row_number() OVER () AS n, doc_id, COALESCE(text, '') AS t FROM documents),\na AS ("
    + "\n  UNION ALL".join(_span_sql(r, k) for k, r in enumerate(secrets.BASE + secrets.ADDED))
    + """),
f AS (SELECT n, s.r AS r, s.s AS pos, s.k || ':' || CAST(s.s AS BIGINT) || ':' || CAST(s.s + s.l AS BIGINT) AS span FROM a),
z AS (
  SELECT n, count(*) FILTER (WHERE r = 0) AS n_assign, count(*) FILTER (WHERE r = 1) AS n_access, count(*) FILTER (WHERE r = 2) AS n_hex,
         string_agg(span, ',' ORDER BY pos, r) FILTER (WHERE r < 3) AS base, string_agg(span, ',' ORDER BY pos, r) AS spans
  FROM f GROUP BY n)
SELECT d.doc_id, COALESCE(z.n_assign, 0) AS n_assign, COALESCE(z.n_access, 0) AS n_access, COALESCE(z.n_hex, 0) AS n_hex,
       sha256(COALESCE(z.base, '')) AS base_sha256, COALESCE(z.spans, '') AS spans
FROM d LEFT JOIN z ON d.n = z.n
""")

SQL["op11_ranked_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
a AS (SELECT CAST(count(*) AS BIGINT) AS N, CAST(sum(len(w)) AS BIGINT) AS L FROM d WHERE len(w) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * N + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM tf, a GROUP BY term, N),
m AS (SELECT row, doc_id, 100 - 90 + ((90 * len(w) * N) // L) AS m FROM d, a),
asked AS (SELECT DISTINCT item, item_id, unnest(w) AS term FROM i),
s AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (row) GROUP BY item, row),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

SQL["op13_merkle_manifest"] = r"""
WITH RECURSIVE
t AS (
  SELECT row_number() OVER () AS n, doc_id, lang, n_chars,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
           || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
           || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         list_reduce(list_concat([4294967295], flatten(list_transform(str_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc
  FROM documents),
l AS (
  SELECT n, doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS leaf,
         CASE WHEN xor(crc, 4294967295) % 7 = 0
              THEN sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) END || tail) END AS bad
  FROM t),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
up AS (
  SELECT lang, 0 AS level, pos, leaf AS h FROM p
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS c FROM up) WHERE c > 1 GROUP BY lang, level, pos // 2),
sub AS (SELECT lang, level AS height, h AS subroot FROM up QUALIFY row_number() OVER (PARTITION BY lang ORDER BY level DESC) = 1),
sp AS (SELECT *, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS spot FROM sub),
up2 AS (
  SELECT 0 AS level, spot AS pos, subroot AS h FROM sp
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS c FROM up2) WHERE c > 1 GROUP BY level, pos // 2),
top AS (SELECT max(level) AS height, arg_max(h, level) AS root FROM up2),
x AS (SELECT p.*, sp.height, sp.spot, sp.subroot, top.root, sp.height + top.height AS total FROM p JOIN sp ON p.lang IS NOT DISTINCT FROM sp.lang, top),
own AS (SELECT n, lang, spot, height, k, CASE WHEN k < height THEN pos >> k ELSE spot >> (k - height) END AS node FROM (SELECT *, unnest(range(0, total)) AS k FROM x)),
sib AS (
  SELECT own.n, k, up.h, up.pos < node AS before FROM own JOIN up ON k < height AND up.level = k AND up.pos = xor(node, 1) AND up.lang IS NOT DISTINCT FROM own.lang
  UNION ALL
  SELECT own.n, k, up2.h, up2.pos < node FROM own JOIN up2 ON k >= height AND up2.level = k - height AND up2.pos = xor(node, 1)),
step AS (SELECT own.n, own.k, COALESCE(CASE WHEN before THEN h END, '') AS a, COALESCE(CASE WHEN NOT before THEN h END, '') AS b FROM own LEFT JOIN sib ON own.n = sib.n AND own.k = sib.k),
proof AS (SELECT n, string_agg(a || b, '' ORDER BY k) AS s FROM step GROUP BY n),
fold AS (
  SELECT n, CAST(0 AS BIGINT) AS k, COALESCE(bad, leaf) AS h FROM x
  UNION ALL
  SELECT fold.n, fold.k + 1, sha256(a || h || b) FROM fold JOIN step ON fold.n = step.n AND fold.k = step.k)
SELECT x.doc_id, x.leaf, x.subroot, x.root, sha256(COALESCE(proof.s, '')) AS proof_sha256, fold.h AS folded_root, fold.h = x.root AS verified
FROM x JOIN fold ON x.n = fold.n AND fold.k = x.total LEFT JOIN proof ON x.n = proof.n
"""
