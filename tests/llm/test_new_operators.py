"""Ranked search, sharding and the dataset manifest against brute force, exact probabilities and their own tables."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import common, hybrid_search, merkle, queries, sharding
from tests.llm import brute
from tests.llm.test_operators import ordered, rows_of

# Manifest

LEAF = "doc_id long, source string, lang string, n_chars long, text string, g string, at long, row string, path string, digest string, leaf string"


def manifest_rows(n):
    rng = random.Random(n)
    rows = [(rng.randrange(3 * n), rng.choice(["a", "é", None, ""]), rng.choice(["en"] * 6 + ["de", "fr", None, "é", ""]), rng.choice([None, rng.randrange(99)]), rng.choice(["", None, "text é %d" % i])) for i in range(n)]
    return rows + rows[:3] + [(None, None, None, None, None), (None, "s", "only", 3, "x"), (5, None, "only2", 3, "漢字" * 5000)]


def rooted(df):
    return rows_of(df, "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest(docs, fanout, step):
    leaf = lambda n: merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, leaf(F.col("n_chars") + 1))
    out = merkle.proofs(docs, leaf(F.col("n_chars")), "lang", "doc_id", [F.col("doc_id"), tampered.alias("tampered")], fanout, step)
    out = out.withColumn("folded_root", merkle.folded("path", F.coalesce("tampered", "leaf"))).withColumn("proof_sha256", merkle.path_digest("path"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


@pytest.mark.parametrize(("n", "fanout", "step"), [(60, 2, 3), (60, 2, 1), (70, 3, 2), (9, 5, 1), (0, 2, 3)])
def test_manifest_equals_plain_trees(spark, n, fanout, step):
    rows = manifest_rows(n)
    docs = spark.createDataFrame([(*r, *"123456") for r in rows], LEAF.replace("at long", "at string")).repartition(3)
    assert rooted(manifest(docs, fanout, step)) == ordered(brute.merkle(rows, fanout))


def test_manifest_query_over_files(spark, tmp_path):
    rows = manifest_rows(40)
    spark.createDataFrame([r[:5] for r in rows], "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rooted(queries.op13_merkle_manifest(spark, str(tmp_path))) == ordered(brute.merkle(rows))


def test_manifest_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(7, None, "en", 3, "abc", *"123456")], LEAF.replace("at long", "at string"))
    row, = manifest(one, 2, 3).collect()
    assert row.leaf == row.subroot == row.root == brute.leaf(7, None, "en", 3, "abc") and row.path == []
    assert manifest(one.where("false"), 2, 3).count() == 0
    with pytest.raises(ValueError, match="fanout"):
        manifest(one, 1, 3)


# Sharding


def test_draws_have_the_exact_probabilities():
    for good, bad, draws in [(5, 7, 4), (1, 0, 1), (30, 3, 20), (3, 90, 50), (6, 6, 12)]:
        low, high = max(0, draws - bad), min(draws, good)
        exact = [math.comb(good, x) * math.comb(bad, draws - x) / math.comb(good + bad, draws) for x in range(low, high + 1)]
        for u in np.linspace(0.0005, 0.9995, 200):  # inversion: a value is drawn for the share of the uniform that is its probability
            x = sharding.hypergeometric(type("", (), {"random": staticmethod(lambda u=u: u)}), good, bad, draws)
            assert sum(exact[: x - low]) - 1e-12 <= u <= sum(exact[: x - low + 1]) + 1e-12
    rng = np.random.default_rng(0)
    far = [sharding.hypergeometric(rng, 3 * 10**10, 2 * 10**10, 10**9) for _ in range(200)]
    sd = math.sqrt(10**9 * 0.6 * 0.4 * (1 - 0.02))
    assert abs(np.mean(far) - 6e8) < 5 * sd / math.sqrt(200) and 0.8 < np.std(far) / sd < 1.2


def test_matrix_has_its_margins():
    for sizes, shards, unit in [({0: 100, 3: 1, 4: 57}, 7, 16), ({2: 5}, 16, 100), ({}, 3, 10), ({0: 64, 1: 64}, 1, 8)]:
        matrix = sharding.Matrix(sizes, shards, 42, unit)
        rows = np.array([matrix.row(i) for i in range(len(matrix.until) - 1)]).reshape(-1, shards)
        assert (rows.sum(axis=0) == (matrix.shards if len(rows) else 0)).all() and (rows >= 0).all()
        assert rows.sum(axis=1).tolist() == [matrix.size(i) for i in range(len(rows))] and max(rows.sum(axis=1), default=0) <= unit
        for i, row in enumerate(rows):
            shard, key = matrix.dealt(i)
            assert np.bincount(shard, minlength=shards).tolist() == row.tolist() and len(set(key.tolist())) == len(key)


def test_every_order_is_as_likely():
    """Five rows in units of two, three and more, two shards: the 120 orders over many seeds."""
    seen = Counter()
    for seed in range(12000):
        matrix = sharding.Matrix({0: 2, 1: 3}, 2, seed, 2)
        places = []
        for number in range(3):
            shard, key = matrix.dealt(number)
            places += [(s, k, (number, i)) for i, (s, k) in enumerate(zip(shard.tolist(), key.tolist()))]
        seen[tuple(p[2] for p in sorted(places))] += 1
    assert len(seen) == 120
    chi = sum((seen[p] - 100) ** 2 / 100 for p in itertools.permutations(next(iter(seen))))
    assert chi < 119 + 4 * math.sqrt(2 * 119)


def test_shuffle_deals_every_row_once(spark, messy, messy_rows):
    for shards, unit in [(16, 1 << 20), (3, 4), (100, 7)]:
        got = sharding.shuffle(messy, shards, 42, unit)
        assert got.columns == [*messy.columns, "shard", "slot"]
        rows = got.collect()
        assert Counter(r[: len(messy.columns)] for r in rows) == Counter(tuple(r) for r in messy.collect())
        by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
        assert all(slots == list(range(len(slots))) for slots in by.values()) and sum(map(len, by.values())) == len(messy_rows)
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    twice = [sorted(map(tuple, sharding.shuffle(messy, 3).select("doc_id", "shard", "slot").collect()), key=str) for _ in range(2)]
    assert twice[0] == twice[1] != sorted(map(tuple, sharding.shuffle(messy, 3, 43).select("doc_id", "shard", "slot").collect()), key=str)


def test_shuffle_of_nothing_and_written_shards(spark, messy, nothing, tmp_path):
    assert sharding.shuffle(nothing).count() == 0
    named = messy.withColumn("slot", F.lit("old")).withColumn("shard", F.lit("old"))
    back = sharding.write_shards(named, f"file:{tmp_path}/shards", 4)
    assert back.count() == messy.count() and {type(r.slot) for r in back.collect()} == {int}
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == [f"shard={i}" for i in range(4)]


def test_sharding_query_over_files(spark, sf):
    rows = queries.op12_sharding(spark, sf).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts) and all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in rows)
    sizes = Counter(r.shard for r in rows)
    assert sorted(sizes) == list(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1 and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


# Ranked search

ASKED = [(1, "alpha beta gamma"), (2, "One two, ONE!"), (3, None), (4, ""), (5, "... --"), (None, "漢字 größe hunter22"), (1, "alpha beta gamma"), (6, "w1 w2 w3 epsilon nowhere"), (7, "w5")]


def test_ranked_search_equals_full_scoring(spark, messy, messy_rows):
    items = spark.createDataFrame([(*i, "x") for i in ASKED], "item_id long, text string, score string")
    for k in (1, 3, 10):
        assert rows_of(hybrid_search.search(messy, items, k), "item_id", "rank", "doc_id", "score") == ordered(brute.ranked([r[:2] for r in messy_rows], ASKED, k))


def test_ranked_search_of_nothing(spark, messy, nothing):
    items = spark.createDataFrame(ASKED, "item_id long, text string")
    blank = messy.withColumn("text", F.lit(" ,. "))
    for docs, asked in ((nothing, items), (messy, items.where("false")), (blank, items)):
        out = hybrid_search.search(docs, asked)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_chunks_search_exactly_with_any_bar(monkeypatch):
    """Spans, essential iterators and look-ups against the plain sums, over lists of all lengths with many ties."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(hybrid_search, "SPAN", 16)
    for trial in range(60):
        n = int(rng.integers(1, 300))
        lists = [np.flatnonzero(rng.random(n) < p) for p in rng.choice([0.005, 0.02, 0.1, 0.5, 1.0], 12)]
        tfs = [rng.integers(1, 4, len(x)) for x in lists]
        present = [t for t, x in enumerate(lists) if len(x)]
        length = rng.integers(1, 5, n) * 50
        row = {"ids": list(range(n)), "lengths": length.astype(np.int64).tobytes(), "terms": present, "counts": [len(lists[t]) for t in present],
               "docs": b"".join(lists[t].astype(np.uint32).tobytes() for t in present), "tfs": b"".join(tfs[t].astype(np.uint32).tobytes() for t in present)}
        weights = rng.integers(0, 6, 12) * 1000
        chunk = hybrid_search.Chunk(row, weights, n, int(length.sum()))
        full = np.zeros(n, np.int64)
        for t in present:
            full[lists[t]] += weights[t] * ((10**9 * tfs[t]) // (1000 * tfs[t] + 8 * chunk.m[lists[t]]))
        for k, bar in ((1, 1), (5, 1), (5, int(np.sort(full)[-min(n, 5)]) or 1), (3, int(full.max()) + 1)):
            docs, scores = chunk.search(list(range(12)), k, bar)
            kth = max(bar, int(np.sort(full[full >= bar])[-k]) if (full >= bar).sum() >= k else bar)
            assert dict(zip(docs.tolist(), scores.tolist())) == {d: s for d, s in enumerate(full.tolist()) if s >= kth}


# Key filter


def test_key_filter_misses_nothing_and_lets_little_else_through(spark):
    keys = spark.range(0, 4000).select((F.col("id") * 7919 - 10**6).alias("k"))

    def passed(among, df, column):
        def count(batches):
            for b in batches:
                yield pa.record_batch([pa.array([int(among.holds(b).sum())], pa.int64())], names=["n"])

        return sum(r.n for r in df.select(*among.places(F.col(column))).mapInArrow(count, "n long").collect())

    among = common.KeyFilter(keys, "k")
    assert passed(among, keys, "k") == 4000 and passed(among, spark.range(10**9, 10**9 + 50000), "id") < 5
    assert passed(common.KeyFilter(keys.where("false"), "k"), keys, "k") == 0
