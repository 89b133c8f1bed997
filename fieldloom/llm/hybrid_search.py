"""Ranked lexical search: term-at-a-time over short lists, document-at-a-time over long ones.

* Index: each task reads its documents once and writes them as chunks of at most ``CHUNK_DOCS`` documents or
  ``CHUNK_ENTRIES`` entries (a longer document is a chunk of its own): document lengths, and for each term of the queries
  its posting list in the chunk. Documents are not shuffled; what is counted of them (documents, terms, document
  frequencies) is summed from the chunks.
* Search, chunk by chunk: a query's short lists (at most ``SHORT`` of the chunk's documents) are summed into accumulators,
  materialised in the order of the documents. From there they are one more iterator, with a largest score like any
  list. The iterators walk document spans in order: a span whose largest scores together miss the bar is skipped; in
  the others, documents of the essential iterators (without which the bar can't be reached) are scored, and the rest
  are looked up by search in the long lists, largest bound first, only for documents that may still reach the bar. The bar
  is the k-th best score so far, and rises from chunk to chunk.
* First bar: the k-th best score among a few chunks (``FIRST_SHARE`` of them, at most ``FIRST_CHUNKS``) is a lower bound
  of the k-th best of all. It spares work and decides nothing; equal scores pass it, since the smaller id wins.
* Each task returns at most k rows a query, the ranks come from a window over them.

Queries are broadcast in parts of at most ``ITEMS`` rows and about ``ITEM_CHARS`` characters; more queries mean more passes.

Scores are whole numbers: a term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is
100 - 90 + (90 n N) div L, and the term adds weight * ((10^9 tf) div (1000 tf + 8 m)).

Cases: NULL and empty texts have no terms, count for nothing and are never found, as queries they find nothing; each row of
the queries is a query, under its id or none; a document row is found by itself, so repeated rows take a rank each; NULL
ids come after all others of a score; empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldloom.llm.common import lowest_hashes, utf8_texts
from fieldloom.session import materialise

ITEMS, ITEM_CHARS = 1 << 16, 1 << 27
CHUNK_DOCS, CHUNK_ENTRIES = 1 << 15, 1 << 21
SHORT, SPAN = 1 / 32, 512
FIRST_SHARE, FIRST_CHUNKS = 1 / 16, 256

#: ASCII letters and digits and all bytes above ASCII make terms; A-Z as a-z; anything else parts them.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

FOUND = "item int, doc_id long, score long"
CHUNKS = "ids array<bigint>, n long, lengths binary, terms array<int>, counts array<bigint>, docs binary, tfs binary"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


class _Numbers(dict):
    """Number of a term, -1 for those that no query has."""

    def __missing__(self, _term: bytes) -> int:
        return -1


class Queries:
    """One part of the queries: their ids, and their distinct terms as numbers."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.ids = [i for i, _ in rows]
        self.numbers = _Numbers()
        self.terms = [list(dict.fromkeys(self.numbers.setdefault(t, len(self.numbers)) for t in terms_of((text or "").encode()))) for _, text in rows]


def query_parts(items: DataFrame) -> Iterator[Queries]:
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, chars = rows.agg(F.count("*"), F.sum(F.length("text"))).first()
    parts = max(math.ceil(n / ITEMS), math.ceil((chars or 0) / ITEM_CHARS))
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        yield Queries([tuple(r) for r in own])


def build_index(docs: DataFrame, queries: Queries) -> DataFrame:
    """The stored chunks of ``docs`` (doc_id, text): each posting list of the queries' terms, and all lengths."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.numbers)

    def chunk(ids, lengths, terms, tfs):
        doc = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(t) for t in terms])
        term, tf = np.concatenate(terms), np.concatenate(tfs)
        order = np.argsort(term, kind="stable")
        present, counts = np.unique(term, return_counts=True)
        return {
            "ids": ids, "n": sum(lengths), "lengths": np.array(lengths, np.int64).tobytes(), "terms": present.tolist(), "counts": counts.tolist(),
            "docs": doc[order].tobytes(), "tfs": tf[order].astype(np.uint32).tobytes(),
        }

    def run(batches):
        number = shared.value.__getitem__
        ids, lengths, terms, tfs, entries = [], [], [], [], 0
        names = ("ids", "n", "lengths", "terms", "counts", "docs", "tfs")
        kinds = pa.schema(list(zip(names, (pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary()))))

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), utf8_texts(batch["text"])):
                words = terms_of(text)
                if not words:
                    continue
                found = np.fromiter(map(number, words), np.int32, len(words))
                known, tf = np.unique(found[found >= 0], return_counts=True)
                ids.append(doc)
                lengths.append(len(words))
                terms.append(known)
                tfs.append(tf)
                entries += len(known)
                if len(ids) >= CHUNK_DOCS or entries >= CHUNK_ENTRIES:
                    yield pa.RecordBatch.from_pylist([chunk(ids, lengths, terms, tfs)], kinds)
                    ids, lengths, terms, tfs, entries = [], [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([chunk(ids, lengths, terms, tfs)], kinds)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, CHUNKS)
    return materialise(rows.withColumn("chunk", F.monotonically_increasing_id()))


class PostingList:
    """Documents in order with their scores; ``begin`` and ``tops`` by span."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, spans: int):
        self.docs, self.scores, self.most = docs, scores, int(scores.max())
        self.begin = np.searchsorted(docs, np.arange(spans + 1) * SPAN)
        self.tops = np.zeros(spans, np.int64)
        np.maximum.at(self.tops, docs // SPAN, scores)

    def look_up(self, docs: np.ndarray, span: int) -> np.ndarray:
        """Scores of ``docs``, which lie in ``span``; 0 where they are not in the list."""
        a, b = self.begin[span], self.begin[span + 1]
        if a == b:
            return np.zeros(len(docs), np.int64)
        at = np.minimum(a + np.searchsorted(self.docs[a:b], docs), b - 1)
        return np.where(self.docs[at] == docs, self.scores[at], 0)


def summed(lists: list[PostingList], spans: int) -> PostingList:
    """Accumulators: the lists' scores added by document."""
    docs = np.concatenate([x.docs for x in lists])
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], np.concatenate([x.scores for x in lists])[order]
    first = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
    return PostingList(docs[first], np.add.reduceat(scores, first), spans)


class Chunk:
    """One stored chunk under the weights of the whole table."""

    def __init__(self, row: dict, weights: np.ndarray, total_docs: int, total_terms: int):
        self.ids = row["ids"]
        self.spans = -(-len(self.ids) // SPAN)
        length = np.frombuffer(row["lengths"], np.int64)
        self.m = 100 - 90 + (90 * length * total_docs) // total_terms
        until = np.cumsum(row["counts"])
        self.place = {t: (b - n, b) for t, n, b in zip(row["terms"], row["counts"], until.tolist())}
        self.docs, self.tfs = np.frombuffer(row["docs"], np.uint32), np.frombuffer(row["tfs"], np.uint32)
        self.weights, self.lists = weights, {}

    def posting(self, term: int) -> PostingList | None:
        if term not in self.lists:
            a, b = self.place.get(term, (0, 0))
            docs, tf = self.docs[a:b].astype(np.int64), self.tfs[a:b].astype(np.int64)
            scores = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.m[docs]))
            self.lists[term] = PostingList(docs, scores, self.spans) if a < b and self.weights[term] else None
        return self.lists[term]

    def search(self, terms: list[int], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents whose score reaches the bar and the k-th best score here, and their scores."""
        lists = [x for x in map(self.posting, terms) if x is not None]
        short = [x for x in lists if len(x.docs) <= SHORT * len(self.ids)]
        walked = [x for x in lists if len(x.docs) > SHORT * len(self.ids)] + ([summed(short, self.spans)] if short else [])
        walked.sort(key=lambda x: -x.most)
        rest = np.cumsum([0] + [x.most for x in reversed(walked)])[::-1]  # what the iterators from a number on add at most
        tops = sum((x.tops for x in walked), np.zeros(self.spans, np.int64))
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for span in np.flatnonzero(tops >= bar).tolist():
            if tops[span] < bar:
                continue
            essential = int(np.searchsorted(-rest, -bar, "right"))  # the first number from which on the bar is out of reach
            sums, base = np.zeros(SPAN, np.int64), span * SPAN
            for x in walked[:essential]:
                a, b = x.begin[span], x.begin[span + 1]
                sums[x.docs[a:b] - base] += x.scores[a:b]
            near = np.flatnonzero((sums > 0) & (sums + rest[min(essential, len(walked))] >= bar))
            here, got = near + base, sums[near]
            for number in range(essential, len(walked)):
                may = got + rest[number] >= bar
                here, got = here[may], got[may]
                if not len(here):
                    break
                got = got + walked[number].look_up(here, span)
            may = got >= bar
            docs, scores = np.concatenate((docs, here[may])), np.concatenate((scores, got[may]))
            if len(scores) >= k:
                bar = max(bar, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        may = scores >= bar
        return docs[may], scores[may]


def _best(rows: list[tuple], k: int) -> list[tuple]:
    """The k best (score, doc_id): highest score, then smallest id, NULL last."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k]


def _scan(index: DataFrame, shared, k: int) -> DataFrame:
    """At most k rows of each query from each task."""

    def run(batches):
        queries, weights, total_docs, total_terms, bars = shared.value
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, weights, total_docs, total_terms)
                for item, terms in enumerate(queries.terms):
                    kept = best.get(item, [])
                    bar = max(int(bars[item]), kept[-1][0] if len(kept) == k else 1)
                    docs, scores = chunk.search(terms, k, bar)
                    if len(docs):
                        best[item] = _best(kept + [(s, chunk.ids[d]) for d, s in zip(docs.tolist(), scores.tolist())], k)
        rows = [(item, doc, score) for item, kept in best.items() for score, doc in kept]
        columns = list(zip(*rows)) or [()] * 3
        yield pa.record_batch([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["item", "doc_id", "score"])

    ranked = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return index.drop("chunk").mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of each query (item_id, text)."""
    spark, out = docs.sparkSession, None
    for queries in query_parts(items):
        index = build_index(docs, queries)
        total_docs, total_terms, chunks = index.agg(F.sum(F.size("ids")).cast("long"), F.sum("n"), F.count("*")).first()
        if not chunks:
            break
        frequency = np.zeros(len(queries.numbers), np.int64)
        pairs = index.select(F.inline(F.arrays_zip("terms", "counts"))).groupBy("terms").agg(F.sum("counts").alias("df"))
        for term, df in pairs.collect():
            frequency[term] = df
        weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)
        bars = np.ones(len(queries.ids), np.int64)
        first = lowest_hashes(index, "chunk", 42, min(FIRST_SHARE, FIRST_CHUNKS / chunks))
        for r in _scan(first, spark.sparkContext.broadcast((queries, weights, total_docs, total_terms, bars)), k).where(F.col("rank") == k).collect():
            bars[r["item"]] = r["score"]
        found = _scan(index, spark.sparkContext.broadcast((queries, weights, total_docs, total_terms, bars)), k)
        names = spark.createDataFrame(list(enumerate(queries.ids)), "item int, item_id long")
        part = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
