"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Each task rolls a 64-bit polynomial over its words and a second, independent one that deals the windows to
buckets, so two different windows are taken for equal only if both agree: the bits that must agree grow
with the number of buckets, which grows with the data. Within a chunk a window that an earlier document has is
settled at once, so a passage in a third of all documents reaches its bucket once for each chunk, not for
each document. A bucket finds the smallest document of every window; the places of the others go back to
their chunk, where they merge into maximal intervals, which then meet the texts by document; texts that surely have none
(by a Bloom filter of those that have) stay out of that exchange.

Cases: NULL and empty texts have no words; a text shorter than the window loses nothing; a row with a NULL id
is kept whole and makes no other lose words (no id is smaller); rows sharing an id do not remove each other's
words; an empty table gives an empty result; extra columns are carried by ``cleaned`` and never looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm import packed
from fieldloom.llm.common import KeyFilter, merge_intervals, text_key, utf8_texts
from fieldloom.session import materialise

#: Words of a chunk and UTF-8 bytes of text for each bucket, both for bounded memory.
CHUNK_WORDS, BUCKET_BYTES, MEMO = 500_000, 5_000_000, 1 << 17
_BASES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO:
            self[word] = value
        return value


def rolled(words: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of the window starting at each word, modulo 2^64, its bits mixed."""
    n = len(words) - width + 1
    value = words[:n].copy()
    for j in range(1, width):
        value *= base
        value += words[j: j + n]
    value ^= value >> np.uint64(32)
    value *= _MIX
    return value ^ (value >> np.uint64(29))


def _chunks(batches, memo: WordHashes) -> Iterator[tuple[list, list, list]]:
    ids, texts, hashes, size = [], [], [], 0
    for b in batches:
        for doc, key, text in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), utf8_texts(b["text"])):
            words = text.split()
            if doc is None or not words:
                continue
            ids.append(doc)
            texts.append(key)
            hashes.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
            size += len(words)
            if size >= CHUNK_WORDS:
                yield ids, texts, hashes
                ids, texts, hashes, size = [], [], [], 0
    if ids:
        yield ids, texts, hashes


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), *((n, pa.binary()) for n in ("ids", "texts", "counts", "gaps", "far", "hashes", "lanes"))])


def _send(width: int, buckets: int):
    def run(batches):
        memo, part = WordHashes(), TaskContext.get().partitionId()
        for number, (ids, texts, hashes) in enumerate(_chunks(batches, memo)):
            chunk = (part << 20) + number
            order = np.lexsort((np.array(texts, np.int64), np.array(ids, np.int64)))
            ids, texts = np.array(ids, np.int64)[order], np.array(texts, np.int64)[order]
            sizes = np.array([len(hashes[i]) for i in order])
            words = np.concatenate([hashes[i] for i in order])
            if len(words) < width:
                continue
            begin = np.cumsum(sizes) - sizes
            windows = np.maximum(0, sizes - width + 1)
            doc = np.repeat(np.arange(len(sizes), dtype=np.int32), windows)
            if not len(doc):
                continue
            place = (np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)).astype(np.int32)
            at = begin[doc] + place
            keys = rolled(words, width, _BASES[0])[at]
            bucket = ((rolled(words, width, _BASES[1])[at] >> np.uint64(20)) % np.uint64(buckets)).astype(np.uint32)
            together, first = packed.runs(keys)
            low = ids[doc[np.minimum.reduceat(together, first)]]
            late = np.zeros(len(keys), bool)
            late[together] = ids[doc[together]] > np.repeat(low, packed.run_lengths(first, len(keys)))
            # Entries name a document by its number in the chunk; its text's hash goes to the chunk once, not to every bucket.
            numbers, nothing = np.arange(len(ids)), np.empty(0, np.int64)
            rows = [packed.pack(int(chunk % buckets), chunk, 2, nothing, nothing, nothing, nothing) | {"texts": texts.astype(np.int64).tobytes()}]
            if late.any():
                rows.append(_slim(packed.pack(int(chunk % buckets), chunk, 1, ids, numbers, doc[late], place[late])))
            kept = np.flatnonzero(~late)
            for k, own in enumerate(packed.by_bucket(bucket[kept], buckets)):
                if len(own):
                    e = kept[own]
                    rows.append(_slim(packed.pack(k, chunk, 0, ids, numbers, doc[e], place[e], keys[e])))
            yield _batch(rows)

    return run


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second ones, and so on: small numbers leave long runs of zeros, which the exchange's compression takes out."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _slim(row: dict) -> dict:
    """A packed row whose ids and document numbers are differences, and these and the counts byte planes."""
    steps = {c: _planes(np.diff(np.frombuffer(row[c], np.int64), prepend=0)) for c in ("ids", "texts")}
    return row | steps | {"counts": _planes(np.frombuffer(row["counts"], np.uint32))}


def _full(row):
    """A slim row as ``packed`` reads it."""
    steps = {c: np.cumsum(_from_planes(getattr(row, c), np.int64)).tobytes() for c in ("ids", "texts")}
    return row._replace(**steps, counts=_from_planes(row.counts, np.uint32).tobytes())


def _settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the entries whose window a smaller document has, back under their chunks."""
    out = [r._asdict() | {"hashes": b""} for r in rows[rows["kind"] != 0].drop(columns="bucket").itertuples(index=False)]
    parts = [(r.chunk, *packed.unpack(_full(r))) for r in rows[rows["kind"] == 0].itertuples(index=False)]
    if parts:
        ids = np.concatenate([p[1][p[3]] for p in parts])
        order, first = packed.runs(np.concatenate([p[5] for p in parts]))
        late = np.empty(len(ids), bool)
        late[order] = ids[order] > np.repeat(np.minimum.reduceat(ids[order], first), packed.run_lengths(first, len(ids)))
        at = 0
        for chunk, names, texts, doc, place, _ in parts:
            own = late[at: at + len(doc)]
            at += len(doc)
            if own.any():
                row = _slim(packed.pack(0, chunk, 1, names, texts, doc[own], place[own]))
                del row["bucket"]
                out.append(row)
    return pd.DataFrame(out, columns=["chunk", "kind", "ids", "texts", "counts", "gaps", "far", "hashes", "lanes"])


def _gather(width: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Of one chunk: the intervals of each document, as packed starts and ends."""
        names = next(r for r in rows.itertuples(index=False) if r.kind == 2)
        keys = np.frombuffer(names.texts, np.int64)
        parts = [packed.unpack(_full(r)) for r in rows.itertuples(index=False) if r.kind == 1]
        if not parts:
            return pd.DataFrame({"doc_id": [], "text_key": [], "starts": [], "ends": []})
        ids, texts = np.concatenate([p[0][p[2]] for p in parts]), np.concatenate([keys[p[1][p[2]]] for p in parts])
        place = np.concatenate([p[3] for p in parts])
        order = np.lexsort((place, texts, ids))
        ids, texts, place = ids[order], texts[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1]))))
        out = []
        for a, b in zip(first, [*first[1:], len(ids)]):
            starts, ends = merge_intervals(place[a:b], place[a:b] + width)
            out.append((ids[a], texts[a], starts.astype(np.int32).tobytes(), ends.astype(np.int32).tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "text_key", "starts", "ends"])

    return run


def bucket_count(docs: DataFrame, bucket_bytes: int) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(size / bucket_bytes))


def repeated_intervals(docs: DataFrame, width: int = 13) -> DataFrame:
    """doc_id, text_key, starts, ends (int32 words, half open, maximal) of what repeats from smaller documents."""
    buckets = bucket_count(docs, BUCKET_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text").mapInArrow(_send(width, buckets), packed.SCHEMA)
    replies = "chunk long, kind int, ids binary, texts binary, counts binary, gaps binary, far binary, hashes binary, lanes binary"
    late = rows.groupBy("bucket").applyInPandas(_settle, replies)
    found = late.groupBy("chunk").applyInPandas(_gather(width), "doc_id long, text_key long, starts binary, ends binary")
    return found.dropDuplicates(["doc_id", "text_key"])


def kept_words(text: bytes, starts: bytes | None, ends: bytes | None) -> tuple[int, int, bytes]:
    """Number of words, of removed ones, and the kept words joined by one space."""
    words = text.split()
    n, removed = len(words), 0
    if starts:
        kept, at = [], 0
        for a, b in zip(np.frombuffer(starts, np.int32).tolist(), np.frombuffer(ends, np.int32).tolist()):
            kept += words[at:a]
            removed += b - a
            at = b
        words = kept + words[at:]
    return n, removed, b" ".join(words)


def with_intervals(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` under ``row`` with starts and ends of what is to go, NULL where nothing is."""
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "starts", "ends")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("_doc"), text_key().alias("_text"))
    return rows.join(found, (F.col("_doc") == F.col("_id")) & (F.col("_text") == F.col("_key")), "left").select("row", "starts", "ends")


_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _digests(ids: pa.Array, texts: pa.Array, starts: list, ends: list) -> pa.RecordBatch:
    done = [kept_words(t, s, e) for t, s, e in zip(utf8_texts(texts), starts, ends)]
    return pa.record_batch([ids.cast(pa.int64()), pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                            pa.array([hashlib.sha256(d[2]).hexdigest() for d in done], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def dedup_windows(docs: DataFrame, width: int = 13) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256.

    Only texts that the filter of the found documents lets through meet the intervals in a join; the others are
    settled where they are read.
    """
    found = materialise(repeated_intervals(docs, width))
    among = KeyFilter(found.select(F.xxhash64("doc_id", "text_key").alias("name")), "name")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *among.places(F.xxhash64(F.col("doc_id").cast("long"), text_key())))

    def apart(batches):
        for b in batches:
            b = b.filter(pa.array(~among.holds(b)))
            nothing = [None] * len(b)
            yield _digests(b["doc_id"], b["text"], nothing, nothing)

    def through(batches):
        for b in batches:
            yield b.filter(pa.array(among.holds(b))).select(["doc_id", "text"])

    def met(batches):
        for b in batches:
            yield _digests(b["doc_id"], b["text"], b["starts"].to_pylist(), b["ends"].to_pylist())

    rows = with_intervals(named.mapInArrow(through, "doc_id long, text string"), found).select("row.doc_id", "row.text", "starts", "ends")
    return rows.mapInArrow(met, _DIGEST).union(named.mapInArrow(apart, _DIGEST))


def cleaned(docs: DataFrame, width: int = 13) -> DataFrame:
    """``docs`` with repeated windows taken out of ``text`` (words joined by one space where any went), all other columns kept."""

    @F.pandas_udf("string")
    def rest(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else kept_words(t.encode(), s, e)[2].decode() for t, s, e in zip(text, starts, ends)], dtype=object)

    rows = with_intervals(docs, materialise(repeated_intervals(docs, width)))
    text = rest(F.col("row.text"), F.col("starts"), F.col("ends"))
    return rows.withColumn("_text", text).select(*[F.col("_text").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
