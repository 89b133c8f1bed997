"""Packed exchange of hashes: many (hash, document, place) entries travel as a few binary rows.

A task writes one row for each bucket and chunk of documents; the entries of a row are ordered by document and
place, so a place costs about one byte next to the eight of its hash. What is found about an entry goes back
under its chunk in the same form, without the hash. Documents are named by (id, hash of the text), so rows
that share an id keep apart.
"""

from __future__ import annotations

import numpy as np

#: Fields of a packed row; ``lanes`` holds further columns of an entry, one after the other.
SCHEMA = "bucket int, chunk long, kind int, ids binary, texts binary, counts binary, gaps binary, far binary, hashes binary, lanes binary"


def pack(bucket: int, chunk: int, kind: int, ids: np.ndarray, texts: np.ndarray, doc: np.ndarray, place: np.ndarray,
         hashes: np.ndarray | None = None, lanes: list[np.ndarray] | None = None) -> dict:
    """Entries ordered by (doc, place); ``doc`` indexes ids and texts."""
    first = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
    used = doc[first]
    counts = np.diff(np.concatenate((np.flatnonzero(first), [len(doc)]))).astype(np.uint32)
    gaps = np.diff(place.astype(np.int64), prepend=0)
    gaps[first] = place[first]
    far = gaps[gaps >= 255].astype(np.uint32)
    return {
        "bucket": bucket, "chunk": chunk, "kind": kind, "ids": ids[used].astype(np.int64).tobytes(), "texts": texts[used].astype(np.int64).tobytes(),
        "counts": counts.tobytes(), "gaps": np.minimum(gaps, 255).astype(np.uint8).tobytes(), "far": far.tobytes(),
        "hashes": b"" if hashes is None else hashes.astype(np.uint64).tobytes(), "lanes": b"".join(x.tobytes() for x in lanes or ()),
    }


def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, texts (of documents), doc, place, hashes (of entries)."""
    counts = np.frombuffer(row.counts, np.uint32)
    gaps = np.frombuffer(row.gaps, np.uint8).astype(np.int64)
    gaps[gaps == 255] = np.frombuffer(row.far, np.uint32)
    doc = np.repeat(np.arange(len(counts)), counts)
    total = np.cumsum(gaps)
    begin = np.cumsum(counts) - counts
    before = total[begin] - gaps[begin]
    return np.frombuffer(row.ids, np.int64), np.frombuffer(row.texts, np.int64), doc, total - before[doc], np.frombuffer(row.hashes, np.uint64)


def lane(row, number: int, kinds: list) -> np.ndarray:
    """Column ``number`` of the lanes, given the type of each."""
    n = len(row.gaps)
    begin = sum(n * np.dtype(k).itemsize for k in kinds[:number])
    return np.frombuffer(row.lanes, kinds[number], n, begin)


def by_bucket(bucket: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Entry numbers of each bucket, in order."""
    small = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    order = np.argsort(small, kind="stable")
    return np.split(order, np.searchsorted(small[order], np.arange(1, buckets)))


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each run begins in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    return order, np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else order


def run_lengths(begin: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.concatenate((begin, [n])))
