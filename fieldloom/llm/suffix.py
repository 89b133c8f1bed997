"""Suffix-array dedup of byte strings: column-wise construction of a collection's Burrows-Wheeler transform.

The construction inserts one symbol per string each round, from the last column to the first: the symbol goes
into the transform where the string's current suffix stands, a stable count of symbols gives the place of the
suffix one longer, and the whole transform is rewritten in order. A round costs one pass over everything
inserted so far, so over whole texts of 100,000 bytes it would cost 100,000 passes over the corpus. Therefore the
strings are short pieces, dealt to shards so that equal substrings meet:

1. Every ``width``-byte window has an anchor, its least hashed ``gram``-byte substring. Consecutive windows with
   one anchor form a segment, ``width`` + at most ``width - gram`` bytes. Equal windows have equal anchors at equal
   offsets, so they lie in segments of one anchor. Anchors travel packed, about 20 bytes for 35 bytes of text.
2. Segments with equal anchor and content (two 64-bit hashes, offset and length) are one; all but the earliest
   lose their windows. Only if an anchor has several contents can windows be shared otherwise: the earliest of each
   is sent, with its bytes, to a shard of its anchor.
3. The shard builds the transform of its segments. Suffixes of ``width`` bytes and more then stand in order, the
   common prefixes of neighbours delimit the classes of equal windows, and the earliest window of a class stays.
4. An anchor with more than ``COLLECTION`` contents (text that very many documents share, each among words of its
   own) goes to no shard. Its windows are dealt one by one as in step 2, named by 128 bits of BLAKE2b; of equal
   names a chunk sends the earliest only. Anchors that a sample of the documents shows as common are dealt by
   content in step 2 already, so that no bucket holds all of one anchor.
5. Intervals from 2, 3 and 4 are merged by document and meet the texts.

The transform and its arrays are read and written in order, but kept in the memory of the task: a collection has
at most ``COLLECTION`` segments and a shard whole anchors of at most so many, so no file outside the shared folder
is needed.

Cases: NULL and empty texts have no bytes; texts shorter than ``width`` lose nothing; a row with a NULL id is kept
whole and removes nothing elsewhere; rows with one id and equal text are one document, those with one id and
different texts are ordered by the text's hash; an empty table gives an empty result; extra columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm import packed
from fieldloom.llm.common import merge_intervals, text_key, utf8_texts
from fieldloom.llm.substring import bucket_count
from fieldloom.session import materialise

#: Bytes of a chunk and of text for each bucket, segments for each shard and for one transform: all for bounded memory.
CHUNK_BYTES, BUCKET_BYTES, SHARD_SEGMENTS, COLLECTION = 2_000_000, 16_000_000, 16_384, 384
#: One document of so many is looked at for common anchors; how often an anchor must occur there, and how many are listed.
SAMPLE, COMMON, LISTED = 64, 64, 50_000
#: Windows of common anchors in a chunk and for each bucket.
CHUNK_WINDOWS, BUCKET_WINDOWS = 500_000, 400_000
GRAM = 32
LANES = [np.uint64, np.uint8]
REPLY = "chunk long, kind int, ids binary, texts binary, counts binary, gaps binary, far binary, hashes binary, lanes binary"
KNOWN, ASKED, SPREAD = 1, 2, 3
_BYTE = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little") | 1 for b in range(256)], np.uint64)
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
_TURN = 0xD6E8FEB86659FD93
_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), *((n, pa.binary()) for n in ("ids", "texts", "counts", "gaps", "far", "hashes", "lanes"))])


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Rabin-Karp hashes of all substrings of ``gram`` (a power of two) bytes, by doubling."""
    value, size, power = _BYTE[data], 1, _BASE
    while size < gram:
        value = value[:-size] * np.uint64(power) + value[size:]
        size, power = 2 * size, power * power % (1 << 64)
    value ^= value >> np.uint64(32)
    value *= _MIX
    return value ^ (value >> np.uint64(29))


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its least one (by its upper 40 bits), leftmost on ties."""
    low = np.uint64((1 << 24) - 1)
    best, size = (values & ~low) | np.arange(len(values), dtype=np.uint64), 1
    while 2 * size <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < width:
        best = np.minimum(best[: len(best) - (width - size)], best[width - size:])
    return (best & low).astype(np.int64)


def segments(data: np.ndarray, sizes: np.ndarray, width: int, gram: int = GRAM):
    """(doc, start, span, key, digest) of the segments of documents that stand one after the other.

    A segment holds the windows starting at start .. start + span. The digest covers its bytes, its length and
    how far in its anchor stands.
    """
    if len(data) < width:
        return [np.zeros(0, t) for t in (np.int64, np.int64, np.uint8, np.uint64, np.uint64)]
    hashes = gram_hashes(data, gram)
    anchor = leftmost_least(hashes, width - gram + 1)
    ends = np.cumsum(sizes)
    at = np.arange(len(anchor))
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    inside = at + width <= ends[doc]
    at, anchor, doc = at[inside], anchor[inside], doc[inside]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))) if len(at) else np.zeros(0, bool)
    begin, anchor, doc = at[first], anchor[first], doc[first]
    last = at[np.concatenate((first[1:], [True]))] if len(at) else at
    # Prefix sums of byte x base^place, divided by base^start: the content's hash wherever it stands.
    n, base = len(data) + 1, np.uint64(_TURN)
    power = np.cumprod(np.full(n, base))
    back = np.cumprod(np.full(n, np.uint64(pow(_TURN, -1, 1 << 64))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[:-1])))
    digest = (sums[last + width] - sums[begin]) * back[begin]
    digest ^= digest >> np.uint64(31)
    digest *= _MIX
    span, offset = last - begin, anchor - begin
    digest += (span * 256 + offset).astype(np.uint64) * np.uint64(_BASE)
    return doc, begin - (ends - sizes)[doc], span.astype(np.uint8), hashes[anchor], digest


def _common_anchors(rows: DataFrame, width: int) -> np.ndarray:
    """The most frequent anchors of a sample of the documents, ascending; they shape the exchange and never the result."""

    def run(batches):
        for b in batches:
            texts = [t for t in utf8_texts(b["text"]) if len(t) >= width]
            if texts:
                _, _, _, key, _ = _long_segments(texts, width)
                found, n = np.unique(key.view(np.int64), return_counts=True)
                yield pa.record_batch([pa.array(found), pa.array(n)], names=["anchor", "n"])

    sample = rows.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SAMPLE)) == 0)).select("text")
    counts = sample.mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    listed = [r["anchor"] for r in counts.orderBy(F.col("n").desc(), "anchor").limit(LISTED).collect()]
    return np.sort(np.array(listed, np.int64).view(np.uint64))


def _chunk_rows(chunk: int, buckets: int, ids, keys, doc, start, span, key, digest, dealt) -> list[dict]:
    """Packed rows of a chunk: equal entries but the earliest as KNOWN, the others for the bucket that ``dealt`` tells."""
    # Documents and starts ascend, so the least number of a run is its earliest segment.
    together, first = packed.runs(key * np.uint64(_BASE) + digest)
    least = np.empty(len(key), np.int64)
    least[together] = np.repeat(np.minimum.reduceat(together, first), packed.run_lengths(first, len(key)))
    late = (ids[doc] != ids[doc[least]]) | (keys[doc] != keys[doc[least]]) | (start != start[least])
    rows = []
    if late.any():
        rows.append(packed.pack(int(chunk % buckets), chunk, KNOWN, ids, keys, doc[late], start[late], None, [span[late]]))
    kept = np.flatnonzero(~late)
    bucket = (dealt[kept] >> np.uint64(24)) % np.uint64(buckets)
    for k, own in enumerate(packed.by_bucket(bucket, buckets)):
        if len(own):
            e = kept[own]
            rows.append(packed.pack(k, chunk, 0, ids, keys, doc[e], start[e], key[e], [digest[e], span[e]]))
    return rows


def _send(width: int, buckets: int, common: np.ndarray):
    def chunks(batches):
        ids, keys, texts, size = [], [], [], 0
        for b in batches:
            for doc, key, text in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), utf8_texts(b["text"])):
                if doc is None or len(text) < width:
                    continue
                if texts and size + len(text) > CHUNK_BYTES:
                    yield ids, keys, texts
                    ids, keys, texts, size = [], [], [], 0
                ids.append(doc)
                keys.append(key)
                texts.append(text)
                size += len(text)
        if texts:
            yield ids, keys, texts

    def run(batches):
        part = TaskContext.get().partitionId()
        for number, (ids, keys, texts) in enumerate(chunks(batches)):
            chunk = (part << 20) + number
            order = np.lexsort((np.array(keys, np.int64), np.array(ids, np.int64)))
            ids, keys = np.array(ids, np.int64)[order], np.array(keys, np.int64)[order]
            texts = [texts[i] for i in order]
            doc, start, span, key, digest = _long_segments(texts, width)
            if not len(doc):
                continue
            rows = _chunk_rows(chunk, buckets, ids, keys, doc, start, span, key, digest, np.where(np.isin(key, common), digest, key))
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def _long_segments(texts: list[bytes], width: int):
    """Segments of a chunk; a text longer than places can count is cut with an overlap of ``width - 1`` bytes."""
    most = (1 << 24) - 1
    if sum(map(len, texts)) <= most:
        return segments(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]), width)
    found = []
    for d, text in enumerate(texts):
        for at in range(0, max(1, len(text) - width + 1), most - width):
            piece = np.frombuffer(text, np.uint8)[at: at + most - 1]
            doc, start, *rest = segments(piece, np.array([len(piece)]), width)
            found.append((doc + d, start + at, *rest))
    return [np.concatenate(c) for c in zip(*found)]


def _send_windows(width: int, buckets: int):
    """Windows of the segments (doc_id, text_key, text, parts), each an entry of its own, named by 128 bits."""

    def documents(batches):
        for b in batches:
            for doc, key, text, parts in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), utf8_texts(b["text"]), b["parts"].to_pylist()):
                start, span = (np.frombuffer(b"".join(p[c] for p in parts), t).astype(np.int64) for c, t in (("start", np.int32), ("span", np.uint8)))
                first = np.cumsum(span + 1) - span - 1
                at = np.sort(np.arange((span + 1).sum()) + np.repeat(start - first, span + 1))
                yield doc, key, at, b"".join(hashlib.blake2b(text[x: x + width], digest_size=16).digest() for x in at.tolist())

    def chunks(batches):
        held, size = [], 0
        for d in documents(batches):
            if held and size + len(d[2]) > CHUNK_WINDOWS:
                yield held
                held, size = [], 0
            held.append(d)
            size += len(d[2])
        if held:
            yield held

    def run(batches):
        part = TaskContext.get().partitionId()
        for number, held in enumerate(chunks(batches)):
            held.sort(key=lambda d: d[:2])
            ids, keys = np.array([d[0] for d in held], np.int64), np.array([d[1] for d in held], np.int64)
            doc, start = np.repeat(np.arange(len(held)), [len(d[2]) for d in held]), np.concatenate([d[2] for d in held])
            names = np.frombuffer(b"".join(d[3] for d in held), np.uint64).reshape(-1, 2)
            key, digest = names[:, 0].copy(), names[:, 1].copy()
            rows = _chunk_rows((part << 20) + number, buckets, ids, keys, doc, start, np.zeros(len(doc), np.uint8), key, digest, key)
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def _settled(rows: pd.DataFrame, common: np.ndarray) -> pd.DataFrame:
    """Of one bucket: equal segments but the earliest (KNOWN), and what only the bytes can tell, by transforms (ASKED) or by windows (SPREAD)."""
    out = [r._asdict() | {"hashes": b""} for r in rows[rows["kind"] == KNOWN].drop(columns="bucket").itertuples(index=False)]
    parts = [(r.chunk, *packed.unpack(r), *(packed.lane(r, k, LANES) for k in range(2))) for r in rows[rows["kind"] == 0].itertuples(index=False)]
    if parts:
        ids, texts = np.concatenate([p[1][p[3]] for p in parts]), np.concatenate([p[2][p[3]] for p in parts])
        place, keys, digest = (np.concatenate([p[k] for p in parts]) for k in (4, 5, 6))
        order = np.lexsort((digest, keys))
        k, g = keys[order], digest[order]
        new_key = np.concatenate(([True], k[1:] != k[:-1]))
        new = new_key | np.concatenate(([True], g[1:] != g[:-1]))
        # Most segments stand alone; only the others need an order by document.
        run = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        several = np.flatnonzero(packed.run_lengths(first, len(order))[run] > 1)
        e = order[several]
        inner = np.lexsort((place[e], texts[e], ids[e], run[several]))
        order[several] = e[inner]
        lead = order[first][run]
        late = np.zeros(len(ids), bool)
        late[order] = (ids[order] != ids[lead]) | (texts[order] != texts[lead]) | (place[order] != place[lead])
        kinds = np.add.reduceat(new, np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
        wide = np.isin(k, common) | (kinds > COLLECTION)
        asked, spread = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        asked[order], spread[order] = new & (kinds > 1) & ~wide, new & wide
        at = 0
        for chunk, names, keys_, doc, place, hashes, _, span in parts:
            for kind, own in ((KNOWN, late[at: at + len(doc)]), (ASKED, asked[at: at + len(doc)]), (SPREAD, spread[at: at + len(doc)])):
                if own.any():
                    more = (hashes[own] if kind == ASKED else None, [span[own]])
                    row = packed.pack(0, chunk, kind, names, keys_, doc[own], place[own], *more)
                    del row["bucket"]
                    out.append(row)
            at += len(doc)
    return pd.DataFrame(out, columns=[c.split()[0] for c in REPLY.split(", ")])


def _settle(common: np.ndarray):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _settled(rows, common)

    return run


def _by_document(rows: pd.DataFrame, lanes: list):
    """For each document of a chunk's replies: id, text key, starts, hashes and lanes."""
    parts = [(*packed.unpack(r), *(packed.lane(r, k, lanes) for k in range(len(lanes)))) for r in rows.itertuples(index=False)]
    ids, texts = np.concatenate([p[0][p[2]] for p in parts]), np.concatenate([p[1][p[2]] for p in parts])
    order = np.lexsort((texts, ids))
    ids, texts = ids[order], texts[order]
    rest = [c[order] if len(c) else c for c in (np.concatenate([p[k] for p in parts]) for k in range(3, 5 + len(lanes)))]
    first = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1]))))
    for a, b in zip(first, [*first[1:], len(ids)]):
        yield ids[a], texts[a], *(c[a:b] for c in rest)


def _known(width: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc, text, start, _, span in _by_document(rows, [np.uint8]):
            starts, ends = merge_intervals(start, start + span + width)
            out.append((doc, text, starts.astype(np.int32).tobytes(), ends.astype(np.int32).tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "text_key", "starts", "ends"])

    return run


def _asked(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    out = [(doc, text, start.astype(np.int32).tobytes(), keys.tobytes(), span.tobytes()) for doc, text, start, keys, span in _by_document(rows, [np.uint8])]
    return pd.DataFrame(out, columns=["_id", "_key", "start", "anchor", "span"])


def transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All non-empty suffixes of the collection in order, as (string, start); equal ones by string.

    Round t inserts the t-th symbol from the end of every string that has one.
    """
    m = len(strings)
    sizes = np.array([len(s) for s in strings])
    longest = int(sizes.max())
    if longest > 1023 or int(sizes.sum()) >= 1 << 31:
        raise OverflowError(f"{m} strings of up to {longest} bytes are beyond one transform")
    table = np.frombuffer(b"".join(s.rjust(longest, b"\0") for s in strings), np.uint8).reshape(m, longest)
    used = np.unique(np.frombuffer(b"".join(strings), np.uint8))
    code = np.zeros(256, np.uint16 if len(used) > 255 else np.uint8)
    code[used] = np.arange(1, len(used) + 1)
    columns = np.ascontiguousarray(code[table].T)
    symbols, names = np.zeros(m, code.dtype), np.full(m, -1, np.int64)
    place = np.arange(m)
    for t in range(1, longest + 1):
        active = np.flatnonzero(sizes >= t)
        symbols[place[active]] = columns[longest - t][active]
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        new = rank[place[active]] - np.count_nonzero(symbols == 0) + m
        old = np.ones(len(symbols) + len(active), bool)
        old[new] = False
        wider, called = np.zeros(len(old), code.dtype), np.empty(len(old), np.int64)
        wider[old], called[old] = symbols, names
        called[new] = active * 1024 + t
        symbols, names = wider, called
        place[active] = new
    names = names[names >= 0]
    return names >> 10, sizes[names >> 10] - (names & 1023)


def late_windows(strings: list[bytes], before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of every window that also starts in another string that is earlier by ``before`` (its rank)."""
    string, start = transform(strings)
    sizes = np.array([len(s) for s in strings])
    long = sizes[string] - start >= width
    string, start = string[long], start[long]
    if not len(string):
        return string, start
    data = np.frombuffer(b"".join(strings), np.uint8)
    at = (np.cumsum(sizes) - sizes)[string] + start
    # Common prefixes of neighbours, as far as the width: eight bytes at a time.
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    same = np.ones(len(at) - 1, bool)
    for k in (*range(0, width - 8, 8), width - 8) if width >= 8 else ():
        near = np.flatnonzero(same)
        same[near] = (words[at[near] + k] == words[at[near + 1] + k]).all(axis=1)
    if width < 8:
        same = np.array([bytes(data[a: a + width]) == bytes(data[b: b + width]) for a, b in zip(at[:-1], at[1:])], bool)
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    rank = before[string]
    low = np.repeat(np.minimum.reduceat(rank, first), packed.run_lengths(first, len(rank)))
    return string[rank > low], start[rank > low]


def _compare(width: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Of one shard: transforms over collections of whole anchors, intervals of the later windows by document."""
        rows = rows.sort_values(["anchor", "doc_id", "text_key", "start"], kind="stable").reset_index(drop=True)
        anchors = rows["anchor"].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
        # A collection ends before the anchor that would pass its size; one anchor's segments stay together.
        cuts, ends = [0], [*first[1:].tolist(), len(rows)]
        for a, b in zip(first.tolist(), ends):
            if b - a > COLLECTION:
                raise OverflowError(f"{b - a} segments of one anchor in a transform")
            if b - cuts[-1] > COLLECTION:
                cuts.append(a)
        cuts.append(len(rows))
        data, start, found = rows["data"].tolist(), rows["start"].to_numpy(np.int64), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            # Rows ascend within an anchor, and equal windows lie in one anchor's rows, so the row number ranks them.
            string, at = late_windows(data[a:b], np.arange(b - a), width)
            found.append(np.stack([string + a, start[string + a] + at]))
        row, begin = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        order = np.lexsort((begin, row))
        row, begin = row[order], begin[order]
        lead = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
        ids, texts, out = rows["doc_id"].to_numpy(), rows["text_key"].to_numpy(), []
        for a, b in zip(lead, [*lead[1:], len(row)]):
            starts, ends = merge_intervals(begin[a:b], begin[a:b] + width)
            out.append((ids[row[a]], texts[row[a]], starts.astype(np.int32).tobytes(), ends.astype(np.int32).tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "text_key", "starts", "ends"])

    return run


def repeated_intervals(docs: DataFrame, width: int = 100) -> DataFrame:
    """doc_id, text_key and lists of packed starts and ends (int32 bytes, half open) of what also starts earlier."""
    if not GRAM < width <= GRAM + 255:
        raise ValueError(f"width must be above {GRAM} and at most {GRAM + 255}")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), "text")
    common = _common_anchors(rows, width)
    sent = rows.mapInArrow(_send(width, bucket_count(docs, BUCKET_BYTES), common), packed.SCHEMA)
    settled = materialise(sent.groupBy("bucket").applyInPandas(_settle(common), REPLY))
    schema = "doc_id long, text_key long, starts binary, ends binary"
    known = settled.where(F.col("kind") == KNOWN).groupBy("chunk").applyInPandas(_known(width), schema)
    entries = settled.where(F.col("kind") == ASKED)
    shards = max(1, math.ceil((entries.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0) / 8 / SHARD_SEGMENTS))

    def segments_of(kind: int) -> DataFrame:
        """The texts with places, anchors and spans of their segments of this kind."""
        asked = settled.where(F.col("kind") == kind).groupBy("chunk").applyInPandas(_asked, "_id long, _key long, start binary, anchor binary, span binary")
        asked = asked.groupBy("_id", "_key").agg(F.collect_list(F.struct("start", "anchor", "span")).alias("parts"))
        return (
            rows.join(asked, (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key"))).dropDuplicates(["_id", "_key"])
            .select("doc_id", "text_key", "text", "parts")
        )

    def cut(batches):
        for b in batches:
            out = []
            for doc, key, text, parts in zip(b["doc_id"].to_pylist(), b["text_key"].to_pylist(), utf8_texts(b["text"]), b["parts"].to_pylist()):
                start, anchor, span = (b"".join(p[c] for p in parts) for c in ("start", "anchor", "span"))
                anchors = np.frombuffer(anchor, np.uint64)
                for s, k, a, n in zip(np.frombuffer(start, np.int32).tolist(), ((anchors >> np.uint64(8)) % np.uint64(shards)).tolist(), anchors.view(np.int64).tolist(), np.frombuffer(span, np.uint8).tolist()):
                    out.append((k, a, doc, key, s, text[s: s + n + width]))
            columns = list(zip(*out)) or [()] * 6
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["shard", "anchor", "doc_id", "text_key", "start", "data"])

    pieces = segments_of(ASKED).mapInArrow(cut, "shard int, anchor long, doc_id long, text_key long, start int, data binary")
    compared = pieces.groupBy("shard").applyInPandas(_compare(width), schema)
    found = known.union(compared)
    spread = settled.where(F.col("kind") == SPREAD).agg(F.sum(F.octet_length("gaps"))).first()[0] or 0
    if spread:
        buckets = math.ceil(spread * (width - GRAM + 1) / BUCKET_WINDOWS)
        named = segments_of(SPREAD).mapInArrow(_send_windows(width, buckets), packed.SCHEMA).groupBy("bucket").applyInPandas(_settle(np.zeros(0, np.uint64)), REPLY)
        found = found.union(named.where(F.col("kind") == KNOWN).groupBy("chunk").applyInPandas(_known(width), schema))
    return found.groupBy("doc_id", "text_key").agg(F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"))


def removed_spans(starts: list[bytes] | None, ends: list[bytes] | None) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes."""
    if not starts:
        return []
    a, b = merge_intervals(np.frombuffer(b"".join(starts), np.int32), np.frombuffer(b"".join(ends), np.int32))
    return list(zip(a.tolist(), b.tolist()))


def dedup_substrings(docs: DataFrame, width: int = 100) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def digest(batches):
        for b in batches:
            out = []
            for doc, text, starts, ends in zip(b["doc_id"].to_pylist(), utf8_texts(b["text"]), b["starts"].to_pylist(), b["ends"].to_pylist()):
                kept, at, spans = hashlib.sha256(), 0, removed_spans(starts, ends)
                for s, e in spans:
                    kept.update(text[at:s])
                    at = e
                kept.update(text[at:])
                out.append((doc, len(text), sum(e - s for s, e in spans), len(spans), kept.hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            yield pa.record_batch([pa.array(c, pa.string() if k == 4 else pa.int64()) for k, c in enumerate(columns)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = materialise(repeated_intervals(docs, width)).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "starts", "ends")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("_text"))
    joined = rows.join(found, (F.col("doc_id") == F.col("_id")) & (F.col("_text") == F.col("_key")), "left").select("doc_id", "text", "starts", "ends")
    return joined.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
