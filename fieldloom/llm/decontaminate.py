"""Benchmark decontamination: BM25 with block-max WAND over the test items, then overlap of question and answer.

Every passage of every document is a query: windows of two strides, one stride apart, a stride being the
longest item (32 words at least), so an item that stands in a text lies whole in some window. Impacts
are BM25 weights divided by the item's score of itself, so one threshold holds for all items.

* The index keeps for each term its postings and, for each block of ``BLOCK`` items, the block's largest impact.
* A shallow pass over many passages at once adds the block maxima of each passage's distinct terms (terms in
  very many blocks add their overall maximum instead), with blocks of eight and then of two items, and keeps
  passages where some block may reach the threshold. These go through the WAND loop, pivots and block skips.
* An item retrieved is a leak if ``overlap`` of its question's and of its answer's word shingles stand in the window. Where either
  half has fewer than ``SHORT_HALF`` shingles, one changed word would hide all of it: there ``overlap`` of the whole item's
  shingles is enough.

The index is broadcast in parts of at most ``ITEMS`` items; more items mean more passes, with the same
document frequencies and mean length, so results do not depend on the parts. Documents are not shuffled.

Items have one text: up to its last question mark is the question if words follow it, else all but the
last sentence; a text of one sentence is halved.

Cases: NULL and empty texts hold nothing and match nothing; a NULL id is kept; repeated documents and items
are judged row by row; an item repeated under several ids is found under each; empty tables give an empty
result (nothing is dropped); extra columns are carried by ``decontaminate`` and never looked at.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEMS, BLOCK = 1 << 16, 8
#: Items in a block and blocks of a term beyond which it counts by its largest impact: coarse first, then finer.
LEVELS = ((8, 64), (2, 512))
LEAST_STRIDE, CHUNK_WORDS, SUMS = 32, 200_000, 1 << 21
SHORT_HALF = 10
#: Spellings whose term is kept at hand in each task.
MEMO = 1 << 18
_SIGNS = string.punctuation + "“”„‘’‚«»‹›–—…¿¡·"


def words_of(text: str | None) -> list[str]:
    """Lower-case words between white space, without signs at either end; signs alone are no words."""
    return [w for w in (t.strip(_SIGNS) for t in text.lower().split()) if w] if text else []


class Terms(dict):
    """Term number of each spelling met, -1 for words that no item has."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, token: str) -> int:
        number = self.numbers.get(token.strip(_SIGNS), -1)
        if len(self) < MEMO:
            self[token] = number
        return number

    def __reduce__(self):
        return Terms, (self.numbers,)


def question_answer(text: str) -> tuple[list[str], list[str]]:
    cut = text.rfind("?") + 1
    if not cut or not words_of(text[cut:]) or not words_of(text[:cut]):
        ends = [m.end() for m in re.finditer(r"[.!?](?=\s)", text) if words_of(text[m.end():])]
        cut = ends[-1] if ends else 0
    question, answer = words_of(text[:cut]), words_of(text[cut:])
    if not question:
        question, answer = answer[: len(answer) // 2], answer[len(answer) // 2:]
    return question, answer


def shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i: i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def _block_maxima(posting: tuple[list[int], list[float]], size: int) -> dict[int, float]:
    best: dict[int, float] = {}
    for i, w in zip(*posting):
        best[i // size] = max(best.get(i // size, 0.0), w)
    return best


class Level:
    """Block maxima of all terms, one after the other; terms in more than ``wide`` blocks count by their largest impact."""

    def __init__(self, lists, n_items: int, size: int, wide: int):
        blocks = [_block_maxima(p, size) for p in lists]
        few = [b if len(b) <= wide else {} for b in blocks]
        self.flat = np.array([0.0 if f else max(b.values()) for f, b in zip(few, blocks)])
        self.begin = np.concatenate(([0], np.cumsum([len(f) for f in few]))).astype(np.int64)
        self.block = np.array([k for f in few for k in f], np.int64)
        self.best = np.array([w for f in few for w in f.values()])
        self.n_blocks = n_items // size + 1

    def open_windows(self, term: np.ndarray, window: np.ndarray, threshold: float) -> np.ndarray:
        """Windows of which some block may reach the threshold; (term, window) are distinct, ordered by window."""
        found = []
        for a, b in self._slices(window):
            t, w = term[a:b], window[a:b] - window[a]
            n = int(w[-1]) + 1
            size = self.begin[t + 1] - self.begin[t]
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - self.begin[t], size)
            key = np.repeat(w, size) * self.n_blocks + self.block[at]
            most = np.bincount(key, self.best[at], minlength=n * self.n_blocks).reshape(n, self.n_blocks).max(axis=1)
            found.append(window[a] + np.flatnonzero(most + np.bincount(w, self.flat[t], minlength=n) >= threshold - 1e-9))
        return np.concatenate(found) if found else window[:0]

    def _slices(self, window: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of rows whose windows times blocks fit ``SUMS``."""
        step, a = max(1, SUMS // self.n_blocks), 0
        while a < len(window):
            b = int(np.searchsorted(window, window[a] + step))
            yield a, b
            a = b


class Index:
    """BM25 impacts of one part of the items, relative to each item's score of itself."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], total: int, mean: float, stride: int,
                 k1: float, b: float, n: int):
        # Items of like length side by side: their impacts are alike, so block maxima are close.
        items = sorted(items, key=lambda x: len(words_of(x[1])))
        self.ids, self.stride = [i for i, _ in items], stride
        parts = [question_answer(t) for _, t in items]
        self.question, self.answer = [shingles(q, n) for q, _ in parts], [shingles(a, n) for _, a in parts]
        short = [0 < min(len(q), len(a)) < SHORT_HALF for q, a in zip(self.question, self.answer)]
        self.whole = [shingles(words_of(t), n) if s else set() for s, (_, t) in zip(short, items)]
        numbers: dict[str, int] = {}
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for number, (_, text) in enumerate(items):
            words = words_of(text)
            weight = {}
            for word, tf in Counter(words).items():
                idf = math.log(1 + (total - frequency[word] + 0.5) / (frequency[word] + 0.5))
                weight[word] = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(words) / mean))
            own = sum(weight.values())
            for word, w in weight.items():
                postings[numbers.setdefault(word, len(numbers))].append((number, w / own))
        self.lists = [([i for i, _ in postings[t]], [w for _, w in postings[t]]) for t in range(len(numbers))]
        self.terms = Terms(numbers)
        self.most = np.array([max(w) for _, w in self.lists] + [0.0])
        self.blocks = [_block_maxima(p, BLOCK) for p in self.lists]
        self.levels = [Level(self.lists, len(items), size, wide) for size, wide in LEVELS]

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Items whose score over ``terms`` reaches the threshold: pivots by list maxima, skips by block maxima."""
        lists = [[self.lists[t][0][0], 0, t] for t in terms]
        found = []
        while lists:
            lists.sort(key=lambda x: x[0])
            bound, pivot = 0.0, -1
            for p, (_, _, t) in enumerate(lists):
                bound += self.most[t]
                if bound >= threshold:
                    pivot = p
                    break
            if pivot < 0:
                break
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            here = item // BLOCK
            if sum(self.blocks[t].get(here, 0.0) for _, _, t in lists[: pivot + 1]) < threshold:
                target = (here + 1) * BLOCK
                if pivot + 1 < len(lists):
                    target = min(target, lists[pivot + 1][0])
            elif lists[0][0] == item:
                score = sum(self.lists[t][1][at] for i, at, t in lists[: pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                target = item + 1
            else:
                target = item
            moved = []
            for x in lists[: pivot + 1]:
                if x[0] < target:
                    numbers = self.lists[x[2]][0]
                    at = bisect_left(numbers, target, x[1])
                    if at == len(numbers):
                        continue
                    x = [numbers[at], at, x[2]]
                moved.append(x)
            lists = moved + lists[pivot + 1:]
        return found

    def leaks(self, texts: list[str | None], threshold: float, overlap: float, n: int) -> list[dict[int, tuple[float, float, float]]]:
        """For each text: item number -> (score, question overlap, answer overlap) of its best window."""
        out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        at = 0
        while at < len(texts):
            split, size, begin = [], 0, at
            while at < len(texts) and size < CHUNK_WORDS:
                split.append(texts[at].lower().split() if texts[at] else [])
                size += len(split[-1])
                at += 1
            self._chunk(split, begin, out, threshold, overlap, n)
        return out

    def _chunk(self, split, begin, out, threshold, overlap, n) -> None:
        # A text's last window ends in a cell of its own, so windows never reach into the next text.
        cells = np.array([len(w) // self.stride + 2 for w in split])
        starts = np.cumsum(cells) - cells
        get = self.terms.__getitem__
        term, cell = [], []
        for words, start in zip(split, starts):
            ids = np.array(list(map(get, words)), np.int64)
            known = np.flatnonzero(ids >= 0)
            # The window at a cell is the cell before and this one, so each word is in two.
            term += [ids[known]] * 2
            cell += [start + known // self.stride, start + known // self.stride + 1]
        pairs = np.sort(np.concatenate(cell) * len(self.lists) + np.concatenate(term))
        pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))] if len(pairs) else pairs
        term, cell = pairs % len(self.lists), pairs // len(self.lists)
        for level in self.levels:
            kept = np.isin(cell, level.open_windows(term, cell, threshold), kind="table") if len(cell) else cell > 0
            term, cell = term[kept], cell[kept]
        for c in np.unique(cell).tolist():
            a, b = np.searchsorted(cell, (c, c + 1))
            hits = self.wand(term[a:b].tolist(), threshold)
            if not hits:
                continue
            doc = int(np.searchsorted(starts, c, side="right")) - 1
            first = (c - int(starts[doc]) - 1) * self.stride
            window = words_of(" ".join(split[doc][max(0, first): first + 2 * self.stride]))
            here = shingles(window, n)
            short = {k: shingles(window, k) for k in {len(s) for h, _ in hits for p in (self.question[h], self.answer[h], self.whole[h]) for s in p} - {n}}
            for item, score in hits:
                *shares, whole = [1.0 if not p else sum(s in (here if len(s) == n else short[len(s)]) for s in p) / len(p) for p in (self.question[item], self.answer[item], self.whole[item])]
                if (min(shares) >= overlap or self.whole[item] and whole >= overlap) and score > out[begin + doc].get(item, (0.0,))[0]:
                    out[begin + doc][item] = (score, *shares)


def build_indexes(items: DataFrame, k1: float, b: float, n: int) -> Iterator[Index]:
    """One index at a time, each of at most about ``ITEMS`` items; statistics are those of all items."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")

    def counted(batches):
        for batch in batches:
            texts = batch["text"].to_pylist()
            split = [words_of(t) for t in texts]
            # The stride counts signs that stand alone, as the documents' cells do.
            yield pa.record_batch([batch["item_id"], batch["text"], pa.array([len(t.split()) if w else 0 for t, w in zip(texts, split)], pa.int64()), pa.array([sorted(set(w)) for w in split], pa.list_(pa.string()))],
                                  names=["item_id", "text", "n", "terms"])

    rows = items.mapInArrow(counted, "item_id long, text string, n long, terms array<string>").where("n > 0")
    total, mean, longest = rows.agg(F.count("*"), F.avg("n"), F.max("n")).first()
    if not total:
        return
    parts = math.ceil(total / ITEMS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for part in range(parts):
        own = rows.where(F.col("part") == part)
        texts = sorted(((r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        terms = own.select(F.explode("terms").alias("term")).distinct()
        frequency = {r["term"]: r["df"] for r in counts.join(terms, "term").collect()}
        yield Index(texts, frequency, total, mean, max(LEAST_STRIDE, longest), k1, b, n)


def matches(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8, n: int = 5, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every leak: one row for a document's row and item."""
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    context, out = docs.sparkSession.sparkContext, None
    for index in build_indexes(items, k1, b, n):
        shared = context.broadcast(index)

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                ids = batch["doc_id"].to_pylist()
                rows = [(doc, index.ids[i], *v) for doc, found in zip(ids, index.leaks(batch["text"].to_pylist(), threshold, overlap, n)) for i, v in found.items()]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.record_batch([pa.array(c, pa.int64() if k < 2 else pa.float64()) for k, c in enumerate(columns)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8, n: int = 5, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    context = docs.sparkSession.sparkContext
    for index in build_indexes(items, k1, b, n):
        docs = docs.where(~_leaking(context.broadcast(index), threshold, overlap, n)(F.col("text")))
    return docs


def _leaking(shared, threshold: float, overlap: float, n: int):
    @F.pandas_udf("boolean")
    def leaking(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(x) for x in shared.value.leaks(texts.tolist(), threshold, overlap, n)], dtype=bool)

    return leaking
