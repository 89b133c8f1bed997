"""Brute-force versions of operators that SQL can't express, in plain Python over collected rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash


def simhash(rows, words=3, max_bits=3, number=False):
    """rows: (doc_id, text) -> (doc_id, fingerprint, component_id), by all pairs; with ``number`` a component's own number instead."""
    prints = []
    for _, text in rows:
        parts = (text or "").encode().lower().split()
        shingles = [b" ".join(parts[i: i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    if number:
        return [(doc, f"{prints[i]:016x}", find(i)) for i, (doc, _) in enumerate(rows)]
    low = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        low[r] = doc if low.get(r) is None else low[r] if doc is None else min(low[r], doc)
    return [(doc, f"{prints[i]:016x}", low[find(i)]) for i, (doc, _) in enumerate(rows)]


def windows(rows, width=13):
    """rows: (doc_id, text) -> (doc_id, n_words, n_removed, kept_sha256)."""
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    first = {}
    for doc, parts in split:
        if doc is not None:
            for i in range(len(parts) - width + 1):
                key = tuple(parts[i: i + width])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, parts in split:
        gone = [False] * len(parts)
        for i in range(len(parts) - width + 1):
            if doc is not None and first[tuple(parts[i: i + width])] < doc:
                gone[i: i + width] = [True] * width
        kept = b" ".join(p for p, g in zip(parts, gone) if not g)
        out.append((doc, len(parts), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def substrings(rows, width=100):
    """rows: (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    datas = []
    for doc, text in rows:
        data = (text or "").encode()
        key = xxhash.xxh64_intdigest(data, 42)
        datas.append((doc, key - (1 << 64) if key >> 63 else key, data))
    first = {}
    for doc, key, data in datas:
        if doc is not None:
            for i in range(len(data) - width + 1):
                w = data[i: i + width]
                first[w] = min(first.get(w, (doc, key, i)), (doc, key, i))
    out = []
    for doc, key, data in datas:
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if doc is not None and first[data[i: i + width]] < (doc, key, i):
                gone[i: i + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def top_k(rows, k=5, scale=256, every=50):
    """rows: (vec_id, embedding) -> (query_id, rank, vec_id, score)."""
    import math

    good = {(i, tuple(math.floor(float(x) * scale) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in good:
        if q % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q and len(a) == len(b))
        out += [(q, n, c, -s) for n, (s, c) in enumerate(scores[:k], 1)]
    return out


def secret_spans(text, rules):
    """All (start, rank, kind, end) by Python's own matcher."""
    import re

    found = []
    for rank, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.kept]) >= rule.least:
                found.append((m.start(rule.kept if rule.led else 0), rank, rule.kind, m.end()))
    return sorted(found)


def targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: source -> words; weights by code point order, None last; excess reshared until no target is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: weight[s] * rest / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in order}
        capped |= over


def leaks(docs, items, threshold=0.6, overlap=0.8, n=5, k1=1.2, b=0.75, least=32):
    """(doc_id, item_id, score) of every window scored against every item, without an index."""
    from fieldloom.llm.decontaminate import question_answer, shingles, words_of

    split = [(i, words_of(t), question_answer(t)) for i, t in items if words_of(t)]
    total, mean = len(split), sum(len(t.split()) for _, t in items if words_of(t)) / max(1, len(split))
    stride = max([least, *(len(t.split()) for _, t in items if words_of(t))])
    df = {}
    for _, w, _ in split:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    import math

    weigh = []
    for i, w, (q, a) in split:
        own = {t: math.log(1 + (total - df[t] + .5) / (df[t] + .5)) * w.count(t) * (k1 + 1) / (w.count(t) + k1 * (1 - b + b * len(w) / mean)) for t in set(w)}
        whole = shingles(w, n) if 0 < min(len(shingles(q, n)), len(shingles(a, n))) < 10 else set()
        weigh.append((i, own, sum(own.values()), shingles(q, n), shingles(a, n), whole))
    out = []
    for d, text in docs:
        words, best = (text or '').lower().split(), {}
        for start in range(0, max(1, len(words)), stride):
            for at in {start, max(0, start - stride)}:
                window = words_of(' '.join(words[at: at + 2 * stride]))
                have = set(window)
                for i, own, all_, q, a, whole in weigh:
                    score = sum(v for t, v in own.items() if t in have) / all_
                    if score < threshold:
                        continue
                    shares = [sum(s in shingles(window, len(s)) for s in p) / len(p) if p else 1.0 for p in (q, a)]
                    if min(shares) >= overlap or whole and sum(s in shingles(window, len(s)) for s in whole) / len(whole) >= overlap:
                        best[i] = max(best.get(i, 0), score)
        out += [(d, i, round(s, 9)) for i, s in best.items()]
    return out


def _field(value):
    return b"-" if value is None else b"%d:%s" % (len(str(value).encode()), str(value).encode())


def _h(*parts):
    return hashlib.sha256(b"".join(p if isinstance(p, bytes) else p.encode() for p in parts)).hexdigest()


def leaf(doc, source, lang, n_chars, text):
    return _h(*map(_field, (doc, source, lang, n_chars, text)))


def _tree(nodes, fanout):
    """Levels of one tree, the last of one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i: i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def _path(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at // fanout * fanout
        out.append((level[first:at], level[at + 1: first + fanout]))
        at //= fanout
    return out


def merkle(rows, fanout=2):
    """rows: (doc_id, source, lang, n_chars, text) -> the manifest query's rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((leaf(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _tree([h for h, _ in members], fanout) for g, members in groups.items() if not members.sort(key=lambda m: (m[1][0] is not None, m[1][0] or 0, m[0]))}
    top = _tree([trees[g][-1][0] for g in order], fanout)
    out = []
    for spot, g in enumerate(order):
        for at, (own, r) in enumerate(groups[g]):
            path = _path(trees[g], at, fanout) + _path(top, spot, fanout)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            below = leaf(r[0], r[1], r[2], r[3] + 1, r[4]) if bad else own
            for left, right in path:
                below = _h(*left, below, *right)
            out.append((r[0], own, trees[g][-1][0], top[-1][0], _h(*[h for left, right in path for h in left + right]), below, below == top[-1][0]))
    return out


def ranked(rows, items, k):
    """rows: (doc_id, text), items: (item_id, text) -> (item_id, rank, doc_id, score)."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [(doc, words(t)) for doc, t in rows]
    docs = [(doc, len(w), Counter(w)) for doc, w in docs if w]
    n, total = len(docs), sum(d[1] for d in docs)
    df = Counter(t for *_, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, size, tf in docs:
            m = 10 + 90 * size * n // total
            scores.append((sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(words(text)) if t in tf), doc))
        best = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
        out += [(item, i + 1, doc, score) for i, (score, doc) in enumerate(best)]
    return out
