"""The pipeline against a brute-force version of its stages, the classifier's verdicts taken from its own query."""

import corpus_pipeline
import __spark_entry__ as entry
from fieldloom.llm import secrets, toxicity
from tests.llm import brute
from tests.oracle import compare, connect
import hashlib

import pytest


def coin(doc_id, seed=42):
    return int(hashlib.md5(f"{'' if doc_id is None else doc_id}:{seed}".encode()).hexdigest()[:13], 16) / 2**52


def redact(text, rules=secrets.BASE + secrets.ADDED):
    out, at = "", 0
    for start, _, _, end in brute.secret_spans(text, rules):
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:]


def test_pipeline_equals_brute_force(spark, sf):
    docs, labels, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    toxic = {r.doc_id for r in toxicity.scored(docs, labels).collect() if r.predicted}
    rows = [r for r in docs.collect() if r.doc_id not in toxic]
    first = {c for *_, c in brute.simhash([(r.doc_id, r.text) for r in rows])}
    rows = [r for r in rows if r.doc_id in first]
    leaked = {d for d, *_ in brute.leaks([(r.doc_id, r.text) for r in rows], [(r.item_id, r.text) for r in items.collect()])}
    rows = [(r.doc_id, redact(r.text), r.source) for r in rows if r.doc_id not in leaked]
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.encode().split())
    target, want = brute.targets(sizes), []
    for doc, text, source in rows:
        rate = target[source] / sizes[source]
        want += [(doc, text, n) for n in range(1, int(rate) + (coin(doc) < rate - int(rate)) + 1)]
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == [*docs.columns, "copy"]
    assert sorted((r.doc_id, r.text, r["copy"]) for r in got.collect()) == sorted(want)
    assert toxic and leaked


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_query_equals_sql(spark, sf, name):
    assert compare(entry.queries()[name](spark, sf), connect(sf), entry.oracle_sql()[name]) is None


def test_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {n.split("_")[0] for n in names}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "mixing"]
