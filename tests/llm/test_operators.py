"""Every operator against brute force on a small table of hard cases, and on an empty one."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import common, decontaminate, html_extract, mixing, secrets, simhash, substring, suffix, toxicity, url_filter, vafile
from tests.llm import brute


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, x) for x in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# Search


def test_top_k_equals_all_pairs(spark):
    rng = random.Random(3)
    vectors = [[rng.choice([-1, 1]) * rng.random() for _ in range(6)] for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[100]) for i in range(40)] + [(150, vectors[3]), (7, vectors[7]), (7, vectors[7])]
    rows += [(2000, None), (2050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2100, [math.nan] * 6), (2150, [math.inf] * 6), (None, vectors[0]), (2200, [0.5] * 3), (2250, [0.25] * 3), (2300, []), (-50, vectors[9])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string").repartition(4)
    for bits in (2, 6):
        got = vafile.top_k(df, F.col("vec_id") % 50 == 0, k=5, scale=256, bits=bits)
        assert rows_of(got, "query_id", "rank", "vec_id", "score") == ordered(brute.top_k(rows))


def test_top_k_of_ids_with_several_vectors(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(50, [3 + j / 256] * 6) for j in range(8)] + [(100, [2 + j / 256] * 6) for j in range(40)] + [(7, [2.0] * 6), (11, [3.0] * 6), (50, [2.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = rows_of(vafile.top_k(df, F.col("vec_id") % 50 == 0), "query_id", "rank", "vec_id", "score")
    assert got == ordered(brute.top_k(rows))


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vafile.top_k(df, F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_bounds_hold():
    rng = np.random.default_rng(0)
    v = rng.integers(-300, 300, (200, 8))
    low, high = vafile.Grid(v.min(0), v.max(0), 4).edges(vafile.Grid(v.min(0), v.max(0), 4).cells(v).astype(np.int64))
    assert (low <= v).all() and (v <= high).all()


# Near duplicates


def test_simhash_equals_all_pairs(messy, messy_rows):
    got = rows_of(simhash.near_duplicates(messy), "doc_id", "fingerprint", "component_id")
    assert got == ordered(brute.simhash([r[:2] for r in messy_rows]))


def test_simhash_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute.simhash([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == ordered(want)


def test_simhash_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_first(nothing).columns == nothing.columns


def test_keep_first_keeps_one_of_each_component(messy, messy_rows):
    kept = simhash.keep_first(messy)
    assert kept.columns == messy.columns
    members = {}
    for doc, _, part in brute.simhash([r[:2] for r in messy_rows], number=True):
        members.setdefault(part, []).append(doc)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(d for d in m if d is not None) for m in members.values())


def test_tree_search_finds_every_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = [b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base[:80] for i, j in rng.integers(0, 63, (4, 2))]
    points = np.unique(np.concatenate((base, np.array(flips, np.uint64))))
    mask, tree = np.uint64((1 << 32) - 1), simhash.grow(np.unique(points & np.uint64((1 << 32) - 1)), 4, np.random.default_rng(2))
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    near &= np.bitwise_count((points[:, None] ^ points[None, :]) & mask) <= 1
    homes, linked = np.zeros(len(points), int), np.zeros(near.shape, bool)
    for _, rows, home in simhash.route(tree, points & mask, 1):
        homes[rows[home]] += 1
        linked[np.ix_(rows[home], rows)] = True
        root = simhash.search(points[rows], home, mask, 1, 3)
        a, b = np.nonzero(near[np.ix_(rows[home], rows)])
        assert (root[np.flatnonzero(home)[a]] == root[b]).all()
    assert (homes == 1).all() and (linked | ~near).all()


def test_components_equal_union_find(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 580)] + [(900, 900 + i) for i in range(1, 50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = sorted((x, find(x)) for x in {v for e in edges if e[0] != e[1] for v in e})
    assert rows_of(common.connected_components(spark.createDataFrame(edges, "src long, dst long")), "node", "component") == want


# Substrings


def test_windows_equal_brute_force(messy, messy_rows):
    got = rows_of(substring.dedup_windows(messy), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == ordered(brute.windows([r[:2] for r in messy_rows]))


def test_windows_in_many_chunks(spark, messy, messy_rows, monkeypatch):
    monkeypatch.setattr(substring, "BUCKET_BYTES", 9000)
    got = rows_of(substring.dedup_windows(messy.repartition(5), 5), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == ordered(brute.windows([r[:2] for r in messy_rows], 5))


def test_cleaned_keeps_columns(messy, nothing):
    out = substring.cleaned(messy)
    assert out.columns == messy.columns and out.count() == messy.count()
    assert substring.dedup_windows(nothing).count() == 0


def test_substrings_equal_brute_force(messy, messy_rows):
    got = rows_of(suffix.dedup_substrings(messy), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == ordered(brute.substrings([r[:2] for r in messy_rows]))


def test_substrings_tables(spark, sf, monkeypatch):
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 60_000)
    monkeypatch.setattr(suffix, "SHARD_SEGMENTS", 100)
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(4)
    want = brute.substrings([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(suffix.dedup_substrings(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == ordered(want)
    assert suffix.dedup_substrings(docs.where("false")).count() == 0


def test_one_passage_in_many_documents(spark, monkeypatch):
    rng = random.Random(8)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage, tail = some(160), some(100)
    rows = [(i, some(rng.randint(40, 80)) + passage + (tail if i % 3 else "") + some(60)) for i in range(900)] + [(None, some(50) + passage), (5, some(70) + passage), (7, passage)]
    rows += [rows[11], rows[12]]
    docs, want = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), ordered(brute.substrings(rows))
    compare, most = suffix.late_windows, suffix.COLLECTION

    def bounded(strings, before, width):
        assert len(strings) <= most
        return compare(strings, before, width)

    monkeypatch.setattr(suffix, "late_windows", bounded)
    for sample in (64, 1):
        monkeypatch.setattr(suffix, "SAMPLE", sample, raising=False)
        assert rows_of(suffix.dedup_substrings(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_transform_orders_all_suffixes():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(60)] + [bytes(range(256)), b"abc", b"abc"]
    string, start = suffix.transform(strings)
    assert [(strings[a][b:], a) for a, b in zip(string, start)] == sorted((s[i:], k) for k, s in enumerate(strings) for i in range(len(s)))


def test_segments_cover_every_window_once():
    rng = random.Random(6)
    for letters in (b"a", b"ab", b"abcdefghijklmnop "):
        parts = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 700))) for _ in range(20)]
        doc, start, span, *_ = suffix.segments(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]), 100)
        got = sorted((int(d), int(s) + i) for d, s, n in zip(doc, start, span) for i in range(int(n) + 1))
        assert got == [(d, i) for d, p in enumerate(parts) for i in range(len(p) - 99)]


def test_places_beyond_a_byte_travel(monkeypatch):
    from fieldloom.llm import packed

    doc, place = np.array([0, 0, 0, 2, 2]), np.array([3, 900, 901, 254, 70_000])
    row = packed.pack(0, 1, 0, np.array([5, 6, 7]), np.array([1, 2, 3]), doc, place, np.arange(5, dtype=np.uint64))
    ids, texts, d, p, h = packed.unpack(type("Row", (), row))
    assert ids[d].tolist() == [5, 5, 5, 7, 7] and texts[d].tolist() == [1, 1, 1, 3, 3] and p.tolist() == place.tolist() and h.tolist() == [0, 1, 2, 3, 4]


# Toxicity


def test_second_person_after_many_insults():
    place = toxicity.NAMES.index
    found = toxicity.Features({}).of("moron " * 3000 + "word " * 20 + "you moron")
    assert found[place("nearest_you")] == 0.5 and found[place("near_you")] == 100 / 3022
    rng = random.Random(2)
    words = rng.choices(["moron", "you", "word"], [5, 1, 200], k=4000)
    people = [i for i, w in enumerate(words) if w == "you"]
    gaps = [min(abs(i - p) for p in people) for i, w in enumerate(words) if w == "moron"]
    found = toxicity.Features({}).of(" ".join(words))
    assert found[place("nearest_you")] == 1 / (1 + min(gaps)) and found[place("near_you")] == sum(g <= 8 for g in gaps) / 4000 * 100


def test_toxicity_finds_what_labels_mark(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.scored(docs, labels).join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    hits = [r for r in out if r.predicted]
    assert sum(r.toxic for r in hits) >= 0.85 * len(hits) >= 25
    assert sum(r.toxic for r in hits if r.held_out) >= 5


def test_toxicity_edge_cases(spark, messy, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.scored(messy, none)
    assert out.count() == messy.count() and {r.score for r in out.collect()} == {0.0}
    assert toxicity.drop_toxic(messy, none).columns == messy.columns
    one = spark.createDataFrame([(i, 1, 1) for i in range(8)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.scored(messy, one).collect()} == {1.0}
    assert toxicity.scored(nothing, one).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 1, 7)] + [(i, 1, i % 2) for i in range(21)], "doc_id long, quality int, toxic int")
    assert toxicity.scored(messy, odd).count() == messy.count()


def test_features_read_whole_texts():
    f = toxicity.Features({"lowei-": 5.0})
    far = f.of("word " * 5000 + "you moron")
    assert far[toxicity.NAMES.index("insult_count")] == 1 and far[toxicity.NAMES.index("nearest_you")] == 0.5
    assert f.of("loweischaft loweient")[toxicity.NAMES.index("learned_count")] == 2
    assert f.of("m0r0n id!ot")[toxicity.NAMES.index("disguised")] == 2


# Mixing


def test_mixing_meets_targets(messy, messy_rows, nothing):
    out = mixing.mixture(messy).collect()
    sizes = {}
    for _, text, source in messy_rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    want = brute.targets(sizes)
    assert len(out) == len(messy_rows) and sorted(r.target for r in out) == pytest.approx(sorted(want[s] for *_, s in messy_rows))
    assert all(r.taken % r["size"] == 0 if r["size"] else r.taken == 0 for r in out) and all(r.taken <= 3 * r["size"] for r in out)
    assert ordered(map(tuple, out)) == ordered(map(tuple, mixing.mixture(messy.repartition(7)).collect()))
    assert mixing.mixture(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_mixing_emits_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken = {r.source: (r.t, r.g) for r in docs.join(mixing.mixture(docs), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()}
    emitted = {r.source: r.t for r in mixing.mix(docs).groupBy("source").agg(F.sum(common.word_count("text")).alias("t")).collect()}
    assert {s: t for s, (t, _) in taken.items() if t} == emitted
    assert sum(t for t, _ in taken.values()) == pytest.approx(sum(g for _, g in taken.values()), rel=0.1)


def test_targets_when_none_is_capped(spark):
    sizes = spark.createDataFrame([("0a", 100), ("0b", 100), ("0c", 100)], "key string, size long")
    assert {r.key: r.target for r in mixing.source_targets(sizes).collect()} == pytest.approx({"0a": 187.5, "0b": 75.0, "0c": 37.5})


# Pages


def test_extraction_keeps_the_article():
    page = """<html><head><title>A title</title><script>var x = "<p>no</p>"</script></head><body><header>Site name</header>
    <ul class="main-menu"><li><a href=/>Home</a><li><a href=/a>About</a></ul><div id=cookie-notice>We use cookies</div>
    <article><h1>A title</h1><p>First &amp; foremost,&nbsp;a <b>bold<p>second
    paragraph &lt;here&gt; with <a href="x>y">a link</a> in it.</p><form><input value="no">Sign up</form><aside>Related</aside>
    <div class="comments"><p>I agree with all of this article very much indeed, thank you.</p></div><p>Last one.</p></article><footer>&copy; me</footer>"""
    assert html_extract.main_text(page) == "A title\nFirst & foremost, a bold\nsecond paragraph <here> with a link in it.\nLast one."


LINE = "The quick brown fox jumps over the lazy dog near the old river bank while many people watch it from the bridge above."
ARTICLE = f"<h1>A fine headline</h1><p>{LINE} {LINE}</p><p>{LINE}</p><p>The end.</p>"
PAGES = [
    f'<body class="single-post right-sidebar"><article>{ARTICLE}</article></body>', f'<html class="js cookies"><body><article>{ARTICLE}</article></body></html>',
    f'<body><div class="content with-sidebar">{ARTICLE}</div></body>', f'<body><article class="post comments-open">{ARTICLE}</article></body>',
    f'<body><article id="post-social-media-law">{ARTICLE}</article></body>', f"<body><article>{ARTICLE.replace('<p>', '<p class=legal>', 1)}</article></body>",
    f"<body><article>{ARTICLE.replace('</p>', '<span class=advert>Buy <b>now</b></span></p>', 1)}</article></body>",
    f"""<body><article>{ARTICLE.replace('</p>', '<i style="display:none">secret</i></p><p style="display: none">Hidden.</p>', 1)}</article></body>""",
    f"<body><article>{ARTICLE.replace('</p>', '<button>Like</button></p>', 1)}</article></body>",
    f"<head><title>A fine headline</title></head><body><nav>Home About</nav>{ARTICLE.replace('</h1>', '</h1><article>')}</article><footer>Foot</footer></body>",
    f'<body><div>{ARTICLE}</div><div class="comments"><p>{LINE}</p></div><footer>Foot</footer></body>',
    f'<body><article>{ARTICLE}<section class="comments"><h3>Comments</h3><article><p>{LINE}</p></article></section></article><aside>{LINE}</aside></body>',
    f'<body><div class="layout right-sidebar"><main>{ARTICLE}</main><div class="site-sidebar"><ul><li><a href=x>One link</a></li></ul></div></div></body>',
]


@pytest.mark.parametrize("page", PAGES)
def test_extraction_loses_no_clean_article(page):
    assert html_extract.main_text(page) == f"A fine headline\n{LINE} {LINE}\n{LINE}\nThe end."


def test_pages_are_cut_at_least_cost():
    """Whole pages: the labelling against all labellings of their blocks, with the same evidence and edges."""
    for page in PAGES:
        blocks, title = html_extract.parse(page)
        costs, last, edges = [html_extract.evidence(b, title) for b in blocks], {}, []
        for i, b in enumerate(blocks):
            for j in ({i - 1} if i else set()) | ({last[id(b.node.parent)]} if id(b.node.parent) in last else set()):
                apart = (blocks[j].node.against > 0) != (b.node.against > 0)
                edges.append((i, j, html_extract.SMOOTH / max(1, html_extract._distance(blocks[j].node, b.node) - 1) / (4 if apart else 1)))
            last[id(b.node.parent)] = i

        def cost(side):
            return sum(max(0, c) if not x else max(0, -c) for c, x in zip(costs, side)) + sum(w for i, j, w in edges if side[i] != side[j])

        n = len(blocks)
        assert cost(html_extract.label(blocks, title)) == pytest.approx(min(cost([m >> i & 1 == 1 for i in range(n)]) for m in range(1 << n)))


def test_extraction_of_deep_pages_is_linear():
    import time

    seconds = []
    for n in (4000, 16000):
        began = time.time()
        html_extract.main_text("<div>" * n + "text" + "</p></li></ul>" * n)
        html_extract.main_text("<div><li>x" * n)
        seconds.append(time.time() - began)
    assert seconds[1] < 10 * seconds[0] + 0.5


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<p>x", "</p></p>text", "<script>never closed", "<!-- never closed", "a < b & c", "<a href='", "&#xZZ;&bogus;", "<p>" * 3000 + "deep"])
def test_extraction_of_broken_pages(page):
    assert isinstance(html_extract.main_text(page), str)


def test_extraction_of_tables(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<article><p>text of it</p></article>", None), (1, None, None, "x")], "page_id long, url string, html string, text string")
    assert rows_of(html_extract.extract(pages), "page_id", "text", "n_chars") == [(1, "", 0), (1, "", 0), (None, "text of it", 10)]
    assert html_extract.extract(pages.where("false")).count() == 0


def test_cut_is_least_of_all_labellings():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 7)
        costs = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < 0.5]
        net = html_extract.Flow(n + 2)
        for i, c in enumerate(costs):
            net.edge(n, i, c) if c > 0 else net.edge(i, n + 1, -c)
        for i, j, w in edges:
            net.edge(i, j, w, w)
        side = net.source_side(n, n + 1)[:n]

        def cost(s):
            return sum(max(0, c) if not x else max(0, -c) for c, x in zip(costs, s)) + sum(w for i, j, w in edges if s[i] != s[j])

        assert cost(side) == pytest.approx(min(cost([m >> i & 1 == 1 for i in range(n)]) for m in range(1 << n)))


def test_url_rules_equal_direct_matching(spark):
    rules = (url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"), url_filter.Rule("a.example.org", "", "block"),
             url_filter.Rule("com", "/fr/", "allow"), url_filter.Rule("xcom", "/fr/", "block"), url_filter.Rule("org", "/es/é", "allow"))
    urls = [None, "", "no scheme", "http://", "http://ORG", "http://org/", "https://A.Example.ORG?x://y/z", "http://b.example.org/es/é/1#f", "http://example.org/es/x?y", "http://x.com/fr/",
            "http://xcom/fr/é", "http://yxcom/fr/1", "ftp://org/es/é?q", "http://a.example.org:80/", "http://..org/", "http://example.org\n/es/", "http://x.org/es/\né"] * 2
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string").repartition(3)

    def want(i, url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host, rest = rest[:cut].lower(), rest[cut:]
            path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.key), default=None)
        return (i, host, path, best and best.key, best.verdict if best else "allow")

    got = url_filter.judge_urls(pages, rules)
    assert rows_of(got, "page_id", "host", "path", "rule", "verdict") == ordered(want(i, u) for i, u in enumerate(urls))
    assert url_filter.judge_urls(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, ()).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    urls = spark.createDataFrame([(f"h{i}.example.net", f"/p{i % 50}/x") for i in range(3000)], "host string, path string")
    listed = [f"h{i}.example.net/p{i % 50}" for i in range(0, 3000, 10)]
    cascade = url_filter.build_cascade(urls, listed, [1, 3, 4], 40)  # far too small an estimate: many levels
    universe = {h + p for r in urls.collect() for h, p in url_filter.candidates(r.host, r.path, [1, 3, 4])}
    assert len(cascade.levels) > 2 and {k for k in universe if k in cascade} == set(listed) & universe


# Secrets


def spans_of(rows):
    return sorted(((r.path, [tuple(s) for s in r.spans]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_secret_spans_equal_python(spark, messy, messy_rows, tmp_path):
    rules = secrets.BASE + secrets.ADDED
    got = secrets.scan_secrets(messy.select(F.col("doc_id").alias("path"), "text", "spans"), f"file:{tmp_path}/ledger").collect()
    want = sorted(((d, brute.secret_spans(t, rules)) for d, t, _ in messy_rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert spans_of(got) == want and sum(bool(s) for _, s in want) >= 4


def test_ledger_scans_only_what_is_unseen(spark, tmp_path):
    ledger = secrets.BlobLedger(spark, f"file:{tmp_path}/ledger")
    day = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    ledger.scan(day("password=abcdef", "clean", "clean", None), secrets.BASE)
    assert ledger.rows().count() == 3
    ledger.scan(day("password=abcdef", "new text"), secrets.BASE)
    assert ledger.rows().count() == 4
    ledger.scan(day("password=abcdef", "new text"), secrets.BASE + secrets.ADDED[:1])
    assert sorted(len(r.rules) for r in ledger.rows().collect()) == [1, 1, 3, 3, 3, 3]
    again = ledger.findings(day("password=abcdef", "other", "password=abcdef"), secrets.BASE + secrets.ADDED[:1])
    assert [[s.kind for s in r.spans] for r in again.orderBy("path").collect()] == [["assign"], [], ["assign"]]


def test_masking_hides_secrets_and_keeps_the_rest(spark, messy, nothing, tmp_path):
    out = secrets.masked(messy, f"file:{tmp_path}/ledger")
    assert out.columns == messy.columns and out.count() == messy.count()
    texts = {r.doc_id: r for r in out.collect()}
    assert texts[17].text == "[SECRET] and token: abc" and texts[17].n_chars == 23
    assert texts[18].text == "[SECRET] and [SECRET]" and texts[19].text == "[SECRET] token=token:abcdefg" and texts[50].text is None
    assert secrets.masked(nothing, f"file:{tmp_path}/none").count() == 0


def test_running_values_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(secrets, "PIECE", 3)
    rng = random.Random(2)
    rows = [[rng.randrange(50) for _ in range(n)] for n in (0, 1, 2, 3, 4, 8, 9, 10, 27, 28, 100)]
    df = spark.createDataFrame([(r,) for r in rows], "a array<int>")
    for combine, plain in ((lambda a, b: a + b, sum), (lambda a, b: F.greatest(a, b), lambda x: max(x, default=0))):
        got = df.select("a", secrets.running(F.col("a"), combine).alias("r")).collect()
        assert all(list(r.r) == [plain(r.a[:i]) for i in range(len(r.a))] for r in got) and len(got) == len(rows)


def test_texts_of_very_many_secrets(spark, tmp_path):
    """Tens of thousands of matches in one text, and long runs that begin a token everywhere, stay cheap and right."""
    import time

    many = "password=abcdef é " * 40_000
    texts = [many, "eyJ" * 40_000, "eyJ-" * 20_000 + ".", "x eyJabcdefgh.ijklmnop.qrstuvwx,eyJabcdefgh.ijklmnop.qrstuvwxyz", "AKIA" * 30_000, "token=" * 20_000 + "abcdefg"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    got = spans_of(secrets.scan_secrets(docs.withColumnRenamed("doc_id", "path"), f"file:{tmp_path}/one").collect())
    clean = {r.doc_id: r.text for r in secrets.masked(docs, f"file:{tmp_path}/two").collect()}
    assert time.time() - began < 60
    assert got == [(i, brute.secret_spans(t, secrets.BASE + secrets.ADDED)) for i, t in enumerate(texts)] and len(got[0][1]) == 40_000
    assert clean[0] == "[SECRET] é " * 40_000 and clean[1] == texts[1] and clean[3] == "x [SECRET],[SECRET]"


def test_a_named_ledger_goes_on(spark, tmp_path):
    assert secrets.ledger_path(spark) != secrets.ledger_path(spark)
    spark.conf.set(secrets.LEDGER_SETTING, f"file:{tmp_path}/named")
    try:
        df = spark.createDataFrame([(1, "secret: abcdef"), (2, "nothing")], "path long, text string")
        for n in (2, 2):
            secrets.scan_secrets(df, secrets.ledger_path(spark))
            assert secrets.BlobLedger(spark, secrets.ledger_path(spark)).rows().count() == n
    finally:
        spark.conf.unset(secrets.LEDGER_SETTING)


# Benchmark items


ITEMS = [(1, "What is the first of the letters? alpha beta gamma delta epsilon zeta"), (2, "eta theta iota kappa. lambda mu nu xi omicron pi rho. The end of it all."), (3, None), (4, ""), (5, "..."),
         (6, "short"), (None, "An item without any id at all but with words enough."), (1, "What is the first of the letters? alpha beta gamma delta epsilon zeta")]


def test_leaks_equal_full_scoring(spark, messy, messy_rows, sf):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    more = [(100, "Lorem ipsum " * 40 + ITEMS[1][1].upper() + " dolor" * 70), (101, ITEMS[0][1]), (102, "first letters alpha beta"), (103, ITEMS[6][1]), (None, ITEMS[0][1])]
    docs = messy.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = [(r.doc_id, r.item_id, round(r.score, 9)) for r in decontaminate.matches(docs, items).collect()]
    want = brute.leaks([r[:2] for r in messy_rows] + more, ITEMS)
    assert {g[:2] for g in got} == {w[:2] for w in want} and {(100, 2), (101, 1), (103, None), (None, 1)} <= {g[:2] for g in got}
    assert ordered(set(got)) == ordered(set(want))
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = [(r.doc_id, r.item_id, round(r.score, 9)) for r in decontaminate.matches(docs, items).collect()]
    assert sorted(got) == sorted(brute.leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]))


def test_copies_with_one_word_changed_are_found(spark):
    """Items of 40 words and a last sentence of seven, copied but for one word, wherever it stands; other texts are left alone."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    texts = [" ".join(word() for _ in range(40)) + ". " + " ".join(word() for _ in range(7)) + "." for _ in range(50)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = []
    for i, t in enumerate(texts):
        for kind, place in enumerate((rng.randrange(40, 47), rng.randrange(46))):
            words = t.split()
            words[place] = word() + ("." if words[place].endswith(".") else "")
            docs.append((2 * i + kind, " ".join(word() for _ in range(60)) + " " + " ".join(words) + " " + " ".join(word() for _ in range(60))))
    docs += [(1000 + i, " ".join(rng.sample(" ".join(texts[i: i + 2]).split(), 90))) for i in range(40)]
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert len({f for f in found if f[0] // 2 == f[1]}) >= 95 and {f[0] // 2 == f[1] for f in found} == {True}


def test_leaks_of_nothing(spark, messy, nothing):
    items, none = spark.createDataFrame(ITEMS, "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(nothing, items).count() == 0 and decontaminate.matches(messy, none).count() == 0
    assert decontaminate.decontaminate(messy, none).count() == messy.count()
    assert decontaminate.decontaminate(messy, items).columns == messy.columns


def test_wand_equals_full_scores():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, weights=range(60, 0, -1), k=rng.randint(3, 20)))) for i in range(90)]
    df = {w: sum(w in t.split() for _, t in items) for w in vocabulary}
    index = decontaminate.Index(items, df, len(items), 10.0, 32, 1.2, 0.75, 5)
    for _ in range(60):
        terms = sorted(rng.sample(range(len(index.lists)), min(len(index.lists), rng.randint(1, 25))))
        full = {}
        for t in terms:
            for i, w in zip(*index.lists[t]):
                full[i] = full.get(i, 0) + w
        got = index.wand(terms, 0.4)
        assert [i for i, _ in got] == sorted(i for i, s in full.items() if s >= 0.4)
        for level in index.levels:
            opened = level.open_windows(np.array(terms), np.zeros(len(terms), np.int64), 0.4)
            assert len(opened) or not got
