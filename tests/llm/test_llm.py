"""Operators against brute force, round trips, held-out accuracy and the cases their docstrings define."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.oracle import connect, same
from tidemark.llm import bpe, fm_index, html_text, langid, mixing, ngram_join, pii, queries, sharding, substring_dedup, vectors
from tidemark.llm.common import Union

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, kind string"


def docs(spark, rows):
    """rows of (doc_id, text[, lang, source]); two more columns with clashing names."""
    return spark.createDataFrame([(*r, *[None] * (4 - len(r)), None, "s", "k") for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{i % 977}" for i in range(20_000))
    return docs(spark, [(1, None), (2, ""), (3, "a"), (3, "a"), (4, long, "en", "x"), (5, long, "en", None), (None, "a b c"), (6, "=" * 3000), (7, "Hallo Welt", "de", "x"), (8, "\t \n")])


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "text").collect()}


def test_bpe_equals_the_library(texts):
    own = bpe.WordBpe(open(queries.VOCABULARY, encoding="utf-8").read())
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    alphabet = "aAbz'stremv ΣςσİßéÉé \t\n 3½١字漢かﬁ😀‍=-_!ǅ"
    cases = [t or "" for t in list(texts.values())[:300]] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(500)]
    cases += ["<|endoftext|>", "a <|startoftext|>b", "x" * 5000, "=" * 3000 + "ab" * 4000, ""]
    for got, want in zip(own.encode_batch(cases), lib.encode_batch(cases, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want.ids
        assert own.decode(got) == lib.decode(want.ids, skip_special_tokens=False)


def test_bpe_odd_rows(odd, empty):
    got = bpe.digests(odd, queries.VOCABULARY).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert len(got) == 10 and all(r.ids_sha256 == none and r.n_tokens == 0 for r in got if r.doc_id in (1, 2, 8))
    back = bpe.decode(bpe.encode(odd, queries.VOCABULARY), queries.VOCABULARY)
    lib = Tokenizer.from_file(queries.VOCABULARY)
    assert {r.doc_id: r.decoded for r in back.collect()}[7] == lib.decode(lib.encode("Hallo Welt", add_special_tokens=False).ids)
    assert bpe.digests(empty, queries.VOCABULARY).count() == 0


def _dedup(rows, n=13):
    first, out = {}, {}
    for i, t in sorted(rows):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first.setdefault(tuple(w[k : k + n]), i) < i:
                gone[k : k + n] = [True] * n
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_substring_dedup_by_brute_force(spark, texts):
    rng = random.Random(5)
    made = {10_000 + i: " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for i in range(60)}
    rows = list((texts | made).items())
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got.collect()} == _dedup(rows)


def test_substring_dedup_odd_rows(odd, empty):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(odd).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (1, 0), 4: (20_000, 0), 5: (20_000, 20_000), None: (3, 0), 6: (1, 0), 7: (2, 0), 8: (0, 0)}
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_matching_statistics_of_unseen_texts():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 4, 300), 0)
    index, query, cap = fm_index.FmIndex(text, 4, 7), rng.integers(-1, 4, 200), 7
    query[query == 0] = -1
    size, low, high = index.matching_statistics(query, np.array([0, 100]), np.array([100, 100]))
    runs = [tuple(text[i : i + cap]) for i in range(300)]
    for i in range(200):
        end = 100 if i < 100 else 200
        want = max(k for k in range(cap + 1) if k == 0 or i + k <= end and any(r[:k] == tuple(query[i : i + k]) and 0 not in r[:k] for r in runs))
        assert size[i] == want
        if want:
            assert high[i] - low[i] == sum(r[:want] == tuple(query[i : i + want]) for r in runs)


def test_pii_is_replaced_consistently(spark, odd, empty):
    t = ["Mr John Smith met Frau Anna. Mr John Smith: +1 (663) 555-6869 or 1-663-555-6869.", "Mail John.Doe@Corp.com or john.doe@corp.com, IP 10.0.0.1; card 4111-1111-1111-1111 and 4111111111111111", 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" ssn 078-05-1120', "2024-01-15 and 3.14 v1.2.3 1,000,000"]
    got = [r.text for r in pii.replace(docs(spark, list(enumerate(t))), "k").orderBy("doc_id").collect()]
    assert got[3] == t[3]
    for gone in ("John", "Anna", "6869", "Corp", "10.0.0.1", "4111", "1eb9", "078-05"):
        assert all(gone not in g for g in got)
    name = re.match(r"Mr (\S+ \S+) met Frau (\w+)\. Mr (\S+ \S+): \+1 \((\d{3})\) (\d{3}-\d{4}) or \d-(\d{3})-(\d{3}-\d{4})\.", got[0])
    assert name and name[1] == name[3] and name[2].endswith("na")
    mail = re.match(r"Mail (\S+) or (\S+), IP [\d.]+; card (\d{4}-\d{4}-\d{4}-\d{4}) and (\d{16})$", got[1])
    assert mail and mail[1].lower() == mail[2] and mail[3].replace("-", "") == mail[4]
    digits = [int(c) for c in mail[4]][::-1]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert re.match(r'token = "[0-9a-f]{40}" ssn \d{3}-\d{2}-\d{4}$', got[2])
    assert pii.replace(odd, "k").count() == 10 and pii.replace(empty, "k").count() == 0


def test_pii_surrogates_are_distinct(spark):
    e = spark.range(300).select(F.lit("ssn").alias("kind"), F.lpad(F.col("id").cast("string"), 3, "0").alias("norm"), F.lit("").alias("gender"), F.lit(0).alias("lead"))
    got = pii.dictionary(e, "k").collect()
    assert len({r.surrogate for r in got}) == 300 and not {r.surrogate for r in got} & {r.norm for r in got}


def test_pii_names_are_found_again_without_a_title(spark):
    t = ["Mr John Miller called. Later John Miller left, and Mr Miller too. Dr Ada Lovelace Byron came.", "Yesterday Ada Lovelace Byron slept. Mary Jones did not. My name is Zo. The Big House stood.", "Big House, fe80:0:0:1::12, +1 (663) 555-6869, 1-663-555-6869 and +49 30 1234-5678"]
    got = [r.text for r in pii.replace(docs(spark, list(enumerate(t))), "k").orderBy("doc_id").collect()]
    for gone in ("John", "Miller", "Ada", "Lovelace", "Byron", "Mary", "Jones", "fe80", "6869", "5678"):
        assert all(gone not in g for g in got)
    m = re.match(r"Mr (\S+) (\S+) called\. Later (\S+) (\S+) left, and Mr (\S+) too\. Dr (\S+ \S+ \S+) came\.$", got[0])
    assert m and m[1] == m[3] and m[2] == m[4] == m[5]
    assert re.match(rf"Yesterday {m[6]} slept\. \S+na \S+ did not\. My name is (?!Zo)\S+\. The Big House stood\.$", got[1])
    n = re.match(r"Big House, [0-9a-f]{4}:\w:\w:\w::\w\w, \+1 \((\d{3})\) (\d{3}-\d{4}), 1-(\d{3})-(\d{3}-\d{4}) and \+49 \d\d \d{4}-\d{4}$", got[2])
    assert n and n[1] == n[3] and n[2] == n[4]


def test_pii_texts_with_marks_nulls_and_repeats(spark):
    t = ["a\u0001b 078-05-1120", None, "", "x " * 30_000 + "078-05-1120", "Mr John Smith", "Mr John Smith"]
    got = {}
    for r in pii.replace(docs(spark, list(enumerate(t))), "k").collect():
        got[r.doc_id] = (r.text, r.n_private)
    ssn = got[0][0][4:]
    assert got[0] == (f"a\u0001b {ssn}", 1) and got[1] == (None, 0) and got[2] == ("", 0) and got[3] == ("x " * 30_000 + ssn, 1) and got[4] == got[5] != (t[4], 0)


def test_pii_many_names_stay_distinct(spark):
    e = spark.range(100_000).select(F.lit("name").alias("kind"), F.concat(F.lit("N"), F.hex("id")).alias("norm"), F.lit("").alias("gender"), F.lit(0).alias("lead"))
    assert pii.dictionary(e, "k").select("surrogate").distinct().count() == 100_000


@pytest.mark.parametrize("ids", [range(1000), [i**5 for i in range(1000)], [-(2**63), 0, 2**63 - 1]])
def test_shards_have_near_equal_bytes(spark, ids):
    rng = random.Random(1)
    rows = [(i, rng.randint(1, 50), "x") for i in ids]
    got = sharding.histogram_sort(spark.createDataFrame(rows, "doc_id long, size long, shard0 string"), "doc_id", "size", 16).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted(r[:2] for r in rows)
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.doc_id):
        by[r.shard].append(r.slot)
    assert all(v == list(range(len(v))) for v in by.values()) and [r.shard for r in sorted(got, key=lambda r: r.doc_id)] == sorted(r.shard for r in got)
    if len(rows) > 100:
        total = collections.Counter()
        for r in got:
            total[r.shard] += r.size
        assert max(total.values()) - min(total.values()) <= 100


@pytest.mark.parametrize("shape", ["null", "equal", "outlier"])
def test_shards_part_null_and_equal_keys(spark, shape):
    key = {"null": lambda i: None if i % 2 else i, "equal": lambda i: 7, "outlier": lambda i: 2**63 - 1 if i == 999 else i}[shape]
    rows = [(key(i), 10, "x") for i in range(1000)]
    got = sharding.histogram_sort(spark.createDataFrame(rows, "doc_id long, size long, name string").repartition(7), "doc_id", "size", 16).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert len(got) == 1000 and len(by) == 16 and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 2
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_sharding_odd_rows(spark, odd, empty):
    x = odd.withColumn("size", F.octet_length("text")).withColumn("slot", F.lit("old")).withColumn("__rank", F.lit(1))
    got = sharding.histogram_sort(x, "doc_id", "size")
    assert got.count() == 10 and got.columns.count("shard") == got.columns.count("slot") == 1 and {r.kind for r in got.collect()} == {"k"}
    assert sharding.histogram_sort(empty, "doc_id", "n_chars").count() == 0


BIG = [2**53, 2**53 + 1, 2**63 - 1, None]


def test_ids_beyond_doubles_stay_exact(spark):
    rows = [(i, f"the little text number {k} of four " * 4, "en", "x") for k, i in enumerate(BIG)]
    d = docs(spark, rows).coalesce(1)
    want = sorted(BIG, key=str)
    ids = lambda df, c="doc_id": sorted((r[c] for r in df.collect()), key=str)
    assert ids(substring_dedup.remove_repeats(d)) == ids(ngram_join.jaccard_join(d)) == ids(langid.identify(d, langid.fit(d))) == want
    assert ids(bpe.digests(d, queries.VOCABULARY)) == want
    pages = spark.createDataFrame([(i, None, "<p>hi") for i in BIG], "page_id long, url string, html string").coalesce(1)
    assert ids(html_text.extract(pages), "page_id") == want


def test_language_sample_counts_repeated_rows_once(spark):
    rows = [(1, "the same text of one id again", "en", "x")] * 3000 + [(2, "ein anderer Text in anderer Sprache", "de", "x"), (4, "and yet another text", "en", "x")]
    model = langid.fit(docs(spark, rows))
    assert model.langs == ["de", "en"]
    with pytest.raises(ValueError):
        langid.fit(docs(spark, rows), most=1)


def _main(spark, pages, host=lambda i: "a"):
    rows = [(i, f"http://{host(i)}/{i}", p) for i, p in enumerate(pages)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    return [r.text for r in sorted(got.collect(), key=lambda r: r.page_id)]


def test_html(spark):
    page = '<html><body><nav><a href=1>Home</a></nav><div class="cookie-notice">ok?</div><article><h1>T&amp;T</h1><p>a<br>b <i>c</i>d&nbsp;e<p>f<script>x</script><div class="share">s</div></article><div id=comments><p>me</div><footer>f</footer>'
    assert _main(spark, [page, None, ""]) == ["T&T\na b cd e\nf", "", ""]
    pages = [f"<div>Welcome to our great little site</div><p>Unique words number {i} {i * 7} {i * 13} here</p>" for i in range(5)]
    assert _main(spark, pages) == [f"Unique words number {i} {i * 7} {i * 13} here" for i in range(5)]


def test_html_keeps_the_articles_own_headers_and_sections(spark):
    page = '<nav>Menu</nav><article><header class="entry-header"><h1>Title</h1></header><div class="article-header">Lead</div><section id="social-history"><p>One</section><p id="share-prices">Two<section id="comment-by-the-author">Three</section><p class="notice">Four</p><p>five <math><mi>x</mi></math></p><noscript><p>Six</p></noscript><div class="share-buttons">tweet</div><div class="ad">buy</div><section id="comments">me</section></article><div class="site-header">Site</div>'
    assert _main(spark, [page]) == ["Title\nLead\nOne\nTwo\nThree\nFour\nfive x\nSix"]
    page = '<article>A teaser</article><div id="content"><p>The body of the page in plain words</div><div class="sidebar">more</div>'
    assert _main(spark, [page]) == ["A teaser\nThe body of the page in plain words"]


def _boilerplate(pages, need):
    """Brute force: blocks outside articles whose words are covered by runs that `need` distinct pages hold."""
    streams = [[w for t in html_text._undecided(html_text.blocks(p)) for w in t.split()] for p in pages]
    holders = collections.defaultdict(set)
    for p, s in zip(pages, streams, strict=True):
        for k in range(len(s) - html_text.RUN + 1):
            holders[tuple(s[k : k + html_text.RUN])].add(p)
    out = []
    for p, s in zip(pages, streams, strict=True):
        gone = [False] * len(s)
        for k in range(len(s) - html_text.RUN + 1):
            if len(holders[tuple(s[k : k + html_text.RUN])]) >= need:
                gone[k : k + html_text.RUN] = [True] * html_text.RUN
        keep, at = [], 0
        for text, away, main in html_text.blocks(p):
            n = 0 if away or main else len(text.split())
            if not away and (main or sum(gone[at : at + n]) < html_text.COVER * n):
                keep.append(text)
            at += n
        out.append("\n".join(keep))
    return out


@pytest.mark.parametrize("size", [7, 40, 600])
def test_html_suffixes_by_brute_force(spark, size):
    """Pages with and without an article; what repeats on a host goes whatever the host's size."""
    rng = random.Random(size)
    word = lambda n: " ".join(f"w{rng.randint(0, 99999)}" for _ in range(n))
    notes, copied = [word(9) for _ in range(3)], word(60)
    pages = []
    for i in range(size):
        parts = [f"<div>{n}</div>" for n in notes if rng.random() < 0.6] + [f"<div>{word(12)}</div>"]
        parts += [f"<article><p>{notes[0]}</p><p>{word(8)}</p></article>"] if i % 2 else [f"<p>{word(20)} {notes[1][:30]}</p>"]
        parts += [f"<p>{copied}</p>"] if i in (1, 2) else []
        pages.append("".join(parts))
    got = _main(spark, pages)
    assert got == _boilerplate(pages, max(3, -(-len(pages) // 5)))
    assert all(notes[0] in t for t in got[1::2]) and copied in got[1] and any(len(html_text.blocks(p)) > t.count("\n") + 1 for p, t in zip(pages, got, strict=True))


def test_html_tables(spark, empty):
    rows = [(1, "http://a/x", "<p>hi"), (1, "http://a/x", "<p>hi"), (2, None, None), (None, "bad", "<b"), (3, "http://a/y", "<p>" + "w " * 50_000)]
    got = html_text.extract(spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string"))
    assert sorted(len(r.text) for r in got.collect()) == [0, 2, 2, 2, 99_999]
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def _embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_top_k_sql_and_odd_rows(spark):
    assert same(queries.op6_topk(spark, SF), connect(SF), queries.TOPK_SQL) == ""
    rows = [(100, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [float("nan"), 1.0], 1), (3, None, 1), (4, [1.0, None], 1), (None, [1.0, 1.0], 1), (5, [1.0], 1), (6, [-1.0, -0.25], None), (7, [1.0, 0.5], 2)]
    got = vectors.top_k(_embeddings(spark, rows)).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(100, 1, 1, 1024**2 + 512**2), (100, 2, 7, 1024**2 + 512**2), (100, 3, 6, -(1024**2) - 512 * 256)]
    assert vectors.top_k(_embeddings(spark, [])).count() == 0


def test_top_k_by_brute_force_with_ties_chunks_and_large_numbers(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.round(rng.standard_normal((700, 12)), 1)
    x[300:400] = x[:100]  # ties
    x[50] = 1e9  # products beyond doubles
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    monkeypatch.setattr(vectors, "CHUNK", 1200)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vectors.top_k(table, every=20, k=7).collect()}
    z = [[int(np.floor(1024 * c)) for c in v] for v in x]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=True))
    want = {}
    for q in range(0, 700, 20):
        scores = sorted((-dot(z[q], z[i]), i) for i in range(700) if i != q)[:7]
        want |= {(q, n): (i, -s if abs(s) < 2**63 else None) for n, (s, i) in enumerate(scores, 1)}
    assert {k: v for k, v in got.items() if want[k][1] is not None} == {k: v for k, v in want.items() if v[1] is not None}


def test_top_k_bounds_prune(spark):
    """Segment statistics leave less than half of the pairs of the given vectors to the exact product."""
    held = vectors.quantise(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), 1024).orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in held]), np.array([r.x for r in held])
    search = vectors._searches([(int(i), v.tobytes()) for i, v in zip(ids, x, strict=True) if i % 100 == 0], 10)[x.shape[1]]
    search.best(x, ids)
    q, _ = search.survivors(x, ids)
    assert len(q) < 0.5 * len(ids) * len(search.ids)


def test_top_k_memory_of_many_queries():
    """A whole chunk of queries against a batch of rows: arrays follow the blocks, and the finds are those of brute force."""
    import tracemalloc

    rng = np.random.default_rng(3)
    x = np.floor(1024 * rng.standard_normal((28_000, 64)) / 8)
    packed = [(i, v.tobytes()) for i, v in enumerate(x)]
    rows = np.floor(1024 * rng.standard_normal((1500, 64)) / 8)
    tracemalloc.start()
    search = vectors._searches(packed, 5)[64]
    got = search.best(rows, np.arange(100_000, 101_500))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 600_000_000
    seeds = x[: vectors.SEEDS]
    for q in range(0, 28_000, 997):
        score = rows @ x[q]
        others = np.sort(np.delete(seeds @ x[q], q) if q < len(seeds) else seeds @ x[q])[-5:]
        want = {(100_000 + int(r), int(score[r])) for r in np.argsort(-score, kind="stable")[:5] if score[r] >= others[0]}
        assert want <= {(r, v) for n, r, v in got if n == q}


def test_near_vectors_by_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 16))
    x = np.concatenate([base + 0.22 * rng.standard_normal((40, 16)) for _ in range(12)] + [base, base]).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 40 % 3)) for i, v in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(_embeddings(spark, rows), window=24).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(len(x))
    for _ in range(len(x)):
        comp = np.minimum(comp, np.where(link, comp[None, :], len(x)).min(1))
    right = sum(got[i] == (int(link[i].sum()), int(comp[i]), int(comp[i]) == i) for i in range(len(x)))
    assert right >= 0.95 * len(x)


@pytest.mark.parametrize("shape", ["hub", "pairs"])
def test_near_vectors_miss_no_link_of_a_large_label(spark, shape):
    rng = np.random.default_rng(4)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal((1 if shape == "hub" else 1500, 64)))
    off = rng.standard_normal((2500 if shape == "hub" else 1500, 64))
    off = unit(off - (off * centre).sum(1, keepdims=True) * centre)
    x = np.concatenate([centre, 0.935 * centre + np.sqrt(1 - 0.935**2) * off])
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(_embeddings(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)])).collect()}
    link = x @ x.T >= 0.93
    np.fill_diagonal(link, False)
    n = len(centre)
    assert {i: k for i, (k, _) in got.items()} == dict(enumerate(link.sum(1).tolist()))
    assert all(got[i][1] == (0 if shape == "hub" else i % n) for i in got)


def _hub(rng, dim, spokes, cosine=0.95):
    """A centre and rows that link with it, and hardly with each other."""
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal((1, dim)))
    off = rng.standard_normal((spokes, dim))
    off = unit(off - (off * centre).sum(1, keepdims=True) * centre)
    return np.concatenate([centre, cosine * centre + np.sqrt(1 - cosine**2) * off])


def _reached(links, start):
    union = Union()
    for a, b in links:
        union.join(a, b)
    return {i for i in union.up if union.find(i) == union.find(start)}


def test_windows_reach_as_far_as_they_unite():
    """A row in the middle of what crowds around it sees it all, in one batch or in several, and nothing of other tags."""
    rng = np.random.default_rng(7)
    x = _hub(rng, 64, 400)
    ids, tag = np.arange(1000, 1401), np.full(401, "t")
    order = np.concatenate([np.arange(1, 201), [0], np.arange(201, 401)])
    links, goes_on = vectors._windows(tag, ids[order], x[order], 8, 0.93)
    assert _reached(links, 1000) == set(range(1000, 1401)) and 200 in goes_on
    # the centre comes with an earlier batch, then rows of its tag, then rows of another one
    other = np.array(["t"] * 301 + ["u"] * 100)
    links, goes_on = vectors._windows(other, ids, x, 8, 0.93, fresh=1, wide=1)
    assert _reached(links, 1000) == set(range(1000, 1301)) and 0 not in goes_on
    assert vectors._windows(tag[:1], ids[:1], x[:1], 8, 0.93) == ([], [])


def test_near_vectors_reach_over_small_batches(spark):
    """Hubs whose copies fill many batches and partitions lose no link, at a window far below a hub's copies."""
    rng = np.random.default_rng(9)
    x = np.concatenate([_hub(rng, 48, 700), _hub(rng, 48, 300), rng.standard_normal((500, 48))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        got = {r.vec_id: r.n_links for r in vectors.near_duplicates(_embeddings(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)]), window=16).collect()}
    finally:
        spark.conf.set(key, before)
    link = x @ x.T >= 0.93
    np.fill_diagonal(link, False)
    assert got == dict(enumerate(link.sum(1).tolist()))


def test_passes_follow_the_rows_of_a_label():
    rows = [10, 5_000, 10**6, 10**8]
    found = [vectors._passes(n, 0.93, 48, 1e-4) for n in rows]
    assert found == sorted(found) and found[0] == 1 and found[1] < found[2] < found[3] < 200


def test_near_vectors_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [float("inf"), 0.0], 1), (7, [1.0, 0.0], 2), (8, [1.0, 0.0], 1), (9, [1.0], 1), (None, [1.0, 0.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(_embeddings(spark, rows)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (2, 1), 9: (0, 9), None: (0, None)}
    assert vectors.near_duplicates(_embeddings(spark, [])).count() == 0


def _jaccard(rows, n, percent):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    up = {i: i for i in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    where, shared = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for ids in where.values():
        shared.update(itertools.combinations(sorted(ids), 2))
    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join_by_brute_force(spark, texts, n, percent):
    rng = random.Random(n)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(4, 90))] for _ in range(12)]
    made = {20_000 + k: " ".join(w if rng.random() > 0.015 else "zz" for w in rng.choice(base)) for k in range(250)}
    rows = list((texts | made).items())
    got = ngram_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == _jaccard(rows, n, percent)


def test_jaccard_odd_rows(odd, empty):
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.jaccard_join(odd).collect()), key=repr)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 1, 3), (3, 1, 3), (4, 977, 4), (5, 977, 4), (0, 1, None), (6, 1, 6), (7, 1, 7), (8, 0, 8)], key=repr)
    assert ngram_join.jaccard_join(empty).count() == 0


def test_mixing_meets_its_targets(spark, odd, empty):
    got = queries.op9_mixing(spark, SF2)
    docs_ = spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "source")
    by = got.join(docs_, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("goal"), F.first("source_size").alias("z"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect()
    left, want = 1.5 * sum(r.z for r in by), {}
    weight = {r.source: (5, 2, 1)[k % 3] for k, r in enumerate(sorted(by, key=lambda r: (r.source is None, r.source or "")))}
    todo = {r.source: r.z for r in by}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in todo) for s in todo}
        full = [s for s in todo if share[s] > 2 * todo[s]]
        if not full:
            break
        for s in full:
            want[s] = 2.0 * todo[s]
            left -= want[s]
            del todo[s]
    want |= share
    for r in by:
        assert r.over <= 0 and abs(r.goal - want[r.source]) < 1e-6 * want[r.source] and abs(r.t - r.goal) <= 0.01 * r.goal + 1
    assert mixing.mix_sources(odd).count() == 10 and mixing.mix_sources(empty).count() == 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, queries.op9_mixing(spark, SF2).collect()))


def test_mixing_rates_are_the_tilt_that_a_solver_finds(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 400), "en", "abc"[i % 3] if i % 7 else None) for i in range(600)]
    table = docs(spark, rows)
    for name in ("s", "skip", "salt", "before", "miss", "n", "t", "x"):
        table = table.withColumn(name, F.lit("own"))
    got = mixing.mix_sources(table)
    assert got.columns.count("miss") == 1 and {(r.skip, r.t, r.s, r.before) for r in got.collect()} == {("own",) * 4}
    for _, part in itertools.groupby(sorted(got.collect(), key=lambda r: (r.source is None, r.source or "")), key=lambda r: r.source):
        part = list(part)
        size, goal = np.array([r.size for r in part], float), part[0].target
        low, high = -50.0, 50.0
        for _ in range(200):
            t = (low + high) / 2
            rate = 2 / (1 + np.exp(-t * size / size.mean()))
            low, high = (t, high) if (rate * size).sum() < goal else (low, t)
        want = np.full(len(part), 2.0) if goal >= 2 * size.sum() * (1 - 1e-9) else rate
        assert np.abs(np.array([r.rate for r in part]) - want).max() < 1e-5
        assert abs(sum(r.taken for r in part) + part[0].miss - goal) < 1e-6


def test_language_held_out(spark, odd, empty):
    got = queries.op10_langid(spark, SF2).join(spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got) > 100
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, langid.fit(odd)).collect()}
    assert found[1] == found[2] == found[6] == found[8] == ("und", 0.0) and all(0 <= s <= 1 for _, s in found.values())
    assert langid.fit(empty) is None and {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(empty, None).count() == 0


def test_pipeline(spark):
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "private_data", "mixing", "encoding"]
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = d
        d = stage(spark, d, SF)
        if k < 4:
            assert d.columns == corpus_pipeline.COLUMNS
            d = d.checkpoint()
        if k == 1:
            want = _jaccard([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert sorted(r.doc_id for r in d.collect()) == sorted(i for i, (_, c) in want.items() if c == i)
    assert d.count() > 100


def test_pipeline_stages_take_odd_rows(spark, odd, empty):
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted(((r.doc_id or 0, r.text) for r in df.collect()), key=repr)
    kept = stages["language"](spark, odd, SF)
    assert kept.columns == corpus_pipeline.COLUMNS and [i for i, _ in rows(kept)] == [0, 3, 3, 4, 5, 7]
    assert all(r.lang is not None for r in kept.collect())
    one = stages["near_duplicates"](spark, odd, SF)
    assert [i for i, _ in rows(one)] == [0, 1, 2, 3, 4, 6, 7, 8]  # copies of an id or of a text are one row
    private = stages["private_data"](spark, odd, SF)
    assert rows(private) == rows(odd) and {r.doc_id: r.n_chars for r in private.collect()}[1] is None
    mixed = stages["mixing"](spark, odd, SF)
    count = collections.Counter(r.doc_id for r in mixed.collect())
    assert max(count.values()) <= 4 and count[4] <= 2 and mixed.columns == corpus_pipeline.COLUMNS
    assert stages["encoding"](spark, odd, SF).count() == 10
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_pipeline_keeps_rows_of_null_and_repeated_ids(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    a, b, c = text(30), text(30), text(30)
    rows = [(1, a, "en", "x"), (7, a, "en", "x"), (7, b, "en", "x"), (7, b, "en", "x"), (8, b, "en", "x"), (9, c, "en", "x"), (9, c + " end", "en", "x"), (None, c, "en", "x"), (10, text(30), "en", "x")]
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs(spark, rows).repartition(3), SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept if r.doc_id != 9) == sorted([(1, a), (7, b), (0, c), (10, rows[-1][1])])
    assert [r.text in (c, c + " end") for r in kept if r.doc_id == 9] == [True]


def test_mixing_stage_gives_rows_of_null_and_repeated_ids_their_copies(spark):
    rows = [(i if i % 3 else None if i % 2 else 5, f"t{i} " + "w " * (20 + i % 7), "en", "xyz"[i % 3] if i % 2 else "x") for i in range(300)]
    got = collections.Counter(r.text for r in corpus_pipeline.mix(spark, docs(spark, rows), SF).collect())
    taken = mixing.mix_sources(docs(spark, [(i, *r[1:]) for i, r in enumerate(rows)]).select("doc_id", "text", "source"))
    goal = {r.source: r.target for r in taken.select("source", "target").distinct().collect()}
    size = collections.Counter()
    for _, t, _, source in rows:
        size[source] += got[t] * len(t.split())
    assert max(got.values()) <= 2 and all(abs(size[s] - g) <= 0.01 * g + 1 for s, g in goal.items())
