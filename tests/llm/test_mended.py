"""Cases that earlier forms of the operators got wrong."""

import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, html_text, langid, mixing, pii, queries, sharding, vectors

CLASH = "doc_id long, text string, lang string, source string, __text string, __c0 string, __input long, __size long"


def _text(page):
    return html_text.main_text(page, np.zeros(0, np.int64))


def test_a_full_format_grows(spark):
    """All 26 addresses of one letter occur, so each surrogate needs more letters; so do the 16 shortest IPv6 addresses."""
    rows = [(i, f"write to {c}@example.com now") for i, c in enumerate(string.ascii_lowercase)]
    rows += [(100 + i, f"host ::{c} up") for i, c in enumerate("0123456789abcdef")]
    got = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    mails = [got[i].split()[2] for i in range(26)]
    assert len(set(mails)) == 26 and all(m.endswith("@example.com") and len(m) > len("a@example.com") for m in mails)
    found = entities_changed(rows, got)
    assert not found, found


def entities_changed(rows, got):
    """Addresses that came through unchanged."""
    return [t for i, t in rows if "@" in t and got[i] == t]


def test_account_numbers_keep_right_check_digits(spark):
    rows = [(1, "pay GB82 WEST 1234 5698 7654 32 or GB82WEST12345698765432 today"), (2, "pay DE89 3704 0044 0532 0130 00 today")]
    got = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}

    def valid(account):
        turned = account[4:] + account[:4]
        return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1

    spaced, plain = got[1].split(" or ")[0].removeprefix("pay "), got[1].split(" or ")[1].split()[0]
    assert spaced.replace(" ", "") == plain != "GB82WEST12345698765432" and valid(plain) and plain.startswith("GB") and spaced[4] == " "
    assert valid(got[2].removeprefix("pay ").removesuffix(" today").replace(" ", ""))


def test_distinct_mentions_stay_distinct(spark):
    """Brute force over the dictionary: one surrogate for each entity, none of them an entity, none shared."""
    rows = [(i, f"mail u{i % 400}@mail{i % 3}.org, call +1 212-555-{i % 700:04}, card 4111 1111 1111 {i % 300:04}") for i in range(1200)]
    got = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    names = {}
    for i, t in rows:
        for old, new in zip(t.split(", "), got[i].split(", "), strict=True):
            assert names.setdefault(old, new) == new and (old != new or "card" in old)
    changed = {o: n for o, n in names.items() if o != n}
    assert len(set(changed.values())) == len(changed) and not set(changed.values()) & set(names)


def test_repeats_dont_crowd_out_a_language(spark):
    words = "le la les une des avec pour dans sur chez sans sous vers entre après avant depuis pendant".split()
    few = spark.createDataFrame([(i, " ".join(words[(i * k) % len(words)] for k in range(1, 30)) + f" mot{i}", "fr") for i in range(50)], "doc_id long, text string, lang string")
    many = spark.range(1_000_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("une seule phrase qui revient toujours dans le texte").alias("text"), F.lit("fr").alias("lang"))
    other = spark.createDataFrame([(1000 + i, f"der die das und nicht mit einem kleinen Wort nummer {i}", "de") for i in range(50)], "doc_id long, text string, lang string")
    model = langid.fit(few.unionByName(many).unionByName(other))
    assert model.langs == ["de", "fr"]
    assert langid.identify(few, model).where("lang_pred <> 'fr'").count() == 0


def test_many_languages_share_the_rows(spark, monkeypatch):
    monkeypatch.setattr(langid, "ROWS", 20)
    rows = [(i, f"wort{i} text{i * 7} satz{i * 3}", f"l{i % 10}") for i in range(400)]
    assert len(langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")).langs) == 10


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<form id="aspnetForm"><div class="nav">x</div><article><p>Body</p></article></form>', "Body"),
        ('<body><form action="/p"><p>One</p><p>Two</p><p>Three</p></form></body>', "One\nTwo\nThree"),
        ('<article><p>Body</p><form><p>Sign up</p><input></form></article>', "Body"),
        ('<article><p>Body</p><div class="comment">c</div><div class="post-comments">c</div><section id="reader-comments"><p>c</p></section></article>', "Body"),
        ('<article><div class="ad-banner">a</div><div class="advert-box">a</div><div class="promo-box">a</div><p>Body</p><div class="newsletter-box">n</div><div class="sidebar">s</div></article>', "Body"),
        ('<body><div id="social-history"><p>Kept</p></div><div class="page-header"><h1>Title</h1></div><div class="site-header">h</div></body>', "Kept\nTitle"),
        ('<article><pre><code><span class="comment"># kept</span> x</code></pre><section id="comment-by-the-author"><p>Also</p></section></article>', "# kept x\nAlso"),
        ('<article><header class="entry-header"><h1>T</h1></header><section id="social-history"><p>Kept</p></section></article>', "T\nKept"),
    ],
)
def test_pages(page, text):
    assert _text(page) == text


def test_clashing_columns_are_kept(spark):
    df = spark.createDataFrame([(1, "ein Text und noch ein Wort", "de", "s", "own", "zero", 5, 6), (2, None, None, None, None, None, None, None)], CLASH)
    got = langid.identify(df, langid.fit(df)).collect()
    assert [(r["__text"], r["__c0"], r["__input"]) for r in sorted(got, key=lambda r: r.doc_id)] == [("own", "zero", 5), (None, None, None)]
    pages = spark.createDataFrame([(1, "http://a.b/c", "<p>x</p>", "own", "c", 3)], "page_id long, url string, html string, __html string, __c1 string, __salt long")
    r = html_text.extract(pages).first()
    assert (r.text, r["__html"], r["__c1"], r["__salt"]) == ("x", "own", "c", 3)


def test_rows_without_ids_part_by_their_texts(spark):
    rows = [(None, " ".join(["w"] * 20) + f" t{i}", "s") for i in range(600)] + [(1, "a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df)
    assert got.count() == 601 and got.where("source = 's'").agg(F.sum("taken")).first()[0] > 0
    again = mixing.mix_sources(df.repartition(5))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)


def test_tokens_keep_columns_of_any_name(spark):
    """Internal names and ones that need quoting stay; columns of the results' names are replaced, whatever their case."""
    names = ["doc_id", "text", "__input", "c0", "c1", "a.b", "IDS", "n_tokens"]
    rows = [(1, "two words", 7, 8, 9, [1, 2], "x", 5), (2, None, None, None, None, None, None, None), (2, "", 1, 1, 1, [], "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __input long, c0 long, c1 long, `a.b` array<long>, IDS string, n_tokens long")
    got = bpe.digests(docs, queries.VOCABULARY)
    assert got.columns == [*names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = sorted((tuple(r)[:7] for r in got.collect()), key=str)
    assert kept == sorted((r[:7] for r in rows), key=str)
    tokens = bpe.encode(docs, queries.VOCABULARY)
    assert tokens.columns == [n for n in names if n != "IDS"] + ["ids"]
    back = bpe.decode(tokens, queries.VOCABULARY, text="text")
    assert sorted(r.text for r in back.collect()) == sorted(bpe.decode(tokens, queries.VOCABULARY).toPandas()["decoded"])


def test_shards_keep_columns_of_their_own_names(spark):
    df = spark.createDataFrame([(i, 10 + i % 7, 777, i * 3, "x", 5) for i in range(500)], "doc_id long, size long, __part int, __rank int, __at string, __c0 long")
    got = sharding.histogram_sort(df, "doc_id", "size", 4).collect()
    assert len(got) == 500 and all((r["__part"], r["__rank"], r["__at"], r["__c0"]) == (777, r.doc_id * 3, "x", 5) for r in got)
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(4) for k in range(sum(r.shard == s for r in got))]


def test_rows_larger_than_the_tolerance_end_the_refining(spark, monkeypatch):
    """Independent splitters: whole rows in order of key, cut where the bytes below are nearest to each share."""
    sizes = [(i, 1000 + i * 37 % 900) for i in range(300)]
    df = spark.createDataFrame(sizes, "doc_id long, size long")
    got = {r.doc_id: r.shard for r in sharding.histogram_sort(df, "doc_id", "size", 8).collect()}
    total, below, cuts = sum(z for _, z in sizes), [0], []
    for _, z in sizes:
        below.append(below[-1] + z)
    for k in range(1, 8):
        goal = total * k / 8
        cuts.append(min(range(len(below)), key=lambda j: (abs(below[j] - goal), j)))
    assert [got[i] for i, _ in sizes] == [sum(c <= j for c in cuts) for j in range(300)]


def test_what_a_mix_is_told_to_miss_is_what_it_misses(spark):
    """Moves are found from counts; made, they leave just the miss that the counts told, also in a size that most rows have."""
    rng = np.random.default_rng(5)
    size = np.where(rng.random(3000) < 0.6, 40, rng.integers(1, 300, 3000))
    rows = [(i, "w " * int(n), (None, "a", "b", "c")[int(k)]) for i, (n, k) in enumerate(zip(size, rng.integers(0, 4, 3000), strict=True))]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for mend in (0, 6):
        got = mixing.mix_sources(table, mend=mend, near=0.0).toPandas()
        assert len(got) == 3000 and got.doc_id.is_unique and got.copies.between(0, 2).all()
        for _, part in got.groupby(got.source.fillna("-")):
            left = part.target.iloc[0] - part.taken.sum()
            assert part.miss.nunique() == 1 and abs(part.miss.iloc[0] - left) < 1e-6
            assert mend == 0 or abs(left) <= 1


def test_moves_take_documents_of_hot_sizes_once(spark, monkeypatch):
    """Forty rows of a size in parts of one: two moves of the same cell, one up and one down, change different rows."""
    monkeypatch.setattr(mixing, "small", lambda df: df)
    rows = [(None, s % 7, k, 5, 1) for s in range(7) for k in range(1, 7)]
    out = spark.createDataFrame(rows, "__source string, __salt int, __k int, size long, copies int")
    moves = spark.createDataFrame([(None, 5, 1, [(5, 1, 1, 0, 10), (5, 1, -1, 10, 3)])], "s string, z long, c int, moves array<struct<z:bigint,c:int,by:int,used:bigint,n:bigint>>")
    got = mixing._moved(out, moves).toPandas()
    assert got.copies.value_counts().to_dict() == {1: 29, 2: 10, 0: 3} and not got.duplicated(["__salt", "__k"]).any()
    cells = spark.createDataFrame([("a", 5, 1, 42), ("a", 50, 0, 1), ("b", 9, 2, 3)], "source string, size long, copies int, rows long")
    state = spark.createDataFrame([("a", 300.0, 37.0), ("b", 100.0, 40.0)], "source string, goal double, miss double")
    told = {r.source: (r.miss, [(m.z, m.c, m.by, m.used, m.n) for m in r.moves]) for r in mixing._moves(cells, state, 2, 6, 0.001).collect()}
    assert told["a"] == (2.0, [(5, 1, 1, 0, 7)]) and told["b"] == (40.0, [])  # all of b have their most


def test_bounds_are_never_below_the_product_and_get_finer():
    rng = np.random.default_rng(2)
    for dim in (1, 3, 5, 64, 100):
        x, y = rng.standard_normal((50, dim)) * np.linspace(9, 1, dim), rng.standard_normal((40, dim)) * np.linspace(9, 1, dim)
        over = []
        for m, length in vectors._levels(dim):
            bound = x[:, :m] @ y[:, :m].T + vectors._statistics(x, m, length) @ vectors._statistics(y, m, length).T
            assert (bound >= x @ y.T - 1e-9).all()
            over.append((bound - x @ y.T).mean())
        assert over == sorted(over, reverse=True)
    assert [n for _, n in vectors._levels(64)] == [16, 8, 4, 2, 2, 2, 2]


def test_long_runs_of_names_and_long_addresses_take_no_stack(spark):
    """Runs of 1,201 capitalised words (as one text of the check tool's has) and addresses of 2,000 parts ended the JVM."""
    host = "a.1." * 1000
    rows = [(1, "Von " * 1201 + "x"), (2, "Von " * 5000 + "x"), (3, f"write to joe@{host}com2 now"), (4, "Mary Smith " * 2000 + "met Mr Smith")]
    got = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert got[1] == rows[0][1] and got[2] == rows[1][1]
    assert got[3].startswith("write to ") and got[3].endswith("2 now") and got[3] != rows[2][1] and len(got[3]) == len(rows[2][1])
    assert got[4].count("Mary") == 0 and got[4].count("Smith") == 0 and len(set(got[4].split())) == 4


def test_addresses_end_as_before(spark):
    texts = ["a@b.com2", "a@b.com2.1 x", "a@b.co-op", "a@b.c.de.f.gh.i", "a@b..com", "a@b.1.2.uk.", "a@b.c", "a.b+c@d-e.f1.org@x.com", "a@1.com"]
    seen = spark.createDataFrame([(t,) for t in texts], "t string").select(F.regexp_extract_all("t", F.lit(pii.EMAIL), F.lit(0)).alias("m")).collect()
    assert [r.m for r in seen] == [["a@b.com"], ["a@b.com"], ["a@b.co"], ["a@b.c.de.f.gh"], [], ["a@b.1.2.uk"], [], ["a.b+c@d-e.f1.org"], ["a@1.com"]]


def test_small_joins_of_the_near_duplicates_stay_out_of_the_driver(spark):
    """Joins found to be small while they run aren't broadcast inside `by_exchange`; the session is as before after it."""
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"

    def plan():
        sums = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        joined = spark.range(5000).withColumn("k", F.xxhash64("id") % 7).groupBy("k").count().withColumnRenamed("count", "n").join(sums, "k")
        joined.collect()
        return joined._jdf.queryExecution().executedPlan().toString()

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200")
    try:
        spark.conf.set(key, "10m")
        assert "BroadcastHashJoin" in plan()
        with common.by_exchange(spark):
            assert "SortMergeJoin" in plan() and spark.conf.get(key) == "-1"
        assert spark.conf.get(key) == "10m"
    finally:
        spark.conf.unset(key)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
