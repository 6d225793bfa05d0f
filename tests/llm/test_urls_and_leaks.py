import random

import duckdb
import numpy as np
import pytest

from gridlens.llm import decontamination, urlfilter
from gridlens.llm.decontamination import contaminated
from gridlens.llm.urlfilter import HOST_RULES, WORD_RULES, filter_urls

URLS = [None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://A.NET/x", "ftp://net/", "http://xnet/",
        "http://example.net/en/1", "http://www.Example.NET/en/", "http://example.net/de/1", "http://badexample.net/en/",
        "http://example.com/de/x?y#z", "http://example.com/de", "http://m.example.com/en/", "http://b.org/fr/", "http://b.org/FR/",
        "http://x.org?q=/fr/", "http://spam-farm.example.org/", "http://spammer.org/", "http://a.com/Casino/1", "a://b://net/",
        "http://example.net:80/en/", "http://ÄÖ.net/ü", "http://a.com/cheap_pills", "http://a.com/x\ny"]


def test_rules_agree_with_sql_and_with_known_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(URLS)] + [(None, URLS[5], "h", "k")] * 2,
                                  "page_id long, url string, html string, host string")
    got = filter_urls(pages, HOST_RULES + WORD_RULES).toPandas()
    assert len(got) == len(URLS) + 2
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toPandas())
    key = lambda df: sorted(map(str, df[["page_id", "host", "path", "rule", "verdict"]].fillna("-").values.tolist()))
    assert key(got) == key(con.sql(urlfilter.sql_twin()).df())
    by = {URLS[int(r.page_id)]: (r.rule, r.verdict) for r in got.itertuples() if r.page_id == r.page_id}
    assert by["http://a.net/"] == ("net/", "block") and by["http://a.net"][1] == "allow"
    assert by["http://www.Example.NET/en/"] == ("example.net/en/", "allow")
    assert by["http://badexample.net/en/"] == ("net/", "block")
    assert by["http://spam-farm.example.org/"][1] == by["http://a.com/Casino/1"][1] == "block"
    assert by["http://spammer.org/"][1] == "allow"
    assert filter_urls(pages.where("false"), HOST_RULES).count() == 0


def test_rules_that_the_index_would_miss_are_refused(spark):
    for name, pattern in (("--", r"\-\-"), ("poker", "poker"), ("poker", "(^|[^a-z0-9])poker"), ("a or b", "(^|[^a-z0-9])(a|b)([^a-z0-9]|$)"),
                          ("digits", r"(^|[^a-z0-9])x\d([^a-z0-9]|$)"), ("any", "(^|[^a-z0-9])a.b([^a-z0-9]|$)"),
                          ("maybe", "(^|[^a-z0-9])ab?([^a-z0-9]|$)"), ("", "")):
        with pytest.raises(ValueError):
            urlfilter.Rule(name, "block", pattern, False)
    with pytest.raises(ValueError):
        urlfilter.word_rule("-")
    with pytest.raises(ValueError):
        urlfilter.Rule("net/", "maybe", r"^([^/]*\.)?net\/", True)
    # a name that differs from its pattern loses nothing: tokens come from the pattern
    rule = urlfilter.Rule("games of chance", "block", "(?i)(^|[^a-z0-9])casino[^a-z0-9]+royale([^a-z0-9]|$)", False)
    assert rule.literals == ["casino", "royale"]
    pages = spark.createDataFrame([(1, "http://a.com/Casino-Royale/"), (2, "http://a.com/casinoroyale")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in filter_urls(pages, [rule]).collect()}
    assert got == {1: "block", 2: "allow"}


def test_leaks_are_found_and_clean_documents_are_not(spark, odd_docs, no_docs):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    common = ["the", "of", "and", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)]
    items = [text(rng.randint(15, 59)) for _ in range(30)]
    docs, want = [], set()
    for i in range(300):
        words = text(rng.randint(20, 400))
        if i % 10 == 0:
            item = list(items[i // 10])
            if i % 20 == 0:  # a paraphrase: some words are exchanged, the answer stays
                for _ in range(len(item) // 6):
                    item[rng.randrange(len(item) - 6)] = word()
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + "," for w in item] if i % 30 == 0 else item
            want.add((i, 100 + i // 10))
        docs.append((i, " ".join(words)))
    bench = spark.createDataFrame([(100 + i, " ".join(w) + ".") for i, w in enumerate(items)] + [(1, None), (2, ""), (3, "...")],
                                  "item_id long, text string")
    rows = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    assert contaminated(odd_docs, bench).count() == 0
    assert contaminated(no_docs, bench).count() == 0
    assert contaminated(odd_docs, bench.where("false")).count() == 0
    itself = bench.where("item_id >= 100").selectExpr("item_id as doc_id", "text")
    assert {(r.doc_id, r.item_id) for r in contaminated(itself, bench).collect()} == {(100 + i, 100 + i) for i in range(30)}


def _planted(spark, n_items, n_docs, seed=8):
    """A benchmark, and documents of which each holds one of its items, copied or with a sixth of its words exchanged."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    common = ["the", "of", "and", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)]
    items = [text(rng.randint(15, 59)) for _ in range(n_items)]
    docs = []
    for i in range(n_docs):
        words, item = text(rng.randint(100, 400)), list(items[i])
        for _ in range(len(item) // 6 if i % 2 else 0):
            item[rng.randrange(len(item) - 6)] = word()
        at = rng.randrange(len(words))
        words[at:at] = item
        docs.append((i, " ".join(words)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))


def test_paraphrases_are_found_in_a_larger_benchmark(spark):
    docs, bench = _planted(spark, 900, 200)
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == {(i, i) for i in range(200)}


def test_copies_are_found_where_items_outnumber_the_axes(spark):
    docs, bench = _planted(spark, 3000, 200)
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == {(i, i) for i in range(200)}


def test_common_words_among_rare_ones_are_found(spark):
    """The item's cosine with every passage around it is next to nothing."""
    rng = random.Random(9)
    common = [f"c{i}" for i in range(40)]
    rare = lambda: "".join(rng.choice("abcdefghij") for _ in range(12))
    item = rng.sample(common, 15)
    docs = [(i, " ".join(rng.sample(common, 40))) for i in range(1, 200)]
    docs.append((0, " ".join([*(rare() for _ in range(100)), *item, *(rare() for _ in range(100))])))
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).where("doc_id = 0").collect()
    assert [(r.first_word, r.end_word) for r in found] == [(100, 115)]


def test_axes_are_fitted_on_all_documents(spark, monkeypatch):
    seen, plain = [], decontamination.latent_axes
    monkeypatch.setattr(decontamination, "FIT_ROWS", 20)
    monkeypatch.setattr(decontamination, "latent_axes", lambda texts, *a: seen.append(texts.count()) or plain(texts, *a))
    docs, bench = _planted(spark, 60, 60)
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == {(i, i) for i in range(60)}
    assert seen == [120]


def test_words_are_compared_only_where_latent_retrieval_leads(spark, sample_docs, monkeypatch):
    """It leaves out places that later steps would look at, none that they would accept, and nothing passes it by."""
    docs, bench = sample_docs.select("doc_id", "text"), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    space, retrieval, items, *_ = next(decontamination._item_groups(docs, bench)).value
    screen, filed, retrieved = decontamination.Screen(space, items), 0, 0
    for words in decontamination._item_words([r.text for r in docs.collect()]):
        item, place = screen.filed(space.vocabulary.numbers(words))
        near = retrieval.near(space, words, np.array([0, len(words)]), item, place)
        filed, retrieved = filed + len(near), retrieved + int(near.sum())
    assert 0 < retrieved < 0.9 * filed
    pairs = lambda: sorted((r.doc_id, r.item_id, r.first_word, r.end_word) for r in contaminated(docs, bench).collect())
    with_it, clean = pairs(), decontamination.without_items(docs, bench).count()
    monkeypatch.setattr(decontamination.Retrieval, "_need", lambda self, idf, count: -np.inf)
    assert pairs() == with_it and len(with_it) > 0
    monkeypatch.setattr(decontamination.Retrieval, "_need", lambda self, idf, count: np.inf)
    assert contaminated(docs, bench).count() == 0
    assert clean < decontamination.without_items(docs, bench).count() == docs.count()
