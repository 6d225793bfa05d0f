from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridlens.llm import cotraining, langid, toxicity
from gridlens.llm.common import held_out

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_language_of_held_out_rows(docs):
    filters = langid.fit_filters(docs)
    got = langid.identify_languages(docs, filters, carry=["doc_id", "lang"]).where(held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    assert filters.languages == ["de", "en", "es", "fr"]


def test_language_learns_from_nothing_held_out(docs):
    """Labels of held-out rows make no difference to what is learned."""
    spoiled = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit_filters(docs), langid.fit_filters(spoiled)
    assert a.languages == b.languages and (a.rows == b.rows).all()


def test_language_of_few_rows_is_learned_and_kept(spark, docs, monkeypatch):
    """The table outgrows the sample, and only a few of its rows, or one, are labelled es."""
    es = docs.where((F.col("lang") == "es") & ~held_out(F.col("doc_id")) & (F.length("text") > 300)).orderBy("doc_id")
    for n in (5, 1):
        few = [r.doc_id for r in es.limit(n).collect()]
        rare = docs.withColumn("lang", F.when((F.col("lang") != "es") | F.col("doc_id").isin(few), F.col("lang")))
        filters = langid.fit_filters(rare, train_rows=200)
        assert filters.languages == ["de", "en", "es", "fr"]
        monkeypatch.setattr(langid, "fit_filters", lambda d, filters=filters: filters)
        kept = corpus_pipeline.identify_language(spark, docs, SF).where("lang = 'es'").count()
        monkeypatch.undo()
        clean = docs.where((F.col("lang") == "es") & F.col("text").rlike(r"\p{L}")).count()
        got = langid.identify_languages(docs, filters, carry=["lang"]).where("lang = 'es' and lang_pred = 'es'").count()
        assert kept >= 0.95 * clean and got >= (0.9 if n > 1 else 0.6) * clean, (n, kept, got, clean, filters.reach)


def test_language_of_odd_rows(odd_docs, no_docs, docs):
    filters = langid.fit_filters(docs)
    rows = langid.identify_languages(odd_docs, filters, carry=odd_docs.columns).collect()
    assert len(rows) == odd_docs.count() and set(odd_docs.columns) <= set(rows[0].asDict())
    assert all((r.lang_pred == "und" and r.score == 0) == (r.text is None or not r.text.strip()) for r in rows)
    assert langid.identify_languages(no_docs, filters, carry=["doc_id"]).count() == 0
    nothing = langid.fit_filters(no_docs)
    assert {r.lang_pred for r in langid.identify_languages(odd_docs, nothing, carry=["doc_id"]).collect()} == {"und"}


def test_machine_finds_held_out_toxic_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.fit_machine(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    scored = toxicity.score_toxicity(docs.join(labels, "doc_id", "left_semi"), machine, carry=["doc_id"])
    rows = scored.join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    bad, fine = [r.score for r in rows if r.toxic == 1], [r.score for r in rows if r.toxic == 0]
    assert len(bad) > 50
    assert sum(s >= 0.5 for s in bad) >= 0.85 * len(bad) and sum(s >= 0.5 for s in fine) <= 0.02 * len(fine)


def test_machine_learns_what_only_a_pair_says(spark):
    """Neither term alone tells the label; both together do."""
    rows = [(i, " ".join(["filler", *(["alpha"] if i % 2 else []), *(["beta"] if i // 2 % 2 else [])]), int(i % 4 == 3))
            for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    machine = toxicity.fit_machine(df, df.select("doc_id", "label"))
    ids = [i for i, _, _ in rows]
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(df, machine, carry=["doc_id"]).collect()}
    assert all((score[i] >= 0.5) == (i % 4 == 3) for i in ids)


def test_machine_learns_pairs_whose_terms_say_nothing(spark):
    """Each of the two terms is as common in toxic rows as in others: chi-square near zero."""
    kinds = [("alpha beta", 1), ("insult", 1), *[("alpha", 0)] * 3, *[("beta", 0)] * 3]
    rows = [(i, "filler " + kinds[i % 8][0], kinds[i % 8][1]) for i in range(1600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    machine = toxicity.fit_machine(df, df.select("doc_id", "label"))
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(df, machine, carry=["doc_id"]).collect()}
    assert all((score[i] >= 0.5) == (label == 1) for i, _, label in rows)


def test_only_terms_that_can_tell_are_paired_and_none_is_missed(spark, monkeypatch):
    """Against counting every pair, at a bound that chance reaches often; most terms are too rare for any pair of theirs to reach it."""
    dice, texts = np.random.default_rng(5), []
    label = (dice.random(1200) < 0.2).astype(float)
    for one in label:
        common = dice.choice(60, 12, replace=False, p=(w := 1 / np.arange(3, 63) + one * (np.arange(60) % 7 == 3) / 20) / w.sum())
        texts.append(sorted({*common.tolist(), *(60 + dice.choice(4000, 40, replace=False)).tolist()}))
    df = spark.createDataFrame([(float(y), t) for y, t in zip(label, texts)], "label double, buckets array<int>")
    held = np.zeros((len(texts), 4060))
    for row, t in enumerate(texts):
        held[row, t] = 1
    ones, rows = label @ held, held.sum(0)
    buckets = np.flatnonzero(rows >= toxicity.LEAST_ROWS)
    monkeypatch.setattr(toxicity, "PAIR_NATS", 4.0)
    monkeypatch.setattr(toxicity, "PLACES_AT_ONCE", 300)
    monkeypatch.setattr(toxicity, "PAIRS_AT_ONCE", 10_000)
    h, share = held[:, buckets], ones[buckets] / rows[buckets]
    n, one = h.T @ h, h.T @ (h * label[:, None])
    high, low, p = np.maximum.outer(share, share), np.minimum.outer(share, share), one / np.maximum(n, 1)
    with np.errstate(invalid="ignore"):
        tells = (n >= toxicity.LEAST_ROWS) & ((p > high) & (toxicity._nats(one, n, high) >= 4) | (p < low) & (toxicity._nats(one, n, low) >= 4))
    np.fill_diagonal(tells, False)
    sent, run = [], toxicity._telling_pairs
    monkeypatch.setattr(toxicity, "_telling_pairs", lambda shared: sent.append(len(shared.value[0])) or run(shared))
    got = toxicity._paired(df, buckets, ones[buckets], (rows - ones)[buckets])
    assert 5 < tells.any(0).sum() < len(buckets) / 2
    assert got.tolist() == tells.any(0).tolist()
    assert sent[0] < 0.7 * rows[buckets].sum()


def test_toxicity_of_odd_rows(odd_docs, no_docs, labels):
    known = labels.select("doc_id", F.col("toxic").alias("label"))
    for fitted in (toxicity.fit_machine(odd_docs, known), toxicity.fit_machine(no_docs, known),
                   toxicity.fit_machine(odd_docs, known.where("false"))):
        rows = toxicity.score_toxicity(odd_docs, fitted, carry=odd_docs.columns).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score_toxicity(no_docs, fitted, carry=["doc_id"]).count() == 0


def test_quality_of_held_out_and_odd_rows(docs, labels, odd_docs, no_docs):
    model = cotraining.fit_quality(docs, labels.select("doc_id", F.col("quality").alias("label")), rounds=1)
    rows = cotraining.score_quality(docs, model, carry=["doc_id"]).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) >= 0.85 * len(rows)
    odd = cotraining.score_quality(odd_docs, model, carry=odd_docs.columns).collect()
    assert len(odd) == odd_docs.count() and all(0 <= x <= 1 for r in odd for x in (r.score, r.text_score, r.meta_score))
    assert cotraining.score_quality(no_docs, model, carry=["doc_id"]).count() == 0
    untaught = cotraining.fit_quality(odd_docs, labels.select("doc_id", F.lit(None).cast("int").alias("label")))
    assert {r.score for r in cotraining.score_quality(odd_docs, untaught, carry=["doc_id"]).collect()} == {0.5}


def test_views_lend_what_they_are_sure_of_among_all_rows(docs):
    rng = np.random.default_rng(3)
    weights = {"text": (rng.normal(0, 30, cotraining.TEXT_INPUTS), 0.5), "meta": (rng.normal(0, 3, 2 * cotraining.NAME_INPUTS + 10), -0.5)}
    model = cotraining.QualityModel(weights["text"], weights["meta"], (np.zeros(2), 0.0))
    scored = cotraining.score_quality(docs, model, carry=["doc_id"]).collect()
    sure = lambda p: 1 if p >= cotraining.SURE else 0 if p <= 1 - cotraining.SURE else None
    want = {r.doc_id: (sure(r.meta_score), sure(r.text_score)) for r in scored}
    want = {i: labels for i, labels in want.items() if labels != (None, None)}
    kinds = Counter((at, label) for labels in want.values() for at, label in enumerate(labels))
    assert sum(n > 10 for (_, label), n in kinds.items() if label is not None) >= 2  # there is something to lend
    free = docs.select("doc_id", "text", "source", "lang")
    all_rows = {r.doc_id: (r.for_text, r.for_meta) for r in cotraining._lent(free, free.where('false'), weights, 1_000_000, 0).collect()}
    assert all_rows == want
    few = {r.doc_id: (r.for_text, r.for_meta) for r in cotraining._lent(free, free.where('false'), weights, 5, 0).collect()}
    assert 0 < len(few) < len(want) and all(x in (None, y) for i, own in few.items() for x, y in zip(own, want[i], strict=True))
    lent = Counter((at, label) for labels in few.values() for at, label in enumerate(labels) if label is not None)
    assert all(n <= 20 for n in lent.values())
