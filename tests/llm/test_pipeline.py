import corpus_pipeline as P
import numpy as np
from pyspark.sql import functions as F
from test_neardup import brute as groups_of
from test_substrings import brute as cuts_of

SF = "/root/testdata/sf0.001"


def test_each_stage_equals_brute_force_on_what_it_gets(spark, sample_docs, workdir):
    docs = sample_docs
    for i, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{workdir}/{i}")
        after = spark.read.parquet(f"{workdir}/{i}")
        rows = after.collect()
        if name != "packing":
            assert after.columns == docs.columns
        if name == "language ID":
            assert {r.doc_id for r in rows} == set(before)
        elif name == "near-duplicates":
            _, label = groups_of([(d, r.text) for d, r in before.items()], 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted(set(label.values()))
        elif name == "suffix-array dedup":
            texts = [r.text for r in before.values()]
            want = {d: kept.decode("utf-8", "ignore") for d, (kept, _) in zip(before, cuts_of(texts, 200), strict=True) if kept}
            assert {r.doc_id: r.text for r in rows} == want
            assert all(r.n_chars == len(r.text) for r in rows if r.text != before[r.doc_id].text)
        elif name == "decontamination":
            items = [t.text.rstrip(".") for t in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert {r.doc_id for r in rows} == {d for d, r in before.items() if not any(x in r.text for x in items)}
        else:
            assert {r.doc_id for r in rows} == set(before)
            assert all(len(np.frombuffer(r.ids, dtype="<u4")) == r.length for r in rows)
        docs = after


def test_odd_and_empty_documents_pass_all_stages(spark, sample_docs, workdir, odd_docs):
    extra = odd_docs.select(F.col("doc_id") + 10_000, "text", "lang", "source", "n_chars").toDF(*sample_docs.columns)
    for docs in (sample_docs.unionByName(extra), sample_docs.where("false")):
        for _, stage in P.STAGES:
            path = f"{workdir}/{docs.count()}-{stage.__name__}"
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)


def test_stages_judge_rows_with_null_and_repeated_ids(spark, sample_docs, workdir):
    """Clean texts stay and bad ones go, whatever their ids."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    words = [w for r in sample_docs.where("lang = 'en'").orderBy("doc_id").limit(30).collect() for w in (r.text or "").split()]
    text = lambda i: " ".join(words[40 * i:40 * i + 40])
    repeat = text(9) + " " + text(10)
    rows = [(None, text(0)), (None, text(0)), (3, text(1)), (3, text(2)), (5, text(2)), (None, text(3) + " " + bench.text),
            (7, text(4) + " " + bench.text), (7, text(5)), (8, None), (8, ""), (None, text(6) + " " + repeat), (9, text(7) + " " + repeat)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(P.STAGES)
    kept = sorted((str(r.doc_id), r.text or "") for r in stages["near-duplicates"](spark, docs, SF).collect())
    want = list(rows)
    for row in ((None, text(0)), (5, text(2))):
        want.remove(row)
    assert kept == sorted((str(d), t or "") for d, t in want)
    clean = sorted((str(r.doc_id), r.text or "") for r in stages["decontamination"](spark, docs, SF).collect())
    assert clean == sorted((str(d), t or "") for d, t in rows if bench.text not in (t or ""))
    cut = stages["suffix-array dedup"](spark, docs.where(F.col("text").contains(repeat) | (F.col("doc_id") == 8)), SF).collect()
    assert len(cut) == 4 and all(repeat not in (r.text or "") for r in cut)
    assert {(r.doc_id, (r.text or "")[:20]) for r in cut} == {(None, text(6)[:20]), (9, text(7)[:20]), (8, "")}
    packed = stages["packing"](spark, docs, SF).select("doc_id").distinct().collect()
    assert {r.doc_id for r in packed} == {d for d, _ in rows}


def test_a_stage_removes_what_the_one_before_staged(spark, sample_docs, workdir):
    stages = dict(P.STAGES)
    stages["near-duplicates"](spark, sample_docs, SF).write.parquet(f"{workdir}/a")
    behind = list(P._behind)
    assert behind
    stages["decontamination"](spark, spark.read.parquet(f"{workdir}/a"), SF).write.parquet(f"{workdir}/b")
    hadoop = spark._jvm.org.apache.hadoop.fs
    exists = lambda f: hadoop.Path(f).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop.Path(f))
    assert not any(exists(f) for f in behind)
    lazy = stages["near-duplicates"](spark, sample_docs, SF)  # not written: the next stage still reads its intermediates
    assert stages["decontamination"](spark, lazy, SF).count() == spark.read.parquet(f"{workdir}/b").count()


def test_learned_stages_have_no_sql():
    assert P.ORACLE_SQL is None
    assert [n for n, _ in P.STAGES] == ["language ID", "near-duplicates", "suffix-array dedup", "decontamination", "packing"]


def test_stages_pass_few_whole_texts_at_once_and_each_once(spark, sample_docs):
    """Executors hold the batches that go to Python beside their heap: at most 1,000 rows, no text twice."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for setting, want in (("10000", 1000), ("0", 1000), ("200", 200)):
            spark.conf.set(key, setting)
            judged = dict(P.STAGES)["language ID"](spark, sample_docs, SF)
            assert int(spark.conf.get(key)) == want
        plan = judged._jdf.queryExecution().optimizedPlan().toString()
        sent = next(line for line in plan.split("\n") if " AS row#" in line)  # what goes to Python: the rows alone
        assert "AS row#" in sent and "text#" not in sent.split(" AS row#")[1]
    finally:
        spark.conf.set(key, before)
