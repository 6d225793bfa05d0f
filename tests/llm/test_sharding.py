import zlib
from collections import Counter

from gridlens.llm.sharding import interleave


def check(rows, docs, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    counts = Counter(r.shard for r in rows)
    filled = [counts[s] for s in range(shards)]
    assert max(filled) - min(filled) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_every_shard_matches_the_mixture(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('t', id) as text",
                                        "case when id % 3 = 0 then 'hot' else concat('s', id % 11) end as source")
    rows = interleave(docs, 40).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 40)
    whole = Counter(r.source for r in rows)
    per = Counter((r.shard, r.source) for r in rows)
    assert all(abs(per[s, x] - whole[x] / 40) <= 2 for s in range(40) for x in whole)
    assert sorted(map(tuple, interleave(docs.repartition(7), 40).collect())) == sorted(map(tuple, rows))  # rows and seed decide
    other = interleave(docs, 40, seed="another").collect()
    assert {r.doc_id: r.shard for r in other} != {r.doc_id: r.shard for r in rows}


def test_odd_rows_copies_and_few_rows(odd_docs, no_docs):
    rows = interleave(odd_docs, 5).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], 5)
    many = odd_docs.unionAll(odd_docs).unionAll(odd_docs)
    check(interleave(many, 7).collect(), [(r.doc_id, r.text) for r in many.collect()], 7)
    assert len({r.shard for r in interleave(odd_docs.limit(3), 40).collect()}) == 3
    assert interleave(no_docs, 5).count() == 0
