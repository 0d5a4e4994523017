import zlib

from brute import awkward, empty

from tallyhouse.llm.sharding import shard_by_bytes


def check(rows, docs, shards):
    expected = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len((r["text"] or "").encode()) + 8,
                       zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == expected
    total = sum(r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    order = [r for s in sorted(by) for r in sorted(by[s], key=lambda r: r.slot)]
    assert [r.slot for r in order] == [i for s in sorted(by) for i in range(len(by[s]))]
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in order]
    assert keys == sorted(keys)
    at = 0
    for r in order:  # the cut, brute force
        assert r.shard == min(shards - 1, (at * 2 + r.size) * shards // (2 * total))
        at += r.size


def test_awkward(spark):
    docs = awkward(spark)
    check(shard_by_bytes(docs, 3).collect(), docs, 3)


def test_empty(spark):
    assert shard_by_bytes(empty(spark)).collect() == []


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shard_by_bytes(docs).collect()
    check(rows, docs, 24)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(24)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
