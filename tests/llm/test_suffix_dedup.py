import hashlib
import random
from collections import Counter

import pytest
from brute import awkward, empty

from tallyhouse.llm import suffix_dedup


def plain(texts, length):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for d in datas:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, length=400, **more):
    rows = docs.collect()
    expected = [(r["doc_id"], *x) for r, x in zip(rows, plain([r["text"] for r in rows], length))]
    found = suffix_dedup.repeat_report(docs, length, **more).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    return expected


def corpus(spark, seed, n=60):
    """Passages that documents share whole, in part, twice, with edits, at their ends; copies and near copies."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(draw.randint(60, 250)) for _ in range(5)]
    texts = []
    for _ in range(n):
        p = draw.choice(passages)
        cut = p[draw.randint(0, 200) : len(p) - draw.randint(0, 200)]
        at = draw.randrange(len(p))
        kind = draw.randrange(8)
        texts.append([
            prose(50) + p + prose(50), p, cut, prose(30) + cut, cut + prose(30), p[:at] + "X" + p[at + 1 :],
            prose(20) + p + prose(5) + p, "ab" * draw.randint(100, 600),
        ][kind])
    texts += texts[:5]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_awkward(spark):
    assert any(r[2] for r in check(awkward(spark)))


def test_empty(spark):
    assert suffix_dedup.repeat_report(empty(spark)).collect() == []


@pytest.mark.parametrize("seed, at_once, batches", [(1, 4096, 4), (2, 2, 3), (3, 4096, 1)])
def test_passages(spark, monkeypatch, seed, at_once, batches):
    """Also with anchors whose contexts are compared through a shuffle, and with any number of batches."""
    monkeypatch.setattr(suffix_dedup, "CONTEXTS_AT_ONCE", at_once)
    assert sum(r[2] > 0 for r in check(corpus(spark, seed), batches=batches)) > 20


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_STEP", 700)
    check(corpus(spark, 4))


def test_levels_merge_geometrically(spark):
    family = suffix_dedup.SuffixFamily(spark)
    ranks = []
    for i in range(5):
        batch = spark.createDataFrame([(i, 1), (i + 1, 1), (9, i)], "a long, c long")
        found = {tuple(r) for r in family.add(batch).collect()}
        assert i == 0 or {(i, 1, 1)} <= found
        ranks.append(sorted(family.levels))
    assert ranks == [[0], [1], [0, 1], [2], [0, 2]]
    family.close()


def test_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
