import random
import re

import numpy as np
import pytest
import xxhash
from brute import awkward, empty

from tallyhouse.llm import simhash
from tallyhouse.llm.common import connected_labels


def plain(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(shingles))


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    prints = [plain(r["text"]) for r in rows]
    distinct = sorted(set(prints))
    roots = components(
        [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= 3], distinct
    )
    ids = {}
    for r, p in zip(rows, prints):
        if r["doc_id"] is not None:
            ids[roots[p]] = min(ids.get(roots[p], r["doc_id"]), r["doc_id"])
    return sorted(((r["doc_id"], f"{p:016x}", ids.get(roots[p])) for r, p in zip(rows, prints)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_awkward(spark):
    docs = awkward(spark)
    assert result(simhash.near_duplicates(docs)) == brute(docs.collect())


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(simhash.near_duplicates(docs)) == brute(docs.collect())


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_every_link_is_found(spark, parts, monkeypatch):
    """Clusters around hot values, so that thresholds differ; buckets are dealt in pieces."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 50)
    draw = random.Random(parts)
    prints = set()
    for _ in range(12):
        base = draw.getrandbits(64) & ~0xFFFF
        for _ in range(60):
            value = base
            for _ in range(draw.randint(0, 4)):
                value ^= 1 << draw.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.near_links(nodes, 3, parts).collect()
    links = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if (a ^ b).bit_count() <= 3 or
             ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    assert components([(r.u, r.v) for r in found], signed) == components(links, signed)


def test_thresholds_spend_the_budget():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 1 << 63, 500, dtype=np.uint64)
    groups = [list(range(i, i + 16)) for i in range(0, 64, 16)]
    counts = [[np.bincount(simhash.pick_bits(values, g).astype(int), minlength=1 << 16)] for g in groups]
    counts[0][0] += 100000
    chosen = simhash.Probing(groups, counts, 500, 3).thresholds(values)
    assert ((chosen + 1).sum(axis=0) == 4).all() and (chosen[0] == -1).all()


def test_components(spark):
    draw = random.Random(7)
    pairs = [(i, i + 1) for i in range(300)] + [(1000 + draw.randrange(200), 1000 + draw.randrange(200)) for _ in range(150)]
    pairs += [(5000, 6000 + i) for i in range(200)]
    nodes = {n for p in pairs for n in p if p[0] != p[1]}
    found = {r.node: r.label for r in connected_labels(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == components([p for p in pairs if p[0] != p[1]], nodes)


def test_no_components(spark):
    assert connected_labels(spark.createDataFrame([], "u long, v long")).collect() == []
