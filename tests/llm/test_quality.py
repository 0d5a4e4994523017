import math

import numpy as np
import pytest
from brute import INSIDE, awkward, empty
from pyspark.sql import functions as F

from tallyhouse.llm import quality
from tallyhouse.llm.common import read_table
from tallyhouse.llm.queries import op13_quality_classifier

LONG = ("some words of a text, and more! " * 40 + "x" * 3000 + " | | ### " + "again " * 300 + "é漢 " * 700).encode()
TEXTS = [b"", b"a", b"one two two", b"   \n", LONG, b"The End.", b"\x00\xff\xfe broken", "É É É".encode()]


def plain_passages(data):
    """One passage after the other, byte by byte."""
    cuts, at = [], quality.PASSAGE
    while at < len(data):
        near = [i for i in range(at, min(at + quality.NEAR, len(data))) if data[i] in b" \t\n\r\x0b\x0c"]
        cuts.append(near[0] if near else at)
        at += quality.PASSAGE
    return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]


def plain_features(passage):
    out = np.zeros(quality.FEATURES)
    kinds = [int(quality.KIND[b]) for b in passage]
    for a, b in zip(kinds, kinds[1:]):
        out[a * quality.KINDS + b] += 1 / (len(passage) - 1)
    low = passage.lower()
    for a, b, c in zip(low, low[1:], low[2:]):
        value = ((a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) % (1 << 32)) * 0x27D4EB2F % (1 << 32)
        out[quality.KINDS**2 + (value >> 25)] += 1 / (len(passage) - 2)
    out = np.sqrt(out)
    words = low.translate(bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")).split()
    if words:
        again = sum(a == b for a, b in zip(words, words[1:]))
        out[-4:] = [len(set(words)) / len(words), again / len(words), min(2, sum(map(len, words)) / len(words) / 20), 1]
    return out


def plain_score(model, data):
    """The gated attention of one document, passage by passage."""
    h = [np.tanh(plain_features(p) @ model.hidden + model.hidden0) for p in plain_passages(data)]
    e = [float((np.tanh(x @ model.look) / (1 + np.exp(-(x @ model.gate)))) @ model.pick) for x in h]
    share = [math.exp(v - max(e)) for v in e]
    bag = sum(s * x for s, x in zip(share, h)) / sum(share)
    return 1 / (1 + math.exp(-float(bag @ model.out + model.out0[0])))


def test_passages_and_features():
    found = [f for features, _ in quality.chunks(TEXTS) for f in features]
    expected = [plain_features(p) for t in TEXTS for p in plain_passages(t)]
    assert len(found) == len(expected) and np.allclose(found, expected, atol=1e-6)


@pytest.mark.parametrize("passages, size", [(1, 1), (2, 700), (3, 1 << 30), (10_000, 1 << 30)])
def test_scores_of_chunks(monkeypatch, passages, size):
    monkeypatch.setattr(quality, "CHUNK_PASSAGES", passages)
    monkeypatch.setattr(quality, "CHUNK_BYTES", size)
    model = quality.Weights.drawn(5)
    model.pick *= 30  # attention that differs much between passages
    assert np.allclose(model.scores(TEXTS), [plain_score(model, t) for t in TEXTS], atol=1e-5)


def test_gradient():
    model = quality.Weights.drawn(1, hidden=5, attention=4)
    draw = np.random.default_rng(2)
    features = draw.random((11, quality.FEATURES))
    starts, labels, weights = np.array([0, 1, 6]), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    _, slope = model.gradient(features, starts, labels, weights)
    flat = model.flat()
    for i in [*draw.integers(0, len(flat), 40), *range(len(flat) - 60, len(flat))]:
        moved = []
        for by in (1e-6, -1e-6):
            other = flat.copy()
            other[i] += by
            moved.append(model.filled(other).gradient(features, starts, labels, weights)[0])
        assert abs((moved[0] - moved[1]) / 2e-6 - slope[i]) < 1e-6


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    rows = op13_quality_classifier(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in read_table(spark, folder, "labels").collect()}
    assert len(rows) == read_table(spark, folder, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, poor = [p for q, p in held if q == 1], [p for q, p in held if q == 0]
    assert len(poor) > 100 and sum(good) > 0.99 * len(good) and sum(poor) < 0.05 * len(poor)


def test_few_labels(spark):
    """Eight poor documents to learn from: held-out ones still score below good ones."""
    folder = "/root/testdata/sf0.001"
    labels = {r.doc_id: r.quality for r in read_table(spark, folder, "labels").collect()}
    rows = [r for r in op13_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in labels]
    good, poor = ([r.score for r in rows if labels[r.doc_id] == q] for q in (1, 0))
    assert min(good) > max(poor)


def test_bounded_sample(spark, monkeypatch):
    """Beyond the bound both labels stay, the rarer one with up to half of the rows, and weights restore the shares."""
    monkeypatch.setattr(quality, "TRAIN_ROWS", 1000)
    rows = [(f"text {i}", int(i % 50 != 0), str(i)) for i in range(20_000)] + [("copy", 1, str(i)) for i in range(10_000)]
    table = spark.createDataFrame(rows, "text string, quality int, row string").withColumn("size", F.length("text"))
    sample, n, size = quality._sampled(table, quality._place("row", 1))
    assert 4000 < size < 10_000
    found = {r["quality"]: r for r in sample.groupBy("quality").agg({"*": "count", "weight": "sum"}).collect()}
    assert n == {0: 400, 1: 29_600} and found[0]["count(1)"] == 400 and 500 < found[1]["count(1)"] < 700
    assert 0.85 < found[1]["sum(weight)"] / 29_600 < 1.15


def test_long_documents_as_several_bags(spark, monkeypatch):
    monkeypatch.setattr(quality, "CHUNK_PASSAGES", 3)
    rows = [("good words of a text. " * 200, 1), ("### $$$ && " * 400, 0), ("short text here", 1), ("%%% @@@", 0), ("", 1)] * 12
    model = quality.fit(spark.createDataFrame(rows, "text string, quality int"))
    good, poor = model.scores([b"other words, a good text. " * 300, b"### && $$$ " * 300])
    assert good > 0.7 > poor


@pytest.mark.parametrize("labels", [[], [1, 1, 1], [0], [None, 5]])
def test_one_label_only(spark, labels):
    data = spark.createDataFrame([("text", q) for q in labels], "text string, quality int")
    with pytest.warns(UserWarning, match="one label"):
        model = quality.fit(data)
    known = [q for q in labels if q in (0, 1)]
    assert model.scores([b"", b"x"]).tolist() == [(sum(known) + 1) / (len(known) + 2)] * 2


@pytest.mark.parametrize("table", [awkward, empty])
def test_awkward_tables(spark, table):
    docs = table(spark)
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (None, 1), (4, 1), (4, 0), (5, 1), (6, 0), (7, 1)], "doc_id long, quality int")
    training = quality.training_rows(docs, labels)
    assert training.columns == ["text", "quality", "row", "weight"]
    kept = {(r.text, r.quality) for r in training.collect()}
    if table is awkward:
        assert ("one", 0) in kept and ("two words", 0) in kept and (None, 1) not in kept
        held = {r.doc_id for r in docs.filter(quality.held_out()).collect()}
        expected = [r for r in docs.collect() if r.doc_id in (1, 3, 4, 5, 6, 7) and r.doc_id not in held]
        assert training.count() == len(expected)  # a repeated row is there as often as in the table
    model = quality.QualityModel(quality.Weights.drawn(1), 0.5)
    scored = quality.score(docs, model)
    rows = scored.collect()
    assert scored.columns == [c for c in docs.columns if c.lower() not in ("quality_score", "quality_predicted")] + ["quality_score", "quality_predicted"]
    assert len(rows) == docs.count() and all([r[c] for c in INSIDE] == INSIDE and r["a.b"] == [1, None] for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.quality_score) == r.quality_score  # a null text scores as an empty one
        assert abs(r.quality_score - plain_score(model.weights, (r.text or "").encode())) < 1e-5
    named = quality.score(docs, model, names=("score", "label"))
    assert named.count() == len(rows) and dict(named.dtypes)["score"] == "double"
    if table is awkward:
        kept = quality.without_poor(docs, labels, threshold=0.0)
        assert kept.columns == docs.columns and kept.count() == len(rows)
