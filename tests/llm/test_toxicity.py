import zlib

import numpy as np
import pytest
from brute import awkward, empty
from pyspark.sql import functions as F

from tallyhouse.llm import toxicity
from tallyhouse.llm.common import read_table

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = read_table(spark, FOLDER, "documents"), read_table(spark, FOLDER, "labels")
    return toxicity.fit(toxicity.training_rows(docs, labels))


def test_held_out_rows(spark, model):
    docs = read_table(spark, FOLDER, "documents")
    labels = read_table(spark, FOLDER, "labels").filter("doc_id is not null").select("doc_id", "toxic")
    found = toxicity.score(docs, model, kept=["doc_id"]).withColumn("held", toxicity.held_out()).join(labels, "doc_id")
    rows = found.filter("held").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    caught = sum(r.tox_predicted for r in rows if r.toxic)
    wrong = sum(r.tox_predicted for r in rows if not r.toxic)
    toxic = sum(r.toxic for r in rows)
    scores = sorted((r.tox_score, r.toxic) for r in rows)
    ranks = [i for i, (_, t) in enumerate(scores) if t]
    area = (sum(ranks) - toxic * (toxic - 1) / 2) / (toxic * (len(rows) - toxic))
    print("held out", len(rows), toxic, "caught", caught, "wrong", wrong, "area", area)
    assert caught / toxic > 0.9 and wrong / (len(rows) - toxic) < 0.005 and area > 0.98


def test_scores_rise_with_the_margin(model):
    values = np.random.default_rng(3).random((2000, len(toxicity.FEATURES)))
    margin, score = model.margin(values), model.scores(values)
    order = np.argsort(margin)
    assert (np.diff(score[order]) >= -1e-12).all() and score.min() >= 0 and score.max() <= 1


def test_trees_as_spark_reads_them(spark):
    """The margin by flat trees is Spark's own raw prediction, also on values that stand on a threshold."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(5)
    values = draw.integers(0, 6, (400, 3)) / 2
    rows = [(float((v[0] > 1) ^ (v[1] * v[2] > 1.5)), Vectors.dense(v)) for v in values]
    rounds = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=6, maxDepth=4, seed=1).fit(spark.createDataFrame(rows, ["toxic", "features"]))
    flat = toxicity.ToxicityModel(toxicity.Lexicon({}), toxicity.flat_trees(rounds), (np.zeros(0), np.zeros(0)))
    asked = np.concatenate([values, draw.normal(0, 100, (100, 3))])
    spark_rows = rounds.transform(spark.createDataFrame([(Vectors.dense(v),) for v in asked], ["features"])).collect()
    assert np.allclose(flat.margin(asked), [r.rawPrediction[1] for r in spark_rows])


def test_few_toxic_labels(spark):
    """Six toxic documents to learn from, in several languages: no constant, and toxic ones tend to score higher."""
    folder = "/root/testdata/sf0.001"
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    few = toxicity.fit(toxicity.training_rows(docs, labels))
    assert few.trees and len(few.steps[0])
    rows = toxicity.score(docs, few, kept=["doc_id"]).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = ([r.tox_score for r in rows if r.toxic == t] for t in (1, 0))
    area = np.mean([(t > c) + (t == c) / 2 for t in toxic for c in clean])
    print("area", area, len(toxic), len(clean))
    assert area > 0.7 and len({r.tox_score for r in rows}) > 20


def test_rare_label_stays(spark, monkeypatch):
    """Of 60,000 rows 40 are toxic: all of them are trained on, and weights make up for the clean ones left out."""
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 2000)
    written = []
    keep = toxicity.write_through
    monkeypatch.setattr(toxicity, "write_through", lambda df, name: written.append((name, keep(df, name))) or written[-1][1])
    word = F.concat(F.lit("word"), (F.col("id") % 997).cast("string"))
    text = F.when(F.col("id") % 1500 == 0, F.concat(F.lit("you vile nasty fool "), word)).otherwise(F.concat(F.lit("a calm and plain text "), word))
    rows = spark.range(60_000).select(text.alias("text"), (F.col("id") % 1500 == 0).cast("int").alias("toxic"), F.col("id").alias("row"))
    model = toxicity.fit(rows)
    labelled = dict(written)["labelled"]
    counts = {r.toxic: (r.n, r.w) for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}
    assert counts[1] == (40, 40.0) and 1700 < counts[0][0] < 2200 and 54_000 < counts[0][1] < 66_000
    asked = spark.createDataFrame([("you nasty vile fool",), ("some calm text",)], "text string")
    bad, good = (r.tox_score for r in toxicity.score(asked, model).collect())
    assert bad > 0.7 > good


@pytest.mark.parametrize("toxic", [0, 1, 2])
def test_too_few_labels(spark, toxic):
    rows = [("bad text", 1)] * 9 + [("worse text", 1)] if toxic == 2 else [("bad text", 1)] * toxic
    with pytest.warns(UserWarning, match="every score"):
        model = toxicity.fit(spark.createDataFrame(rows + [(f"good text {i}", 0) for i in range(30)], "text string, toxic int"))
    assert not model.trees


def test_awkward(spark, model):
    docs = awkward(spark)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and {"shard", "fp", "label"} <= set(rows[0].asDict())
    assert all(0 <= r.tox_score <= 1 and r.tox_predicted == int(r.tox_score >= 0.7) for r in rows)
    same = {}
    for r in rows:
        assert same.setdefault(r.text or "", r.tox_score) == r.tox_score


def test_empty_and_one_label(spark):
    none = toxicity.fit(empty(spark).select("text", F.lit(1).alias("toxic")))
    assert toxicity.score(empty(spark), none).collect() == []
    rows = toxicity.score(awkward(spark), none, kept=["doc_id"]).collect()
    assert len({r.tox_score for r in rows}) == 1 and not any(r.tox_predicted for r in rows)


def test_labels_that_repeat(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(4, 0), (4, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    assert {tuple(r) for r in toxicity.training_rows(docs, labels).collect()} <= {("one", 1, 4), ("two words", 1, 4)}


def test_sample_of_many_copies(spark, monkeypatch):
    """Half of the labelled rows are one text; what is trained on keeps to the bound, but for chance."""
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 400)
    trained = []
    monkeypatch.setattr(toxicity, "write_through", lambda df, name: trained.append(df) or df)
    text = F.when(F.col("id") % 2 == 0, "one text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string")))
    rows = spark.range(8000).select(text.alias("text"), F.lit(0).alias("toxic"), F.col("id").alias("row"))
    toxicity.fit(rows)
    copies = trained[0].groupBy("text").count().filter("text = 'one text'").first()["count"]
    assert 300 < trained[0].count() < 500 and 130 < copies < 270
