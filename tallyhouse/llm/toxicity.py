"""Toxicity scores: gradient-boosted trees over dense features of whole texts, calibrated by isotonic regression.

The lexicon is learned from the labels: words, and the beginnings of words, that stand in clearly more toxic than clean
documents, in any language. The features are densities and rates; the trees are Spark's; the calibration is a monotone
step function of the trees' margin. Training uses a bounded sample of labelled rows, everything else all rows.
"""

from __future__ import annotations

import math
import re
import warnings
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, giving_back, write_through

#: Labelled rows that are trained on, but for chance: beyond this bound a hash of text and row chooses them, the rarer
#: label's up to half of the bound.
TRAIN_ROWS = 30_000
#: Parts that the trained rows are dealt to, label by label.
PARTS = 5
#: Entries of the learned lexicon at most, strongest first.
LEXICON_SIZE = 2_000
STEMS = (4, 5, 6, 7)
#: An entry stands in at least so many toxic documents (two, where there are few), and this much oftener in them than in clean ones.
LEAST_DOCS, LEAST_RATIO = 4, 6.0
THRESHOLD = 0.7

#: Second-person words of the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted su".split()
)
WORD = re.compile(r"\w+", re.UNICODE)
#: Signs and digits inside a word, as in "st*pid".
OBFUSCATED = re.compile(r"(?<=[^\W\d_])[*@$#%&!0-9]+(?=[^\W\d_])")
SHOUTED = re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}")
_DISGUISES = np.array([ord(c) for c in "*@$#%&!0123456789"])
_MARKS = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
FEATURES = [
    "lexicon_words", "lexicon_weight", "lexicon_most", "lexicon_kinds", "lexicon_second_person", "second_person",
    "capitals", "shouted_words", "punctuation", "exclamations", "obfuscated", "digits", "log_words", "word_length",
]
#: Words around a lexicon word in which a second person counts as near.
NEAR = 5


def entries_of(word: str) -> list[str]:
    """A word and its beginnings: "word", and "stem-" for each length shorter than the word."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) > n)]


class _Known(dict):
    """Weights of the words that a worker has met."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 100_000:
            self.clear()
        get = self.weights.get
        found = self[word] = max(get(e, 0.0) for e in entries_of(word))
        return found


@dataclass
class Lexicon:
    """Weights (log of how much oftener an entry stands in toxic documents), strongest entries only: bounded."""

    weights: dict[str, float]

    def __post_init__(self):
        self.known = _Known(self.weights)

    def __getstate__(self):
        return self.weights

    def __setstate__(self, weights):
        self.weights, self.known = weights, _Known(weights)


def _runs(short: np.ndarray) -> int:
    """Stretches of four and more single letters."""
    if short.sum() < 4:
        return 0
    edges = np.diff(np.r_[0, short.astype(np.int8), 0])
    return int((np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1) >= 4).sum())


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text; an empty one has zeros."""
    words = WORD.findall(text.lower())
    data = text.encode("utf-8", "surrogatepass")
    n, size = max(1, len(words)), max(1, len(data))
    weights = np.fromiter(map(lexicon.known.__getitem__, words), float, count=len(words))
    lengths = np.fromiter(map(len, words), np.int64, count=len(words))
    hits = np.flatnonzero(weights)
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if len(hits) and persons:
        at = np.array(persons)
        place = np.searchsorted(at, hits)
        before = np.abs(hits - at[np.maximum(place - 1, 0)])
        after = np.abs(at[np.minimum(place, len(at) - 1)] - hits)
        near = int((np.minimum(before, after) <= NEAR).sum())
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    obfuscated = _runs(lengths == 1) + (len(OBFUSCATED.findall(text)) if seen[_DISGUISES].any() else 0)
    return [
        len(hits) / n, float(weights.sum()) / n, float(weights.max(initial=0.0)), float(len({words[i] for i in hits})),
        near / n, len(persons) / n, float(seen[65:91].sum()) / size, len(SHOUTED.findall(text)) / n,
        float(seen[_MARKS].sum()) / size, float(seen[33]) / size, obfuscated / n, float(seen[48:58].sum()) / size,
        math.log1p(len(words)), float(lengths.sum()) / n,
    ]


# ---- lexicon --------------------------------------------------------------------------------------------------------


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """From (text, toxic): document counts of every entry in toxic and in clean documents, then the strongest."""

    def count(batches):
        """Counts of a part of the rows, pre-aggregated: a row an entry, not one a word."""
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            keys = list({*seen[0], *seen[1]})
            clean, toxic = ([c[k] for k in keys] for c in seen)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())],
                ["entry", "clean", "toxic"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                words = set(WORD.findall((text.as_py() or "").lower()))
                seen[toxic.as_py()].update({e for w in words for e in entries_of(w)})
                if len(seen[0]) + len(seen[1]) > 200_000:
                    yield flush()
                    seen[0].clear()
                    seen[1].clear()
        yield flush()

    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Lexicon({})
    least = max(2, min(LEAST_DOCS, n[1] // 2))
    counts = labelled.select("text", "toxic").mapInArrow(giving_back(count), "entry string, clean long, toxic long")
    counts = counts.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = (F.col("toxic") / n[1]) / ((F.col("clean") + 1) / n[0])
    strong = (
        counts.filter((F.col("toxic") >= least) & (ratio >= LEAST_RATIO))
        .select("entry", F.log(ratio).alias("weight"), (F.log(ratio) * F.sqrt("toxic")).alias("strength"))
        .orderBy(F.desc("strength"), "entry")
        .limit(LEXICON_SIZE)  # the lexicon's size, a parameter
    )
    return Lexicon({r["entry"]: r["weight"] for r in strong.collect()})


def with_features(docs: DataFrame, lexicon: Lexicon, text: str, kept: list[str]) -> DataFrame:
    """The columns ``kept`` and an array of features, one for each row."""
    fields = [docs.schema[c] for c in kept]
    names = [*kept, "tox_features"]

    def compute(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = [features(t.as_py() or "", lexicon) for t in part.column(0)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i + 1) for i in range(len(kept))), pa.array(values, pa.list_(pa.float64()))], names
                )

    schema = T.StructType([*fields, T.StructField("tox_features", T.ArrayType(T.DoubleType()))])
    chosen = docs.select(F.col(text).cast("string").alias("tox_text"), *(F.col(f"`{c}`") for c in kept))
    return chosen.mapInArrow(giving_back(compute), schema)


# ---- model ----------------------------------------------------------------------------------------------------------


@dataclass
class ToxicityModel:
    """A learned lexicon, trees as flat arrays, and the steps of the calibration: all of bounded size."""

    lexicon: Lexicon
    trees: list[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    steps: tuple[np.ndarray, np.ndarray]

    def margin(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values))
        for weight, feature, threshold, left, right, value in self.trees:
            node = np.zeros(len(values), dtype=np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                own = values[np.arange(len(values)), np.maximum(feature[node], 0)]
                node = np.where(inner, np.where(own <= threshold[node], left[node], right[node]), node)
            total += weight * value[node]
        return total

    def scores(self, values: np.ndarray) -> np.ndarray:
        """0 to 1: the calibrated margin; ties of its steps are ordered by a thousandth of the margin's own order."""
        margin = self.margin(values)
        x, y = self.steps
        calibrated = np.interp(margin, x, y) if len(x) else np.full(len(values), 0.5)
        return np.clip(0.999 * calibrated + 0.001 / (1 + np.exp(-2 * margin)), 0.0, 1.0)


def _flat(node, rows: list) -> int:
    """A Java tree as rows (feature, threshold, left, right, value), a leaf with feature -1; returns the node's place."""
    at = len(rows)
    rows.append(None)
    if node.getClass().getSimpleName() == "LeafNode":
        rows[at] = (-1, 0.0, at, at, node.prediction())
    else:
        split = node.split()
        left, right = _flat(node.leftChild(), rows), _flat(node.rightChild(), rows)
        rows[at] = (split.featureIndex(), split.threshold(), left, right, node.prediction())
    return at


def flat_trees(rounds) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The trees of Spark's boosted model, each with its weight."""
    flat = []
    for weight, tree in zip(rounds.treeWeights, rounds._call_java("trees")):
        rows: list = []
        _flat(tree.rootNode(), rows)
        flat.append((weight, *(np.array(x) for x in zip(*rows))))
    return flat


def fit(labelled: DataFrame, trees: int = 20, depth: int = 4, seed: int = 7) -> ToxicityModel:
    """From (text, toxic 0 or 1); rows with a null label are left out.

    A column ``row``, if there, tells copies of a text apart when rows are sampled, so that a text with very many
    copies is sampled like others; it is not learned from.

    Parts by the order of a hash of the text, label by label, so that every part has rows of both labels, and nothing is
    fitted on what it is judged by: copies stay together. The lexicon that trees see is learned from the other half than
    the trees, the calibration from a part that neither saw. With less than three different texts of a label there is
    nothing to hold back: the model is then constant, and a warning says so.
    """
    # here, because the workers import this module and need none of it
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    row = F.col("row").cast("string") if "row" in labelled.columns else F.lit("")
    labelled = labelled.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic"), row.alias("row"))
    labelled = labelled.filter(F.col("toxic").isin(0, 1)).withColumn("text", F.coalesce("text", F.lit("")))
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = min(n.get(0, 0), n.get(1, 0), TRAIN_ROWS // 2)
    rare = 1 if n.get(1, 0) <= n.get(0, 0) else 0
    share = {label: min(1.0, (few if label == rare else TRAIN_ROWS - few) / max(1, n.get(label, 0))) for label in (0, 1)}
    place = F.pmod(F.xxhash64("text", "row", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    weight = F.when(F.col("toxic") == 1, F.lit(1 / (share[1] or 1.0))).otherwise(F.lit(1 / (share[0] or 1.0)))
    # on the texts' side, so that only what is chosen meets the labels
    labelled = labelled.filter(place < max(share.values())).filter(place < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    labelled = labelled.select("text", "toxic", weight.alias("weight"), F.xxhash64("text", F.lit(seed + 1)).alias("key"))
    labelled = write_through(labelled, "labelled")
    # the sample is bounded, so its keys may be ordered in one task and sent to all
    order = F.row_number().over(Window.partitionBy("toxic").orderBy("key"))
    order = write_through(labelled.select("toxic", "key").distinct().withColumn("order", order), "order")
    texts = {r["toxic"]: r["order"] for r in order.groupBy("toxic").agg(F.max("order").alias("order")).collect()}
    parts = min(PARTS, texts.get(0, 0), texts.get(1, 0))
    lexicon = learn_lexicon(labelled)
    if parts < 3:
        warnings.warn(f"labels of {texts.get(1, 0)} toxic and {texts.get(0, 0)} other texts: every score will be the same", stacklevel=2)
        return ToxicityModel(lexicon, [], (np.zeros(0), np.zeros(0)))
    labelled = labelled.join(F.broadcast(order), ["toxic", "key"]).withColumn("part", F.col("order") % parts)
    half, rest = labelled.filter(F.col("part") < parts // 2), labelled.filter(F.col("part") >= parts // 2)
    other, last = rest.filter(F.col("part") < parts - 1), rest.filter(F.col("part") == parts - 1)
    kept = ["toxic", "weight"]
    seen = with_features(other, learn_lexicon(half), "text", kept)
    seen = seen.union(with_features(half, learn_lexicon(other), "text", kept))
    held = with_features(last, learn_lexicon(labelled.filter(F.col("part") < parts - 1)), "text", kept)

    def table(df):
        named = df.select(F.col("toxic").cast("double").alias("toxic"), "weight", *(F.col("tox_features")[i].alias(f) for i, f in enumerate(FEATURES)))
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(named)

    train = write_through(table(seen).select("toxic", "weight", vector_to_array("features").alias("v")), "features")
    train = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        train.select("toxic", "weight", *(F.col("v")[i].alias(f) for i, f in enumerate(FEATURES)))
    )
    rounds = GBTClassifier(
        labelCol="toxic", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed,
        subsamplingRate=0.8, minInstancesPerNode=max(1, min(5, texts[rare] // 4)), checkpointInterval=-1,
    ).fit(train)
    model = ToxicityModel(lexicon, flat_trees(rounds), (np.zeros(0), np.zeros(0)))
    margins = held.select(F.col("toxic").cast("double").alias("toxic"), "tox_features", "weight")

    def margin(batches):
        for batch in batches:
            values = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.margin(values)), batch.column(2)], ["toxic", "margin", "weight"])

    points = write_through(margins.mapInArrow(giving_back(margin), "toxic double, margin double, weight double"), "margins")
    steps = IsotonicRegression(labelCol="toxic", featuresCol="margin", weightCol="weight").fit(points)
    model.steps = (np.array(steps.boundaries.toArray()), np.array(steps.predictions.toArray()))
    return model


def score(
    docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, kept: list[str] | None = None,
    names: tuple[str, str] = ("tox_score", "tox_predicted"),
) -> DataFrame:
    """The columns ``kept`` (all by default) with tox_score (0 to 1) and tox_predicted (1 from ``threshold`` on).

    ``names`` gives the two new columns other names; a kept column that has one of them gives way to the new one.

    Whole texts are scored, one row for each row; null and empty texts have a score too, that of no words. Only
    ``text`` is read. An empty table has no rows.
    """
    new = {n.lower() for n in names}
    kept = [c for c in (docs.columns if kept is None else kept) if c.lower() not in new]
    fields = [docs.schema[c] for c in kept]
    # the text goes to the tasks once
    at_text = kept.index("text") if "text" in kept else len(kept)
    whole = [] if "text" in kept else [F.col("text").cast("string").alias("whole")]
    held = [*(f"c{i}" for i in range(len(kept))), "score"]

    def compute(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = np.array([features(t.as_py() or "", model.lexicon) for t in part.column(at_text)], dtype=float)
                found = model.scores(values.reshape(-1, len(FEATURES)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), pa.array(found)], held)

    schema = T.StructType([*(T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)), T.StructField("score", T.DoubleType())])
    chosen = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), *whole)
    scored = chosen.mapInArrow(giving_back(compute), schema)
    return scored.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)),
        F.col("score").alias(names[0]),
        (F.col("score") >= threshold).cast("int").alias(names[1]),
    )


def held_out() -> F.Column:
    """Rows that are never learned from: crc32 of the doc_id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, row) of the labelled documents that are not held out. Of several labels of a doc_id, the toxic one
    holds; ``row`` is for sampling alone, see ``fit``."""
    own = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.filter(~held_out()).select("doc_id", "text")
    return texts.join(own, "doc_id").select("text", "toxic", F.col("doc_id").alias("row"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that a model learned from them and ``labels`` does not call toxic."""
    model = fit(training_rows(docs, labels))
    names = free_name(docs, "tox_score"), free_name(docs, "tox_predicted")
    return score(docs, model, threshold, names=names).filter(F.col(names[1]) == 0).drop(*names)
