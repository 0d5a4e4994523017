"""Quality scores: attention-based multiple-instance learning, a document being a bag of its passages.

Every passage of a whole text is encoded by rates that need no word list (which kinds of signs follow each other, hashed
groups of three bytes, repeated words). A hidden layer, gated attention over the passages of a document and a
logistic score of the weighted passage representation are learned together, from labels of documents only. Training
takes a bounded sample of labelled rows, dealt to a few groups: each group trains from the same start, and the mean of
their weights starts the next round. Scoring takes all rows; a long text passes in chunks, with running sums of the attention.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, fields as parts_of

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, giving_back, text_bytes, write_through

#: Labelled rows that are trained on, but for chance: at most half of it from the rarer label, the rest from the other.
TRAIN_ROWS = 12_000
#: Rows and bytes of text of a training group, about; and steps that it takes in a round at least.
GROUP_ROWS, GROUP_BYTES, LEAST_STEPS = 1_500, 16 << 20, 60
THRESHOLD = 0.7
#: A passage is so many bytes, and goes on to the next space if one is that near.
PASSAGE, NEAR = 512, 64
#: Bytes and passages that a task holds as numbers at once.
CHUNK_BYTES, CHUNK_PASSAGES = 1 << 20, 2_048

#: Kinds of bytes: spaces, line ends, digits, capitals, small letters, bytes beyond ASCII, and kinds of other signs.
_KINDS = [b" \t", b"\n\r\x0b\x0c", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", bytes(range(128, 256)),
          b".,", b";:", b"!?", b"'\"`", b"()[]{}<>", b"-_~", b"#$%&*@^", b"|/\\", b"+="]
KIND = np.full(256, len(_KINDS), dtype=np.int64)
for _kind, _signs in enumerate(_KINDS):
    KIND[list(_signs)] = _kind
KINDS = len(_KINDS) + 1
HASHED = 128
FEATURES = KINDS * KINDS + HASHED + 4
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 1 << 64)


# ---- passages -------------------------------------------------------------------------------------------------------


def passage_ends(data: np.ndarray) -> np.ndarray:
    """Ends of the passages of one text: every PASSAGE bytes, or at the next space or line end where it is near.

    An end depends only on the bytes around it. The last passage is what is left; an empty text is one empty passage.
    """
    at = np.arange(PASSAGE, len(data), PASSAGE)
    if len(at):
        ahead = np.minimum(at[:, None] + np.arange(NEAR), len(data) - 1)
        space = KIND[data[ahead]] < 2
        at = at + np.where(space.any(axis=1), space.argmax(axis=1), 0)
    return np.append(at, len(data))


def encode_passages(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of features for each passage of ``data``, the passages being one behind the other and some perhaps empty."""
    n, sizes = len(ends), np.diff(ends, prepend=0)
    out = np.zeros((n, FEATURES), dtype=np.float32)
    if not len(data):
        return out
    own = np.repeat(np.arange(n), sizes)
    kind = KIND[data]
    pairs = np.flatnonzero(own[1:] == own[:-1])
    seen = np.bincount(own[pairs] * KINDS * KINDS + kind[pairs] * KINDS + kind[pairs + 1], minlength=n * KINDS * KINDS)
    out[:, : KINDS * KINDS] = np.sqrt(seen.reshape(n, -1) / np.maximum(sizes - 1, 1)[:, None])
    low = np.where(kind == 3, data + 32, data).astype(np.uint32)
    threes = pairs[:-1][np.diff(pairs) == 1]
    value = (low[threes] * 0x9E3779B1 ^ low[threes + 1] * 0x85EBCA77 ^ low[threes + 2] * 0xC2B2AE3D) * np.uint32(0x27D4EB2F)
    seen = np.bincount(own[threes] * HASHED + (value >> 25), minlength=n * HASHED)
    out[:, KINDS * KINDS : KINDS * KINDS + HASHED] = np.sqrt(seen.reshape(n, -1) / np.maximum(sizes - 2, 1)[:, None])
    out[:, -4:] = _word_rates(low, kind > 1, own, n)
    return out


def _word_rates(low: np.ndarray, inside: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """Distinct words among the words, words equal to the one before, mean length of words, presence of any."""
    edge = np.empty(len(low) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = own[1:] != own[:-1]
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    out = np.zeros((n, 4))
    if not len(starts):
        return out
    # a word's hash by sums of byte times power of its place, moved back to place 0
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(low), _ODD, dtype=np.uint64))
        back = np.cumprod(np.full(len(low), _BACK, dtype=np.uint64))
        sums = np.append(np.uint64(0), np.cumsum((low + np.uint64(1)) * power))
        words = (sums[ends] - sums[starts]) * back[starts]
        place = own[starts]
        keyed = (words ^ (words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + place.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    count = np.bincount(place, minlength=n)
    distinct = np.bincount(place[np.unique(keyed, return_index=True)[1]], minlength=n)
    again = np.flatnonzero((words[1:] == words[:-1]) & (place[1:] == place[:-1]))
    some = np.maximum(count, 1)
    out[:, 0], out[:, 1] = distinct / some, np.bincount(place[again], minlength=n) / some
    out[:, 2] = np.minimum(np.bincount(place, weights=ends - starts, minlength=n) / some / 20, 2)
    out[:, 3] = count > 0
    return out


def chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, place of the text in the list) of all passages in order; a long text goes over several chunks."""
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = count = 0

    def done():
        data = np.concatenate([d for _, d, _ in held])
        shift = np.cumsum([0, *(len(d) for _, d, _ in held)])
        ends = np.concatenate([e + s for (_, _, e), s in zip(held, shift)])
        return encode_passages(data, ends), np.repeat([i for i, _, _ in held], [len(e) for _, _, e in held])

    for i, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        ends = passage_ends(data)
        start = 0
        for at in range(0, len(ends), CHUNK_PASSAGES):
            some = ends[at : at + CHUNK_PASSAGES]
            held.append((i, data[start : some[-1]], some - start))
            size, count, start = size + int(some[-1]) - start, count + len(some), some[-1]
            if size >= CHUNK_BYTES or count >= CHUNK_PASSAGES:
                yield done()
                held, size, count = [], 0, 0
    if held:
        yield done()


# ---- model ----------------------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Weights:
    """The hidden layer of a passage (hidden), the two halves of the gated attention (look, gate, pick), the score (out)."""

    hidden: np.ndarray
    hidden0: np.ndarray
    look: np.ndarray
    gate: np.ndarray
    pick: np.ndarray
    out: np.ndarray
    out0: np.ndarray

    @staticmethod
    def drawn(seed: int, hidden: int = 24, attention: int = 12) -> "Weights":
        draw = np.random.default_rng(seed)
        scale = [(FEATURES, hidden, 0.3), (hidden, attention, 0.4), (hidden, attention, 0.4)]
        first, look, gate = (draw.normal(0, s, (a, b)) for a, b, s in scale)
        return Weights(first, np.zeros(hidden), look, gate, draw.normal(0, 0.3, attention), draw.normal(0, 0.3, hidden), np.zeros(1))

    def values(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in parts_of(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.values()])

    def filled(self, flat: np.ndarray) -> "Weights":
        cuts = np.cumsum([v.size for v in self.values()])[:-1]
        return Weights(*(part.reshape(v.shape) for part, v in zip(np.split(flat, cuts), self.values())))

    def encoded(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Representation of each passage, its attention before the softmax, and the two halves of that."""
        h = np.tanh(features @ self.hidden + self.hidden0)
        look, gate = np.tanh(h @ self.look), _sigmoid(h @ self.gate)
        return h, (look * gate) @ self.pick, look, gate

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """0 to 1 for each whole text, by sums that run over its chunks."""
        top, total = np.full(len(texts), -np.inf), np.zeros(len(texts))
        mixed = np.zeros((len(texts), self.hidden.shape[1]))
        for features, own in chunks(texts):
            h, e, _, _ = self.encoded(features)
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            docs = own[starts]
            most = np.maximum(top[docs], np.maximum.reduceat(e, starts))
            share = np.exp(e - np.repeat(most, np.diff(np.append(starts, len(own)))))
            fade = np.exp(top[docs] - most)
            total[docs] = total[docs] * fade + np.add.reduceat(share, starts)
            mixed[docs] = mixed[docs] * fade[:, None] + np.add.reduceat(share[:, None] * h, starts)
            top[docs] = most
        return _sigmoid((mixed / total[:, None]) @ self.out + self.out0[0])

    def gradient(self, features: np.ndarray, starts: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss and its gradient, over documents whose passages begin at ``starts``."""
        h, e, look, gate = self.encoded(features)
        own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(features))))
        share = np.exp(e - np.maximum.reduceat(e, starts)[own])
        share /= np.add.reduceat(share, starts)[own]
        bag = np.add.reduceat(share[:, None] * h, starts)
        p = _sigmoid(bag @ self.out + self.out0[0])
        loss = -float((weights * np.log(np.where(labels == 1, p, 1 - p) + 1e-12)).sum() / weights.sum())
        d_out = weights * (p - labels) / weights.sum()
        d_bag = d_out[:, None] * self.out
        d_share = (d_bag[own] * h).sum(axis=1)
        d_e = share * (d_share - np.add.reduceat(share * d_share, starts)[own])
        d_both = d_e[:, None] * self.pick
        d_look, d_gate = d_both * gate * (1 - look * look), d_both * look * gate * (1 - gate)
        d_h = share[:, None] * d_bag[own] + d_look @ self.look.T + d_gate @ self.gate.T
        d_first = d_h * (1 - h * h)
        found = [features.T @ d_first, d_first.sum(axis=0), h.T @ d_look, h.T @ d_gate, (look * gate).T @ d_e, bag.T @ d_out, [d_out.sum()]]
        return loss, np.concatenate([np.ravel(f) for f in found])


def _descend(start: Weights, features, sizes, labels, weights, seed: int, epochs: int, rate: float, shrink: float) -> Weights:
    """Adam over small lots of documents, drawn without regard to the order of the rows."""
    ends = np.cumsum(sizes)
    flat = start.flat()
    mean, square, step = np.zeros_like(flat), np.zeros_like(flat), 0
    draw = np.random.default_rng(seed)
    lots = max(1, len(sizes) // 64)
    for _ in range(max(epochs, -(-LEAST_STEPS // lots))):
        for lot in np.array_split(draw.permutation(len(sizes)), lots):
            rows = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in lot])
            starts = np.cumsum(sizes[lot]) - sizes[lot]
            _, slope = start.filled(flat).gradient(features[rows], starts, labels[lot], weights[lot])
            slope += shrink * flat
            step += 1
            mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
            flat = flat - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return start.filled(flat)


@dataclass
class QualityModel:
    """Learned weights; without any (one label only) the share of label 1 among the rows, which is then every score."""

    weights: Weights | None
    share: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """To nine digits, so that equal texts score alike whatever texts stand beside them."""
        return np.full(len(texts), self.share) if self.weights is None else np.round(self.weights.scores(texts), 9)


def _place(row: str, seed: int) -> Column:
    """A number from 0 to 1 for a text (bytes) and its row."""
    return F.pmod(F.xxhash64("text", row, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def _sampled(labelled: DataFrame, place: Column) -> tuple[DataFrame, dict[int, int], int]:
    """Rows (quality, size, and others) whose ``place`` is below the share of their label, with a column ``weight`` that
    makes up for what a label lost; counts by label of all rows; bytes of the sample, about."""
    known = labelled.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()
    known = {r["quality"]: (r["n"], r["bytes"]) for r in known}
    left, chosen, size = TRAIN_ROWS, F.lit(0.0), 0
    for turn, label in enumerate(sorted(known, key=known.get)):  # the rarer label first
        n, weight = known[label]
        share = min(1.0, (left // 2 if turn == 0 and len(known) > 1 else left) / n)
        left, size = left - int(share * n), size + int(share * weight)
        chosen = F.when(F.col("quality") == label, F.lit(share)).otherwise(chosen)
    return labelled.withColumn("weight", F.try_divide(F.lit(1.0), chosen)).filter(place < chosen), {label: n for label, (n, _) in known.items()}, size


def fit(labelled: DataFrame, rounds: int = 5, epochs: int = 4, rate: float = 0.005, shrink: float = 1e-4, seed: int = 11) -> QualityModel:
    """From (text, quality 0 or 1); rows with another label are left out, a null text is an empty one.

    A column ``row``, if there, tells copies of a text apart when rows are sampled, and a column ``weight`` says how many
    rows a row stands for; neither is learned from. A document of more than CHUNK_PASSAGES passages is trained on as several bags with its label, which share its weight. With rows of
    one label only there is nothing to tell apart: the model is then constant, and a warning says so.
    """
    row = F.col("row").cast("string") if "row" in labelled.columns else F.lit("")
    own = F.col("weight").cast("double") if "weight" in labelled.columns else F.lit(1.0)
    labelled = labelled.select(text_bytes().alias("text"), F.col("quality").cast("int").alias("quality"), row.alias("row"), own.alias("own"))
    labelled = labelled.withColumn("size", F.length("text")).filter(F.col("quality").isin(0, 1))
    sample, n, size = _sampled(labelled, _place("row", seed))
    known = n.get(0, 0) + n.get(1, 0)
    if not n.get(0) or not n.get(1):
        warnings.warn(f"{known} labelled rows of one label: every quality score will be the same", stacklevel=2)
        return QualityModel(None, (n.get(1, 0) + 1) / (known + 2))
    groups = 1 + max(min(known, TRAIN_ROWS) // GROUP_ROWS, size // GROUP_BYTES)
    sample = sample.select(F.xxhash64("text", "row", F.lit(seed + 1)).alias("place"), "quality", F.col("weight") * F.col("own"), "text")

    def encode(batches):
        """A row for each bag: a document, or CHUNK_PASSAGES passages of a longer one."""
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                places, labels, weights, texts = (c.to_pylist() for c in batch.slice(at, 128).columns)
                bags = [1 + max(len(t) - 1, 0) // (PASSAGE * CHUNK_PASSAGES) for t in texts]
                met = [0] * len(texts)
                for features, own in chunks(texts):
                    starts = np.flatnonzero(np.diff(own, prepend=-1))
                    rows = []
                    for i, some in zip(own[starts].tolist(), np.split(features, starts[1:])):
                        rows.append(((places[i] + met[i]) % groups, places[i], met[i], labels[i], weights[i] / bags[i], some.astype(np.float16).tobytes()))
                        met[i] += 1
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.binary()]
    names = ["part", "place", "bag", "quality", "weight", "features"]
    encoded = sample.mapInArrow(giving_back(encode), "part int, place long, bag int, quality int, weight double, features binary")
    encoded = write_through(encoded, "passages")
    start = Weights.drawn(seed)

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("bag", "ascending"), ("quality", "ascending")])
        bags = [np.frombuffer(f.as_py(), np.float16).reshape(-1, FEATURES) for f in table["features"]]
        features = np.concatenate(bags).astype(np.float32)
        sizes, labels = np.array([len(b) for b in bags]), table["quality"].to_numpy().astype(float)
        done = _descend(start, features, sizes, labels, table["weight"].to_numpy(), seed + turn, epochs, rate, shrink)
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "n": [len(bags)], "flat": pa.array([done.flat().tolist()])})

    for turn in range(rounds):
        # a group is a bounded part of the sample; the weights, not the rows, come to the driver
        found = encoded.groupBy("part").applyInArrow(train, "part int, n long, flat array<double>").orderBy("part").collect()
        mean = sum(r["n"] * np.array(r["flat"]) for r in found) / sum(r["n"] for r in found)
        start = start.filled(mean)
    return QualityModel(start, n[1] / known)


def score(
    docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, kept: list[str] | None = None,
    names: tuple[str, str] = ("quality_score", "quality_predicted"),
) -> DataFrame:
    """The columns ``kept`` (all by default) with quality_score (0 to 1) and quality_predicted (1 from ``threshold`` on).

    One row for each row; only ``text`` is read. Null and empty texts have the score of one empty passage. ``names``
    gives the new columns other names; a kept column that has one of them gives way. An empty table has no rows.
    """
    new = {n.lower() for n in names}
    kept = [c for c in (docs.columns if kept is None else kept) if c.lower() not in new]
    held = [f"c{i}" for i in range(len(kept))]

    def compute(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = model.scores(some.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays([*(some.column(i) for i in range(len(kept))), pa.array(found)], [*held, "score"])

    schema = T.StructType([*(T.StructField(h, docs.schema[c].dataType) for h, c in zip(held, kept)), T.StructField("score", T.DoubleType())])
    chosen = docs.select(*(F.col(f"`{c}`").alias(h) for h, c in zip(held, kept)), text_bytes().alias("whole"))
    return chosen.mapInArrow(giving_back(compute), schema).select(
        *(F.col(h).alias(c) for h, c in zip(held, kept)),
        F.col("score").alias(names[0]),
        (F.col("score") >= threshold).cast("int").alias(names[1]),
    )


def held_out() -> Column:
    """Rows that are never learned from: crc32 of the doc_id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, seed: int = 5) -> DataFrame:
    """(text, quality, row, weight): a sample, bounded by TRAIN_ROWS, of the labelled documents that are not held out.

    Of several labels of a doc_id the lower holds. Rows are chosen without their texts, which then meet the chosen rows:
    that table is bounded, so it goes to the texts and no text is shuffled.
    """
    own = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    texts = docs.filter(~held_out()).select("doc_id", text_bytes().alias("text"))
    texts = texts.withColumn("place", _place("doc_id", seed))
    keys = texts.select("doc_id", "place", F.length("text").alias("size")).join(own.filter("quality in (0, 1)"), "doc_id")
    keys = write_through(keys, "labelled")
    chosen, _, _ = _sampled(keys, F.col("place"))
    chosen = chosen.select("doc_id", "place", "quality", "weight").distinct()
    rows = texts.join(F.broadcast(chosen), ["doc_id", "place"])
    return write_through(rows.select(F.col("text").cast("string").alias("text"), "quality", F.col("doc_id").alias("row"), "weight"), "sample")


def without_poor(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score by a model learned from them and ``labels`` reaches ``threshold``."""
    names = free_name(docs, "quality_score"), free_name(docs, "quality_predicted")
    return score(docs, fit(training_rows(docs, labels)), threshold, names=names).filter(F.col(names[1]) == 1).drop(*names)
