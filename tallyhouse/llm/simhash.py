"""SimHash near-duplicates by the general pigeonhole principle.

64 bits are cut into partitions of bits that go together; a probe gives each partition its own threshold t, with
sum(t + 1) = distance + 1: two fingerprints within the distance then agree up to t in at least one partition (after
Qin et al., "GPH: similarity search in Hamming space", 2018). The thresholds are chosen for each fingerprint, by dynamic
programming over the candidates expected in each ball.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_labels, doc_hash, free_name, giving_back, write_through

BLOCK_BITS = 16
#: Fingerprints of one bucket that a task holds at once (8 bytes each); larger buckets are dealt to several tasks.
BUCKET_ROWS = 1 << 20
PAIRS_AT_ONCE = 1 << 21
SHINGLES_AT_ONCE = 1 << 16


def simhash(data: bytes, words: int = 3) -> int:
    """The fingerprint of one UTF-8 text; 0 without words."""
    from xxhash import xxh64_intdigest

    tokens = data.lower().split()  # bytes: A-Z, and ASCII white space
    if not tokens:
        return 0
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    k = min(words, len(tokens))
    line = b" ".join(tokens)
    n = len(tokens) - k + 1
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        to = min(n, at + SHINGLES_AT_ONCE)
        spans = zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist())
        hashes = np.array([xxh64_intdigest(line[s:e], 42) for s, e in spans], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, h (hash of the text), fp (the fingerprint's 64 bits as a long) for every row; a null text has no words."""

    def compute(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 1024):
                rows = batch.slice(part, 1024)
                texts = rows.column(2).cast(pa.binary())
                values = np.array([simhash(t.as_py() or b"", words) for t in texts], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(values.view(np.int64))], ["doc_id", "h", "fp"]
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_hash().alias("h"), F.col("text").cast("string"))
    return chosen.mapInArrow(giving_back(compute), "doc_id long, h long, fp long")


# ---- partitions, counts, thresholds ------------------------------------------------------------------------------


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and a 64 x 64 table of how many have both bits: 4,096 numbers for any input."""

    def count(batches):
        both, n = np.zeros((64, 64), dtype=np.float64), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64).astype(">u8")
            bits = np.unpackbits(values.view(np.uint8)).reshape(-1, 64).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([*range(4097)], pa.int32()), pa.array([*both.ravel().astype(np.int64), n], pa.int64())], ["at", "n"]
            )

    rows = prints.select("fp").mapInArrow(giving_back(count), "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(4097, dtype=np.int64)
    for row in rows:
        table[row["at"]] = row["n"]
    return int(table[-1]), table[:-1].reshape(64, 64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits (0 is the highest) in ``parts`` groups of nearly equal size: correlated bits go together."""
    share = both / max(1, n)
    one = np.diag(share)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    related = np.abs((share - np.outer(one, one)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = list(range(64)), []
    for size in [64 // parts + (i < 64 % parts) for i in range(parts)]:
        first = max(left, key=lambda b: related[b, left].max())
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(left, key=lambda b: related[b, group].mean())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def number_of_parts(n: int, distance: int) -> int:
    """The number of partitions that makes the fewest rows and comparisons, were the bits even."""

    def cost(parts):
        slack = distance + 1 - parts  # that many of the thresholds can be 1
        probes = parts + max(0, slack) * (64 // parts)
        return probes * (1 + n / 2.0 ** (64 / parts) / 16)

    return min(range(2, distance + 2), key=cost)


def pick_bits(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of uint64 values, side by side."""
    out = np.zeros(len(values), dtype=np.uint64)
    for bit in bits:
        out = (out << np.uint64(1)) | ((values >> np.uint64(63 - bit)) & np.uint64(1))
    return out


def blocks_of(group: list[int]) -> list[list[int]]:
    """A group of bits in blocks that are small enough to count every value."""
    n = -(-len(group) // BLOCK_BITS)
    size = -(-len(group) // n)
    return [group[i : i + size] for i in range(0, len(group), size)]


def block_counts(prints: DataFrame, groups: list[list[int]]) -> list[list[np.ndarray]]:
    """For every block, the fingerprints with each of its values: at most 2^16 numbers a block for any input."""
    blocks = [(g, b, bits) for g, group in enumerate(groups) for b, bits in enumerate(blocks_of(group))]

    def count(batches):
        tables = [np.zeros(1 << len(bits), dtype=np.int64) for *_, bits in blocks]
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for table, (*_, bits) in zip(tables, blocks):
                np.add.at(table, pick_bits(values, bits).astype(np.int64), 1)
        for i, table in enumerate(tables):
            at = np.flatnonzero(table)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(table[at])],
                    ["block", "value", "n"],
                )

    found = prints.select("fp").mapInArrow(giving_back(count), "block int, value int, n long")
    found = found.groupBy("block", "value").agg(F.sum("n").alias("n")).toArrow()
    tables = [np.zeros(1 << len(bits), dtype=np.int64) for *_, bits in blocks]
    block, value, n = (found.column(i).to_numpy() for i in range(3))
    for i, table in enumerate(tables):
        here = block == i
        table[value[here]] = n[here]
    out: list[list[np.ndarray]] = [[] for _ in groups]
    for (g, *_), table in zip(blocks, tables):
        out[g].append(table)
    return out


def shells(table: np.ndarray, distance: int) -> np.ndarray:
    """[t, value]: how many counted entries differ from value in exactly t bits."""
    out = np.zeros((distance + 1, len(table)), dtype=np.float64)
    out[0] = table
    at = np.arange(len(table))
    for bit in range(int(np.log2(len(table)))):
        flipped = out[:, at ^ (1 << bit)]
        out[1:] += flipped[:-1]
    return out


class Probing:
    """What a task needs to choose thresholds: bit groups and the counts' shells, of bounded size."""

    def __init__(self, groups, counts, total: int, distance: int):
        self.groups, self.distance = groups, distance
        self.blocks = [blocks_of(g) for g in groups]
        self.shells = [[shells(t, distance).astype(np.float32) for t in tables] for tables in counts]
        self.total = max(1, total)
        self.balls = [self._ball(len(g)) for g in groups]

    def _ball(self, bits: int) -> list[np.ndarray]:
        """Masks of exactly t bits, for each t."""
        return [
            np.array([sum(1 << i for i in c) for c in itertools.combinations(range(bits), t)], dtype=np.uint64)
            for t in range(self.distance + 1)
        ]

    def expected(self, values: np.ndarray) -> np.ndarray:
        """[group, t, row]: the candidates expected within t of each value in each group, blocks taken as independent."""
        out = np.zeros((len(self.groups), self.distance + 1, len(values)))
        for g, (blocks, tables) in enumerate(zip(self.blocks, self.shells)):
            exact = None
            for bits, table in zip(blocks, tables):
                own = table[:, pick_bits(values, bits).astype(np.int64)].astype(np.float64)
                if exact is None:
                    exact = own
                else:
                    joint = np.zeros_like(exact)
                    for t in range(self.distance + 1):
                        for a in range(t + 1):
                            joint[t] += exact[a] * own[t - a] / self.total
                    exact = joint
            out[g] = np.cumsum(exact, axis=0)
        return out

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """[group, row], -1 and up: the cheapest of all choices with sum(t + 1) = distance + 1, for each row."""
        found = self.expected(values)
        budget, rows = self.distance + 1, len(values)
        best = np.full((budget + 1, rows), np.inf)
        best[0] = 0
        choices = []
        for g in range(len(self.groups)):
            probes = np.cumsum([len(b) for b in self.balls[g]])
            now = np.full((budget + 1, rows), np.inf)
            chosen = np.zeros((budget + 1, rows), dtype=np.int8)
            for spent in range(budget + 1):
                for own in range(spent + 1):  # t + 1
                    cost = best[spent - own] + (0 if not own else probes[own - 1] + found[g, own - 1] / 16)
                    better = cost < now[spent]
                    now[spent] = np.where(better, cost, now[spent])
                    chosen[spent] = np.where(better, own, chosen[spent])
            best = now
            choices.append(chosen)
        out = np.zeros((len(self.groups), rows), dtype=np.int64)
        left = np.full(rows, budget)
        for g in reversed(range(len(self.groups))):
            own = choices[g][left, np.arange(rows)].astype(np.int64)
            out[g] = own - 1
            left = left - own
        return out

    def pieces(self, group: int, keys: np.ndarray) -> np.ndarray:
        """Into how many tasks a bucket is dealt: from a bound on its rows, its rarest block's count."""
        most, shift = None, len(self.groups[group])
        for bits, table in zip(self.blocks[group], self.shells[group]):
            shift -= len(bits)
            own = table[0][((keys >> np.uint64(shift)) & np.uint64((1 << len(bits)) - 1)).astype(np.int64)]
            most = own if most is None else np.minimum(most, own)
        return np.maximum(1, np.ceil(most / BUCKET_ROWS)).astype(np.int64)


def _mixed(values: np.ndarray) -> np.ndarray:
    x = values * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _probe_rows(probing: Probing):
    """fp -> (part, key, piece, probe, fp): a row for each partition as data, and a row for each probed value."""

    def made(g, keys, values, probe, pieces):
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, g, np.int32)),
                pa.array(keys.astype(np.int64)),
                pa.array(pieces.astype(np.int32)),
                pa.array(np.full(n, probe)),
                pa.array(values.view(np.int64)),
            ],
            ["part", "key", "piece", "probe", "fp"],
        )

    def rows(batches):
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 4096):
                values = every[at : at + 4096]
                chosen = probing.thresholds(values)
                for g, group in enumerate(probing.groups):
                    keys = pick_bits(values, group)
                    pieces = probing.pieces(g, keys)
                    yield made(g, keys, values, False, (_mixed(values) % pieces.astype(np.uint64)).astype(np.int64))
                    for t in range(probing.distance + 1):
                        here = chosen[g] >= t
                        if not here.any():
                            break
                        masks = probing.balls[g][t]
                        probed = (keys[here][:, None] ^ masks[None, :]).ravel()
                        who = np.repeat(values[here], len(masks))
                        pieces = probing.pieces(g, probed)
                        if pieces.max(initial=1) > 1:
                            first = np.cumsum(pieces) - pieces
                            place = np.arange(pieces.sum()) - np.repeat(first, pieces)
                            yield made(g, np.repeat(probed, pieces), np.repeat(who, pieces), True, place)
                        else:
                            yield made(g, probed, who, True, np.zeros(len(probed)))

    return rows


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links (a, b) connect, at most one a node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if (label[x] == label[y]).all() and (label[label] == label).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _verify(distance: int):
    """Rows sorted by (part, key, piece, probe): each probe meets its bucket's data; only a forest of the links leaves."""

    def links(held, probes):
        """held, probes: arrays of (bucket number, fp), both sorted by bucket."""
        lo = np.searchsorted(held[0], probes[0], "left")
        hi = np.searchsorted(held[0], probes[0], "right")
        n = hi - lo
        at = 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(np.cumsum(n[at:]), PAIRS_AT_ONCE)) + at)
            count = n[at:to]
            whole = int(count.sum())
            for part in range(0, max(1, whole), PAIRS_AT_ONCE):  # a single probe can meet a very large bucket
                place = np.arange(part, min(whole, part + PAIRS_AT_ONCE))
                first = np.cumsum(count) - count
                who = np.searchsorted(first + count, place, "right")
                a = probes[1][at:to][who]
                b = held[1][lo[at:to][who] + place - first[who]]
                near = (np.bitwise_count(a ^ b) <= distance) & (a != b)
                if near.any():
                    yield forest(a[near], b[near])
            at = to

    def run(batches):
        carry = (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        last, number = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            probe = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            values = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            new = np.r_[last is None or bool((key[:, 0] != last).any()), (key[:, 1:] != key[:, :-1]).any(axis=0)]
            bucket = number + np.cumsum(new)
            held = (np.r_[carry[0], bucket[~probe]], np.r_[carry[1], values[~probe]])
            for u, v in links(held, (bucket[probe], values[probe])):
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])
            last, number = key[:, -1], int(bucket[-1])
            keep = held[0] == number
            carry = (held[0][keep], held[1][keep])

    return run


def near_links(prints: DataFrame, distance: int = 3, parts: int | None = None) -> DataFrame:
    """Links (u, v) between distinct fingerprints: a forest of every pair within ``distance`` bits."""
    n, both = bit_counts(prints)
    groups = group_bits(n, both, parts or number_of_parts(n, distance))
    probing = Probing(groups, block_counts(prints, groups), n, distance)
    rows = prints.select("fp").mapInArrow(giving_back(_probe_rows(probing)), "part int, key long, piece int, probe boolean, fp long")
    bucket = ["part", "key", "piece"]
    dealt = rows.repartition(*bucket).sortWithinPartitions(*bucket, "probe")
    return dealt.mapInArrow(giving_back(_verify(distance)), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, parts: int | None = None) -> DataFrame:
    """doc_id, h, fp, fingerprint, component_id, root: a row for every row of ``docs``.

    Fingerprints within ``distance`` bits are linked; component_id is the smallest doc_id among all rows that links
    reach, and root the fingerprint that names the component. Equal fingerprints are one node, so copies add nothing to the comparison. Null and empty texts have
    fingerprint zero, which links like any other. Null doc_ids are kept and never are a component's id (it is null only
    if all of a component's are); repeated rows stay repeated. An empty table has no rows. Other columns are ignored.
    """
    prints = write_through(fingerprints(docs, words), "prints")
    nodes = write_through(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    labels = connected_labels(near_links(nodes, distance, parts))
    rooted = nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return prints.join(classes, "fp").select(
        "doc_id", "h", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def one_of_each(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: the smallest doc_id, of equals by its text.

    A row without a doc_id stays only if no row of its component has one; of rows that repeat doc_id and text one stays.
    """
    found = near_duplicates(docs, words, distance)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("one"))
    kept = first.select(F.col("one.doc_id").alias("k_doc_id"), F.col("one.h").alias("k_h"))
    own = free_name(docs, "own")
    keyed = docs.withColumn(own, doc_hash())
    same = keyed["doc_id"].cast("long").eqNullSafe(kept["k_doc_id"]) & (keyed[own] == kept["k_h"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
