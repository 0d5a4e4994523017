"""Long repeated passages, by a logarithmic family of suffix arrays.

A suffix enters the array if it starts at an anchor (``suffixes.Anchors``): every window of ``length`` bytes has one,
and equal windows have the same. The arrays are ordered by the fingerprint of a suffix's first ``prefix`` bytes, the
anchor's: suffixes that share these are neighbours, which is what a scan for long matches needs of the order. A new
batch of documents gets its array, is merge-scanned against every level, and levels of equal rank merge into one of
the next, so that an entry is rewritten a logarithmic number of times. The arrays are bucketed tables in the shared folder:
scans and merges run bucket by bucket, without a shuffle.

A run is the successive windows of one anchor, its context the bytes that these cover. Anchors whose contexts all are
equal need nothing more. Where contexts differ, each distinct context is read once and its windows are compared.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root
from .common import doc_hash, giving_back, text_bytes, write_through
from .suffixes import PIECE_BYTES, Anchors

PREFIX = 100
BATCHES = 4
#: Contexts of one anchor that a task compares at once (under a kilobyte each); more are compared through a shuffle.
CONTEXTS_AT_ONCE = 4096
#: Texts are handled in steps of so many bytes.
_STEP = PIECE_BYTES - 4096
_N_BITS = 12


# ---- runs ----------------------------------------------------------------------------------------------------------


def suffix_entries(docs: DataFrame, length: int, prefix: int, batches: int) -> DataFrame:
    """doc_id, h, batch, a (fingerprint of the anchor), c (of the context), start, shape (windows and anchor's place)."""

    def compute(record_batches):
        from xxhash import xxh3_64_intdigest

        anchors = Anchors(length, prefix)

        def flush(held, owners):
            data = b"".join(held)
            ends = np.cumsum([len(x) for x in held])
            at, n, anchor = anchors.runs(np.frombuffer(data, np.uint8), ends)
            owner = np.searchsorted(ends, at, "right")
            starts = at - np.r_[0, ends[:-1]][owner]
            keys, contexts = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
            for j, (i, m, p) in enumerate(zip(at.tolist(), n.tolist(), anchor.tolist())):
                keys[j] = xxh3_64_intdigest(data[p : p + prefix])
                contexts[j] = xxh3_64_intdigest(data[i : i + m - 1 + length], p - i)
            ids = pa.array([owners[o][0] for o in owner], pa.int64())
            hashes = pa.array([owners[o][1] for o in owner], pa.int64())
            batch = pa.array([owners[o][2] for o in owner], pa.int32())
            start = starts + np.array([owners[o][3] for o in owner], dtype=np.int64)
            shape = (n << _N_BITS) | (anchor - at)
            columns = [ids, hashes, batch, keys.view(np.int64), contexts.view(np.int64), start, shape.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)

        names = ["doc_id", "h", "batch", "a", "c", "start", "shape"]
        held, owners, size = [], [], 0
        for rows in record_batches:
            for doc_id, h, batch, data in zip(*(rows.column(i) for i in range(4))):
                data = data.as_py()
                for at in range(0, max(0, len(data) - length + 1), _STEP):  # a piece holds the windows that start in it
                    piece = data[at : at + _STEP + length - 1]
                    if size + len(piece) > PIECE_BYTES:
                        yield flush(held, owners)
                        held, owners, size = [], [], 0
                    held.append(piece)
                    owners.append((doc_id.as_py(), h.as_py(), batch.as_py(), at))
                    size += len(piece)
        if held:
            yield flush(held, owners)

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        doc_hash().alias("h"),
        F.expr(f"int(pmod(xxhash64(doc_id), {batches}))").alias("batch"),
        text_bytes().alias("data"),
    ).filter(F.length("data") >= length)
    return chosen.mapInArrow(giving_back(compute), "doc_id long, h long, batch int, a long, c long, start long, shape int")


# ---- the family of arrays ------------------------------------------------------------------------------------------


class SuffixFamily:
    """Levels of suffix arrays: (a, lo, hi, n), one row an anchor: its least and greatest context, and its suffixes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, str] = {}
        self.name = f"suffixes_{uuid.uuid4().hex}"
        self.made = 0

    def _path(self, table: str) -> str:
        return f"{scratch_root(self.spark)}/{table}"

    def _save(self, array: DataFrame) -> str:
        self.made += 1
        table = f"{self.name}_{self.made}"
        writer = array.write.bucketBy(self.buckets, "a").sortBy("a").option("path", self._path(table))
        writer.saveAsTable(table)
        return table

    def _discard(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE {table}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(table))
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _joined(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select("a", *(F.col(x).alias(f"r_{x}") for x in ("lo", "hi", "n")))
        return left.hint("merge").join(right, "a", how).select(
            "a",
            F.least("lo", "r_lo").alias("lo"),
            F.greatest("hi", "r_hi").alias("hi"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("r_n", F.lit(0))).alias("n"),
        )

    def add(self, entries: DataFrame) -> DataFrame:
        """Give a batch its array and scan it: (a, lo, hi) of the anchors that it shares with itself or a level."""
        array = entries.groupBy("a").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("n"))
        new = self._save(array.repartition(self.buckets, "a"))
        found = self.spark.table(new).filter("n > 1").select("a", "lo", "hi")
        for level in self.levels.values():
            found = found.union(
                self._joined(self.spark.table(new), self.spark.table(level), "inner").select("a", "lo", "hi")
            )
        found = write_through(found, "matches")
        rank, merged, old = 0, self.spark.table(new), [new]
        while rank in self.levels:
            old.append(self.levels.pop(rank))
            merged = self._joined(merged, self.spark.table(old[-1]), "full")
            rank += 1
        if rank:
            self.levels[rank] = self._save(merged)
            for table in old:
                self._discard(table)
        else:
            self.levels[rank] = new
        return found

    def close(self) -> None:
        for table in self.levels.values():
            self._discard(table)
        self.levels = {}


# ---- anchors whose contexts differ ----------------------------------------------------------------------------------


def _contexts(length: int):
    """Texts with the runs wanted of them -> a row for each context, with its bytes."""

    def read(record_batches):
        names = ["a", "c", "pieces", "data"]
        for rows in record_batches:
            out: list[list] = [[], [], [], []]
            size = 0
            for row in range(rows.num_rows):
                data = rows.column(0)[row].as_py()
                for run in rows.column(1)[row].as_py():
                    end = run["start"] + (run["shape"] >> _N_BITS) - 1 + length
                    out[0].append(run["a"])
                    out[1].append(run["c"])
                    out[2].append(run["pieces"])
                    out[3].append(data[run["start"] : end])
                    size += end - run["start"]
                if size > 1 << 21:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, out[:2]), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())], names)
                    out, size = [[], [], [], []], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                names,
            )

    return read


def _compare(length: int):
    """Contexts sorted by anchor and piece -> the repeated windows of each as (a, c, lo, hi, w null).

    Of an anchor in several pieces, every window leaves as (a, c, lo, lo, w) instead.
    """
    names = ["a", "c", "lo", "hi", "w"]

    def made(a, c, lo, hi, w):
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(c, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), w], names
        )

    def settle(rows):
        from xxhash import xxh3_64_intdigest

        counts = np.array([len(r[4]) - length + 1 for r in rows])
        row = np.repeat(np.arange(len(rows)), counts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        hashes = (xxh3_64_intdigest(r[4][i : i + length]) for r, n in zip(rows, counts.tolist()) for i in range(n))
        window = np.fromiter(hashes, np.uint64, count=len(row))
        a = np.array([r[0] for r in rows], dtype=np.int64)[row]
        c = np.array([r[1] for r in rows], dtype=np.int64)[row]
        shared = np.array([r[3] > 1 for r in rows])[row]
        if shared.any():
            yield made(a[shared], c[shared], place[shared], place[shared], pa.array(window[shared].view(np.int64)))
        order = np.lexsort((window, a))
        same = (window[order][1:] == window[order][:-1]) & (a[order][1:] == a[order][:-1])
        repeated = np.zeros(len(row), dtype=bool)
        repeated[order[1:][same]] = repeated[order[:-1][same]] = True
        repeated &= ~shared
        first = repeated & ~np.r_[False, repeated[:-1] & (row[1:] == row[:-1])]
        last = repeated & ~np.r_[repeated[1:] & (row[1:] == row[:-1]), False]
        yield made(a[first], c[first], place[first], place[last], pa.nulls(int(first.sum()), pa.int64()))

    def run(record_batches):
        held, size = [], 0
        for batch in record_batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size > 1 << 18 and row[:2] != (held[-1][0], held[-1][2]):
                    yield from settle(held)
                    held, size = [], 0
                held.append((row[0], row[3], row[1], row[2], row[4]))
                size += len(row[4])
        if held:
            yield from settle(held)

    return run


def _repeated_windows(spark: SparkSession, mixed: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(a, c, lo, hi): the repeated windows lo to hi of each context of the anchors whose contexts differ."""
    contexts = write_through(
        mixed.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "h", "start", "shape")).alias("one")),
        "contexts",
    )
    # written, so that contexts meet the few anchors with very many of them by a plain exchange, which AQE can split
    pieces = contexts.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CONTEXTS_AT_ONCE).cast("int").alias("pieces")).filter("pieces > 1")
    wanted = (
        contexts.join(write_through(pieces, "pieces"), "a", "left")
        .withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        .select("one.doc_id", "one.h", F.struct("a", "c", "one.start", "one.shape", "pieces").alias("run"))
        .groupBy("doc_id", "h")
        .agg(F.collect_list("run").alias("runs"))  # of one document
    )
    one_text = texts.dropDuplicates(["doc_id", "h"])
    found = (
        one_text.join(wanted, one_text["doc_id"].eqNullSafe(wanted["doc_id"]) & (one_text["h"] == wanted["h"]))
        .select("data", "runs")
        .mapInArrow(giving_back(_contexts(length)), "a long, c long, pieces int, data binary")
    )
    dealt = found.select("a", F.expr("int(pmod(c, pieces))").alias("piece"), "pieces", "c", "data")
    dealt = dealt.repartition("a", "piece").sortWithinPartitions("a", "piece")
    compared = write_through(dealt.mapInArrow(giving_back(_compare(length)), "a long, c long, lo int, hi int, w long"), "compared")
    open_windows = compared.filter("w is not null")
    twice = open_windows.groupBy("a", "w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "w")
    whole = contexts.filter("n > 1").select("a", "c", F.lit(0).alias("lo"), F.col("one.shape").alias("hi"))
    return (
        compared.filter("w is null")
        .select("a", "c", "lo", "hi")
        .union(open_windows.join(twice, ["a", "w"]).select("a", "c", "lo", "hi"))
        .union(whole.withColumn("hi", F.shiftright("hi", _N_BITS) - 1))
    )


# ---- whole documents ------------------------------------------------------------------------------------------------


def _packed(record_batches):
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for rows in record_batches:
        for at in range(0, rows.num_rows, 512):
            part = rows.slice(at, 512)
            data = pa.array([pack(x.as_py()) for x in part.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), data], ["doc_id", "h", "data"])


def _unpacked(record_batches):
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for rows in record_batches:
        for at in range(0, rows.num_rows, 512):
            part = rows.slice(at, 512)
            data = pa.array([unpack(x.as_py()) for x in part.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), data], ["doc_id", "h", "data"])


def repeated_spans(docs: DataFrame, length: int = 400, batches: int = BATCHES, prefix: int = PREFIX) -> tuple[DataFrame, DataFrame]:
    """(spans, texts) of the documents with repeated bytes.

    spans: doc_id, h, spans (array of start and end, in bytes, unsorted and overlapping); texts: doc_id, h, data.
    """
    spark = docs.sparkSession
    entries = write_through(suffix_entries(docs, length, prefix, batches), "entries")
    family = SuffixFamily(spark)
    matches = None
    try:
        for batch in range(batches):
            found = family.add(entries.filter(F.col("batch") == batch).select("a", "c"))
            matches = found if matches is None else matches.union(found)
    finally:
        family.close()
    # written, so that the join reads two plain exchanges and an anchor with very many runs is split
    matches = write_through(matches.groupBy("a").agg((F.min("lo") != F.max("hi")).alias("mixed")), "shared")
    runs = write_through(entries.drop("batch").join(matches, "a"), "runs")
    owners = runs.select("doc_id", "h").distinct()
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_hash().alias("h"), text_bytes().alias("data"))
    keyed = keyed.filter(F.length("data") >= length).mapInArrow(giving_back(_packed), "doc_id long, h long, data binary")
    same = keyed["doc_id"].eqNullSafe(owners["doc_id"]) & (keyed["h"] == owners["h"])
    packed = write_through(keyed.join(owners, same, "left_semi"), "texts")
    texts = packed.mapInArrow(giving_back(_unpacked), "doc_id long, h long, data binary")
    windows = _repeated_windows(spark, runs.filter("mixed"), texts, length)
    n = F.shiftright("shape", _N_BITS)
    even = runs.filter("not mixed").select("doc_id", "h", "start", (F.col("start") + n - 1 + length).alias("end"))
    uneven = runs.filter("mixed").select("doc_id", "h", "a", "c", "start").join(windows, ["a", "c"])
    uneven = uneven.select(
        "doc_id", "h", (F.col("start") + F.col("lo")).alias("start"), (F.col("start") + F.col("hi") + length).alias("end")
    )
    spans = even.union(uneven).groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return spans, texts


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as maximal ones, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _cut(record_batches):
    import hashlib

    names = ["k_doc_id", "k_h", "removed", "spans", "kept"]
    for rows in record_batches:
        for at in range(0, rows.num_rows, 256):
            part = rows.slice(at, 256)
            out: list[list] = [[], [], []]
            for data, spans in zip(part.column(2), part.column(3)):
                data, cuts = data.as_py(), merged(spans.as_py())
                ends = [0, *(e for _, e in cuts)]
                out[2].append(b"".join(data[s:e] for s, e in zip(ends, [*(s for s, _ in cuts), len(data)])))
                out[0].append(sum(e - s for s, e in cuts))
                out[1].append(len(cuts))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                names,
            )


def without_repeats(docs: DataFrame, length: int = 400, batches: int = BATCHES) -> DataFrame:
    """k_doc_id, k_h, removed, spans, kept: a row for each document (doc_id and text) that loses bytes; kept is what stays.

    Each byte goes that lies in ``length`` bytes which also start anywhere else: in another row (an equal one too) or
    elsewhere in the same text. Texts are UTF-8 bytes; a null text has none, and texts shorter than ``length`` lose
    nothing. Strings are judged on the input. Null and repeated doc_ids are told apart by their text. What stays may
    begin or end within a character. An empty table has no rows; other columns are ignored, whatever their names.
    """
    spans, texts = repeated_spans(docs, length, batches)
    texts = texts.dropDuplicates(["doc_id", "h"])
    same = texts["doc_id"].eqNullSafe(spans["doc_id"]) & (texts["h"] == spans["h"])
    return (
        texts.join(spans, same)
        .select(texts["doc_id"], texts["h"], "data", "spans")
        .mapInArrow(giving_back(_cut), "k_doc_id long, k_h long, removed long, spans long, kept binary")
    )


def repeat_report(docs: DataFrame, length: int = 400, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``; see ``without_repeats``."""
    cut = write_through(
        without_repeats(docs, length, batches).select("k_doc_id", "k_h", "removed", "spans", F.sha2("kept", 256).alias("sha")),
        "cut",
    )
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        doc_hash().alias("h"),
        F.length(text_bytes()).cast("long").alias("n_bytes"),
        F.sha2(text_bytes(), 256).alias("whole"),
    )
    return every.join(cut, every["doc_id"].eqNullSafe(cut["k_doc_id"]) & (every["h"] == cut["k_h"]), "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", F.lit(0)).alias("n_removed"),
        F.coalesce("spans", F.lit(0)).alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )


def cut_texts(docs: DataFrame, length: int = 400, batches: int = BATCHES) -> DataFrame:
    """The rows of ``docs``, all columns, with the text that stays, and n_chars, if there, counted anew.

    A character that a cut divides goes whole. Rows without repeats keep their text as it is, a null too; a row that
    loses everything stays with an empty text.
    """
    def whole_characters(record_batches):
        for rows in record_batches:
            texts = pa.array([x.as_py().decode("utf-8", "ignore") for x in rows.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), texts], ["k_doc_id", "k_h", "k_text"])

    cut = without_repeats(docs, length, batches).select("k_doc_id", "k_h", "kept")
    cut = write_through(cut.mapInArrow(giving_back(whole_characters), "k_doc_id long, k_h long, k_text string"), "cut")
    same = docs["doc_id"].cast("long").eqNullSafe(cut["k_doc_id"]) & (doc_hash() == cut["k_h"])
    new = {"text": F.coalesce(cut["k_text"], docs["text"])}
    if "n_chars" in docs.columns:
        counted = F.length(cut["k_text"]).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(cut["k_h"].isNull(), docs["n_chars"]).otherwise(counted)
    # by frame, since a column of the documents may have any name
    return docs.join(cut, same, "left").select(*(new.get(c, docs[f"`{c}`"]).alias(c) for c in docs.columns))
