"""Phrases whose words stand together more often than apart, by language: counting quotient filters over shards.

Texts are cut into blocks of one language. A block's distinct words meet the vocabulary in a join and come back as ids,
so that a frequent word is a row a block, not a row an occurrence, and no vocabulary is sent to a task. Then, for two,
three and four words in turn, every task fills filters (``quotient.py``) with the n-grams of its blocks whose parts are
frequent, and the filters of a bucket, an even part of all n-grams, are merged where the bucket lies. Which shorter n-grams are
frequent is known to the tasks by a bit set of bounded size, which may say "yes" too often, never "no": what is counted
in vain falls out by its exact count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quotient
from .common import giving_back, write_through

LONGEST = 4
#: What ends a piece, and what ends a word, besides.
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b"\t"
_TABLE = bytes.maketrans(PIECE_ENDS + WORD_ENDS, b"\n" * len(PIECE_ENDS) + b" " * len(WORD_ENDS))
#: Bytes of text of a block, and of the blocks that a task fills at once.
BLOCK_BYTES, HELD_BYTES = 2 << 20, 16 << 20
#: Entries that a task holds before they go to their buckets; occurrences a bucket, about; the fewest and most buckets (as bits).
HELD_ENTRIES, BUCKET_WORDS, BUCKET_BITS = 1_000_000, 1 << 21, (9, 22)
#: Bits of the set of frequent n-grams at most (as a power of two), beside 64 a bucket.
MEMBER_BITS = 26
#: Words of the vocabulary that are numbered in one group, about.
NUMBERED = 100_000
#: A part of one word meets so many copies of the vocabulary's row: a word may begin very many phrases.
SALT = 16


# ---- words as numbers -----------------------------------------------------------------------------------------------


def words_of(data: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes in order, distinct words, counts) of a text; 0 stands between pieces, k for the (k-1)-th distinct word."""
    line = data.lower().translate(_TABLE).replace(b"\n", b" \n ")  # bytes.lower() changes A-Z only
    coded = pc.split_pattern(pa.array([line], pa.large_binary()), " ").values.dictionary_encode()
    codes, known = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    special = [known.index(pa.scalar(s, pa.large_binary())).as_py() for s in (b"", b"\n")]
    new = np.zeros(len(known), dtype=np.int64)
    real = np.array([i for i in range(len(known)) if i not in special], dtype=np.int64)
    new[real] = np.arange(1, len(real) + 1)
    if special[0] >= 0:
        codes = codes[codes != special[0]]
    codes = new[codes]
    return _squeezed(codes), known.take(pa.array(real)), np.bincount(codes, minlength=len(real) + 1)[1:]


def _squeezed(codes: np.ndarray) -> np.ndarray:
    """Without the second and later ones of neighbouring zeros."""
    return codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))] if len(codes) else codes


def _written(codes: np.ndarray) -> bytes:
    import zstandard

    wide = int(codes.max(initial=0)) >= 1 << 16
    return bytes([wide]) + zstandard.ZstdCompressor(level=1).compress(codes.astype("<u4" if wide else "<u2").tobytes())


def _read(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), "<u4" if data[0] else "<u2").astype(np.int64)


def _blocks(batches):
    """(text, lang) -> a row for each block: its distinct words with counts, and its words in order as codes."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    base, made, total = TaskContext.get().partitionId() << 32, 0, 0

    def done(lang):
        nonlocal made, total
        codes, words, counts = words_of(b"\n".join(held.pop(lang)))
        total -= sizes.pop(lang)
        made += 1
        whole = np.array([0, len(words)], np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([base + made], pa.int64()), pa.array([lang]), pa.ListArray.from_arrays(whole, words.cast(pa.binary())),
             pa.ListArray.from_arrays(whole, pa.array(counts, pa.int64())), pa.array([_written(codes)], pa.binary())],
            ["block", "lang", "words", "counts", "codes"],
        )

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            text, lang = text.as_py(), lang.as_py()
            held.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text) + 1
            total += len(text) + 1
            if sizes[lang] >= BLOCK_BYTES:
                yield done(lang)
            elif total >= HELD_BYTES:
                yield done(max(sizes, key=sizes.get))
    for lang in list(held):
        yield done(lang)


def _window(part: str, *order):
    return Window.partitionBy(part).orderBy(*order)


def _numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, f) with ids from 1 without gaps, and how many there are."""
    groups = max(64, words.count() // NUMBERED)
    words = words.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(groups)).cast("int"))
    sizes = words.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    rows = sizes.orderBy("part").collect()  # a number for each 100,000 words
    ends = np.cumsum([r["n"] for r in rows])
    first = words.sparkSession.createDataFrame([(r["part"], int(e - r["n"])) for r, e in zip(rows, ends)], "part int, first long")
    place = F.row_number().over(_window("part", "lang", "word"))
    numbered = words.withColumn("place", place).join(first, "part")
    return write_through(numbered.select("lang", "word", "f", (F.col("first") + F.col("place")).alias("id")), "vocabulary"), int(ends[-1]) if rows else 0


def _recoded(batches):
    """(codes, array of (place, id)) -> codes of the vocabulary, 0 also for words outside it."""
    for batch in batches:
        for codes, found in zip(batch.column(0), batch.column(1)):
            codes, found = _read(codes.as_py()), found.values
            new = np.zeros(int(codes.max(initial=0)) + 1, dtype=np.int64)
            new[found.field(0).to_numpy() + 1] = found.field(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array([_written(_squeezed(new[codes]))], pa.binary())], ["codes"])


# ---- n-grams --------------------------------------------------------------------------------------------------------


def _grams(codes: np.ndarray, n: int, bits: int, members: quotient.Members | None, layout: quotient.Layout):
    """Permuted halves of the n-grams of a block without a 0 whose two (n-1)-grams may be frequent."""
    if len(codes) < n:
        return np.zeros(0, quotient.U), np.zeros(0, quotient.U)
    count = len(codes) - n + 1
    at = np.flatnonzero(np.logical_and.reduce([codes[k : count + k] != 0 for k in range(n)]))
    if members is not None and len(at):
        shorter = members.layout
        both = []
        for shift in (0, 1):
            both.append(members.holds(*shorter.permuted(*shorter.packed([codes[at + shift + k] for k in range(n - 1)]))))
        at = at[both[0] & both[1]]
    return layout.permuted(*layout.packed([codes[at + k] for k in range(n)]))


def _filled(layout: quotient.Layout, members: quotient.Members | None):
    def fill(batches):
        """Blocks -> filters, a row for each bucket and time that a task's entries are given out."""
        held, size = [], 0

        def given():
            high, low, counts = quotient.summed(*map(np.concatenate, zip(*held)))
            buckets, first = np.unique(layout.bucket(high), return_index=True)
            for b, start, end in zip(buckets.tolist(), first, np.append(first[1:], len(high))):
                yield b, quotient.encode(layout, high[start:end], low[start:end], counts[start:end])

        def rows():
            found = list(given())
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())], ["bucket", "filter"])

        for batch in batches:
            for codes in batch.column(0):
                found = quotient.summed(*_grams(_read(codes.as_py()), layout.n, layout.bits, members, layout))
                if len(found[0]):
                    held.append(found)
                    size += len(found[0])
                if size > HELD_ENTRIES:
                    held = [quotient.summed(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
                    if size > HELD_ENTRIES // 2:
                        yield rows()
                        held, size = [], 0
        if held:
            yield rows()

    return fill


def _merging(layout: quotient.Layout, least: int, bits: int):
    def merge(batches):
        """Sorted (bucket, filter) -> a row for each bucket: its frequent n-grams, and the bit set of these."""

        def done(held: quotient.Merged):
            high, low, counts = held.merge()
            often = counts >= least
            high, low, counts = high[often], low[often], counts[often]
            ids = layout.unpacked(*layout.restored(high, low))
            ids += [np.zeros(len(high), np.int64)] * (LONGEST - layout.n)
            grams = pa.StructArray.from_arrays([pa.array(x) for x in (*ids, counts)], [*(f"w{k + 1}" for k in range(LONGEST)), "f"])
            lists = pa.ListArray.from_arrays(np.array([0, len(high)], np.int32), grams)
            return pa.RecordBatch.from_arrays([pa.array([held.bucket], pa.int32()), lists, pa.array([quotient.marked(high, low, bits)], pa.binary())], ["bucket", "grams", "marks"])

        held = None
        for batch in batches:
            for bucket, data in zip(batch.column(0), batch.column(1)):
                if held is None or held.bucket != bucket.as_py():
                    if held is not None:
                        yield done(held)
                    held = quotient.Merged(layout, bucket.as_py())
                held.add(data.as_py())
        if held is not None:
            yield done(held)

    return merge


_FIELDS = ", ".join(f"w{k + 1}: bigint" for k in range(LONGEST))


def count_grams(codes: DataFrame, n: int, bits: int, bucket_bits: int, least: int, members: quotient.Members | None, mark_bits: int):
    """(w1..w4, f) of the n-grams that stand in ``codes`` ``least`` times, 0 for words that an n-gram has not; and members."""
    layout = quotient.Layout(n, bits, bucket_bits)
    filters = codes.mapInArrow(giving_back(_filled(layout, members)), "bucket int, filter binary")
    tasks = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = filters.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    merged = merged.mapInArrow(giving_back(_merging(layout, least, mark_bits)), f"bucket int, grams array<struct<{_FIELDS}, f: bigint>>, marks binary")
    merged = write_through(merged, f"grams{n}")
    found = None
    if n < LONGEST:
        data = np.zeros(1 << (bucket_bits + mark_bits - 3), dtype=np.uint8)
        size = 1 << (mark_bits - 3)
        for r in merged.select("bucket", "marks").collect():  # of bounded size together, see MEMBER_BITS
            data[r["bucket"] * size : (r["bucket"] + 1) * size] = np.frombuffer(r["marks"], np.uint8)
        found = quotient.Members(layout, mark_bits, data)
    return merged.select(F.explode("grams").alias("g")).select("g.*"), found


# ---- scores ---------------------------------------------------------------------------------------------------------


def _part(first: int, last: int, words: list[Column]) -> list[Column]:
    """The columns of an n-gram of ``words[first:last]``, filled with zeros."""
    return [*words[first:last], *[F.lit(0).cast("long")] * (LONGEST - last + first)]


def _tagged(tag: int, at: int, words: list[Column], first: int, last: int) -> Column:
    """A part of a candidate: a word (tag 0), or what is before (1) or behind (2) the cut after ``at`` words."""
    key = [c.alias(f"p{k + 1}") for k, c in enumerate(_part(first, last, words))]
    return F.struct(F.lit(tag).alias("tag"), F.lit(at).alias("at"), *key)


def _parts(n: int) -> Column:
    """All parts of a candidate of n words whose counts or words are needed; single words serve as parts, too."""
    words = [F.col(f"w{k + 1}") for k in range(n)]
    found = [_tagged(0, k, words, k, k + 1) for k in range(n)]
    for cut in range(1, n):
        found += [_tagged(1, cut, words, 0, cut)] * (cut > 1) + [_tagged(2, cut, words, cut, n)] * (n - cut > 1)
    return F.array(*found)


def _dominated(grams: DataFrame) -> DataFrame:
    """(w1..w4, over): for each phrase inside a longer candidate, the largest count of these."""
    inner = []
    for n in range(3, LONGEST + 1):
        words = [F.col(f"w{k + 1}") for k in range(n)]
        spans = [(a, a + size) for size in range(2, n) for a in range(n - size + 1)]
        keys = F.array(*(F.struct(*(c.alias(f"p{k + 1}") for k, c in enumerate(_part(a, b, words)))) for a, b in spans))
        inner.append(grams.filter(_length() == n).select(F.explode(keys).alias("p"), "f"))
    inner = inner[0].union(inner[1])
    return inner.groupBy(*(F.col(f"p.p{k + 1}").alias(f"w{k + 1}") for k in range(LONGEST))).agg(F.max("f").alias("over"))


def _count(tag: int, at: int) -> Column:
    return F.get(F.filter("parts", lambda p: (p["tag"] == tag) & (p["at"] == at)), F.lit(0))["f"]


def _length() -> Column:
    return sum((F.col(f"w{k + 1}") > 0).cast("int") for k in range(LONGEST))


def collocations(
    docs: DataFrame, least: int = 30, share: int = 80, first: int = 2000, scale: int = 2_000_000, nameless: str = "und"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language by score.

    Words, pieces, n, counts and candidates (2 to 4 words, ``least`` times) are those of whole texts; a null text has no
    words, a null lang is ``nameless``. Only ``text`` and ``lang`` are read. A cut after k words has l and r, the counts
    of both sides, and floor(scale * a / (l + r)); the lowest-scoring cut counts, of equal ones the first. Phrases inside a
    longer candidate with at least ``share`` percent of their count are dropped, whether that one is dropped or not. Order:
    score, then a, both falling, then the bytes of the phrase. A table without frequent phrases has no rows.
    """
    texts = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(nameless)).alias("lang")
    )
    blocks = write_through(texts.mapInArrow(giving_back(_blocks), "block long, lang string, words array<binary>, counts array<long>, codes binary"), "blocks")
    words = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    words = words.select("block", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    total = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)).alias("n"))
    often = words.groupBy("lang", "word").agg(F.sum("c").alias("f")).filter(F.col("f") >= least)
    vocabulary, known = _numbered(write_through(often, "words"))
    if known >= 1 << 32:
        raise OverflowError("four ids of a word are packed into 128 bits: at most 2^32 words can be frequent")
    bits = max(1, known.bit_length())
    found = words.join(vocabulary, ["lang", "word"]).groupBy("block").agg(F.collect_list(F.struct("place", "id")).alias("found"))
    # a block's distinct words are bounded by the block
    coded = blocks.select("block", "codes").join(found, "block").select("codes", "found").mapInArrow(giving_back(_recoded), "codes binary")
    coded = write_through(coded, "codes")
    occurrences = vocabulary.agg(F.sum("f")).first()[0] or 0
    fewest, most = BUCKET_BITS
    bucket_bits = min(most, max(fewest, (occurrences // BUCKET_WORDS).bit_length()))
    mark_bits = max(6, min(MEMBER_BITS, max(occurrences // 2, 1).bit_length()) - bucket_bits)
    members, grams = None, None
    for n in range(2, LONGEST + 1):
        counted, members = count_grams(coded, n, bits, bucket_bits, least, members, mark_bits)
        grams = counted if grams is None else grams.union(counted)
    return _ranked(write_through(grams, "grams"), vocabulary, total, share, first, scale)


def _ranked(grams: DataFrame, vocabulary: DataFrame, total: DataFrame, share: int, first: int, scale: int) -> DataFrame:
    key = [f"w{k + 1}" for k in range(LONGEST)]
    over = F.col("over").isNull() | (100 * F.col("over").cast("decimal(20,0)") < share * F.col("f").cast("decimal(20,0)"))
    kept = write_through(grams.join(_dominated(grams), key, "left").filter(over).select(*key, "f"), "kept")
    parts = None
    for n in range(2, LONGEST + 1):
        some = kept.filter(_length() == n).select(*key, F.col("f").alias("a"), F.explode(_parts(n)).alias("p"))
        parts = some if parts is None else parts.union(some)
    salt = F.when(F.col("p.p2") == 0, F.pmod(F.xxhash64(*key), F.lit(SALT))).otherwise(0).cast("int")
    parts = parts.select(*key, "a", F.col("p.tag").alias("tag"), F.col("p.at").alias("at"), *(f"p.p{k + 1}" for k in range(LONGEST)), salt.alias("salt"))
    zero = F.lit(0).cast("long")
    single = vocabulary.select(
        F.col("id").alias("p1"), *(zero.alias(f"p{k + 1}") for k in range(1, LONGEST)),
        "f", "lang", "word", F.explode(F.array(*(F.lit(i) for i in range(SALT)))).alias("salt"),
    )
    longer = grams.filter("w4 = 0").select(
        *(F.col(f"w{k + 1}").alias(f"p{k + 1}") for k in range(LONGEST)), "f", F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("binary").alias("word"), F.lit(0).alias("salt"),
    )
    met = parts.join(single.union(longer), [*(f"p{k + 1}" for k in range(LONGEST)), "salt"])
    found = met.groupBy(*key, "a").agg(F.max("lang").alias("lang"), F.collect_list(F.struct("tag", "at", "f", "word")).alias("parts"))
    size = F.size(F.filter("parts", lambda p: p["tag"] == 0))
    scored = []
    for k in range(1, LONGEST):
        left = _count(0, 0) if k == 1 else _count(1, k)
        right = F.coalesce(_count(2, k), _count(0, k))  # the last word is a part of tag 0
        twice = left.cast("decimal(20,0)") + right.cast("decimal(20,0)")
        score = F.call_function("div", F.col("a").cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)"), twice).cast("long")
        scored.append(F.when(size > k, F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))))
    best = F.array_min(F.filter(F.array(*scored), lambda c: c.isNotNull()))
    texts = F.transform(F.sort_array(F.transform(F.filter("parts", lambda p: p["tag"] == 0), lambda p: F.struct(p["at"], p["word"]))), lambda p: p["word"].cast("string"))
    rows = found.select("lang", F.array_join(texts, " ").alias("phrase"), "a", best.alias("b"))
    rows = rows.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score"))
    place = F.row_number().over(_window("lang", F.desc("score"), F.desc("a"), "phrase"))
    rows = rows.withColumn("rank", place).filter(F.col("rank") <= first).join(total, "lang")
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
