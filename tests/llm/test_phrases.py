import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import awkward, empty

from tallyhouse.llm import phrases, quotient


def plain(rows, least, share, first):
    """The phrases of (text, lang) rows, word by word."""
    counts, n = {}, Counter()
    for text, lang in rows:
        text, lang = re.sub("[A-Z]", lambda m: m.group().lower(), text or ""), "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
            words = [w for w in re.split(r"[ \t]", piece) if w]
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = lang, tuple(words[i : i + k])
                    counts[key] = counts.get(key, 0) + 1
    candidates = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    dropped = set()
    for (lang, w), f in candidates.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                inner = lang, w[i : i + size]
                if 100 * f >= share * candidates[inner]:
                    dropped.add(inner)
    found = {}
    for (lang, w), a in candidates.items():
        if (lang, w) in dropped:
            continue
        cuts = [(counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
        l, r = min(cuts, key=lambda c: 2_000_000 * a // (c[0] + c[1]))  # min() keeps the first of equal ones
        found.setdefault(lang, []).append((2_000_000 * a // (l + r), a, " ".join(w), l, r))
    out = []
    for lang, some in found.items():
        some.sort(key=lambda s: (-s[0], -s[1], s[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(some[:first])]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in df.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    return sorted(map(tuple, df.collect()))


def drawn(seed, count):
    draw = np.random.default_rng(seed)
    words = ["a", "b", "of the", "New York City", "É", "x-y", "漢字", "tab\there", "end.", "one, two", "nul\x00", "nb sp", "A B a b", "", "\n", "\x0b"]
    langs = ["en", "EN", None, "de", ""]
    return [(" ".join(words[i] for i in draw.zipf(1.4, draw.integers(0, 30)) % len(words)), langs[draw.integers(0, 5)]) for _ in range(count)]


@pytest.mark.parametrize("least, share, first, parts", [(3, 80, 2000, 1), (2, 50, 7, 5), (30, 101, 2000, 3)])
def test_against_brute_force(spark, monkeypatch, least, share, first, parts):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 300)
    monkeypatch.setattr(phrases, "HELD_BYTES", 500)
    rows = drawn(least, 400) + [(None, "en"), (None, None), ("hot phrase here now " * 3000, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    assert rows_of(phrases.collocations(docs, least, share, first)) == plain(rows, least, share, first)


@pytest.mark.parametrize("table", [awkward, empty])
def test_awkward_tables(spark, table):
    docs = table(spark, [(9, "an odd couple, an odd couple")]) if table is awkward else table(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    found = rows_of(phrases.collocations(docs, least=2))
    assert found == plain(rows, 2, 80, 2000) and (table is empty) == (not found)


def test_filled_in_pieces(spark, monkeypatch):
    """Entries that are given out often, and very few bits of the set of members: the same phrases."""
    rows = drawn(8, 300)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    grams = {}
    blocks = [phrases.words_of((t or "").encode())[0] for t, _ in rows]
    codes = np.concatenate(blocks) % 50
    for held in (5, 10_000):
        monkeypatch.setattr(phrases, "HELD_ENTRIES", held)
        for bits in (3, 16):
            layout = quotient.Layout(2, 6, 3)
            fill = phrases._filled(layout, None)
            batch = pa.RecordBatch.from_arrays([pa.array([phrases._written(codes[i : i + 40]) for i in range(0, len(codes), 40)], pa.binary())], ["codes"])
            out = sorted(((b.as_py(), f.as_py()) for r in fill([batch]) for b, f in zip(r.column(0), r.column(1))), key=lambda x: x[0])
            table = pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([f for _, f in out], pa.binary())], ["bucket", "filter"])
            found = sorted(tuple(g.values()) for r in phrases._merging(layout, 2, bits)([table]) for lists in r.column(1).to_pylist() for g in lists)
            grams[held, bits] = found
    assert len({str(g) for g in grams.values()}) == 1 and len(grams[5, 3]) > 5
    monkeypatch.setattr(phrases, "MEMBER_BITS", 1)
    assert rows_of(phrases.collocations(docs, 3)) == plain(rows, 3, 80, 2000)


@pytest.mark.parametrize("n, bits, buckets", [(2, 1, 9), (2, 17, 9), (3, 20, 12), (4, 32, 22), (3, 32, 9), (2, 32, 22), (4, 5, 3)])
def test_permutation_and_filters(n, bits, buckets):
    draw = np.random.default_rng(n * bits)
    layout = quotient.Layout(n, bits, buckets)
    ids = [draw.integers(0, 1 << bits, 3000) for _ in range(n)]
    halves = layout.packed(ids)
    moved = layout.permuted(*halves)
    assert all((a == b).all() for a, b in zip(layout.unpacked(*layout.restored(*moved)), ids))
    assert len(set(zip(*map(list, moved)))) == len(set(zip(*map(list, halves))))
    high, low, counts = quotient.summed(*moved)
    assert counts.sum() == 3000
    counts = counts * draw.choice([1, 254, 255, 256, 1 << 40], len(counts))
    place = layout.bucket(high)
    for b in np.unique(place):
        own = place == b
        data = quotient.encode(layout, high[own], low[own], counts[own])
        back = quotient.decode(layout, int(b), data)
        assert all((x == y).all() for x, y in zip(back, (high[own], low[own], counts[own])))
        held = quotient.Merged(layout, int(b))
        for _ in range(5):
            held.add(data)
        assert (held.merge()[2] == 5 * counts[own]).all()


def test_no_member_is_missed():
    layout = quotient.Layout(3, 20, 4)
    draw = np.random.default_rng(5)
    high, low = layout.permuted(*layout.packed([draw.integers(0, 1 << 20, 4000) for _ in range(3)]))
    for bits in (6, 12):
        place = layout.bucket(high)
        sets = [quotient.marked(high[place == b], low[place == b], bits) for b in range(16)]
        members = quotient.Members(layout, bits, np.frombuffer(b"".join(sets), np.uint8))
        assert members.holds(high, low).all()
    others = layout.permuted(*layout.packed([draw.integers(0, 1 << 20, 4000) for _ in range(3)]))
    assert members.holds(*others).mean() < 0.1
