import random

import numpy as np
import pytest
from brute import awkward, empty

from tallyhouse.llm import decontamination as d
from tallyhouse.llm.common import read_table

FOLDER = "/root/testdata/sf0.01"


def plain_distance(a, b):
    """Least edits from a to a substring of b, by the full table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(row[j] + (x != y), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


def test_edit_distance():
    draw = random.Random(1)
    for _ in range(150):
        a = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 30)))
        b = bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 60)))
        distance, end = d.edit_distance_in(a, b)
        assert distance == plain_distance(a, b) and plain_distance(a, b[:end]) == distance
        found = d.edit_match(a, b, len(a))
        assert found[0] == distance and plain_distance(a, b[found[1] : found[2]]) == distance


def test_distances_beyond_the_most():
    """Up to the most edits they are exact, beyond it only known to be beyond."""
    draw = random.Random(8)
    for _ in range(300):
        a = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 20)))
        b = bytes(draw.choice(b"abcde") for _ in range(draw.randint(0, 40)))
        most = draw.randint(0, 12)
        distance, end = d.edit_distance_in(a, b, most)
        plain = plain_distance(a, b)
        assert distance > most if plain > most else (distance, end) == d.edit_distance_in(a, b) and distance == plain


def items():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghiklmnoprstuvé") for _ in range(draw.randint(2, 9)))
    return [(i, d.normalise(" ".join(word() for _ in range(draw.randint(12, 60))))) for i in range(60)], word


def test_recall_of_edited_copies():
    """Copies with as many edits as are allowed, and with fewer, in other prose; and no match where there is none."""
    known, word = items()
    searcher = d.Searcher(known)
    draw = random.Random(9)
    for share, least in ((0.0, 1.0), (0.05, 0.99), (0.1, 0.97), (0.18, 0.9)):
        texts = []
        for i, text in known:
            prose = " ".join(word() for _ in range(80)).encode()
            texts.append(prose[:200] + b" " + d.edited(text, share, draw) + b" " + prose[200:])
        found = {(t, i) for t, i, *_ in searcher.matches(texts)}
        hit = sum((t, t) in found for t in range(len(known)))
        print(share, hit / len(known), len(searcher.sides[-1].walks))
        assert hit >= least * len(known) and all(t == i for t, i in found)
    clean = [" ".join(word() for _ in range(400)).encode() for _ in range(50)]
    assert searcher.matches(clean) == []


def test_items_inside_a_run_without_spaces():
    """Exact copies behind any number of other bytes, of texts without spaces and of single long words."""
    draw = random.Random(3)
    signs = "".join(chr(0x4E00 + draw.randrange(3000)) for _ in range(400))
    url = "https://example.org/" + "".join(draw.choice("abcdef0123456789/-") for _ in range(150))
    for item in (signs[:40], signs[40:60], signs[60:64], url, url[30:60], url[100:112], signs[300:340] + " " + url[:50], "alpha beta gamma delta", "a"):
        searcher = d.Searcher([(0, d.normalise(item))])
        for n in range(12):
            for before in (signs[100 : 100 + n], "x" * n, "some words " + "y" * n):
                found = searcher.matches([d.normalise(before + item + signs[200:210])])
                assert [m[2] for m in found] == [0], (item, before)


def test_recall_of_short_items_among_long_ones():
    """Fresh copies with the most edits, by length: many long items do not end the search for a few short ones."""
    _, word = items()
    draw = random.Random(6)
    long = [d.normalise(" ".join(word() for _ in range(60))) for _ in range(100)]
    short = [d.normalise(" ".join(word() for _ in range(40)))[:84].strip() for _ in range(20)]
    searcher = d.Searcher(list(enumerate(long + short)))
    for own in (range(100), range(100, 120)):
        copies = [(i, d.edited(searcher.texts[i], d.MAX_EDITS, draw)) for i in own for _ in range(400 // len(own))]
        found = {(t, i) for t, i, *_ in searcher.matches([b"before " + text + b" behind" for _, text in copies])}
        recall = sum((t, i) in found for t, (i, _) in enumerate(copies)) / len(copies)
        print(own, recall, [(s.steps, len(s.walks)) for s in searcher.sides])
        assert recall >= 0.92


def test_places():
    text = "  Ab\n\ncD  éf "
    norm = d.normalise(text).decode()
    for a in range(len(norm)):
        for b in range(a + 1, len(norm) + 1):
            if norm[a] != " " and norm[b - 1] != " ":
                s, e = d.places(text, len(norm[:a].encode()), len(norm[:b].encode()))
                assert d.normalise(text[s:e]).decode() == norm[a:b]


def test_awkward(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta " * 12), (2, None), (3, ""), (None, "two words"), (5, "a")], "item_id long, text string")
    docs = awkward(spark, [(30, "see: ALPHA  beta\ngamma delta " + "alpha beta gamma delta " * 11 + "end")])
    rows = d.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows if r.item_id == 1} == {(5, 1), (6, 1), (30, 1)}
    assert (4, None) in {(r.doc_id, r.item_id) for r in rows}
    hit = next(r for r in rows if r.doc_id == 30 and r.item_id == 1)
    assert hit.distance == 0 and hit.start == 5


def test_empty(spark):
    bench = read_table(spark, FOLDER, "benchmark")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.find_leaks(empty(spark), bench).collect() == []
    assert d.find_leaks(awkward(spark), none).collect() == []


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 2000])
def test_table(spark, block_bytes):
    """All verbatim passages of the table are found, and what is found is within the distance."""
    docs, bench = read_table(spark, FOLDER, "documents"), read_table(spark, FOLDER, "benchmark")
    texts = {r.doc_id: d.normalise(r.text or "") for r in docs.collect()}
    known = {r.item_id: d.normalise(r.text or "") for r in bench.collect()}
    rows = d.find_leaks(docs, bench, block_bytes=block_bytes).collect()
    verbatim = {(k, i) for k, t in texts.items() for i, item in known.items() if item in t}
    assert verbatim and verbatim <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        assert r.distance <= d.MAX_EDITS * len(known[r.item_id])
        assert (r.distance == 0) == ((r.doc_id, r.item_id) in verbatim)


def test_packed_walks_are_the_plain_ones():
    """Walks whose place and key are one number find what step by step walks find: with bytes that no item has, and
    where windows lie further apart than the place has bits for."""
    draw = random.Random(8)
    word = lambda letters: "".join(draw.choice(letters) for _ in range(draw.randint(1, 12)))
    items = [" ".join(word("abcde") for _ in range(n)).encode() for n in (4, 12, 12, 30, 60, 60)]
    searcher = d.Searcher(list(enumerate(items)))
    texts = [" ".join(word("abcdexyzé漢") for _ in range(80)).encode() + b" " + draw.choice(items)[:70] for _ in range(40)]
    texts[20:20] = [b""] * (1 << d._PLACE_BITS)
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    codes = d.step_codes(np.r_[data, np.zeros(d.STEPS, np.uint8)])
    found = set()
    for side in searcher.sides:
        starts = d.text_starts(d.word_places(data), side.steps)
        for walk, table in zip(side.walks, side.tables):
            owner, at, begin = searcher._hits(walk, table, codes, starts)
            found |= set(zip(owner.tolist(), np.searchsorted(ends, at, "right").tolist(), (begin >> 4).tolist()))
    assert found and set(map(tuple, searcher.candidates(data, ends).T.tolist())) == found
