import os

import numpy as np
import pytest
from brute import awkward, empty
from tokenizers import Tokenizer

from tallyhouse.llm import token_counts as t

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    """Another library with the same vocabulary, as the independent count."""
    made = Tokenizer.from_file(os.path.join(t.TOKENIZERS, "byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def spans_of(library, text):
    """Bytes of every token, from the byte-level pieces' lengths."""
    ends, at = [], 0
    for piece in library.encode(text, add_special_tokens=False).tokens:
        at += len(piece)  # a byte is one character of a byte-level piece
        ends.append(at)
    return list(zip([0, *ends], ends))


def plain(spans, sections, rule):
    counts = [0.0] * (len(sections) + 1)
    for start, end in spans:
        owners = []
        for byte in range(start, end):
            inside = [i for i, (s, e) in enumerate(sections) if s <= byte < e]
            owners.append(inside[-1] if inside else len(sections))
        if rule == "first":
            counts[owners[0]] += 1
        elif rule == "split":
            for o in owners:
                counts[o] += 1 / len(owners)
        else:
            counts[max(dict.fromkeys(owners), key=owners.count)] += 1
    return counts


@pytest.mark.parametrize("rule", t.RULES)
def test_lines(spark, library, rule):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    rows = t.count_by_section(docs, rule).collect()
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, {})[r.section] = r
    for doc in docs.collect():
        data = doc.text.encode()
        spans = spans_of(library, doc.text)
        assert spans[-1][1] == len(data)
        lines = doc.text.split("\n")
        lines = [line + "\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        ends = np.cumsum([len(x.encode()) for x in lines])
        expected = plain(spans, list(zip([0, *ends], ends)), rule)
        own = found[doc.doc_id]
        assert [own[i].n_tokens for i in range(len(lines))] == pytest.approx(expected[:-1])
        assert [doc.text[own[i].start : own[i].end] for i in range(len(lines))] == lines
        assert {r.doc_tokens for r in own.values()} == {len(spans)}


@pytest.mark.parametrize("rule", t.RULES)
def test_attribution(rule):
    draw = np.random.default_rng(4)
    for _ in range(200):
        ends = np.cumsum(draw.integers(1, 6, draw.integers(1, 12)))
        sections = draw.integers(0, ends[-1] + 1, (draw.integers(0, 5), 2))
        sections = np.array(sorted({tuple(sorted(s)) for s in sections.tolist() if s[0] != s[1]}), dtype=np.int64).reshape(-1, 2)
        if len(sections):  # later sections take over from earlier ones, which end there
            clipped = np.minimum(sections[:, 1], np.r_[sections[1:, 0], 1 << 40])
            expected = plain(list(zip([0, *ends], ends)), [*zip(sections[:, 0], clipped)], rule)
        else:
            expected = plain(list(zip([0, *ends], ends)), [], rule)
        assert t.attribute(ends, sections, rule) == pytest.approx(expected)


def test_given_sections(spark):
    docs = spark.createDataFrame(
        [(1, "Ünïted states of x", [(0, 3), (6, 100)]), (2, "abc", None), (3, "abc", [(None, 2), (5, 9)])],
        "doc_id long, text string, parts array<struct<start:int,end:int>>",
    )
    rows = t.count_by_section(docs, "split", "parts").collect()
    for i in (1, 2, 3):
        own = [r for r in rows if r.doc_id == i]
        assert sum(r.n_tokens for r in own) == pytest.approx(own[0].doc_tokens)
    assert [(r.section, r.start, r.end) for r in rows if r.doc_id == 1] == [(0, 0, 3), (1, 6, 18), (-1, None, None)]
    assert [r.section for r in rows if r.doc_id != 1] == [-1, -1]


def test_awkward(spark):
    docs = awkward(spark)
    rows = t.count_by_section(docs).collect()
    assert sum(1 for r in rows if r.doc_id == 4) == 3 and sum(1 for r in rows if r.doc_id == 1) == 1
    assert next(r for r in rows if r.doc_id == 1).doc_tokens == 0
    with pytest.raises(ValueError):
        t.count_by_section(docs, "last")


def test_empty(spark):
    assert t.count_by_section(empty(spark)).collect() == []
