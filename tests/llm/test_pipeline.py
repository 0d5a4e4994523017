import sys
from collections import defaultdict

import pytest
from brute import INSIDE, awkward, empty
from test_simhash import components, plain as fingerprint
from test_suffix_dedup import plain as cut

import corpus_pipeline
from tallyhouse.llm import decontamination, pieces
from tallyhouse.llm.common import read_table, write_through

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before each stage, and the last result."""
    docs = [read_table(spark, FOLDER, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(write_through(stage(spark, docs[-1], FOLDER), name))
    return docs


def test_stages(steps):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    assert all(d.columns == COLUMNS for d in steps[:5])


def test_toxic_documents_go(spark, steps):
    """A few dozen toxic labels teach less than the thousands of the larger tables (test_toxicity.py)."""
    labels = {r.doc_id: r.toxic for r in read_table(spark, FOLDER, "labels").collect()}
    before, after = ({r.doc_id for r in d.collect()} for d in steps[:2])
    toxic = {d for d, t in labels.items() if t and d in before}
    clean = {d for d, t in labels.items() if not t and d in before}
    assert after < before and len(toxic - after) > 0.7 * len(toxic) and len(clean - after) < 0.02 * len(clean)


def test_one_document_of_each_group(steps):
    rows = steps[1].collect()
    prints = {r.doc_id: fingerprint(r.text) for r in rows}
    distinct = sorted(set(prints.values()))
    roots = components([(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= 3], distinct)
    groups = defaultdict(list)
    for doc_id, p in prints.items():
        groups[roots[p]].append(doc_id)
    assert {r.doc_id for r in steps[2].collect()} == {min(g) for g in groups.values()}


def test_repeats_are_cut(steps):
    rows = {r.doc_id: r for r in steps[2].collect()}
    after = {r.doc_id: r for r in steps[3].collect()}
    assert set(after) == set(rows)
    for (doc_id, row), (size, removed, _, _) in zip(rows.items(), cut([r.text for r in rows.values()], 400)):
        left = after[doc_id]
        assert (left.text == row.text) == (removed == 0) and left.n_chars == len(left.text)
        assert 0 <= size - removed - len(left.text.encode()) <= 8 * (removed > 0)


def test_leaks_go(spark, steps):
    items = [decontamination.normalise(r.text) for r in read_table(spark, FOLDER, "benchmark").collect()]
    before, after = ({r.doc_id: decontamination.normalise(r.text) for r in d.collect()} for d in steps[3:5])
    verbatim = {d for d, t in before.items() if any(i in t for i in items)}
    gone = set(before) - set(after)
    assert verbatim and verbatim <= gone
    for d in gone - verbatim:
        assert any(decontamination.edit_match(i, before[d], int(len(i) * decontamination.MAX_EDITS)) for i in items)


def test_ids_decode_to_the_texts(spark, steps):
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    back = {r.doc_id: r.text for r in pieces.decode_documents(steps[5]).collect()}
    assert back == texts and steps[5].filter("not round_trip").count() == 0


def test_run_is_the_stages(spark, steps):
    names = ["doc_id", "n_tokens"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select(names).collect())) == sorted(
        map(tuple, steps[5].select(names).collect())
    )


@pytest.mark.parametrize("table", [awkward, empty])
def test_awkward_tables(spark, table):
    docs = table(spark)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        n = docs.count()
        docs = write_through(stage(spark, docs, FOLDER), name)
        assert docs.count() <= n and (docs.columns == columns or name == "sentencepiece")
        if name != "sentencepiece":  # columns that are not the stage's pass as they are
            assert all([r[c] for c in INSIDE] == INSIDE and r["a.b"] == [1, None] and r.nest[0] == 2 for r in docs.collect())
        if table is empty:
            assert docs.count() == 0
    if table is awkward:
        # one of the equal texts is left, with its smallest doc_id; the long copies went to one, which keeps its text
        assert {r.doc_id for r in docs.collect()} >= {1, 5, 7}


def test_entry_without_the_corpus(monkeypatch):
    """The entry point imports, and has its other queries, where the subpackage or the pipeline is not there."""
    import __spark_entry__ as entry

    everything = set(entry.queries())
    assert {"pipeline", "op1_toxicity"} <= everything
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "tallyhouse.llm.queries", None)
    left = set(entry.queries())
    assert left and not any(n == "pipeline" or n.startswith("op") and n[2].isdigit() for n in left)
