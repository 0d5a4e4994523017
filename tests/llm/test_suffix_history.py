from collections import Counter

import pytest
from brute import awkward, empty
from test_suffix_dedup import corpus

from tallyhouse.llm import suffix_history


def plain(earlier, new, length):
    """(doc_id, text) -> the bytes of the new documents that lie in strings which start elsewhere, in either table."""
    seen = Counter(d[i : i + length] for _, t in earlier + new for d in [(t or "").encode()] for i in range(len(d) - length + 1))
    out = {}
    for doc_id, text in new:
        d = (text or "").encode()
        gone = {j for i in range(len(d) - length + 1) if seen[d[i : i + length]] > 1 for j in range(i, i + length)}
        if gone:
            out[doc_id, text] = gone
    return out


def covered(spans, docs):
    """The same of spans, by document."""
    texts = {(r.doc_id, r.h): r.text for r in docs.select("doc_id", suffix_history.doc_hash().alias("h"), "text").collect()}
    out = {}
    for r in spans.collect():
        out.setdefault((r.doc_id, texts[r.doc_id, r.h]), set()).update(range(r.start, r.end))
    return out


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_batches_of_several_sessions(spark, tmp_path):
    """Each batch against all before it; the tables are forgotten in between, as at the end of a session."""
    folder, earlier = str(tmp_path / "kept"), []
    whole = corpus(spark, 11, n=75).collect()
    for at in range(0, len(whole), 16):
        batch = spark.createDataFrame(whole[at : at + 16], "doc_id long, text string")
        spans = suffix_history.scan_batch(batch, folder)
        assert covered(spans, batch) == plain(earlier, rows_of(batch), 400)
        earlier += rows_of(batch)
        for table in [r["table"] for r in suffix_history._state(spark, folder) if r["table"]]:
            spark.sql(f"DROP TABLE {table}")  # the files stay: they lie outside the warehouse
    assert len([r for r in suffix_history._state(spark, folder) if r["table"]]) < 5


def test_a_scan_that_ended_early_is_done_again(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "kept")
    first, second = (corpus(spark, seed, n=15) for seed in (21, 21))
    suffix_history.scan_batch(first, folder)

    class Ended(Exception):
        pass

    def end(*_):
        raise Ended

    with monkeypatch.context() as patch:
        patch.setattr(suffix_history, "_repeated_windows", end)
        with pytest.raises(Ended):
            suffix_history.scan_batch(second, folder)
    spans = suffix_history.scan_batch(second, folder)
    assert covered(spans, second) == plain(rows_of(first), rows_of(second), 400)
    with pytest.raises(ValueError):
        suffix_history.scan_batch(second, folder, length=300)


def test_awkward_and_empty(spark, tmp_path):
    folder = str(tmp_path / "kept")
    assert suffix_history.scan_batch(empty(spark), folder).collect() == []
    docs = awkward(spark)
    assert covered(suffix_history.scan_batch(docs, folder), docs) == plain([], rows_of(docs), 400)
    assert covered(suffix_history.scan_batch(docs, folder), docs) == plain(rows_of(docs), rows_of(docs), 400)
