import numpy as np
import pytest

from tallyhouse.llm import neighbours
from tallyhouse.llm.common import read_table


def brute(rows, asked, k=5):
    """(query, rank, id) of every row that takes part against every other."""
    def sound(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and sound(v)]
    out = {}
    for q, v in good:
        if q not in asked:
            continue
        near = {}
        for i, w in good:
            if i != q and len(w) == len(v):
                score = float((w * v).sum() / (np.sqrt((w * w).sum()) * np.sqrt((v * v).sum())))
                near[i] = max(score, near.get(i, -2.0))
        out[q] = sorted(near.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int, score string")


def found_by(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (10, [3.0, 0.0]), (10, [3.0, 0.0]), (11, [-1.0, 0.0]),
    ]
    rows = table(spark, [(i, v, 1, "x") for i, v in vectors])
    found = found_by(neighbours.nearest_neighbours(rows, rows, share=1.0))
    expected = brute(vectors, {i for i, _ in vectors})
    assert {q: v for q, v in expected.items() if v} == found
    assert found[0][:2] == [(1, 1.0), (10, 1.0)] and 9 not in found


def test_very_large_and_very_small_vectors(spark):
    """Squares of 1e200 and 1e-200 are no numbers; the cosines are."""
    plain = np.random.default_rng(4).normal(size=(40, 6))
    sizes = np.array([1.0, 2.0**660, 2.0**-660])[np.arange(40) % 3]
    expected = brute(list(enumerate(plain.tolist())), set(range(40)))
    rows = table(spark, [(i, v, 1, "x") for i, v in enumerate((plain * sizes[:, None]).tolist())])
    found = found_by(neighbours.nearest_neighbours(rows, rows, share=1.0))
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
    assert np.allclose([s for v in found.values() for _, s in v], [s for q in found for _, s in expected[q]], rtol=1e-15, atol=1e-15)


def test_query_blocks_are_bounded(spark):
    rows = table(spark, [(i, [1.0] * (1 + i % 7), 1, "x") for i in range(500)])
    blocks = [(r.dims, np.frombuffer(r.q_ids, np.int64), r.q_vectors) for r in neighbours.query_blocks(rows, "vec_id", "embedding", 50).collect()]
    assert sorted(i for _, ids, _ in blocks for i in ids) == list(range(500))
    assert all(len(v) == 8 * dims * len(ids) and set(ids % 7) == {dims - 1} and len(ids) <= 50 for dims, ids, v in blocks)


def test_empty(spark):
    none, some = table(spark, []), table(spark, [(1, [1.0], 1, "x"), (2, [1.0], 1, "x")])
    assert neighbours.nearest_neighbours(none, none).collect() == []
    assert neighbours.nearest_neighbours(some, none).collect() == []
    assert neighbours.nearest_neighbours(none, some).collect() == []


def test_many_equal_vectors(spark):
    """A third of all rows is one vector: ties go to the smallest ids, over all blocks."""
    draw = np.random.default_rng(1)
    vectors = [(i, ([1.0] * 8 if i % 3 == 0 else draw.normal(size=8).tolist())) for i in range(900)]
    rows = table(spark, [(i, v, 1, "x") for i, v in vectors])
    asked = rows.filter("vec_id % 30 = 0")
    found = found_by(neighbours.nearest_neighbours(rows, asked, block_rows=100, query_rows=7))
    assert [i for i, _ in found[30]] == [0, 3, 6, 9, 12] and [i for i, _ in found[0]] == [3, 6, 9, 12, 15]


def test_the_whole_share_is_exact(spark):
    rows = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    plain = brute([(r.vec_id, r.embedding) for r in rows.collect()], set(range(0, 500, 50)))
    found = found_by(neighbours.nearest_neighbours(rows, rows.filter("vec_id % 50 = 0"), share=1.0, block_rows=120))
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in plain.items()}
    for q, own in found.items():
        assert [s for _, s in own] == pytest.approx([s for _, s in plain[q]], abs=1e-15)


def test_recall(spark):
    rows = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    plain = brute([(r.vec_id, r.embedding) for r in rows.collect()], set(range(0, 10**6, 50)))
    found = found_by(neighbours.nearest_neighbours(rows, rows.filter("vec_id % 50 = 0")))
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in own}) for q, own in plain.items())
    recall = hits / sum(len(own) for own in plain.values())
    print("recall", recall)
    assert recall >= 0.95


def test_prefix_ranges():
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(300, 16))
    strings = neighbours.hash_strings(vectors, 4, 12)
    order = np.argsort(strings, axis=1, kind="stable")
    forest = neighbours.Forest(np.arange(300), vectors, np.take_along_axis(strings, order, axis=1), order, 4, 12)
    lo, hi = forest.ranges(strings[:, :20])
    for q in range(20):
        for length in range(13):
            for tree in range(4):
                own = set(order[tree][lo[length, tree, q] : hi[length, tree, q]].tolist())
                assert own == {i for i in range(300) if int(strings[tree, i] ^ strings[tree, q]) >> (12 - length) == 0}
        rows = forest.candidates(lo[:, :, q], hi[:, :, q], 50)
        assert len(rows) >= 50 and q in rows


def test_queries_that_repeat_an_id(spark):
    """Of one query id with three vectors the smallest asks, however the rows are partitioned."""
    draw = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in draw.standard_normal(6)]) for i in range(1, 60)]
    asks = [(100, [0.5, -1.0, 0.0, 0.0, 1.0, 2.0]), (100, [-2.0, 1.0, 0.0, 3.0, 0.0, 0.5]), (100, [0.5, -1.5, 1.0, 0.0, 0.0, 0.0])]
    table, queries = (spark.createDataFrame(r, "vec_id long, embedding array<double>") for r in (rows, asks))
    query = np.array(asks[1][1])
    expected = sorted(((float(np.dot(query, v) / np.linalg.norm(query) / np.linalg.norm(v)), i) for i, v in rows), reverse=True)[:5]
    for parts in (1, 2, 3):
        found = neighbours.nearest_neighbours(table, queries.repartition(parts), k=5, share=1.0).orderBy("rank").collect()
        assert [r.vec_id for r in found] == [i for _, i in expected]


def test_an_id_with_many_vectors_counts_once(spark):
    """More vectors of one id lie nearest than neighbours are asked for: the others still come."""
    draw = np.random.default_rng(6)
    near = [(7, [1.0, 1e-3 * i, 0.0]) for i in range(40)] + [(8, [1.0, 0.0, 1e-3 * i]) for i in range(40)]
    vectors = [(0, [1.0, 0.0, 0.0]), *near, *[(i, draw.normal(size=3).tolist()) for i in range(20, 60)]]
    rows = table(spark, [(i, v, 1, "x") for i, v in vectors])
    found = found_by(neighbours.nearest_neighbours(rows, rows.filter("vec_id = 0"), share=1.0, block_rows=30))
    expected = brute(vectors, {0})
    assert [i for i, _ in found[0]] == [i for i, _ in expected[0]] and len(found[0]) == 5
    assert [s for _, s in found[0]] == pytest.approx([s for _, s in expected[0]], abs=1e-15)


def test_recall_beside_a_hot_group(spark):
    """Half of all rows are one vector: they are one entry, and the recall of the other queries stays."""
    rows = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    some = [(r.vec_id, [float(x) for x in r.embedding]) for r in rows.collect()]
    vectors = some + [(10**6 + i, some[3][1]) for i in range(len(some))]
    asked = {i for i, _ in some if i % 50 == 0}
    given = table(spark, [(i, v, 1, "x") for i, v in vectors])
    found = found_by(neighbours.nearest_neighbours(given, given.filter("vec_id % 50 = 0 and vec_id < 1000000")))
    plain = brute(vectors, asked)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in own}) for q, own in plain.items())
    assert hits >= 0.95 * sum(len(own) for own in plain.values())
    copies = neighbours.build_index(given)
    assert sum(len(r.counts) // 4 for r in copies.select("counts").collect()) == len({tuple(v) for _, v in some})
