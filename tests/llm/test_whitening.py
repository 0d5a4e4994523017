import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import whitening
from tallyhouse.llm.common import read_table
from tallyhouse.llm.queries import op12_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, place string, `a.b` string, whitened string, v int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, None, "p", "q", "w", 1) for i, v in vectors], SCHEMA)


def brute(rows, components=8):
    """{(vec_id, place in the table, component): row} by numpy's eigenvectors of the covariance, in integers where these are exact."""
    x = np.array([np.floor(1024 * np.array(v, dtype=np.float32).astype(float)) + 100000 for _, v in rows])
    n = len(x)
    sums = x.astype(np.int64).sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    white = centred @ vectors[:, order] / np.sqrt(values[order])
    off = [[n * int(a) - int(s) for a, s in zip(row, sums)] for row in x]
    return n, [sum(a * a for a in row) for row in off], white, values[order] / values.sum()


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_query_against_numpy(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = [(r.vec_id, r.embedding) for r in read_table(spark, path, "embeddings").collect()]
    found = op12_embedding_whitening(spark, path).collect()
    n, deviation, white, explained = brute(rows)
    at = {i: k for k, (i, _) in enumerate(rows)}
    assert len(found) == 8 * len(rows)
    signs = {}
    for r in found:
        k, c = at[r.vec_id], r.component - 1
        assert (r.n, r.deviation) == (n, deviation[k])
        sign = signs.setdefault(c, np.sign(r.whitened * white[k, c]))
        assert abs(r.whitened - sign * white[k, c]) < 1e-8
        assert abs(r.explained / explained[c] - 1) < 1e-9 and r.identity_error < 1e-9


def test_factor_and_rotations():
    draw = np.random.default_rng(3)
    for size, rank in [(1, 1), (5, 5), (17, 4), (64, 64)]:
        base = draw.normal(size=(size, rank)) * np.logspace(0, -4, rank)
        matrix = base @ base.T
        factor, order = whitening.pivoted_cholesky(matrix)
        assert np.allclose(factor @ factor.T, matrix[order][:, order], atol=1e-12)
        assert np.allclose(np.triu(factor, 1), 0) and np.all(np.diff(factor.diagonal()) <= 0)
        values, vectors = whitening.principal(matrix)
        expected = np.linalg.svd(base, compute_uv=False) ** 2  # squares of singular values are precise when small, too
        assert np.allclose(values[:rank], expected, rtol=1e-6) and np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), float(i % 5), 1.0]) for i in range(20)] + [(7, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0]), (None, [0.5, 0.25, 0.125])]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [inf, 1.0, 1.0]), (104, []), (105, [1.0, 2.0]), (106, [-inf] * 3)]
    vectors = table(spark, good + bad)
    for parts in (1, 7):
        model = whitening.fit(vectors.repartition(parts))
        done = whitening.transform(vectors.repartition(parts), model)
        assert done.columns == ["vec_id", "embedding", "label", "place", "a.b", "v", "deviation", "whitened"]
        n, deviation, white, explained = brute(good)
        rows = done.collect()
        assert model.n == n == len(rows) and sorted(r.deviation for r in rows) == sorted(deviation)
        assert np.allclose(model.explained(), explained[: len(model.components)])
        assert whitening.identity_error(done, model) < 1e-9
        assert np.allclose(sorted(abs(r.whitened[0]) for r in rows), sorted(abs(white[:, 0])))
    assert whitening.report(done, model).filter(F.col("component") == 3).count() == n


def test_tables_without_spread(spark):
    for vectors, n in [([], 0), ([(1, None)], 0), ([(1, [1.0, 2.0])], 1), ([(i, [1.0, 2.0]) for i in range(50)], 50)]:
        data = table(spark, vectors)
        model = whitening.fit(data)
        done = whitening.transform(data, model)
        assert model.n == n and len(model.components) == 0 and done.count() == n
        assert whitening.report(done, model).count() == 0


def test_extreme_entries(spark):
    """Sums and deviations stay exact beyond 64 bits; a deviation that a long does not hold is null."""
    data = table(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e12, 3.0]), (4, [0.0, 4.0])])
    model = whitening.fit(data)
    rows = whitening.transform(data, model).collect()
    assert model.n == 4 and all(r.deviation is None for r in rows) and all(np.isfinite(r.whitened).all() for r in rows)
    assert whitening.integers(np.array([-0.0001, 0.0, 0.9999 / 1024])).tolist() == [99999, 100000, 100000]
