"""Whitening against exact arithmetic and a library's eigenvectors."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from starmill.llm import whitening
from starmill.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, n string, component string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def whole(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]


def check(got, vectors, most=8):
    """``vectors``: (vec_id, embedding) that are left; ids may repeat."""
    x = [whole(v) for _, v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x, strict=True)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums, strict=True)] for row in x])
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    count = min(most, d, int((values > 1e-9 * values[0]).sum()))
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    assert sorted(by) == list(range(1, count + 1)) and len(got) == n * count
    deviation = sorted((i, sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))) for (i, _), row in zip(vectors, x, strict=True))
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() <= 1e-8
    for k in range(count):
        rows = by[k + 1]
        assert {r.n for r in rows} == {n}
        assert sorted((r.vec_id, r.deviation) for r in rows) == deviation
        assert rows[0].explained == pytest.approx(values[k] / cov.trace(), rel=1e-9)
        want = [(i, z) for (i, _), z in zip(vectors, centred @ vecs[:, k] / math.sqrt(values[k]), strict=True)]
        found = sorted((r.vec_id, r.whitened) for r in rows)
        near = lambda sign: np.allclose([v for _, v in found], [v for _, v in sorted((i, sign * z) for i, z in want)], atol=1e-7)
        assert near(1) or near(-1)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    got = QUERIES["op13_whitening"](spark, f"/root/testdata/{sf}")
    assert got.columns == COLUMNS
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    check(got.collect(), vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, (rng.normal(size=5) * [5, 3, 2, 1, 0.3]).tolist()) for i in range(60)]
    good += [(None, [1.0, 2.0, 3.0, 4.0, 5.0]), good[0], good[0], (7, [0.0] * 5)]
    bad = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [math.nan] * 5), (204, [1, 2, math.inf, 4, 5]), (205, [1, 2, -math.inf, 4, 5]), (206, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in good + [(i, v and [None if c is None else float(c) for c in v]) for i, v in bad]], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    ids = sorted({r.vec_id for r in got if r.vec_id is not None})
    assert ids == list(range(60)) and len(got) == len(good) * 5 and {r.n for r in got} == {len(good)}
    named = spark.createDataFrame([(1000 + k, v, "x", "y") for k, (_, v) in enumerate(good)], SCHEMA).repartition(4)
    check(whitening.whiten(named).collect(), [(1000 + k, v) for k, (_, v) in enumerate(good)])
    # nothing to whiten: no rows, one row, equal rows
    for few in (df.limit(0), df.where("vec_id = 200"), df.where("vec_id = 3"), df.where("vec_id = 0")):
        assert whitening.whiten(few).collect() == [] and whitening.whiten(few).columns == COLUMNS


def test_dimensions_without_variance_and_in_step(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 2))
    rows = [(i, [float(a), 1.0, float(np.float32(a)), float(b), 0.0], "", "") for i, (a, b) in enumerate(base)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, [(i, v) for i, v, _, _ in rows])


def test_huge_entries_do_not_overflow(spark):
    rows = [(i, [float(i), 3e38 if i % 2 else -3e38], "", "") for i in range(10)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.deviation for r in got} == {None} and {r.n for r in got} == {10} and all(abs(abs(r.whitened) - 1) < 1e-9 for r in got if r.component == 1)


def test_factor_and_rotations():
    rng = np.random.default_rng(7)
    for d, r in ((1, 1), (6, 6), (12, 5), (64, 64)):
        g = rng.normal(size=(d, r)) * 10.0 ** rng.uniform(-3, 3, size=r)
        a = g @ g.T
        factor = whitening.pivoted_cholesky(a)
        assert np.allclose(factor @ factor.T, a, rtol=1e-10, atol=1e-10 * a.max())
        values, vectors = whitening.one_sided_jacobi(factor, 60)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12) and (np.diff(values) <= 0).all()
        assert np.allclose(values[: min(d, r)], np.linalg.eigvalsh(a)[::-1][: len(values)], rtol=1e-8, atol=1e-12 * a.max())
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_products_are_exact():
    rng = np.random.default_rng(8)
    for size in (10, 1 << 20, 1 << 28, 1 << 60):
        d = rng.integers(-size, size, (300, 3))
        want = d.astype(object).T @ d.astype(object)
        assert whitening._exact_products(d) == [int(v) for v in want[np.triu_indices(3)]]
