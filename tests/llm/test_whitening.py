"""Whitening against a direct fit over all distinct vectors, with exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from idweave.llm.queries import op11_whitening
from idweave.llm.whitening import deviations, exact_sums, leading_components, whitened_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def direct(rows, weights="one", components=4):
    """id -> (deviation, projections) lists, and the eigenvalues, trace and n of the fit: one list, no grouping."""
    xs = [(i, tuple(math.floor(256 * c) + 0 for c in v)) for i, v in rows
          if v and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 54 for c in v)]
    if not xs:
        return {}, None, 0.0, 0
    lengths = [len(x) for _, x in xs]
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    xs = [(i, x) for i, x in xs if len(x) == dim]
    fit = sorted({x for _, x in xs}) if weights == "one" else [x for _, x in xs]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    e, u = leading_components(v, components)
    out = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)),
            [float(Fraction(n * c - s, n)) for c, s in zip(x, sums)]) for i, x in xs]
    got = {}
    for i, far, y in out:
        got.setdefault(i, []).append((far, [float(np.dot(y, u[:, k]) / math.sqrt(e[k])) if e[k] > 0 else None for k in range(len(e))]))
    return got, e, float(np.trace(v)), n


def compare(found, rows, weights="one"):
    want, e, trace, n = direct(rows, weights)
    by = {}
    for r in found:
        by.setdefault(r.id, []).append(r)
    assert set(by) == set(want)
    for i, expected in want.items():
        mine = sorted(by[i], key=lambda r: (r.deviation, r.component))
        assert len(mine) == sum(len(p) for _, p in expected)
        flat = sorted(((far, k + 1, p) for far, ps in expected for k, p in enumerate(ps)), key=lambda t: t[:2])
        for r, (far, k, p) in zip(mine, flat):
            assert (r.deviation, r.component, r.n) == (far, k, n)
            assert (r.whitened is None) == (p is None)
            if p is not None:
                assert abs(r.whitened - p) < 1e-6 * max(1, abs(p)), (r, p)  # both signs by the same rule
            if trace:
                assert abs(r.explained - e[k - 1] / trace) <= 1e-9
            assert r.identity_error < 1e-6


@pytest.mark.parametrize("weights", ["one", "copies"])
def test_equal_to_a_direct_fit_with_hot_copies(spark, weights):
    rng = np.random.default_rng(3)
    base = rng.normal(0.05, [0.9, 0.5, 0.3, 0.2, 0.1, 0.1], (300, 6))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # copies: a third of all rows
    rows += [(2000, [c + 1e-7 for c in rows[9][1]]), (None, rows[3][1]), (5, rows[5][1])]  # equal x, null and repeated id
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, label int").repartition(5)
    compare(whitened_vectors(df, weights=weights).collect(), rows, weights)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5, 0.25]), (2, None), (3, []), (4, [0.1, None, 0.3]), (5, [nan, 0.0, 0.0]), (6, [inf, 0.0, 1.0]),
            (7, [0.0, -0.0, 1e-9]), (8, [0.0, 0.0, 0.0]), (8, [0.0, 0.0, 0.0]), (9, [1.0, 2.0]), (10, [-0.5, 0.75, 4.0]),
            (None, [0.5, -0.5, 0.25]), (11, [2.0 ** 60, 0.0, 0.0]), (12, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA).selectExpr(
        "*", "1 AS x", "2 AS id", "3 AS weight", "4 AS whitened", "5 AS copies", "6 AS n")
    got = whitened_vectors(df).collect()
    assert {r.id for r in got} == {1, 7, 8, None, 10, 12} and max(r.component for r in got) == 3
    compare(got, rows)


def test_few_vectors(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)], SCHEMA)
    got = whitened_vectors(one).collect()
    assert [(r.id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got)] == [
        (i, k, 1, 0, None, None, 0.0) for i in (1, 2) for k in (1, 2)]
    two = whitened_vectors(spark.createDataFrame([(1, [0.5, 0.25], 0), (2, [0.0, 0.25], 0)], SCHEMA)).collect()
    assert sorted((r.id, r.component, r.whitened is None) for r in two) == [(1, 1, False), (1, 2, True), (2, 1, False), (2, 2, True)]
    assert all(abs(abs(r.whitened) - 1) < 1e-12 and r.explained == 1 for r in two if r.component == 1)
    empty = whitened_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == one.sparkSession.createDataFrame([], empty.schema).columns


def test_exact_beyond_64_bits():
    x = np.array([[2 ** 61, -3], [2 ** 61 + 1, 5]], dtype=np.int64)
    assert exact_sums(x, np.array([3, 4])) == [7 * 2 ** 61 + 4, 11]
    y = np.array([[2 ** 40, -7], [1, 2]], dtype=np.int64)
    assert deviations(y, 10 ** 12, [10 ** 11, -5]) == [sum((10 ** 12 * int(v) - r) ** 2 for v, r in zip(row, [10 ** 11, -5])) for row in y]


def test_a_far_mean_costs_no_digits(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(1e9, [4, 2, 1], (200, 3)))]
    compare(whitened_vectors(spark.createDataFrame([(i, v) for i, v in rows], "vec_id bigint, embedding array<double>")).collect(), rows)


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op11_whitening(spark, sf)
    assert dict(got.dtypes)["deviation"] == "bigint" and got.count() == 4 * len(rows)
    compare(got.withColumnRenamed("vec_id", "id").collect(), rows)
