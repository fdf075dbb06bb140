import math

import numpy as np
import pytest

from lakepipe.llm import queries, whitening
from lakepipe.session import importable_by_workers

RNG = np.random.default_rng(5)
MATRICES = {
    "plain": RNG.normal(size=(200, 20)),
    "graded": RNG.normal(size=(200, 15)) * np.logspace(0, -12, 15),
    "equal values": np.vstack([np.eye(12), -np.eye(12)]),
    "cube": np.array(np.meshgrid(*[[0, 1]] * 6)).reshape(6, -1).T.astype(float),
    "low rank": RNG.normal(size=(3, 30)),
    "rank one": np.outer(RNG.normal(size=50), RNG.normal(size=8)),
    "constant columns": RNG.normal(size=(60, 6)) * [0, 1, 1, 0, 1, 1],
    "one column": RNG.normal(size=(30, 1)),
    "two columns": RNG.normal(size=(30, 2)),
}


def factor_of(matrix):
    return whitening._padded(np.linalg.qr(matrix - matrix.mean(0), mode="r"))


@pytest.mark.parametrize("name", MATRICES)
def test_directions(name):
    factor = factor_of(MATRICES[name])
    values, directions, total = whitening.leading_directions(factor, 4)
    singular = np.linalg.svd(factor, compute_uv=False)
    kept = min(4, int((singular > 1e-13 * singular[0]).sum()))
    assert len(values) == kept
    np.testing.assert_allclose(values, singular[:kept] ** 2, rtol=1e-12)
    np.testing.assert_allclose(directions.T @ directions, np.eye(kept), atol=1e-12)
    np.testing.assert_allclose(factor.T @ (factor @ directions), directions * values, atol=1e-13 * values[0])
    assert math.isclose(total, (singular**2).sum(), rel_tol=1e-12)


def test_small_singular_values_to_high_relative_accuracy():
    """A graded bidiagonal matrix, against 60 digits."""
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    q = [10.0 ** (-3 * i) for i in range(6)]
    e = [10.0 ** (-3 * i - 1) for i in range(5)]
    product = Decimal(1)
    for x in q:
        product *= Decimal(x)
    found = whitening.dqds(q, e)
    got = Decimal(1)
    for x in found:
        got *= Decimal(x)
    assert abs(got / product - 1) < Decimal(1e-13)  # the determinant holds the smallest value
    assert math.isclose(sum(found), sum(q) + sum(e), rel_tol=1e-14)


def test_a_pair_too_close_to_tell_apart():
    """Wilkinson's matrix: its largest values agree to the last digits."""
    t = np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    factor = np.linalg.cholesky(t + 3 * np.eye(21)).T
    values, directions, _ = whitening.leading_directions(factor, 6)
    np.testing.assert_allclose(directions.T @ directions, np.eye(6), atol=1e-12)
    np.testing.assert_allclose(factor.T @ factor @ directions, directions * values, atol=1e-12)


def brute(rows, components=4):
    """{(id, component): (n, deviation, |whitened|, explained)} with numpy's own eigenvectors."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    centred = fit - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for k, j in enumerate(order, 1):
            w = (np.array(x) - np.array(sums) / n) @ vectors[:, j] / math.sqrt(values[j])
            out[i, k] = (n, deviation, w, values[j] / values.sum())
    return out


def same(rows, want):
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert set(got) == set(want) and len(rows) == len(want)
    for k in {k for _, k in want}:
        ids = [i for i, c in want if c == k]
        ours, theirs = (np.array(v) for v in ([got[i, k]["whitened"] for i in ids], [want[i, k][2] for i in ids]))
        np.testing.assert_allclose(ours * np.sign(ours @ theirs), theirs, atol=1e-9)
    for key, (n, deviation, _, explained) in want.items():
        r = got[key]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert math.isclose(r["explained"], explained, rel_tol=1e-9) and r["identity_error"] < 1e-9


def test_query_against_numpy(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    same(queries.op11_whitened_embeddings(spark, folder).collect(), brute(rows))


SCHEMA = "vec_id long, embedding array<double>, component string, n string, whitened long, x int"


def odd(spark, rows):
    importable_by_workers(spark)
    return spark.createDataFrame([(i, v, "a", "b", 1, 2) for i, v in rows], SCHEMA).repartition(5)


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 500)] + [(7, rows[9][1]), (None, rows[10][1]), (501, [-0.0] * 6)]
    bad = [(600, None), (601, []), (602, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (603, [math.nan] * 6), (604, [math.inf] + [0.0] * 5)]
    other = [(605, [1.0, 2.0]), (606, [2.0**40] * 6)]
    found = whitening.whiten(odd(spark, rows + bad + other)).collect()
    assert len(found) == 4 * len(rows) and not {r["vec_id"] for r in found} & set(range(600, 700))
    unique = [r for r in rows if r[0] is not None and r[0] != 7]
    both = [r for r in found if r["vec_id"] is not None and r["vec_id"] != 7]
    want = {k: v for k, v in brute(rows).items() if k[0] is not None and k[0] != 7}
    same(both, want)
    assert len(unique) * 4 == len(both)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]], ids=["none", "unusable", "equal"])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(odd(spark, rows)).collect() == []


def test_fewer_components_than_asked(spark):
    found = whitening.whiten(odd(spark, [(1, [0.0, 0.0, 5.0]), (2, [1.0, 1.0, 5.0]), (3, [3.0, 3.0, 5.0])])).collect()
    assert {r["component"] for r in found} == {1} and all(math.isclose(r["explained"], 1.0) for r in found)


def test_a_deviation_beyond_64_bits_is_null(spark):
    found = whitening.whiten(odd(spark, [(1, [2.0**34, 0.0]), (2, [0.0, 1.0])])).collect()
    assert found and all(r["deviation"] is None for r in found)
