import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from machinewatch.llm.queries import op11_embedding_whitening
from machinewatch.llm.whitening import COMPONENTS, SCALE, SHIFT, components, polar_factor, whiten

SMALL = "/root/testdata/sf0.001"


def reference(rows):
    """Straight from the definition: exact integers, and numpy's own eigenvalue solver."""
    x = {i: [math.floor(SCALE * float(c)) + SHIFT for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=np.int64)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    mean = np.array([s / n for s in sums])
    y = fit - mean
    values, z = np.linalg.eigh(y.T @ y / n)
    values, z = values[::-1], z[:, ::-1]
    deviation = {i: sum((n * e - s) ** 2 for e, s in zip(v, sums)) for i, v in x.items()}
    white = {i: (np.array(v) - mean) @ z[:, :COMPONENTS] / np.sqrt(values[:COMPONENTS]) for i, v in x.items()}
    return n, deviation, white, values / values.sum()


def test_the_query_equals_a_direct_computation(ready):
    table = ready.read.parquet(f"{SMALL}/embeddings.parquet")
    n, deviation, white, explained = reference([(r["vec_id"], r["embedding"]) for r in table.collect()])
    out = op11_embedding_whitening(ready, SMALL).collect()
    assert len(out) == len(deviation) * COMPONENTS
    signs = {}
    for r in out:
        k = r["component"]
        expected = white[r["vec_id"]][k - 1]
        if abs(expected) > 1e-3:
            signs.setdefault(k, np.sign(expected) * np.sign(r["whitened"]))
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert r["whitened"] * signs.get(k, 1.0) == pytest.approx(expected, abs=1e-8)
        assert r["explained"] == pytest.approx(explained[k - 1], rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-9


@pytest.mark.parametrize("values", [
    [5.0, 4.0, 3.0, 2.0, 1.0], [1.0] * 6, [7.0, 7.0, 7.0, 1.0, 1.0, 0.0], [1e9, 1.0, 1e-3, 0.0, 0.0],
    [1.0 - 1e-9 * i for i in range(12)], [2.0], [0.0, 0.0, 0.0], [2.0 ** -i for i in range(40)]])
def test_components_of_known_spectra(values):
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values), len(values))))[0]
    v = (q * np.array(values)) @ q.T
    v = (v + v.T) / 2
    for k in (1, len(values)):
        found, z = components(v, k)
        scale = max(values) or 1.0
        assert np.allclose(found, sorted(values, reverse=True)[:k], atol=1e-13 * scale * len(values))
        assert np.allclose(z.T @ z, np.eye(k), atol=1e-13)
        assert np.allclose(v @ z, z * found, atol=1e-12 * scale * len(values))


def test_the_polar_factor_is_the_matrix_sign():
    q = np.linalg.qr(np.random.default_rng(5).standard_normal((7, 7)))[0]
    for d in ([3, 2, 1, -1, -2, -3, 4], [1e-3, 1, 1, -1, -1e-3, 5, 1e6]):
        d = np.array(d, dtype=float)
        assert np.allclose(polar_factor((q * d) @ q.T), (q * np.sign(d)) @ q.T, atol=1e-6)


def test_odd_rows(ready):
    rows = [(1, [0.1, 0.2]), (1, [0.1, 0.2]), (2, None), (3, [0.1, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, []), (7, [1.0, 2.0, 3.0]), (None, [0.5, -0.5]), (8, [-3.0, 0.7]), (9, [0.1, 0.2]), (10, [1e300, 1.0])]
    df = ready.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 as component", "'x' as x", "2 as n", "3 as part", "4 as i")
    out = whiten(df).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == sorted(
        (i, c) for i in (1, 1, 0, 8, 9) for c in (1, 2))
    assert {r["n"] for r in out} == {3}
    assert all(math.isfinite(r["whitened"]) and r["identity_error"] < 1e-12 for r in out)


def test_a_single_vector_has_no_variance(ready):
    df = ready.createDataFrame([(1, [0.1, 0.2]), (2, [0.1, 0.2])], "vec_id long, embedding array<float>")
    out = whiten(df).collect()
    assert len(out) == 4
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in out} == {(1, 0, 0.0, 0.0, 0.0)}


def test_deviations_beyond_a_long_are_null(ready):
    df = ready.range(50).select(F.col("id").alias("vec_id"), F.array(
        F.col("id").cast("double") * 1e9, F.lit(1.0)).alias("embedding"))
    n = 50
    xs = [math.floor(64e9 * i) + SHIFT for i in range(n)]
    exact = [(n * x - sum(xs)) ** 2 for x in xs]
    got = {r["vec_id"]: r["deviation"] for r in whiten(df).where("component = 1").collect()}
    assert got == {i: (e if e < 1 << 63 else None) for i, e in enumerate(exact)}


def test_nothing(ready):
    df = ready.createDataFrame([], "vec_id long, embedding array<float>")
    assert whiten(df).collect() == []
    assert whiten(ready.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0
