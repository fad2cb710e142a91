from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm.queries import QUERIES
from tradeloom.llm.whitening import polar, spectrum, whiten

E = "vec_id long, embedding array<float>, label int"


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 24), st.integers(0, 1000), st.sampled_from(["any", "low rank", "repeated", "graded"]))
def test_spectrum_as_by_a_library(n, seed, kind):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = {"any": rng.standard_normal(n), "low rank": np.r_[rng.uniform(1, 2, (n + 1) // 2), np.zeros(n // 2)], "repeated": rng.integers(0, 3, n).astype(float), "graded": 10.0 ** -np.arange(n)}[kind]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, axes = spectrum(a)
    size = max(1e-300, np.abs(a).max())
    assert np.allclose(found, np.sort(np.linalg.eigvalsh(a))[::-1], atol=1e-12 * size)
    assert np.allclose(axes.T @ axes, np.eye(n), atol=1e-12)
    assert np.allclose(a @ axes, axes * found, atol=1e-11 * size)


def test_polar_factor_is_the_sign():
    a = np.diag([3.0, 1e-9, -2.0])
    assert np.allclose(polar(a), np.diag([1.0, 1, -1]), atol=1e-12)
    assert np.allclose(polar(np.zeros((2, 2))), np.eye(2))


def truth(rows):
    sound = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    wide = max(len(r[1]) for r in sound)
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in [*r[1], *[0.0] * (wide - len(r[1]))]] for r in sound]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array(x, float) - np.array(sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return [(r[0], sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))) for r, v in zip(sound, x, strict=True)], centred @ axes / np.sqrt(values), values / values.sum()


def test_as_by_brute_force_with_messy_rows(spark):
    rng = np.random.default_rng(2)
    mix = rng.standard_normal((12, 12))
    rows = [(i, (rng.standard_normal(12) @ mix).astype(float).tolist(), 0) for i in range(300)]
    rows += [(2**60 + 1, rows[0][1], 0), (2**60 + 1, rows[0][1], 0), (None, rows[5][1], None), (500, [1.0, 2.0], 1), (501, [], 1)]
    bad = [(400, None, 0), (401, [None] * 12, 0), (402, [float("nan")] + [0.0] * 11, 0), (403, [float("inf")] + [0.0] * 11, 0)]
    df = spark.createDataFrame(rows + bad, E).withColumnsRenamed({"label": "x"}).selectExpr("*", "1 as z", "2 as n", "3 as component")
    found = whiten(df.repartition(3)).collect()
    named, z, shares = truth(rows + bad)
    assert len(found) == 8 * len(named) and {r["n"] for r in found} == {len(named)}
    assert sorted({(r["vec_id"], r["deviation"]) for r in found}, key=str) == sorted(set(named), key=str)
    assert all(math.isclose(r["explained"], shares[r["component"] - 1], rel_tol=1e-9) for r in found)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in found}
    mine = np.array([[by[(i, c)] for c in range(1, 9)] for i, _ in named])
    signs = np.sign((mine * z[:, :8]).sum(axis=0))
    assert np.abs(mine - z[:, :8] * signs).max() < 1e-8


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0)], [(i, [1.0, 2.0], 0) for i in range(4)]])
def test_no_variance_gives_no_rows(spark, rows):
    assert whiten(spark.createDataFrame(rows, E)).count() == 0


def test_components_without_variance_are_left_out(spark):
    found = whiten(spark.createDataFrame([(i, [float(i % 7), 5.0, float(i % 7)], 0) for i in range(50)], E)).collect()
    assert {r["component"] for r in found} == {1} and found[0]["identity_error"] < 1e-9


def test_large_deviations_are_exact_or_the_largest_long(spark):
    rows = [(i, [float((i - 2) * 2**20), 1.0], 0) for i in range(5)] + [(9, [1e30, 0.0], 0)]
    by = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame(rows, E)).collect()}
    want = {i: 0 for i, *_ in rows}
    x = {i: [math.floor(1024 * min(c, 2.0**30)) + 100_000 for c in v] for i, v, _ in rows}
    sums = [sum(c) for c in zip(*x.values(), strict=True)]
    for i, v in x.items():
        want[i] = min(2**63 - 1, sum((6 * a - s) ** 2 for a, s in zip(v, sums, strict=True)))
    assert by == want


def test_registered_query_whitens_the_given_vectors(spark):
    found = QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001").toPandas()
    assert found["identity_error"].max() < 1e-4 and set(found["component"]) == set(range(1, 9))
