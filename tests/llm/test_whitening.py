"""The bidiagonal qd solver and whitening against plain dense algebra on exact integers."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from streamlake.llm import bidiagonal, queries, whitening

DRAW = np.random.default_rng(5)


def rotation(n):
    return np.linalg.qr(DRAW.standard_normal((n, n)))[0]


MATRICES = {
    "one": np.array([[3.0]]),
    "gaussian": DRAW.standard_normal((64, 64)),
    "even": np.linalg.qr(DRAW.standard_normal((4000, 32)), mode="r"),
    "identity": np.eye(12),
    "repeated": np.diag([3.0, 3, 3, 1, 1, 0, 0]),
    "groups": rotation(30) @ np.diag([5.0] * 10 + [1.0] * 20) @ rotation(30),
    "near": rotation(25) @ np.diag(1 + 1e-10 * np.arange(25)) @ rotation(25),
    "deficient": DRAW.standard_normal((20, 6)) @ DRAW.standard_normal((6, 20)),
    "tiny": 1e-150 * DRAW.standard_normal((9, 9)),
    "large": 1e150 * DRAW.standard_normal((9, 9)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_values_and_directions(name):
    matrix = MATRICES[name]
    values, directions = bidiagonal.right_directions(matrix, 16)
    expected = np.linalg.svd(matrix, compute_uv=False)
    rank = int((expected > 1e-12 * expected[0]).sum())
    assert len(values) == min(16, rank)
    np.testing.assert_allclose(values, expected[: len(values)], rtol=1e-13)
    np.testing.assert_allclose(directions.T @ directions, np.eye(len(values)), atol=1e-13)
    scaled = matrix / expected[0]
    np.testing.assert_allclose(scaled.T @ (scaled @ directions), directions * (values / expected[0]) ** 2, atol=1e-13)


def test_nothing_but_zeros():
    values, directions = bidiagonal.right_directions(np.zeros((4, 4)), 16)
    assert len(values) == 0 and directions.shape == (4, 0)


def test_the_bidiagonal_is_the_matrix():
    matrix = DRAW.standard_normal((17, 17))
    a, b, q = bidiagonal.bidiagonalise(matrix)
    square = np.diag(a) + np.diag(b, 1)
    np.testing.assert_allclose(q @ square.T @ square @ q.T, matrix.T @ matrix, atol=1e-12)
    np.testing.assert_allclose(q.T @ q, np.eye(17), atol=1e-14)


def test_small_values_are_as_accurate_as_large_ones():
    a, b = 10.0 ** -np.arange(12), np.full(11, 1e-13)
    found = bidiagonal.squared_values((a**2).tolist(), (b**2).tolist())
    np.testing.assert_allclose(np.sqrt(found), a, rtol=1e-3)
    assert bidiagonal.squared_values([4.0, 0.0, 1.0], [1.0, 2.0]) == pytest.approx(
        np.linalg.eigvalsh(np.array([[4, 2, 0], [2, 1, 0], [0, 0, 3.0]]))[::-1].tolist(), abs=1e-12
    )


def test_the_shift_is_a_lower_bound():
    for _ in range(50):
        q, e = DRAW.uniform(0.1, 3, 12).tolist(), DRAW.uniform(0, 3, 11).tolist()
        square = np.diag(np.sqrt(q)) + np.diag(np.sqrt(e), 1)
        smallest = np.linalg.svd(square, compute_uv=False)[-1] ** 2
        assert 0 < bidiagonal.laguerre_shift(q, e) <= smallest * (1 + 1e-12)


SCHEMA = "vec_id long, embedding array<float>, x string, Component int, kept string"


def expected(vectors, most=16):
    """Per id (n, exact deviation, whitened up to sign, explained) from the plain covariance."""
    x = {k: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for k, v in vectors}
    distinct = sorted({tuple(v) for v in x.values()})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in distinct])
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    kept = [k for k in range(min(most, len(values))) if values[k] > 1e-20 * max(values[0], 1e-300) and values[0] > 0]
    out = {}
    for key, v in x.items():
        row = np.array([float(Fraction(n * c - s, n)) for c, s in zip(v, sums)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        out[key] = (n, deviation, [abs(row @ directions[:, k]) / math.sqrt(values[k]) for k in kept], [values[k] / values.sum() for k in kept])
    return out


def check(spark, vectors, odd=()):
    rows = [(k, v, "own", 5, "kept") for k, v in [*vectors, *odd]]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["vec_id", "kept", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    by_id = {}
    for r in sorted(found.collect(), key=lambda r: r["component"]):
        by_id.setdefault(r["vec_id"], []).append(r)
    wanted = expected(vectors)
    assert set(by_id) == {k for k, w in wanted.items() if w[2]}
    for key, got in by_id.items():
        n, deviation, whitened, explained = wanted[key]
        assert [r["component"] for r in got] == list(range(1, len(whitened) + 1))
        assert {r["n"] for r in got} == {n} and {r["deviation"] for r in got} == {deviation}
        np.testing.assert_allclose([abs(r["whitened"]) for r in got], whitened, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose([r["explained"] for r in got], explained, rtol=1e-12)
        assert all(r["identity_error"] < 1e-9 and r["kept"] == "kept" for r in got)
    return by_id


def floats(rows):
    return [[float(np.float32(c)) for c in r] for r in rows]


def test_against_the_plain_covariance(spark):
    spread = DRAW.standard_normal((400, 20)) * np.linspace(3, 0.5, 20) @ rotation(20)
    vectors = list(enumerate(floats(spread)))
    vectors += [(1000 + k, vectors[k % 3][1]) for k in range(60)]  # copies count once
    nan, inf = float("nan"), float("inf")
    odd = [(-1, None), (-2, []), (-3, [None] + [1.0] * 19), (-4, [nan] * 20), (-5, [1.0] * 19 + [-inf]), (-6, [1.0] * 7)]
    found = check(spark, vectors, odd)
    assert {len(r) for r in found.values()} == {16}


def test_fewer_directions_than_components(spark):
    check(spark, [(k, [float(k), 2.0 * k, 7.0]) for k in range(9)] + [(None, [3.0, 6.0, 7.0])])


def test_many_factors_are_merged(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    check(spark, list(enumerate(floats(DRAW.standard_normal((50, 4)) * [4, 3, 2, 1]))))


def test_no_variance_and_no_vectors(spark):
    assert check(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])]) == {}
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "x", 1, "k")], SCHEMA)).count() == 0


def test_huge_entries_have_a_result(spark):
    rows = spark.createDataFrame([(k, [float(k % 7), 3e38 if k == 5 else 0.5 * k], "x", 1, "k") for k in range(12)], SCHEMA)
    found = whitening.whiten(rows).collect()
    assert {r["vec_id"] for r in found} == set(range(12)) and all(math.isfinite(r["whitened"]) for r in found)
    assert [r["deviation"] for r in found if r["vec_id"] == 5][0] is None


def test_query_on_the_whole_table(spark, sf_dir):
    rows = queries.op13_whitening(spark, sf_dir).collect()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    wanted = expected([(r[0], r[1]) for r in table])
    assert len(rows) == 16 * len(wanted)
    for r in rows:
        n, deviation, whitened, explained = wanted[r["vec_id"]]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(whitened[k], rel=1e-7, abs=1e-7)
        assert r["explained"] == pytest.approx(explained[k], rel=1e-10) and r["identity_error"] < 1e-9
