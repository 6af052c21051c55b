"""Whitening against a dense eigendecomposition, and the iteration on hard spectra."""
import numpy as np
import pytest

from barloom.llm import whitening

DDL = "vec_id long, embedding array<double>"


def plain(rows, k=16):
    """{(id, component): (n, deviation, |whitened|, explained)} by numpy's own decomposition."""
    usable = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows]
    x = np.array(sorted(set(map(tuple, (v for _, v in usable)))), dtype=object)
    n, total = len(x), x.sum(0)
    centred = ((n * x - total) / n).astype(float)
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    out = []
    for i, v in usable:
        numerator = n * np.array(v, object) - total
        z = (numerator / n).astype(float) @ q / np.sqrt(e)
        out += [(i, c + 1, n, int((numerator ** 2).sum()), abs(z[c]), e[c] / np.trace(centred.T @ centred / n)) for c in range(len(e))]
    return out


def compare(spark, rows, extra=()):
    got = whitening.whitened(spark.createDataFrame([*rows, *extra], DDL).repartition(3)).collect()
    want = plain(rows)
    key = lambda r: (str(r[0]), r[1], r[3])
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"], r["identity_error"]) for r in got), key=key)
    assert [r[:4] for r in got] == [r[:4] for r in sorted(want, key=key)]
    np.testing.assert_allclose([r[4] for r in got], [r[4] for r in sorted(want, key=key)], atol=1e-9)
    np.testing.assert_allclose([r[5] for r in got], [r[5] for r in sorted(want, key=key)], rtol=1e-11)
    assert all(r[6] < 1e-10 for r in got)


def test_against_a_dense_decomposition(spark):
    rng = np.random.default_rng(5)
    mix = rng.standard_normal((24, 24)) * np.geomspace(3, 0.1, 24)
    rows = [(i, (rng.standard_normal(24) @ mix.T + 5).tolist()) for i in range(400)]
    rows += [(i + 1000, rows[i][1]) for i in range(50)] + [(None, rows[7][1]), (3, rows[3][1])]
    extra = [(9001, None), (9002, [1.0] * 23 + [None]), (9003, [float("nan")] * 24), (9004, [float("inf")] * 24), (9005, [1.0] * 5), (9006, []), (9007, [1e300] * 24)]
    compare(spark, rows, extra)


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(6)
    compare(spark, [(i, rng.standard_normal(3).tolist()) for i in range(40)])


def test_integers_beyond_64_bits(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.standard_normal(4) * 2.0**40).tolist()) for i in range(60)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(spark.createDataFrame(rows, DDL)).collect()}
    assert got and set(got.values()) == {None}


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    got = whitening.whitened(spark.createDataFrame(rows, DDL)).collect()
    assert len(got) == 30 and all((r["whitened"] is None) == (r["component"] > 1) for r in got) and got[0]["identity_error"] < 1e-12
    one = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], DDL)).collect()
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one} == {(1, 0, None, 0.0)}


def test_empty_tables_and_other_columns(spark):
    assert whitening.whitened(spark.createDataFrame([], DDL)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], DDL)).count() == 0
    df = spark.createDataFrame([(1, [1.0], 5, "a"), (2, [2.0], 6, "b")], DDL + ", x long, raw string")
    assert sorted(round(r["whitened"], 12) for r in whitening.whitened(df).collect()) == [-1.0, 1.0]


@pytest.mark.parametrize("spectrum", [np.geomspace(1, 1e-12, 200), np.r_[np.full(10, 2.0), np.linspace(1, 0.9, 190)], np.r_[np.zeros(190), np.ones(10)], np.linspace(1, 2, 200) ** 8])
def test_restarts_and_close_values(spectrum):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(spectrum), len(spectrum))))[0]
    a = q * spectrum @ q.T
    values, vectors, residual = whitening.leading(lambda w: a @ w, len(a), 16)
    np.testing.assert_allclose(values, np.sort(spectrum)[::-1][:16], atol=1e-12 * spectrum.max())
    assert residual < 1e-13 and np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13
