"""Whitening against a dense eigen decomposition, and its edge cases."""

import math

import numpy as np
import pytest

from marquee.llm import whitening
from marquee.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, component string"


def brute_force(vectors, components=8):
    """``{(row, component): ...}`` of plain numpy on float vectors, rows numbered."""
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    d = (n * x - s) / n
    v = d.T @ d / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum((int(n) * int(a) - int(t)) ** 2 for a, t in zip(row, s, strict=True)) for row in x]
    return n, deviation, d @ vectors / np.sqrt(values), values / np.trace(v)


def check(rows, ids, vectors, components=8):
    n, deviation, white, share = brute_force(vectors, components)
    assert len(rows) == n * len(share)
    by_key = {(r["vec_id"], r["component"]): r for r in rows}
    for j in range(len(share)):
        got = np.array([by_key[i, j + 1]["whitened"] for i in ids])
        sign = math.copysign(1, got @ white[:, j])
        assert np.allclose(sign * got, white[:, j], atol=1e-7)
        for k, i in enumerate(ids):
            r = by_key[i, j + 1]
            assert (r["n"], r["deviation"]) == (n, deviation[k])
            assert r["explained"] == pytest.approx(share[j], rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_whitening_equals_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 12)).astype(np.float32) * np.linspace(1, 0.2, 12, dtype=np.float32)
    vectors = np.vstack([base, base[:40]])  # repeated vectors count each time
    data = [(i, [float(c) for c in v], "x") for i, v in enumerate(vectors)]
    bad = [(900, None, "x"), (901, [1.0, None] + [0.0] * 10, "x"), (902, [float("nan")] + [0.0] * 11, "x"),
           (903, [float("inf")] + [0.0] * 11, "x"), (904, [], "x"), (905, [1.0] * 5, "x")]
    df = spark.createDataFrame(data + bad, SCHEMA).repartition(5)
    rows = whitening.whiten(df).collect()
    check(rows, list(range(len(vectors))), vectors)


def test_given_embeddings(spark):
    sf001 = "/root/testdata/sf0.001"
    rows = QUERIES["op12_embedding_whitening"](spark, sf001)
    assert dict(rows.dtypes)["deviation"] == "bigint"
    given = spark.read.parquet(f"{sf001}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(rows.collect(), [r["vec_id"] for r in given], [r["embedding"] for r in given])


@pytest.mark.parametrize("dims,kind", [(64, "flat"), (200, "decay"), (150, "close"), (6, "flat")])
def test_jacobi_davidson(dims, kind):
    rng = np.random.default_rng(dims)
    spectrum = {"flat": rng.uniform(0.5, 1, dims), "decay": 1 / np.arange(1, dims + 1) ** 1.5,
                "close": 1 - 1e-3 * np.arange(dims)}[kind]
    q, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.jacobi_davidson(lambda b: a @ b, dims, 8, space=40)
    k = min(8, dims)
    assert np.allclose(values, np.sort(spectrum)[::-1][:k], atol=1e-13)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((20, 20)))
    a = (q * np.r_[-np.arange(1, 6), np.arange(1, 16)]) @ q.T
    b = rng.standard_normal((20, 3))
    assert np.allclose(a @ whitening.minres(lambda v: a @ v, b, 20), b, atol=1e-8)


def test_tables_without_variance_and_null_ids(spark):
    def rows(data):
        return whitening.whiten(spark.createDataFrame(data, SCHEMA)).collect()
    assert rows([]) == []
    assert rows([(1, None, None), (None, [], None)]) == []
    assert rows([(1, [1.0, 2.0], None)]) == []
    assert rows([(1, [1.0, 2.0], None)] * 3) == []
    # one direction varies: one component, ids may be NULL
    got = rows([(None, [0.0, 5.0], None), (1, [1.0, 5.0], None)])
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["deviation"]) for r in got) == [(0, 1, 2, 1024**2), (1, 1, 2, 1024**2)]
    assert sorted(round(r["whitened"], 9) for r in got) == [-1, 1]


def test_exact_deviation_of_large_entries(spark):
    vectors = [[3.0e7, -1.0], [-3.0e7, 0.25], [1.0e7, 0.5]]
    got = whitening.whiten(spark.createDataFrame([(i, v, None) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, z string"))
    _, deviation, _, _ = brute_force(vectors)
    assert {r["vec_id"]: int(r["deviation"]) for r in got.collect()} == dict(enumerate(deviation))
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0], None)], "vec_id long, embedding array<double>, z string")).collect()
