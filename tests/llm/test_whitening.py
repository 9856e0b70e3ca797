import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexstrata.llm import whitening as M

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("whitened", T.StringType()), T.StructField("v", T.StringType())])


def brute(vectors):
    """Integers, deviations, and eigenpairs of the dense covariance."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(r, sums, strict=True)] for r in x])
    values, found = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], found[:, ::-1]


def check(spark, vectors, expected_k, extra=()):
    rows = [(i, [float(c) for c in v], None, "x") for i, v in enumerate(vectors)] + list(extra)
    got = M.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    deviation, centred, values, found = brute(vectors)
    assert len(got) == len(vectors) * expected_k
    white = np.zeros((len(vectors), expected_k))
    for r in got:
        assert r["n"] == len(vectors) and r["deviation"] == deviation[r["vec_id"]] and r["identity_error"] <= 1e-4
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) <= 1e-9
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    want = centred @ found[:, :expected_k] / np.sqrt(values[:expected_k])
    want *= np.sign((want * white).sum(axis=0))
    assert np.abs(white - want).max() < 1e-8
    assert np.abs(white.T @ white / len(white) - np.eye(expected_k)).max() < 1e-8


def test_against_dense_eigenvectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.1, (300, 24)) * np.linspace(1, 2, 24)
    vectors[200:] = vectors[7]  # a third of all rows are copies
    odd = [(900, None, None, None), (901, [None] * 24, None, None), (902, [float("nan")] * 24, None, None), (903, [float("inf")] * 24, None, None), (904, [1.0, 2.0], None, None), (905, [], None, None)]
    check(spark, vectors, 8, odd)


def test_low_rank_and_narrow(spark):
    rng = np.random.default_rng(2)
    check(spark, np.outer(rng.normal(size=40), np.r_[np.ones(6), np.zeros(6)]).round(), 1)
    check(spark, rng.normal(size=(4, 12)), 3)
    check(spark, rng.normal(size=(50, 3)), 3)


def test_large_values_are_exact(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 1, (20, 4)).astype(np.float32) * np.float32(1e8)
    rows = [(i, [float(c) for c in v], None, None) for i, v in enumerate(vectors)]
    deviation, *_ = brute(vectors)
    for r in M.whiten(spark.createDataFrame(rows, SCHEMA)).collect():
        d = deviation[r["vec_id"]]
        assert r["deviation"] == (d if d <= M.LARGEST else None)
    assert any(d > M.LARGEST for d in deviation)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, None, None)], [(1, [1.0, 2.0], None, None)] * 3, [(1, [], None, None)]):
        df = M.whiten(spark.createDataFrame(rows, SCHEMA))
        assert df.collect() == [] and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("width", [40, 200])
def test_lanczos_converges_restarts_and_breaks_down(width):
    rng = np.random.default_rng(width)
    q, _ = np.linalg.qr(rng.normal(size=(width, width)))
    values = np.concatenate([[9, 7, 7, 5, 4, 3, 2.5, 2.2, 2], 1.5 * 0.9 ** np.arange(width - 9)])
    a = q * values @ q.T
    found, vectors, counts = M.lanczos(lambda b: a @ b, width, 8, most=48)
    assert np.allclose(found, values[:8], rtol=1e-12) and np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * found) < 1e-12
    assert (counts["restarts"] > 0) == (width == 200)
    low = np.outer(q[:, 0], q[:, 0])  # the image of any block has one direction
    found, _, counts = M.lanczos(lambda b: low @ b, width, 3)
    assert np.allclose(found, [1, 0, 0], atol=1e-14) and counts["breakdowns"] > 0


def test_passes_end_before_the_space_is_full():
    rng = np.random.default_rng(5)
    values = np.concatenate([100 * 0.5 ** np.arange(8), np.full(392, 1e-3)])
    q, _ = np.linalg.qr(rng.normal(size=(400, 400)))
    _, _, counts = M.lanczos(lambda b: q @ (values[:, None] * (q.T @ b)), 400, 8)
    assert counts["passes"] < 12


def test_row_of_columns(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], None, None), (2, [0.0, 1.0], None, None)], SCHEMA).withColumn("component", F.lit("x"))
    assert {r["vec_id"] for r in M.whiten(df).collect()} == {None, 2}
