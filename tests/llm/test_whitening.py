"""Whitening against exact sums and a local eigendecomposition."""

import math

import numpy as np
import pytest
from logweir.llm.queries import QUERIES
from logweir.llm.whitening import components, numbered, whiten
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, most=8):
    """``{(vec_id, component): values}``; whitened values up to the component's sign."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    white = centred @ vectors / np.sqrt(values)
    error = np.abs(white.T @ white / n - np.eye(len(values))).max()
    share = values / np.trace(centred.T @ centred / n)
    return {(i, k + 1): (n, deviation[r], abs(white[r, k]), share[k]) for r, (i, _) in enumerate(good) for k in range(len(values))}, error


def agrees(df, rows, most=8):
    wanted, error = brute(rows, most)
    found = {(r.vec_id, r.component): r for r in df.collect()}
    assert set(found) == set(wanted)
    for key, (n, deviation, white, share) in wanted.items():
        r = found[key]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(white, abs=1e-8)
        assert r.explained == pytest.approx(share, rel=1e-9)
        assert r.identity_error < 1e-8 and error < 1e-8


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    agrees(QUERIES["op11_whitening"](spark, FOLDER), rows)


def test_many_blocks_and_few_dimensions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(0, [1, 5, 0.1], 3)]) for i in range(97)]
    agrees(whiten(spark.createDataFrame(rows, SCHEMA).repartition(5), rows_per_block=10), rows)


def test_a_sign_is_the_same_for_all_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(0, [1, 5, 2], 3)]) for i in range(40)]
    out = whiten(spark.createDataFrame(rows, SCHEMA), most=1).orderBy("vec_id").collect()
    x = np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(float))
    vector = np.linalg.eigh(np.cov(x.T))[1][:, -1]
    corner = np.corrcoef([r.whitened for r in out], x @ vector)[0, 1]
    assert abs(corner) == pytest.approx(1)


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(0, 1, 4)]) for i in range(20)] + [(3, [0.5, 0.25, 1.0, 2.0])] * 3
    odd = [(50, None), (51, [1.0, None, 2.0, 3.0]), (52, [math.nan, 1.0, 1.0, 1.0]), (53, [math.inf, 1.0, 1.0, 1.0]), (54, []),
           (55, [1e30, 0.0, 0.0, 0.0]), (56, [1.0, 2.0]), (None, [0.1, 0.2, 0.3, 0.4])]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumns({"index": F.lit("x"), "at": F.lit(1), "n": F.lit(None), "v": F.lit(2.0)})
    out = whiten(df).collect()
    assert {r.vec_id for r in out} == {i for i, _ in rows} | {None}
    assert {r.n for r in out} == {24} and len(out) == 24 * 4
    assert sum(r.vec_id == 3 for r in out) == 4 * 4


def test_directions_without_variance(spark):
    rows = [(i, [float(i % 5), 1.0]) for i in range(10)]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    still = [r for r in out if r.component == 2]
    assert all(r.whitened == 0 and r.explained == 0 and r.identity_error == 1 for r in still)
    assert {round(r.explained, 9) for r in out if r.component == 1} == {1.0}
    one = whiten(spark.createDataFrame([(1, [2.0, 3.0])], SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened) for r in one] == [(1, 0, 0.0)] * 2


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(i * 10**9)]) for i in range(4)]
    assert {r.deviation for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()} == {None}


def test_empty(spark):
    out = whiten(spark.createDataFrame([(1, None)], SCHEMA))
    assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_numbers_are_consecutive(spark):
    rows = numbered(spark.range(0, 1000, 1, 7))
    assert sorted(r["index"] for r in rows.select("index").collect()) == list(range(1000))


def test_components_fall():
    values, vectors = components(np.diag([1.0, 9.0, 4.0]), 2)
    assert values.tolist() == [9.0, 4.0] and vectors[1, 0] == 1.0
