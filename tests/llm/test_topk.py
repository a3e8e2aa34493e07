"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from waitline.llm import registry
from waitline.llm import topk as K

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("v", T.StringType()), T.StructField("id", T.StringType())])


def brute(rows, query_ids, k=5):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in fine:
        if i in query_ids:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i)[:k]
            out += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    t = pq.read_table(f"{sf}/embeddings.parquet").to_pydict()
    got = result(registry.QUERIES["op5_pivot_topk"](spark, sf))
    assert got == brute(list(zip(t["vec_id"], t["embedding"])), {i for i in t["vec_id"] if i % 50 == 0})


@pytest.mark.parametrize("block,task,queries", [(1024, 512, 16384), (7, 3, 4)])
def test_clusters_ties_and_copies(spark, monkeypatch, block, task, queries):
    monkeypatch.setattr(K, "BLOCK", block)
    monkeypatch.setattr(K, "_TASK", task)
    monkeypatch.setattr(K, "QUERIES", queries)
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    vectors = [[x + rnd.gauss(0, 0.1) for x in rnd.choice(centres)] for _ in range(150)] + [[0.5] * 8] * 60 + [[-x for x in centres[0]], [0.0] * 8]
    rows = [(i * 3 + 1, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    asked = {i for i, _ in rows if i % 7 == 0}
    got = result(K.search(df, df.where("vec_id % 7 = 0"), pivots=6))
    assert got == brute(rows, asked)


def test_nulls_non_finite_short_large_and_clashing_columns(spark):
    rows = [(1, [0.1, 0.2]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [1.0]), (8, [-1e9, 3e9]), (9, [2e9, 1e9, 1.0]), (None, [1.0, 1.0]), (10, [0.1, 0.2])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert result(K.search(df, df)) == [r for r in brute(rows, {r[0] for r in rows})]


def test_fewer_than_k_and_none(spark):
    df = spark.createDataFrame([(1, [1.0], "", ""), (2, [2.0], "", "")], SCHEMA)
    assert result(K.search(df, df.where("vec_id = 1"))) == [(1, 1, 2, 131072)]
    assert result(K.search(df.where("vec_id = 1"), df.where("vec_id = 1"))) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert K.search(empty, empty).count() == 0 and K.search(empty, df).count() == 0 and K.search(df, empty).count() == 0


def test_bounds_prune(spark):
    """Far annuli are not compared: the bound of a far cluster is below the k-th score."""
    a, b = np.full((50, 4), 300), np.full((50, 4), -300)
    x = np.concatenate([a, b]) + np.arange(400).reshape(100, 4) % 7
    largest = float((x * x).sum(axis=1).max())
    lifted = K._lifted(x, largest)
    pivots = K.choose_pivots(lifted, 2)
    d = K._distances(lifted, pivots)
    q = np.concatenate([x[:1].astype(float), [[0.0]]], axis=1)
    to = K._distances(q, pivots)
    far = int(d[60].argmin())
    rows = d[:, far][d.argmin(axis=1) == far]
    gap = np.maximum(np.maximum(to[:, far] - rows.max(), rows.min() - to[:, far]), 0)
    assert K._bounds(gap, (q * q).sum(axis=1), largest)[0] < np.sort(x[:50] @ x[0])[-6]


def test_repeated_query_ids_over_chunk_borders(spark, monkeypatch):
    monkeypatch.setattr(K, "QUERIES", 4)
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in [1, 2, 2, 2, 3, 3, 4, 5, *[6] * 11, 7, 8, 9]]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    got = result(K.search(df, df))
    want = []
    for i in {i for i, _ in rows}:  # the rows of an id share its ranks, as in the SQL
        pairs = [(-s, r, j) for q, r, j, s in [x for a in rows if a[0] == i for x in brute([a, *[b for b in rows if b[0] != i]], {i}, 99)]]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted((s, j) for s, _, j in pairs)[:5])]
    assert got == sorted(want)


def test_large_finite_components_take_part(spark):
    big = [2.0**53, 1e17, -3e200, 1.7e308]
    rows = [(i, [b, 1.5 * i, -0.25]) for i, b in enumerate(big, 1)] + [(i, [0.25 * i, 1.0, -float(i)]) for i in range(10, 30)] + [(40, [0.0, -1e16])]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).repartition(7)
    ints = [(i, [int(x) * 256 if abs(x) > 2**60 else math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for i, q in ints:
        top = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ints if j != i)[:5]
        want += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(top)]
    assert result(K.search(df, df)) == sorted(want)
