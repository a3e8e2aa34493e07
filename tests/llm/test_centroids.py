"""Integer clustering with tables against a plain version."""

import hashlib
import math
import random

import pyarrow.parquet as pq
from pyspark.sql import types as T

from waitline.llm import centroids as K

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("cluster", T.StringType())])
LONGEST = 2**63 - 1


def brute(rows, dims=64, clusters=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) if math.isfinite(1024 * x) else int(x) * 1024 for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centre = [v for _, v in first[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(centre)), key=lambda k: (far(v, centre[k]), k))
    for _ in range(rounds):
        of = [nearest(v) for _, v in kept]
        new = []
        for k, c in enumerate(centre):
            own = [v for (_, v), j in zip(kept, of) if j == k]
            new.append([sum(x) // len(own) for x in zip(*own)] if own else c)
        centre = new
    last = [(i, k := nearest(v), min(far(v, centre[k]), LONGEST)) for i, v in kept]
    inertia = [sum(d for _, k, d in last if k == c) for c in range(len(centre))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted(((i, k, d, min(inertia[k], LONGEST), min(sum(inertia), LONGEST), sha[k]) for i, k, d in last), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_table_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    got = K.clustered(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert got.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert result(got) == brute(list(zip(t["vec_id"], t["embedding"])))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def test_small_blocks_ties_and_empty_clusters(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 3)
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(60)] + [(99, [0.5] * 4)] * 9
    got = K.clustered(frame(spark, rows), dims=4, clusters=8, rounds=6)
    assert result(got) == brute(rows, 4, 8, 6)


def test_nulls_other_sizes_and_repeats(spark):
    rows = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0])]
    rows += [(None, [0.25, -0.25]), (None, [0.5, 1.0]), (7, [-0.0001, 3.0]), (7, [-0.0001, 3.0]), (7, [2.0, 2.0])]
    got = result(K.clustered(frame(spark, rows), dims=2, clusters=3, rounds=4))
    assert got == brute(rows, 2, 3, 4) and len(got) == 5
    few = result(K.clustered(frame(spark, rows[:7]), dims=2))
    assert len(few) == 1 and few[0][1:5] == (0, 0, 0, 0)


def test_large_components_are_exact(spark):
    rows = [(i, [x, -x / 3]) for i, x in enumerate([1e5, 2e5, 1e6, 3e6 + 0.7, 1e9, 1e300, -1e300, 1.7e308, 0.5])]
    got = result(K.clustered(frame(spark, rows), dims=2, clusters=3, rounds=5))
    assert got == brute(rows, 2, 3, 5)
    mixed = rows[:4] + [(9, [0.1, 0.2]), (10, [9.0, 9.0])]
    assert result(K.clustered(frame(spark, mixed), dims=2, clusters=3, rounds=5)) == brute(mixed, 2, 3, 5)


def test_empty_table(spark):
    assert result(K.clustered(frame(spark, []))) == []
