"""The hash tree: balance, movement, slots and edge cases."""

import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitline.llm import registry
from waitline.llm import sharding as S

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("slot", T.StringType()), T.StructField("_task", T.StringType())])


def gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def shards(spark, ids, tree):
    df = ids if not isinstance(ids, int) else spark.range(ids)
    return {r.id: r.s for r in df.select("id", S.shard_of(F.col("id"), tree).alias("s")).collect()}


def test_query(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    rows = registry.QUERIES["op12_hash_tree_shards"](spark, SF).collect()
    raw = {i: (x or "").encode() for i, x in zip(t["doc_id"], t["text"])}
    assert sorted(r.doc_id for r in rows) == sorted(t["doc_id"])
    assert all((r.size, r.text_crc32, r.law) == (len(raw[r.doc_id]) + 1, zlib.crc32(raw[r.doc_id]), "key") for r in rows)
    assert gapless(rows) and {r.shard for r in rows} == set(range(16))
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and any(r.grown_shard == 16 for r in rows)


def test_descent_equals_the_definition(spark):
    """Level by level in plain Python, from the uniform numbers of Spark."""
    import math

    tree = [[[(0, 1.0), (1, 2.5)], [(2, 0.5)]], [[(3, 1.0), (4, 0.0)]], [[(5, 4.0)], []]]
    leaves = [s for region in tree for rack in region for s, _ in rack]
    u = spark.range(500).select("id", *(S.uniform(F.col("id"), F.lit(s)).alias(f"u{s}") for s in leaves)).collect()
    got = shards(spark, 500, tree)
    for r in u:
        draw = lambda s, w: -math.log(r[f"u{s}"]) / w if w else math.inf
        of_rack = lambda rack: min((draw(s, w) for s, w in rack), default=math.inf)
        region = min(tree, key=lambda g: min(map(of_rack, g)))
        rack = min(region, key=of_rack)
        assert got[r.id] == min(rack, key=lambda x: draw(*x))[0]


def test_weights_are_met_at_each_level(spark):
    tree = [[[(0, 1.0), (1, 2.0)], [(2, 3.0)]], [[(3, 6.0), (4, 0.0)]]]
    n = Counter(shards(spark, 24_000, tree).values())
    assert all(abs(n[s] - 2000 * w) < 250 for s, w in ((0, 1), (1, 2), (2, 3), (3, 6))) and n[4] == 0


def test_growth_moves_rows_into_the_new_shard_only(spark):
    before = shards(spark, 6000, S.even_tree(1))
    for n in range(2, 21):
        after = shards(spark, 6000, S.even_tree(n))
        moved = [i for i in after if after[i] != before[i]]
        assert {after[i] for i in moved} == {n - 1} and abs(len(moved) - 6000 / n) < 250
        before = after


def test_weight_changes_are_confined(spark):
    tree = S.even_tree(16)
    heavier = [[[(s, 3.0 if s == 6 else w) for s, w in rack] for rack in region] for region in tree]
    a, b = shards(spark, 6000, tree), shards(spark, 6000, heavier)
    assert {b[i] for i in a if a[i] != b[i]} == {6} and not any(a[i] == 6 != b[i] for i in a)


def test_edge_cases(spark):
    rows = [(None, "a"), (None, None), (1, ""), (1, ""), (1, "other"), (2, "é" * 300_000)] + [(9, "copy")] * 500
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(7)
    out = S.placed(df, S.even_tree(3), S.even_tree(4))
    assert out.columns == ["doc_id", "text", "_task", *("size", "text_crc32", "law", "shard", "grown_shard", "slot")]
    got = out.collect()
    assert len(got) == len(rows) and gapless(got)
    assert all(len({r.shard for r in got if r.doc_id == i}) == 1 for i in (None, 1, 9))
    assert {r.size for r in got if r.doc_id == 2} == {600_001} and {r.size for r in got if r.text is None} == {1}
    assert {r.text_crc32 for r in got if not r.text} == {0}
    assert [r.grown_shard for r in S.placed(df, S.even_tree(3)).limit(1).collect()] == [None]
    assert S.placed(df.limit(0), S.even_tree(3), S.even_tree(4)).count() == 0
