from itertools import combinations

from pyspark.sql import functions as F

from waitline.operators import itemsets as IS


def _brute(baskets, min_count, max_size=3):
    counts = {}
    for b in baskets:
        items = sorted(set(b))
        for k in range(1, max_size + 1):
            for c in combinations(items, k):
                counts[c] = counts.get(c, 0) + 1
    return {c: n for c, n in counts.items() if n >= min_count}


def test_absolute_support_is_exact_and_anti_monotone(spark):
    # 29 baskets: a relative support of 15/29 would round past the cut
    baskets = [["a", "b"]] * 15 + [["a", "c", "a"]] * 10 + [["b", "c"]] * 4
    df = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)], "k int, items array<string>")
    got = {tuple(r.items): r.freq for r in IS.frequent_itemsets(df, 15).collect()}
    assert got == _brute(baskets, 15)
    for items, freq in got.items():
        for k in range(1, len(items)):
            for sub in combinations(items, k):
                assert got[sub] >= freq


def test_baskets_are_distinct(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x")], "k int, it string")
    b = {r.k: sorted(r.items) for r in IS.baskets(df, "k", F.col("it")).collect()}
    assert b == {1: ["x", "y"], 2: ["x"]}


def test_save_itemsets_by_date(spark, tmp_path):
    df = spark.createDataFrame([(["a"], 3)], "items array<string>, freq bigint")
    IS.save_itemsets(df, str(tmp_path / "sets"), "2016-02-01")
    back = spark.read.parquet(str(tmp_path / "sets")).collect()
    assert back[0].items == ["a"] and str(back[0].starting_date) == "2016-02-01"
