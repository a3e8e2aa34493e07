from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from waitline.operators import evaluate as EV
from waitline.operators import profile


def _final(plan):
    """An adaptive plan's text without initial plans, those of subqueries too."""
    kept, skipped = [], None
    for line in plan.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if skipped is None or at < skipped:
            skipped = at if "== Initial Plan ==" in line else None
            if skipped is None:
                kept.append(line)
    return "\n".join(kept)


@pytest.mark.parametrize("split", [2_000_000, 40])
def test_permuted_guess_keeps_label_counts(spark, split):
    df = spark.range(0, 700).select("id", F.when(F.col("id") % 10 == 3, 1).when(F.col("id") % 50 != 7, 0).alias("label"), F.lit("x").alias("more"))
    got = EV.permuted_guess(df, "label", "id", 5, rows_per_split=split).collect()
    again = EV.permuted_guess(df.repartition(3), "label", "id", 5, rows_per_split=split).collect()
    assert sorted(got, key=lambda r: r.id) == sorted(again, key=lambda r: r.id) and {r.more for r in got} == {"x"}
    assert Counter(r.prediction for r in got) == Counter(r.label for r in got) and len({r.id for r in got}) == 700
    # not the labels themselves: about 10 % of the ones are guessed right
    assert sum(r.label == 1 and r.prediction == 1 for r in got) < 25


def test_permuted_guess_of_repeated_keys_and_nothing(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 1), (None, 1), (2, None)], "k int, label int")
    got = EV.permuted_guess(df, "label", "k").collect()
    assert Counter(r.prediction for r in got) == Counter(r.label for r in got) == Counter({1: 3, 0: 1, None: 1})
    assert EV.permuted_guess(df.limit(0), "label", "k").count() == 0


def test_histogram_equals_numpy_and_reads_once(spark, tmp_path):
    rng = np.random.default_rng(3)
    values = np.round(rng.exponential(40.0, 3000), 1)
    path = str(tmp_path / "v")
    spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").write.parquet(path)
    h = profile.histogram(spark.read.parquet(path), F.col("v"), 10)
    lo, hi = values.min(), values.max()
    want = Counter(min(int((v - lo) * 10 / (hi - lo)), 9) for v in values)
    assert {r.bin: r.n for r in h.collect()} == dict(want)
    plan = _final(h._jdf.queryExecution().executedPlan().toString())
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_histogram_of_one_value_and_none(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert [tuple(r) for r in profile.histogram(df, F.col("v")).collect()] == [(0, 2)]
    assert profile.histogram(df.where("v IS NULL"), F.col("v")).collect() == []
