"""Split and unsplit paths give equal results: null labels, null times, string
keys, outliers."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from waitline.operators import history, sampling
from waitline.operators.ordered import exact_row_number, hot_group_buckets, running_sums


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_null_labels_keep_their_rows(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 2).alias("label"))
    whole = sampling.stratified_folds(df, "label", "id", 3)
    split = sampling.stratified_folds(df, "label", "id", 3, rows_per_split=3)
    assert rows(whole) == rows(split) and split.count() == 100


def test_string_keys(spark):
    df = spark.range(200).select(F.concat(F.lit("user-"), F.col("id")).alias("key"), (F.col("id") % 2).alias("label"))
    assert rows(sampling.stratified_folds(df, "label", "key", 3)) == rows(sampling.stratified_folds(df, "label", "key", 3, rows_per_split=10))


def test_null_keys_stay_in_order(spark):
    df = spark.range(120).select("id", F.when(F.col("id") % 5 != 0, F.col("id") % 50).alias("k"), F.lit(1).alias("g"))
    want = df.withColumn("_rn", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")).cast("bigint")).withColumn("_n", F.lit(120).cast("bigint"))
    order = [F.col("k"), F.col("id")]
    got = exact_row_number(df, ["g"], order, F.col("k"), 10)
    assert rows(got.select("id", "k", "g", "_rn", "_n")) == rows(want)


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_running_sums_with_a_null_and_null_groups(spark, groups):
    df = spark.range(60).select(F.when(F.col("id") != 7, F.col("id").cast("double")).alias("s"), F.lit(1).alias("v"), F.when(F.col("id") % 3 != 0, F.lit(1)).alias("g"))
    for descending in (False, True):
        one = running_sums(df, "s", ["v"], F.col("s"), descending, group_cols=groups)
        two = running_sums(df, "s", ["v"], F.col("s"), descending, 5, groups)
        assert rows(one.select("s", "g", "cum_v")) == rows(two.select("s", "g", "cum_v"))


def test_an_outlier_does_not_unbalance_the_ranges(spark):
    df = spark.range(2000).select(F.lit(1).alias("g"), F.when(F.col("id") == 0, F.lit(1e15)).otherwise(F.col("id").cast("double")).alias("k"))
    out, split = hot_group_buckets(df, ["g"], F.col("k"), rows_per_split=100)
    sizes = [r.n for r in out.groupBy("_bucket").agg(F.count("*").alias("n")).collect()]
    assert split and max(sizes) <= 200 and sum(sizes) == 2000


def test_history_of_one_user_split_and_whole(spark):
    t0 = dt.datetime(2020, 1, 1)
    at = lambda i: None if i is None else t0 + dt.timedelta(hours=i)
    asks = spark.createDataFrame(
        [(i, 1, at(i * 3 % 60)) for i in range(30)] + [(100, 1, None), (101, None, at(5)), (102, 2, at(1)), (103, 1, at(10_000_000 // 24))],
        "id long, owneruserid long, creationdate timestamp_ntz",
    )
    events = spark.createDataFrame(
        [(i, 1, at(i * 7 % 61), f"b{i}") for i in range(80)] + [(500, 1, None, "x"), (501, 2, at(0), "y"), (502, 1, at(4), None)],
        "id long, userid long, date timestamp_ntz, name string",
    )
    whole = rows(history.prior_events(asks, events))
    for n in (5, 10, 1000):
        assert rows(history.prior_events(asks, events, rows_per_split=n)) == whole
    by = {r[0]: r for r in whole}
    assert by[100][2:] == ("", 0) and by[101][2:] == ("", 0) and by[102][2:] == ("y", 1)
    ev = events.collect()
    for a in asks.where("creationdate IS NOT NULL AND owneruserid = 1").collect():
        want = [e.name for e in sorted((e for e in ev if e.userid == 1 and e.date is not None and e.date < a.creationdate), key=lambda e: (e.date, e.id)) if e.name is not None]
        assert by[a.id][2] == " ".join(want)


def test_a_share_of_one_takes_every_row(spark):
    assert spark.range(500).where(sampling.in_fraction("id", 1.0)).count() == 500
    assert spark.range(500).where(sampling.in_fraction("id", 0.0)).count() == 0


def test_contiguous_folds_are_ntile(spark):
    from waitline.operators import sampling as SP

    df = spark.range(0, 503).selectExpr("id * 7 AS id").repartition(5)
    sizes = [126, 126, 126, 125]
    want, at = {}, 0
    for fold, n in enumerate(sizes, 1):
        want |= {7 * i: fold for i in range(at, at + n)}
        at += n
    for most in (2_000_000, 40):
        assert {r.id: r.fold for r in SP.contiguous_folds(df, "id", 4, rows_per_split=most).collect()} == want
