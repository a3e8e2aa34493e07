"""Exact in-group positions and running totals without one task per group.

A window ``partitionBy(g).orderBy(k)`` sends every row of a group to one
task; when one group holds a third of the data that task is the job. Here a
group above ``rows_per_split`` rows is cut into ranges of its ordering key
(``_bucket``) holding about ``rows_per_split`` rows each, so each window
partition ``(g, _bucket)`` stays bounded. Ranges are by value, so ties never
straddle two ranges and bucket order equals key order. Results stay exact:
per-range counts (or sums) are turned into offsets by a window over the
ranges of a group, which has only about ``n / rows_per_split`` rows. Null
groups are groups of their own, as in a window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ROWS_PER_SPLIT = 2_000_000

# sampled keys per wanted range, from which its boundaries are taken
SAMPLES_PER_RANGE = 64


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``cols`` where null equals null; the left columns stay."""
    names = {c: f"_r_{c}" for c in cols}
    r = right.withColumnsRenamed(names)
    on = reduce(lambda x, y: x & y, [left[c].eqNullSafe(r[names[c]]) for c in cols])
    return left.join(r, on, how).drop(*names.values())


def numeric_key(c: Column, dtype: str) -> Column:
    """A double key with the same order as ``c`` (timestamps as microseconds)."""
    if dtype.startswith("timestamp") or dtype == "date":
        return F.timestamp_diff(
            "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
            c.cast("timestamp_ntz"),
        ).cast("double")
    return c.cast("double")


def _boundaries(k: DataFrame, hot: DataFrame, group_cols: Sequence[str], rows_per_split: int) -> DataFrame:
    """One row per hot group with its ascending range boundaries ``_bounds``
    (first key of each range but the lowest): quantiles of a random sample,
    about ``SAMPLES_PER_RANGE`` keys per range, of the key's own type. Brought
    to the driver once (rows / rows_per_split boundaries in all), so every
    later use sees the same ranges."""
    spark = k.sparkSession
    fraction = min(1.0, SAMPLES_PER_RANGE / rows_per_split)
    sample = k.select(*group_cols, "_k").where(F.col("_k").isNotNull() & (F.rand(7) < fraction))
    if group_cols:
        sample = null_safe_join(sample, F.broadcast(hot.select(*group_cols, "_n")), group_cols, "inner")
    else:
        sample = sample.withColumn("_n", F.lit(hot.first()["_n"]))
    ranges = F.ceil(F.max("_n") / F.lit(rows_per_split)).cast("int")
    per = sample.groupBy(*group_cols).agg(ranges.alias("_r"), F.array_sort(F.collect_list("_k")).alias("_s"))
    cut = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_r") - 1, F.lit(1))),
        lambda i: F.get("_s", F.floor(i * F.size("_s") / F.col("_r")).cast("int")),
    )
    per = per.select(*group_cols, F.array_distinct(cut).alias("_bounds"))
    return spark.createDataFrame(per.collect(), per.schema)


def _range_of(key: Column, bounds: str, step: int = 32) -> Column:
    """How many of the ascending boundaries are <= key (0 for a null key):
    first among every ``step``-th, then within the one stretch that holds it."""
    coarse = F.filter(bounds, lambda x, i: (i % step == 0) & (x <= key))
    at = F.greatest(F.size(coarse) - 1, F.lit(0)) * step
    fine = F.filter(F.slice(bounds, at + 1, F.lit(step)), lambda x: x <= key)
    return (at + F.size(fine)).cast("int")


def hot_group_buckets(
    df: DataFrame,
    group_cols: Sequence[str],
    key: Column,
    rows_per_split: int = DEFAULT_ROWS_PER_SPLIT,
    nulls_last: bool = False,
) -> tuple[DataFrame, bool]:
    """Add ``_bucket`` (key range within the group) and ``_split``; return
    (frame, any group split?). Only groups above ``rows_per_split`` rows
    are cut; the others are one range.

    Group sizes are a partial + final aggregate; the hot groups (at most
    ``rows / rows_per_split`` of them, which bounds what is broadcast) get
    boundaries at the quantiles of a sample, so outliers and bursts do not
    matter; equal keys stay in one range. Ordinary groups get range 0, and
    without hot groups the data is not touched. Null keys go to the lowest
    range, or the highest (``nulls_last``).
    """
    k = df.withColumn("_k", key)
    hot = k.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_split)
    found = hot.collect()
    if not found:
        return k.drop("_k").withColumn("_bucket", F.lit(0)).withColumn("_split", F.lit(False)), False
    hot = df.sparkSession.createDataFrame(found, hot.schema)
    bounds = _boundaries(k, hot, group_cols, rows_per_split)
    if group_cols:
        j = null_safe_join(k, F.broadcast(hot), group_cols, "left")
        j = null_safe_join(j, F.broadcast(bounds), group_cols, "left")
    else:
        row = bounds.first()
        cuts = F.array(*map(F.lit, row["_bounds"])) if row and row["_bounds"] else F.array()
        j = k.withColumn("_n", F.lit(found[0]["_n"])).withColumn("_bounds", cuts.cast(bounds.schema["_bounds"].dataType))
    bucket = F.coalesce(_range_of(F.col("_k"), "_bounds"), F.lit(0))
    if nulls_last:
        bucket = F.when(F.col("_k").isNull() & F.col("_bounds").isNotNull(), F.size("_bounds")).otherwise(bucket)
    out = j.withColumn("_bucket", F.when(F.col("_bounds").isNotNull(), bucket).otherwise(F.lit(0)))
    return out.withColumn("_split", F.col("_n").isNotNull()).drop("_k", "_n", "_bounds"), True


def exact_row_number(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    key: Column,
    rows_per_split: int = DEFAULT_ROWS_PER_SPLIT,
    out: str = "_rn",
) -> DataFrame:
    """``row_number() over (partition by group order by order_cols)``, split.

    ``key`` is a column ordered like the first of ``order_cols`` (any type).
    Adds ``out`` (1-based) and ``_n`` (group size). Groups above
    ``rows_per_split`` rows are ranked in count-balanced key ranges
    (``hot_group_buckets``); range offsets and group sizes come from the
    per-range counts.
    """
    g = list(group_cols)
    b, split = hot_group_buckets(df, g, key, rows_per_split)
    if not split:
        # every group is one range of at most rows_per_split rows: plain
        # windows, no offsets (and no join on constant keys)
        res = b.withColumn(out, F.row_number().over(Window.partitionBy(*g).orderBy(*order_cols)))
        res = res.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*g))).drop(
            "_bucket", "_split"
        )
        res = res.withColumn(out, F.col(out).cast("bigint"))
        return res
    counts = b.groupBy(*g, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    w_prev = Window.partitionBy(*g).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *g,
        "_bucket",
        F.coalesce(F.sum("_cnt").over(w_prev), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(*g)).alias("_n"),
    )
    local = Window.partitionBy(*g, "_bucket").orderBy(*order_cols)
    ranked = b.withColumn("_local", F.row_number().over(local))
    res = (
        null_safe_join(ranked, offsets, [*g, "_bucket"], "inner")
        .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
        .drop("_off", "_local", "_bucket", "_split")
    )
    return res


def ntile_from_rank(rn: Column, n: Column, k: int) -> Column:
    """``ntile(k)`` from a 1-based rank and the group size (standard SQL rule:
    the first ``n % k`` tiles hold one extra row)."""
    base = F.floor(n / F.lit(k))
    rem = n - base * F.lit(k)
    big = rem * (base + 1)
    first = F.floor((rn - 1) / (base + 1)) + 1
    rest = rem + F.floor((rn - 1 - big) / F.greatest(base, F.lit(1))) + 1
    return F.when(rn <= big, first).otherwise(rest).cast("int")


def running_sums(
    df: DataFrame,
    order_col: str,
    value_cols: Sequence[str],
    key: Column,
    descending: bool = False,
    rows_per_split: int = DEFAULT_ROWS_PER_SPLIT,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums of ``value_cols`` along ``order_col`` (rows with
    distinct order values), computed in count-balanced key ranges.

    Adds ``cum_<v>`` for each value column.
    """
    sign = -1.0 if descending else 1.0
    g = list(group_cols)
    b, split = hot_group_buckets(df, g, key * F.lit(sign), rows_per_split, nulls_last=descending)
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if not split:
        w = Window.partitionBy(*g).orderBy(oc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = b
        for v in value_cols:
            out = out.withColumn(f"cum_{v}", F.sum(v).over(w))
        out = out.drop("_bucket", "_split")
        return out
    totals = b.groupBy(*g, "_bucket").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    w_off = Window.partitionBy(*g).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *g,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}") for v in value_cols],
    )
    w_in = Window.partitionBy(*g, "_bucket").orderBy(oc).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    for v in value_cols:
        b = b.withColumn(f"_l_{v}", F.sum(v).over(w_in))
    out = null_safe_join(b, totals, [*g, "_bucket"], "inner")
    for v in value_cols:
        out = out.withColumn(f"cum_{v}", F.col(f"_o_{v}") + F.col(f"_l_{v}"))
    out = out.drop("_bucket", "_split", *[f"_o_{v}" for v in value_cols], *[f"_l_{v}" for v in value_cols])
    return out
