"""Profiles behind the reference's printed counts and figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value (D5): ``col, n``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, value: Column, bins: int = 10) -> DataFrame:
    """Fixed-width histogram over [min, max] (D8): ``bin, n``.

    One read of ``df``: rows are counted by value (partial + final aggregate: a task
    sends each of its values once), and both the range, a scalar subquery, and the
    bins come from these counts through one exchange. The bin is
    ``least(floor((x - lo) * bins / (hi - lo)), bins - 1)``, so the maximum falls in
    the last bin, as in the plotting library; equal values are all in bin 0. Null
    values are left out; no value, no row.
    """
    counts = df.groupBy(value.cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_v").isNotNull())
    # the range reads the counts as well, or pruning them would make the exchanges differ
    span = counts.where(F.col("_c") > 0).agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("s")).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    at = F.floor((F.col("_v") - lo) * F.lit(bins) / (hi - lo))
    b = F.when(lo == hi, F.lit(0)).otherwise(F.least(at, F.lit(bins - 1)))
    return counts.select(b.cast("int").alias("bin"), "_c").groupBy("bin").agg(F.sum("_c").alias("n"))


def bin_edges(lo: float, hi: float, bins: int) -> list[float]:
    """Edges of the ``bins`` fixed-width bins (for labelling only)."""
    step = (hi - lo) / bins
    return [lo + i * step for i in range(bins + 1)]


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``n`` rows (I1): the ``n`` smallest hashes of
    ``key:seed``. ``orderBy().limit()`` is a top-n per partition then a merge,
    not a full sort; the sample is the feature, so the limit is the point."""
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def predicted_vs_actual(pred: DataFrame, label: str = "label", prediction: str = "prediction", keep=()):
    """The pairs behind the scatter figures (K6), with the columns ``keep``."""
    return pred.select(*keep, F.col(prediction).alias("prediction"), F.col(label).alias("label"))
