"""Frequent item sets with an absolute support."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def baskets(df: DataFrame, key: str, item: Column) -> DataFrame:
    """One basket per key with distinct items: ``key, items``.

    ``collect_set`` is a partial + final aggregate; a basket is one key's
    distinct items, bounded by the item vocabulary.
    """
    return df.groupBy(key).agg(F.collect_set(item).alias("items"))


def frequent_itemsets(
    baskets_df: DataFrame,
    min_count: int,
    items_col: str = "items",
    n_baskets: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Item sets in at least ``min_count`` baskets: ``items, freq, size``.

    FPGrowth takes a relative support; ``(min_count - 0.5) / n`` with a
    final ``freq >= min_count`` filter keeps the absolute cut exact (plain
    ``min_count / n`` can round up past it). Baskets must hold distinct
    items, so duplicates are removed first. Parallel FP-growth partitions
    the conditional trees by item, so no basket set is collected anywhere.
    """
    b = baskets_df.select(F.array_distinct(F.col(items_col)).alias("items")).where(
        F.size("items") > 0
    )
    n = n_baskets if n_baskets is not None else b.count()
    if n == 0:
        return b.select("items", F.lit(0).cast("bigint").alias("freq"), F.size("items").alias("size")).limit(0)
    fp = FPGrowth(
        itemsCol="items",
        minSupport=max((min_count - 0.5) / n, 0.0),
        minConfidence=1.0,
    )
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    sets = fp.fit(b).freqItemsets
    return sets.where(F.col("freq") >= min_count).select(
        F.array_sort("items").alias("items"), "freq", F.size("items").alias("size")
    )


def save_itemsets(sets: DataFrame, path: str, starting_date: str | None = None) -> None:
    """Persist ``(items, freq)`` rows as parquet (A12), keyed by snapshot date
    when given."""
    from ..sources.files import write_stage

    if starting_date is None:
        sets.write.mode("overwrite").parquet(path)
    else:
        write_stage(sets, path, starting_date)
