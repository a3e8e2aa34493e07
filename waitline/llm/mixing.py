"""Mixing sources to target weights by Poisson replication, in DataFrame
functions only.

Each source has a target share of the output, whose expected size (in
characters) is that of the input. A source's rate is its target size over its
own size; a document of it is repeated Poisson(rate) times: its uniform number,
from the MD5 of its id, text and seed, is inverted through the cumulative
distribution, which is tabulated once for each source. The copies are then
dealt to partitions and sorted by a hash of themselves, a uniform random order.
Draws depend on the row alone, so a task that is run again repeats them, and
rows that are equal in id and text are drawn alike.

Default targets are the square root of the sources' sizes, normalised:
large sources shrink and small ones grow. ``weights`` gives others by source
(need not sum to one; sources that it lacks get zero). A null source is one of
its own, '' in ``weights``. A null text counts no characters; its row is drawn
at its source's rate. A source without any characters keeps its rows once each.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SEED = 1
EXPONENT = 0.5
MOST_SOURCES = 100_000  # whose rates are broadcast; with more, they are joined by a shuffle


def uniform(id_: Column, text: Column, seed: int) -> Column:
    """In [0, 1), of 52 bits of an MD5."""
    text = F.md5(F.coalesce(text, F.lit("")))
    digest = F.md5(F.concat_ws("|", F.coalesce(id_.cast("string"), F.lit("")), text, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(docs: DataFrame, text_col: str, source_col: str, weights: Mapping[str, float] | None = None, exponent: float = EXPONENT) -> DataFrame:
    """(source, size, rate): one row for each source."""
    size = F.sum(F.coalesce(F.length(text_col), F.lit(0))).cast("long")
    sizes = docs.groupBy(F.coalesce(source_col, F.lit("")).alias("source")).agg(size.alias("size"))
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(exponent))
    else:
        given = F.create_map(*(F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1])))) if weights else F.create_map().cast("map<string,double>")
        weight = F.coalesce(F.element_at(given, F.col("source")), F.lit(0.0))
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(F.lit(0.0)))
    sizes = C.stored(sizes, "sizes")
    total = sizes.agg(F.sum("size").cast("double").alias("size"), F.sum("weight").alias("weight")).first()
    rate = F.col("weight") / F.lit(total.weight or 1.0) * F.lit(total.size) / F.col("size")
    return sizes.select("source", "size", F.when(F.col("size") > 0, rate).alias("rate"))


def _cumulative(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ...; past its end the tail is below 2**-52."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("table"))

    def step(a, k):
        log = a["log"] + F.log(rate / k)
        return F.struct(log.alias("log"), (a["sum"] + F.exp(log)).alias("sum"), F.concat(a["table"], F.array(a["sum"] + F.exp(log))).alias("table"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["table"])


def replicated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Mapping[str, float] | None = None,
    seed: int = SEED,
    copy_col: str = "copy",
    order_col: str = "shuffle_key",
) -> DataFrame:
    """The columns of ``docs``, with copy (from 1) and shuffle_key, ascending
    within each partition, which replace columns of the same names."""
    docs = docs.drop(copy_col, order_col)
    source, cdf, draw = (C.free_name(docs, x) for x in ("_source", "_cdf", "_u"))
    found = rates(docs, text_col, source_col, weights)
    table = F.when(F.col("rate") > 0, _cumulative(F.col("rate"))).otherwise(F.when(F.col("rate") == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(-1.0), F.lit(1.0))))
    found = C.stored(found.select(F.col("source").alias(source), table.alias(cdf)), "rates")
    few = found.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES
    joined = docs.withColumn(draw, uniform(F.col(id_col), F.col(text_col), seed)).join(F.broadcast(found) if few else found, F.coalesce(F.col(source_col), F.lit("")) == F.col(source))
    count = F.size(F.filter(cdf, lambda c: c <= F.col(draw)))
    copies = joined.withColumn(cdf, count).where(F.col(cdf) > 0).drop(source)
    copies = copies.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col(cdf)))).drop(cdf)
    key = F.xxhash64(draw, F.col(id_col), copy_col, F.lit(seed))
    return copies.withColumn(order_col, key).drop(draw).repartition(order_col).sortWithinPartitions(order_col)
