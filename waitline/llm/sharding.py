"""Sharding by a hierarchical weighted hash tree, in DataFrame functions (the
slots are counted in tasks).

The tree has regions, racks in them and shards in those; a shard has a weight, a
rack and a region that of all shards below. A document descends from level to
level: every child makes a weighted hash draw and the least one wins.

A shard's draw is -ln(u) / weight, u uniform from a hash of document id and shard
number: exponential with the weight as rate. The draw of a rack or region is the
least of those below it, which again is exponential with their summed weight as
rate. So a level chooses children in proportion to their weights, and a change of
weights confines movement: only draws on the path to a changed shard change, so
rows move into a shard that grows (or is new) from all others in proportion, out of
one that shrinks, and nowhere else. (Draws made anew for a whole rack would also
move rows between the rack and shards that did not change.) A row costs one hash a
shard of the tree.

Law: ``key``. Document id and tree decide a row's shard, nothing else: rows that
share an id share a shard, and so do all rows with a null id. Texts that are equal
are spread like others.

``placed`` also gives each row a slot, gapless from 0 in its shard: tasks number
their own rows and are offset by what the tasks before them have. A null text has
no bytes. Repeated rows have slots of their own. An empty table has no rows. All
columns pass through; those of the result replace columns of the same names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

Tree = list[list[list[tuple[int, float]]]]  #: regions of racks of (shard, weight)

RACK = 4  # shards of a rack
REGION = 2  # racks of a region
SEED = 12
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def even_tree(shards: int) -> Tree:
    """Shards 0, 1, ... of weight one, filling rack after rack."""
    racks = [[(s, 1.0) for s in range(i, min(i + RACK, shards))] for i in range(0, shards, RACK)]
    return [racks[i : i + REGION] for i in range(0, len(racks), REGION)]


def uniform(id_: Column, shard: Column) -> Column:
    """In (0, 1), of 53 bits of a hash."""
    return (F.shiftrightunsigned(F.xxhash64(id_, shard, F.lit(SEED)), 11).cast("double") + 0.5) / float(1 << 53)


def shard_of(id_: Column, tree: Tree) -> Column:
    """The shard that the id descends to."""
    held = [[[{"shard": s, "weight": w} for s, w in rack if w > 0] for rack in region] for region in tree]
    held = [[rack for rack in region if rack] for region in held]
    held = [region for region in held if region]
    if not held:
        raise ValueError("the tree has no shard of positive weight")
    leaves = F.from_json(F.lit(json.dumps(held)), "array<array<array<struct<shard:int,weight:double>>>>")
    draw = lambda s: F.struct((-F.log(uniform(id_, s["shard"])) / s["weight"]).alias("draw"), s["shard"].alias("below"))
    least = lambda children: F.struct(F.array_min(children)["draw"].alias("draw"), children.alias("below"))
    rack = lambda shards: least(F.transform(shards, draw))
    region = lambda racks: least(F.transform(racks, rack))
    chosen = F.array_min(F.transform(leaves, region))["below"]  # the region's racks
    return F.array_min(F.array_min(chosen)["below"])["below"]


def _numberer(width: int):
    """Adds to each row its task and its number among the task's rows of its shard,
    which is in the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            shard = batch.column(width - 1).to_numpy(zero_copy_only=False)
            number = np.empty(len(shard), np.int64)
            for s in np.unique(shard).tolist():
                own = np.flatnonzero(shard == s)
                number[own] = seen.get(s, 0) + np.arange(len(own))
                seen[s] = seen.get(s, 0) + len(own)
            columns = [*batch.columns, pa.array(np.full(len(shard), task), pa.int32()), pa.array(number)]
            yield pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])

    return run


def numbered(df: DataFrame, shard_col: str, slot_col: str) -> DataFrame:
    """``df`` with each row's place in its shard, gapless from 0; no shard and no
    table goes through one task: rows are numbered where they are read."""
    task, number, start = (C.free_name(df, x) for x in ("_task", "_number", "_start"))
    own = df.select(*(c for c in df.columns if c != shard_col), shard_col)
    kinds = [f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(own.schema.fields)]
    rows = own.mapInArrow(_numberer(len(own.columns)), ", ".join([*kinds, "task int, number long"])).toDF(*own.columns, task, number)
    rows = C.stored(rows, "numbered")  # numbers are of this run of the tasks
    counts = rows.groupBy(shard_col, task).agg(F.count(F.lit(1)).alias(number))
    before = F.sum(number).over(Window.partitionBy(shard_col).orderBy(task).rowsBetween(Window.unboundedPreceding, -1))
    starts = C.stored(counts.select(shard_col, task, F.coalesce(before, F.lit(0)).alias(start)), "starts")
    joined = rows.join(C.few(starts), [shard_col, task])
    return joined.withColumn(slot_col, F.col(start) + F.col(number)).select(*df.columns, slot_col)


def placed(docs: DataFrame, tree: Tree, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (of its columns ``columns``, where given) with size (bytes of the text and one), text_crc32, law, shard, slot and
    grown_shard (the shard in the tree ``grown``; null without one)."""
    kept = [c for c in docs.columns if (columns is None or c in columns) and c not in RESULT]
    docs = docs.drop(*({*RESULT} - {id_col, text_col}))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    own, wide = shard_of(F.col(id_col), tree), F.lit(None).cast("int") if grown is None else shard_of(F.col(id_col), grown)
    df = docs.select(*kept, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), own.alias("shard"), wide.alias("grown_shard"))
    return numbered(df, "shard", "slot")
