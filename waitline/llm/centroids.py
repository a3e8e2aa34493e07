"""Centroid clustering in integers, with scalar lookup tables.

A vector's component x becomes the integer floor(scale * x). Vectors with other
than ``dims`` components, or with a null or non-finite one, take no part.
Centroids start as the kept vectors of smallest sha256 of ``<seed>:<id>`` (ties: the
smaller vector). Each of ``rounds`` rounds assigns every vector to the nearest
centroid (squared Euclidean distance; ties: the smaller number), then replaces each
centroid that has vectors by their componentwise floor(sum / count); at last the
vectors are assigned once more.

*Tables.* The vectors are stored once, in blocks: for each dimension the integers
that occur in the block, ascending, and for each vector the places of its own ones.
A round tabulates, for each dimension, the squared difference of each occurring
integer to each centroid; a vector's distances are its table entries, gathered and
summed with NumPy. Tables are as large as a block at most, whatever the input.

*Sums.* A task adds up its vectors by centroid and dimension; Spark adds the tasks'
sums, cut into 32-bit limbs so that none overflows. The driver sees one sum for each
centroid, dimension and limb. Everything is exact: a block with integers beyond
2**27 is calculated in Python's integers. Distances and inertias that exceed a long
are given as the largest long.

Null and repeated ids count as rows of their own (a null id hashes as an empty one).
With fewer vectors than centroids there are as many centroids as vectors; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024  # a power of two: products are exact
SEED = 3
BLOCK = 4096  # vectors
_NARROW = 1 << 27  # 64 squares of differences of integers to here fit into a long
_LONGEST = (1 << 63) - 1
_COUNT = -1  # in place of a dimension
_BLOCK_KIND = "wide boolean, sizes binary, occurring binary, places binary"


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(id, vector) of the vectors that take part, as doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN exceeds all
    return vectors.where((F.size(vector_col) == dims) & finite).select(F.col(id_col).alias("id"), v.alias("vector"))


def _integer(x: float, scale: int) -> int:
    y = x * scale
    return math.floor(y) if math.isfinite(y) else int(x) * scale


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as longs or, beyond 2**27, as Python's integers."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not y.size or np.abs(y).max() <= _NARROW:
        return y.astype(np.int64)
    return np.array([_integer(v, scale) for v in x.ravel().tolist()], object).reshape(x.shape)


def _blocker(dims: int, scale: int, size: int):
    """(id, vector) -> blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, size):
                ids, lists = batch.column(0).slice(i, size), batch.column(1).slice(i, size)
                x = integers(lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
                wide = x.dtype == object
                occurring, places = zip(*(np.unique(column, return_inverse=True) for column in x.T))
                sizes = np.array([len(v) for v in occurring], np.int32)
                values = np.concatenate(occurring)
                values = json.dumps(values.tolist()).encode() if wide else values.tobytes()
                kind = np.uint16 if len(x) <= 1 << 16 else np.uint32
                rows = [pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([wide])]
                rows += [pa.array([b], pa.binary()) for b in (sizes.tobytes(), values, np.stack(places).astype(kind).tobytes())]
                yield pa.RecordBatch.from_arrays(rows, names=["ids", "wide", "sizes", "occurring", "places"])
        C.give_back()

    return run


def _blocks(batch: pa.RecordBatch, dims: int):
    """(ids, occurring integers of each dimension, places by dimension) of each block."""
    for k in range(batch.num_rows):
        ids = batch.column("ids")[k].values
        wide, sizes, raw, places = (batch.column(c)[k].as_py() for c in ("wide", "sizes", "occurring", "places"))
        values = np.array(json.loads(raw), object) if wide else np.frombuffer(raw, np.int64)
        edges = np.cumsum(np.frombuffer(sizes, np.int32))[:-1]
        kind = np.uint16 if len(ids) <= 1 << 16 else np.uint32
        yield ids, np.split(values, edges), np.frombuffer(places, kind).reshape(dims, -1)


def distances(occurring: list[np.ndarray], places: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Squared distances, a row for each centroid."""
    exact = any(v.dtype == object for v in occurring) or any(abs(c) > _NARROW for own in centroids for c in own)
    total = np.zeros((len(centroids), places.shape[1]), object if exact else np.int64)
    for d, values in enumerate(occurring):
        values = values.astype(total.dtype)
        centre = np.array([own[d] for own in centroids], total.dtype)
        table = (values[None, :] - centre[:, None]) ** 2
        total += table[:, places[d]]
    return total


def _limbs(key: tuple[int, int], total: int) -> Iterator[tuple[int, int, int, int]]:
    """(cluster, dimension, limb, part): total is the sum of part << 32 * limb."""
    limb = 0
    while not -(1 << 31) <= total < 1 << 31:
        yield *key, limb, total & 0xFFFFFFFF
        total >>= 32
        limb += 1
    yield *key, limb, total


_PARTS = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("limb", pa.int32()), ("part", pa.int64())])


def _summer(centroids: list[list[int]], dims: int):
    """Blocks -> the task's counts and sums by nearest centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, occurring, places in _blocks(batch, dims):
                nearest = distances(occurring, places, centroids).argmin(axis=0)
                x = np.stack([v[p] for v, p in zip(occurring, places)])
                for k in np.unique(nearest).tolist():
                    own = x[:, nearest == k]
                    sums[k, _COUNT] = sums.get((k, _COUNT), 0) + own.shape[1]
                    for d, s in enumerate(own.sum(axis=1).tolist()):
                        sums[k, d] = sums.get((k, d), 0) + s
        columns = list(zip(*(row for key, total in sums.items() for row in _limbs(key, total)))) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PARTS)], schema=_PARTS)
        C.give_back()

    return run


def _assigner(centroids: list[list[int]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, occurring, places in _blocks(batch, dims):
                far = distances(occurring, places, centroids)
                nearest = far.argmin(axis=0)
                own = [min(int(x), _LONGEST) for x in far[nearest, np.arange(far.shape[1])]]
                yield pa.RecordBatch.from_arrays([ids, pa.array(nearest, pa.int32()), pa.array(own, pa.int64())], names=["id", "cluster", "distance"])
        C.give_back()

    return run


# ------------------------------------------------------------ operator


def first_centroids(kept: DataFrame, clusters: int, scale: int, seed: int) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = kept.select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(clusters).collect()
    return [[_integer(x, scale) for x in r.vector] for r in rows]


def clustered(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = DIMS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each
    vector that takes part; the digest is of the final centroid's components, in
    decimal, joined by commas."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, id_col, vector_col, dims)
    kind = kept.schema["id"].dataType.simpleString()
    blocks = C.stored(kept.mapInArrow(_blocker(dims, scale, BLOCK), f"ids array<{kind}>, {_BLOCK_KIND}"), "blocks")
    centroids = first_centroids(kept, clusters, scale, seed)
    for _ in range(rounds if centroids else 0):
        parts = blocks.mapInArrow(_summer(centroids, dims), "cluster int, dim int, limb int, part long")
        # bounded: a row for each cluster, dimension and limb
        totals: dict[tuple[int, int], int] = {}
        for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part")).collect():
            totals[r.cluster, r.dim] = totals.get((r.cluster, r.dim), 0) + (r.part << 32 * r.limb)
        centroids = [[totals[k, d] // totals[k, _COUNT] for d in range(dims)] if (k, _COUNT) in totals else own for k, own in enumerate(centroids)]
    found = C.stored(blocks.mapInArrow(_assigner(centroids, dims), f"id {kind}, cluster int, distance long"), "assigned")
    inertia = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = sum(inertia.values())
    rows = [(k, min(x, _LONGEST), min(whole, _LONGEST), hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for k, x in inertia.items()]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
