"""Exact top-k search by inner product with a pivot-distance index.

Vectors are turned into integers, floor(256 * x). The largest inner products are
nearest neighbours once every vector gets one more component, sqrt(M - |x|^2) with
M the largest |x|^2, and queries get 0: then |q - x|^2 = |q|^2 + M - 2 q.x.

Index. Pivots are vectors of a bounded sample (``SAMPLE`` rows of smallest hash),
far from each other. Every vector is keyed by its nearest pivot and its distance
to it, and the table is sorted by (pivot, distance, id) into blocks of ``BLOCK``
rows: annuli around a pivot. Range partitioning on that key splits a pivot, or
copies of one vector, over as many tasks as they need. The index is written to
the shared folder.

Search. By the triangle inequality a vector in an annulus [lo, hi] of pivot p is
no nearer to q than the gap between d(q, p) and [lo, hi], so no product in it
exceeds (|q|^2 + M - gap^2) / 2. Queries go in chunks of ``QUERIES``, a bounded
broadcast, over all blocks, in two expansions:
first each query looks into the blocks around its own distance to its nearest
pivot, which gives it k candidates and so a least score; then every task visits
its blocks in order of their bounds and stops a query where the bound falls below
the least score that the query has, there or from the first expansion. A task
emits k rows a query id at most, and they are merged by an aggregate. Chunks are
cut by a number that the stored query rows have, not by id; rows of one id share
its k results, also over several chunks.

Bounds are in double precision with a margin; scores are exact integers (float
products are used only where they are exact). Ties go to the smaller id.

Vectors that are null or hold null or non-finite components take no part. A
shorter vector counts as padded with zeros. Rows that share an id are candidates
one by one (a query never meets a row of its own id); an id that is null takes no
part. Vectors with a finite component over ``_LARGE / scale`` in size are kept apart
from the index, as doubles, in blocks that every query visits, and as queries they
visit every block; their products are of Python's integers. A score beyond a 64-bit
integer is given as the nearest one, after ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PIVOTS = 64
SAMPLE = 4096  # vectors that pivots are chosen from
BLOCK = 1024
QUERIES = 16_384  # of a chunk
SCALE = 256
_LARGE = 2.0**60  # scaled components beyond it are not kept as 64-bit integers
_TASK = 512  # queries that a task compares at a time


def integral(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> tuple[DataFrame, DataFrame]:
    """(id, v array<long>): floor(scale * x) of each vector that takes part; and (id,
    v array<double>), unscaled, of those with large components."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    fine = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    fine = fine.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = fine.where(~F.coalesce(bad, F.lit(True)))
    large = F.exists("v", lambda x: F.abs(x) > _LARGE / scale)
    return fine.where(~large).select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v")), fine.where(large)


def exact(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles as Python's integers."""
    one = lambda a: math.floor(a * scale) if abs(a) < 2.0**900 else int(a) * scale
    return np.array([one(a) for a in x.ravel().tolist()], object).reshape(x.shape)


def _matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), kind)
    if len(n):
        out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exactly."""
    if object in (a.dtype, b.dtype):
        return np.array(a.astype(object) @ b.T.astype(object), object).reshape(len(a), len(b))
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return np.array(a.astype(object) @ b.T.astype(object), object).reshape(len(a), len(b))


def _lifted(v: np.ndarray, largest: float) -> np.ndarray:
    x = v.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0))[:, None]], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Rows of the sample, each the farthest from those before it."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(pivots, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _keyer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, largest, pivots = model.value
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                d = _distances(_lifted(_matrix(part.column(1), width), largest), pivots)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])], names=["id", "v", "pivot", "distance"])

    return run


def _blocker(width: int):
    """Rows sorted by (pivot, distance) to blocks of one pivot each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def blocks(table: pa.Table, last: bool):
            pivot = table.column("pivot").to_numpy()
            at = 0
            while at < len(pivot):
                stop = min(at + BLOCK, int(np.searchsorted(pivot, pivot[at], "right")))
                if stop == len(pivot) and stop - at < BLOCK and not last:
                    break
                part = table.slice(at, stop - at)
                d = part.column("distance").to_numpy()
                body = _matrix(part.column("v"), width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(pivot[at])], pa.int32()), pa.array([d[0]]), pa.array([d[-1]]), pa.array([part.column("id").to_numpy().tobytes()], pa.binary()), pa.array([body.tobytes()], pa.binary())],
                    names=["pivot", "lo", "hi", "ids", "vectors"],
                )
                at = stop
            held[:] = [table.slice(at)]

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= 4 * BLOCK:
                yield from blocks(pa.concat_tables(held), False)
        if held:
            yield from blocks(pa.concat_tables(held), True)

    return run


def _large_blocker(width: int):
    """Rows (id, v array<double>) to blocks of pivot -1, with doubles as vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK):
                part = batch.slice(i, BLOCK)
                ids, body = part.column(0).to_numpy(), _matrix(part.column(1), width, np.float64)
                cols = [pa.array([-1], pa.int32()), pa.array([0.0]), pa.array([0.0]), pa.array([ids.tobytes()], pa.binary()), pa.array([body.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["pivot", "lo", "hi", "ids", "vectors"])

    return run


def _as_float(x: int) -> float:
    try:
        return float(x)
    except OverflowError:
        return math.inf if x > 0 else -math.inf


_MOST = (1 << 63) - 1


def _beyond(s: int) -> bytes:
    """For scores that are not told apart in 64 bits: bytes that ascend as they fall."""
    if -_MOST - 1 < s < _MOST:
        return b""
    raw = abs(s).to_bytes(abs(s).bit_length() // 8 + 1, "big")
    raw = len(raw).to_bytes(4, "big") + raw
    return bytes(255 - x for x in raw) if s > 0 else raw


class _Best:
    """The k best (score, id) of each query."""

    def __init__(self, k: int, n: int):
        self.k, self.rows = k, [[] for _ in range(n)]

    def least(self, i: int):
        return self.rows[i][-1][0] if len(self.rows[i]) == self.k else None

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray):
        k = self.k
        if len(scores) > 4 * k and scores.dtype != object:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= edge
            scores, ids = scores[keep], ids[keep]
            if len(scores) > 4 * k:  # many ties at the edge: the smallest ids
                tied = np.flatnonzero(scores == edge)
                keep = np.concatenate([np.flatnonzero(scores > edge), tied[np.argsort(ids[tied], kind="stable")[:k]]])
                scores, ids = scores[keep], ids[keep]
        rows = self.rows[i] + [(int(s), int(x)) for s, x in zip(scores, ids)]
        self.rows[i] = sorted(rows, key=lambda r: (-r[0], r[1]))[:k]


def _bounds(gap: np.ndarray, norms: np.ndarray, largest: float) -> np.ndarray:
    """What no product exceeds at that gap, with a margin for rounding."""
    top = (norms + largest - gap * gap) / 2
    return top + 1e-9 * (norms + largest) + 1


def _searcher(model, chunk, k: int, first: bool, scale: int):
    """chunk: a broadcast of (ids, vectors, least scores or None) of queries; vectors
    are doubles for large ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, largest, pivots = model.value
        qids, queries, known = chunk.value
        large = queries.dtype == np.float64
        lifted = np.concatenate([np.zeros(queries.shape) if large else queries.astype(np.float64), np.zeros((len(queries), 1))], axis=1)
        queries = exact(queries, scale) if large else queries
        to_pivot, norms = _distances(lifted, pivots), (lifted * lifted).sum(axis=1)
        nearest = to_pivot.argmin(axis=1)
        best = _Best(k, len(qids))
        least = np.full(len(qids), -np.inf) if known is None else known.copy()
        for batch in batches:
            blocks = []
            for p, lo, hi, ids, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
                ids = np.frombuffer(ids, np.int64)
                vectors = np.frombuffer(raw, np.int64 if p >= 0 else np.float64).reshape(len(ids), width)
                blocks.append((p, lo, hi, ids, vectors))
            gaps = np.stack([np.maximum(np.maximum(to_pivot[:, p] - hi, lo - to_pivot[:, p]), 0) for p, lo, hi, _, _ in blocks])
            bound = _bounds(gaps, norms, largest)
            bound[[large or b[0] < 0 for b in blocks]] = np.inf
            if first:
                wanted = np.stack([(nearest == b[0]) for b in blocks]) & (gaps == 0)
            for j in np.argsort(-bound.max(axis=1)):  # annuli in order of their bounds
                ids, vectors = blocks[j][3], blocks[j][4]
                if blocks[j][0] < 0 and not first:
                    vectors = exact(vectors, scale)
                active = np.flatnonzero(wanted[j] if first else bound[j] >= least)
                for i in range(0, len(active), _TASK):
                    own = active[i : i + _TASK]
                    scores = products(queries[own], vectors)
                    top = scores.max(axis=1)
                    for a in np.flatnonzero(top >= least[own]) if scores.dtype != object else range(len(own)):
                        q = own[a]
                        other = ids != qids[q]
                        s, x = scores[a][other], ids[other]
                        if s.dtype != object and np.isfinite(least[q]):
                            near = s >= least[q]
                            s, x = s[near], x[near]
                        best.add(q, s, x)
                        if (now := best.least(q)) is not None:
                            least[q] = max(least[q], _as_float(now))
        found = {}
        for q in range(len(qids)):
            found.setdefault(int(qids[q]), []).append(best.rows[q])
        rows = []
        for q, parts in found.items():
            own = parts[0] if len(parts) == 1 else sorted((r for part in parts for r in part), key=lambda r: (-r[0], r[1]))[:k]
            rows += [(q, s, x) for s, x in own]
        cols = list(zip(*rows)) or [[], [], []]
        clip = [max(-_MOST - 1, min(_MOST, s)) for s in cols[1]]
        beyond = [_beyond(s) for s in cols[1]]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(clip, pa.int64()), pa.array(beyond, pa.binary()), pa.array(cols[2], pa.int64())], names=["query_id", "score", "beyond", "vec_id"])

    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("s"), "beyond", "vec_id", "score"))), 1, k)
    return found.groupBy("query_id").agg(best.alias("best"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of ``vectors`` of largest
    integer inner product with each of ``queries`` (the same columns), but for
    rows of the query's own id."""
    spark = vectors.sparkSession
    schema = "query_id long, score long, beyond binary, vec_id long"
    own, own_large = (C.stored(x, "vectors") for x in integral(vectors, id_col, vector_col, scale))
    number = F.monotonically_increasing_id()  # stored with the rows: one for each, for good
    asked, asked_large = (C.stored(x.repartitionByRange("id").sortWithinPartitions("id").withColumn("number", number), "queries") for x in integral(queries, id_col, vector_col, scale))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    wide = own.select(F.size("v").alias("n"), square.alias("s")).unionAll(asked.select(F.size("v"), F.lit(0.0)))
    wide = wide.unionAll(own_large.unionAll(asked_large.drop("number")).select(F.size("v"), F.lit(0.0))).agg(F.max("n"), F.max("s")).first()
    width, largest = wide[0] or 0, float(wide[1] or 0.0)
    sample = own.select("v").orderBy(F.xxhash64("id", "v")).limit(SAMPLE).toArrow()
    sample = _lifted(_matrix(sample.column("v"), width), largest) if sample.num_rows else np.zeros((0, width + 1))
    chosen = choose_pivots(sample, pivots) if len(sample) else np.zeros((1, width + 1))
    model = spark.sparkContext.broadcast((width, largest, chosen))
    keyed = own.mapInArrow(_keyer(model), "id long, v array<long>, pivot int, distance double")
    order = ["pivot", "distance", "id"]
    index = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocker(width), "pivot int, lo double, hi double, ids binary, vectors binary")
    large = own_large.mapInArrow(_large_blocker(width), "pivot int, lo double, hi double, ids binary, vectors binary")
    index = C.stored(index.unionAll(large), "index")
    found, chunks = None, 0
    for rows, kind in ((asked, np.int64), (asked_large, np.float64)):
        low = None
        for _ in range(-(-rows.count() // QUERIES)):  # the queries in chunks, by their number
            part = (rows if low is None else rows.where(F.col("number") > low)).orderBy("number").limit(QUERIES).toArrow()
            ids, q = part.column("id").to_numpy(), _matrix(part.column("v"), width, kind)
            low = part.column("number")[-1].as_py()
            least = None
            if kind is np.int64:
                near = _merged(index.mapInArrow(_searcher(model, spark.sparkContext.broadcast((ids, q, None)), k, True, scale), schema), k)
                near = near.where(F.size("best") == k).select("query_id", F.element_at("best", k)["score"].alias("least")).collect()  # at most QUERIES
                known = {r.query_id: float(r.least) for r in near if r.least > -_MOST - 1}
                least = np.array([known.get(int(i), -np.inf) for i in ids])
            best = _merged(index.mapInArrow(_searcher(model, spark.sparkContext.broadcast((ids, q, least)), k, False, scale), schema), k)
            found = best if found is None else found.unionAll(best)
            chunks += 1
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if chunks > 1:  # an id's rows can be in several
        found = _merged(found.select("query_id", F.inline("best")).drop("s"), k)
    rows = found.select("query_id", F.posexplode("best").alias("rank", "b"))
    return rows.select("query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", "b.score")
