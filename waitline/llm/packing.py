"""Best-fit packing by exact-complement hashing.

A document is its token ids and an end id; only one longer than ``size`` is
cut, into pieces of ``size`` ids, the last of which may be shorter. Pieces go
whole into sequences of ``size`` places, as few as can be.

1. Tasks tokenise and write a row for each piece: length, start, CRC, the
   task's number and the piece's rank among that task's pieces of its length.
2. The histogram of lengths (``size`` numbers, whatever the corpus) decides the
   packing. From the longest length down, the gap it leaves is looked up among
   indexes of single lengths, of sums of pairs and of sums of triples; a
   combination that fills it exactly is consumed as often as its lengths are
   available. Lengths without exact complement are left, and best-fit puts the
   residuals, longest first, into the fullest open sequence with room. All in
   bulk: a step settles all sequences alike, so there are about as many steps
   as lengths, not as pieces.
3. Steps say which ranks of a length go where (runs of ranks, a table of
   bounded size). A piece's rank over all tasks is that in its task plus the
   number of pieces of its length in earlier tasks; a binary search over the
   broadcast runs gives its sequence and offset. A length that a third of all
   documents share needs no group of its own.

A null text is empty: its one piece is the end id. Rows with null or equal ids
are packed one by one; ids may repeat in the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

SIZE = 4096
END = 1


# ------------------------------------------------------------ pieces


_PIECE = "doc_id {}, piece int, start long, length long, ids_crc32 long, task long, rank long"


def _cutter(path: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, task = T.table_of(path), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            rows = []
            for k, ids in enumerate(T.documents(table, batch.column(1))):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), size)):
                    part = ids[at : at + size]
                    rows.append((k, piece, at, len(part), zlib.crc32(part.tobytes()), seen[len(part)]))
                    seen[len(part)] += 1
            cols = [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cols[0])), pa.array(cols[1].astype(np.int32)), *(pa.array(c) for c in cols[2:5]), pa.array(np.full(len(cols[0]), task)), pa.array(cols[5])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )
        C.give_back()

    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and task and rank (see above)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(_cutter(tokenizer or T.path_of(), size, end), _PIECE.format(kind))


# ------------------------------------------------------------ plan


class _Plan:
    """Runs of ranks of a length: (length, first rank, ranks, ranks in a
    sequence, first sequence, offset)."""

    def __init__(self, counts: np.ndarray):
        self.left, self.taken = counts.copy(), np.zeros_like(counts)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0

    def put(self, length: int, sequences: int, each: int, first: int, offset: int):
        n = sequences * each
        self.runs.append((length, int(self.taken[length]), n, each, first, offset))
        self.taken[length] += n
        self.left[length] -= n


def _pair(left: np.ndarray, total: int, used: dict[int, int]) -> tuple[int, int] | None:
    """Two available lengths of that sum, the longest first; ``used``: lengths
    that the combination holds already."""
    if total < 2:
        return None
    a = np.arange(total - 1, (total + 1) // 2 - 1, -1)
    have = left.copy()
    for x, n in used.items():
        have[x] -= n
    ok = (have[a] > 0) & (have[total - a] > 0) & ((a != total - a) | (have[a] > 1))
    k = int(np.argmax(ok))
    return (int(a[k]), int(total - a[k])) if ok[k] else None


def _complement(left: np.ndarray, length: int, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that fill the gap beside ``length``."""
    used = {length: 1}
    if left[gap] - used.get(gap, 0) > 0:
        return (gap,)
    if found := _pair(left, gap, used):
        return found
    for a in range(min(gap - 2, length), (gap + 2) // 3 - 1, -1):
        n = used.get(a, 0) + 1
        if left[a] >= n and (found := _pair(left, gap - a, used | {a: n})):
            return (a, *found)
    return None


def plan(counts: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, int]:
    """The runs for ``counts[l]`` pieces of each length l, and the number of
    sequences."""
    p = _Plan(counts)
    residual = np.zeros_like(counts)
    for length in range(size, 0, -1):
        while p.left[length] > 0:
            if length == size:
                p.put(length, int(p.left[length]), 1, p.sequences, 0)
                p.sequences += p.runs[-1][2]
                continue
            found = _complement(p.left, length, size - length)
            if found is None:
                residual[length] = p.left[length]
                p.left[length] = 0
                break
            need: dict[int, int] = {}
            for x in (length, *found):
                need[x] = need.get(x, 0) + 1
            times = min(int(p.left[x]) // n for x, n in need.items())
            offset = 0
            for x, n in need.items():
                p.put(x, times, n, p.sequences, offset)
                offset += x * n
            p.sequences += times
    p.left = residual
    _best_fit(p, size)
    return np.array(p.runs, np.int64).reshape(-1, 6), p.sequences


def _best_fit(p: _Plan, size: int) -> None:
    """The longest length first, into the fullest sequences that have room."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by room: (first sequence, sequences)
    for length in range(size, 0, -1):
        for gap in range(length, size + 1):
            while p.left[length] and room[gap]:
                first, n = room[gap].pop()
                each = min(gap // length, max(1, int(p.left[length]) // n))
                taken = min(n, int(p.left[length]) // each)
                p.put(length, taken, each, first, size - gap)
                room[gap - each * length].append((first, taken))
                if taken < n:
                    room[gap].append((first + taken, n - taken))
        if n := int(p.left[length]):
            each = min(size // length, n)
            for each, times in ((each, n // each), (n % each, 1)):
                if each:
                    first, p.sequences = p.sequences, p.sequences + times
                    p.put(length, times, each, first, 0)
                    room[size - each * length].append((first, times))


# ------------------------------------------------------------ places


def _placer(runs):
    """runs: a broadcast of the runs, ascending by length and rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        bound = table[:, 0] * (1 << 48) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = table[np.searchsorted(bound, length * (1 << 48) + rank, "right") - 1]
            step, slot = np.divmod(rank - at[:, 1], at[:, 3])
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(at[:, 4] + step), pa.array(at[:, 5] + slot * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for
    each piece of every row of ``docs``."""
    spark = docs.sparkSession
    cut = C.stored(pieces(docs, id_col, text_col, tokenizer, size, end), "pieces")
    by_task = C.stored(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(size + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        counts[r.length] = r.n
    runs, _ = plan(counts, size)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_task.select(F.col("task").alias("_task"), F.col("length").alias("_length"), F.coalesce(earlier, F.lit(0)).alias("_earlier"))
    ranked = cut.join(offsets, (cut["task"] == F.col("_task")) & (cut["length"] == F.col("_length")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("_earlier")).alias("rank"))
    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(_placer(spark.sparkContext.broadcast(runs)), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
