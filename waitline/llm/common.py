"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word of every contract of this subpackage: a run without these bytes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: what the session names in
    ``spark.checkpoint.dir``. A session of one process without one (tests) gets
    a scratch folder, once; on a cluster it must be set."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="waitline-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/waitline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage,
    survives lost executors and is computed once for several consumers."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of short keys that are broadcast at most (about 64 MB); more are shuffled.
MOST_BROADCAST = 1_000_000


def few(keys: DataFrame) -> DataFrame:
    """``keys`` (stored, short rows) marked for a broadcast if it has no more than
    MOST_BROADCAST rows; beyond that a join shuffles both sides."""
    return F.broadcast(keys) if keys.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else keys


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (case ignored)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def power_of_two(n: float, least: int, most: int | None = None) -> int:
    p = least
    while p < n and (most is None or p < most):
        p *= 2
    return p


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


# ------------------------------------------------------------ inside tasks


#: Where ``tokens`` keeps a process's word tables.
WORD_TABLES = "_waitline_word_tables"


def drop_tables() -> None:
    """For tasks of other work: a worker needs the word tables of earlier tasks no
    more."""
    if sys.modules.pop(WORD_TABLES, None) is not None:
        give_back()


def give_back() -> None:
    """Returns a task's freed memory to the system: Python workers live on, and
    idle, after a task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without copying; a null is
    an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def is_space(data: np.ndarray) -> np.ndarray:
    return _IS_SPACE[data]


def slices(offsets: np.ndarray, most: int):
    """Ranges [i, j) of texts of about ``most`` bytes together, one text at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of adjoining texts, and for each text
    the index of its first word (one entry more at the end)."""
    word = ~_IS_SPACE[data]
    if not len(word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(word))]
    start = word.copy()
    start[1:] &= ~word[:-1]
    start[cut] = word[cut]
    end = word.copy()
    end[:-1] &= ~word[1:]
    end[cut - 1] = word[cut - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


_MUL = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 64), _MUL)
        steps[0] = 1
        _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, finalised.
    ``most``: bytes of text worked on at a time, a word at least."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + most, "right")))
        length = ends[i:j] - starts[i:j]
        first = np.cumsum(length) - length
        at = np.arange(int(length.sum())) - np.repeat(first, length)
        raw = data[np.repeat(starts[i:j], length) + at].astype(np.uint64) + np.uint64(1)
        raw *= _powers(int(length.max()))[at]
        out[i:j] = mixed(np.add.reduceat(raw, first) + length.astype(np.uint64))
        i = j
    return out


_PLACES = 64  # of a word, with random numbers of their own


def random_table(seed: int) -> np.ndarray:
    """A random number for each of _PLACES places and each byte."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(1)) * _MUL + mixed(np.array([seed], np.uint64)))


def tabulated(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word by tabulation: the numbers of its bytes at their
    places, added up and finalised; each further _PLACES bytes count times an odd
    number of their own. Other than of a polynomial, no two words are known to
    share it, and hashes from tables of other seeds are independent. ``most``: see
    ``word_hashes``."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + most, "right")))
        length = ends[i:j] - starts[i:j]
        first = np.cumsum(length) - length
        at = np.arange(int(length.sum())) - np.repeat(first, length)
        value = table[(at % _PLACES << 8) + data[np.repeat(starts[i:j], length) + at]]
        if int(length.max()) > _PLACES:
            value *= mixed((at // _PLACES).astype(np.uint64) * _MUL) | np.uint64(1)
        out[i:j] = mixed(np.add.reduceat(value, first) + length.astype(np.uint64))
        i = j
    return out
