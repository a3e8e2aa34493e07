"""Token-id files coded by an adaptive context-mixing range coder.

A file is a run of blocks. A block starts every model anew, carries its own
checksums and decodes by itself:

    "WLTK", u32 CRC-32 of the rest of the header and the body, u32 bytes of body,
    u32 ids, u32 vocabulary, u32 lanes, u32 bytes of the document table; then the
    table (zlib: id, null mark, ids in this block, continues mark), u32 CRC-32 of
    the ids, the words of each lane (u16 counts), the lanes' words (u32), "\\n".

A block's ids are cut into ``lanes`` runs that are coded side by side, one id of
each lane a step, so that a step is a handful of array operations. All lanes
share the models of the block, which a step updates for all of them:

* order 2: the id last seen after the two before it (hashed), with a confidence;
* order 1: the id last seen after the one before it, with a confidence;
* order 0: how often each id has occurred in the block, refreshed as it grows.

The probability of an id mixes the three: weight(order 2) if it is that
prediction + weight(order 1) if it is that one + weight(order 0) * frequency.
The weights are adaptive too: for each pair of confidences, how often either
prediction has been right so far. A 64-bit range coder with 32-bit words and
24-bit totals codes each lane; the decoder repeats every update.

Documents are written in ascending order of id (null first; equal ids by their
text's hash). An empty text has the end id alone. A null text is empty.
Writing and reading go through Spark's file sources, so any store works. A file
is read by one task, whole: ``write`` makes as many files as Spark has
partitions, and a partition should be the size of a task's input.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import tokens as T

END = 2
VOCABULARY = 49_408
BLOCK = 1 << 20  # ids
LANES = 8192
TOTAL_BITS = 24
CONTEXT_BITS = 18  # of the order-2 table
LEAST_ZERO = 1 << 20  # weight that order 0 keeps at least, of 1 << 24
LEAST_FREQUENCY = 16  # of an id in order 0, so that its share of LEAST_ZERO is one at least

_MAGIC = b"WLTK"
_HEAD = "<4sIIIIII"
_HEAD_SIZE = struct.calcsize(_HEAD)
_TOTAL = 1 << TOTAL_BITS
_U = np.uint64


class _Model:
    """The three predictions and their weights for the lanes of one block."""

    def __init__(self, lanes: int, vocabulary: int):
        if vocabulary * LEAST_FREQUENCY >= _TOTAL // 2:
            raise ValueError(f"vocabulary of {vocabulary} ids: at most {_TOTAL // 2 // LEAST_FREQUENCY - 1}")
        self.vocabulary = vocabulary
        self.one, self.two = np.zeros(vocabulary, np.int64), np.zeros(1 << CONTEXT_BITS, np.int64)
        self.before, self.last = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.seen, self.fresh = np.zeros(vocabulary, np.int64), []
        # right by order 2, else by order 1, else neither; for each pair of confidences
        self.right = np.tile(np.array([1, 1, 2], np.int64), (256, 1))
        self.step = 0
        self._refresh()

    def _refresh(self):
        if self.fresh:
            self.seen += np.bincount(np.concatenate(self.fresh), minlength=self.vocabulary)
            self.fresh = []
        free = _TOTAL - LEAST_FREQUENCY * self.vocabulary
        share = self.seen * free // max(1, int(self.seen.sum()))
        share[0] += free - share.sum()
        self.table = np.concatenate([[0], np.cumsum(share + LEAST_FREQUENCY)])

    def predict(self):
        self.at = (((self.last * 0x9E3779B1 + self.before * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - CONTEXT_BITS))
        self.v2, self.v1 = self.two[self.at], self.one[self.last]
        self.e2, self.e1 = self.v2 >> 4, self.v1 >> 4
        self.state = (self.v2 & 15) << 4 | (self.v1 & 15)
        all_ = self.right.sum(axis=1)
        w2 = (_TOTAL - LEAST_ZERO) * self.right[:, 0] // all_
        w1 = (_TOTAL - LEAST_ZERO) * self.right[:, 1] // all_
        self.w2, self.w1 = w2[self.state], w1[self.state]
        self.w0 = _TOTAL - self.w2 - self.w1

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the ids' intervals, of a total of 1 << 24."""
        low = (self.table[x] * self.w0 >> TOTAL_BITS) + (self.e2 < x) * self.w2 + (self.e1 < x) * self.w1
        high = (self.table[x + 1] * self.w0 >> TOTAL_BITS) + (self.e2 <= x) * self.w2 + (self.e1 <= x) * self.w1
        return low, high - low

    def find(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold ``v``, and these intervals."""
        low2, wide2 = self.interval(self.e2)
        low1, wide1 = self.interval(self.e1)
        is2 = (v >= low2) & (v < low2 + wide2)
        x, low, wide = np.where(is2, self.e2, self.e1), np.where(is2, low2, low1), np.where(is2, wide2, wide1)
        k = np.flatnonzero(~is2 & ((v < low1) | (v >= low1 + wide1)))
        if len(k):
            w0, above2, above1 = self.w0[k], v[k] >= (low2 + wide2)[k], v[k] >= (low1 + wide1)[k]
            aside = above2 * self.w2[k] + above1 * self.w1[k]
            place = (((v[k] - aside + 1) << TOTAL_BITS) - 1) // w0
            order = np.argsort(place)  # ascending needles are found much faster
            own = np.empty(len(k), np.int64)
            own[order] = np.searchsorted(self.table, place[order], "right") - 1
            start = self.table[own] * w0 >> TOTAL_BITS
            x[k], low[k], wide[k] = own, start + aside, (self.table[own + 1] * w0 >> TOTAL_BITS) - start
        return x, low, wide

    def update(self, x: np.ndarray):
        hit2, hit1 = self.e2 == x, self.e1 == x
        outcome = np.where(hit2, 0, np.where(hit1, 1, 2))
        self.right += np.bincount(self.state * 3 + outcome, minlength=768).reshape(256, 3)
        for table, at, v, e, hit in ((self.two, self.at, self.v2, self.e2, hit2), (self.one, self.last, self.v1, self.e1, hit1)):
            c = v & 15
            table[at] = np.where(hit, v + (c < 15), np.where(c > 0, e << 4 | c >> 1, x << 4 | 1))
        self.before, self.last = self.last, x
        self.fresh.append(x)
        self.step += 1
        if self.step & (self.step - 1) == 0 or self.step % 32 == 0:
            self._refresh()


def _encode_lanes(rows: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """rows[t]: the t-th id of each lane. The lanes' words one lane after the
    other, and how many each has."""
    steps, lanes = rows.shape
    model = _Model(lanes, vocabulary)
    low, wide = np.zeros(lanes, _U), np.full(lanes, ~_U(0))
    out, n = np.zeros((steps + 2, lanes), _U), np.zeros(lanes, np.int64)
    for x in rows:
        model.predict()
        start, width = model.interval(x)
        unit = wide >> _U(TOTAL_BITS)
        moved = low + unit * start.view(_U)
        k = np.flatnonzero(moved < low)
        out[n[k] - 1, k] += _U(1)  # carries are settled at the end
        low, wide = moved, unit * width.view(_U)
        k = np.flatnonzero(wide < _U(1 << 32))
        out[n[k], k] = low[k] >> _U(32)
        n[k] += 1
        low[k] <<= _U(32)
        wide[k] <<= _U(32)
        model.update(x)
    every = np.arange(lanes)
    for _ in range(2):
        out[n, every] = low >> _U(32)
        n += 1
        low <<= _U(32)
    for t in range(len(out) - 1, 0, -1):
        out[t - 1] += out[t] >> _U(32)
        out[t] &= _U(0xFFFFFFFF)
    return out.T[np.arange(len(out)) < n[:, None]].astype("<u4"), n


def _decode_lanes(words: np.ndarray, n: np.ndarray, steps: int, vocabulary: int) -> np.ndarray:
    lanes = len(n)
    model = _Model(lanes, vocabulary)
    first = np.cumsum(n) - n
    padded = np.append(words, np.zeros(1, "<u4")).astype(_U)
    code = padded[first] << _U(32) | padded[first + 1]
    wide, at = np.full(lanes, ~_U(0)), first + 2
    out = np.empty((steps, lanes), np.int64)
    for t in range(steps):
        model.predict()
        unit = wide >> _U(TOTAL_BITS)
        v = np.minimum(code // unit, _U(_TOTAL - 1)).view(np.int64)
        x, start, width = model.find(v)
        code -= unit * start.view(_U)
        wide = unit * width.view(_U)
        k = np.flatnonzero(wide < _U(1 << 32))
        code[k] = code[k] << _U(32) | padded[at[k]]
        at[k] += 1
        wide[k] <<= _U(32)
        model.update(x)
        out[t] = x
    return out


def encode_block(ids: np.ndarray, docs: list[tuple[int | None, int, bool]], vocabulary: int = VOCABULARY) -> bytes:
    """docs: (id, ids in this block, whether it goes on from the block before)."""
    lanes = max(1, min(LANES, len(ids) // 64))
    steps = -(-len(ids) // lanes)
    rows = np.zeros(lanes * steps, np.int64)
    rows[: len(ids)] = ids
    words, n = _encode_lanes(np.ascontiguousarray(rows.reshape(lanes, steps).T), vocabulary)
    table = np.array([(d or 0, d is None, k, goes_on) for d, k, goes_on in docs], "<i8").reshape(-1, 4)
    table = zlib.compress(np.ascontiguousarray(table.T).tobytes(), 1)
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    body = b"".join([table, struct.pack("<I", crc), n.astype("<u2").tobytes(), words.tobytes()])
    head = struct.pack(_HEAD, _MAGIC, 0, len(body), len(ids), vocabulary, lanes, len(table))[8:]
    return _MAGIC + struct.pack("<I", zlib.crc32(body, zlib.crc32(head))) + head + body


def decode_blocks(raw: bytes | memoryview) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, document table) of each block of a file; raises on damage."""
    at, raw = 0, memoryview(raw)
    while at < len(raw):
        magic, crc, size, ids, vocabulary, lanes, table_size = struct.unpack_from(_HEAD, raw, at)
        body = raw[at + _HEAD_SIZE : at + _HEAD_SIZE + size]
        if magic != _MAGIC or len(body) < size or zlib.crc32(body, zlib.crc32(raw[at + 8 : at + _HEAD_SIZE])) != crc:
            raise ValueError(f"damaged block at byte {at}")
        table = np.frombuffer(zlib.decompress(body[:table_size]), "<i8").reshape(4, -1).T
        (ids_crc,) = struct.unpack_from("<I", body, table_size)
        n = np.frombuffer(body, "<u2", lanes, table_size + 4).astype(np.int64)
        words = np.frombuffer(body, "<u4", int(n.sum()), table_size + 4 + 2 * lanes)
        out = _decode_lanes(words, n, -(-ids // lanes), vocabulary).T.ravel()[:ids].astype("<u4")
        if zlib.crc32(out.tobytes()) != ids_crc:
            raise ValueError(f"block at byte {at}: its ids don't match their checksum")
        yield out, table
        at += _HEAD_SIZE + size + 1


# ------------------------------------------------------------ files


def _encoder(path: str, end: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = T.table_of(path)
        held, docs, size = [], [], 0

        def block() -> pa.RecordBatch:
            raw = encode_block(np.concatenate(held), docs, vocabulary)
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["block"])

        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, ids in zip(names, T.documents(words, batch.column(1))):
                ids, goes_on = np.append(ids, np.uint32(end)), False
                while len(ids):
                    part, ids = ids[: BLOCK - size], ids[BLOCK - size :]
                    held.append(part)
                    docs.append((name, len(part), goes_on))
                    size, goes_on = size + len(part), True
                    if size == BLOCK:
                        yield block()
                        held, docs, size = [], [], 0
        if size:
            yield block()
        held = []
        C.give_back()

    return run


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end: int = END, vocabulary: int = VOCABULARY) -> None:
    """Writes the token ids of every text, each with the end id, to files under
    ``path``: their names ascend with the documents' ids."""
    one = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    dealt = one.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = dealt.mapInArrow(_encoder(tokenizer or T.path_of(), end, vocabulary), "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def _decoder(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                rows, start, last = [], 0, None

                def flush(rows):
                    cols = [list(c) for c in zip(*rows)]
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
                    names = ["id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
                    return pa.RecordBatch.from_arrays(
                        [pa.array([file.as_py()] * len(rows), pa.string()), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["file", *names]
                    )

                for ids, table in decode_blocks(content.as_buffer()):
                    at = 0
                    for name, null, n, goes_on in table.tolist():
                        part = ids[at : at + n]
                        at += n
                        if goes_on:
                            last = [*last[:2], last[2] + n, zlib.crc32(part.tobytes(), last[3]), *(np.append(x, part) for x in last[4:])]
                        else:
                            if last:
                                rows.append(last)
                            last = [None if null else name, start, n, zlib.crc32(part.tobytes())] + [part] * with_ids
                            start += n
                            continue
                        start += n
                    if rows:
                        yield flush(rows)
                        rows = []
                if last:
                    yield flush([last])

    return run


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row for each document of the files under ``path``: id, start (ids of
    all documents before it), n_tokens, ids_crc32; and its ids if asked for."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = "file string, id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    found = files.mapInArrow(_decoder(with_ids), schema)
    if not with_ids:
        found = C.stored(found, "token-index")
    sizes = found.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # one row for each file: their names ascend with the ids
    order = Window.orderBy(F.regexp_extract("file", r"part-(\d+)", 1).cast("long"), "file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col("file").alias("_file"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_before"))
    out = found.join(before, found["file"] == before["_file"])
    return out.withColumn("start", F.col("start") + F.col("_before")).drop("file", "_file", "_before")
