"""Substring dedup with a count-min prefilter.

A window is ``width`` consecutive words of one document (words are runs
without ASCII white space, unchanged). A word is removed if a window that
covers it has a word sequence that also starts in a document with a smaller
id. Windows are judged on the input, not on what is left.

1. *Sketch.* Every task hashes the windows of its documents into ``ROWS`` rows
   of counting cells and emits the touched cells, sorted and compressed, with
   a mark where its own count passed one. Sketches are merged cell range by
   cell range, in rounds of bounded fan-in; counters saturate at two, so a
   merged cell says "at least two" whenever any of its windows occurs twice
   (it may say so of others: it overestimates, never underestimates). The
   merged sketch is one bit per cell, at most ``2 * MOST_CELLS / 8`` bytes (64
   MiB) by construction, which is the bound of what is broadcast. Beyond that
   capacity more windows pass the filter; none is ever lost.
2. *Exact pass.* Windows whose cells all say two go on, as 96-bit keys: 64 bits
   from one hash of each word and 32 from another, independent one. A task first joins equal keys of its own run of documents (keeping the
   smallest id), so a passage that a third of the corpus shares arrives once
   per run, not once per document. Keys are packed by hash bucket, a bucket
   answers each run with the keys that a smaller id holds elsewhere, and the
   run turns its answers into word ranges.
3. *Cut.* Documents are joined with their ranges by id (and text hash). Ranges of
   up to a million documents, four ranges each, are broadcast, so that no text is
   shuffled; with more, texts are shuffled once.

A run's packing follows the order in which its rows are read; give a stored
table (as the pipeline does), so that a task that is run again sees the same
rows.

Rows with a null id are left whole and count for no other row; a null or empty
text has no words; documents that share an id are never cut because of each
other; repeated rows are all returned. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WIDTH = 13
ROWS = 2
MOST_CELLS = 1 << 28
RUN = 1 << 19  # windows of a run of the sketch or of requests
FAN_IN = 64
SLICE = 1 << 19
MOST_RANGES = 4 * C.MOST_BROADCAST  # that are broadcast (32 MB and the rows' own)

_Q1, _Q2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 31), kind)


def _deltas(x: np.ndarray) -> bytes:
    """Ascending or slowly changing numbers, packed as differences."""
    return _pack(np.diff(x.astype(np.int64), prepend=np.int64(0)).view(np.uint64).view(np.uint8).reshape(-1, 8).T)


def _undelta(raw: bytes) -> np.ndarray:
    planes = _unpack(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


_TABLE1, _TABLE2 = C.random_table(1), C.random_table(2)


def _over_windows(words: np.ndarray, width: int, by: np.uint64) -> np.ndarray:
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(width if n else 0):
        out *= by
        out += words[j : j + n]
    return C.mixed(out)


def window_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and, from another hash of the words, 32 bits for each window of adjoining
    words."""
    one, two = (_over_windows(C.tabulated(data, starts, ends, t), width, q) for t, q in ((_TABLE1, _Q1), (_TABLE2, _Q2)))
    return one, (two >> np.uint64(32)).astype(np.uint32)


def windows_of(data: np.ndarray, offsets: np.ndarray, width: int):
    """(document index, position, key, key2) of every window of the texts."""
    starts, ends, first = C.words_of(data, offsets)
    key, key2 = window_keys(data, starts, ends, width)
    count = np.maximum(np.diff(first) - width + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    pos = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = first[:-1][doc] + pos
    return doc, pos, key[at], key2[at]


def _cells(key: np.ndarray, bits: int, row: int) -> np.ndarray:
    own = C.mixed(key ^ _Q2) if row else key
    return (own >> np.uint64(64 - bits)).astype(np.int64)


# ------------------------------------------------------------ sketch


_SKETCH = "shard int, part long, cells binary, twice binary"


def _sketch_rows(cells: np.ndarray, twice: np.ndarray, row: int, bits: int, shard_bits: int, part: int):
    """One output row for each shard that has cells; ``cells`` ascending."""
    shard = cells >> shard_bits
    edges = np.searchsorted(shard, np.arange((1 << (bits - shard_bits)) + 1))
    for s in range(len(edges) - 1):
        i, j = edges[s], edges[s + 1]
        if i < j:
            own = cells[i:j] - (s << shard_bits)
            yield (row << (bits - shard_bits)) + s, part, _deltas(own), _pack(np.packbits(twice[i:j]))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_SKETCH_SCHEMA = pa.schema([("shard", pa.int32()), ("part", pa.int64()), ("cells", pa.binary()), ("twice", pa.binary())])


def _sketcher(bits: int, shard_bits: int, width: int):
    def flush(keys: list[np.ndarray], part: int):
        key = np.concatenate(keys)
        keys.clear()
        for row in range(ROWS):
            cells = _cells(key, bits, row)
            cells.sort()
            new = np.flatnonzero(np.diff(cells, prepend=-1))
            twice = np.diff(new, append=len(cells)) > 1
            yield _batch(list(_sketch_rows(cells[new], twice, row, bits, shard_bits, part)), _SKETCH_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.drop_tables()
        keys, held, part = [], 0, TaskContext.get().partitionId()
        for batch in batches:
            data, offsets = C.text_bytes(batch.column(0))
            for i, j in C.slices(offsets, SLICE):
                key = windows_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)[2]
                if len(key):
                    keys.append(key)
                    held += len(key)
                if held >= RUN:
                    yield from flush(keys, part)
                    held = 0
        if held:
            yield from flush(keys, part)
        C.give_back()

    return run


def _merger(shard_bits: int):
    def run(group: pa.Table) -> pa.Table:
        counts = np.zeros(1 << shard_bits, np.uint8)
        for cells, twice in zip(group.column("cells"), group.column("twice")):
            at = _undelta(cells.as_py())
            more = np.unpackbits(_unpack(twice.as_py(), np.uint8), count=len(at))
            counts[at] = np.minimum(2, counts[at] + 1 + more)
        at = np.flatnonzero(counts)
        row = (group.column("shard")[0].as_py(), group.column("part")[0].as_py(), _deltas(at), _pack(np.packbits(counts[at] > 1)))
        return pa.Table.from_batches([_batch([row], _SKETCH_SCHEMA)])

    return run


def _finisher(shard_bits: int):
    merge = _merger(shard_bits)

    def run(group: pa.Table) -> pa.Table:
        done = merge(group)
        at = _undelta(done.column("cells")[0].as_py())
        twice = np.unpackbits(_unpack(done.column("twice")[0].as_py(), np.uint8), count=len(at))
        plane = np.zeros(1 << shard_bits, np.uint8)
        plane[at] = twice
        return pa.table({"shard": pa.array([done.column("shard")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(plane, bitorder="little").tobytes()], pa.binary())})

    return run


def merged_sketch(texts: DataFrame, windows: float, width: int = WIDTH) -> tuple[np.ndarray, int]:
    """The merged sketch of a one-column frame of texts: a bit per cell, set if
    the cell counts two or more; and the number of bits of a cell's index.
    ``windows``: about how many windows there are; sizes the sketch only."""
    cells = C.power_of_two(2 * windows, 1 << 16, MOST_CELLS)
    bits = cells.bit_length() - 1
    shard_bits = min(bits, 22)
    parts = texts.rdd.getNumPartitions()
    sketch = texts.mapInArrow(_sketcher(bits, shard_bits, width), _SKETCH)
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        sketch = sketch.withColumn("part", F.pmod(F.col("part"), F.lit(parts)))
        sketch = sketch.groupBy("shard", "part").applyInArrow(_merger(shard_bits), _SKETCH)
    planes = sketch.groupBy("shard").applyInArrow(_finisher(shard_bits), "shard int, bits binary")
    size = (1 << shard_bits) // 8
    out = np.zeros(ROWS * cells // 8, np.uint8)
    for row in C.stored(planes, "sketch").toLocalIterator():  # bounded: ROWS * MOST_CELLS / 8 bytes in all
        out[row.shard * size : (row.shard + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return out, bits


def _estimated_repeated(sketch: np.ndarray, bits: int, key: np.ndarray) -> np.ndarray:
    """Indices of the keys whose cells all say two or more."""
    left = np.arange(len(key))
    for row in range(ROWS):
        at = _cells(key[left], bits, row) + (row << bits)
        left = left[(sketch[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return left


# ------------------------------------------------------------ exact pass


_MESSAGE = "bucket long, run long, kind int, body binary, body2 binary, body3 binary, body4 binary"
_MESSAGE_SCHEMA = pa.schema([("bucket", pa.int64()), ("run", pa.int64()), ("kind", pa.int32()), *((f"body{i}", pa.binary()) for i in ("", 2, 3, 4))])
_KEYS, _ANSWER, _PLACES = 0, 1, 2


def _requests(docs: list[tuple], parts: list[tuple], run: int, bucket_bits: int):
    """The messages of one run. docs: (id, text hash) of its documents; parts:
    (document index, position, key, key2) of its flagged windows."""
    doc, pos, key, key2 = (np.concatenate(x) for x in zip(*parts))
    ids = np.array([d[0] for d in docs], np.int64)
    order = np.lexsort((key2, key))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(key[order]) != 0) | (np.diff(key2[order]) != 0)
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[doc[order]], heads)
    seen = np.minimum.reduceat(order, heads)  # entries are numbered by their first window
    number = np.empty(len(heads), np.int64)
    number[np.argsort(seen, kind="stable")] = np.arange(len(heads))
    entry = np.empty(len(order), np.int64)
    entry[order] = number[np.cumsum(new) - 1]
    later = np.empty(len(order), bool)
    later[order] = ids[doc[order]] > least[np.cumsum(new) - 1]
    first = np.sort(seen)
    ekey, ekey2, eleast = key[first], key2[first], np.empty(len(heads), np.int64)
    eleast[number] = least
    bucket = (ekey >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(ekey), np.int64)
    by = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[by], prepend=-1, append=-1))
    for i, j in zip(edges[:-1], edges[1:]):
        at = by[i:j]
        yield int(bucket[at[0]]), run, _KEYS, ekey[at].tobytes(), ekey2[at].tobytes(), _deltas(eleast[at]), _deltas(at)
    used = np.unique(doc)
    head = np.stack([ids[used], np.array([docs[i][1] for i in used], np.int64)])
    body = np.stack([np.searchsorted(used, doc), pos, entry, later])
    spread = int(C.mixed(np.array([run], np.uint64))[0]) >> (64 - bucket_bits)  # a run's number within its partition is in its low bits
    yield spread, run, _PLACES, _pack(head), b"".join([len(doc).to_bytes(8, "little"), *(_sized(_deltas(x)) for x in body)]), b"", b""


def _sized(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + raw


def _unsized(raw: bytes, at: int):
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        yield raw[at + 8 : at + 8 + n]
        at += 8 + n


def _asker(sketch, bits: int, bucket_bits: int, width: int):
    """sketch: a broadcast of the merged sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.drop_tables()
        bitmap = sketch.value
        docs, parts, held, number = [], [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, offsets = C.text_bytes(batch.column(2))
            for i, j in C.slices(offsets, SLICE):
                doc, pos, key, key2 = windows_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                at = _estimated_repeated(bitmap, bits, key)
                if len(at):
                    parts.append((doc[at] + len(docs), pos[at], key[at], key2[at]))
                    docs += zip(ids[i:j], marks[i:j])
                    held += len(at)
                if held >= RUN:
                    yield _batch(list(_requests(docs, parts, number, bucket_bits)), _MESSAGE_SCHEMA)
                    docs, parts, held, number = [], [], 0, number + 1
        if held:
            yield _batch(list(_requests(docs, parts, number, bucket_bits)), _MESSAGE_SCHEMA)
        docs, parts = [], []
        C.give_back()

    return run


def _answer(group: pa.Table) -> pa.Table:
    """A bucket: each run gets the numbers of its keys that a smaller id has
    elsewhere; places pass through."""
    rows = group.to_pylist()
    asks = [r for r in rows if r["kind"] == _KEYS]
    out = [(r["bucket"], r["run"], r["kind"], r["body"], r["body2"], b"", b"") for r in rows if r["kind"] == _PLACES]
    if asks:
        key = np.concatenate([np.frombuffer(r["body"], np.uint64) for r in asks])
        key2 = np.concatenate([np.frombuffer(r["body2"], np.uint32) for r in asks])
        least = np.concatenate([_undelta(r["body3"]) for r in asks])
        order = np.lexsort((key2, key))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(key[order]) != 0) | (np.diff(key2[order]) != 0)
        of_all = np.minimum.reduceat(least[order], np.flatnonzero(new))
        found = np.empty(len(order), bool)
        found[order] = least[order] > of_all[np.cumsum(new) - 1]
        at = 0
        for r in asks:
            n = len(r["body"]) // 8
            hit = found[at : at + n]
            at += n
            if hit.any():
                out.append((r["bucket"], r["run"], _ANSWER, _deltas(_undelta(r["body4"])[hit]), b"", b"", b""))
    return pa.Table.from_batches([_batch(out, _MESSAGE_SCHEMA)])


def _ranges_maker(width: int):
    def run(group: pa.Table) -> pa.Table:
        head = body = None
        hits = []
        for r in group.to_pylist():
            if r["kind"] == _PLACES:
                head, body = _unpack(r["body"], np.int64).reshape(2, -1), r["body2"]
            else:
                hits.append(_undelta(r["body"]))
        doc, pos, entry, later = (_undelta(x) for x in _unsized(body, 8))
        smaller = np.zeros(int(entry.max()) + 1, bool)
        if hits:
            smaller[np.concatenate(hits)] = True
        cut = smaller[entry] | (later == 1)
        doc, pos = doc[cut], pos[cut]
        new = np.ones(len(doc), bool)
        new[1:] = (np.diff(doc) != 0) | (pos[1:] > pos[:-1] + width)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(doc)) - 1 if len(doc) else heads
        lo, hi, of = pos[heads], pos[tails] + width, doc[heads]
        edges = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
        owners = of[edges[:-1]] if len(of) else of
        lists = lambda x: pa.ListArray.from_arrays(pa.array(edges if len(of) else [0], pa.int32()), pa.array(x, pa.int32()))
        return pa.table({"id": pa.array(head[0][owners], pa.int64()), "mark": pa.array(head[1][owners], pa.int64()), "lo": lists(lo), "hi": lists(hi)})

    return run


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, mark, lo, hi): for each document with words to remove, the word
    ranges [lo[i], hi[i]) in ascending order; ``mark`` is xxhash64 of the text."""
    spark = docs.sparkSession
    texts = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    windows = (texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) / 6
    sketch, bits = merged_sketch(texts.select(text_col), windows, width)
    shared = spark.sparkContext.broadcast(sketch)
    bucket_bits = C.power_of_two(windows / (1 << 20), 16).bit_length() - 1
    asked = texts.select(F.col(id_col).cast("long"), F.xxhash64(text_col), text_col).mapInArrow(_asker(shared, bits, bucket_bits, width), _MESSAGE)
    answered = asked.groupBy("bucket").applyInArrow(_answer, _MESSAGE)
    return answered.groupBy("run").applyInArrow(_ranges_maker(width), "id long, mark long, lo array<int>, hi array<int>")


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, width: int) -> tuple[DataFrame, str, str]:
    """``docs`` with the columns of their ranges (null: none)."""
    lo, hi, own, mark = (C.free_name(docs, x) for x in ("_lo", "_hi", "_id", "_mark"))
    found = repeated_ranges(docs, id_col, text_col, width).toDF(own, mark, lo, hi)
    found = C.stored(found.dropDuplicates([own, mark]), "ranges")  # repeated rows have the same ranges
    told = found.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size(lo)).alias("ranges")).first()
    if told.rows <= C.MOST_BROADCAST and (told.ranges or 0) <= MOST_RANGES:
        found = F.broadcast(found)
    on = (docs[id_col].cast("long") == found[own]) & (F.xxhash64(docs[text_col]) == found[mark])
    return docs.join(found, on, "left").drop(own, mark), lo, hi


def _cutter(text_at: int, lo_at: int, hi_at: int, kept_columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            los, his = batch.column(lo_at).to_pylist(), batch.column(hi_at).to_pylist()
            column = batch.column(text_at)
            texts, words, removed, digests = [], [], [], []
            for k in range(batch.num_rows):
                text = column[k].as_py()
                raw = (text or "").encode()
                own = raw.split()
                gone = 0
                if los[k]:
                    starts, ends, _ = C.words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                    kept, pieces, at, byte = [], [], 0, 0
                    for lo, hi in zip(los[k], his[k]):
                        kept += own[at:lo]
                        pieces.append(raw[byte : starts[lo]])
                        at, byte = hi, starts[hi] if hi < len(own) else ends[hi - 1]
                        gone += hi - lo
                    kept += own[at:]
                    pieces.append(raw[byte:])
                    text = b"".join(pieces).decode()
                    n, own = len(own), kept
                else:
                    n = len(own)
                texts.append(text)
                words.append(n)
                removed.append(gone)
                digests.append(hashlib.sha256(b" ".join(own)).hexdigest())
            columns = [pa.array(texts, pa.string()) if i == text_at else batch.column(i) for i in range(kept_columns)]
            columns += [pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])
        C.give_back()

    return run


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` without the repeated words: all columns with ``text_col`` cut
    (what is left keeps its white space; a text without repeats is unchanged),
    and n_words (before), n_removed, kept_sha256 (of the kept words joined by
    one space); these replace columns of the same names."""
    own = docs.drop("n_words", "n_removed", "kept_sha256")
    joined, lo, hi = _with_ranges(own, id_col, text_col, width)
    columns = [*own.columns, lo, hi]
    at = {c: i for i, c in enumerate(columns)}
    schema = [f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(own.schema.fields)]
    out = joined.select(*columns).mapInArrow(
        _cutter(at[text_col], at[lo], at[hi], len(own.columns)), ", ".join([*schema, "n_words long", "n_removed long", "kept_sha256 string"])
    )
    return out.toDF(*own.columns, "n_words", "n_removed", "kept_sha256")
