"""Token files: the coder's round trip, damage, and whole tables against direct encoding."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from test_packing import ODD, encoded
from waitline.llm import common as C
from waitline.llm import tokenfile as K

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("start", T.StringType())])


def brute(rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*encoded(text), 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def result(df):
    return sorted(((r.id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = C.scratch_path(spark, "tokens")
    K.write(docs, path)
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    assert result(K.read(spark, path)) == brute(list(zip(t["doc_id"], t["text"])))


def test_ids_come_back(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 300)  # documents go on from block to block
    rows = [(9, "q w e " * 200, "", ""), (4, None, "", ""), (None, "a b", "", ""), (-7, "", "", ""), *((100 + i, t, "", "") for i, t in enumerate(ODD))]
    path = C.scratch_path(spark, "tokens")
    K.write(spark.createDataFrame(rows, SCHEMA), path)
    got = {r.id: r.ids for r in K.read(spark, path, with_ids=True).collect()}
    assert got == {r[0]: [*encoded(r[1]), 2] for r in rows}
    assert result(K.read(spark, path)) == brute([r[:2] for r in rows])


def test_repeated_ids_all_come_back(spark):
    path = C.scratch_path(spark, "tokens")
    K.write(spark.createDataFrame([(1, "x y", "", ""), (1, "x y", "", ""), (1, "z", "", "")], SCHEMA), path)
    got = result(K.read(spark, path))
    assert [r[0] for r in got] == [1, 1, 1] and [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got[:2])]).tolist()


def test_empty_table(spark):
    path = C.scratch_path(spark, "tokens")
    K.write(spark.createDataFrame([], SCHEMA), path)
    assert K.read(spark, path).count() == 0


@pytest.mark.parametrize("seed,n", [(0, 1), (1, 63), (2, 64), (3, 5000), (4, 70_001)])
def test_round_trip_of_any_ids(seed, n):
    rng = np.random.default_rng(seed)
    kinds = [rng.integers(0, K.VOCABULARY, n), np.minimum(rng.zipf(1.3, n) - 1, K.VOCABULARY - 1), np.resize(rng.integers(0, 50, 17), n), np.full(n, K.VOCABULARY - 1), np.zeros(n, np.int64)]
    for ids in kinds:
        raw = K.encode_block(ids.astype(np.uint32), [(5, n, False)])
        ((out, table),) = K.decode_blocks(raw + b"\n")
        assert (out == ids).all() and table.tolist() == [[5, 0, n, 0]]


def test_predictions_pay():
    rng = np.random.default_rng(1)
    follow = rng.integers(0, K.VOCABULARY, 512)
    at, ids = 0, []
    for _ in range(200_000):
        ids.append(follow[at])
        at = (at * 5 + 1) % 512 if rng.random() < 0.95 else int(rng.integers(0, 512))
    raw = K.encode_block(np.array(ids, np.uint32), [(0, len(ids), False)])
    assert 8 * len(raw) / len(ids) < 4  # of 16 bits


def test_damage_is_found():
    raw = bytearray(K.encode_block(np.arange(500, dtype=np.uint32), [(0, 500, False)]) + b"\n")
    for at in (0, 9, 40, len(raw) - 20):
        bad = bytearray(raw)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(K.decode_blocks(bytes(bad)))
    with pytest.raises(ValueError):
        K.encode_block(np.zeros(1, np.uint32), [(0, 1, False)], vocabulary=1 << 20)
