"""Tokens and best-fit packing against direct encoding and lower bounds."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from waitline.llm import packing as P
from waitline.llm import tokens as K

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("piece", T.StringType()), T.StructField("task", T.StringType())])


def encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(K.path_of()).encode(text or "", add_special_tokens=False).ids


ODD = ["<|endoftext|> a <|startoftext|>b", "Ünḯcode wörd x\x85y", "it's I'VE don't'll 12345 \U0001f642\U0001f642 漢字", "J̌ ǰ İ ΣΑΣ", "\x00 \x1f\x1c a​b", " \t\n\x0b\f\r", "", "e\ń x", "x" * 3000, f"{'y' * 64} a {'z' * 65}, b {'w' * 900} {'z' * 65}, c" * 9, "\u00c9cole, STRASSE: \u00df\u00ff\u00fe\u00f0\u00d7\u00f7 \u00c0\u00d6\u00d8\u00f6\u00f8! na\u0303o \u00aa\u00ba \u00b5 a.. b., C!", "isn't, it's. o'clock, 'the' I'M"]


def test_ids_equal_those_of_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    texts = ODD + [None] + pq.read_table(f"{SF}/documents.parquet").to_pydict()["text"]
    whole = Tokenizer.from_file(K.path_of())
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for most, piece in ((1_500_000, 1 << 20), (50, 500), (3000, 1 << 14)):
        monkeypatch.setattr(K, "MOST_WORDS", most)
        got = [x.tolist() for x in K.documents(K.WordTable(K.path_of()), pa.array(texts), piece)]
        assert got == want


def test_a_process_keeps_its_table():
    assert K.table_of(K.path_of()) is K.table_of(K.path_of())


def check(rows, docs, size):
    """Every id is packed once, in place, gapless; returns the number of sequences."""
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
    for placed in by_seq.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    want = []
    for i, text in docs:
        ids = np.array([*encoded(text), 1], "<u4")
        want += [(i, n, s, len(ids[s : s + size]), zlib.crc32(ids[s : s + size].tobytes())) for n, s in enumerate(range(0, len(ids), size))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    return len(by_seq)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.packed(docs.repartition(7)).collect()
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    n = check(rows, list(zip(t["doc_id"], t["text"])), 4096)
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1


def test_nulls_long_repeats_and_clashing_columns(spark):
    rows = [(1, None, "", ""), (None, "a b", "", ""), (2, "", "", ""), (2, "a b", "", ""), (2, "a b", "", ""), (3, "q " * 100, "", ""), *((10 + i, t, "", "") for i, t in enumerate(ODD))]
    got = P.packed(spark.createDataFrame(rows, SCHEMA), size=64).collect()
    check(got, [r[:2] for r in rows], 64)
    assert [c for c in got[0].asDict()] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_empty_table(spark):
    assert P.packed(spark.createDataFrame([], SCHEMA)).count() == 0


def simulate(counts, size):
    """Fills the sequences as the runs say; every rank of every length once."""
    runs, n = P.plan(counts, size)
    filled = defaultdict(list)
    for length in range(size + 1):
        own = runs[runs[:, 0] == length]
        own = own[np.argsort(own[:, 1])]
        assert own[:, 2].sum() == counts[length]
        assert (own[:, 1] == np.cumsum(own[:, 2]) - own[:, 2]).all()
        for _, _, ranks, each, first, offset in own:
            for r in range(ranks):
                filled[first + r // each].append((offset + length * (r % each), length))
    assert sorted(filled) == list(range(n))
    for placed in filled.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= size
    return n


@pytest.mark.parametrize("seed", range(12))
def test_plans_place_every_piece(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(5, 60))
    counts = np.zeros(size + 1, np.int64)
    counts[1:] = rng.integers(0, rng.integers(1, 30), size) * (rng.random(size) < rng.random())
    simulate(counts, size)


def test_exact_complements_of_one_two_and_three():
    def plan(size, **of):
        counts = np.zeros(size + 1, np.int64)
        for k, v in of.items():
            counts[int(k[1:])] = v
        return simulate(counts, size)

    assert plan(10, l7=4, l3=4) == 4
    assert plan(10, l6=4, l1=4, l3=4) == 4
    assert plan(10, l5=3, l2=3, l1=6) == 3
    assert plan(10, l4=3, l3=3, l2=3, l1=3) == 3
    assert plan(10, l5=5) == 3
    assert plan(10, l6=5, l5=1) == 6
