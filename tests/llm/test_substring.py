"""Substring dedup against a brute-force version."""

import hashlib
import re
from collections import defaultdict

import pyarrow.parquet as pq
from pyspark.sql import types as T

from waitline.llm import common as C
from waitline.llm import substring as S

SF = "/root/testdata/sf0.001"


def brute(rows, width=13):
    """rows: (doc_id, text); the expected digests in the order given."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = defaultdict(lambda: float("inf"))
    for (i, _), w in zip(rows, words):
        if i is not None:
            for p in range(len(w) - width + 1):
                k = tuple(w[p : p + width])
                least[k] = min(least[k], i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - width + 1) if i is not None else ():
            if least[tuple(w[p : p + width])] < i:
                gone.update(range(p, p + width))
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def digest(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    assert digest(S.remove_repeated(docs)) == sorted(brute(list(zip(t["doc_id"], t["text"]))), key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("_lo", T.StringType()), T.StructField("n_words", T.LongType())]))


PASSAGE = " ".join(f"p{i}" for i in range(30))


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (1, f"a b\n{PASSAGE} c", "x", 7), (2, f"{PASSAGE}\n\tend", None, None), (2, f"{PASSAGE}\n\tend", None, None),
        (2, f"other {PASSAGE}", "y", 1), (None, PASSAGE, "z", 1), (4, None, "n", 1), (5, "", "e", 1), (6, " \n ", "w", 1),
        (7, "r " * 40, "s", 1), (8, "r " * 40 + "q", "s", 1), (-3, " ".join(f"p{i}" for i in range(5, 18)), "neg", 0),
        (9, PASSAGE + "\x85\xa0 é" * 50_000, "long", 1),
    ]
    df = S.remove_repeated(_frame(spark, rows))
    assert digest(df) == sorted(brute([r[:2] for r in rows]), key=str)
    assert df.columns == ["doc_id", "text", "_lo", "n_words", "n_removed", "kept_sha256"]
    got = {(r.doc_id, r._lo): r.text for r in df.collect()}
    assert got[(2, None)] == "end"  # the words go with the white space after them
    assert got[(1, "x")].startswith("a b\np0 p1 p2 p3 p4 p18")
    assert got[(4, "n")] is None and got[(6, "w")] == " \n "


def test_empty_table(spark):
    assert S.remove_repeated(_frame(spark, [])).count() == 0


def test_results_do_not_depend_on_sketch_or_run_sizes(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(9, "doc_id")
    want = digest(S.remove_repeated(docs))
    monkeypatch.setattr(S, "MOST_CELLS", 1 << 10)  # everything collides: nothing may be lost
    monkeypatch.setattr(S, "RUN", 500)
    monkeypatch.setattr(S, "SLICE", 3000)
    monkeypatch.setattr(S, "FAN_IN", 2)
    assert digest(S.remove_repeated(docs)) == want


def test_word_hashes_do_not_depend_on_slices():
    import numpy as np

    texts = [b"one two  three", b"", b"three", b" \t", "é one".encode()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    starts, ends, first = C.words_of(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == b" ".join(texts).split()
    assert list(np.diff(first)) == [len(t.split()) for t in texts]
    one, two = C.word_hashes(data, starts, ends), C.word_hashes(data, starts, ends, most=4)
    assert (one == two).all() and one[0] == one[-1] and one[2] == one[3] and len(set(one)) == 4


def test_places_of_many_partitions_spread_over_buckets():
    from collections import Counter

    import numpy as np

    from waitline.llm import substring as S

    part = (np.zeros(1, np.int64), np.zeros(1, np.int64), np.ones(1, np.uint64), np.ones(1, np.uint32))
    rows = [r for p in range(256) for r in S._requests([(1, 2)], [part], p << 24, 4)]
    held = Counter(r[0] for r in rows if r[2] == S._PLACES)
    assert sum(held.values()) == 256 and set(held) == set(range(16)) and max(held.values()) < 48


def test_words_that_share_a_polynomial_hash_stay_apart(spark):
    """A Thue-Morse word and its complement: polynomials modulo 2**64 are equal."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, f"{one} {rest}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in S.remove_repeated(df).collect()} == {1: 0, 2: 0, 3: 13}


def test_the_join_without_a_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = digest(S.remove_repeated(docs))
    monkeypatch.setattr(S, "MOST_RANGES", 0)
    assert digest(S.remove_repeated(docs)) == want
