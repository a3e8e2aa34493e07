"""Hyperdimensional language id: bundles by definition, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitline.llm import langid as L
from waitline.llm import registry

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType())])


def brute(text, dimensions):
    v = lambda c: np.random.default_rng(ord(c)).integers(0, 2, dimensions) * 2.0 - 1
    folded = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    folded = f" {' '.join(folded.split())} " if folded.strip() else ""
    out = np.zeros(dimensions)
    for a, b, c in zip(folded, folded[1:], folded[2:]):
        out += np.roll(v(a), 2) * np.roll(v(b), 1) * v(c)
    return out, max(0, len(folded) - 2)


def test_bundles_follow_the_definition(monkeypatch):
    texts = ["The cat, the CAT; 12 dogs.", None, "", "123 !?", "é", "Ünïcödé 漢字仮名 \U00020000x ퟿", "a" * 50, "x y z " * 40]
    for size in (L.SLICE, 7):
        monkeypatch.setattr(L, "SLICE", size)
        vectors, n = L.bundles(texts, L.Letters(64))
        for text, v, k in zip(texts, vectors, n):
            want, count = brute(text, 64)
            assert k == count and np.allclose(v, want)


def test_prototypes_sum_over_the_labelled_rows(spark):
    rows = [(1, "der die das", "de", ""), (2, "und", "de", ""), (3, "the of", "en", ""), (4, "of all", None, ""), (5, None, "en", ""), (6, "12", "xx", "")]
    names, vectors = L.learn(spark.createDataFrame(rows, SCHEMA), dimensions=64)
    assert names == ["de", "en"]
    for v, texts in zip(vectors, (["der die das", "und"], ["the of"])):
        want = sum(brute(t, 64)[0] for t in texts)
        assert np.allclose(v, want / np.linalg.norm(want), atol=1e-6)


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in registry.QUERIES["op7_language_id"](spark, sf).collect()}
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    assert sorted(got) == sorted(t["doc_id"])
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1 for i in got)
    right = [got[i].lang_pred == lang for i, lang in zip(t["doc_id"], t["lang"]) if got[i].held_out]
    assert np.mean(right) > 0.98


def test_nulls_ties_long_repeats_and_clashing_columns(spark):
    model = (["a", "b"], np.ones((2, 64), np.float32) / 8)
    rows = [(1, None, "a", ""), (None, "", "b", ""), (2, " 12\n", None, ""), (3, "x" * 2_500_000, "b", ""), (4, "tie", "b", "s"), (4, "tie", "b", "s")]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "lang_")
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(df, model, ["doc_id"]).collect()}
    assert got[1] == got[None] == got[2] == ("und", 0.0)
    assert got[4][0] == "a" and L.predict(df, model, ["doc_id"]).count() == 6


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = L.learn(empty)
    assert model[0] == []
    assert L.predict(empty, model, ["doc_id"]).count() == 0
    one = spark.createDataFrame([(1, "some text", "en", "")], SCHEMA)
    assert [tuple(r) for r in L.predict(one, model, ["doc_id"]).collect()] == [(1, "und", 0.0)]
    assert one.select(L.held_out(F.lit(None))).count() == 1
