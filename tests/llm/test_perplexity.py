"""Kneser-Ney perplexity against a plain version, normalisation, and the verdict."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from waitline.llm import perplexity as P
from waitline.llm import registry

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("trusted", T.StringType()), T.StructField("_id", T.StringType())])


class Brute:
    def __init__(self, texts):
        tri = Counter(g for t in texts for g in self.grams(t))
        bi = Counter((b, c) for _, b, c in tri)
        uni = Counter(c for _, c in bi)
        self.tables = [uni, bi, tri]
        self.d = [self.discounts(t) for t in self.tables]
        self.total, self.free = [], []
        for table, d in zip(self.tables, self.d):
            total, free = defaultdict(float), defaultdict(float)
            for g, n in table.items():
                h = g[:-1] if isinstance(g, tuple) else ()
                total[h] += n
                free[h] += d[min(n, 3) - 1]
            self.total.append(total)
            self.free.append(free)

    @staticmethod
    def grams(t):
        c = [2, 2, *(min(ord(x), 0xFFFF) for x in t), 3]
        return list(zip(c, c[1:], c[2:]))

    @staticmethod
    def discounts(table):
        c = Counter(table.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.5
        raw = [k - (k + 1) * y * c[k + 1] / c[k] if c[k] else 0.5 * k for k in (1, 2, 3)]
        return [max(0.05, min(k - 0.05, x)) for k, x in zip((1, 2, 3), raw)]

    def p(self, g, order=2):
        table = self.tables[order]
        key, h = (g[2 - order :], g[2 - order : 2]) if order else (g[2], ())
        total = self.total[order].get(h)
        lower = self.p(g, order - 1) if order else 1 / (len(table) + 1)
        if not total:
            return lower
        n = table.get(key, 0)
        taken = self.d[order][min(n, 3) - 1] if n else 0
        return (n - taken) / total + self.free[order][h] / total * lower

    def perplexity(self, t):
        g = self.grams(t)
        return math.exp(-sum(math.log(self.p(x)) for x in g) / len(g))


def check(got, rows, trusted, quantile=0.99):
    by = defaultdict(list)
    for i, t, lang in rows:
        if i in trusted and t:
            by[lang or ""].append(t)
    models = {lang: Brute(ts) for lang, ts in by.items()}
    want = [(i, lang or "", models[lang or ""].perplexity(t) if t and (lang or "") in models else None) for i, t, lang in rows]
    have = [(r.id, r.lang, r.perplexity) for r in got]
    key = lambda r: (str(r[0]), r[1], r[2] or 0)
    for a, b in zip(sorted(have, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and (a[2] == b[2] if None in (a[2], b[2]) else a[2] == pytest.approx(b[2], rel=1e-9))
    for lang in models:
        own = sorted(r.perplexity for r in got if r.lang == lang and r.trusted and r.perplexity)
        limit = {r.threshold for r in got if r.lang == lang}
        assert limit == {own[math.ceil(quantile * len(own)) - 1]}
    for r in got:
        assert r.kept == (r.units > 0 and (r.threshold is None or r.perplexity is None or r.perplexity <= r.threshold))


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(P, "RUN", 30_000)
    monkeypatch.setattr(P, "RUNS_A_GROUP", 2)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trusted = labels.where("quality = 1 AND toxic = 0").select("doc_id")
    got = P.classify(docs, trusted).collect()
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    check(got, list(zip(t["doc_id"], t["text"], t["lang"])), {r.doc_id for r in trusted.collect()})


def test_nulls_long_repeats_and_clashing_columns(spark):
    rows = [(1, "abab abc", "x"), (2, "abc \U0001f642 é", "x"), (2, "abc \U0001f642 é", "x"), (3, None, "x"), (4, "", "y"), (5, "zzz", "y"), (None, "ab", "x"), (6, "abc", None), (7, "cab", None), (8, "q\x00" * 600_000, "x")]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    trusted = spark.createDataFrame([(1,), (2,), (3,), (6,), (6,), (None,), (99,)], "doc_id long")
    check(P.classify(df, trusted).collect(), rows, {1, 2, 3, 6})


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    none = empty.select("doc_id")
    assert P.classify(empty, none).count() == 0
    one = spark.createDataFrame([(1, "abc", "x", "", "")], SCHEMA)
    assert [(r.perplexity, r.threshold, r.kept) for r in P.classify(one, none).collect()] == [(None, None, True)]


def test_the_plain_model_sums_to_one():
    m = Brute(["the cat sat on the mat", "a cat", "that hat"])
    chars = [*m.tables[0]]
    for h in ((2, 2), (ord("t"), ord("h")), (ord("q"), ord("t")), (ord("q"), ord("q"))):
        assert sum(m.p((*h, c)) for c in chars) + m.p((*h, 0xABC)) == pytest.approx(1)


def test_query_rejects_junk_and_keeps_trusted_text(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r.kept for r in registry.QUERIES["op3_kneser_ney"](spark, sf).collect()}
    t = pq.read_table(f"{sf}/labels.parquet").to_pydict()
    good = [got[i] for i, q in zip(t["doc_id"], t["quality"]) if q == 1]
    bad = [got[i] for i, q in zip(t["doc_id"], t["quality"]) if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.8


def test_thresholds_are_held_out(spark, monkeypatch):
    """Each trusted document is scored by a plain model without its fold."""
    monkeypatch.setattr(P, "RUN", 30_000)
    monkeypatch.setattr(P, "FEWEST", 40)  # en has more trusted texts, de 10, fr and es fewer
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trusted = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    good = {r.doc_id for r in trusted.collect()}
    by = defaultdict(list)
    for r in docs.selectExpr("doc_id", "text", "lang", "pmod(xxhash64(text), 3) AS fold").collect():
        if r.doc_id in good and r.text:
            by[r.lang].append((r.fold, r.text))
    held = {}
    for lang, rows in by.items():
        models = {f: Brute([t for g, t in rows if g != f]) for f in {f for f, _ in rows}}
        held[lang] = sorted(models[f].perplexity(t) for f, t in rows)
    at = lambda x, q: sorted(x)[math.ceil(q * len(x)) - 1]
    ratio = at([x / at(held[lang], 0.5) for lang in ("en", "de", "fr", "es") for x in held[lang]], 0.9)
    got = P.classify(docs, trusted, quantile=0.9, folds=3).collect()
    limits = {r.lang: r.threshold for r in got}
    assert limits["en"] == pytest.approx(at(held["en"], 0.9))
    assert limits["de"] == pytest.approx(max(at(held["de"], 0.9), at(held["de"], 0.5) * ratio))
    assert limits["fr"] is None and limits["es"] is None
    whole = P.classify(docs, trusted, quantile=0.9).collect()
    assert sorted(r.perplexity for r in got if r.perplexity) == pytest.approx(sorted(r.perplexity for r in whole if r.perplexity))
    assert all(r.threshold < limits[r.lang] for r in whole if r.lang in ("en", "de"))


def test_one_fold_only_has_no_threshold(spark):
    """Copies of one text are one fold: no model lacks them and has others."""
    df = spark.createDataFrame([(i, "a text again", "x", "", "") for i in range(200)], SCHEMA)
    got = P.classify(df, df.select("doc_id"), folds=5).collect()
    assert len(got) == 200 and all(r.threshold is None and r.kept for r in got)


def test_few_trusted_documents_do_not_reject_clean_ones(spark):
    sf = "/root/testdata/sf0.1"
    t, labels = (pq.read_table(f"{sf}/{n}.parquet").to_pydict() for n in ("documents", "labels"))
    clean = {i for i, q, x in zip(labels["doc_id"], labels["quality"], labels["toxic"]) if q == 1 and x == 0}
    rows = [r for r in zip(t["doc_id"], t["text"], t["lang"]) if r[2] == "de" and r[0] in clean]
    docs = spark.createDataFrame(rows[:200], "doc_id long, text string, lang string")
    few = docs.where(docs.doc_id.isin([r[0] for r in rows[:10]])).select("doc_id")
    rejected = lambda got: np.mean([not r.kept for r in got if not r.trusted])
    assert rejected(P.classify(docs, few, folds=P.FOLDS).collect()) < 0.15  # thresholds of seen text: over 0.8
