"""SimHash near-dedup against a brute-force version."""

import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import types as T

from waitline.llm import simhash as S

SF = "/root/testdata/sf0.001"


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids, distance=3):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fp = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= distance):
            a, b = find(i), find(int(j))
            if a != b:
                parent[a] = b
    least = {}
    for i, x in enumerate(ids):
        least[find(i)] = min(x, least.get(find(i), x))
    return [least[find(i)] for i in range(len(ids))]


def _result(df):
    return sorted((r.id, r.fp & S.LONG_MASK, r.component) for r in df.collect())


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    prints = [brute_print(x) for x in t["text"]]
    want = sorted(zip(t["doc_id"], prints, brute_components(prints, t["doc_id"])))
    assert _result(S.near_duplicates(docs)) == want


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    rows = [(5, None, "a", 1), (3, "", "b", 2), (9, " \t", "c", 3), (None, "x y z", "d", 4), (7, "One two", "e", 5), (7, "One two", "e", 5), (8, "oNE\ntwo", None, None), (11, "w" * 300_000 + " q" * 200_000, "f", 6)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.id or -1, r.component) for r in S.near_duplicates(df).collect())
    assert got == [(-1, None), (3, 3), (5, 3), (7, 7), (7, 7), (8, 7), (9, 3), (11, 11)]
    kept = S.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.id, r.n) for r in kept.collect()), key=str) == [(11, "f", 6), (3, "b", 2), (7, "e", 5), (None, "d", 4)]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.near_duplicates(df).count() == 0 and S.one_of_each(df).count() == 0


@pytest.mark.parametrize("most_rows,parts", [(8192, (2, 3, 4)), (40, (2,)), (40, (4,)), (8, (3,))])
def test_links_of_planted_prints(spark, monkeypatch, most_rows, parts):
    """Near copies of a few centres, chains and random prints; large buckets are split."""
    rnd = random.Random(7)
    prints = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(3):
        at = centre = rnd.getrandbits(64)
        for _ in range(120):
            prints.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice((1, 2, 3)))))
        for _ in range(30):
            at ^= sum(1 << b for b in rnd.sample(range(64), 3))
            prints.add(at)
    prints = sorted(prints)
    ids = [rnd.randrange(10**9) for _ in prints]
    monkeypatch.setattr(S, "MOST_ROWS", most_rows)
    monkeypatch.setattr(S, "PARTS", parts)
    classes = spark.createDataFrame([(S._signed(p), i) for p, i in zip(prints, ids)], "fp long, rep long")
    found = {r.id: r.component for r in S.components(S.links(classes)).collect()}
    assert [found.get(i, i) for i in ids] == brute_components(prints, ids)


def test_thresholds_cover_the_distance():
    cost, ts = S.allocate([[1, 5, 50, 500], [10, 11, 12, 13], [9, 9, 9, 9]], 3)
    assert sum(t + 1 for t in ts) == 4 and cost == 9 and ts == [-1, -1, 3]


def test_large_and_small_buckets_agree():
    rnd = np.random.default_rng(3)
    fp = rnd.integers(0, 2**63, 300, dtype=np.uint64)
    fp[150:] = fp[:150] ^ (np.uint64(1) << rnd.integers(0, 63, 150).astype(np.uint64))
    probe = rnd.random(300) < 0.2
    one = S._linked_large(fp, probe, 3)
    two = S._linked(fp, probe, np.array([0]), 3)
    assert (one[:, None] == one[None]).tolist() == (two[:, None] == two[None]).tolist()
