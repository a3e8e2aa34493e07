"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from waitline.llm import registry
from waitline.llm import variants as V

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("word", T.StringType()), T.StructField("n", T.StringType())])


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, one_in=None):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute(words):
    near = {w: [] for w in words}
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) < 2 and a < b and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (words[w], len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


def result(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def made_words(n, seed, letters="abcé", sizes=(6, 12)):
    draw = random.Random(seed)
    base = ["".join(draw.choices(letters, k=draw.randint(*sizes))) for _ in range(n)]
    out = set(base)
    for w in base:
        for _ in range(4):
            k = draw.randrange(len(w) + 1)
            out.add(draw.choice([w[:k] + w[k + 1 :], w[:k] + draw.choice(letters) + w[k:], w[:k] + draw.choice(letters) + w[k + 1 :]]))
    return {w: draw.choice([5, 6, 30, 150, 900]) for w in sorted(out) if len(w) >= 6}


@pytest.fixture
def as_frame(spark):
    return lambda words: spark.createDataFrame(sorted(words.items()), "word string, n long")


def test_query_equals_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    want = brute(counted(list(zip(t["doc_id"], t["text"])), 199))
    got = registry.QUERIES["op11_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == want and len(want) > 300 and any(v[2] for v in want.values())


@pytest.mark.parametrize("most", [20_000, 40, 3])
def test_made_words_with_long_lists(as_frame, most):
    words = made_words(60, 4)
    want = brute(words)
    assert result(V.grouped(as_frame(words), most_listed=most)) == want
    assert any(v[4] not in (w, v[2]) for w, v in want.items() if v[2])  # roots further than forms


def test_one_hot_beginning_is_split(as_frame, spark):
    words = {"abcabcabc" + w: n for w, n in made_words(40, 5, sizes=(3, 6)).items()}
    rows = V._bounded(V._members(as_frame(words)), 25)
    assert rows.where("NOT split").groupBy(*V._LIST).count().agg({"count": "max"}).first()[0] <= 25
    assert result(V.grouped(as_frame(words), most_listed=25)) == brute(words)


def test_scan_in_small_batches(as_frame):
    words = made_words(50, 6)
    rows = sorted((*[r[c] for c in (*V._LIST, "text", "n")],) for r in V._members(as_frame(words)).collect())
    import pyarrow as pa

    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.int64()]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*V._LIST, "text", "n"])
    small = [whole.slice(i, 7) for i in range(0, whole.num_rows, 7)]
    near = Counter()
    for out in V._scanner(most_rows=10)(small):
        for r in out.to_pylist():
            near[r["word"]] += r["n_near"]
    assert {w: n for w, n in near.items()} == {w: v[1] for w, v in brute(words).items() if v[1]}


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    long = "zebrafish " * 60_000 + "zebrafih " * 5 + "q" * 50_000
    rows = [(1, None), (None, "Zebrafish ZEBRAFÎSH"), (2, ""), (3, long), (4, "one two"), (4, "one two"), (5, "straße Straße×straße " * 3)]
    rows += [(7, "orange" * 3 + " ")] * 6 + [(8, "abcdef abcdeg " * 5)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    for one_in in (None, 3):
        want = brute(counted(rows, one_in))
        assert result(V.grouped(V.vocabulary(df, one_in=one_in))) == want
    plain = brute(counted(rows))
    assert plain["zebrafih"][2:] == ("zebrafish", 60_001, "zebrafish") and plain["abcdef"][1:3] == (1, None)


def test_ties_go_to_the_smaller_word(as_frame):
    got = result(V.grouped(as_frame({"abcdefg": 5, "abcdefgz": 25, "abcdefé": 25, "xabcdefg": 25})))
    assert got["abcdefg"] == (5, 3, "abcdefgz", 25, "abcdefgz")


def test_empty_table(spark):
    assert V.grouped(V.vocabulary(spark.createDataFrame([], SCHEMA))).count() == 0
