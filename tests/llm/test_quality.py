"""Quality rules: base counts against brute force, divergence on hand-made texts."""

import re
from collections import Counter

import pyarrow.parquet as pq
from pyspark.sql import types as T

from waitline.llm import quality as Q

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("kept", T.StringType()), ("_words", T.IntegerType()))])


def brute(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    n = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), len(covered), len(ws) < 10 or 100 * len(covered) > 20 * len(ws)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_equal_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    got = {r.id: tuple(r[c] for c in COLUMNS) for r in Q.judged(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert got == {i: brute(x) for i, x in zip(t["doc_id"], t["text"])}


CLEAN = "the cat of the house and a dog in the yard ran to see what it was that made such noise "


def test_nulls_blank_long_repeats_and_clashing_columns(spark):
    texts = [None, "", " \x0b\t", "a b c d e a b c d e", "x\n\nx\n x\r\n\x85", "é🙂 #*$ 漢字", "r " * 20_000, "\n".join(f"{CLEAN}{i}" for i in range(900)), CLEAN + "one", CLEAN + "two"]
    rows = [(i, t, "en" if i % 3 else None, "k", i) for i, t in enumerate(texts)] + [(None, CLEAN, "en", "k", 1), (8, texts[8], "en", "k", 8), (8, texts[8], "en", "k", 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in Q.judged(df).collect())
    assert got == sorted(brute(r[1]) for r in rows)
    kept = Q.filtered(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 8, 8, 8, 9]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert Q.judged(df).count() == 0 and Q.filtered(df).count() == 0


def test_divergence_rejects_shouting_symbols_and_tables_but_not_prose(spark):
    import random

    rnd = random.Random(1)
    names = [f"{a}{b}{c}" for a in ("bor", "ten", "mal") for b in ("an", "ode", "ish") for c in ("ed", "ing", "s")]
    prose = lambda: " ".join(rnd.choice(["the", "of", "and", "to", "in", rnd.choice(names), rnd.choice(names)]) for _ in range(300))
    rows = [(i, prose(), "en", "", 0) for i in range(60)]
    rows += [(100, prose().upper(), "en", "", 0), (101, prose().replace(" ", "%%% "), "en", "", 0), (102, " | ".join(rnd.choice(names) + str(i % 10) for i in range(300)), "en", "", 0)]
    rows += [(200, "THE OF AND TO IN BORANED TENISHS MALODEING SO ON", "en", "", 0)]  # too short to tell
    got = {r.id: r for r in Q.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].kept for i in range(60)) and got[200].kept
    assert not any(got[i].kept for i in (100, 101, 102)) and not any(got[i].base_failed for i in (100, 101, 102))


def test_plan_has_no_python(spark):
    plan = Q.judged(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
