"""Spelling variants: words of a corpus that differ by one edit, and the form
that each one most likely stands for.

A run is a maximal sequence of ``[A-Za-z\\u00C0-\\u00FF]``; A to Z are lower-cased.
Words are the runs of at least ``LEAST_LENGTH`` code points that occur
``LEAST_COUNT`` times or more. Two words are near if they differ by exactly one
inserted, deleted or replaced code point.

*Lists.* Of two near words, the shorter of s code points, both begin or both end
with the same s // 2 code points. Each word goes into the lists of its beginnings
and, spelled backwards, of its endings, for s its own length and one less; a pair
that shares both counts in the list of the beginning only. So each pair is met in
exactly one list, and no list is the whole vocabulary.

*Scan.* A list is sorted. For each word the words after it are scanned with a
banded edit matrix: the row at depth d holds the distances of a word's first d
code points to the d - 1, d and d + 1 first ones of the word asked for. Words
whose LCP reaches d share that row; where it exceeds one edit throughout, every
word of that range is skipped at once. NumPy does a depth of several lists at a
time.

*Long lists.* A list of more than ``MOST_LISTED`` words, all beginning with P, is
replaced by the lists of P and one more code point, and by lists of words that are
equal but for what stands right after P (a handful of words each). This repeats
until no list is longer, so that no task holds an unbounded one; no pair is lost.

A list returns, for each of its words, the number of near words and the best one;
pairs are never written. Near words of largest count (ties: smallest in code-point
order) become a word's form where they occur ``TIMES`` times as often or more.
Roots follow forms by pointer doubling: counts grow by ``TIMES`` along a chain.

``corrupted`` can misspell some runs first (a test set with known answers).

Null texts have no words; a null id reads as an empty text. Repeated rows and ids
count each. An empty table has no words. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5
MOST_LISTED = 20_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def corrupted(id_: Column, run: Column, one_in: int) -> Column:
    """``run`` without one code point, where the crc32 h of ``<id>:<run>`` is
    divisible by ``one_in``: the code point h % length, from 0."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % one_in == 0, less).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int | None = None) -> DataFrame:
    """(word, n) of the words long and frequent enough; ``one_in``: see ``corrupted``."""
    runs = F.regexp_extract_all(F.translate(text_col, _UPPER, _UPPER.lower()), F.lit(RUN), 0)
    # explode_outer with a filter above it: explode alone evaluates the pattern twice
    df = docs.select(F.col(id_col).alias("id"), F.explode_outer(runs).alias("word")).where(F.col("word").isNotNull())
    if one_in:
        df = df.select(corrupted(F.col("id"), F.col("word"), one_in).alias("word"))
    return df.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


# ------------------------------------------------------------ lists

_BEGINNING, _ENDING = 0, 1
#: kind: by beginning or ending; s: code points of the shorter of a pair; shared: code
#: points that all begin with; split: whether pairs must differ right after those;
#: rest: what follows the differing code point (split lists).
_LIST = ["kind", "s", "shared", "head", "split", "rest"]


def _members(words: DataFrame) -> DataFrame:
    """The rows of all lists: _LIST, text (backwards for endings), n."""
    length = F.length("word")
    sizes = F.filter(F.array(length, length - 1), lambda s: s >= 1)
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), t.alias("text")) for k, t in ((_BEGINNING, F.col("word")), (_ENDING, F.reverse("word")))))
    df = words.select("word", "n", F.explode(sizes).alias("s")).select("n", "s", F.explode(kinds).alias("k"))
    shared = F.floor(F.col("s") / 2).cast("int")
    df = df.select(F.col("k.kind").alias("kind"), "s", shared.alias("shared"), F.substring(F.col("k.text"), F.lit(1), shared).alias("head"), F.lit(False).alias("split"), F.lit("").alias("rest"), F.col("k.text").alias("text"), "n")
    return df


def _sublists(df: DataFrame) -> DataFrame:
    """The rows of lists that are too long, in the lists that replace them."""
    after = lambda k: F.substring(F.col("text"), F.col("shared") + 1 + k, F.length("text"))
    entry = lambda shared, head, split, rest: F.struct(shared.alias("shared"), head.alias("head"), split.alias("split"), rest.alias("rest"))
    short = F.length("text") == F.col("s")
    split = lambda tag, rest: entry(F.col("shared"), F.col("head"), F.lit(True), F.concat(F.lit(tag), rest))
    deeper = entry(F.col("shared") + 1, F.substring(F.col("text"), F.lit(1), F.col("shared") + 1), F.lit(False), F.lit(""))
    lists = F.array(
        F.when(F.length("text") > F.col("shared"), deeper),
        F.when(short & (F.length("text") > F.col("shared")), split("=", after(1))),  # one replaced
        F.when(short, split("+", after(0))).otherwise(split("+", after(1))),  # one more in the longer
    )
    df = df.withColumn("_new", F.explode(F.filter(lists, lambda x: x.isNotNull())))
    return df.select("kind", "s", *(F.col(f"_new.{c}").alias(c) for c in ("shared", "head", "split", "rest")), "text", "n")


def _bounded(df: DataFrame, most: int) -> DataFrame:
    """``df`` with every list of more than ``most`` words replaced."""
    done = []
    while True:
        # a split list has at most one word for each code point there is
        long = C.stored(df.where("NOT split").groupBy(*_LIST).count().where(F.col("count") > most).select(*_LIST), "long-lists")
        if long.isEmpty():
            break
        long = C.few(long)
        done.append(df.join(long, _LIST, "left_anti"))
        df = C.stored(_sublists(df.join(long, _LIST, "left_semi").select(*df.columns)), "sublists")
    for d in done:
        df = df.unionByName(d)
    return df


# ------------------------------------------------------------ inside tasks


def near_pairs(rests: list[str], lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), i < j, of words one edit apart. ``rests``: the words of several lists
    without what their list shares, sorted and distinct in each; ``lists``: the
    list of each, ascending.

    A prefix of depth d stands for the range of adjacent words whose LCP reaches d.
    The frontier holds the pairs (word asked for, prefix) whose matrix row (left,
    mid, right) is not past one edit: a row is computed once for all words below a
    prefix, and a pair that is dropped skips them all."""
    size = np.array([len(r) for r in rests], np.int64)
    codes = np.frombuffer("".join(r + "\0\0\0" for r in rests).encode("utf-32-le"), np.uint32)
    start = np.cumsum(size + 3) - (size + 3)
    at = np.arange(len(rests))  # words that reach this depth
    prefix = np.unique(lists, return_inverse=True)[1]  # of each of them
    lo = np.flatnonzero(np.diff(prefix, prepend=-1))  # first word of each prefix
    q, node = at, prefix
    left, mid, right = np.full(len(q), 2, np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)
    found, d = [], 0
    while len(q):
        # a word that ends here is the first of its prefix
        first = lo[node]
        ends = np.flatnonzero((size[first] == d) & (first > q))
        over = d - size[q[ends]]
        near = ((over == 0) & (mid[ends] == 1)) | ((over == 1) & (left[ends] == 1)) | ((over == -1) & (right[ends] == 1))
        found.append((q[ends[near]], first[ends[near]]))
        # prefixes one deeper
        longer = size[at] > d
        at, parent = at[longer], prefix[longer]
        code = codes[start[at] + d]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(parent) != 0) | (code[1:] != code[:-1])
        heads = np.flatnonzero(new)
        prefix = np.cumsum(new) - 1
        lo, last = at[heads], at[np.append(heads[1:], len(at)) - 1] if len(heads) else at
        edges = np.searchsorted(parent[heads], np.arange(int(node.max()) + 2))
        count = edges[node + 1] - edges[node]
        pair = np.repeat(np.arange(len(q)), count)
        below = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + edges[node[pair]]
        later = last[below] > q[pair]
        pair, below = pair[later], below[later]
        q, code, l, m, r = q[pair], code[heads[below]], left[pair], mid[pair], right[pair]
        own = start[q] + d
        left = np.minimum(l + (code != codes[own - 1]), m + 1) if d else m + 1
        mid = np.minimum(np.minimum(m + (code != codes[own]), r + 1), left + 1)
        right = np.minimum(r + (code != codes[own + 1]), mid + 1)
        alive = (left < 2) | (mid < 2) | (right < 2)
        q, node, left, mid, right = q[alive], below[alive], left[alive], mid[alive], right[alive]
        d += 1
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


_FOUND = "word string, n_near long, best_n long, best string"
_FOUND_SCHEMA = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _scan(rows: list[tuple]) -> pa.RecordBatch:
    """The words of whole lists (the rows of _members, sorted by list and text) that
    have near words: (word, near words, count of the best, the best)."""
    kind, s, shared, head, split, rest, text, n = zip(*rows)
    new = [True] + [a[:6] != b[:6] for a, b in zip(rows[1:], rows)]
    rests = [t[k:] for t, k in zip(text, shared)]
    i, j = near_pairs(rests, np.cumsum(new))
    words = [t[::-1] if k == _ENDING else t for t, k in zip(text, kind)]
    s, size = np.array(s), np.array([len(t) for t in text])
    keep = np.minimum(size[i], size[j]) == s[i]  # else met in the lists of their own length
    starts = np.unique([w[: k // 2] for w, k in zip(words, s)], return_inverse=True)[1]
    keep &= (np.array(kind)[i] == _BEGINNING) | (starts[i] != starts[j])  # else met by their beginning
    after = np.array([ord(r[0]) if r else 0 for r in rests])
    keep &= ~np.array(split)[i] | (after[i] != after[j])  # else met in the list of the longer beginning
    a, b = np.concatenate([i[keep], j[keep]]), np.concatenate([j[keep], i[keep]])
    n = np.array(n, np.int64)
    place = np.unique(words, return_inverse=True)[1]  # in code-point order
    order = np.lexsort((place[b], -n[b], a))
    a, b = a[order], b[order]
    heads = np.flatnonzero(np.diff(a, prepend=-1))
    near = np.diff(np.append(heads, len(a)))
    of, best = a[heads], b[heads]
    columns = [pa.array([words[k] for k in of], pa.string()), pa.array(near, pa.int64()), pa.array(n[best], pa.int64()), pa.array([words[k] for k in best], pa.string())]
    return pa.RecordBatch.from_arrays(columns, schema=_FOUND_SCHEMA)


def _scanner(most_rows: int = 20_000, most_codes: int = 2_000_000):
    """Rows sorted by list and text -> what ``_scan`` finds; several lists at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, codes = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if (len(held) >= most_rows or codes >= most_codes) and row[:6] != held[-1][:6]:
                    yield _scan(held)
                    held, codes = [], 0
                held.append(row)
                codes += len(row[6])
        if held:
            yield _scan(held)
        held = []
        C.give_back()

    return run


# ------------------------------------------------------------ operators


def near_words(words: DataFrame, most_listed: int = MOST_LISTED) -> DataFrame:
    """(word, n_near, best_n, best) of the rows of (word, n), words distinct, that
    have near words; best: the near word of largest n (ties: the smallest)."""
    rows = _bounded(_members(words), most_listed).select(*_LIST, "text", "n")
    rows = rows.repartition(*_LIST).sortWithinPartitions(*_LIST, "text")
    found = rows.mapInArrow(_scanner(), _FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, root), where root is at first the next word: each round
    doubles the steps taken, until no root leads further."""
    while True:
        links = C.stored(links, "roots")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = links.join(C.few(further), "root", "left")
        moved = C.stored(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "moved")
        if moved.where("moved").isEmpty():
            return links
        links = moved.select("word", "root")


def grouped(words: DataFrame, times: int = TIMES, most_listed: int = MOST_LISTED) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each row of (word, n)."""
    words = C.stored(words, "vocabulary")
    df = words.join(near_words(words, most_listed), "word", "left")
    formed = F.col("best_n") >= times * F.col("n")
    near = F.coalesce("n_near", F.lit(0)).cast("long")
    df = df.select("word", "n", near.alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"))
    df = C.stored(df, "forms")
    roots = _roots(df.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return df.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
