"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

Units are characters (code points; those above U+FFFF share one), because the
corpora's words are an open class; the order is 3. There is one model for each
language, trained on the trusted documents of it. A text is scored with two start
marks before it and an end mark after it.

Training. Trigram counts of the trusted texts are summed per task and then by
key. With N1+(.bc) the number of characters seen before bc, and so on:

    p(c|ab) = max(n(abc) - D(n(abc)), 0) / n(ab) + g(ab) p(c|b)
    p(c|b)  = max(N1+(.bc) - D', 0) / N1+(.b.) + g'(b) p(c)
    p(c)    = max(N1+(.c) - D'', 0) / N1+(..) + g'' / V

where D takes three values for counts of 1, 2, and 3 or more, estimated from the
counts of counts of the order and language (Chen and Goodman), g spreads what was
taken, and V counts the language's characters and one for any other.

Scoring. A task turns its documents into postings: for each run of documents,
language and shard (of the middle character), the distinct trigrams with the
documents that hold them and how often. The model is dealt to the same shards:
the middle character decides which trigrams, contexts and bigrams a posting can
need, and only the one-character table (at most 65,536 rows) goes to all of them.
Postings and shards are joined by shard; a frequent character's postings are
spread over as many groups as runs need, each with a copy of the shard. Each group
gives its documents' sums, which are added up by run. No text is shuffled.

Threshold: a language's ``QUANTILE`` of the perplexities of its trusted documents.
With ``folds``, each is taken under a model that lacks it: trusted texts are dealt
to folds by hash (copies of a text to one), a model is trained without each fold
from the same counts, less the fold's, and a document of the fold is scored under
both in the same join. A language of fewer than ``FEWEST`` trusted texts gets, if
that is more, its median times the quantile of held-out perplexities over their
language's median, pooled over all languages; one of fewer than ``LEAST`` has no
threshold. Without folds (0), the perplexities are those under the model that has
the documents, which unseen text exceeds where a language has few of them. The
perplexity that is returned and compared is that of the whole model.
A document is kept if its perplexity is not above the threshold, or there is none.
Languages without trusted documents have no model: perplexity and threshold are
null and documents are kept.
A text that is null or empty has no perplexity and is not kept. A null language
is one of its own (''). Repeated rows and ids are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

QUANTILE = 0.99
SHARDS = 16
RUN = 1 << 20  # characters of a run of documents
RUNS_A_GROUP = 128
FOLDS = 5  # of the query
FEWEST = 100  # trusted texts of a language from which on its own quantile stands
LEAST = 10  # with fewer there is no threshold
MOST_TRUSTED = 4_000_000  # ids that are broadcast; with more, they are joined by a shuffle
_START, _END, _FAR = 2, 3, 0xFFFF
_MASK = (1 << 16) - 1


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.concatenate([[_START, _START], np.minimum(codes, _FAR), [_END]]).astype(np.int64)


def trigrams(text: str) -> np.ndarray:
    """Keys of the trigrams: 16 bits a character, the last one lowest."""
    c = _codes(text)
    return c[:-2] << 32 | c[1:-1] << 16 | c[2:]


# ------------------------------------------------------------ training


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, fold, text) to counts by (lang, fold) and trigram."""
    held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    fresh: dict[tuple, list[np.ndarray]] = {}
    size = 0

    def fold():
        for own, parts in fresh.items():
            k, n = np.unique(np.concatenate(parts), return_counts=True)
            if own in held:
                k0, n0 = held[own]
                k, at = np.unique(np.concatenate([k0, k]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([n0, n])).astype(np.int64)
            held[own] = (k, n)
        fresh.clear()

    def emit():
        for (lang, part_of), (keys, n) in held.items():
            for i in range(0, len(keys), 1 << 16):
                part = keys[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array([part_of] * len(part), pa.int32()), pa.array(part), pa.array(n[i : i + (1 << 16)])], names=["lang", "fold", "key", "n"])
        held.clear()

    for batch in batches:
        for lang, part_of, text in zip(*(batch.column(i) for i in range(3))):
            if text := text.as_py():
                keys = trigrams(text)
                fresh.setdefault((lang.as_py(), part_of.as_py()), []).append(keys)
                size += len(keys)
                if size > 1 << 20:
                    fold()
                    size = 0
                    if sum(len(k) for k, _ in held.values()) > 1 << 21:
                        yield from emit()
    fold()
    yield from emit()


_OF = ["lang", "fold"]


def _discounts(counts: DataFrame, n: str) -> DataFrame:
    """(lang, fold, d): the three discounts of an order, as an array."""
    of = lambda k: F.sum(F.when(F.col(n) == k, 1).otherwise(0)).cast("double")
    c = counts.groupBy(*_OF).agg(*(of(k).alias(f"c{k}") for k in (1, 2, 3, 4)))
    y = F.when(F.col("c1") > 0, F.col("c1") / (F.col("c1") + 2 * F.col("c2"))).otherwise(F.lit(0.5))

    def d(k: int) -> Column:
        estimate = F.when(F.col(f"c{k}") > 0, k - (k + 1) * y * F.col(f"c{k + 1}") / F.col(f"c{k}")).otherwise(F.lit(0.5 * k))
        return F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), estimate))  # few counts: what is taken stays positive and below the count

    return c.select(*_OF, F.array(d(1), d(2), d(3)).alias("d"))


def _discount(n: Column) -> Column:
    return F.when(n == 1, F.col("d")[0]).when(n == 2, F.col("d")[1]).otherwise(F.col("d")[2])


def _contexts(counts: DataFrame, context: list[str], n: str) -> DataFrame:
    """For each context: its total and what its discounts free, as a share."""
    return counts.groupBy(*_OF, *context).agg(F.sum(n).cast("double").alias("total"), (F.sum(_discount(F.col(n))) / F.sum(n)).alias("free"))


def train(texts: DataFrame, folds: int) -> DataFrame:
    """texts: (lang, fold, text). The models as rows (lang, kind, key, values), values
    being those of the whole model and of the models that lack fold 0, 1 and so on,
    with NaN where a model has none. Kind 3: p(c|ab) of seen trigrams; 2: g(ab); 1:
    p(c|b) of seen bigrams; 0: g'(b); -1: p(c); -2: p of any other character (key 0)."""
    own = [F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)) for f in range(folds)]
    counts = texts.mapInArrow(_counter, "lang string, fold int, key long, n long").groupBy("lang", "key").agg(F.array(F.sum("n"), *(F.sum("n") - x for x in own)).alias("all"))
    counts = counts.select("lang", "key", F.posexplode("all").alias("fold", "n")).where("n > 0")  # fold 0: the whole, f + 1: without f
    low = lambda shift, c="key": F.shiftright(c, shift).bitwiseAND(F.lit(_MASK))
    tri = C.stored(counts.select(*_OF, F.shiftright("key", 16).alias("ab"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("bc"), F.col("n").cast("double").alias("n")), "trigrams")
    bi = C.stored(tri.groupBy(*_OF, "bc").agg(F.count(F.lit(1)).cast("double").alias("n")).select(*_OF, low(16, "bc").alias("b"), low(0, "bc").alias("c"), "n"), "bigrams")
    uni = bi.groupBy(*_OF, "c").agg(F.count(F.lit(1)).cast("double").alias("n"))
    uni = uni.join(_discounts(uni, "n"), _OF)
    whole = uni.groupBy(*_OF).agg(F.sum("n").alias("total"), F.sum(_discount(F.col("n"))).alias("freed"), (F.count(F.lit(1)) + 1).alias("v"))
    whole = C.stored(whole.select(*_OF, "total", (F.col("freed") / F.col("total") / F.col("v")).alias("other")), "whole")
    uni = uni.join(whole, _OF).select(*_OF, "c", ((F.col("n") - _discount(F.col("n"))) / F.col("total") + F.col("other")).alias("p"))
    uni = C.stored(uni, "unigrams")
    bi = bi.join(_discounts(bi, "n"), _OF)
    bi_contexts = C.stored(_contexts(bi, ["b"], "n"), "contexts1")
    bi = bi.join(bi_contexts, [*_OF, "b"]).join(uni, [*_OF, "c"])
    bi = C.stored(bi.select(*_OF, "b", "c", ((F.col("n") - _discount(F.col("n"))) / F.col("total") + F.col("free") * F.col("p")).alias("p")), "bigrams")
    tri = tri.join(_discounts(tri, "n"), _OF)
    tri_contexts = C.stored(_contexts(tri, ["ab"], "n"), "contexts2")
    tri = tri.join(tri_contexts, [*_OF, "ab"]).join(bi.withColumn("bc", F.shiftleft("b", 16).bitwiseOR(F.col("c"))), [*_OF, "bc"])
    key = F.shiftleft("ab", 16).bitwiseOR(F.col("c"))
    tri = tri.select(*_OF, F.lit(3).alias("kind"), key.alias("key"), ((F.col("n") - _discount(F.col("n"))) / F.col("total") + F.col("free") * F.col("p")).alias("value"))
    out = tri.unionAll(tri_contexts.select(*_OF, F.lit(2), "ab", "free"))
    out = out.unionAll(bi.select(*_OF, F.lit(1), F.shiftleft("b", 16).bitwiseOR(F.col("c")), "p"))
    out = out.unionAll(bi_contexts.select(*_OF, F.lit(0), "b", "free"))
    out = out.unionAll(uni.select(*_OF, F.lit(-1), "c", "p"))
    out = out.unionAll(whole.select(*_OF, F.lit(-2), F.lit(0).cast("long"), "other"))
    value = lambda f: F.coalesce(F.max(F.when(F.col("fold") == f, F.col("value"))), F.lit(float("nan")))
    return C.stored(out.groupBy("lang", "kind", "key").agg(F.array(*(value(f) for f in range(folds + 1))).alias("values")), "model")


def _shard(middle: Column, shards: int) -> Column:
    return F.pmod(middle, F.lit(shards)).cast("int")


def _sharded(model: DataFrame, shards: int, salts: int) -> DataFrame:
    """The model's rows in every group that can need them."""
    middle = F.when(F.col("kind") == 3, F.shiftright("key", 16).bitwiseAND(F.lit(_MASK))).when(F.col("kind") == 2, F.col("key").bitwiseAND(F.lit(_MASK))).when(F.col("kind") == 1, F.shiftright("key", 16)).when(F.col("kind") == 0, F.col("key"))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    out = model.withColumn("shard", F.explode(F.when(middle.isNull(), every).otherwise(F.array(_shard(middle, shards)))))
    return out.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


# ------------------------------------------------------------ postings


_POSTING = "run long, lang string, shard int, salt int, keys binary, sizes binary, docs binary, counts binary, n int, ids binary, folds binary"
_POSTING_SCHEMA = pa.schema([("run", pa.int64()), ("lang", pa.string()), ("shard", pa.int32()), ("salt", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("docs", pa.binary()), ("counts", pa.binary()), ("n", pa.int32()), ("ids", pa.binary()), ("folds", pa.binary())])


def _pack(x: np.ndarray, kind: str) -> bytes:
    """Packed with the bytes of equal weight side by side."""
    raw = np.ascontiguousarray(np.ascontiguousarray(x.astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(raw.tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 31), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _deltas(x: np.ndarray, kind: str) -> bytes:
    return _pack(np.diff(x, prepend=0), kind)


def _poster(shards: int, salts: int, folds: int):
    """Rows (lang, id, trusted, mark, fold, text) to postings. A run's first row, told
    by its ``ids``, has what its documents are and how many trigrams each has; the
    others have the model that each document is held out with (0: none)."""

    def flush(lang: str, docs: list[tuple], run: int):
        n = np.array([len(d[-1]) for d in docs], np.int64)
        ids = np.array([(i or 0, i is None, t, mark) for i, t, mark, _, _ in docs], np.int64).T
        without = _pack(np.array([f + 1 if t else 0 for _, t, _, f, _ in docs]), "<i4") if folds else b""
        salt = run % salts
        yield (run, lang, run % shards, salt, b"", _pack(n, "<i8"), b"", b"", len(docs), _pack(ids.ravel(), "<i8"), b"")
        if not n.sum():
            return
        distinct, at = np.unique(np.concatenate([d[-1] for d in docs]), return_inverse=True)
        # by key, then document: one sort of both in one number
        both = np.sort(at * len(docs) + np.repeat(np.arange(len(docs)), n))
        heads = np.flatnonzero(np.diff(both, prepend=-1))
        counts = np.diff(heads, append=len(both))
        at, doc = np.divmod(both[heads], len(docs))
        sizes = np.bincount(at, minlength=len(distinct))
        shard = (distinct >> 16 & _MASK) % shards
        for s in np.unique(shard).tolist():
            own, rows = np.flatnonzero(shard == s), (shard == s)[at]
            yield (run, lang, s, salt, _deltas(distinct[own], "<i8"), _pack(sizes[own], "<i4"), _deltas(doc[rows], "<i4"), _pack(counts[rows], "<i4"), len(docs), b"", without)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 24

        def out(lang: str):
            nonlocal number
            rows = list(zip(*flush(lang, held.pop(lang), number)))
            size[lang] = 0
            number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _POSTING_SCHEMA)], schema=_POSTING_SCHEMA)

        for batch in batches:
            for lang, id_, trusted, mark, fold, text in zip(*(batch.column(i) for i in range(6))):
                lang, text = lang.as_py(), text.as_py()
                keys = trigrams(text) if text else np.zeros(0, np.int64)
                held.setdefault(lang, []).append((id_.as_py(), trusted.as_py(), mark.as_py(), fold.as_py(), keys))
                size[lang] = size.get(lang, 0) + len(keys) + 64
                if size[lang] >= RUN:
                    yield out(lang)
        for lang in list(held):
            yield out(lang)

    return run


def _found(table_keys: np.ndarray, values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a key is in the sorted table, its value), for each model."""
    if not len(table_keys):
        return np.zeros((len(keys), values.shape[1]), bool), np.zeros((len(keys), values.shape[1]))
    at = np.minimum(np.searchsorted(table_keys, keys), len(table_keys) - 1)
    got = values[at]
    ok = (table_keys[at] == keys)[:, None] & ~np.isnan(got)
    return ok, np.where(ok, got, 0.0)


def log_probabilities(model: dict[int, tuple[np.ndarray, np.ndarray]], keys: np.ndarray) -> np.ndarray:
    """Natural logarithms, a row for each key and a column for each model (NaN: the
    model is not there); model: for each kind, sorted keys and rows of values."""
    none = (np.zeros(0, np.int64), np.zeros((0, model[-2][1].shape[1])))
    look = lambda kind, k: _found(*model.get(kind, none), k)
    c, b, ab, bc = keys & _MASK, keys >> 16 & _MASK, keys >> 16, keys & (1 << 32) - 1
    seen, p3 = look(3, keys)
    known, p1 = look(-1, c)
    p1 = np.where(known, p1, model[-2][1][0])
    context, g1 = look(0, b)
    seen2, p2 = look(1, bc)
    p2 = np.where(seen2, p2, np.where(context, g1, 1.0) * p1)
    context, g2 = look(2, ab)
    return np.log(np.where(seen, p3, np.where(context, g2, 1.0) * p2))


_SUMS = "run long, lang string, sums binary, held binary, sizes binary, ids binary"
_SUMS_SCHEMA = pa.schema([("run", pa.int64()), ("lang", pa.string()), ("sums", pa.binary()), ("held", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])


def _score(postings: pa.Table, model: pa.Table) -> pa.Table:
    """A shard's postings and its part of the model: each run's partial sums."""
    tables, out = {}, []
    if model.num_rows:
        kind, key = (model.column(c).to_numpy() for c in ("kind", "key"))
        value = model.column("values").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
        for k in np.unique(kind).tolist():
            own = np.flatnonzero(kind == k)
            own = own[np.argsort(key[own], kind="stable")]
            tables[k] = (key[own], value[own])
    for i in range(postings.num_rows):
        r = {c: postings.column(c)[i].as_py() for c in ("run", "lang", "keys", "sizes", "docs", "counts", "n", "ids", "folds")}
        if r["ids"]:
            out.append((r["run"], r["lang"], b"", b"", r["sizes"], r["ids"]))
        elif tables:
            logs = log_probabilities(tables, np.cumsum(_unpack(r["keys"], "<i8")))
            docs, counts = np.cumsum(_unpack(r["docs"], "<i4").astype(np.int64)), _unpack(r["counts"], "<i4")
            at = np.repeat(np.arange(len(logs)), _unpack(r["sizes"], "<i4"))
            sums = np.bincount(docs, weights=logs[at, 0] * counts, minlength=r["n"])
            held = b""
            if r["folds"] and (without := _unpack(r["folds"], "<i4")).any():
                held = np.bincount(docs, weights=logs[at, without[docs]] * counts, minlength=r["n"]).astype("<f8").tobytes()
            out.append((r["run"], r["lang"], sums.astype("<f8").tobytes(), held, b"", b""))
    cols = list(zip(*out)) or [[]] * 6
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SUMS_SCHEMA)], schema=_SUMS_SCHEMA)


def _add_up(group: pa.Table) -> pa.Table:
    """A run's rows: its documents with the sums of all shards."""
    rows = group.to_pylist()
    head = next(r for r in rows if r["ids"])
    ids, null, trusted, marks = _unpack(head["ids"], "<i8").reshape(4, -1)
    n = _unpack(head["sizes"], "<i8")
    parts = [np.frombuffer(r["sums"], "<f8") for r in rows if r["sums"]]
    total = np.sum(np.stack(parts), axis=0) if parts else np.zeros(len(n))
    parts_held = [np.frombuffer(r["held"], "<f8") for r in rows if r["held"]]
    held = np.sum(np.stack(parts_held), axis=0) if parts_held else np.full(len(n), np.nan)
    return pa.table(
        {
            "id": pa.array(ids, mask=null == 1),
            "lang": pa.array([head["lang"]] * len(n), pa.string()),
            "trusted": pa.array(trusted == 1),
            "mark": pa.array(marks),
            "units": pa.array(n),
            "log_p": pa.array(total, mask=(n == 0) | (not parts)),
            "held_log_p": pa.array(held, mask=(n == 0) | (trusted == 0) | np.isnan(held)),
        }
    )


def scored(rows: DataFrame, model: DataFrame, salts: int, folds: int) -> DataFrame:
    """rows: (lang, id, trusted, mark, fold, text). id, lang, trusted, mark, units,
    log_p, held_log_p of each; log_p is null without a text or a model, held_log_p
    also of documents that are not trusted."""
    postings = rows.select("lang", "id", "trusted", "mark", "fold", "text").mapInArrow(_poster(SHARDS, salts, folds), _POSTING)
    key = ["lang", "shard", "salt"]
    sums = postings.groupBy(*key).cogroup(_sharded(model, SHARDS, salts).groupBy(*key)).applyInArrow(_score, _SUMS)
    return sums.groupBy("run").applyInArrow(_add_up, "id long, lang string, trusted boolean, mark long, units long, log_p double, held_log_p double")


def _thresholds(out: DataFrame, quantile: float) -> DataFrame:
    """(lang, threshold) from held-out perplexities."""
    held = out.where("held IS NOT NULL")
    texts = held.select("lang", "mark").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))  # apart: beside a distinct count, quantiles are not summed per task
    own = held.groupBy("lang").agg(F.percentile_approx("held", quantile, 10_000).alias("top"), F.percentile_approx("held", 0.5, 10_000).alias("median"))
    own = C.few(C.stored(own.join(texts, "lang"), "limits"))  # a row for each language
    ratio = held.join(own, "lang").agg(F.percentile_approx(F.col("held") / F.col("median"), quantile, 10_000)).first()[0]
    pooled = F.greatest(F.col("top"), F.col("median") * F.lit(ratio).cast("double"))
    return own.select("lang", F.when(F.col("texts") >= FEWEST, F.col("top")).when(F.col("texts") >= LEAST, pooled).alias("threshold"))


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, folds: int = 0) -> DataFrame:
    """id, lang, trusted, units (trigrams scored), perplexity, threshold, kept for
    each row of ``docs``. ``trusted``: a one-column frame of the ids of trusted
    documents. ``folds``: of the trusted texts, two at least for held-out thresholds;
    0 takes the threshold from the documents that the model was trained on."""
    ids = C.stored(trusted.toDF("_id").where("_id IS NOT NULL").distinct(), "trusted")
    few = ids.count() <= MOST_TRUSTED
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    marked = own.join((F.broadcast(ids) if few else ids).withColumn("_t", F.lit(True)), F.col("id") == F.col("_id"), "left").select("id", "lang", "text", F.coalesce("_t", F.lit(False)).alias("trusted"))
    marked = marked.withColumn("mark", F.xxhash64("text")).withColumn("fold", F.pmod("mark", F.lit(max(folds, 1))).cast("int"))
    model = train(marked.where("trusted").select("lang", "fold", "text"), folds)
    size = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    salts = max(1, round(size / RUN / RUNS_A_GROUP))
    perplexity = lambda log_p: F.when(F.col("units") > 0, F.exp(-F.col(log_p) / F.col("units")))
    out = scored(marked, model, salts, folds).select("id", "lang", "trusted", "mark", "units", perplexity("log_p").alias("perplexity"), perplexity("held_log_p").alias("held"))
    out = C.stored(out, "scored")
    limit = _thresholds(out, quantile) if folds else out.where("trusted").groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    out = out.join(C.few(C.stored(limit, "limits")), "lang", "left")  # a row for each language
    kept = (F.col("units") > 0) & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select("id", "lang", "trusted", "units", "perplexity", "threshold", kept.alias("kept"))
