"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (``DIMENSIONS`` long, seeded by its
code point). A trigram binds its letters: the product of the first one's vector
rotated by two places, the second one's by one and the third one's. Bundling, the
sum over all its trigrams, gives a text's vector and a language's prototype; the
prediction is the language whose prototype has the largest cosine, and the score
is that cosine (0 if negative). Ties go to the smallest language.

Letters are Unicode letters, lower-cased; every run of other characters, and
either end of the text, is one blank with a vector of its own, so trigrams know
the ends of words. A text without letters, or null, is ``und`` with score 0.

Learning counts trigrams by language, task by task, then sums the counts and
bundles each language's; rows whose language is null take no part. What is
learned is one vector for each distinct language label, which is broadcast: 8 KiB
a label. Prediction bundles a document from its trigram counts. Texts are worked
on in slices, whole, however long.

Learned from nothing, every prediction is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

DIMENSIONS = 1024
UNKNOWN = "und"
SLICE = 1 << 20  # characters worked on at a time
DOCUMENTS = 256  # bundled at a time
_BLANK = 32
_BITS = 21  # of a code point


class Letters:
    """Vectors of letters; filled as letters come."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.known: dict[int, np.ndarray] = {}

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), self.dimensions), np.float32)
        for k, c in enumerate(codes.tolist()):
            if c not in self.known:
                self.known[c] = np.random.default_rng(c).integers(0, 2, self.dimensions).astype(np.float32) * 2 - 1
            out[k] = self.known[c]
        return out

    def bound(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of trigram keys."""
        mask = (1 << _BITS) - 1
        out = None
        for place in (2, 1, 0):
            codes, at = np.unique(keys >> (_BITS * place) & mask, return_inverse=True)
            part = np.roll(self.vectors(codes), place, axis=1)[at]
            out = part if out is None else np.multiply(out, part, out=out)
        return out


class _Folder:
    """Texts to code points of letters and blanks."""

    def __init__(self):
        self.letter = np.full(1 << 16, -1, np.int8)

    def _learn(self, codes: np.ndarray):
        for c in np.unique(codes[self.letter[codes] < 0]).tolist():
            self.letter[c] = chr(c).isalpha()

    def codes(self, text: str) -> np.ndarray:
        """Blank, then letters and single blanks, then blank; only a blank if
        there are no letters."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        small = np.minimum(codes, 0xFFFF)
        if (codes > 0xFFFF).any():
            far = np.flatnonzero(codes > 0xFFFF)
            is_letter = np.ones(len(codes), bool)
            is_letter[far] = [chr(c).isalpha() for c in codes[far].tolist()]
        else:
            is_letter = None
        self._learn(small)
        ok = self.letter[small] == 1
        if is_letter is not None:
            ok[far] = is_letter[far]
        codes = np.concatenate([[_BLANK], np.where(ok, codes, _BLANK), [_BLANK]])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)
        return codes[keep]


def _keys(codes: np.ndarray) -> np.ndarray:
    return (codes[:-2] << 2 * _BITS) | (codes[1:-1] << _BITS) | codes[2:]


def _trigrams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, trigram key) of all texts, in slices."""
    folder, held, size = _Folder(), [], 0

    def flush():
        return np.concatenate([np.full(len(k), n) for n, k in held]), np.concatenate([k for _, k in held])

    for n, text in enumerate(texts):
        if not text:
            continue
        codes = folder.codes(text.lower())
        for i in range(0, max(0, len(codes) - 2), SLICE):
            held.append((n, _keys(codes[i : i + SLICE + 2])))
            size += len(held[-1][1])
            if size >= SLICE:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def bundles(texts: list[str | None], letters: Letters) -> tuple[np.ndarray, np.ndarray]:
    """A vector for each text and how many trigrams it has."""
    out, n = np.zeros((len(texts), letters.dimensions), np.float32), np.zeros(len(texts), np.int64)
    for doc, keys in _trigrams(texts):
        distinct, at = np.unique(keys, return_inverse=True)
        first, last = int(doc[0]), int(doc[-1]) + 1
        n += np.bincount(doc, minlength=len(texts))
        for i in range(0, len(distinct), 8192):
            own = (at >= i) & (at < i + 8192) if len(distinct) > 8192 else slice(None)
            width = min(8192, len(distinct) - i)
            counts = np.bincount((doc[own] - first) * width + at[own] - i, minlength=(last - first) * width)
            out[first:last] += counts.reshape(last - first, width).astype(np.float32) @ letters.bound(distinct[i : i + width])
    return out, n


# ------------------------------------------------------------ learning


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, n), summed over a task's batches, in parts of bounded size."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def emit():
        for lang, (keys, n) in held.items():
            for i in range(0, len(keys), 1 << 16):
                part = keys[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(n[i : i + (1 << 16)])], names=["lang", "key", "n"])

    for batch in batches:
        langs, column = np.array(batch.column(0).to_pylist(), object), batch.column(1)
        for i in range(0, batch.num_rows, DOCUMENTS):
            texts, own = column.slice(i, DOCUMENTS).to_pylist(), langs[i : i + DOCUMENTS]
            for doc, keys in _trigrams(texts):
                names = own[doc]
                for lang in dict.fromkeys(names.tolist()):
                    k, n = np.unique(keys[names == lang], return_counts=True)
                    if lang in held:
                        k0, n0 = held[lang]
                        k, at = np.unique(np.concatenate([k0, k]), return_inverse=True)
                        n = np.bincount(at, weights=np.concatenate([n0, n])).astype(np.int64)
                    held[lang] = (k, n)
        if sum(len(k) for k, _ in held.values()) > 1 << 21:
            yield from emit()
            held.clear()
    yield from emit()


def _bundler(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(dimensions), {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            keys, n = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.float64)
            for lang in dict.fromkeys(langs.tolist()):
                for i in np.array_split(np.flatnonzero(langs == lang), 1 + len(langs) // 8192):
                    sums[lang] = sums.get(lang, 0.0) + n[i] @ letters.bound(keys[i]).astype(np.float64)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions, pa.string()), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v)], names=["lang", "at", "v"])

    return run


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """The languages, ascending, and their prototypes (unit vectors)."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string"), text_col)
    counts = labelled.mapInArrow(_counter, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    sums = counts.mapInArrow(_bundler(dimensions), "lang string, at int, v double").groupBy("lang", "at").agg(F.sum("v").alias("v"))
    rows = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("v")).orderBy("lang").collect()  # a row for each language
    vectors = np.array([r.v for r in rows], np.float64).reshape(-1, dimensions)
    return [r.lang for r in rows], (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)).astype(np.float32)


# ------------------------------------------------------------ prediction


def _predictor(model, columns: int):
    """model: a broadcast of what ``learn`` returns. The text is the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, prototypes = model.value
        letters = Letters(prototypes.shape[1])
        names = np.array([UNKNOWN, *languages], object)
        for batch in batches:
            found, scores = [], []
            for i in range(0, batch.num_rows, DOCUMENTS):
                vectors, n = bundles(batch.column(columns).slice(i, DOCUMENTS).to_pylist(), letters)
                if languages:
                    norm = np.linalg.norm(vectors, axis=1)
                    cosine = vectors @ prototypes.T / np.maximum(norm, 1e-30)[:, None]
                    best = cosine.argmax(axis=1)
                    ok = n > 0
                    found.append(names[np.where(ok, best + 1, 0)])
                    scores.append(np.where(ok, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0).astype(np.float64))
                else:
                    found.append(names[np.zeros(len(n), int)])
                    scores.append(np.zeros(len(n)))
            kept = [batch.column(i) for i in range(columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(found), pa.string()), pa.array(np.concatenate(scores))], names=[str(i) for i in range(columns + 2)])

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [f"`c{i}` {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    out = docs.select(*keep, text_col).mapInArrow(_predictor(shared, len(keep)), ", ".join([*kinds, "lang_pred string", "score double"]))
    return out.toDF(*keep, "lang_pred", "score")


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text is 0 modulo ``folds``; a null id is ''."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % folds == 0
