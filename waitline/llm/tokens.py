"""Token ids of whole texts by a public tokenizer file (``tokenizers`` library).

The tokenizer drops white space, so the ids of a text are those of its words
(runs without ASCII white space) one after the other, and each distinct word is
encoded once: a table of arrays, which a Python worker keeps from task to task and
looks up for all words of a slice at a time, knows words of up to ``LONGEST`` bytes by a 64-bit hash (with a full table
two of its words share one with a probability of about 1e-8). That holds for tokenizers whose pre-tokenizer never
keeps or crosses white space, such as ``word_bpe_49k.json``; ``ids_of`` is
tested against encoding whole texts.

Most of the time of encoding a single word goes into the normaliser and the
pre-tokenizer. For a word of Latin-1 letters, perhaps with one mark after it,
what these two do is known (lower case; letters and mark apart; bytes as
characters), so its parts go straight to the file's BPE model. This shortcut is
taken only for files whose normaliser and pre-tokenizer are those.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import types

import numpy as np
import pyarrow as pa

from . import common as C

NAME = "word_bpe_49k.json"
MOST_WORDS = 1_500_000  # held in a worker's table (about 100 MB); it starts anew beyond
LONGEST = 64  # bytes of a word that the table holds


def path_of(name: str = NAME) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The normaliser and pre-tokenizer that the shortcut knows.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]?)")


def _byte_characters() -> dict[int, str]:
    """Latin-1 letters as byte-level BPE writes their UTF-8 bytes: a printable
    Latin-1 byte as itself, the n-th other byte as character 256 + n."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    name = {b: chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)}
    return {c: "".join(name[b] for b in chr(c).encode()) for c in range(192, 256)}


def _known(path: str) -> bool:
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    parts = ((made.get("normalizer") or {}).get("normalizers") or []), ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [])
    return [x["type"] for x in parts[0]] == _NORMALIZERS and [x["type"] for x in parts[1]] == ["Split", "ByteLevel"] and parts[1][0]["pattern"] == {"Regex": _SPLIT}


class WordTable:
    """Words to ids, filled as words come."""

    def __init__(self, path: str):
        # a task has one core; threads would each keep an arena of memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model if _known(path) else None
        self.characters = _byte_characters()
        self._clear()

    def _clear(self):
        self.keys, self.entry = np.zeros(1 << 17, np.uint64), np.zeros(1 << 17, np.int32)
        self.flat, self.used = np.empty(1 << 18, np.uint32), 0
        self.starts, self.lengths, self.size = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int32), 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The entry of each hash, or -1 (open addressing, all at a time)."""
        out = np.full(len(h), -1, np.int64)
        mask = len(self.keys) - 1
        slot, left = (h & np.uint64(mask)).astype(np.int64), np.arange(len(h))
        while len(left):
            key = self.keys[slot]
            hit = key == h[left]
            out[left[hit]] = self.entry[slot[hit]]
            go = ~hit & (key != 0)
            left, slot = left[go], (slot[go] + 1) & mask
        return out

    def _insert(self, h: np.ndarray, entry: np.ndarray):
        """New, distinct hashes."""
        mask = len(self.keys) - 1
        slot, left = (h & np.uint64(mask)).astype(np.int64), np.arange(len(h))
        while len(left):
            free = np.flatnonzero(self.keys[slot] == 0)
            self.keys[slot[free]] = h[left[free]]  # the last of equal slots stays
            won = np.zeros(len(left), bool)
            won[free] = self.keys[slot[free]] == h[left[free]]
            self.entry[slot[won]] = entry[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & mask

    def _part(self, part: str) -> list[int]:
        return [t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.characters))]

    def _encoded(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        rest, marks, plain = [], {}, _PLAIN.fullmatch
        for k, word in enumerate(words):
            text = word.decode()
            found = plain(text) if self.model else None
            if found is None:
                rest.append((k, text))
                continue
            letters, mark = found.groups()
            ids = self._part(letters.lower())
            if mark:
                if mark not in marks:
                    marks[mark] = self._part(mark)
                ids += marks[mark]
            out[k] = ids
        for (k, _), one in zip(rest, self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)):
            out[k] = one.ids
        return out

    def _add(self, h: np.ndarray, words: list[bytes]):
        on = gc.isenabled()
        gc.disable()  # many small lists and no cycles: collections would only take time
        try:
            lists = self._encoded(words)
        finally:
            if on:
                gc.enable()
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        k, end = self.size, self.used + int(n.sum())
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while k + len(words) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.empty_like(x)]) for x in (self.starts, self.lengths))
        self.flat[self.used : end] = np.fromiter((i for ids in lists for i in ids), np.uint32, end - self.used)
        self.starts[k : k + len(words)] = self.used + np.cumsum(n) - n
        self.lengths[k : k + len(words)] = n
        self.used, self.size = end, k + len(words)
        if 2 * self.size > len(self.keys):
            old = np.flatnonzero(self.keys)
            keys, entry = self.keys[old], self.entry[old]
            size = C.power_of_two(3 * self.size, len(self.keys))
            self.keys, self.entry = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._insert(keys, entry)
        self._insert(h, np.arange(k, self.size))

    def ids_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words data[starts:ends] one after the other, and how many
        each has."""
        h = np.maximum(C.word_hashes(data, starts, ends), np.uint64(1))
        long = np.flatnonzero(ends - starts > LONGEST)
        if len(long):
            h[long] = 0
        at = self._find(h)
        missing = np.flatnonzero((at < 0) & (h > 0))
        raw = data.tobytes() if len(missing) or len(long) else b""
        if len(missing):
            new, first = np.unique(h[missing], return_index=True)
            if self.size + len(new) > MOST_WORDS:
                self._clear()
                missing = np.flatnonzero(h > 0)
                new, first = np.unique(h[missing], return_index=True)
            w = missing[first]
            self._add(new, [raw[a:b] for a, b in zip(starts[w].tolist(), ends[w].tolist())])
            at[missing] = self._find(h[missing])
        at = np.maximum(at, 0)
        n = self.lengths[at].astype(np.int64)
        n[long] = 0
        first = np.cumsum(n) - n
        ids = self.flat[np.repeat(self.starts[at] - first, n) + np.arange(int(n.sum()))]
        if len(long):
            found = [np.array(x, np.uint32) for x in self._encoded([raw[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist())])]
            ids = np.insert(ids, np.repeat(first[long], list(map(len, found))), np.concatenate(found))
            n[long] = list(map(len, found))
        return ids, n


def table_of(path: str) -> WordTable:
    """This process's table for a tokenizer file; made once, kept in
    ``sys.modules``, as what is shipped by value has no module to keep it in."""
    kept = sys.modules.setdefault(C.WORD_TABLES, types.ModuleType(C.WORD_TABLES))
    tables = kept.__dict__.setdefault("tables", {})
    if path not in tables:
        tables[path] = WordTable(path)
    return tables[path]


def documents(table: WordTable, column: pa.Array, piece: int = 1 << 20):
    """For each text of a column in turn: its ids, in arrays of about ``piece``
    bytes of text (one at least); a null is an empty text."""
    data, offsets = C.text_bytes(column)
    for i, j in C.slices(offsets, piece):
        own = data[offsets[i] : offsets[j]]
        if j == i + 1 and len(own) > piece:
            yield _long(table, own, piece)
            continue
        starts, ends, first = C.words_of(own, offsets[i : j + 1] - offsets[i])
        ids, n = table.ids_of(own, starts, ends)
        edges = np.concatenate([[0], np.cumsum(n)])[first]
        for a, b in zip(edges[:-1], edges[1:]):
            yield ids[a:b]


def _long(table: WordTable, data: np.ndarray, piece: int) -> np.ndarray:
    """Of one text, cut where a word ends."""
    parts, i = [], 0
    while i < len(data):
        j = i + piece
        while j < len(data) and not C.is_space(data[j : j + piece]).any():
            j += piece
        j = min(len(data), j + int(C.is_space(data[j : j + piece]).argmax())) if j < len(data) else len(data)
        starts, ends, _ = C.words_of(data[i:j], np.array([0, j - i]))
        parts.append(table.ids_of(data[i:j], starts, ends)[0])
        i = j
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
