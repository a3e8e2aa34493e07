"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprint: the text with A-Z lower-cased, its words (runs without ASCII
white space), its shingles of ``shingle`` words joined by spaces, repeats
included (fewer words: the whole sequence); each shingle is hashed with XXH64
(seed 42); a bit is 1 if it is set in over half the hashes. No words: zero,
linked like any other fingerprint. Fingerprints link at ``distance`` or fewer
differing bits; a component is what links reach.

1. Equal fingerprints become one class (its smallest id) before anything else,
   so a group of copies costs one row, however large.
2. Bits that are correlated over all classes are grouped into the same part
   (``correlated_parts``). Parts with thresholds t_i, where the sum of
   (t_i + 1) is distance + 1, find every link: if each part differed in more
   than t_i bits, over ``distance`` bits would differ. Dynamic programming
   (``allocate``) gives the thresholds, a part may get none (-1), that cost the
   least rows to probe plus candidate pairs, estimated over all classes.
3. Probes carry the part's value with up to t_i bits flipped. Rows that share a
   value meet in one task. A value with more than ``MOST_ROWS`` rows is cut into
   blocks by a hash, and its rows go to a task for each pair of blocks that
   theirs is in: no bucket is capped, no task holds over two blocks.
4. A task verifies candidates on the full fingerprint and emits, for each
   bucket, the edges of a spanning forest of its links, never all pairs.
5. Components: large-star and small-star steps on the edges (joins and
   aggregates), each written to the shared folder, until nothing changes.

Rows with a null id take part under no class: they get the component null. A
null text is an empty one. Repeated ids or rows are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
MOST_ROWS = 4096  # of a block of a bucket; a task compares two
PARTS = (2, 3, 4)  # numbers of parts to choose from
LONG_MASK = (1 << 64) - 1


def _signed(x: int) -> int:
    x &= LONG_MASK
    return x - (1 << 64) if x >> 63 else x


# ------------------------------------------------------------ fingerprints


def _bit_counts(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(raw: bytes, shingle: int = SHINGLE, chunk: int = 1 << 17) -> int:
    """Of the UTF-8 bytes of a text. ``chunk``: hashes held at a time."""
    words = raw.lower().split()  # bytes: lower() is A-Z only, split() ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        starts, ends = [0], [len(joined)]
    else:
        length = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length + 1) - 1
        starts, ends = (end - length)[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), chunk):
        counts += _bit_counts([hashed(joined[a:b], SEED) for a, b in zip(starts[i : i + chunk], ends[i : i + chunk])])
    return sum(1 << b for b in np.flatnonzero(counts * 2 > len(starts)).tolist())


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.drop_tables()
        for batch in batches:
            data, offsets = C.text_bytes(batch.column(1))
            raw = memoryview(data)
            prints = [fingerprint(bytes(raw[a:b]), shingle) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["id", "fp"])
        C.give_back()

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every row as a signed long."""
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_fingerprints(shingle), "id long, fp long")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------------ parts and thresholds


def _co_occurrence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        raw = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
        for i in range(0, len(raw), 1 << 16):
            bits = np.unpackbits(raw[i : i + (1 << 16)], axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
    j, k = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(j.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[j, k])], names=["j", "k", "n"])


def bit_statistics(fps: DataFrame) -> np.ndarray:
    """How often each pair of bits is set together, over all rows of ``fps``."""
    out = np.zeros((BITS, BITS))
    for r in fps.mapInArrow(_co_occurrence, "j int, k int, n long").groupBy("j", "k").agg(F.sum("n").alias("n")).collect():  # 64 * 64 rows at most
        out[r.j, r.k] = r.n
    return out


def correlated_parts(together: np.ndarray, n: int, m: int) -> list[list[int]]:
    """``m`` parts of nearly equal size; each grows by the bit that is most
    correlated with it."""
    p = together.diagonal() / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    cor = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(cor, 0)
    free, parts = set(range(BITS)), []
    for i in range(m):
        size = len(free) // (m - i)
        rest = sorted(free)
        sub = cor[np.ix_(rest, rest)]
        part = [rest[int(np.argmax(sub.sum(axis=1)))]]
        free.discard(part[0])
        while len(part) < size:
            rest = sorted(free)
            nxt = rest[int(np.argmax(cor[np.ix_(part, rest)].sum(axis=0)))]
            part.append(nxt)
            free.discard(nxt)
        parts.append(sorted(part))
    return parts


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _candidates(part: list[int], equal_pairs: float, p: np.ndarray, most: int) -> list[float]:
    """Estimated pairs within 0..most differing bits of the part: the pairs
    equal on it, counted over all rows, times the odds that chosen bits differ."""
    differ = 2 * p[part] * (1 - p[part])
    odds = differ / np.maximum(1 - differ, 1e-9)
    poly = np.zeros(most + 1)
    poly[0] = 1
    for o in odds:
        poly[1:] += poly[:-1] * o
    return list(equal_pairs * np.cumsum(poly))


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds t_i from -1 up, where the sum of (t_i + 1) is distance + 1,
    of the least total cost; costs[i][t] is that of part i at t, -1 is free."""
    best = {0: (0.0, [])}
    for cost in costs:
        step = {}
        for used, (c, ts) in best.items():
            for t in range(-1, distance - used + 1):
                x = (c + (cost[t] if t >= 0 else 0.0), [*ts, t])
                if used + t + 1 not in step or x[0] < step[used + t + 1][0]:
                    step[used + t + 1] = x
        best = step
    return best[distance + 1]


def plan(fps: DataFrame, n: int, distance: int = DISTANCE) -> tuple[list[list[int]], list[int]]:
    """The parts and their thresholds for the distinct fingerprints ``fps``."""
    together = bit_statistics(fps)
    choices = [correlated_parts(together, n, m) for m in PARTS]
    flat = [(i, j, part) for i, parts in enumerate(choices) for j, part in enumerate(parts)]
    keys = F.array(*(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(_mask(part)))).alias("v")) for k, (_, _, part) in enumerate(flat)))
    sizes = fps.select(F.explode(keys).alias("x")).groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("n"))
    pairs = {r.k: r.pairs for r in sizes.groupBy("k").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()}  # one row a part
    p = together.diagonal() / max(n, 1)
    found = []
    for i, parts in enumerate(choices):
        costs = []
        for j, part in enumerate(parts):
            k = flat.index((i, j, part))
            candidates = _candidates(part, (pairs.get(k) or 0) + n * n / 2.0 ** (len(part) + 1), p, distance)
            probes = np.cumsum([comb(len(part), t) for t in range(distance + 1)]) * float(n)
            # a row that is shuffled costs about as much as 50 comparisons
            costs.append([candidates[t] + 50 * probes[t] for t in range(distance + 1)])
        found.append((*allocate(costs, distance), parts))
    _, thresholds, parts = min(found, key=lambda x: x[0])
    return parts, thresholds


# ------------------------------------------------------------ links


def _buckets(classes: DataFrame, parts: list[list[int]], thresholds: list[int]) -> DataFrame:
    """(used, value, fp, rep, sig, probe): each class under the value of each part
    that has a threshold, and under those with up to t bits flipped."""
    rows = []
    for part, t in zip(parts, thresholds):
        if t >= 0:
            flips = [_signed(_mask(list(x))) for r in range(t + 1) for x in combinations(part, r)]
            rows.append(F.struct(F.lit(_signed(_mask(part))).alias("used"), F.array(*map(F.lit, flips)).alias("flips")))
    out = classes.select("fp", "rep", F.explode(F.array(*rows)).alias("p")).select("fp", "rep", "p.used", F.explode("p.flips").alias("flip"))
    return out.select("used", F.col("fp").bitwiseXOR(F.col("flip")).alias("sig"), "fp", "rep", (F.col("flip") != 0).alias("probe"))


def _tiled(rows: DataFrame) -> DataFrame:
    """``rows`` with the column tile: 0, or for buckets of over MOST_ROWS rows the
    pairs of blocks to compare."""
    sizes = rows.groupBy("used", "value").agg(F.ceil(F.count(F.lit(1)) / MOST_ROWS).alias("blocks"))
    large = C.stored(sizes.where("blocks > 1"), "large")
    if not large.head(1):
        return rows.withColumn("tile", F.lit(0).cast("long"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j))
    return rows.join(large, ["used", "value"], "left").withColumn("tile", F.explode(F.when(F.col("blocks") > 1, pairs).otherwise(F.array(F.lit(0).cast("long")))))


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that links a-b reach from each index."""
    label = np.arange(size)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def _linked(fp: np.ndarray, probe: np.ndarray, heads: np.ndarray, distance: int) -> np.ndarray:
    """Labels of rows in adjoining small buckets; ``heads``: their first rows."""
    group = np.repeat(np.arange(len(heads)), np.diff(heads, append=len(fp)))
    active, pairs, d = np.arange(len(fp)), [], 1
    while True:
        active = active[active + d < len(fp)]
        active = active[group[active + d] == group[active]]
        if not len(active):
            break
        both = active[~(probe[active] & probe[active + d])]
        near = both[np.bitwise_count(fp[both] ^ fp[both + d]) <= distance]
        pairs.append((near, near + d))
        d += 1
    a, b = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
    return _forest(len(fp), a, b)


def _linked_large(fp: np.ndarray, probe: np.ndarray, distance: int) -> np.ndarray:
    label = np.arange(len(fp))
    for i in range(len(fp)):
        near = np.bitwise_count(fp ^ fp[i]) <= distance
        if probe[i]:
            near &= ~probe
        near[i] = True
        own = np.unique(label[near])
        if len(own) > 1:
            label[np.isin(label, own)] = own[0]
    return label


def _linker(distance: int, small: int = 256, chunk: int = 1 << 14):
    """Over rows sorted by bucket: the edges of a spanning forest of each bucket."""

    def edges(rep, label):
        at = np.flatnonzero(rep != rep[label])
        return pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(rep[label[at]])], names=["a", "b"])

    def worked(used, value, tile, fp, rep, probe):
        new = np.ones(len(fp), bool)
        new[1:] = (np.diff(used) != 0) | (np.diff(value) != 0) | (np.diff(tile) != 0)
        heads = np.flatnonzero(new)
        sizes = np.diff(heads, append=len(fp))
        for k in np.flatnonzero(sizes > small):
            at = slice(heads[k], heads[k] + sizes[k])
            yield edges(rep[at], _linked_large(fp[at], probe[at], distance))
        few = np.flatnonzero((sizes > 1) & (sizes <= small))
        i = 0
        while i < len(few):
            j = max(i + 1, int(np.searchsorted(np.cumsum(sizes[few[i:]]), chunk, "right")) + i)
            own = few[i:j]
            at = np.concatenate([np.arange(heads[k], heads[k] + sizes[k]) for k in own])
            first = np.cumsum(sizes[own]) - sizes[own]
            yield edges(rep[at], _linked(fp[at], probe[at], first, distance))
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            cols[3] = cols[3].view(np.uint64)
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)] if held else cols
            # the last bucket may go on in the next batch
            tail = np.flatnonzero((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1]))[0]
            if tail:
                yield from worked(*(c[:tail] for c in cols))
            held = [c[tail:] for c in cols]
        if held:
            yield from worked(*held)

    return run


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): edges whose components are those of all links between the classes
    (fp, rep), fp distinct."""
    n = classes.count()
    parts, thresholds = plan(classes.select("fp"), n, distance)
    rows = _buckets(classes, parts, thresholds).withColumn("value", F.col("sig").bitwiseAND(F.col("used")))
    key = ["used", "value", "tile"]
    dealt = _tiled(C.stored(rows.drop("sig"), "buckets")).select(*key, "fp", "rep", "probe")
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linker(distance), "a long, b long")


# ------------------------------------------------------------ components


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "u")
    joined = near.join(least, F.col("a") == F.col("u"))
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select("b", "m").unionByName(least.select(F.col("u").alias("b"), "m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for ids with edges whose own
    id is not it."""
    edges = C.stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = C.stored(_star(_star(edges, True), False), "edges")
        if (after := _state(edges)) == state:
            break
        state = after
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(id, fp, component) for every row of ``docs``."""
    prints = C.stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = C.stored(prints.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    found = components(links(classes, distance))
    of = classes.join(found, classes["rep"] == found["id"], "left").select("fp", F.coalesce("component", "rep").alias("component"))
    out = prints.join(of, "fp", "left")
    return out.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (of rows
    that share it, any one); rows with a null id stay."""
    found = near_duplicates(docs, id_col, text_col, shingle, distance)
    own, is_own = F.col("id").alias("own"), F.col("id") == F.col("component")
    ids = C.stored(found.where("id IS NOT NULL").groupBy(own).agg(F.max(is_own).alias("stays"), F.count(F.lit(1)).alias("n")), "ids")
    gone, several = ids.where("NOT stays").select("own"), ids.where("stays AND n > 1").select("own")
    key = docs[id_col].cast("long")
    out = docs.join(C.few(gone), key == gone["own"], "left_anti")
    if several.head(1):  # rows share an id that stays: one of them does
        same = out.join(C.few(several), key == several["own"], "left_semi").dropDuplicates([id_col])
        out = out.join(C.few(several), key == several["own"], "left_anti").unionByName(same)
    return out
