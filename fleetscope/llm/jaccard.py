r"""Exact Jaccard join of documents on word shingles, by size-banded tiles with bitmap signatures.

1. Every document is read once for its set size, a digest of its set, and counts
   of shingles in hashed buckets. Documents of equal size and digest are one class.
2. Each class emits its first ``n - ceil(t n) + 1`` shingles in order of rarity
   (bucket count, then hash). Linked sets share one of those, so all classes of a
   shingle form a tile. A row carries set size, position and a 128-bit parity
   bitmap of the whole set.
3. In a tile, sorted by size and position, a class meets only those in its size band (the
   smaller at least t times the larger). The bits in which two bitmaps differ are at most the
   shingles in which the sets do, which bounds the overlap from above; position does the same.
4. What passes is a candidate. Its bitmaps are compared once more at a width that
   follows the set size, and the sorted shingle arrays of what is left are intersected.

Tiles of more than ``HOT`` classes emit only each class's likeliest partners at
first. When those are verified and the components known, the hot tiles are split
into blocks, and only pairs of blocks' members from different components are
tested, all of them: no link that would join two components is lost.

Defined results: null, empty and blank texts have an empty set and link with
nothing; rows that repeat a doc_id are separate documents that may share an id;
a null doc_id counts as smaller than all, so a component that holds one has the
id null. Two sets count as equal if size and 64-bit digest agree, two shingles
if 56 bits do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, settled, text_chunks
from .components import components
from .wordhash import digest64, shingle_sets

BUCKETS = 1 << 16
HOT = 32
#: Members of a hot tile that one block holds, about.
BLOCK = 2048
MIN_LONG = -(1 << 63)
#: Bits of the map that tells tasks which documents to read again; always a megabyte.
MARK_BITS = 1 << 23


def least_overlap(a, b, percent: int):
    """Least common shingles of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def _profile(docs: DataFrame, shingle: int) -> DataFrame:
    """Per document (doc_id, n, c); per task and bucket (bucket, cnt)."""
    names = ["doc_id", "n", "c", "bucket", "cnt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for i, j, data, offsets in text_chunks(b.column(1)):
                sets, sizes = shingle_sets(data, offsets, shingle)
                counts += np.bincount((sets >> np.uint64(40)).astype(np.int64), minlength=BUCKETS)
                c = [digest64(x) for x in np.split(sets, np.cumsum(sizes)[:-1])]
                nothing = pa.nulls(j - i, pa.int32()), pa.nulls(j - i, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(sizes.astype(np.int32)), pa.array(c, pa.int64()), *nothing], names=names)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.int64()),
                                          pa.array(at.astype(np.int32)), pa.array(counts[at])], names=names)

    return held(docs.mapInArrow(run, "doc_id long, n int, c long, bucket int, cnt long"), "jaccard-profile")


def _postings(docs: DataFrame, shingle: int, percent: int, levels: np.ndarray) -> DataFrame:
    """(w, place, c, b0, b1): a class's rare shingles; place is the set size, then the position. A task emits a class once."""
    names = ["w", "place", "c", "b0", "b1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[tuple[int, int]] = set()
        for b in batches:
            for _, _, data, offsets in text_chunks(b.column(1)):
                sets, sizes = shingle_sets(data, offsets, shingle)
                cols: list[list[np.ndarray]] = [[], [], [], [], []]
                ends = np.cumsum(sizes).tolist()
                for e, n in zip(ends, sizes.tolist(), strict=True):
                    s = sets[e - n:e]
                    if not n or (key := (n, digest64(s))) in done:
                        continue
                    done.add(key)
                    p = n + (-percent * n // 100) + 1
                    order = np.sort(levels[(s >> np.uint64(40)).astype(np.int64)] | s)[:p]
                    bits = np.bincount((s & np.uint64(127)).astype(np.int64), minlength=128) & 1
                    b0, b1 = np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)
                    cols[0].append(order.view(np.int64))
                    cols[1].append((n << 32) + np.arange(p, dtype=np.int64))
                    for k, v in ((2, key[1]), (3, b0), (4, b1)):
                        cols[k].append(np.full(p, v, np.int64))
                if cols[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in cols], names=names)

    return docs.mapInArrow(run, "w long, place long, c long, b0 long, b1 long")


class _Tiles:
    """The complete lists of sorted batches; the last list waits for the next batch."""

    def __init__(self, keys: int) -> None:
        self.keys, self.rest = keys, None

    def feed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
            if self.rest is not None:
                cols = [np.concatenate(x) for x in zip(self.rest, cols, strict=True)]
            if not len(cols[0]):
                continue
            last = np.ones(len(cols[0]), bool)
            for k in cols[:self.keys]:
                last &= k == k[-1]
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            self.rest = [x[cut:] for x in cols]
            if cut:
                yield [x[:cut] for x in cols]
        if self.rest is not None and len(self.rest[0]):
            yield self.rest


def _bound(i: np.ndarray, j: np.ndarray, n: np.ndarray, at: np.ndarray, b0: np.ndarray, b1: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs that may be linked, bits in which they differ)."""
    need = least_overlap(n[i], n[j], percent)
    ones = lambda x: np.bitwise_count(x.view(np.uint64)).astype(np.int64)  # noqa: E731  (of signed numbers it would take the absolute value)
    differ = ones(b0[i] ^ b0[j]) + ones(b1[i] ^ b1[j])
    ok = (differ <= n[i] + n[j] - 2 * need) & (np.minimum(n[i] - at[i], n[j] - at[j]) >= need) & (100 * n[i] >= percent * n[j])
    return ok, differ


def _first_round(percent: int):
    """Sorted postings to rows (hot, a, b, place, b0, b1): candidate pairs of classes, and the members of hot tiles."""
    names = ["hot", "a", "b", "place", "b0", "b1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, place, c, b0, b1 in _Tiles(1).feed(batches):
            fresh = np.ones(len(w), bool)  # tasks may have emitted the same class
            fresh[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1]) | (place[1:] != place[:-1])
            w, place, c, b0, b1 = (x[fresh] for x in (w, place, c, b0, b1))
            starts = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            sizes = np.diff(np.append(starts, len(w)))
            size = np.repeat(sizes, sizes)
            keep = size > 1
            w, place, c, b0, b1, size = (x[keep] for x in (w, place, c, b0, b1, size))
            if not len(w):
                continue
            n, at = place >> 32, place & 0xFFFFFFFF
            hot = size > HOT
            best, partner = np.full(len(w), 1 << 30), np.full(len(w), -1)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            i = np.arange(len(w))
            for d in range(1, HOT + 1):
                i = i[i + d < len(w)]
                i = i[(w[i] == w[i + d]) & (100 * n[i] >= percent * n[i + d])]
                if not len(i):
                    break
                ok, differ = _bound(i, i + d, n, at, b0, b1, percent)
                cold = ok & ~hot[i]
                found.append((i[cold], i[cold] + d))
                for near in (ok & hot[i] & (differ < best[i + d]),):
                    best[i[near] + d], partner[i[near] + d] = differ[near], i[near]
            # hot tiles: each class with its likeliest of the HOT before it, and with the tile's first ones
            mine = np.flatnonzero(partner >= 0)
            found.append((partner[mine], mine))
            first = np.maximum.accumulate(np.where(np.append(True, w[1:] != w[:-1]), np.arange(len(w)), 0))
            far = np.flatnonzero(hot & (np.arange(len(w)) - first > HOT))
            for lead in range(4):
                ok, _ = _bound(first[far] + lead, far, n, at, b0, b1, percent)
                found.append((first[far[ok]] + lead, far[ok]))
            x, y = (np.concatenate(z) for z in zip(*found, strict=True))
            pairs = np.unique(np.stack([np.minimum(c[x], c[y]), np.maximum(c[x], c[y])]), axis=1) if len(x) else np.zeros((2, 0), np.int64)
            none = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(pairs.shape[1], bool)), pa.array(pairs[0]), pa.array(pairs[1]), none, none, none], names=names)
            h = np.flatnonzero(hot)
            if len(h):
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(h), bool)), *(pa.array(v[h]) for v in (w, c, place, b0, b1))], names=names)

    return run


def _second_round(percent: int):
    """Blocks of hot tiles, sorted: every pair of different components that may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, s, t, place, c, label, side, b0, b1 in _Tiles(3).feed(batches):
            n, at = place >> 32, place & 0xFFFFFFFF
            i, d = np.arange(len(w)), 1
            while True:
                i = i[i + d < len(w)]
                j = i + d
                same = (w[i] == w[j]) & (s[i] == s[j]) & (t[i] == t[j]) & (100 * n[i] >= percent * n[j])
                i = i[same]
                if not len(i):
                    break
                j = i + d
                ok, _ = _bound(i, j, n, at, b0, b1, percent)
                ok &= (label[i] != label[j]) & ((s[i] == t[i]) | (side[i] != side[j]))
                if ok.any():
                    x, y = c[i[ok]], c[j[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
                d += 1

    return run


class _Marked:
    """A fixed-size bitmap of document ids: few others pass, none of the marked fails."""

    def __init__(self, ids: DataFrame) -> None:
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(MARK_BITS))
        rows = ids.groupBy(F.floor(slot / 64).alias("k")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {MARK_BITS}) % 64 as int))")).alias("v")).collect()
        words = np.zeros(MARK_BITS // 64, np.int64)
        for r in rows:  # MARK_BITS / 64 at most
            words[r["k"]] = r["v"]
        self.words = words

    def of(self, slots: np.ndarray) -> np.ndarray:
        return (self.words[slots >> 6] >> (slots & 63) & 1).astype(bool)


def _of_marked(docs: DataFrame, shingle: int, wanted: DataFrame, make, kind: str, name: str) -> DataFrame:
    """(c, s): ``make`` of the shingle sets of the wanted classes, each read again from one document.

    A task looks up its documents in a bitmap of the wanted ids, so the texts of
    all others are neither cut into words nor moved."""
    spark = docs.sparkSession
    marked = spark.sparkContext.broadcast(_Marked(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(marked.value.of(b.column(0).to_numpy())))
            for _, _, data, offsets in text_chunks(b.column(1)):
                sets, sizes = shingle_sets(data, offsets, shingle)
                parts = [x for x in np.split(sets, np.cumsum(sizes)[:-1]) if len(x)]
                yield pa.RecordBatch.from_arrays([pa.array([digest64(x) for x in parts], pa.int64()), pa.array([make(x) for x in parts], pa.binary())], names=["c", "s"])

    slot = F.pmod(F.xxhash64("doc_id"), F.lit(MARK_BITS)).alias("slot")
    found = docs.select(slot, "text").mapInArrow(run, "c long, s binary")
    return held(found.join(wanted.select("c"), "c", "left_semi"), name, kind)


def bitmap(values: np.ndarray) -> bytes:
    """Parity of the values that fall on each bit; four bits or more per value, so that it
    tells sets apart that differ in a fifth of them. A power of two of bytes."""
    bits = 1 << max(9, (4 * len(values) - 1).bit_length())
    odd = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def bitmap_distance(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ; the wider one is folded to the width of the other."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def _joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x, y = sets.select(F.col("c").alias("a"), F.col("s").alias("x")), sets.select(F.col("c").alias("b"), F.col("s").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", *[c for c in pairs.columns if c not in ("a", "b")], "x", "y")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity: wide bitmaps first, then the sorted arrays of what they leave."""
    pairs = held(pairs.select("a", "b").distinct(), "jaccard-pairs")
    if pairs.isEmpty():
        return pairs

    def wanted(p: DataFrame) -> DataFrame:
        need = p.select(F.col("a").alias("c")).union(p.select("b")).distinct()
        return held(classes.join(need, "c").groupBy("c").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "jaccard-wanted")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = b.column(2).to_numpy().astype(np.int64), b.column(3).to_numpy().astype(np.int64)
            most = n + m - 2 * least_overlap(n, m, percent)
            ok = [bitmap_distance(x, y) <= d for x, y, d in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), most.tolist(), strict=True)]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                common = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                ok.append(100 * common >= percent * (len(p) + len(q) - common))
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    first = wanted(pairs)
    sized = pairs.join(first.select(F.col("c").alias("a"), F.col("n").alias("na")), "a").join(first.select(F.col("c").alias("b"), F.col("n").alias("nb")), "b")
    maps = _of_marked(docs, shingle, first, bitmap, "none", "jaccard-bitmaps")
    pairs = held(_joined(sized, maps).mapInArrow(likely, "a long, b long").distinct(), "jaccard-likely")
    if pairs.isEmpty():
        return pairs
    sets = _of_marked(docs, shingle, wanted(pairs), lambda x: x.tobytes(), "none", "jaccard-sets")
    return held(_joined(pairs, sets).mapInArrow(linked, "a long, b long").distinct(), "jaccard-links")


def jaccard_components(docs: DataFrame, shingle: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links of similarity
    ``percent`` / 100; n_links counts the verified links of the document's class
    (in hot tiles not all links are tested, only as many as the components need)."""
    return settled(lambda: _components(docs, shingle, percent, doc_id, text), "jaccard-components")


def _components(docs: DataFrame, shingle: int, percent: int, doc_id: str, text: str) -> DataFrame:
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(MIN_LONG)).alias("doc_id"), F.col(text).alias("text"))
    profile = _profile(d, shingle)
    counts = np.zeros(BUCKETS, np.int64)
    for r in profile.filter("bucket is not null").groupBy("bucket").agg(F.sum("cnt").alias("cnt")).collect():  # BUCKETS rows at most
        counts[r["bucket"]] = r["cnt"]
    levels = np.minimum(np.log2(counts + 1) * 4, 127).astype(np.uint64) << np.uint64(56)
    members = profile.filter("bucket is null").select("doc_id", "n", "c")
    classes = members.filter("n > 0").groupBy("c", "n").agg(F.min("doc_id").alias("doc_id"))

    postings = _postings(d, shingle, percent, levels)
    tiles = postings.repartition(F.col("w")).sortWithinPartitions("w", "place", "c")
    first = held(tiles.mapInArrow(_first_round(percent), "hot boolean, a long, b long, place long, b0 long, b1 long"), "jaccard-tiles")
    links = _verified(first.filter("not hot"), d, classes, shingle, percent)
    hot = first.filter("hot").select(F.col("a").alias("w"), F.col("b").alias("c"), "place", "b0", "b1")
    labels = components(links)
    if not hot.isEmpty():
        size = hot.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        blocks = (hot.join(size, "w").join(labels.withColumnRenamed("node", "c"), "c", "left")
                  .withColumn("label", F.coalesce("label", "c")).withColumn("side", F.pmod("c", F.col("blocks"))))
        blocks = blocks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        blocks = blocks.select("w", F.least("side", "other").alias("s"), F.greatest("side", "other").alias("t"), "place", "c", "label", "side", "b0", "b1")
        late = blocks.repartition(F.col("w"), F.col("s"), F.col("t")).sortWithinPartitions("w", "s", "t", "place")
        more = late.mapInArrow(_second_round(percent), "a long, b long").distinct().join(held(first.filter("not hot").select("a", "b").distinct(), "jaccard-tested"), ["a", "b"], "left_anti")
        more = _verified(more, d, classes, shingle, percent)
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
    degree = links.select(F.col("a").alias("c")).union(links.select("b")).groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("label", F.coalesce("label", "c"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "label").join(degree, "c", "left").select("c", "n", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    own = F.nullif("doc_id", F.lit(MIN_LONG))
    linked = members.filter("n > 0").join(named, ["c", "n"]).select(
        own.alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.nullif("component_id", F.lit(MIN_LONG)).alias("component_id"), "n_links")
    empty = members.filter("n = 0").select(own.alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), own.alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(empty)
