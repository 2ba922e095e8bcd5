r"""Mixing sources to target weights by a low-discrepancy schedule.

Targets. Sources share the sum of all sizes by weight; a source stops at
``max_repeat`` times its own size and its excess goes to the others by weight.

Schedule. Slot n of the mix lies at the fractional part of n times the golden
ratio; the source whose share of the unit interval holds that point owns the
slot. Any run of consecutive slots is then close to the target shares. Each
slot stands for one block of ``block_words`` words.

Blocks. A source's documents are shuffled by a hash of their id and laid end to
end; the line is cut into blocks of equal size, so a document may lie in several
blocks and a block may hold several documents. The r-th slot of a source takes
its block r modulo the number of blocks; the source's last slot is cut where its
target is reached. A document's taken words are its words in the slots' blocks.

Scale. Ranks of slots and places of documents are running sums over a source;
both are summed per chunk first (a range of slots, a range of hash values), so
that a source holding a third of all rows is still split over many tasks. Only
per-source and per-chunk totals meet; blocks bound the rows of a join key.

Defined results: null is a source of its own, last in order; a document without
words has size 0 and takes 0; rows that repeat a doc_id are separate documents;
an empty table gives an empty result. Reruns agree, whatever the partitioning
(repeated rows are told apart by their order in (hash, doc_id, size), equal ones
being interchangeable).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held, settled, words_in

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
GOLDEN = (math.sqrt(5) - 1) / 2
#: Rows that one running-sum task holds, about.
CHUNK_ROWS = 100_000


def targets(sizes: Sequence[int], weights: Sequence[float], max_repeat: int = MAX_REPEAT) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, none above ``max_repeat`` times its size."""
    out = [0.0] * len(sizes)
    free = [i for i in range(len(sizes)) if sizes[i] > 0]
    left = float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > max_repeat * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(max_repeat * sizes[i])
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def _running(df: DataFrame, key: list[str], chunk: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """``name``: sum of ``value`` over the rows before this one in (chunk, order) within ``key``.

    A chunk is summed in one task; across chunks only their totals are summed."""
    df = df.withColumn("_chunk", chunk)
    totals = df.groupBy(*key, "_chunk").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*key, "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return df.join(totals, [*key, "_chunk"]).withColumn(name, F.col("_start") + F.col("_in")).drop("_chunk", "_start", "_in")


def _schedule(spark, n_slots: int, shares: Sequence[float]) -> DataFrame:
    """(n, rank_id): the source of each slot, by its point in the cumulative shares."""
    ends = np.cumsum(np.asarray(shares, float))
    ends /= ends[-1]

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(0).to_numpy()
            # the product is split so that the fraction keeps its digits for large n
            hi, lo = n >> 20, n & ((1 << 20) - 1)
            step = math.fmod(GOLDEN * (1 << 20), 1.0)
            x = np.mod(np.mod(hi * step, 1.0) + np.mod(lo * GOLDEN, 1.0), 1.0)
            s = np.minimum(np.searchsorted(ends, x, side="right"), len(ends) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(s.astype(np.int32))], names=["n", "rank_id"])

    parts = max(1, min(n_slots // CHUNK_ROWS + 1, spark.sparkContext.defaultParallelism * 8))
    return spark.range(0, n_slots, 1, parts).mapInArrow(owners, "n long, rank_id int")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT, block_words: int | None = None,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of ``docs``.

    Weights go to the sources in code-point order, null last, and repeat.
    ``block_words`` is by default 1,024, or less for small tables, so that a source
    has some 200 slots on average.
    The driver holds one total per source."""
    return settled(lambda: _mix(docs, weights, max_repeat, block_words, doc_id, text, source), "mix")


def _mix(docs: DataFrame, weights: Sequence[float], max_repeat: int, block_words: int | None, doc_id: str, text: str, source: str) -> DataFrame:
    spark = docs.sparkSession
    d = held(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words_in(F.col(text)).alias("size"),
                         F.xxhash64(F.col(doc_id).cast("string"), F.lit("mix")).alias("place")), "mix-docs")
    per = d.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    per.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in per]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(per))], max_repeat)
    names = spark.createDataFrame([(r["source"], i, r["size"], g, int(min(round(g), max_repeat * r["size"])))
                                   for i, (r, g) in enumerate(zip(per, goal, strict=True))],
                                  "source string, rank_id int, source_size long, target double, quota long")
    base = d.join(names, d.source.eqNullSafe(names.source)).drop(names.source)
    total = sum(sizes)
    if total == 0:
        return base.select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    block = block_words or max(1, min(1024, total // (200 * len(per))))

    # Slots. A source needs its quota in blocks. Its count of golden-ratio points strays from its share by a few,
    # and gaps between n such points are below 2 / n, so a third or more of them is always there; quotas cut the rest.
    quota = [min(round(g), max_repeat * s) for g, s in zip(goal, sizes, strict=True)]
    need = [q // s * math.ceil(s / block) + math.ceil(q % s / block) if s else 0 for q, s in zip(quota, sizes, strict=True)]
    if not any(need):
        return base.select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    least = min(k for k in need if k > 0)
    n_slots = math.ceil(sum(need) * min(3.0, 1 + (8 + 2 * sum(need).bit_length()) / least)) + 1
    slots = _schedule(spark, n_slots, need)
    slots = _running(slots, ["rank_id"], F.floor(F.col("n") / CHUNK_ROWS), ["n"], F.lit(1), "rank")
    small = names.select("rank_id", "source_size", "quota")
    slots = slots.join(small, "rank_id")
    n_blocks = F.ceil(F.col("source_size") / block)
    # the last block of a line may be short, so the words before slot r are counted by whole passes
    before = F.floor(F.col("rank") / n_blocks) * F.col("source_size") + (F.col("rank") % n_blocks) * block
    slots = slots.select("rank_id", (F.col("rank") % n_blocks).alias("block"), (F.col("quota") - before).alias("left"), "source_size").filter("left > 0")
    # of a block's takes all are whole but perhaps one, which is cut after `part` words
    whole = F.col("left") >= F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    takes = slots.groupBy("rank_id", "block").agg(F.sum(whole.cast("int")).alias("whole"), F.max(F.when(~whole, F.col("left"))).alias("part"))

    # Documents on their source's line, cut at block borders.
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(r["n"] for r in per) // CHUNK_ROWS)
    placed = _running(base.withColumn("row", F.monotonically_increasing_id()), ["rank_id"], F.pmod(F.shiftright("place", 20), F.lit(chunks)),
                      ["place", "doc_id", "size", "row"], F.col("size"), "start")
    placed = held(placed, "mix-placed")
    pieces = placed.filter("size > 0").select("row", "rank_id", "start", "size", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    lo = F.greatest(F.col("start"), F.col("block") * block) - F.col("block") * block
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block) - F.col("block") * block
    words = F.col("whole") * (hi - lo) + F.greatest(F.lit(0), F.least(hi, F.coalesce("part", F.lit(0))) - lo)
    taken = pieces.join(takes, ["rank_id", "block"]).groupBy("row").agg(F.sum(words).alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
