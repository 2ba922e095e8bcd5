r"""Ranked lexical search with bag deduplication, in whole numbers.

1. The items (the queries) are cut into blocks of about ``BLOCK_TERMS`` terms; the
   distinct terms of a block are its vocabulary and go to every task.
2. A document becomes a bag: its length, and the vocabulary's terms in it with their
   counts. Texts are read where they are; bags are stored.
3. Document frequencies, the number of documents and their total length come from the
   bags; a document's length norm m follows.
4. Documents with the same m, terms and counts have the same score for every item.
   They are brought together by a hash of the three and compared in full. A task hands
   on the ``k`` smallest doc_ids of each class: of a class no item can return more, as
   its members tie and smaller doc_ids go first. A group of copies, however large, thus
   crosses the shuffle as k rows a task.
5. Each class is scored once against all items; a task keeps each item's best classes
   and expands them by ascending doc_id. The tasks' lists are merged.

Defined results: a null text is the empty one and has no terms; documents without
terms count nowhere; rows that repeat a doc_id are documents of their own and each may
be returned; null doc_ids come last among equal scores; rows that repeat an item_id
are items of their own; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held, text_chunks
from .pretokens import Pieces, distinct, ragged, texts_of

#: A term is a run of letters and digits of ASCII and of any other characters.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms (with repeats between items) of a block of items, about: a vocabulary of some tens of megabytes at most.
BLOCK_TERMS = 1 << 19
#: Scores that a task holds at a time.
CELLS = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms_in(text: Column) -> Column:
    """The distinct terms of a short text."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, lower), F.lit(TERM_PATTERN), F.lit(0)))


def cut_terms(data: np.ndarray, offsets: np.ndarray) -> Pieces:
    """The places of all terms in a chunk of texts."""
    inside = _INSIDE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = False
    edge[offsets] = True
    begins = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    return Pieces(begins, ends, np.searchsorted(offsets, begins, side="right") - 1, np.zeros(0, np.int64))


def bags(docs: DataFrame, vocabulary: list[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts): per document the number of its terms, and of the vocabulary's terms in it
    the places in the vocabulary, ascending, with their counts."""
    known = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, size = known.value.get, len(vocabulary)
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                data = _LOWER[data]
                p = cut_terms(data, offsets)
                rep, code = distinct(data, p)
                place = np.array([get(t, -1) for t in texts_of(data, p, rep)], np.int64)[code] if len(rep) else np.zeros(0, np.int64)
                mine = place >= 0
                pair, n = np.unique(p.doc[mine] * size + place[mine], return_counts=True)
                starts = pa.array(np.searchsorted(pair, np.arange(j - i + 1) * size).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(np.bincount(p.doc, minlength=j - i).astype(np.int64)),
                    pa.ListArray.from_arrays(starts, pa.array((pair % size if size else pair).astype(np.int32))),
                    pa.ListArray.from_arrays(starts, pa.array(n.astype(np.int32)))], names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, counts array<int>")


def bag_classes(bag: DataFrame, k: int) -> DataFrame:
    """(m, terms, counts, members): each distinct combination once, with its ``k`` smallest doc_ids in order.

    ``bag`` holds doc_id, m, terms, counts. The hash leads the keys, so that vectors are compared only where it is the same."""
    same = ["hash", "m", "terms", "counts"]
    keyed = bag.select(F.xxhash64("m", "terms", "counts").alias("hash"), "m", "terms", "counts", "doc_id")
    first = Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last())
    few = keyed.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k)
    member = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id")
    return few.groupBy(*same).agg(F.transform(F.sort_array(F.collect_list(member)), lambda x: x["doc_id"]).alias("members")).drop("hash")


class Best:
    """The best classes of each item met so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.zeros(items, np.int64)
        self.members: dict[int, list] = {}
        self.rows: list[np.ndarray] = []
        self.size = self.serial = 0

    def offer(self, scores: np.ndarray, members: list[list]) -> None:
        """A row of scores per class. Scores below an item's k-th best class can't be returned; equal ones can."""
        c, item = np.nonzero((scores > 0) & (scores >= self.least))
        used = np.unique(c)
        self.members.update((self.serial + i, members[i]) for i in used.tolist())
        lead = np.array([_last(m[0]) for m in members], np.int64)
        self.rows.append(np.stack([item, scores[c, item], lead[c], c + self.serial]))
        self.serial += len(members)
        self.size += len(c)
        if self.size > CELLS:
            self.settle()

    def settle(self) -> None:
        item, score, lead, number = np.concatenate(self.rows, axis=1)
        order = np.lexsort((lead, -score, item))
        item, score, lead, number = (x[order] for x in (item, score, lead, number))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.k - 1
        self.least[item[last]] = score[last]
        keep = place < self.k
        self.rows = [np.stack([x[keep] for x in (item, score, lead, number)])]
        self.size = int(keep.sum())
        self.members = {i: self.members[i] for i in np.unique(number[keep]).tolist()}

    def lists(self) -> Iterator[tuple[int, int, int | None]]:
        """(item, score, doc_id) of each item's best documents."""
        if not self.rows:
            return
        self.settle()
        item, score, _, number = self.rows[0]
        for i in np.unique(item).tolist():
            of = item == i
            found = sorted((-s, _last(d), d) for s, n in zip(score[of].tolist(), number[of].tolist(), strict=True) for d in self.members[n])
            yield from ((i, -s, None if d is None else d) for s, _, d in found[:self.k])


def _last(doc_id: int | None) -> int:
    return (1 << 63) - 1 if doc_id is None else doc_id


def score_classes(classes: DataFrame, of_term: tuple[np.ndarray, np.ndarray], weight: np.ndarray, items: np.ndarray, k: int) -> DataFrame:
    """(item, score, doc_id): per task and item the best documents of the task's classes.

    ``of_term``: the places in ``items`` of the items of each term of the vocabulary, one term after the other, and where each term's begin."""
    sent = classes.sparkSession.sparkContext.broadcast((*of_term, weight, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_of, starts, w, names = sent.value
        items = len(names)
        best = Best(items, k)
        for batch in batches:
            m = batch.column("m").to_numpy()
            lists = batch.column("terms")
            term, tf = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy().astype(np.int64)
            per = np.diff(lists.offsets.to_numpy())
            entry_end = np.cumsum(per)
            owner = np.repeat(np.arange(len(m)), per)
            part = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[owner]))
            fan = starts[term + 1] - starts[term]
            cells = np.cumsum(np.append(0, np.bincount(owner, weights=fan, minlength=len(m)).astype(np.int64) + items))
            members = batch.column("members").to_pylist()
            i = 0
            while i < len(m):
                j = max(i + 1, int(np.searchsorted(cells, cells[i] + CELLS, side="right")) - 1)
                e = slice(int(entry_end[i] - per[i]), int(entry_end[j - 1]))
                item = ragged(item_of, starts[term[e]], fan[e])
                at = np.repeat((owner[e] - i) * items, fan[e]) + item
                value = np.repeat(part[e], fan[e])
                if float(part[e].max(initial=0)) * max(1, len(w)) < 2.0**53:  # whole in doubles
                    scores = np.bincount(at, weights=value, minlength=(j - i) * items).astype(np.int64)
                else:
                    scores = np.zeros((j - i) * items, np.int64)
                    np.add.at(scores, at, value)
                best.offer(scores.reshape(j - i, items), members[i:j])
                i = j
        rows = list(best.lists())
        item, score, doc = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names[list(item)], pa.int64()), pa.array(score, pa.int64()), pa.array(doc, pa.int64())], names=["item", "score", "doc_id"])

    return classes.mapInArrow(run, "item long, score long, doc_id long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` best documents with a score above 0."""
    asked = held(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), terms_in(F.col(item_text)).alias("terms")), "items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    found: DataFrame | None = None
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).filter(F.size("terms") > 0).select("item", "terms").collect()
        vocabulary = sorted({t.encode() for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        pairs = np.array(sorted((number[t.encode()], i) for i, r in enumerate(rows) for t in r["terms"]), np.int64).reshape(-1, 2)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(vocabulary) + 1))
        bag = held(bags(docs, vocabulary, doc_id, text), "bags")
        size = bag.filter("n > 0").agg(F.count("*").alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
        df = {r["term"]: r["df"] for r in bag.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
        here = np.array([df.get(i, 0) for i in range(len(vocabulary))], np.float64)
        weight = np.floor(1000 * np.log((2 * size["N"] + 2) / (2 * here + 1))).astype(np.int64)
        norm = F.expr(f"50 + (50 * n * {size['N']}L) div {max(1, size['L'])}L").alias("m")
        classes = bag_classes(bag.filter(F.size("terms") > 0).select("doc_id", norm, "terms", "counts"), k)
        scored = score_classes(classes, (pairs[:, 1].copy(), starts), weight, np.array([r["item"] for r in rows], np.int64), k)
        found = scored if found is None else found.unionByName(scored)
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
