r"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line's set is its distinct words (runs outside \x20 and \x09-\x0D, lower case).
A line is removed when an earlier line (smaller doc_id, then line number) has a
Jaccard similarity of at least ``percent`` / 100 with it, whether or not that
earlier line is itself removed.

1. Rarity: words are counted over all texts in a fixed number of hashed buckets;
   a word's rank is its bucket's level, then its hash. Any total order gives
   right results; a bucket that holds a frequent word only sorts later.
2. Lines of equal sets are one class, at its first line. All later lines of a
   class are removed at once, so a line that a third of all documents hold is one
   row from here on.
3. Prefix filter: sets that reach the similarity share a word among their first
   ``n - ceil(t n) + 1``. Position and length filters, and a 128-bit parity
   signature (it differs in at most as many bits as the sets do in words), drop
   most pairs inside the join's condition.
4. A prefix word of more than ``HOT`` classes is a hot list. There every class
   first meets the list's ``LEADERS`` first classes only; the classes that this does not
   settle meet all earlier ones.
5. The Jaccard is verified on the words themselves: first of each line with its
   likeliest earlier line, then, for the lines that this does not settle, of all pairs
   left. A group of near copies thus moves as many words as it has lines.

Defined results: lines without a word are always kept; null text has no lines
and stays null; rows that repeat a doc_id count as documents that follow each
other, in the order of their text; a null doc_id sorts first. Other columns pass
through unchanged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_PATTERN, held, settled

PERCENT = 80
BUCKET_BITS = 21
HOT = 256
#: Bits of the map of lines whose words are needed again; the same for any table.
MARK_BITS = 1 << 21
LEADERS = 4
#: Columns of a line's signature, 64 bits each. One alone stops telling sets of 100 words apart.
SIGNATURE = ("sig", "sig2")
MIN_LONG = -(1 << 63)
#: Line numbers of a repeated doc_id's k-th row begin at k times this.
ROW_STEP = 1 << 40


def tokens(text: Column) -> Column:
    """Lower-case words of a line, and empty strings between blanks in a row.

    Splitting at one blank needs no regular expression; other white space, which is rare, is made a blank first."""
    plain = F.when(text.rlike(r"[\x09-\x0D]"), F.regexp_replace(text, SPACE_PATTERN, " ")).otherwise(text)
    return F.split(F.lower(plain), " ")


def words(text: Column) -> Column:
    """Distinct lower-case words of a line."""
    return F.array_remove(F.array_distinct(tokens(text)), "")


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int")


def word_levels(docs: DataFrame, text: str) -> Column:
    """Level of every bucket, one byte each: 4 times the binary logarithm of its words' occurrences."""
    flat = F.replace(F.col(text), F.lit("\n"), F.lit(" "))  # not a reason for the regular expression
    counts = docs.select(F.explode(tokens(flat)).alias("w")).groupBy(_bucket(F.xxhash64("w")).alias("b")).count()
    # a thousand or two strings, whatever the corpus: of each bucket in use its place among 1,024, as two characters, and its level
    level = F.least(F.lit(127), F.floor(4 * F.log2(F.col("count") + 1)))
    entry = F.concat(F.char(F.shiftright("b", 5).bitwiseAND(F.lit(31)) + 64), F.char(F.col("b").bitwiseAND(F.lit(31)) + 64), F.char(level))
    parts = counts.groupBy(F.shiftright("b", 10).alias("k")).agg(F.array_join(F.collect_list(entry), "").alias("s"))
    out = np.zeros(1 << BUCKET_BITS, np.uint8)
    for r in parts.collect():
        found = np.frombuffer(r["s"].encode("ascii"), np.uint8).reshape(-1, 3).astype(np.int32)
        out[(r["k"] << 10) + (found[:, 0] - 64) * 32 + found[:, 1] - 64] = found[:, 2]
    return F.lit(out.tobytes())


def _least_shared(n: Column, percent: int) -> Column:
    """ceil(t n): a set of n words shares at least so many with any that matches it."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _unlike(a: str, b: str) -> Column:
    """Bits in which the signatures of two lines differ: no more than their sets do in words."""
    return sum((F.bit_count(F.col(f"{a}.{sig}").bitwiseXOR(F.col(f"{b}.{sig}"))) for sig in SIGNATURE[1:]),
               F.bit_count(F.col(f"{a}.{SIGNATURE[0]}").bitwiseXOR(F.col(f"{b}.{SIGNATURE[0]}"))))


def _numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id (null: smallest long), text, base: where the row's line numbers begin."""
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(MIN_LONG)).alias("doc_id"), F.col(text).alias("text"))
    again = d.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    again = held(again, "lines-repeated")
    if again.isEmpty():
        return d.withColumn("base", F.lit(0).cast("long"))
    once = d.join(again, "doc_id", "left_anti").withColumn("base", F.lit(0).cast("long"))
    w = Window.partitionBy("doc_id").orderBy("text")
    return once.unionByName(d.join(again, "doc_id").withColumn("base", (F.row_number().over(w) - 1) * F.lit(ROW_STEP)))


def _lines(numbered: DataFrame) -> DataFrame:
    return numbered.select("doc_id", "base", F.posexplode(F.split("text", "\n")).alias("at", "line_text")).select(
        "doc_id", (F.col("base") + F.col("at")).alias("line"), "line_text")


def _passes(a: str, b: str, percent: int) -> Column:
    """Length, position and signature filters for two postings of one word."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = F.floor((percent * (na + nb) + 99 + percent) / (100 + percent))  # least overlap, rounded up
    rest = F.least(na - F.col(f"{a}.at"), nb - F.col(f"{b}.at"))  # words from this one on
    return ((F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (rest >= need)
            & (_unlike(a, b) <= na + nb - 2 * need))


def _earlier(a: str, b: str) -> Column:
    return (F.col(f"{a}.doc_id") < F.col(f"{b}.doc_id")) | ((F.col(f"{a}.doc_id") == F.col(f"{b}.doc_id")) & (F.col(f"{a}.line") < F.col(f"{b}.line")))


def _index_prefix(n: Column, percent: int) -> Column:
    """Of a set of n words and one that is not smaller, a shared word is among the first so many of the former."""
    return n - F.floor((2 * percent * n + 99 + percent) / (100 + percent)) + 1


def _apart(a: str, b: str) -> Column:
    return (F.col(f"{a}.doc_id") != F.col(f"{b}.doc_id")) | (F.col(f"{a}.line") != F.col(f"{b}.line"))


def _pairs(joined: DataFrame, either: bool = False) -> DataFrame:
    """Places of the earlier and the later line, and how far apart their signatures and sizes are; ``either``: the sides x
    and y come in any order."""
    far = (_unlike("x", "y") + F.abs(F.col("x.n") - F.col("y.n"))).alias("far")
    if either:
        x, y = F.struct("x.doc_id", "x.line"), F.struct("y.doc_id", "y.line")
        joined = joined.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"), far)
    else:
        joined = joined.select(F.struct("x.doc_id", "x.line").alias("x"), F.struct("y.doc_id", "y.line").alias("y"), far)
    return joined.select(F.col("x.doc_id").alias("d1"), F.col("x.line").alias("l1"), F.col("y.doc_id").alias("d2"), F.col("y.line").alias("l2"), "far")


def _marked(places: DataFrame):
    """Test of a hash against a bitmap of the hashes of ``places``; none of those fails it."""
    slot = f"pmod(xxhash64(doc_id, line), {MARK_BITS})"
    rows = places.groupBy(F.expr(f"cast(floor({slot} / 32) as int)").alias("k")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({slot} % 32 as int))")).alias("v")).collect()
    out = [0] * (MARK_BITS // 32)
    for r in rows:  # MARK_BITS / 32 at most
        out[r["k"]] = r["v"]
    table = F.expr("cast(split('" + ",".join(map(str, out)) + "', ',') as array<bigint>)")
    at = lambda h: F.pmod(h, F.lit(MARK_BITS))
    bit = lambda h: F.call_function("shiftright", F.get(table, F.floor(at(h) / 32).cast("int")), (at(h) % 32).cast("int"))
    return lambda h: bit(h).bitwiseAND(F.lit(1)) == 1


def _verified(pairs: DataFrame, numbered: DataFrame, percent: int) -> DataFrame:
    """Positions (doc_id, line) of the later lines of the pairs whose words reach the similarity."""
    pairs = held(pairs.select("d1", "l1", "d2", "l2").distinct(), "lines-tested")
    if pairs.isEmpty():
        return pairs.select(F.col("d2").alias("doc_id"), F.col("l2").alias("line"))
    # whether a line is the earlier or the later one of a pair, or both: each side of the joins moves its own lines only
    place = lambda d, l, earlier: pairs.select(F.col(d).alias("doc_id"), F.col(l).alias("line"), F.lit(earlier).alias("earlier"))
    need = held(place("d1", "l1", True).union(place("d2", "l2", False)).groupBy("doc_id", "line").agg(
        F.bool_or("earlier").alias("earlier"), F.bool_or(~F.col("earlier")).alias("later")), "lines-needed")
    # a fixed-size bitmap keeps most lines that no pair needs from the shuffle
    near = _lines(numbered).filter(_marked(need)(F.xxhash64("doc_id", "line")))
    # a set travels as one text: an array of words takes four times the room in a shuffle
    found = words(F.col("line_text"))
    sets = held(near.join(need, ["doc_id", "line"]).select("doc_id", "line", "earlier", "later", F.size(found).alias("n"), F.array_join(found, " ").alias("w")), "lines-sets")
    one = sets.filter("earlier").select(F.col("doc_id").alias("d1"), F.col("line").alias("l1"), F.col("n").alias("n1"), F.col("w").alias("w1"))
    two = sets.filter("later").select(F.col("doc_id").alias("d2"), F.col("line").alias("l2"), F.col("n").alias("n2"), F.col("w").alias("w2"))
    both = F.size(F.array_intersect(F.split("w1", " "), F.split("w2", " ")))
    return (pairs.join(one, ["d1", "l1"]).join(two, ["d2", "l2"])
            .filter(100 * both >= percent * (F.col("n1") + F.col("n2") - both))
            .select(F.col("d2").alias("doc_id"), F.col("l2").alias("line")).distinct())


def removed_lines(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((doc_id, line) of every removed line, the numbered documents)."""
    numbered = _numbered(docs, doc_id, text)
    levels = word_levels(docs, text)
    level = lambda h: F.ascii(F.substring(levels, _bucket(h) + 1, F.lit(1)).cast("string"))
    ranked = lambda h: F.shiftleft(level(h).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))
    # words are told apart by 56 bits of their hash from here to the verification
    # lines without a word are told by their text: a filter on the keys would be pushed below them and make them twice
    keyed = _lines(numbered).filter(F.col("line_text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", "line", F.sort_array(F.array_distinct(F.transform(
        F.array_remove(F.array_distinct(F.transform(tokens(F.col("line_text")), lambda w: F.xxhash64(w))), F.xxhash64(F.lit(""))), ranked))).alias("keys"))
    n = F.size("keys")
    head = n - _least_shared(n, percent) + 1
    # the bit above the lowest six says which of the signature's columns a word belongs to
    bit = lambda k, i: F.call_function("shiftleft", F.shiftright(k, 6).bitwiseAND(F.lit(1)).bitwiseXOR(F.lit(1 - i)), k.bitwiseAND(F.lit(63)).cast("int"))
    parity = lambda i: F.aggregate("keys", F.lit(0).cast("long"), lambda s, k: s.bitwiseXOR(bit(k, i)))
    lines = held(keyed.select(
        "doc_id", "line", n.alias("n"), F.xxhash64("keys").alias("c1"), F.xxhash64(F.lit(1), F.col("keys")).alias("c2"), *[parity(i).alias(c) for i, c in enumerate(SIGNATURE)],
        # (words >> 7) leaves the bits that the signature does not use
        F.transform(F.slice("keys", F.lit(1), head), lambda k: F.shiftright(k, 7).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("prefix")), "lines")

    classes = held(lines.groupBy("c1", "c2").agg(F.min(F.struct("doc_id", "line")).alias("p"), F.first("n").alias("n"), *[F.first(c).alias(c) for c in SIGNATURE],
                                                 F.first("prefix").alias("prefix")).select("p.doc_id", "p.line", "n", *SIGNATURE, "prefix", "c1", "c2"), "lines-classes")
    # sets so small that only an equal one matches need no partner
    postings = classes.filter((F.floor(F.col("n") * 100 / percent) > F.col("n")) | (_least_shared(F.col("n"), percent) < F.col("n"))).select(
        "doc_id", "line", "n", *SIGNATURE, F.posexplode("prefix").alias("at", "w"))
    hot = held(postings.groupBy("w").count().filter(F.col("count") > HOT).select("w"), "lines-hot")
    cold = postings.join(hot, "w", "left_anti")
    # of two sets the smaller one shares a word among still fewer; said as a condition on both
    # sides, so that it is not pushed down and both sides read one shuffle
    few = (F.col("x.n") <= F.col("y.n")) & (F.col("x.at") + F.col("x.n") < _index_prefix(F.col("x.n"), percent) + F.least("x.n", "y.n"))
    pairs = _pairs(cold.alias("y").join(cold.alias("x").hint("shuffle_hash"),
                                        (F.col("x.w") == F.col("y.w")) & few & _apart("x", "y") & _passes("x", "y", percent)), True)
    warm = None if hot.isEmpty() else held(postings.join(hot, "w"), "lines-warm")
    if warm is not None:
        order = Window.partitionBy("w").orderBy("doc_id", "line")
        first = warm.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= LEADERS)
        pairs = pairs.union(_pairs(first.alias("x").join(warm.alias("y"), (F.col("x.w") == F.col("y.w")) & _earlier("x", "y") & _passes("x", "y", percent))))
    # one match is enough for a line, so its likeliest earlier line is tested first and the others only if that is none
    pairs = held(pairs.distinct(), "lines-pairs")
    likely = pairs.groupBy("d2", "l2").agg(F.min(F.struct("far", "d1", "l1")).alias("x")).select("x.d1", "x.l1", "d2", "l2")
    settled = held(_verified(likely, numbered, percent), "lines-settled")
    rest = pairs.join(settled.select(F.col("doc_id").alias("d2"), F.col("line").alias("l2")), ["d2", "l2"], "left_anti").select(pairs.columns)
    if warm is not None:
        open_ = warm.join(settled, ["doc_id", "line"], "left_anti")
        rest = rest.union(_pairs(warm.alias("x").join(open_.alias("y"), (F.col("x.w") == F.col("y.w")) & _earlier("x", "y") & _passes("x", "y", percent))))
    matched = settled.union(_verified(rest.join(likely, ["d1", "l1", "d2", "l2"], "left_anti"), numbered, percent))
    # later lines of a class go, and the first if an earlier line matches it
    first = classes.select("c1", "c2", F.col("doc_id").alias("d"), F.col("line").alias("l"))
    copies = (lines.select("doc_id", "line", "c1", "c2").join(first, ["c1", "c2"])
              .filter((F.col("doc_id") != F.col("d")) | (F.col("line") != F.col("l"))).select("doc_id", "line"))
    return copies.union(matched), numbered


def line_report(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, removed: the numbers of the removed lines, joined by commas; a row for each row of ``docs``."""
    return settled(lambda: _report(docs, percent, doc_id, text), "lines-report")


def _report(docs: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    gone, numbered = removed_lines(docs, percent, doc_id, text)
    per = gone.groupBy("doc_id", (F.col("line") - F.col("line") % ROW_STEP).alias("base")).agg(
        F.count(F.lit(1)).alias("n_removed"), F.array_join(F.sort_array(F.collect_list(F.col("line") % ROW_STEP)), ",").alias("removed"))
    mine = numbered.select("doc_id", "base", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    return mine.join(per, ["doc_id", "base"], "left").select(F.nullif("doc_id", F.lit(MIN_LONG)).alias("doc_id"), "n_lines", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                                                   F.coalesce("removed", F.lit("")).alias("removed"))


def dedup_lines(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_lines, n_removed): the rows of ``docs`` as structs whose ``text`` has lost the removed lines."""
    per = settled(lambda: removed_lines(docs, percent, doc_id, text)[0].groupBy("doc_id").agg(F.collect_list("line").alias("gone")), "lines-gone")
    per = per.withColumnRenamed("doc_id", "key")
    d = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(doc_id).cast("long"), F.lit(MIN_LONG)).alias("key"), F.lit(0).cast("long").alias("base"))
    again = held(d.groupBy("key").count().filter("count > 1").select("key"), "lines-repeated")
    if not again.isEmpty():
        w = Window.partitionBy("key").orderBy(f"doc.{text}")
        d = d.join(again, "key", "left_anti").unionByName(d.join(again, "key").withColumn("base", (F.row_number().over(w) - 1) * F.lit(ROW_STEP)))
    every = F.split(f"doc.{text}", "\n")
    mine = F.filter(F.coalesce("gone", F.array().cast("array<bigint>")), lambda x: (x >= F.col("base")) & (x < F.col("base") + ROW_STEP))
    d = d.join(per, "key", "left").withColumn("gone", F.transform(mine, lambda x: (x - F.col("base")).cast("int")))
    kept = F.array_join(F.filter(every, lambda x, i: ~F.array_contains("gone", i)), "\n")
    doc = F.when(F.size("gone") > 0, F.col("doc").withField(text, kept)).otherwise(F.col("doc"))
    return d.select(doc.alias("doc"), F.coalesce(F.size(every), F.lit(0)).alias("n_lines"), F.size("gone").alias("n_removed"))
