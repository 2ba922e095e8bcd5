"""Distinct pre-tokens of a corpus with their counts, and the most frequent ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, text_chunks
from .pretokens import distinct, special_strings, split, texts_of

#: A task hands on its counts when so many distinct pre-tokens are held; Spark adds them up before the shuffle.
TASK_ENTRIES = 50_000
#: Texts are cut into pre-tokens in chunks of about so many bytes; the arrays of a chunk take some fifty times the room.
PIECE_BYTES = 1 << 19


def vocabulary(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(token binary, n long): every distinct pre-token of all whole texts and its occurrences.

    Tasks add up their own counts first, so a token crosses the shuffle about once
    per task. Texts that go to the library whole have no pre-tokens here."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials = special_strings(tokenizer)
        total: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["token", "n"])
            total.clear()
            return b

        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), PIECE_BYTES):
                p = split(data, offsets, specials, tokenizer)
                rep, code = distinct(data, p)
                for t, n in zip(texts_of(data, p, rep), np.bincount(code, minlength=len(rep)).tolist(), strict=True):
                    total[t] = total.get(t, 0) + n
                if len(total) > TASK_ENTRIES:
                    yield out()
        yield out()

    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "token binary, n long")
    return held(parts.groupBy("token").agg(F.sum("n").alias("n")), "vocabulary")


def frequent(vocab: DataFrame, limit: int) -> list[bytes]:
    """At most ``limit`` pre-tokens: all with a count above a bound found from a histogram of counts."""
    level = F.floor(F.log2("n") * 32).cast("int").alias("level")
    levels = vocab.groupBy(level).count().orderBy(F.desc("level")).collect()  # 2,048 rows at most
    held_back, seen = None, 0
    for r in levels:
        if seen + r["count"] > limit:
            break
        seen, held_back = seen + r["count"], r["level"]
    if held_back is None:
        return []
    return [bytes(r["token"]) for r in vocab.filter(level >= held_back).select("token").collect()]
