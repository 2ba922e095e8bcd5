"""Token counts of documents without making their ids.

1. All distinct pre-tokens of the corpus are gathered with their counts.
2. The pieces of each distinct pre-token are counted once, by the tokenizers library.
3. Per-document pre-token frequencies are joined to those counts and summed.

Most of the frequencies are of a few pre-tokens: the ``HEAD`` most frequent at
most (a bounded table, some megabytes) go to every task and are joined there;
the rest is joined by a shuffle on the pre-token, with frequencies instead of
occurrences. A frequent pre-token thus never makes a hot key.

Defined results: null counts as the empty text, with 0 bytes and 0 tokens; rows
that repeat a doc_id are counted each; texts with special strings are encoded whole by
the library. An empty table gives an
empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, text_chunks
from .pretokens import distinct, library, special_strings, split, texts_of
from .vocabulary import frequent, vocabulary

HEAD = 131_072
LIMIT = 512
#: First byte of the keys of rows that carry a document's own sum; no UTF-8 text holds it.
OWN = b"\xff"


def _pieces(vocab: DataFrame, tokenizer: str) -> DataFrame:
    """(token, pieces): one library call per distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = library(tokenizer)
        for b in batches:
            tokens = b.column(0)
            made = lib.encode_batch([t.decode() for t in tokens.to_pylist()], add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([tokens, pa.array([len(e) for e in made], pa.int32())], names=["token", "pieces"])

    return held(vocab.select("token").mapInArrow(count, "token binary, pieces int"), "pieces")


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, head: int = HEAD,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``): one row per row of ``docs``."""
    vocab = vocabulary(docs, tokenizer, text)
    counted = _pieces(vocab, tokenizer)
    top = frequent(vocab, head)
    if top:
        lib = library(tokenizer)
        known = docs.sparkSession.sparkContext.broadcast(
            dict(zip(top, (len(e) for e in lib.encode_batch([t.decode() for t in top], add_special_tokens=False)), strict=True)))
    else:
        known = docs.sparkSession.sparkContext.broadcast({})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials, get = special_strings(tokenizer), known.value.get
        names = ["token", "row", "doc_id", "n_bytes", "n"]
        for batch in batches:
            rows, ids, texts = batch.column("row"), batch.column("doc_id"), batch.column("text")
            for i, j, data, offsets in text_chunks(texts):
                p = split(data, offsets, specials, tokenizer)
                rep, code = distinct(data, p)
                found = texts_of(data, p, rep)
                pieces = np.array([get(t, 0) for t in found], np.int64)
                own = np.bincount(p.doc, weights=pieces[code] if len(rep) else None, minlength=j - i).astype(np.int64)
                for k in p.odd.tolist():
                    own[k] = len(library(tokenizer).encode(texts[i + k].as_py(), add_special_tokens=False))
                row = rows.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([pa.array([OWN + struct.pack(">q", x) for x in row.to_pylist()], pa.binary()), row,
                                                  ids.slice(i, j - i), pa.array(np.diff(offsets)), pa.array(own)], names=names)
                rare = np.flatnonzero(pieces[code] == 0) if len(rep) else np.zeros(0, np.int64)
                if len(rare):
                    pair, n = np.unique(p.doc[rare] * len(rep) + code[rare], return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(found, pa.binary()).take(pa.array(pair % len(rep))), row.take(pa.array(pair // len(rep))),
                        pa.nulls(len(pair), ids.type), pa.nulls(len(pair), pa.int64()), pa.array(n.astype(np.int64))], names=names)

    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = src.mapInArrow(frequencies, "token binary, row long, doc_id long, n_bytes long, n long")
    # the rows that carry a document's own sum find no pre-token and keep their value
    own = F.substring("token", 1, 1) == F.lit(OWN)
    joined = rows.join(counted, "token", "left").withColumn("tokens", F.when(own, F.col("n")).otherwise(
        F.col("n") * F.coalesce("pieces", F.raise_error(F.lit("a pre-token was not counted")).cast("int"))))
    return (joined.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
