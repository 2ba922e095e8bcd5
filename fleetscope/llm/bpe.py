"""Byte-level BPE encoding and decoding of whole texts.

The most frequent pre-tokens of the corpus (``LEXICON`` at most) are encoded once
and compiled into a minimal acyclic transducer with their ids as outputs; the
file goes to every executor, whose workers memory-map it. A task cuts its texts
into pre-tokens, looks the distinct ones up in the transducer, and merges the
unseen ones exactly, by merge rank, all at a time. No shuffle is needed but for
the counts of pre-tokens.

Defined results: null is the empty text, with no ids; rows that repeat a doc_id
are encoded each; texts with special strings are encoded whole by the tokenizers library; a vocabulary whose merges are not
in the order of their making goes to the library altogether.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled, text_chunks
from .pretokens import distinct, library, ragged, special_strings, split, texts_of
from .transducer import Transducer, compile_words
from .vocabulary import PIECE_BYTES, frequent, vocabulary

LEXICON = 32_768
#: Unseen pre-tokens whose ids a worker remembers; beyond, it starts anew.
MEMORY = 100_000
OUTPUTS = {"ids": "array<int>", "n_tokens": "bigint", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
_NONE = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Merges:
    """Vocabulary and merges of a tokenizer file, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        chars = byte_characters()
        self.byte_id = np.array([vocab[c] for c in chars], np.int32)
        back = {c: b for b, c in enumerate(chars)}
        size = max(vocab.values()) + 1
        names: list[bytes] = [b""] * size
        for s, i in vocab.items():
            names[i] = bytes(back[c] for c in s)
        self.names = names
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        # a piece must be made by an earlier merge than those that use it
        born = np.full(size, -1, np.int64)
        born[made[::-1]] = np.arange(len(made))[::-1]
        self.ordered = bool((np.maximum(born[left], born[right]) < np.arange(len(made))).all()) and len(set(made.tolist())) == len(made)
        self._tables(left << 32 | right, made)

    def _tables(self, keys: np.ndarray, made: np.ndarray) -> None:
        """Pairs in hash tables without chains: what collides in one goes to the next."""
        self.levels, rest = [], np.arange(len(keys))
        bits, turn = 20, 0
        while len(rest):
            factor = np.uint64(0x9E3779B97F4A7C15 + 2 * turn * 0x1000193)
            slot = ((keys[rest].view(np.uint64) * factor) >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << bits, -1, np.int32)
            table[slot[first]] = rest[first]
            self.levels.append((factor, np.uint64(64 - bits), table))
            rest = np.delete(rest, first)
            bits, turn = 16, turn + 1
        self.keys, self.made = np.append(keys, -1), np.append(made, -1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        out = np.full(len(key), _NONE, np.int32)
        for factor, shift, table in self.levels:
            at = table[((key.view(np.uint64) * factor) >> shift).astype(np.int64)]
            hit = self.keys[at] == key
            out[hit] = at[hit]
        return out

    def merge(self, words: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of each word; per round, every word merges all places of its best pair, from the left."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        which = np.flatnonzero([len(w) > 0 for w in words])
        sizes = np.array([len(words[i]) for i in which.tolist()], np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        while len(which):
            starts = np.cumsum(sizes) - sizes
            rank = np.full(len(sym), _NONE, np.int32)
            rank[:-1] = self.ranks(sym[:-1], sym[1:])
            rank[starts + sizes - 1] = _NONE
            best = np.minimum.reduceat(rank, starts)
            done = best == _NONE
            if done.any():
                for i, s, n in zip(which[done].tolist(), starts[done].tolist(), sizes[done].tolist(), strict=True):
                    out[i] = sym[s:s + n].copy()
                keep = np.repeat(~done, sizes)
                sym, rank = sym[keep], rank[keep]
                which, sizes, best = which[~done], sizes[~done], best[~done]
                if not len(which):
                    break
                starts = np.cumsum(sizes) - sizes
            hit = rank == np.repeat(best, sizes)
            at = np.flatnonzero(hit)
            # of places that overlap (as in aaa) every other one counts, from the left
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            run = np.flatnonzero(fresh)
            at = at[(np.arange(len(at)) - run[np.cumsum(fresh) - 1]) % 2 == 0]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sizes = np.add.reduceat(keep, starts, dtype=np.int64)
            sym = sym[keep]
        return out


@functools.cache
def merges(path: str) -> Merges:
    return Merges(path)


@functools.cache
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces' bytes one after the other, with their starts and sizes."""
    names = merges(path).names
    sizes = np.array([len(x) for x in names], np.int64)
    return np.frombuffer(b"".join(names), np.uint8), np.cumsum(sizes) - sizes, sizes


@functools.cache
def decimal_table(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the ids as decimals, each with a comma."""
    names = [b"%d," % i for i in range(n)]
    sizes = np.array([len(x) for x in names], np.int64)
    return np.frombuffer(b"".join(names), np.uint8), np.cumsum(sizes) - sizes, sizes


def lexicon(docs: DataFrame, tokenizer: str, size: int = LEXICON, text: str = "text") -> tuple[str, dict]:
    """Compile the frequent pre-tokens of ``docs``; (name of the shared file, its layout)."""
    spark = docs.sparkSession
    found: list[bytes] = []
    settled(lambda: (found.extend(frequent(vocabulary(docs, tokenizer, text), size)), spark.range(0))[1], "lexicon")
    words = found
    name = f"lexicon-{uuid.uuid4().hex[:12]}.npy"
    path = os.path.join(tempfile.mkdtemp(prefix="fleetscope-lexicon-"), name)
    info = compile_words(words, merges(tokenizer).merge(words), path)
    docs.sparkSession.sparkContext.addFile(path)
    return name, info


@functools.cache
def _mapped(name: str, layout: tuple) -> Transducer:
    return Transducer(SparkFiles.get(name), layout)


class Encoder:
    """Ids of the texts of a chunk; holds the ids of unseen words between chunks."""

    def __init__(self, tokenizer: str, transducer: Transducer | None) -> None:
        self.tokenizer, self.words = tokenizer, transducer
        self.specials, self.merges = special_strings(tokenizer), merges(tokenizer)
        self.seen: dict[bytes, bytes] = {}  # ids as bytes: an array each would take three times the room

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, count per text, indexes of texts left to the library)."""
        n_docs = len(offsets) - 1
        if not self.merges.ordered:
            return np.zeros(0, np.int32), np.zeros(n_docs, np.int64), np.arange(n_docs)
        p = split(data, offsets, self.specials, self.tokenizer)
        rep, code = distinct(data, p)
        if not len(rep):
            return np.zeros(0, np.int32), np.zeros(n_docs, np.int64), p.odd
        number = (self.words.numbers(data, p.start[rep], p.end[rep] - p.start[rep]) if self.words is not None
                  else np.full(len(rep), -1, np.int64))
        unseen = np.flatnonzero(number < 0)
        tokens = texts_of(data, p, rep[unseen])
        if len(self.seen) > MEMORY:
            self.seen.clear()
        new = [t for t in tokens if t not in self.seen]
        if new:
            self.seen.update((t, x.tobytes()) for t, x in zip(new, self.merges.merge(new), strict=True))
        more = [self.seen[t] for t in tokens]
        sizes, starts = np.zeros(len(rep), np.int64), np.zeros(len(rep), np.int64)
        known = np.flatnonzero(number >= 0)
        table = np.zeros(0, np.int32)
        if len(known):
            sizes[known], starts[known] = self.words.sizes[number[known]], self.words.starts[number[known]]
            table = np.asarray(self.words.ids)
        if more:
            n = np.array([len(x) for x in more], np.int64) // 4
            sizes[unseen], starts[unseen] = n, len(table) + np.cumsum(n) - n
            table = np.concatenate([table, np.frombuffer(b"".join(more), np.int32)])
        ids = ragged(table, starts[code], sizes[code])
        per = np.bincount(p.doc, weights=sizes[code], minlength=n_docs).astype(np.int64)
        return ids, per, p.odd


def encode_decode(docs: DataFrame, tokenizer: str, outputs: Sequence[str] = ("ids", "n_tokens"), keep: Sequence[str] = ("doc_id",),
                  text: str = "text", lexicon_size: int = LEXICON) -> DataFrame:
    """``keep`` columns of ``docs`` with the asked ones of ``OUTPUTS``.

    ids: without added special tokens. decoded: the ids' text again, special
    tokens kept. The digests are SHA-256 in lower-case hex, of the decimal ids
    joined by commas and of the decoded text in UTF-8."""
    name, info = lexicon(docs, tokenizer, lexicon_size, text)
    layout = tuple(info["layout"])
    kept = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    digest = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tokenizer, _mapped(name, layout))
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for i, j, data, offsets in text_chunks(texts, PIECE_BYTES):
                ids, per, odd = enc.chunk(data, offsets)
                if len(odd):
                    parts = np.split(ids, np.cumsum(per)[:-1])
                    for k in odd.tolist():
                        whole = library(tokenizer).encode(texts[i + k].as_py() or "", add_special_tokens=False).ids
                        parts[k] = np.array(whole, np.int32)
                    per = np.array([len(x) for x in parts], np.int64)
                    ids = np.concatenate(parts).astype(np.int32)
                ends = np.cumsum(per)
                cols: dict[str, pa.Array] = {}
                if "ids" in outputs:
                    cols["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids, pa.int32()))
                if "n_tokens" in outputs:
                    cols["n_tokens"] = pa.array(per)
                if "ids_sha256" in outputs:
                    flat, s, n = decimal_table(max(len(enc.merges.names), int(ids.max()) + 1 if len(ids) else 0))
                    cols["ids_sha256"] = pa.array([digest(x[:-1]) for x in _cut(ragged(flat, s[ids], n[ids]), n[ids], ends)])
                if "decoded" in outputs or "decoded_sha256" in outputs:
                    flat, s, n = byte_table(tokenizer)
                    plain = np.where(ids < len(n), ids, 0)
                    back = _cut(ragged(flat, s[plain], n[plain]), n[plain], ends)
                    for k in odd.tolist():  # may hold special tokens, which are not in the table
                        back[k] = library(tokenizer).decode(ids[ends[k] - per[k]:ends[k]].tolist(), skip_special_tokens=False).encode()
                    back = [x.decode("utf-8", "replace") for x in back]
                    if "decoded" in outputs:
                        cols["decoded"] = pa.array(back, pa.string())
                    if "decoded_sha256" in outputs:
                        cols["decoded_sha256"] = pa.array([digest(x.encode()) for x in back])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(len(keep))), *(cols[o] for o in outputs)],
                                                 names=[*(f"k{c}" for c in range(len(keep))), *outputs])

    schema = ", ".join([*(f"k{i} {kept.schema[i].dataType.simpleString()}" for i in range(len(keep))), *(f"{o} {OUTPUTS[o]}" for o in outputs)])
    return kept.mapInArrow(run, schema).toDF(*keep, *outputs)


def _cut(data: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """``data`` (pieces of the given sizes) as one byte string per text; ``ends`` counts pieces."""
    at = np.append(0, np.cumsum(sizes))[np.append(0, ends)].tolist()
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
