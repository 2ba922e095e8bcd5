r"""SentencePiece BPE encoding and decoding of whole texts, with every piece's place in the source.

1. *Normalisation*: at each character the compiled character map (a double-array
   trie over UTF-8 bytes) is searched for its longest key; the key's replacement
   comes out, or else the character itself. All characters of a chunk of texts walk
   the trie in step. Each character that comes out keeps the byte where its source
   begins.
2. White space is trimmed as the model says, blanks become U+2581 and the dummy
   prefix goes in front; the alignment moves along.
3. No piece of the vocabulary holds U+2581 behind another character, so no merge
   crosses from one such run to the next: the text is cut there, and every distinct
   run of a chunk is merged once, best score first, ties from the left.
4. Characters without a piece fall back to bytes. Each piece covers some normalised
   characters; their alignment gives its byte span in the source.

Texts are encoded where they are read: no shuffle, and a task holds one chunk of
texts.

Defined results: null is the empty text, with no ids; a text is UTF-8, as Spark
holds it (bytes that are not count as U+FFFD); rows that repeat a doc_id are
encoded each; an empty table gives an empty result. Models other than BPE with byte
fallback, and models with user-defined or unused pieces, are refused.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks
from .pretokens import Pieces, distinct, ragged

BLANK = 0x2581
#: Bytes of texts that are encoded at a time.
CHUNK = 4 << 20
#: A run of more characters is merged by itself, with a heap.
LONG = 40
#: No piece.
NONE = np.int64(1 << 62)
OUTPUTS = {"ids": "array<int>", "spans": "array<struct<begin:int,end:int>>", "n_tokens": "bigint", "ids_sha256": "string",
           "decoded": "string", "decoded_sha256": "string"}


class CharacterMap:
    """The compiled map of a model: a trie's size, the trie, and the replacements with a NUL behind each."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.unit = np.frombuffer(blob[4:4 + size], np.uint32).astype(np.int64)
        self.blob = blob[4 + size:]
        self.found: dict[int, np.ndarray] = {}

    def _below(self, unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length in bytes, value) of the longest key at each start that ends by its text's end; 0 if none."""
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        if not len(self.unit):
            return length, value
        active = np.arange(len(starts))
        node = np.full(len(starts), self._below(self.unit[:1])[0], np.int64)
        depth = 0
        while len(active):
            at = starts[active] + depth
            inside = at < ends[active]
            active, node, at = active[inside], node[inside], at[inside]
            byte = data[at].astype(np.int64)
            step = node ^ byte
            ok = step < len(self.unit)
            unit = self.unit[np.where(ok, step, 0)]
            ok &= (unit & 0x800000FF) == byte
            active, unit, step = active[ok], unit[ok], step[ok]
            node = step ^ self._below(unit)
            depth += 1
            leaf = np.flatnonzero(unit >> 8 & 1)
            length[active[leaf]] = depth
            value[active[leaf]] = self.unit[node[leaf]] & 0x7FFFFFFF
        return length, value

    def replacement(self, value: int) -> np.ndarray:
        """The code points at a value."""
        if value not in self.found:
            text = self.blob[value:self.blob.index(b"\0", value)].decode()
            self.found[value] = np.array([ord(c) for c in text], np.uint32)
        return self.found[value]


class Pairs:
    """Pairs of symbols and the pieces they make, in an open hash table that takes many pairs at a time."""

    def __init__(self, known: dict[int, int]) -> None:
        self.known = known
        keys, made = np.array(list(known), np.int64), np.array(list(known.values()), np.int64)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.made = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        slot = self._slot(keys)
        while len(keys):
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] < 0]
            self.keys[slot[first]], self.made[slot[first]] = keys[first], made[first]
            keys, made, slot = np.delete(keys, first), np.delete(made, first), (np.delete(slot, first) + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, -1 where there is none."""
        out, slot = np.full(len(keys), -1, np.int64), self._slot(keys)
        rest = np.flatnonzero(keys >= 0)
        while len(rest):
            found = self.keys[slot[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self.made[slot[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
        return out


class Model:
    """A SentencePiece BPE model's character map, pieces and merges."""

    def __init__(self, proto: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(proto)
        t, n = m.trainer_spec, m.normalizer_spec
        kinds = [p.type for p in m.pieces]
        kind = pb.ModelProto.SentencePiece
        if t.model_type != t.BPE or not t.byte_fallback or t.treat_whitespace_as_suffix or not n.escape_whitespaces or {kind.USER_DEFINED, kind.UNUSED} & {*kinds}:
            raise ValueError("only BPE models with byte fallback, escaped white space and normal pieces are known here")
        self.map = CharacterMap(n.precompiled_charsmap)
        self.prefix, self.trim = n.add_dummy_prefix, n.remove_extra_whitespaces
        blank = chr(BLANK)
        normal = {p.piece: i for i, p in enumerate(m.pieces) if p.type == kind.NORMAL}
        if any(blank in s.lstrip(blank) for s in normal):
            raise ValueError("a piece goes across white space")
        self.score = [p.score for p in m.pieces]
        self.byte = np.zeros(256, np.int64)
        self.surface: list[bytes] = []
        for i, p in enumerate(m.pieces):
            if p.type == kind.BYTE:
                self.byte[int(p.piece[1:-1], 16)] = i
                self.surface.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == kind.UNKNOWN:
                self.surface.append(t.unk_surface.encode())
            else:
                self.surface.append(b"" if p.type == kind.CONTROL else p.piece.replace(blank, " ").encode())
        # symbols: the pieces, and the characters that only occur inside them; any other character is below zero
        self.size = len(m.pieces)
        symbols = dict(normal)
        for c in sorted({c for s in normal for c in s}):
            symbols.setdefault(c, self.size + len(symbols))
        self.char = -1 - np.arange(0x110000, dtype=np.int64)
        for c, i in symbols.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        self.blank = normal.get(blank, -1)
        self.inner = {i: ord(c) for c, i in symbols.items() if i >= self.size}
        _, self.rank = np.unique(-np.array([p.score for p in m.pieces]), return_inverse=True)
        self.pairs = Pairs({symbols[s[:k]] << 32 | symbols[s[k:]]: i for s, i in normal.items() for k in range(1, len(s)) if s[:k] in symbols and s[k:] in symbols})

    def normalise(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a chunk of texts: (code points, source byte of each in ``data``, first code point of each text and the
        end of the last, byte where each text's last code point ends)."""
        raw = data.tobytes()
        cps = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        source = np.flatnonzero((data & 0xC0) != 0x80) if len(cps) < len(data) else np.arange(len(data))
        marks = np.searchsorted(source, offsets)
        if len(self.map.unit) and len(cps):
            cps, source, marks = self._mapped(data, offsets, cps, source, marks)
        last = offsets[1:].copy()
        doc = np.repeat(np.arange(len(marks) - 1), np.diff(marks))
        if self.trim and len(cps):
            blank = cps == 0x20
            before = np.ones(len(cps), bool)
            before[1:] = blank[:-1]
            before[marks[:-1][np.diff(marks) > 0]] = True
            keep = ~(blank & before)
            # behind the last other character nothing stays, U+2581 of the text itself included
            edge = np.zeros(len(marks) - 1, np.int64)
            np.maximum.at(edge, doc, np.where(blank | (cps == BLANK), 0, np.arange(len(cps)) + 1 - marks[doc]))
            behind = np.arange(len(cps)) >= (marks[:-1] + edge)[doc]
            first = np.flatnonzero(keep & behind)[::-1]
            last[doc[first]] = source[first]
            keep &= ~behind
            cps, source, doc = cps[keep], source[keep], doc[keep]
            marks = np.append(0, np.cumsum(np.bincount(doc, minlength=len(marks) - 1)))
        cps = np.where(cps == 0x20, np.uint32(BLANK), cps)
        if self.prefix:
            full = np.flatnonzero(np.diff(marks))
            at = marks[full]
            cps = np.insert(cps, at, np.uint32(BLANK))
            source = np.insert(source, at, source[at] if self.trim else offsets[full])
            marks = marks + np.searchsorted(full, np.arange(len(marks)))
        return cps, source, marks, last

    def _mapped(self, data: np.ndarray, offsets: np.ndarray, cps: np.ndarray, source: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        doc = np.repeat(np.arange(len(marks) - 1), np.diff(marks))
        length, value = self.map.longest(data, source, offsets[1:][doc])
        width = np.diff(np.append(source, len(data)))
        # from the left: a key of several characters covers those behind it
        covered = np.zeros(len(cps), bool)
        free = 0
        for i in np.flatnonzero(length > width).tolist():
            if source[i] >= free:
                free = int(source[i] + length[i])
                covered[i + 1:np.searchsorted(source, free)] = True
        hit = np.flatnonzero((length > 0) & ~covered)
        values, which = np.unique(value[hit], return_inverse=True)
        texts = [self.map.replacement(v) for v in values.tolist()]
        table = np.concatenate([cps, *texts])
        sizes_of = np.array([len(x) for x in texts], np.int64)
        starts_of = len(cps) + np.cumsum(sizes_of) - sizes_of
        size, start = (~covered).astype(np.int64), np.arange(len(cps))
        size[hit], start[hit] = sizes_of[which], starts_of[which]
        return ragged(table, start, size), np.repeat(source, size), np.append(0, np.cumsum(size))[marks]

    def _joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 32 | piece of each pair that makes a piece, else NONE."""
        made = self.pairs.get(np.where((left < 0) | (right < 0), -1, left << 32 | np.maximum(right, 0)))
        return np.where(made < 0, NONE, self.rank[made] << 32 | made)

    def merge(self, symbol: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, characters that each covers, symbols per run) of runs of characters, in their order.

        Every run makes its one best merge per round: best score, then leftmost."""
        sizes = np.diff(np.append(starts, len(symbol)))
        number, width = np.repeat(np.arange(len(starts)), sizes), np.ones(len(symbol), np.int64)
        joint = np.full(len(symbol), NONE)
        inner = np.flatnonzero(number[1:] == number[:-1])
        joint[inner] = self._joint(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, ...]] = []
        long = sizes > LONG
        if long.any():
            for i in np.flatnonzero(long).tolist():
                s, w = self._merge_long(symbol[starts[i]:starts[i] + sizes[i]].tolist())
                done.append((np.full(len(s), i), s, w))
            keep = ~np.repeat(long, sizes)
            symbol, number, width, joint, sizes = symbol[keep], number[keep], width[keep], joint[keep], sizes[~long]
        while len(symbol):
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(joint >> 32, starts)
            over = best == NONE >> 32
            if over.any():
                out = np.repeat(over, sizes)
                done.append((number[out], symbol[out], width[out]))
                symbol, number, width, joint = (x[~out] for x in (symbol, number, width, joint))
                sizes, best = sizes[~over], best[~over]
                if not len(sizes):
                    break
                starts = np.cumsum(sizes) - sizes
            hit = np.flatnonzero(joint >> 32 == np.repeat(best, sizes))
            first = np.ones(len(hit), bool)
            first[1:] = number[hit[1:]] != number[hit[:-1]]
            at = hit[first]
            symbol[at] = joint[at] & 0xFFFFFFFF
            width[at] += width[at + 1]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            symbol, number, width, joint = symbol[stay], number[stay], width[stay], joint[stay]
            at = at - np.arange(len(at))
            sizes = sizes - 1
            for x in (at, np.maximum(at - 1, 0)):
                y = np.minimum(x + 1, len(symbol) - 1)
                joint[x] = np.where((number[x] == number[y]) & (x != y), self._joint(symbol[x], symbol[y]), NONE)
        number, symbol, width = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(number, kind="stable")
        return symbol[order], width[order], np.bincount(number, minlength=len(long))

    def _merge_long(self, symbol: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long run, with its pairs in a heap."""
        n = len(symbol)
        width, left, right = [1] * n, list(range(-1, n - 1)), [*range(1, n), -1]
        known, heap = self.pairs.known, []

        def offer(a: int, b: int) -> None:
            made = known.get(symbol[a] << 32 | symbol[b]) if symbol[a] >= 0 and symbol[b] >= 0 else None
            if made is not None:
                heapq.heappush(heap, (int(self.rank[made]), a, b, width[a] + width[b], made))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, size, made = heapq.heappop(heap)
            if not width[a] or right[a] != b or width[a] + width[b] != size:
                continue  # one of the two has been merged since
            symbol[a], width[a], width[b] = made, size, 0
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
                offer(a, right[a])
            if left[a] >= 0:
                offer(left[a], a)
        size = np.array(width, np.int64)
        return np.array(symbol, np.int64)[size > 0], size[size > 0]

    def fall_back(self, symbol: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, characters that each covers, ids per symbol): characters without a piece as bytes, the last of which covers it."""
        odd = np.flatnonzero((symbol < 0) | (symbol >= self.size))
        per = np.ones(len(symbol), np.int64)
        if not len(odd):
            return symbol.astype(np.int32), width, per
        of, which = np.unique(symbol[odd], return_inverse=True)
        raw = [chr(-1 - s if s < 0 else self.inner[s]).encode() for s in of.tolist()]
        flat, starts, sizes = _flat(raw)
        per[odd] = sizes[which]
        ends = np.cumsum(per)
        ids, widths = np.repeat(symbol, per), np.zeros(int(ends[-1]), np.int64)
        ids[ragged(np.arange(len(ids)), (ends - per)[odd], per[odd])] = self.byte[ragged(flat, starts[which], per[odd])]
        widths[ends - 1] = width
        return ids.astype(np.int32), widths, per

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a chunk of texts: (ids, ids per text, begin and end of each id's span in bytes of its text)."""
        n_docs = len(offsets) - 1
        cps, source, marks, last = self.normalise(data, offsets)
        if not len(cps):
            e = np.zeros(0, np.int64)
            return e.astype(np.int32), np.zeros(n_docs, np.int64), e, e
        plain = np.frombuffer(cps.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), np.uint8)
        byte_at = np.append(np.flatnonzero((plain & 0xC0) != 0x80), len(plain))
        blank = cps == BLANK
        begins = np.zeros(len(cps), bool)
        begins[1:] = blank[1:] & ~blank[:-1]
        begins[marks[:-1][np.diff(marks) > 0]] = True
        at = np.flatnonzero(begins)
        doc = np.searchsorted(marks, at, side="right") - 1
        p = Pieces(byte_at[at], byte_at[np.append(at[1:], len(cps))], doc, np.zeros(0, np.int64))
        rep, code = distinct(plain, p)
        rep_from = np.cumsum(chars := np.diff(np.append(at, len(cps)))[rep]) - chars
        symbol, width, count = self.merge(self.char[ragged(cps, at[rep], chars)], rep_from)
        ids, widths, per = self.fall_back(symbol, width)
        sizes = np.add.reduceat(per, np.cumsum(count) - count)
        starts = np.cumsum(sizes) - sizes
        ids, widths = ragged(ids, starts[code], sizes[code]), ragged(widths, starts[code], sizes[code])
        owner = np.repeat(doc, sizes[code])
        per = np.bincount(owner, minlength=n_docs)
        right = np.cumsum(widths)
        # byte pieces before the last of a character are empty and stand where it begins
        first = right - widths
        begin = source[np.minimum(first, len(cps) - 1)]
        end = np.where(right >= marks[owner + 1], last[owner], source[np.minimum(right, len(cps) - 1)])
        end = np.where(widths == 0, begin, end)
        return ids, per, begin - offsets[owner], end - offsets[owner]

    @functools.cached_property
    def surfaces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _flat(self.surface)

    @functools.cached_property
    def decimals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _flat([b"%d," % i for i in range(self.size)])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of the ids; ``ends`` counts the ids up to each text's end."""
        back = strings(self.surfaces, ids, ends)
        if self.trim:  # pieces that are nothing but a blank do not end the beginning
            rest, first = np.append(np.flatnonzero(ids != self.blank), len(ids)), np.append(0, ends)[:-1]
            back = [x[n:] for x, n in zip(back, (np.minimum(rest[np.searchsorted(rest, first)], ends) - first).tolist(), strict=True)]
        if self.trim or self.prefix:
            back = [x[1:] if x.startswith(b" ") else x for x in back]
        return [x.decode("utf-8", "replace") for x in back]


def _flat(names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in names], np.int64)
    return np.frombuffer(b"".join(names), np.uint8), np.cumsum(sizes) - sizes, sizes


def strings(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Per text, the table's entries of its ids, one after the other."""
    flat, starts, sizes = table
    at = np.append(0, np.cumsum(sizes[ids]))[np.append(0, ends)].tolist()
    raw = ragged(flat, starts[ids], sizes[ids]).tobytes()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


@functools.cache
def model(path: str) -> Model:
    """The model of a file, one per Python worker."""
    with open(path, "rb") as f:
        return Model(f.read())


def encode_pieces(docs: DataFrame, path: str, outputs: Sequence[str] = ("ids", "spans", "n_tokens"), keep: Sequence[str] = ("doc_id",),
                  text: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` with the asked ones of ``OUTPUTS``.

    spans: the bytes of the source text that each id stands for; empty for the byte
    pieces of a character but its last. The digests are SHA-256 in lower-case hex, of
    the decimal ids joined by commas and of the decoded text in UTF-8."""
    kept = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    digest = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(batch.num_columns - 1), CHUNK):
                ids, per, begin, end = m.encode(data, offsets)
                ends = np.cumsum(per)
                lists = pa.array(np.append(0, ends).astype(np.int32))
                cols: dict[str, pa.Array] = {}
                if "ids" in outputs:
                    cols["ids"] = pa.ListArray.from_arrays(lists, pa.array(ids, pa.int32()))
                if "spans" in outputs:
                    places = pa.StructArray.from_arrays([pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], names=["begin", "end"])
                    cols["spans"] = pa.ListArray.from_arrays(lists, places)
                if "n_tokens" in outputs:
                    cols["n_tokens"] = pa.array(per.astype(np.int64))
                if "ids_sha256" in outputs:
                    cols["ids_sha256"] = pa.array([digest(x[:-1]) for x in strings(m.decimals, ids, ends)])
                if "decoded" in outputs or "decoded_sha256" in outputs:
                    back = m.decode(ids, ends)
                    if "decoded" in outputs:
                        cols["decoded"] = pa.array(back, pa.string())
                    if "decoded_sha256" in outputs:
                        cols["decoded_sha256"] = pa.array([digest(x.encode()) for x in back])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(len(keep))), *(cols[o] for o in outputs)],
                                                 names=[*(f"k{c}" for c in range(len(keep))), *outputs])

    schema = ", ".join([*(f"k{i} {kept.schema[i].dataType.simpleString()}" for i in range(len(keep))), *(f"{o} {OUTPUTS[o]}" for o in outputs)])
    return kept.mapInArrow(run, schema).toDF(*keep, *outputs)
