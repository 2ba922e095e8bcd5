import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fleetscope.llm.bpe import Encoder, encode_decode, merges
from fleetscope.llm.common import text_chunks
from fleetscope.llm.pretokens import special_strings, split
from fleetscope.llm.queries import tokenizer_path
from fleetscope.llm.tokencount import token_counts
from fleetscope.llm.transducer import Transducer, compile_words

from .conftest import LONG, documents

PATH = tokenizer_path("byte_bpe_50k.json")
PARTS = [*"ab'stmdrevlLS  \n\t\r 12.,!é中　ß\x00", "'s", " the", " hello", "aaaaaaa", "<|endoftext|>", "'ll", "😀", "ȡ", "\u0085"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [*made, None, "", "   ", LONG, "x" * 30_000, *made[:3]]


def test_encoding_decoding_and_counts_are_the_librarys(shipped, texts):
    lib = Tokenizer.from_file(PATH)
    docs = documents(shipped, texts)
    enc = {r.doc_id: r for r in encode_decode(docs, PATH, outputs=("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"), lexicon_size=40).collect()}
    cnt = {r.doc_id: r for r in token_counts(docs, PATH, limit=20, head=16).collect()}
    assert len(enc) == len(cnt) == len(texts)
    for i, t in enumerate(texts, 1):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        assert enc[i].ids == ids and enc[i].decoded == back
        assert enc[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert enc[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
        assert (cnt[i].n_tokens, cnt[i].n_bytes, cnt[i].over_limit) == (len(ids), len((t or "").encode()), len(ids) > 20)


def test_only_special_strings_are_left_to_the_library():
    rng = random.Random(6)
    new = [*map(chr, [0x1F600, 0x1F389, 0x1F680, 0x20B9, 0x0221, 0x1E900, 0x1D7CE, 0x20000, 0x2EBF0, 0x30000, 0x31350, 0x180E, 0x200B, 0x0378, 0x10FFFF, 0xE000, 0x0660, 0x1171E])]
    made = ["".join(rng.choice([*PARTS, *new, *new]).replace("<|endoftext|>", "") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    lib = Tokenizer.from_file(PATH)
    for limit in (1 << 20, 200):
        for i, j, data, offsets in text_chunks(pa.array([*made, "a<|endoftext|>b"]), limit):
            p = split(data, offsets, special_strings(PATH), PATH)
            assert p.odd.tolist() == ([len(made) - i] if j > len(made) else [])
            raw = data.tobytes()
            for k in range(i, min(j, len(made))):
                mine = np.flatnonzero(p.doc == k - i)
                assert [raw[p.start[m]:p.end[m]].decode() for m in mine] == [made[k][a:b] for _, (a, b) in lib.pre_tokenizer.pre_tokenize_str(made[k])]


def test_empty_table_and_repeated_rows(shipped):
    docs = documents(shipped, ["a b", "a b"])
    assert encode_decode(docs.limit(0), PATH).collect() == [] and token_counts(docs.limit(0), PATH).collect() == []
    twice = docs.filter("doc_id = 1").union(docs.filter("doc_id = 1"))
    assert [r.n_tokens for r in token_counts(twice, PATH).collect()] == [2, 2]


def test_merges_agree_with_the_library():
    lib = Tokenizer.from_file(PATH)
    words = [b"a", b"aaaaa", b" antidisestablishment", "é".encode(), b"x" * 300, b" the"]
    assert [m.tolist() for m in merges(PATH).merge(words)] == [lib.encode(w.decode(), add_special_tokens=False).ids for w in words]


def test_transducer_shares_suffixes_and_numbers_words(tmp_path):
    words = [a + b for a in (b"", b"un", b"re", b"pre") for b in (b"doing", b"making", b"taking", b"ing")]
    info = compile_words(words, [[i] for i in range(len(words))], str(tmp_path / "t.npy"))
    assert info["states"] < len({w[:k] for w in words for k in range(len(w) + 1)})
    t = Transducer(str(tmp_path / "t.npy"), info["layout"])
    asked = [*words, b"und", b"xing", b"doingx", b""]
    data = np.frombuffer(b"".join(asked), np.uint8)
    sizes = np.array([len(w) for w in asked])
    number = t.numbers(data, np.cumsum(sizes) - sizes, sizes)
    assert (number[len(words):] == -1).all()
    assert [t.ids[t.starts[n]] for n in number[:len(words)]] == list(range(len(words)))


def test_a_worker_remembers_unseen_words_in_little_memory():
    enc = Encoder(PATH, None)
    enc.chunk(np.frombuffer(b"warm up", np.uint8), np.array([0, 7]))
    rng = np.random.default_rng(7)
    tracemalloc.start()
    for _ in range(5):
        words = rng.integers(97, 123, (40_000, 9), np.uint8)
        words[:, 0] = 32
        ids, per, odd = enc.chunk(words.ravel(), np.array([0, words.size]))
        assert not len(odd) and per[0] == len(ids) > 40_000
    taken, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert taken < 32 << 20
