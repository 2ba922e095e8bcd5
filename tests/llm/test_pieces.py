"""op11: ids, decoded texts and spans against the sentencepiece library, for this model and for models with a character map."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from fleetscope.llm.common import text_chunks
from fleetscope.llm.queries import tokenizer_path
from fleetscope.llm.spm import Model, encode_pieces, model

from .conftest import LONG, documents

PATH = tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "▁", "▁▁ a", "hello  world   foo ", "<s> </s> <unk> <0x0A>", "\n\n\n", "a\x00b", "é😀😀", " " * 1000 + "x", "ab" * 3000, "▁ ▁", "日本語 テスト"]


def texts(alphabet, n=600):
    rng = random.Random(1)
    return ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(n)]


def encoded(m, texts, limit):
    for i, j, data, offsets in text_chunks(pa.array(texts, pa.string()), limit):
        ids, per, begin, end = m.encode(data, offsets)
        ends = np.cumsum(per)
        for k, text in zip(range(i, j), m.decode(ids, ends), strict=True):
            s = slice(ends[k - i] - per[k - i], ends[k - i])
            yield ids[s].tolist(), text, list(zip(begin[s].tolist(), end[s].tolist(), strict=True))


def same(m, lib, texts, limit=1 << 20):
    for text, got in zip(texts, encoded(m, texts, limit), strict=True):
        ids = lib.encode(text)
        assert got == (ids, lib.decode(ids), [(p.begin, p.end) for p in lib.encode(text, return_type="proto").pieces]), text


@pytest.mark.parametrize("limit", [1 << 20, 300])
def test_ids_text_and_spans_are_the_librarys(limit):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    same(model(PATH), lib, texts("ab  e▁ théñ<s>\n\t0123😀日本語​,.'\""), limit)
    pieces = [lib.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    same(model(PATH), lib, texts(pieces), limit)


@pytest.mark.parametrize("trim", [True, False])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_maps(rule, trim):
    proto, rules = pb.ModelProto(), pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    proto.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = trim
    raw = proto.SerializeToString()
    same(Model(raw), sentencepiece.SentencePieceProcessor(model_proto=raw), texts("ＡＢﬁ①㍿が゙が　  \t\n​ é éÅÅ㌖Ⅷa  ½…️İßŉ ▁\x00"))


def test_models_of_other_kinds_are_refused():
    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        Model(proto.SerializeToString())


def test_rows_nulls_repeats_and_spans(shipped):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    given = [None, "", "a b", "a b", "naïve café 😀", LONG]
    docs = documents(shipped, given).union(documents(shipped, ["a b", "x"], start=3))
    got = encode_pieces(docs, PATH, ("ids", "spans", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")).collect()
    assert sorted((r.doc_id, r.decoded) for r in got) == sorted([(i + 1, t or "") for i, t in enumerate(given)] + [(3, "a b"), (4, "x")])
    for r in got:
        ids = lib.encode(r.decoded)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
        raw = r.decoded.encode()
        assert b"".join(raw[s.begin:s.end] for s in r.spans) == raw
    assert encode_pieces(docs.limit(0), PATH).collect() == []
