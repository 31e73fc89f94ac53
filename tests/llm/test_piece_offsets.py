import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path

import __spark_entry__ as E
from linkrec.llm import piece_offsets as po
from tests.conftest import SF001

MODEL = path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "ñ", "😀", "▁", "<s>", "<0x0A>", "word", "\x00", "ﬁ", "İ", "汉字", "́",
         "'s", "12", "   ", "\xa0", "Ⅷ", "①", "ｶﾞ"]


@pytest.fixture(scope="module")
def data():
    with open(MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(data):
    return sentencepiece.SentencePieceProcessor(model_proto=data)


def texts(n=500):
    rng = random.Random(7)
    made = ["".join(rng.choices(PARTS, k=rng.randrange(0, 60))) for _ in range(n)]
    return [*made, "", " ", "x" * 3000, "ab" * 2000 + " tail", "word " * 5000, "\x00", "▁▁a"]


def test_ids_spans_and_decoding_equal_the_library(data, library):
    model = po.PieceModel(data)
    for text in texts():
        ids, ends = model.encode(text)
        want = library.encode(text, add_bos=True, add_eos=True)
        assert po.unpack(ids) == want, text
        assert model.decode(ids) == library.decode(want), text
        marks = po.spans(ends)
        assert marks[1:-1] == [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces], text
        assert marks[-1] == (len(text.encode()),) * 2 and marks[0][0] == marks[0][1]


def test_decoding_of_any_ids(data, library):
    model, rng = po.PieceModel(data), random.Random(3)
    for _ in range(1500):
        ids = [rng.randrange(0, 400) if rng.random() < 0.7 else rng.randrange(32000) for _ in range(rng.randrange(30))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_small_cache_and_long_units_change_nothing(data, monkeypatch):
    model = po.PieceModel(data)
    want = [model.encode(t) for t in texts(200)]
    monkeypatch.setattr(po, "CACHE", 5)
    monkeypatch.setattr(po, "CACHED_CHARS", 3)
    other = po.PieceModel(data)
    assert [other.encode(t) for t in texts(200)] == want


def _field(number, value):
    def varint(n):
        out = b""
        while True:
            out += bytes([n & 127 | (128 if n > 127 else 0)])
            n >>= 7
            if not n:
                return out
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeeze", [0, 1])
def test_longest_prefixes_of_a_compiled_map(data, rule, squeeze):
    """The same pieces under another normaliser: ids and spans still equal the library's."""
    spec = dict(po.wire_fields(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()))
    assert len(spec[2]) > 1000
    new = _field(1, rule.encode()) + _field(2, spec[2]) + _field(3, 1) + _field(4, squeeze) + _field(5, 1)
    parts = [_field(n, v) for n, v in po.wire_fields(data) if n != 3]
    own = b"".join(parts) + _field(3, new)
    model, library = po.PieceModel(own), sentencepiece.SentencePieceProcessor(model_proto=own)
    for text in texts(300):
        ids, ends = model.encode(text)
        want = library.encode(text, add_bos=True, add_eos=True)
        assert po.unpack(ids) == want, text
        assert po.spans(ends)[1:-1] == [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces], text
        assert model.decode(ids) == library.decode(want), text


def test_unsupported_models(data):
    parts = [(n, v) for n, v in po.wire_fields(data)]
    unigram = b"".join(_field(n, v if n != 2 else _field(3, 1)) for n, v in parts)
    with pytest.raises(ValueError):
        po.PieceModel(unigram)


def test_rows(spark):
    rows = [(1, "Hello  wörld"), (2, None), (3, ""), (None, "x"), (1, "Hello  wörld"), (4, "long text " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "1 as decoded")
    got = po.encode_pieces(df, MODEL).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "2", "3", "4", "None"]
    by = {r.doc_id: r for r in got}
    assert by[2].decoded == by[3].decoded == "" and po.unpack(by[2].ids) == [1, 2]
    assert by[1].decoded == "Hello  wörld" and by[4].decoded == "long text " * 200_000
    assert po.encode_pieces(df, MODEL, decode=False).where("decoded is not null").count() == 0
    assert po.encode_pieces(df.limit(0), MODEL).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = E.queries()["op11_pieces"](spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
