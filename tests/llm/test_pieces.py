"""SentencePiece encoding with offsets against the library, under several normalisers."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceNormalizer, SentencePieceProcessor, sentencepiece_model_pb2

from tenorgrid.llm import pieces
from tenorgrid.llm.pieces import BYTE, PieceModel, character_map, decode_pieces, encode_pieces
from tenorgrid.llm.tokens import tokenizer_path
from tests.llm import helpers as h

AWKWARD = ["", " ", "   ", "a", " a", "a ", "a  b", "\ta\n\nb \n", "▁", "▁x▁", "x ▁", "①㍿ﬁ", "éẹ́ å", "　wide　　x",
           "a\x00b", "\x01\x02", "­​", "😀👩‍👩‍👧 x", "中文 字", "<s>x</s><unk><0x0A>", "Ⅷ ℌ ½", "ガギ ｶﾞ", "क़ড়", "ﷺ  ", "한글 한", "�"]


def variant(rule: str | None = None, **changes) -> bytes:
    model = sentencepiece_model_pb2.ModelProto.FromString(open(tokenizer_path("piece_bpe_32k.model"), "rb").read())
    if rule:
        spec = SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
        model.normalizer_spec.CopyFrom(sentencepiece_model_pb2.NormalizerSpec.FromString(spec))
    for name, value in changes.items():
        if name == "user":
            model.pieces[300].type, model.pieces[300].piece = 4, value
        elif name == "byte_fallback" and not value:
            model.trainer_spec.byte_fallback = False
            for p in model.pieces:
                if p.type == BYTE:
                    p.type, p.piece = 1, f"never{p.piece}"
        else:
            setattr(model.trainer_spec if name.startswith("treat") else model.normalizer_spec, name, value)
    return model.SerializeToString()


VARIANTS = {
    "as it is": variant(),
    "no prefix": variant(add_dummy_prefix=False),
    "nfkc": variant("nfkc"),
    "nmt_nfkc_cf": variant("nmt_nfkc_cf", remove_extra_whitespaces=True, add_dummy_prefix=True),
    "nfkc, spaces stay": variant("nmt_nfkc", remove_extra_whitespaces=False),
    "suffix": variant("nfkc_cf", treat_whitespace_as_suffix=True, add_dummy_prefix=True),
    "user symbols": variant("nfkc", user="①㍿"),
    "unknown pieces": variant("nfkc", byte_fallback=False),
}


@pytest.fixture(scope="module", params=VARIANTS)
def model(request):
    return PieceModel(VARIANTS[request.param])


def check(model: PieceModel, text: str) -> None:
    normal, start, end = model.normalise(text)
    expected, offsets = model.library.normalize(text, with_offsets=True)
    assert normal == expected
    place = {0: 0}
    for k, c in enumerate(text):  # byte place to character place
        place[max(place) + len(c.encode())] = k + 1
    at, firsts = 0, []
    for c in normal:
        firsts.append(at)
        at += len(c.encode())
    if not model.fixed:  # the library gives all characters of a user symbol its first place
        assert [place[int(start[k])] for k in [*firsts, at]] == list(offsets)
    assert (start[:-1] <= end).all() and len(end) == at

    ids, begins, ends = model.encode([text])[0]
    assert ids.tolist() == model.library.encode(text)
    spans = model.library.encode(text.encode(), return_type="offset_mapping")["offsets"]
    source = text.encode()
    for i, b, e, (lb, le) in zip(ids.tolist(), begins.tolist(), ends.tolist(), spans):
        assert b <= e <= len(source)
        if not model.library.is_byte(i) and lb < le:
            assert e == le and b <= lb or b == lb
        if model.plain and not model.library.is_byte(i):
            assert (b, e) == (lb, le)
        if model.plain and model.library.is_byte(i):
            assert source[b:e] == model.pieces[i]
    if model.plain:
        assert b"".join(source[b:e] for b, e in zip(begins.tolist(), ends.tolist())) == source


def test_awkward_texts(model):
    for text in [*AWKWARD, "".join(AWKWARD), " ".join(AWKWARD)]:
        check(model, text)


CHARS = st.text(st.one_of(st.sampled_from(" 　▁aẹ́①㍿ﬁｶﾞ하\n\t"), st.characters(exclude_categories=["Cs"])), max_size=40)


@given(CHARS)
@settings(max_examples=150, deadline=None)
def test_any_text(text):
    for name in VARIANTS:
        check(MODELS[name], text)


MODELS = {name: PieceModel(proto) for name, proto in VARIANTS.items()}


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf"])
def test_character_map_is_read_whole(rule):
    normalizer = SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)
    spec = sentencepiece_model_pb2.NormalizerSpec.FromString(normalizer.serialized_normalizer_spec())
    found = character_map(spec.precompiled_charsmap)
    assert len(found) > 1000
    assert all(normalizer.normalize(k) == v for k, v in found.items())
    assert found == {k: v for k, v in normalizer.decompile().items()} if isinstance(normalizer.decompile(), dict) else True


def test_operator_keeps_rows_and_offsets(spark):
    docs = h.table(spark)
    library = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    encoded = encode_pieces(docs, ["doc_id", "key", "size"])
    assert encoded.columns == ["doc_id", "key", "size", "ids", "starts", "ends"]
    got = sorted((r.doc_id, tuple(r.ids), r.ends[-1] if r.ends else 0) for r in encoded.collect())
    assert got == sorted((d, tuple(library.encode(t or "")), len((t or "").encode())) for d, t, _ in h.corpus())
    back = sorted((r.doc_id, r.decoded) for r in decode_pieces(encoded, ["doc_id"]).collect())
    assert back == sorted((d, library.decode(library.encode(t or ""))) for d, t, _ in h.corpus())
    assert encode_pieces(h.table(spark, []), ["doc_id"]).count() == 0
    assert decode_pieces(encode_pieces(h.table(spark, []), ["doc_id"]), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        encode_pieces(docs.withColumnRenamed("key", "ids"), ["ids"])
    odd = docs.withColumnRenamed("key", "a `b`.c 0").withColumnRenamed("blob", "TEXT ")
    assert encode_pieces(odd, ["a `b`.c 0", "text", "TEXT "]).count() == docs.count()


def test_query_equals_the_library(spark):
    library = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    expected = []
    for r in spark.read.parquet(f"{h.FOLDER}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        expected.append((r.doc_id, len(ids), len((r.text or "").encode()), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, pieces.op11_sentence_pieces(spark, h.FOLDER).collect())) == sorted(expected)
