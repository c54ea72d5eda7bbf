"""SentencePiece encoding and decoding against the library, on its model and on variants with character maps."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tidewatch.llm import catalog, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "\n\n", "▁", "▁▁ ▁", " ▁a", "a\tb", "\x00a\x00", "é🙂日本語x", "<s></s><0x41><unk>", " " * 40 + "x", "a" * 300,
    "ﬁ ＡＢＣ　ｶﾞ ﷺ x", "á é̀", "​​", "　　a", " \t\n ", "①½ Ⅷ", "\x01", "\x01 \x02 a", "a \x01", "¨ ¨", " ¨",
]


def random_texts(seed, n=600):
    rng = random.Random(seed)
    letters = "ab eÀ́\n\t▁é日ｶﾞ🙂.ﬁ①​\x01　¨<>0x1"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(n)]


def _number(n):
    return bytes([n & 127 | (128 if n > 127 else 0)]) + (_number(n >> 7) if n > 127 else b"")


def _message(field, data):
    return _number(field << 3 | 2) + _number(len(data)) + data


def variant(chars, dummy, squeeze, suffix, fallback):
    """The model with another normaliser, and with or without byte pieces."""
    out = b""
    with open(PATH, "rb") as file:
        data = file.read()
    for field, value in pieces._fields(data):
        if field == 1:
            out += _message(1, value if fallback else value.replace(b"\x18\x06", b"\x18\x01"))
    trainer = _number(3 << 3) + _number(2) + _number(24 << 3) + _number(suffix) + _number(35 << 3) + _number(fallback)
    rules = _message(2, chars) + b"".join(_number(f << 3) + _number(v) for f, v in ((3, dummy), (4, squeeze), (5, 1)))
    return out + _message(2, trainer) + _message(3, rules)


def compare(library, data, texts):
    encoder, decoder = pieces.Encoder(data), pieces.Decoder(data)
    ids, begins, ends, first = encoder.encode(texts)
    for i, text in enumerate(texts):
        own = slice(first[i], first[i + 1])
        expected = library.encode(text)
        assert ids[own].tolist() == expected, repr(text)
        spans = library.encode(text, return_type="offset_mapping", return_bytes=True)["offsets"]
        assert list(zip(begins[own].tolist(), ends[own].tolist(), strict=True)) == [tuple(s) for s in spans], repr(text)
        assert decoder.decode(expected) == library.decode(expected), repr(text)


def test_the_model_as_it_is():
    data = pieces.read_model(PATH)
    compare(sentencepiece.SentencePieceProcessor(model_file=PATH), data, ODD + random_texts(1, 2000))


@pytest.mark.parametrize("dummy", [0, 1])
@pytest.mark.parametrize("squeeze", [0, 1])
@pytest.mark.parametrize("suffix", [0, 1])
@pytest.mark.parametrize("fallback", [0, 1])
@pytest.mark.parametrize("mapped", [0, 1])
def test_other_normalisers(dummy, squeeze, suffix, fallback, mapped):
    chars = b""
    if mapped:
        made = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
        chars = dict(pieces._fields(dict(pieces._fields(made))[3]))[2]
    data = variant(chars, dummy, squeeze, suffix, fallback)
    compare(sentencepiece.SentencePieceProcessor(model_proto=data), data, ODD + random_texts(2))


def test_any_ids_decode_as_the_library_does():
    data, library = pieces.read_model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    decoder, rng = pieces.Decoder(data), random.Random(3)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else 3 + rng.randrange(256) for _ in range(rng.randrange(9))]
        assert decoder.decode(ids) == library.decode(ids)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    data = pieces.read_model(PATH)
    encoder, library = pieces.Encoder(data), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in random_texts(4, 200):
        assert encoder.encode([text])[0].tolist() == library.encode(text)


def test_a_long_text_without_a_cut():
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(200_000))
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert pieces.Encoder(pieces.read_model(PATH)).encode([text])[0].tolist() == library.encode(text)


def test_other_models_are_refused(tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="BPE"):
        pieces.Model.read(_message(1, _message(1, b"a")))
    monkeypatch.setattr(pieces, "MODEL_BYTES", 10)
    with pytest.raises(ValueError, match="larger"):
        pieces.read_model(PATH)


def test_rows(spark, documents):
    rows = [(1, ""), (2, None), (1, "Hello  world"), (1, "Hello  world"), (None, "é日🙂\n"), (3, "x" * 5000)]
    data = pieces.read_model(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = documents(rows).withColumn("ids", F.lit(1)).withColumn("ends", F.lit("x"))
    found = pieces.encoded(docs, data, bos=True).collect()
    assert sorted((r.doc_id or 0, r.ids) for r in found) == sorted(
        (i or 0, library.encode(t or "", add_bos=True, add_eos=True)) for i, t in rows
    )
    for r in found:
        text = next((t or "") for i, t in rows if library.encode(t or "", add_bos=True, add_eos=True) == r.ids)
        assert (r.begins[0], r.ends[0], r.begins[-1], r.ends[-1]) == (0, 0, *[len(text.encode())] * 2)
        assert all(a <= b for a, b in zip(r.begins, r.ends, strict=True))
    assert pieces.round_trips(docs.limit(0), data).count() == 0


def test_query_against_the_library(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = set()
    for doc_id, text in texts.items():
        ids = library.encode(text, add_eos=True)
        expected.add((doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    assert {tuple(r) for r in catalog.QUERIES["op13_pieces"](spark, sf_dir).collect()} == expected
