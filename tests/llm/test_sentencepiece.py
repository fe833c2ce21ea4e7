"""Ids and texts against the SentencePiece library, for the BPE file and for unigram models written by hand."""

from __future__ import annotations

import struct
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tariffa.llm import sentencepiece_codec as codec

TEXTS = [
    "", " ", "  a  b ", "Hello, World", "\n\t x", "<s> hi </s> <unk>", "日本語テキスト😀", "a▁b", "▁▁x", "\u0000z", "é́ ﬁ ", "<0x41>",
    "naïve café", "long word " * 5000,
]


def message(*fields):
    """A protobuf message from (number, value): int, float or bytes."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram(byte_fallback=True, prefix=True, squeeze=True):
    words = ["▁", "▁Hello", "He", "llo", "▁W", "or", "ld", "▁a", "▁b", "l", "o", "a", "b", "x", "H", "e", "W", "r", "d", ",", "w", "n", "g", "▁long"]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{i:02X}>", -20.0, 6) for i in range(256)] if byte_fallback else []
    pieces += [(w, -1.0 - 0.37 * i, 1) for i, w in enumerate(words)]
    body = [(1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in pieces]
    trainer = message((3, 1), (35, int(byte_fallback)), (40, 0), (41, 1), (42, 2), (43, 2**64 - 1))
    normaliser = message((1, b"identity"), (3, int(prefix)), (4, int(squeeze)), (5, 1))
    return message(*body, (2, trainer), (3, normaliser))


def test_the_file_is_rebuilt_exactly():
    model = codec.read_model(codec.MODEL)
    ours, theirs = codec.build(model), SentencePieceProcessor(model_proto=model)
    for text in TEXTS:
        ids = ours.encode(text, add_special_tokens=False).ids
        assert ids == theirs.encode(text), text
        assert ours.decode(ids, skip_special_tokens=False) == theirs.decode(ids), text


@pytest.mark.parametrize("settings", [(True, True, True), (True, False, False), (True, True, False)])
def test_unigram_models_with_bytes(settings):
    model = unigram(*settings)
    ours, theirs = codec.build(model), SentencePieceProcessor(model_proto=model)
    for text in TEXTS:
        if "<0x41>" not in text:
            assert ours.encode(text, add_special_tokens=False).ids == theirs.encode(text), text


@pytest.mark.parametrize("most", [400_000, 3])
def test_parts_that_came_before_change_nothing(most):
    for model in (codec.read_model(codec.MODEL), unigram(), unigram(True, False, False)):
        encoder, theirs = codec.Encoder(model, most), SentencePieceProcessor(model_proto=model)
        texts = [t for t in TEXTS if "<0x41>" not in t]
        for batch in (texts, texts[::-1], texts[:2]):
            ids, parity = encoder.encode(batch)
            assert ids == theirs.encode(batch) and all(parity)
            assert encoder.decode(ids) == encoder.tokenizer.decode_batch(ids, skip_special_tokens=False)


def test_a_difference_is_seen():
    """Another model as the reference: parity is false where the ids differ, and only there."""
    encoder = codec.Encoder(unigram())
    encoder.reference = SentencePieceProcessor(model_proto=codec.read_model(codec.MODEL))
    ids, parity = encoder.encode(["Hello World", "", " a  b"])
    assert parity == [a == b for a, b in zip(ids, encoder.reference.encode(["Hello World", "", " a  b"]), strict=True)]
    assert parity[:2] == [False, True]


def test_a_difference_of_whole_texts_is_seen():
    """Every part agrees alone, but the library's own normaliser squeezes spaces: only the text as a whole tells."""
    encoder = codec.Encoder(unigram(squeeze=False))
    encoder.reference = SentencePieceProcessor(model_proto=unigram(squeeze=True))
    assert encoder.encode(["a b"])[1] == [True]
    assert encoder.encode(["a  b", "a b "])[1] == [False, False]
    # a word known from before hides nothing
    assert encoder.encode(["a b", "a  b"])[1] == [True, False]


def test_texts_come_back_through_the_decoder():
    encoder = codec.Encoder(codec.read_model(codec.MODEL))
    ids, _ = encoder.encode(TEXTS)
    assert encoder.decode(ids) == encoder.reference.decode(ids) and encoder.decode([[]]) == [""]


def test_parse_reads_the_settings():
    spec = codec.parse(unigram(True, False, True))
    assert (spec.kind, spec.byte_fallback, spec.dummy_prefix, spec.squeeze) == (codec.UNIGRAM, True, False, True)
    assert spec.pieces[0] == ("<unk>", 0.0, 2) and len(spec.pieces) == 3 + 256 + 24


def test_columns(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, "x"), (3, "Hello, World", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = docs.withColumn("found", codec.encoded(codec.read_model(codec.MODEL), most=1000)).collect()
    theirs = SentencePieceProcessor(model_file=codec.MODEL)
    assert len(found) == len(rows)
    for r in found:
        assert r["found"]["parity"] and r["found"]["ids"] == theirs.encode(r["text"] or "")
        assert "▁" in (r["text"] or "") or r["found"]["decoded"] == (r["text"] or "")
    empty = docs.limit(0).withColumn("found", codec.encoded(codec.read_model(codec.MODEL)))
    assert empty.filter(F.col("found.parity")).count() == 0


def test_a_batch_is_handed_over_in_pieces():
    """What a worker holds follows the piece, not the batch; one vocabulary serves whole texts and parts."""
    encoder = codec.Encoder(codec.read_model(codec.MODEL))
    texts = ["Hello World " * 30, None, "", "x" * 5000, *["a b c"] * 1000, "Grüße\n"]
    batch = pa.array(texts, pa.string())
    found = list(codec.encode_batches(encoder, iter([batch, batch.slice(0, 0), batch.slice(2)]), 1000))
    assert len(found) > 10 and max(len(piece) for piece in found) <= 201
    rows = [r for piece in found for r in piece.to_pylist()]
    assert [r["decoded"] for r in rows] == [t or "" for t in [*texts, *texts[2:]]] and all(r["parity"] for r in rows)


def test_kept_parts_take_four_bytes_an_id():
    """As lists of numbers they took many times that, in every worker process."""
    encoder = codec.Encoder(codec.read_model(codec.MODEL))
    texts = [f"part{i} zq{i * i}xv and some more words" for i in range(500)]
    ids, parity = encoder.encode(texts)
    assert all(parity) and ids == encoder.reference.encode(texts)
    assert sum(sys.getsizeof(v) - sys.getsizeof(b"") for v in encoder.known.values()) <= 4 * sum(len(i) for i in ids)
