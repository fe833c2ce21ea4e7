"""SentencePiece models on the Tokenizers library.

The model's protobuf is read here (five fields are needed, so no schema library): pieces with scores and types, the
kind of model, byte fallback and the normaliser's settings.  From them a ``tokenizers.Tokenizer`` is rebuilt: the precompiled
character map, extra-space removal, the metaspace marker with its prefix, unigram scores or merges in the order of scores, and bytes
for unknown characters.  Batches are encoded and decoded multithreaded, and ids are held against the SentencePiece library itself.

A null text counts as empty; an empty text has no ids.  Control symbols (``<s>`` and the like) inside a text are ordinary text; only a unigram
model may take a byte piece spelled out in a text (``<0x41>``) for the piece, and parity is false then.  Repeated
rows get equal ids, an empty table gives an empty result, further columns are ignored.  The model file travels with the
job as bytes, so workers need no copy; its path is a parameter.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# the file format's numbers
UNIGRAM, BPE = 1, 2
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6


@dataclass
class Spec:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix_marker: bool = False


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}[wire] if wire != 2 else varint()
        yield key >> 3, data[at : at + size]
        at += size


def parse(model: bytes) -> Spec:
    spec = Spec()
    for number, value in _fields(model):
        if number == 1:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            spec.pieces.append((own.get(1, b"").decode(), score, own.get(3, 1)))
        elif number == 2:
            trainer = dict(_fields(value))
            spec.kind = trainer.get(3, UNIGRAM)
            spec.byte_fallback = bool(trainer.get(35, 0))
            spec.suffix_marker = bool(trainer.get(24, 0))
        elif number == 3:
            own = dict(_fields(value))
            spec.charsmap = own.get(2, b"")
            spec.dummy_prefix, spec.squeeze, spec.escape = (bool(own.get(n, 1)) for n in (3, 4, 5))
    return spec


def _merges(spec: Spec) -> list[tuple[str, str]]:
    """Pairs that make a piece, best score first."""
    ids = {piece: i for i, (piece, _, kind) in enumerate(spec.pieces) if kind not in (CONTROL, UNKNOWN, BYTE)}
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-spec.pieces[i][1], i, left, right, piece[:cut], piece[cut:]))
    return [(left, right) for *_, left, right in sorted(found)]


def separable(spec: Spec) -> bool:
    """Whether texts may be cut before each run of markers: no piece holds a marker behind another character."""
    plain = (CONTROL, UNKNOWN)
    return not any(k == USER_DEFINED or k not in plain and MARK in p.lstrip(MARK) for p, _, k in spec.pieces)


CUT = f"{MARK}*[^{MARK}]+|{MARK}+"


def build(model: bytes) -> Tokenizer:
    """A tokenizer that gives the ids of the SentencePiece model."""
    spec = parse(model)
    if spec.kind not in (UNIGRAM, BPE) or spec.suffix_marker or not spec.escape:
        raise ValueError("only unigram and BPE models with a leading marker are rebuilt")
    unknown = next(i for i, p in enumerate(spec.pieces) if p[2] == UNKNOWN)
    if spec.kind == BPE:
        vocabulary = {piece: i for i, (piece, _, _) in enumerate(spec.pieces)}
        core = models.BPE(
            vocabulary, _merges(spec), unk_token=spec.pieces[unknown][0], fuse_unk=True, byte_fallback=spec.byte_fallback
        )
    else:
        # control pieces never match text, so they get spellings that no text has
        names = [(f"\U0010ffff{p}" if kind in (CONTROL, UNKNOWN) else p, s) for p, s, kind in spec.pieces]
        core = models.Unigram(names, unk_id=unknown, byte_fallback=spec.byte_fallback)
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
    if spec.squeeze:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if spec.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if separable(spec):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(CUT), "isolated")
    user = [AddedToken(p, normalized=False, special=False) for p, _, kind in spec.pieces if kind == USER_DEFINED]
    if user:
        out.add_tokens(user)
    tail = [decoders.Strip(" ", 1, 0)] if spec.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return out


def pack(ids: list[int]) -> bytes:
    """Ids as 32-bit numbers: a small part of the memory of a list, and joined and compared as bytes."""
    return array("i", ids).tobytes()


class Encoder:
    """Encodes and decodes batches; a part of a text between cuts that came before isn't encoded again (``most`` are kept).

    Parity is held on whole texts: the ids joined from a text's parts against those that the SentencePiece library, with its own normaliser,
    gives for the text itself.  Ids are decoded by the rebuilt tokenizer's decoder.
    """

    def __init__(self, model: bytes, most: int = 120_000, run: int = 1000, threads: int = 1):
        self.reference, self.threads = SentencePieceProcessor(model_proto=model), threads
        self.tokenizer, spec = build(model), parse(model)
        self.most, self.run, self.known = most, run, {}
        self.heads = np.array([p.startswith(MARK) for p, _, _ in spec.pieces])
        self.parts = None
        if separable(spec):
            # the same model without the normaliser, not a second copy of its vocabulary
            self.parts = Tokenizer(self.tokenizer.model)
            self.parts.pre_tokenizer = self.tokenizer.pre_tokenizer
            self.cut = re.compile(CUT).findall
            self.normalise = self.tokenizer.normalizer.normalize_str

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Ids of each text, and whether they agree with the library's."""
        packed, ids, parity = self.encode_packed(texts)
        return [i if same else np.frombuffer(p, np.int32).tolist() for p, i, same in zip(packed, ids, parity, strict=True)], parity

    def encode_packed(self, texts: list[str]) -> tuple[list[bytes], list[list[int]], list[bool]]:
        """Ids of each text as bytes of 32-bit numbers, the library's own ids, and whether the two agree."""
        if self.parts is None:
            ids = [pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            cut = [self.cut(self.normalise(t)) for t in texts]
            if len(self.known) > self.most:
                self.known.clear()
            self._learn(set().union(*cut) - self.known.keys())
            ids = [b"".join(map(self.known.__getitem__, parts)) for parts in cut]
        theirs = self.reference.encode(texts, num_threads=self.threads)
        return ids, theirs, [a == pack(b) for a, b in zip(ids, theirs, strict=True)]

    def _learn(self, new: set[str]) -> None:
        """Encode parts: those with one marker, at the start, in runs whose ids tell where each part starts."""
        single = [w for w in new if w[0] == MARK and MARK not in w[1:] and len(w) > 1]
        runs = [single[i : i + self.run] for i in range(0, len(single), self.run)]
        for parts, found in zip(runs, self.parts.encode_batch_fast(["".join(r) for r in runs], add_special_tokens=False), strict=True):
            ids = found.ids
            starts = np.flatnonzero(self.heads[ids]).tolist()
            held = pack(ids)
            self.known.update(zip(parts, (held[4 * a : 4 * b] for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)), strict=True))
        other = list(new.difference(single))
        self.known.update(zip(other, (pack(e.ids) for e in self.parts.encode_batch_fast(other, add_special_tokens=False)), strict=True))

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def pieces(batches: Iterator[pa.Array], most: int) -> Iterator[pa.Array]:
    """The batches' texts in order, cut so that a piece holds about ``most`` bytes or one long text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(ends // most)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
            yield batch.slice(start, end - start)


def encode_batches(encoder: Encoder, batches: Iterator[pa.Array], most: int) -> Iterator[pa.Array]:
    """Structs of ids, decoded and parity, a piece at a time: what a piece needs is let go before the next one is read."""
    for piece in pieces(batches, most):
        texts = [t or "" for t in piece.to_pylist()]
        packed, ids, parity = encoder.encode_packed(texts)
        sizes = np.cumsum([0, *map(len, packed)], dtype=np.int64) // 4
        lists = pa.ListArray.from_arrays(sizes.astype(np.int32), np.frombuffer(b"".join(packed), np.int32))
        # what is decoded are the ids found here; where both agree, the library's list spares making another
        ours = [i if same else np.frombuffer(p, np.int32).tolist() for p, i, same in zip(packed, ids, parity, strict=True)]
        yield pa.StructArray.from_arrays(
            [lists, pa.array(encoder.decode(ours), pa.string()), pa.array(parity, pa.bool_())], ["ids", "decoded", "parity"]
        )


def encoded(model: bytes, text: str = "text", threads: int = 2, most: int = 500_000) -> Column:
    """A struct for a text column: ids, decoded (the text the ids give back), parity (SentencePiece gives the same ids)."""

    @F.arrow_udf("ids array<int>, decoded string, parity boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # as many threads as a task has cores; read before the library's pool starts
        os.environ |= {"TOKENIZERS_PARALLELISM": "true", "RAYON_NUM_THREADS": str(threads)}
        yield from encode_batches(Encoder(model, threads=threads), batches, most)

    return run(F.col(text))
