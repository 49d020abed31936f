"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed as a protobuf message; its normaliser, space marker,
pieces with scores and byte fallback are rebuilt as a tokenizers pipeline.
Unigram models keep their scores; BPE models get their merges from them: every
split of a piece into two pieces is a merge, ranked by the score of the piece.
Where no piece continues over a space marker, text is cut before each run of
markers, which leaves all merges as they are and bounds their length.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from marketlake.llm.common import shipped, whole_text

shipped(__name__)

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # piece types of the model format
UNIGRAM, BPE = 1, 2  # model types
BATCH_CHARS = 200_000  # characters encoded at a time
THREADS = 2  # threads of the library in a Python worker; more mostly wait for each other and hold memory each


@dataclass
class Model:
    """What is read from a model file."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint():
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
        size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
        yield key >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> Model:
    """Read the fields used here: pieces (1), trainer settings (2), normaliser settings (3)."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            parts = dict(_fields(value))
            score = struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0
            model.pieces.append((parts[1].decode(), score, parts.get(3, NORMAL)))
        elif number == 2:
            parts = dict(_fields(value))
            model.kind, model.byte_fallback = parts.get(3, UNIGRAM), bool(parts.get(35, 0))
        elif number == 3:
            parts = dict(_fields(value))
            model.charsmap = parts.get(2, b"")
            model.dummy_prefix = bool(parts.get(3, 1))
            model.remove_extra_spaces = bool(parts.get(4, 1))
            model.escape_spaces = bool(parts.get(5, 1))
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    ranked = []
    for piece, i in ids.items():
        splits = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
        found = [(a, b) for a, b in splits if a in ids and b in ids]
        ranked += [(-model.pieces[i][1], ids[a], ids[b], a, b) for a, b in found]
    return [(a, b) for *_, a, b in sorted(ranked)]


def build_tokenizer(model: Model):
    """A tokenizers pipeline with the ids of the model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.kind == UNIGRAM:
        vocabulary = [(p, s) for p, s, _ in model.pieces]
        core = models.Unigram(vocabulary, unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)},
            _merges(model),
            unk_token=model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    if not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind in (NORMAL, USER)):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    out.decoder = decoders.Sequence(back + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    return out


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Consecutive texts of together at most ``BATCH_CHARS`` characters; a longer text stands alone."""
    start = 0
    while start < len(texts):
        end, chars = start, 0
        while end < len(texts) and (end == start or chars + len(texts[end]) <= BATCH_CHARS):
            chars += len(texts[end])
            end += 1
        yield texts[start:end]
        start = end


def encode_texts(tokenizer, texts: list[str]) -> list[list[int]]:
    """Ids of each text: many texts at a time, on the library's own threads."""
    return [
        e.ids for some in slices(texts) for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)
    ]


def decode_ids(tokenizer, ids: list[list[int]]) -> list[str]:
    return tokenizer.decode_batch(ids, skip_special_tokens=True)


def piece_bytes(model: Model) -> list[bytes]:
    """What each id decodes to: a byte piece its byte, another piece its text with spaces for markers."""
    return [
        bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in model.pieces
    ]


def decode_joined(tokenizer, table: list[bytes], prefixed: bool, ids: list[list[int]]) -> list[str]:
    """As ``decode_ids``, by joining bytes; the library decodes where they are not UTF-8 (broken runs of byte pieces)."""
    out = []
    for some in ids:
        try:
            text = b"".join(map(table.__getitem__, some)).decode()
            out.append(text[1:] if prefixed and text[:1] == " " else text)
        except UnicodeDecodeError:
            out += decode_ids(tokenizer, [some])
    return out


def disagreements(data: bytes, texts: list[str]) -> list[int]:
    """Parity check: places of the texts whose ids differ from the original library's."""
    import sentencepiece

    original = sentencepiece.SentencePieceProcessor(model_proto=data)
    theirs = original.encode(texts, num_threads=1)
    return [i for i, (a, b) in enumerate(zip(encode_texts(build_tokenizer(parse_model(data)), texts), theirs, strict=True)) if a != b]


def add_pieces(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """Add ``piece_ids`` (array<int>) and ``decoded`` (the text the ids decode to).

    ``model_file`` is read once on the driver (a vocabulary file, megabytes); the
    rebuilt pipeline is broadcast.  A null or empty text has no ids and decodes to
    an empty text.  Control pieces written in a text are ordinary text.  Columns
    of the new names are replaced; rows are independent of each other.
    """
    with open(model_file, "rb") as f:
        model = parse_model(f.read())
    built = build_tokenizer(model).to_str(), piece_bytes(model), model.dummy_prefix
    shared = docs.sparkSession.sparkContext.broadcast(built)

    kind = pa.struct({"ids": pa.list_(pa.int32()), "decoded": pa.string()})
    threads = str(THREADS)

    @arrow_udf("struct<ids: array<int>, decoded: string>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        os.environ["RAYON_NUM_THREADS"] = threads  # read when the library starts its threads
        from tokenizers import Tokenizer

        built, *back = shared.value
        tokenizer = Tokenizer.from_str(built)
        for text in batches:
            parts = [encoded(tokenizer, back, some) for some in slices([t or "" for t in text.to_pylist()])]
            yield pa.concat_arrays(parts) if parts else pa.array([], kind)

    def encoded(tokenizer, back: list, texts: list[str]) -> pa.Array:
        """One slice; the lists of its ids are let go with it."""
        ids = encode_texts(tokenizer, texts)
        decoded = pa.array(decode_joined(tokenizer, *back, ids), pa.string())
        return pa.StructArray.from_arrays([pa.array(ids, pa.list_(pa.int32())), decoded], fields=list(kind))

    plain = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("piece_ids", "decoded")))
    return (
        plain.withColumn("_pieces", pieces(whole_text(text_col)))
        .withColumns({"piece_ids": F.col("_pieces.ids"), "decoded": F.col("_pieces.decoded")})
        .drop("_pieces")
    )
