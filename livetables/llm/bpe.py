"""Byte-level BPE through a sentencepiece model made from a rank file.

The vocabulary's byte strings are written with one printable character per byte
(the usual byte alphabet), so each token is a sentencepiece piece; its score is
the negative rank, the normaliser does nothing. BPE by highest score then makes
the same merges as BPE by lowest rank. Texts are split by the vocabulary's
pattern and each pre-token is encoded separately; a pre-token that is itself a
token gets that id, as rank-based encoders do. Decoding maps ids to their bytes.

Plan. One narrow map over the rows, no shuffle: each worker builds the model once,
keeps a bounded cache of words, and handles one text at a time, so memory follows
the longest text. A lost executor repeats its tasks only.

Defined results: a null text counts as empty and has no ids; repeated rows are
encoded each; a null id passes through; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from livetables.llm.common import col, giving_back, ship_package, text_or_empty
from livetables.llm.pretokens import WordCache


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself where printable, else one from 256 on."""
    own = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from a file of base64 tokens and ranks; ranks count from 0 without gaps."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def serialise_model(tokens: Sequence[bytes]) -> bytes:
    """A sentencepiece BPE model: piece 0 is unknown, piece i + 1 the token of rank i."""
    alphabet = byte_alphabet()
    # Field numbers and enum values of sentencepiece's public model format.
    unknown, normal, bpe = 2, 1, 2
    out = [_message(1, _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, unknown))]
    for rank, token in enumerate(tokens):
        piece = "".join(alphabet[b] for b in token).encode()
        out.append(_message(1, _message(1, piece) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, normal)))
    out.append(_message(2, _number(3, bpe) + _number(4, len(tokens) + 1)))
    out.append(_message(3, _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)))
    return b"".join(out)


class Codec:
    """Encoder and decoder of one vocabulary, for one process."""

    def __init__(self, path: str, pattern: str):
        import numpy as np
        import regex
        import sentencepiece

        self.np, self.tokens = np, read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.alphabet = {i: c for i, c in enumerate(byte_alphabet())}
        self.whole = {"".join(self.alphabet[b] for b in t): i for i, t in enumerate(self.tokens)}
        self.cache = WordCache(self._encode_many)

    def _encode_many(self, texts: Sequence[str]) -> list[bytes]:
        split = [[p.encode().decode("latin-1").translate(self.alphabet) for p in self.split(t)] for t in texts]
        asked = [p for pieces in split for p in pieces if p not in self.whole]
        ids = iter(self.model.encode(asked, num_threads=1) if asked else ())
        out = []
        for pieces in split:
            own: list[int] = []
            for p in pieces:
                if p in self.whole:
                    own.append(self.whole[p])
                else:
                    own.extend([i - 1 for i in next(ids)])
            out.append(struct.pack(f"<{len(own)}I", *own))
        return out

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        return self.cache.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, self.np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _rows(batches: Iterator[pa.RecordBatch], step: int = 64) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part.column(0), part.column(1).to_pylist()


def encode_rows(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids (array of int) of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for ids, texts in _rows(batches):
            packed = [own.np.frombuffer(p, dtype="<i4") for p in own.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(p) for p in packed], pa.int64()), pa.array(packed, pa.list_(pa.int32()))],
                names=[id_col, "n_tokens", "ids"])
    ship_package(df.sparkSession)
    rows = df.select(col(id_col), text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(run, StructType([
        StructField(id_col, rows.schema[0].dataType), StructField("n_tokens", LongType()),
        StructField("ids", ArrayType(IntegerType()))]))


def decode_rows(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, decoded (the bytes that the ids stand for; null ids give no bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for ids, lists in _rows(batches):
            raw = [own.decode(own.np.array(x or (), dtype="<u4").tobytes()) for x in lists]
            yield pa.RecordBatch.from_arrays([ids, pa.array(raw, pa.binary())], names=[id_col, "decoded"])
    ship_package(df.sparkSession)
    rows = df.select(col(id_col), col(ids_col))
    return rows.mapInArrow(run, StructType([
        StructField(id_col, rows.schema[0].dataType), StructField("decoded", BinaryType())]))


def round_trip(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 (and ids): each text encoded and its ids decoded, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for ids, texts in _rows(batches):
            packed = own.encode(texts)
            columns = {id_col: ids, "n_tokens": pa.array([len(p) // 4 for p in packed], pa.int64()),
                       "ids_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                       "decoded_sha256": pa.array([hashlib.sha256(own.decode(p)).hexdigest() for p in packed], pa.string())}
            if with_ids:
                columns["ids"] = pa.array([own.np.frombuffer(p, dtype="<i4") for p in packed], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
    ship_package(df.sparkSession)
    rows = df.select(col(id_col), text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(lambda batches: giving_back(run(batches)), StructType([
        StructField(id_col, rows.schema[0].dataType), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
        *[StructField("ids", ArrayType(IntegerType()))] * with_ids]))
