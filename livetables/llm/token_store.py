"""Token ids stored as zstandard-compressed byte or bit planes, with a chunk index.

Format. A store is a table of chunks. A chunk holds the ids of consecutive whole
documents (about `chunk_ids` ids; a longer document is a chunk of its own) and is
cut into blocks of `block_ids` ids. Each block is transposed: plane j has the
j-th byte (or bit) of every id, and each plane is compressed by itself. The index
of a chunk is in its other columns: shard, chunk number, ids before it in the
shard, and its documents' ids and lengths. The table's container is Parquet
(uncompressed: the planes already are), written by Spark, so a lost executor
leaves no half chunk and any store that Spark can write to will do.

Plan. Documents are range-partitioned and sorted by id (one shuffle of the
texts); each task encodes its documents and writes a shard. The ids before a
shard come from the shards' totals (one small row each). Reading back is a
narrow map over chunks: no document crosses a chunk.

Defined results: a null text counts as empty and stores only the end id; null
document ids come first; rows that repeat an id are stored each, ordered by
text; an empty table gives an empty store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from livetables.llm.common import col, ship_package, text_or_empty
from livetables.llm.pretokens import WordCache

STORE = ("shard int, chunk int, start long, n_ids long, doc_ids array<long>, lengths array<long>, "
         "unit string, block_ids int, blocks array<int>, planes array<binary>")
_UNITS = {"byte": 4, "bit": 32}


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """The planes of a block: by byte or by bit, lowest first; planes past the last with a bit set are left out."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        raw = np.unpackbits(raw, axis=1, bitorder="little")
    used = max((j + 1 for j in range(raw.shape[1]) if raw[:, j].any()), default=0)
    pack = (lambda x: np.packbits(x).tobytes()) if unit == "bit" else (lambda x: x.tobytes())
    return [pack(np.ascontiguousarray(raw[:, j])) for j in range(used)]


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    raw = np.zeros((n, _UNITS[unit]), np.uint8)
    for j, plane in enumerate(planes):
        own = np.frombuffer(plane, np.uint8)
        raw[:, j] = np.unpackbits(own, count=n) if unit == "bit" else own
    if unit == "bit":
        raw = np.packbits(raw, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordCache:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)

    def encode_many(texts):
        made = model.encode_batch_fast(list(texts), add_special_tokens=False)
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in made]

    # the first token of a word after a space, and no other, begins with the space
    known = model.get_vocab()
    spaced = np.zeros(max(known.values(), default=0) + 1, bool)
    spaced[[i for token, i in known.items() if token.startswith("\u0120")]] = True
    line_break = known.get("\u010a", -1)

    def encode_words(words):
        # words of letters, each after a space, are one pre-token each: one text for all of them
        made = np.array(model.encode_batch_fast(["".join([" " + w for w in words])], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(spaced[made])
        if len(starts) != len(words) or starts[0]:
            return encode_many([" " + w for w in words])
        packed, ends = made.tobytes(), [*(starts * 4).tolist(), 4 * len(made)]
        return [packed[a:b] for a, b in zip(ends, ends[1:])]

    def encode_lines(words):
        # a line break before each is a token of its own
        made = np.array(model.encode_batch_fast(["".join(["\n" + w for w in words])], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(made == line_break) if line_break >= 0 else made[:0]
        if len(starts) != len(words) or starts[0]:
            return encode_many(words)
        packed, ends = made.tobytes(), [*(starts * 4).tolist(), 4 * len(made)]
        return [packed[a + 4:b] for a, b in zip(ends, ends[1:])]
    return WordCache(encode_many, encode_words, encode_lines=encode_lines)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 1 << 21) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of consecutive rows, many at a time, as long as they are not large."""
    docs, texts, held = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            docs += part.column(0).to_pylist()
            texts += part.column(1).to_pylist()
            held += part.nbytes
            if len(docs) >= rows or held >= size:
                yield docs, texts
                docs, texts, held = [], [], 0
    if docs:
        yield docs, texts


def write_store(df: DataFrame, out: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = 2, unit: str = "byte", block_ids: int = 16_384, chunk_ids: int = 131_072,
                level: int = 3) -> None:
    """Encode every text, append `end_id`, and write the ids in ascending order of the document ids to `out`."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, squeeze = _encoder(tokenizer), TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=level)
        chunk, start, waiting, held, docs, lengths = 0, 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal chunk, start
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            blocks, planes = [], []
            for at in range(0, len(ids), block_ids):
                own = to_planes(ids[at:at + block_ids], unit)
                blocks.append(len(own))
                planes += [squeeze.compress(p) for p in own]
            row = {"shard": [shard], "chunk": [chunk], "start": [start], "n_ids": [len(ids)], "doc_ids": [list(docs)],
                   "lengths": [list(lengths)], "unit": [unit], "block_ids": [block_ids], "blocks": [blocks], "planes": [planes]}
            chunk, start = chunk + 1, start + len(ids)
            for x in (held, docs, lengths):
                x.clear()
            return pa.RecordBatch.from_pydict(row, schema=_ARROW)
        for some, texts in _parts(batches):
            for doc, ids in zip(some, words.encode(texts)):
                ids += end
                if held and waiting + len(ids) // 4 > chunk_ids:
                    yield flush()
                    waiting = 0
                waiting += len(ids) // 4
                held.append(ids)
                docs.append(doc)
                lengths.append(len(ids) // 4)
        if held:
            yield flush()
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    (rows.repartitionByRange("id").sortWithinPartitions("id", "t").mapInArrow(run, STORE)
     .write.option("compression", "uncompressed").parquet(out))


_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("unit", pa.string()), ("block_ids", pa.int32()),
                    ("blocks", pa.list_(pa.int32())), ("planes", pa.list_(pa.binary()))])


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The store's chunks, with `base`: the ids in all shards before theirs."""
    chunks = spark.read.schema(STORE).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = (chunks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
              .select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    return chunks.join(F.broadcast(totals), "shard")        # a row for each task that wrote a shard


def chunk_ids_of(n_ids: int, block_ids: int, unit: str, blocks: list[int], planes: list[bytes]) -> np.ndarray:
    """The ids of one chunk."""
    grow, at, out = zstandard.ZstdDecompressor(), 0, []
    for i, used in enumerate(blocks):
        n = min(block_ids, n_ids - i * block_ids)
        out.append(from_planes([grow.decompress(p) for p in planes[at:at + used]], n, unit))
        at += used
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def read_store(spark: SparkSession, path: str, *, id_col: str = "doc_id",
               digests: bool = False) -> DataFrame:
    """id, start, n_tokens and ids (or, with `digests`, ids_crc32) of every stored document."""
    name, kind = ("ids_crc32", "long") if digests else ("ids", "array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = chunk_ids_of(row["n_ids"], row["block_ids"], row["unit"], row["blocks"], row["planes"])
                ends = np.cumsum(row["lengths"])
                own = [ids[e - n:e] for e, n in zip(ends.tolist(), row["lengths"])]
                made = [zlib.crc32(x.tobytes()) for x in own] if digests else [x.astype("i8") for x in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(ends - row["lengths"] + row["base"] + row["start"], pa.int64()),
                     pa.array(row["lengths"], pa.int64()), pa.array(made, pa.int64() if digests else pa.list_(pa.int64()))],
                    names=[id_col, "start", "n_tokens", name])
    ship_package(spark)
    return open_store(spark, path).mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, {name} {kind}")
