"""SimHash near duplicates: keys from the Golay code, pigeonholed segments, links verified, components.

Fingerprint. Texts are lower-cased (A-Z), cut into words at white space and hashed
as shingles of `words` words (XXH64, repeats included). A bit of the 64-bit
fingerprint is set if it is set in over half of the hashes.

Keys. Two fingerprints link if at most 3 of their bits differ. The 64 bits are
cut into segments of 22, 21 and 21 bits, words of the binary Golay code [23, 12].
The code is perfect: every word is within 3 bits of exactly one of 4,096
codewords. A word's keys are the codewords to which it or a word one bit away
decodes: 1 if it is within 2 bits of its codeword, else 6. So if two words differ
in at most one bit, the codeword of each is among the keys of the other. By the
pigeonhole principle, of 3 errors in three segments either
(a) one segment has none and another at most one: a key is that whole segment and
a codeword of the other (6 ordered pairs of segments), or
(b) every segment has one: then one half of the second and one half of the third
segment are without error, and a key is these halves and a codeword of the first
segment (4 choices of halves).
That is 10 to 60 keys of 33 or 34 bits for a fingerprint; any two that link meet in
the bucket of a key at which one of them stands with its own codeword.

Links. Equal fingerprints are one node. No list of all pairs of a bucket is
made: in a few rounds its members are compared with one hub, first the smallest,
then one from a class that is not yet joined; what links is merged, and buckets
whose members are all of one class are settled. In what is left, members of
different classes are compared with each other where one has its own codeword.
Every link that could join two components has thus been tested, and components
are exact. Every comparison counts the differing bits.

Plan. One narrow pass over the texts; a fingerprint and its document's id are 16
bytes. Keys are made twice from the nodes rather than kept; only rows in
buckets with at least two nodes are shuffled a second time. Hubs are minima and maxima, so a
hot bucket is folded in each task. Classes and links stay distributed, and each step is written to the shared folder.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and links like any other; a shorter text is one shingle; rows
without an id have a fingerprint and the component of their fingerprint, but give it
no name; a component of rows without ids is null; rows that repeat an id are each
returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livetables.llm.byte_words import Words, byte_table, words_of, xxh64
from livetables.llm.common import col, likely, ship_package, text_or_empty, written
from livetables.llm.components import components

_SPACE = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Differing bits of a link; the keys below are made for this number.
MAX_BITS = 3
# Fixed value: the generator polynomial of the binary Golay code.
_GENERATOR = 0xAE3
_SEGMENTS = ((0, 22), (22, 21), (43, 21))
_STEP = 1 << 17                          # shingles hashed at a time


def _fingerprints(words: Words, n: int, seed: int) -> np.ndarray:
    """One fingerprint per text."""
    count = np.diff(words.first)
    made = np.where(count == 0, 0, np.maximum(1, count - n + 1))          # shingles of each text
    first = np.append(0, np.cumsum(made))
    ones = np.zeros((len(count), 64), np.int64)
    for a in range(0, int(first[-1]), _STEP):
        shingle = np.arange(a, min(a + _STEP, int(first[-1])))
        text = np.searchsorted(first, shingle, side="right") - 1
        at = words.first[text] + shingle - first[text]
        h = xxh64(words.data, words.begin[at], words.end[at + np.minimum(n, count[text]) - 1], seed)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, start = np.unique(text, return_index=True)
        ones[own] += np.add.reduceat(bits, start, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > made[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """id, fp (64 bits as a long) per row."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                part = batch.slice(at, 32)
                made = _fingerprints(words_of(part.column(1), _SPACE), words, seed)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made.view(np.int64))], names=["id", "fp"])
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words divided by the generator."""
    out = words.astype(np.int64)
    for bit in range(22, 10, -1):
        out = np.where(out >> bit & 1, out ^ (_GENERATOR << (bit - 11)), out)
    return out


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """By remainder: the error (at most 3 bits), and what to XOR to the codeword's index for the word's keys."""
    bits = 1 << np.arange(23)
    errors = [0, *bits.tolist(), *(int(a | b) for i, a in enumerate(bits) for b in bits[i + 1:]),
              *(int(a | b | c) for i, a in enumerate(bits) for j, b in enumerate(bits[i + 1:], i + 1) for c in bits[j + 1:])]
    error = np.zeros(2048, np.int64)
    error[_remainders(np.array(errors))] = errors
    index = np.arange(4096)
    code = index << 11 ^ _remainders(index << 11)
    seven = code[np.bitwise_count(code) == 7]
    keys = np.zeros((2048, 6), np.int64)
    for remainder in np.flatnonzero(np.bitwise_count(error) == 3):
        # the codewords 4 bits away from a word that is 3 bits away from its own
        keys[remainder, 1:] = seven[seven & error[remainder] == error[remainder]] >> 11
    return error, keys


def fuzzy(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[word, 6] indices of near codewords, its own first, and which of them count (1 or all 6)."""
    error, others = _golay()
    remainder = _remainders(words)
    index = (words.astype(np.int64) ^ error[remainder]) >> 11
    keys = index[:, None] ^ others[remainder]
    there = np.ones(keys.shape, bool)
    there[:, 1:] = others[remainder][:, 1:] != 0
    return keys, there


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the fingerprint, key, whether by its own codeword) of unsigned fingerprints."""
    part = [(fp >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in _SEGMENTS]
    near = [fuzzy(p) for p in part]
    families = [(part[i], *near[j]) for i in range(3) for j in range(3) if i != j]
    halves = [(p & 0x3FF, p >> 10) for p in part[1:]]
    families += [(a << 11 | b, *near[0]) for a in halves[0] for b in halves[1]]
    line, key, own = [], [], []
    for number, (exact, indices, there) in enumerate(families):
        at, which = np.nonzero(there)
        line.append(at)
        key.append(number << 40 | exact[at] << 12 | indices[at, which])
        own.append(which == 0)
    return np.concatenate(line), np.concatenate(key), np.concatenate(own)


def _keyed(nodes: DataFrame) -> DataFrame:
    """key, fp, own per key of each node (a frame of fp)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                fp = batch.slice(at, 1024).column(0)
                line, key, own = keys_of(fp.to_numpy(zero_copy_only=False).view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), fp.take(pa.array(line)), pa.array(own)], names=["key", "fp", "own"])
    return nodes.select("fp").mapInArrow(run, "key long, fp long, own boolean")


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(fp, root) with the classes that links (of roots) connect made one."""
    new = components(links)
    return (classes.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
            .select("fp", F.coalesce("to", "root").alias("root")))


def linked(nodes: DataFrame, *, star_rounds: int = 3) -> DataFrame:
    """Distinct fingerprints (fp) -> (fp, root) of those in a component of several."""
    spread = _keyed(nodes)
    crowds = written(spread.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
                     .where("low <> high").select("key"), "simhash-crowds")
    members = written(likely(spread, "key", crowds).join(crowds, "key"), "simhash-buckets")
    classes = written(members.select("fp").distinct().select("fp", F.col("fp").alias("root")), "simhash-classes")
    for number in range(star_rounds + 1):
        placed = members.join(classes, "fp")
        # the hub: the smallest class's smallest member, then a member of the largest class
        first, last = F.struct("root", "fp"), F.struct("root", "fp")
        hubs = (placed.groupBy("key").agg(F.min(first).alias("low"), F.max(last).alias("high")).where("low.root <> high.root"))
        hub = F.col("low") if number % 2 == 0 else F.col("high")
        hubs = hubs.select("key", hub["fp"].alias("a"), hub["root"].alias("a_root"))
        open_ = written(placed.join(hubs, "key"), "simhash-open")
        if open_.isEmpty():
            break
        members = open_.select("key", "fp", "own")
        if number == star_rounds:
            mine = open_.where("own").select("key", F.col("fp").alias("a"), F.col("root").alias("a_root"))
            open_ = open_.select("key", "fp", "root").join(mine, "key")
        found = open_.where((F.col("root") != F.col("a_root")) & _near("fp", "a"))
        links = written(found.select(F.col("root").alias("a"), F.col("a_root").alias("b")).distinct(), "simhash-links")
        if not links.isEmpty():
            classes = written(_merged(classes, links), "simhash-classes")
    return classes


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42,
                    star_rounds: int = 3) -> DataFrame:
    """One row per row of `df`: id, fingerprint (16 hex digits), component_id (smallest id of its component)."""
    made = written(fingerprints(df, id_col=id_col, text_col=text_col, words=words, seed=seed), "simhash-fingerprints")
    nodes = written(made.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    classes = linked(nodes, star_rounds=star_rounds)
    rooted = nodes.join(classes, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return made.join(named, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
