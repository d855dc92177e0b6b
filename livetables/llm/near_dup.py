"""Near duplicates: consistent weighted sampling over TF-IDF word shingles, banded, verified exactly.

Weights. A shingle is `words` consecutive words (lower-cased runs of word
characters; shorter texts are one shingle). Its weight in a text is
(1 + ln tf) * idf. The idf is damped: 1 for shingles in less than the share
`common` of all documents, falling with the logarithm of the share to `floor`
for one that every document has. Undamped, a group of copies that holds much of
the corpus would take the weight from its own shared shingles and fall apart.
Which shingles are common is counted over all documents: a table of hashed
counts finds the buckets that can hold one, then those are counted exactly.

Candidates. Improved consistent weighted sampling draws bands * rows samples of
a text's weighted shingles; two texts agree on a sample with the probability of
their weighted Jaccard similarity. Texts that agree on a whole band meet in its
bucket. Texts with the same words are one node from the start.

Links. Within a bucket no list of all pairs is made. Every bucket picks a hub
(its smallest id) and the others are compared with it; what is linked is merged
into classes. For the members of buckets that still hold several classes
the weight of the shingles that no other of them has is counted: a text with much
of its own can't reach the threshold with any, as its shared weight bounds every
intersection. After another round, with the text that has the least of its own as
the hub (the original of a group of copies rather than a copy), the members of a bucket that are still
of different classes are compared with each other where their shared and total
weights allow the threshold. So no link between candidates of different classes
is left untested. Pairs are verified by the exact weighted Jaccard similarity of
the whole texts.

Plan. Texts are read in narrow passes (counting, signatures); signatures are
16-byte text keys and one number per band. Only texts that share a bucket with
another are shuffled: a bit table of fixed size keeps the others out. Joins on hubs and buckets aggregate by minimum or maximum,
so AQE can split a hot one. Classes and links stay distributed, and each step is
written to the shared folder.

Defined results: a null text counts as empty; texts without words are copies of
each other but link to nothing else; rows without an id get no class; rows that
repeat an id belong to one class; the class id is its smallest id; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livetables.llm.common import col, likely, ship_package, text_or_empty, written
from livetables.llm.components import components

_WORD = re.compile(r"\w+")
_SLOTS = 1 << 15                      # rows of the table of random numbers
_BUCKET_BITS = 18                     # of the table of hashed counts


@dataclass(frozen=True)
class Params:
    words: int = 5
    threshold: float = 0.8
    bands: int = 12
    rows: int = 4
    common: float = 0.01
    floor: float = 0.8
    seed: int = 20


class _WordHashes(dict):
    """64-bit hashes of words, with a bounded memory."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: Sequence[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (ascending) and how often each occurs."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for j in range(width):
        total = (total ^ h[j:len(h) - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return np.unique(total, return_counts=True)


@dataclass
class Weights:
    """Idf of the common shingles (ascending hashes); all others have 1. At most shingles-per-text / common entries."""

    hashes: np.ndarray
    idf: np.ndarray

    def of(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = 1 + np.log(counts)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            w = np.where(self.hashes[at] == found, w * self.idf[at], w)
        return w


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (hashes ascending, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    shared = np.minimum(a[1], b[1][at])[b[0][at] == a[0]].sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


@lru_cache(maxsize=1)
def _draws(samples: int, seed: int) -> tuple[np.ndarray, ...]:
    """r, ln c and beta of consistent weighted sampling, a row per slot of shingle hashes; ln a for weight 1."""
    rng = np.random.default_rng(seed)
    r = rng.gamma(2.0, 1.0, (_SLOTS, samples)).astype("f4")
    ln_c = np.log(rng.gamma(2.0, 1.0, (_SLOTS, samples))).astype("f4")
    beta = rng.random((_SLOTS, samples)).astype("f4")
    beta[beta >= 1] = 0                                       # rounding to 32 bits may reach 1
    return r, ln_c, beta, ln_c - r * (1 - beta)


def sample(hashes: np.ndarray, weights: np.ndarray, samples: int, seed: int) -> np.ndarray:
    """The sampled (shingle, level) of each draw, as one 64-bit hash."""
    r, ln_c, beta, ln_a_of_1 = _draws(samples, seed)
    best = np.full(samples, np.inf, "f4")
    key, level = np.zeros(samples, np.uint64), np.zeros(samples, "f4")
    each = np.arange(samples)
    for at in range(0, len(hashes), 4096):                    # bounded memory for the longest texts
        own, weight = hashes[at:at + 4096], weights[at:at + 4096]
        slot = (own & np.uint64(_SLOTS - 1)).astype(np.int64)
        ln_a = ln_a_of_1[slot]                                # weight 1, most shingles: level 0
        t = np.zeros((1, samples), "f4")
        other = np.flatnonzero(weight != 1)
        if len(other):
            s = slot[other]
            t = np.zeros((len(own), samples), "f4")
            t[other] = np.floor(np.log(weight[other]).astype("f4")[:, None] / r[s] + beta[s])
            ln_a[other] = ln_c[s] - r[s] * (t[other] - beta[s] + 1)
        least = ln_a.argmin(axis=0)
        value = ln_a[least, each]
        better = value < best
        best[better] = value[better]
        key[better] = own[least[better]]
        level[better] = t[least if len(t) > 1 else 0, each][better]
    mixed = (key ^ level.astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(31))


def _texts(batches: Iterator[pa.RecordBatch], step: int = 64) -> Iterator[tuple[pa.RecordBatch, Iterator[list[str]]]]:
    """A few rows and the words of their last column, one text's at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, (words_of(t) for t in part.column(part.num_columns - 1).to_pylist())


def common_shingles(texts: DataFrame, p: Params) -> Weights:
    """Count the shingles that at least the share `common` of the documents with words have; texts has column t."""
    shift = np.uint64(64 - _BUCKET_BITS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total, held = np.zeros(1 << _BUCKET_BITS, np.int64), 0, []
        for _, rows in _texts(batches):
            for words in rows:
                found = shingles(words, p.words)[0]
                total += len(found) > 0
                held.append((found >> shift).astype(np.int64))
            # two shingles of a text in a bucket count twice: an upper bound, which is all that is asked
            counts += np.bincount(np.concatenate(held), minlength=len(counts))
            held.clear()
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some], pa.int32()), pa.array(np.r_[total, counts[some]], pa.int64())],
                                         names=["bucket", "n"])
    # at most a row for each bucket of the table, whatever the input
    told = texts.mapInArrow(hashed, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((1 << _BUCKET_BITS) + 1, np.int64)
    counts[told["bucket"].to_numpy()] = told["n"].to_numpy()        # the number of documents comes last, as -1
    total = int(counts[-1])
    least = max(2.0, p.common * total)
    mask = counts[:-1] >= least
    if not mask.any():
        return Weights(np.zeros(0, np.uint64), np.zeros(0))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.view("i8"), pa.int64()), pa.array(n, pa.int64())], names=["h", "n"])
        for _, rows in _texts(batches):
            for words in rows:
                found = shingles(words, p.words)[0]
                held.append(found[mask[(found >> shift).astype(np.int64)]])
            if sum(map(len, held)) > 1_000_000:
                yield flush()
        yield flush()
    counted = (texts.mapInArrow(exact, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
    rows = sorted((r["h"] & 0xFFFFFFFFFFFFFFFF, r["n"]) for r in counted.collect())
    share = np.array([n / total for _, n in rows])
    fall = np.clip(np.log(share / p.common) / math.log(1 / p.common), 0, 1) if len(share) else share
    return Weights(np.array([h for h, _ in rows], np.uint64), 1 - (1 - p.floor) * fall)


def signatures(rows: DataFrame, weights: Weights, p: Params) -> DataFrame:
    """id, t -> id, key (of the words), total (weight), bands (empty for a text without words)."""
    samples = p.bands * p.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches):
            keys, totals, bands = [], [], []
            for words in texts:
                keys.append(hashlib.md5(" ".join(words).encode()).digest())
                found, counts = shingles(words, p.words)
                w = weights.of(found, counts)
                totals.append(float(w.sum()))
                if not len(found):
                    bands.append([])
                    continue
                drawn = sample(found, w, samples, p.seed).reshape(p.bands, p.rows)
                bands.append([xxhash.xxh64_intdigest(b.tobytes()) - (1 << 63) for b in drawn])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary()), pa.array(totals, pa.float64()),
                                              pa.array(bands, pa.list_(pa.int64()))], names=["id", "key", "total", "bands"])
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, key binary, total double, bands array<long>")


class _Shingled:
    """Weighted shingles of texts, with a bounded memory: the pairs of a group have the same few texts many times."""

    def __init__(self, weights: Weights, words: int, most: int = 1_000_000):
        self.weights, self.words, self.most = weights, words, most
        self.known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.held = 0

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        made = self.known.get(text)
        if made is None:
            found, counts = shingles(words_of(text), self.words)
            made = found, self.weights.of(found, counts)
            if self.held > self.most:
                self.known.clear()
                self.held = 0
            self.known[text] = made
            self.held += len(found) + 64
        return made


def verified(pairs: DataFrame, texts: DataFrame, weights: Weights, p: Params) -> DataFrame:
    """The pairs (a, b, perhaps more columns) of ids whose texts reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Shingled(weights, p.words)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                keep = [similarity(known.of(a), known.of(b)) >= p.threshold for a, b in zip(*(c.to_pylist() for c in part.columns[-2:]))]
                yield part.select(part.schema.names[:-2]).filter(pa.array(keep, pa.bool_()))
    of_b = pairs.join(likely(texts, "id", pairs.select("b")).select(F.col("id").alias("b"), F.col("t").alias("b_text")), "b")
    both = of_b.join(likely(texts, "id", pairs.select("a")).select(F.col("id").alias("a"), F.col("t").alias("a_text")), "a")
    return both.select(*pairs.columns, "a_text", "b_text").mapInArrow(run, pairs.schema)


def own_weight(nodes: DataFrame, texts: DataFrame, weights: Weights, p: Params) -> DataFrame:
    """node, own: the weight of its shingles that no other of the nodes has (nodes without any are left out)."""
    kind = nodes.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _texts(batches):
            made = [shingles(words, p.words) for words in rows]
            size = [len(found) for found, _ in made]
            if sum(size):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(len(size)), size))),
                     pa.array(np.concatenate([f for f, _ in made]).view("i8"), pa.int64()),
                     pa.array(np.concatenate([weights.of(f, c) for f, c in made]), pa.float64())], names=["node", "h", "w"])
    some = _of(texts, nodes.select("node")).select(F.col("id").alias("node"), "t")
    return (some.mapInArrow(run, f"node {kind}, h long, w double").groupBy("h")
            .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("w").alias("w"))
            .where("n = 1").groupBy("node").agg(F.sum("w").alias("own")))


def _of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids (a frame of one column, perhaps repeated)."""
    # an inner join: a semi join would be pushed below the bit table, where it shuffles every text
    return likely(texts, "id", ids).join(ids.select(F.col(ids.columns[0]).alias("id")).distinct(), "id")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) with the classes that links (of roots) connect made one."""
    new = components(links)
    return (classes.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
            .select("node", F.coalesce("to", "root").alias("root")))


def classes_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params(), *, star_rounds: int = 2) -> DataFrame:
    """One row per row of `df`: id, class_id (smallest id of its class; null without an id), kept."""
    ship_package(df.sparkSession)
    rows = df.select(col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    weights = common_shingles(rows.select("t"), p)
    signed = written(signatures(rows, weights, p), "near-signatures")
    # texts with the same words are one node, named by the smallest id
    same = signed.where("id is not null").groupBy("key").agg(F.min("id").alias("node"), F.first("total").alias("total"),
                                                             F.first("bands").alias("bands"))
    nodes = written(same, "near-nodes")
    spread = nodes.select("node", "total", F.posexplode("bands").alias("band", "hash"))
    crowds = spread.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = spread.join(crowds, ["band", "hash"])
    members = written(members.drop("n").withColumn("own", F.lit(0.0)), "near-buckets")
    texts = written(_of(rows, members.select("node")), "near-texts")
    classes = members.select("node", F.col("node").alias("root")).distinct()
    tested = None
    for choice in range(star_rounds + 1):
        if choice:
            placed = members.join(classes, "node")
            mixed = (placed.groupBy("band", "hash").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                     .where("low <> high").select("band", "hash"))
            open_ = written(placed.join(mixed, ["band", "hash"]), "near-open")
        else:
            open_ = members.withColumn("root", F.col("node"))     # at first each is a class of its own
        if open_.isEmpty():
            break
        if choice:
            # what a text shares with any other bounds its intersections: texts with too much of their own are out
            own = own_weight(open_.select("node"), texts, weights, p)
            open_ = written(open_.drop("own").join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
                            .where(F.col("total") - F.col("own") >= p.threshold * F.col("total") * (1 - 1e-9)), "near-shared")
            members = open_.drop("root")
        shared = F.least(F.col("total") - F.col("own"), F.col("a_total") - F.col("a_own"))
        allowed = shared * (1 + 1e-9) >= p.threshold / (1 + p.threshold) * (F.col("total") + F.col("a_total"))
        if choice < star_rounds:
            # the less a text has of its own, the likelier others were made from it
            best = F.min(F.struct((F.col("own") / F.col("total")).alias("odd"), "node", "root", "total", "own"))
            hubs = open_.groupBy("band", "hash").agg(best.alias("hub")).select(
                "band", "hash", F.col("hub.node").alias("a"), F.col("hub.root").alias("a_root"),
                F.col("hub.total").alias("a_total"), F.col("hub.own").alias("a_own"))
        else:
            # with all bands at hand a pair is made in the first bucket that its texts share, not in each
            open_ = open_.join(nodes.select("node", "bands"), "node")
            hubs = open_.select("band", "hash", F.col("node").alias("a"), F.col("root").alias("a_root"),
                                F.col("total").alias("a_total"), F.col("own").alias("a_own"), F.col("bands").alias("a_bands"))
        apart = (F.col("a_root") != F.col("root")) & allowed
        if choice == star_rounds:
            first = F.array_position(F.zip_with("a_bands", "bands", lambda x, y: x == y), True) == F.col("band") + 1
            apart = apart & (F.col("a") < F.col("node")) & first
        pairs = (open_.join(hubs, ["band", "hash"]).where(apart)
                 .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"),
                         F.least("a_root", "root").alias("low"), F.greatest("a_root", "root").alias("high")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "near-pairs")
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        links = written(verified(pairs, texts, weights, p).select(F.col("low").alias("a"), F.col("high").alias("b")), "near-links")
        if not links.isEmpty():
            classes = written(_merged(classes, links), "near-classes")
    named = nodes.select("key", "node").join(classes.where("node <> root"), "node", "left").select("key", F.coalesce("root", "node").alias("class_id"))
    return (signed.select("id", "key").join(named, "key", "left")
            .select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"))
            .withColumn("kept", F.coalesce(col(id_col) == F.col("class_id"), F.lit(True))))
