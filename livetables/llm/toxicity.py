"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fit. A bounded sample of labelled rows (`max_examples`, by a hash of the id)
gives the examples. Features are words and the 4- and 5-letter starts of longer
words, each also as "at least 2" and "at least 4 times"; every feature of the
sample is in the vocabulary. A feature weighs its idf times chi2 / (chi2 +
`half_chi2`), where chi2 tells how much its share differs between the classes
(high, because many are tried): rare and indifferent features count little, none
is left out. Document frequencies are counted over all documents.

Features are known by 64-bit hashes; two that share one would count as one. Their numbers fall with their frequency.

Index. The examples' unit vectors are kept as posting lists by feature, cut into
blocks of examples, with the largest weight of each (feature, block) that occurs.
Features that at least 1 in `dense` examples have are kept as rows of a matrix
instead, and multiplied for several texts at once. The features that cost most for
the little they weigh, together at most the share `light` of all squared weights, are in
neither: the products of their parts' lengths bound what they add to a cosine.
The products, the maxima of the rest and these bounds bound every block's best cosine; blocks that
can't reach the k-th best product are left out. The k best examples so far are added up over
all features, and then whatever their bound could still lift to the k-th place, in full
precision, so the k nearest examples are exact.

Score. The neighbours vote with their cosines as weights, against `prior_votes`
of the sample's share of toxic rows. An isotonic fit on the examples' own votes,
each without itself, turns votes into probabilities. All neighbours that
voted are returned as evidence, best first; between equal cosines a hash of the example's id decides,
never its label. A score is a function of the text and the fitted model only.

Plan. The vocabulary and the index are those of at most `max_examples` texts, so
they don't grow with the corpus. The driver holds hashes and vectors; index and matrix are
made in the workers, where the examples' own votes are taken too. Two
narrow passes over the documents, one counting frequencies (a row per feature and
task is shuffled), one scoring; only the labelled texts are shuffled, and which of them
are the sample is decided on ids and hashes.

Defined results: a null text counts as empty; texts without any feature of
the sample score what the examples without neighbours are; labels that are null or whose
id is null are not used, of contradicting labels of an id toxic counts; without
labels every score is 0; repeated rows score alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from livetables.llm.common import col, give_back, giving_back, ship_package, text_or_empty, written

_WORD = re.compile(r"\w+")
REPEATS = (2, 4)
EVIDENCE = "array<struct<doc_id:long,cosine:double,toxic:int>>"
_STEP = 128                               # texts handled at a time
_ENTRIES = 1 << 20                        # entries of vectors looked at together
_ROW = 8                                  # postings of a feature are kept in rows of that many
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not (c.isalnum() or c == "_"))      # in no word


def features_of(word: str) -> list[str]:
    """A word and its 4- and 5-letter starts, marked `^`."""
    return [word, *("^" + word[:n] for n in (4, 5) if len(word) > n)]


def repeated(features: np.ndarray, n: int) -> np.ndarray:
    """The features "at least n times" of some features (64-bit hashes)."""
    with np.errstate(over="ignore"):
        mixed = (features ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def feature_hashes(text: str) -> np.ndarray:
    """All features of a text, as 64-bit hashes (ascending)."""
    counts: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for f in features_of(word):
            counts[f] += n
    plain = np.fromiter((xxhash.xxh64_intdigest(f) for f in counts), np.uint64, len(counts))
    totals = np.fromiter(counts.values(), np.int64, len(counts))
    return np.unique(np.concatenate([plain, *(repeated(plain[totals >= n], n) for n in REPEATS)]))


def ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all [begin, end) one after the other, and the length of each."""
    length = end - begin
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + length, length), length


def piece(x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All [begin, end) (one at least) of an array, one after the other."""
    return np.concatenate([x[a:b] for a, b in zip(begin.tolist(), end.tolist())])


def ordered(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their numbers (both >= 0), by ascending key: sorted as one, which takes a fraction of an `argsort`."""
    bits = int(n.max(initial=0)).bit_length()
    both = np.sort(key << bits | n)
    return both >> bits, both & ((1 << bits) - 1)


def strings(texts: pa.Array) -> list[str]:
    """A list of the texts, none of them null (one by one, Arrow's own takes several times as long)."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def hashed(features: Sequence[str] | Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, features), np.uint64, len(features))


def slack(n: int) -> float:
    """What a bar loses for the roundings of a query of `n` features: all terms are >= 0, so a sum's relative error is at most theirs."""
    return 1 - 4 * (n + 4) * 2.0 ** -24


def reached(scores: np.ndarray, k: int, group: int = 64) -> float:
    """A value that at least `k` of the scores reach, close to the k-th largest; 0 for fewer scores."""
    if len(scores) % group == 0 and len(scores) >= 4 * k * group:
        scores = scores.reshape(-1, group).max(axis=1)
    return float(np.partition(scores, -k)[-k]) if len(scores) >= k else 0.0


class _Starts(dict):
    """Numbers of starts of words, in the order in which they are first asked for; `new` are those since the last look."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, start: str) -> int:
        at = self[start] = len(self)
        self.new.append(start)
        return at


class Vocabulary:
    """Numbers of features, which are known by ascending 64-bit hashes, with a bounded memory of which starts hold which.

    A repeat ("at least n times") only counts with its plain feature.
    """

    def __init__(self, hashes: np.ndarray, max_starts: int = 200_000, numbers: np.ndarray | None = None):
        """`numbers`: those of the features, in the order of their hashes by default."""
        self.hashes, self.max_starts = hashes, max_starts
        self.numbers = np.arange(len(hashes), dtype=np.int32) if numbers is None else numbers
        #: by a hash's first bits (more values than there are features): where hashes that begin so do
        bits = len(hashes).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(hashes >> self.shift, np.arange(2 ** bits + 1, dtype=np.uint64)).astype(np.int32)
        #: by number of a plain feature: those of its repeats (or -1)
        by_number = hashes[np.argsort(self.numbers)]
        self.repeats = np.stack([self.find(repeated(by_number, n)) for n in REPEATS], axis=1)
        self.starts = _Starts()
        #: by number of a start: its feature (or -1)
        self.started = np.zeros(0, np.int32)

    def __reduce__(self):
        return Vocabulary, (self.hashes, self.max_starts, self.numbers)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of features by their hashes, -1 for others."""
        found = np.full(len(hashes), -1, np.int32)
        head = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[head], self.first[head + 1]
        live = np.flatnonzero(at < end)
        while len(live):
            hit = self.hashes[at[live]] == hashes[live]
            found[live[hit]] = self.numbers[at[live[hit]]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < end[live]]
        return found

    def held(self, words: pa.Array) -> np.ndarray:
        """The features of each word as `features_of` has them (or -1)."""
        held = np.full((len(words), 3), -1, np.int32)
        held[:, 0] = self.find(hashed(strings(words.view(pa.large_binary()))))
        if len(self.starts) > self.max_starts:
            self.starts, self.started = _Starts(), self.started[:0]
        length = pc.utf8_length(words).to_numpy()
        cut = [pc.utf8_slice_codeunits(words.filter(pa.array(length > n)), 0, n).dictionary_encode() for n in (4, 5)]
        numbers = [np.array([self.starts[w] for w in strings(c.dictionary)], np.int64) for c in cut]
        new = self.starts.new
        self.started = np.append(self.started, self.find(hashed(["^" + w for w in new])))
        new.clear()
        for j, (some, c, n) in enumerate(zip(numbers, cut, (4, 5)), 1):
            held[length > n, j] = self.started[some][c.indices.to_numpy()]
        return held

    def counted(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' features, ascending: number of the text, of the feature, and how often the text has it."""
        # cut at white space, which no word holds, and without the marks around; what differs of that is looked at token by token
        cut, size = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string())), max(1, len(self.hashes))
        tokens = cut.values.dictionary_encode()
        core = pc.ascii_trim(tokens.dictionary, _MARKS).dictionary_encode()
        at = core.indices.to_numpy()[tokens.indices.to_numpy()]
        plain = pc.ascii_is_alnum(core.dictionary)
        words, is_word = core.dictionary.filter(plain), plain.to_numpy(zero_copy_only=False)
        of, other = np.flatnonzero(is_word), np.flatnonzero(~is_word)
        found = [[t] if t.isalnum() else _WORD.findall(t) for t in strings(core.dictionary.filter(pc.invert(plain)))]
        words = pa.concat_arrays([words, pa.array(list(chain.from_iterable(found)), pa.large_string())])
        of = np.append(of, np.repeat(other, [len(f) for f in found]).astype(of.dtype))
        held = self.held(words)
        # each core's features, one core's after the other's
        there = held >= 0
        of = np.repeat(of, there.sum(axis=1))
        order = np.argsort(of, kind="stable")
        features, ends = held[there][order], np.append(0, np.cumsum(np.bincount(of, minlength=len(core.dictionary))))
        many = len(core.dictionary) + 1
        key = np.sort(np.repeat(np.arange(len(texts)) * many, np.diff(cut.offsets.to_numpy())) + at)
        start = np.flatnonzero(np.diff(key, prepend=-1))
        (line, at), n = np.divmod(key[start], many), np.diff(start, append=len(key))
        own, length = ranges(ends[at], ends[at + 1])
        key, n = ordered(np.repeat(line * size, length) + features[own], np.repeat(n, length))
        start = np.flatnonzero(np.diff(key, prepend=-1))
        totals = np.add.reduceat(n, start) if len(start) else n
        line, numbers = np.divmod(key[start], size)
        keys, many = [key[start]], [totals]
        for j, least in enumerate(REPEATS):
            more = np.flatnonzero(totals >= least)
            repeat = self.repeats[numbers[more], j]
            more, repeat = more[repeat >= 0], repeat[repeat >= 0]
            keys.append(line[more] * size + repeat)
            many.append(totals[more])
        key, totals = ordered(np.concatenate(keys), np.concatenate(many))
        return *np.divmod(key, size), totals

    def counts_of(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text: feature numbers and how often it has each."""
        line, numbers, totals = self.counted(texts)
        ends, totals = np.searchsorted(line, np.arange(len(texts) + 1)).tolist(), totals.astype(np.float64)
        return [(numbers[x:y], totals[x:y]) for x, y in zip(ends[:-1], ends[1:])]


@dataclass
class Entries:
    """Weights of vectors' entries before they are divided by the vectors' lengths: few bytes an entry, worked out when asked for."""

    own: np.ndarray           # [entry]: feature
    counts: np.ndarray        # [entry]: how often the text has it
    weights: np.ndarray       # [feature]

    @classmethod
    def of(cls, own: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> Entries:
        return cls(own, counts.astype(np.min_scalar_type(int(counts.max(initial=0)))), weights)

    def __getitem__(self, at: slice | np.ndarray) -> np.ndarray:
        return (1 + np.log(self.counts[at].astype(np.float64))) * self.weights[self.own[at]]


@dataclass
class Examples:
    """The examples' vectors one after the other; their index is made where it is first asked."""

    entries: Entries
    lengths: np.ndarray       # [example]: its vector's
    begin: np.ndarray
    size: int                 # of the vocabulary
    block: int = 1024
    dense: int = 16
    light: float = 0.006
    made: "BlockMaxIndex | None" = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "made": None}

    def index(self) -> "BlockMaxIndex":
        if self.made is None:
            self.made = BlockMaxIndex._of(self.entries.own, self.entries, self.lengths, self.begin, self.size, self.block, self.dense, self.light)
            give_back()
        return self.made

    def nearest_of(self, queries: Sequence[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return self.index().nearest_of(queries, k)


@dataclass
class BlockMaxIndex:
    """Exact nearest neighbours by inner product of sparse non-negative vectors.

    A cell is a feature in the posting lists and a block of examples that has it; cells
    are in the order of features, then blocks, postings in the order of cells.
    """

    cells: np.ndarray        # [feature + 1]: where the cells of a feature begin
    blocks: np.ndarray       # [cell]: number of the block
    top: np.ndarray          # [cell]: the largest weight
    ptr: np.ndarray          # [cell + 1]: where the postings of a cell begin; those of a feature fill whole rows
    postings: np.ndarray     # [posting]: weight in single precision, the number of the example in its last bits (`number`)
    place: np.ndarray        # [feature]: its row of the matrix, -1 in the posting lists, -2 if it is light
    light: np.ndarray        # [example]: length of its vector's light part
    light_top: np.ndarray    # [block]: the largest of them
    begin: np.ndarray        # [example + 1]: where an example's own vector begins
    own: np.ndarray          # features of the examples' vectors
    own_weights: np.ndarray | Entries        # their weights, to be divided by `lengths`
    lengths: np.ndarray      # [example]: its vector's
    block: int
    size: int
    dense: int
    number: int              # the bits of a posting that are the number of the example
    matrix: np.ndarray | None = None         # [row, example], single precision; made where it is used
    asked: np.ndarray | None = None          # [feature]: zeros, room for where in a query a feature is (from 1)
    light_most: float = 0.0                  # the largest of `light`
    idle: int = 0                            # how often in a row the bounds have left out next to nothing

    @classmethod
    def build(cls, vectors: Sequence[tuple[np.ndarray, np.ndarray]], n_features: int, block: int = 64, dense: int = 16,
              light: float = 0.006) -> BlockMaxIndex:
        own = np.concatenate([v[0] for v in vectors] or [np.zeros(0)]).astype(np.int32)
        own_weights = np.concatenate([v[1] for v in vectors] or [np.zeros(0)])
        begin = np.append(0, np.cumsum([len(v[0]) for v in vectors], dtype=np.int64))
        return cls._of(own, own_weights, np.ones(len(vectors)), begin, n_features, block, dense, light)

    @classmethod
    def _of(cls, own: np.ndarray, own_weights: np.ndarray | Entries, lengths: np.ndarray, begin: np.ndarray, n_features: int,
            block: int, dense: int, light: float) -> BlockMaxIndex:
        size = len(begin) - 1
        having, squares = np.zeros(n_features, np.int64), np.zeros(n_features)
        step = max(1, min(block, _ENTRIES * size // max(1, len(own))))
        for line in range(0, size, step):                          # some at a time: no large intermediate arrays
            ends = begin[line:line + step + 1]
            some = own[ends[0]:ends[-1]]
            weight = own_weights[ends[0]:ends[-1]] / np.repeat(lengths[line:line + step], np.diff(ends))
            having += np.bincount(some, minlength=n_features)
            squares += np.bincount(some, weights=weight * weight, minlength=n_features)
        common = having * dense >= max(1, size)
        # what a feature costs a text like the examples: its postings, or the dearer row of the matrix
        cost = np.minimum(having.astype(np.float64) ** 2 / max(1, size), size / dense ** 2 if dense else np.inf)
        cheap = np.argsort(squares / np.maximum(cost, 1e-300), kind="stable")
        slight = np.zeros(n_features, bool)
        slight[cheap[np.cumsum(squares[cheap]) <= light * squares.sum()]] = True
        common &= ~slight
        place = np.where(slight, -2, np.where(common, np.cumsum(common) - 1, -1)).astype(np.int32)
        number = (1 << max(0, size - 1).bit_length()) - 1
        slights, cells, parts = np.zeros(size), [], []
        for line in range(0, size, block):
            ends = begin[line:line + block + 1]
            some = own[ends[0]:ends[-1]]
            weight = own_weights[ends[0]:ends[-1]] / np.repeat(lengths[line:line + block], np.diff(ends))
            row, at = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends)), place[some]
            small = at == -2
            slights[line:line + block] = np.sqrt(np.bincount(row[small], weights=weight[small] ** 2, minlength=len(ends) - 1))
            rest = np.flatnonzero(at == -1)
            rest = rest[np.argsort(some[rest], kind="stable")]     # rows ascend already
            feature, weight = some[rest], weight[rest].astype("f4")
            first = np.flatnonzero(np.diff(feature, prepend=-1))
            cells.append((feature[first], np.diff(first, append=len(feature)), np.maximum.reduceat(weight, first) if len(first) else weight))
            # weights and products rounded more than in exact sums: `slack` allows for it
            parts.append(weight.view("u4") & np.uint32(~number & 0xffffffff) | (row[rest] + line).astype("u4"))
        tops = np.maximum.reduceat(slights, np.arange(0, size, block)) if size else slights
        feature, length, top = (np.concatenate([c[i] for c in cells] or [np.zeros(0, np.int64)]) for i in range(3))
        blocks = np.repeat(np.arange(len(cells), dtype=np.int32), [len(c[0]) for c in cells])
        order = np.argsort(feature, kind="stable")                 # blocks ascend already
        cell = np.searchsorted(feature[order], np.arange(n_features + 1))
        ptr = np.append(0, np.cumsum(length[order]))
        # a feature's postings fill whole rows, with zeros behind
        many = np.diff(ptr[cell])
        more = np.repeat(np.cumsum(-many % _ROW) - (-many % _ROW), np.diff(cell))
        ptr += np.append(more, np.sum(-many % _ROW))
        start = np.empty(len(order), np.int64)
        start[order] = ptr[:-1]
        postings, at = np.zeros(ptr[-1], "u4"), 0
        for (_, many, _), part in zip(cells, parts):
            some = start[at:at + len(many)]
            postings[ranges(some, some + many)[0]] = part
            at += len(many)
        return cls(cell, blocks[order], top[order], ptr,
                   postings, place, slights, tops, begin, own, own_weights, lengths, block, size, dense, number)

    def _make_room(self) -> None:
        # columns up to a whole number of blocks
        self.matrix = np.zeros((self.place.max(initial=-1) + 1, -(-self.size // self.block) * self.block), "f4")
        for line in range(self.size):                              # one by one: no large intermediate arrays
            features, weights = self.vector(line)
            at = self.place[features]
            self.matrix[at[at >= 0], line] = weights[at >= 0]
        self.asked = np.zeros(len(self.place), np.int32)
        self.light_most = float(self.light_top.max(initial=0.0))

    def vector(self, line: int) -> tuple[np.ndarray, np.ndarray]:
        """Features and weights of an example."""
        at = slice(self.begin[line], self.begin[line + 1])
        return self.own[at], self.own_weights[at] / self.lengths[line]

    def nearest(self, features: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the k best examples with a positive score; ties to the smaller number."""
        return self.nearest_of([(features, query)], k)[0]

    def nearest_of(self, queries: Sequence[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """`nearest` for each of several queries (features, weights)."""
        if not self.size:
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
        if self.matrix is None:
            self._make_room()
        starts = np.append(0, np.cumsum([len(q[0]) for q in queries]))
        line = np.repeat(np.arange(len(queries)), np.diff(starts))
        features, weights = (np.concatenate([q[i] for q in queries]) for i in (0, 1))
        place = self.place[features]
        wide = np.zeros((len(queries), len(self.matrix)), "f4")
        wide[line[place >= 0], place[place >= 0]] = weights[place >= 0]
        scores = wide @ self.matrix
        light = np.sqrt(np.bincount(line[place == -2], weights=weights[place == -2] ** 2, minlength=len(queries)))
        tail = np.flatnonzero(place == -1)
        kept = self._kept(queries, scores, light, line[tail], features[tail], weights[tail], k)
        weights = weights.astype("f4")
        found = []
        for i, (own, query) in enumerate(queries):
            some = tail[slice(*np.searchsorted(tail, starts[i:i + 2]))]
            found.append(self._nearest(own, query, k, scores[i], light[i], None if kept is None else kept[i], features[some], weights[some]))
        return found

    def _kept(self, queries: Sequence[tuple[np.ndarray, np.ndarray]], scores: np.ndarray, light: np.ndarray, line: np.ndarray,
              features: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray | None:
        """Which blocks may hold a query's best examples, by the bounds of all queries in one go; None for all.

        Bounds that leave out next to nothing are asked for less and less often: they only save time.
        """
        if self.idle and self.idle & (self.idle - 1) and self.idle % 64:
            self.idle += 1
            return None
        count = scores.shape[1] // self.block
        cells, length = ranges(self.cells[features], self.cells[features + 1])
        of = np.repeat(line * count, length) + self.blocks[cells]
        bound = np.bincount(of, weights=np.repeat(weights, length) * self.top[cells], minlength=len(queries) * count)
        bound = bound.reshape(-1, count) + scores.reshape(len(queries), -1, self.block).max(axis=2) + light[:, None] * self.light_top
        kept = np.array([b >= reached(s, k) * slack(len(q[0])) for b, s, q in zip(bound, scores, queries)])
        self.idle = 0 if kept.mean() < 0.9 else self.idle + 1
        return kept

    def _nearest(self, features: np.ndarray, query: np.ndarray, k: int, scores: np.ndarray, light: float,
                 kept: np.ndarray | None, tail: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One query's: `scores` by the matrix, `light` the length of its light part, `kept` blocks, `tail` features and their weights."""
        begin, end = self.cells[tail], self.cells[tail + 1]
        if kept is not None and not kept.all():
            cells, length = ranges(begin, end)
            some = kept[self.blocks[cells]]
            begin, end, share = self.ptr[cells[some]], self.ptr[cells[some] + 1], np.repeat(share, length)[some]
            found, share = piece(self.postings, begin, end) if len(begin) else self.postings[:0], np.repeat(share, end - begin)
        else:
            rows, length = ranges(self.ptr[begin] // _ROW, self.ptr[end] // _ROW)
            found, share = self.postings.reshape(-1, _ROW).take(rows, axis=0), np.repeat(share, length)[:, None]
        if len(found):
            weight = (found.view("f4") * share).ravel()
            scores = scores + np.bincount((found & np.uint32(self.number)).ravel(), weights=weight, minlength=len(scores))
        scores = scores[:self.size]
        # light parts only add: what the k-th best has without them, no example whose bound is below it is among the k best
        bar = 0.0
        if self.size >= k:
            best = scores[scores >= reached(scores, k)]
            bar = float(np.partition(best, -k)[-k]) * (slack(len(features)) - (self.number + 1) * 2.0 ** -22)
        if bar > 0:
            some = np.flatnonzero(scores >= bar - light * self.light_most)
            some = some[scores[some] + light * self.light[some] >= bar]
        else:
            some = np.flatnonzero(scores + light * self.light > 0)
        self.asked[features] = np.arange(1, len(features) + 1)
        exact = self._exact(some, query)
        self.asked[features] = 0
        some, exact = some[exact > 0], exact[exact > 0]
        order = np.lexsort((some, -exact))[:k]
        return some[order], exact[order]

    def _exact(self, some: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Products of some examples with a query's weights, whose features are `asked`, over all features."""
        if not len(some):
            return np.zeros(0)
        begin, end = self.begin[some], self.begin[some + 1]
        at = self.asked.take(piece(self.own, begin, end))
        shared, ends = np.flatnonzero(at != 0), np.cumsum(end - begin)
        length = np.diff(np.searchsorted(shared, ends), prepend=0)
        weights = self.own_weights[shared + np.repeat(end - ends, length)]
        line = np.repeat(np.arange(len(some)), length)
        return np.bincount(line, weights=query[at[shared] - 1] * (weights / self.lengths[some][line]), minlength=len(some))


def isotonic(x: np.ndarray, y: np.ndarray, prior: float, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Step points and levels of the non-decreasing fit of y on x; each level leans on `weight` rows of `prior`."""
    points, counts = np.unique(x, return_counts=True)
    sums = np.array([y[x == p].sum() for p in points]) if len(points) < 2000 else np.bincount(np.searchsorted(points, x), weights=y)
    steps: list[list[float]] = []
    for p, n, s in zip(points, counts, sums):
        steps.append([p, float(n), float(s)])
        while len(steps) > 1 and steps[-2][2] * steps[-1][1] >= steps[-1][2] * steps[-2][1]:
            _, n1, s1 = steps.pop()
            steps[-1][1] += n1
            steps[-1][2] += s1
    levels = np.array([(s + weight * prior) / (n + weight) for _, n, s in steps])
    return np.array([p for p, _, _ in steps]), np.maximum.accumulate(levels) if len(levels) else levels


@dataclass
class Model:
    """A fitted model; everything in it is bounded by the sample."""

    vocabulary: Vocabulary
    weights: np.ndarray
    index: Examples
    labels: np.ndarray
    ids: list
    prior: float
    k: int
    prior_votes: float
    points: np.ndarray = field(default_factory=lambda: np.zeros(0))
    levels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: the model without points and levels, as it was sent to the executors
    shared: object = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "shared": None}

    def vector(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return unit(counts, self.weights[numbers])

    def vote(self, best: np.ndarray, cosines: np.ndarray) -> float:
        total = float(cosines.sum()) + self.prior_votes
        return (float(cosines @ self.labels[best]) + self.prior_votes * self.prior) / total

    def calibrated(self, vote: float) -> float:
        if not len(self.points):
            return 0.0
        return float(self.levels[max(0, np.searchsorted(self.points, vote, side="right") - 1)])

    def score(self, text: str) -> tuple[float, list[dict]]:
        return self.scores([text])[0]

    def nearest(self, counted: Sequence[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text's features: numbers and cosines of its neighbours."""
        return [found for at in range(0, len(counted), _STEP)
                for found in self.index.nearest_of([(f, self.vector(f, c)) for f, c in counted[at:at + _STEP]], self.k)]

    def scores(self, texts: Sequence[str]) -> list[tuple[float, list[dict]]]:
        return list(zip(*(column.to_pylist() for column in self.columns(self.vocabulary.counts_of(texts)))))

    def columns(self, counted: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[pa.Array, pa.Array]:
        """Scores and evidence for each text's features."""
        found = self.nearest(counted)
        best, cosines = (np.concatenate([f[i] for f in found] or [np.zeros(0)]) for i in (0, 1))
        best = best.astype(np.int64)
        ids = np.array(self.ids, np.int64)
        proof = pa.StructArray.from_arrays([pa.array(ids[best]), pa.array(cosines), pa.array(self.labels[best].astype(np.int32))],
                                           names=["doc_id", "cosine", "toxic"])
        ends = np.append(0, np.cumsum([len(b) for b, _ in found])).astype(np.int32)
        return pa.array([self.calibrated(self.vote(*f)) for f in found], pa.float64()), pa.ListArray.from_arrays(pa.array(ends), proof)


def unit(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * weights if len(counts) else counts
    length = math.sqrt(float(weights @ weights))
    return weights / length if length else weights


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, bound: int) -> DataFrame:
    """id, t, toxic of at most `bound` labelled texts outside the held-out fold, by a hash of their ids.

    Rows are chosen by id and text hash; texts go to no task that sorts or bounds.
    """
    known = (labels.where(col(id_col).isNotNull() & col(label_col).isNotNull() & ~held_out(id_col))
             .groupBy(col(id_col).alias("id")).agg(F.max(col(label_col)).cast("int").alias("toxic")))
    mixed = F.md5(F.col("id").cast("string").cast("binary"))
    chosen = F.broadcast(known.orderBy(mixed, "id").limit(bound))        # at most `bound` narrow rows
    texts = docs.select(col(id_col).alias("doc"), text_or_empty(text_col).alias("t"))
    texts = texts.join(chosen, texts["doc"] == chosen["id"]).select("id", "t", "toxic", F.md5(F.col("t").cast("binary")).alias("h"))
    texts = written(texts.groupBy("id", "h").agg(F.first("t").alias("t"), F.max("toxic").alias("toxic")), "toxicity-labelled")
    kept = texts.select(F.col("id").alias("i"), F.col("h").alias("k")).orderBy(F.md5(F.col("i").cast("string").cast("binary")), "i", "k").limit(bound)
    kept = F.broadcast(kept)                                              # at most `bound` narrow rows
    return texts.join(kept, (F.col("id") == F.col("i")) & (F.col("h") == F.col("k"))).select("id", "t", "toxic")


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 2 * _STEP, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at least `rows` rows or `size` bytes, but for the last one; of at most `rows` rows more than one needs for that."""
    held: list[pa.RecordBatch] = []
    for part in (b.slice(at, _STEP) for b in batches for at in range(0, b.num_rows, _STEP)):
        held.append(part)
        if sum(h.num_rows for h in held) >= rows or sum(h.nbytes for h in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def significance(a: np.ndarray, b: np.ndarray, toxic: int, other: int, half_chi2: float) -> np.ndarray:
    """Between 0 and 1, never 0: of features that `a` toxic and `b` other examples have."""
    c, d = toxic - a, other - b
    spread = (a + b) * (c + d) * float(toxic) * float(other)
    chi2 = (toxic + other) * (a * d - b * c) ** 2 / np.where(spread > 0, spread, 1.0) + 0.1
    return chi2 / (chi2 + half_chi2)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_examples: int = 8192, half_chi2: float = 30.0, k: int = 15, prior_votes: float = 0.25) -> Model:
    """Learn from labelled rows outside the held-out fold; counts are over all `docs`."""
    spark = docs.sparkSession
    ship_package(spark)
    sample = written(_examples(docs, labels, id_col, text_col, label_col, max_examples), "toxicity-examples")
    totals = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n, n_toxic = int(totals[0]), int(totals[1])
    tasks = max(1, min(n // 64, 4 * spark.sparkContext.defaultParallelism))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = feature_hashes(t)
                yield pa.RecordBatch.from_pydict({"f": pa.array(found.view(np.int64)), "y": pa.array(np.full(len(found), y, np.int32))})
    seen = (sample.select("t", "toxic").repartition(tasks).mapInArrow(explode, "f long, y int")
            .groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("a")).toArrow())      # features of at most max_examples texts
    hashes = seen["f"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, toxic = hashes[order], seen["a"].to_numpy()[order].astype(np.float64)
    having, size = seen["n"].to_numpy()[order], len(hashes)
    # numbered by falling frequency: what most entries of vectors need lies close together in tables
    order = np.argsort(-having, kind="stable")
    numbers = np.empty(size, np.int32)
    numbers[order] = np.arange(size)
    significant = significance(toxic, having - toxic, n_toxic, n - n_toxic, half_chi2)[order]
    seen = having = None
    shared = spark.sparkContext.broadcast(Vocabulary(hashes, numbers=numbers))          # 8 bytes for each of these features

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                part = batch.slice(at, _STEP)
                made = shared.value.counts_of(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *(pa.array([m[i].astype("<i4").tobytes() for m in made], pa.binary())
                                                                                    for i in (0, 1))], names=["id", "toxic", "f", "c"])
    rows = sample.repartition(tasks).mapInArrow(vectors, "id long, toxic int, f binary, c binary").toArrow()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = 0, np.zeros(size, np.int64)
        for batch in _gathered(batches):
            total += batch.num_rows
            counts += np.bincount(shared.value.counted(strings(batch.column(0)))[1], minlength=size)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"f": pa.array(np.append(-1, some), pa.int32()), "n": pa.array(np.append(total, counts[some]), pa.int64())})
    told = docs.select(text_or_empty(text_col).alias("t")).mapInArrow(frequencies, "f int, n long")
    told = told.groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(size + 1)
    df[told["f"].to_numpy()] = told["n"].to_numpy()                 # the number of documents comes last, as -1
    weights = np.log(1 + df[-1] / (1 + df[:-1])) * significant
    told = df = toxic = significant = None

    made = []
    for batch in rows.to_batches():
        for i, y, f, c in zip(*(batch.column(x).to_pylist() for x in ("id", "toxic", "f", "c"))):
            f = np.frombuffer(f, "<i4")
            c = np.frombuffer(c, "<i4")
            w = unit(c.astype(np.float64), weights[f])
            made.append((i, y, f, c, int(f[np.argmax(w)]) if len(f) else -1))
    rows = None
    # neighbours in the index share their strongest feature: tight block maxima. Among them a hash of the id
    # decides, and so it does between equal cosines: a label never does
    made.sort(key=lambda m: (int(order[m[4]]) if len(m[2]) else size, xxhash.xxh64_intdigest(str(m[0])), m[0], m[2].tobytes()))
    own, counts = (np.concatenate([m[i] for m in made] or [np.zeros(0, np.int32)]).astype(np.int32) for i in (2, 3))
    lengths = np.array([math.sqrt(float(w @ w)) or 1.0 for m in made for w in [(1 + np.log(m[3].astype(np.float64))) * weights[m[2]]]])
    begin = np.append(0, np.cumsum([len(m[2]) for m in made], dtype=np.int64))
    ids, known = [m[0] for m in made], np.array([m[1] for m in made], np.float64)
    made = None
    index = Examples(Entries.of(own, counts, weights), lengths, begin, size)
    own = counts = None
    model = Model(Vocabulary(hashes, numbers=numbers), weights, index, known, ids, n_toxic / n if n else 0.0, k, prior_votes)
    shared.unpersist()
    model.shared = spark.sparkContext.broadcast(model)              # the vectors of at most max_examples texts

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            lines, out = batch.column(0).to_pylist(), []
            for at in range(0, len(lines), _STEP):
                some = lines[at:at + _STEP]
                for line, (best, cosines) in zip(some, own.index.nearest_of([own.index.index().vector(i) for i in some], k + 1)):
                    other = best != line
                    out.append(own.vote(best[other][:k], cosines[other][:k]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["id", "vote"])
    sent = model.shared
    told = spark.range(0, len(ids), 1, tasks).mapInArrow(votes, "id long, vote double").toArrow() if ids else None
    if told is not None:
        made = np.zeros(len(ids))
        made[told["id"].to_numpy()] = told["vote"].to_numpy()
        model.points, model.levels = isotonic(made, known, model.prior)
    give_back()
    return model


def score(df: DataFrame, model: Model, *, text_col: str = "text", columns: Sequence[str] | None = None) -> DataFrame:
    """Per row of `df`: row (struct of `columns`, default all), score, evidence."""
    spark = df.sparkSession
    ship_package(spark)
    shared = model.shared or spark.sparkContext.broadcast(model)          # the features and vectors of at most max_examples texts
    points, levels = model.points, model.levels
    kept = F.struct(*[col(c) for c in (df.columns if columns is None else columns)])
    rows = df.select(kept.alias("row"), text_or_empty(text_col).alias("t"))
    schema = StructType([StructField("row", rows.schema["row"].dataType), StructField("score", DoubleType()),
                         *StructType.fromDDL(f"evidence {EVIDENCE}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        own.points, own.levels = points, levels
        for part in _gathered(batches):
            found, proof = own.columns(own.vocabulary.counts_of(strings(part.column(1))))
            yield pa.RecordBatch.from_arrays([part.column(0), found, proof], names=["row", "score", "evidence"])
    return rows.mapInArrow(lambda batches: giving_back(run(batches)), schema)
