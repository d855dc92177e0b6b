"""SimHash with Golay keys against plain Python over all pairs."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from livetables.llm import byte_words, simhash
from livetables.llm.queries import QUERIES
from tests.conftest import SF001


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints):
    """{index: smallest index reachable} over links of at most 3 bits."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def _check(got, rows):
    prints = [_fingerprint(t) for _, t in rows]
    roots = _components(prints)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = sorted(((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots)), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == want


def test_words_and_hashes_equal_plain_python():
    texts = ["", " ", "A  b\tC", "Äbé 漢 x", "one", "w" * 200 + " \r\n " + "y" * 33, "a b  c"] + ["z" * k for k in range(70)]
    array = pa.array([t.encode() for t in texts], pa.binary())
    for part in (array, array.slice(2, 40)):
        words = byte_words.words_of(part, byte_words.byte_table(b" \t\n\r\x0b\x0c"))
        want = [t.lower().split() for t in part.to_pylist()]
        assert [bytes(words.data[a:b]) for a, b in zip(words.begin, words.end)] == [w for t in want for w in t]
        assert np.diff(words.first).tolist() == [len(t) for t in want]
        assert byte_words.xxh64(words.data, words.begin, words.end, 42).tolist() == [xxhash.xxh64_intdigest(w, 42) for t in want for w in t]


def test_golay_keys_of_words_one_bit_apart():
    words = np.random.default_rng(1).integers(0, 1 << 23, 3000)
    keys, there = simhash.fuzzy(words)
    assert set(there.sum(axis=1).tolist()) == {1, 6}
    error = np.bitwise_count((words ^ (keys[:, 0] << 11 ^ simhash._remainders(keys[:, 0] << 11))).astype(np.int64))
    assert error.max() == 3                                           # a perfect code
    for bit in range(23):
        others, those = simhash.fuzzy(words ^ (1 << bit))
        assert ((keys == others[:, :1]) & there).any(axis=1).all() and ((others == keys[:, :1]) & those).any(axis=1).all()


def test_every_pair_within_three_bits_shares_a_key():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 4000).astype(np.uint64)
    other = fp.copy()
    for at in range(3):
        other ^= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)

    def keys(prints):
        out = [(set(), set()) for _ in prints]
        for line, key, own in zip(*(x.tolist() for x in simhash.keys_of(prints))):
            out[line][0].add(key)
            if own:
                out[line][1].add(key)
        return out
    for (a, a_own), (b, b_own) in zip(keys(fp), keys(other)):
        assert a_own & b and b_own & a and 10 <= len(a) <= 60


def test_links_of_planted_fingerprints(spark):
    """A chain, a dense cluster around a centre, and far ones: every round of hubs leaves something to the last."""
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(0, 1 << 62, 100)}
    centre = int(rng.integers(0, 1 << 62))
    for _ in range(400):
        x = centre
        for b in rng.integers(0, 64, rng.integers(0, 7)):
            x ^= 1 << int(b)
        prints.add(x)
    chain = int(rng.integers(0, 1 << 62))
    for b in range(0, 64, 3):
        prints.add(chain)
        chain ^= 0b111 << b if b < 61 else 1 << b
    prints = sorted(prints)
    nodes = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    for rounds in (0, 1, 3):
        got = {np.uint64(np.int64(r["fp"])).item(): r["root"] for r in simhash.linked(nodes, star_rounds=rounds).collect()}
        want = _components(prints)
        groups, made = {}, {}
        for p, r in zip(prints, want):
            groups.setdefault(r, set()).add(p)
            made.setdefault(got.get(p, f"alone {p}"), set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, made.values()))


ROWS = [(5, "the quick brown fox jumps over the lazy dog"), (3, "The  Quick brown\tfox jumps over the lazy dog"), (9, "one"), (8, "ONE"), (7, "one two"),
        (1, ""), (2, None), (4, " \n"), (None, "one"), (None, "nobody else has this text"), (6, "a b c"), (6, "d e f"), (10, "x " * 30_000)]


def test_hand_made_rows(spark):
    df = spark.createDataFrame([(i, t, "f", 1) for i, t in ROWS], "doc_id long, text string, fingerprint string, component_id int")
    _check(simhash.near_duplicates(df).collect(), ROWS)


def test_empty_table(spark):
    out = simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.collect() == []


def test_spark_has_the_same_hash(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("ä b c"))).first()[0] == np.uint64(xxhash.xxh64_intdigest("ä b c", 42)).astype(np.int64)


def test_query_on_the_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    _check(QUERIES["op12_golay_simhash"](spark, SF001).collect(), rows)
