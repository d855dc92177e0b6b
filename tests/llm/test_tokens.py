"""Encoding, decoding and the plane store against the public tokenizers themselves."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from livetables.llm import bpe, token_store
from livetables.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "the  cat\n\nsat", "don't stop, now.\nYes!", "x\ty \r\n z", "日本語 text 🎉 ok", "a" * 30_000,
         "word " * 20_000, "x\0y", "tail ", "\n", "a,b.c;; d.. e", "same text", "same text", "1234 56,7", "a\x1cb c", "\u00a0x y"]


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(bpe.read_ranks(RANKS))})


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def frame(spark, texts, **extra):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, ids string, n_tokens string")


def test_round_trip_equals_rank_based_encoder(spark):
    rows = {r.doc_id: r for r in bpe.round_trip(frame(spark, TEXTS), RANKS, public_tokenizers.PATTERN).collect()}
    assert len(rows) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = reference().encode_ordinary(t or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_then_decode_rows(spark):
    made = bpe.encode_rows(frame(spark, TEXTS), RANKS, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode_rows(made, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(TEXTS)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab' .,\n\t!é1\u00a0\x1c日s"), max_size=30), max_size=5))
def test_word_cache_never_changes_ids(texts):
    assert CODEC.encode(texts) == [packed(REFERENCE.encode_ordinary(t)) for t in texts]


CODEC, REFERENCE = bpe.Codec(RANKS, public_tokenizers.PATTERN), reference()


def test_word_cache_is_bounded():
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    codec.cache.max_words = 10
    for i in range(20):
        text = " ".join(f"w{i}x{j}" for j in range(8)) + " always here"
        assert codec.encode([text]) == [packed(REFERENCE.encode_ordinary(text))]
        assert len(codec.cache.ids) + len(codec.cache.ids.older) <= 2 * (10 + 24)
    assert "here" in codec.cache.ids or "here" in codec.cache.ids.older


def test_both_encoders_agree_through_the_cache():
    words = token_store._encoder(JSON)
    texts = [t or "" for t in TEXTS] + ["Ab ab AB. ab, ab\nab ab!", "ªº ǅ ʰ word", "x 一二 三", "mixed 12 abc1 d'ef g's"]
    model = Tokenizer.from_file(JSON)
    for group in (texts, texts[::-1], texts[:3]):
        assert words.encode(group) == [packed(model.encode(t, add_special_tokens=False).ids) for t in group]


@pytest.mark.parametrize("unit", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(unit, n):
    ids = np.random.default_rng(n).integers(0, 2 ** 32 if n == 7 else 50_257, n, dtype="u4")
    assert (token_store.from_planes(token_store.to_planes(ids, unit), n, unit) == ids).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_store_keeps_every_id_in_order(spark, unit):
    path = scratch_path(spark, "store")
    token_store.write_store(frame(spark, TEXTS), path, JSON, unit=unit, block_ids=100, chunk_ids=500)
    model, start = Tokenizer.from_file(JSON), 0
    rows = {r.doc_id: r for r in token_store.read_store(spark, path).collect()}
    crc = {r.doc_id: r.ids_crc32 for r in token_store.read_store(spark, path, digests=True).collect()}
    for i, t in enumerate(TEXTS):
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 2]
        assert rows[i].ids == ids and rows[i].n_tokens == len(ids) and rows[i].start == start
        assert crc[i] == zlib.crc32(packed(ids))
        start += len(ids)


def test_store_of_an_empty_table_and_null_ids(spark):
    path = scratch_path(spark, "store")
    token_store.write_store(frame(spark, []), path, JSON)
    assert token_store.read_store(spark, path).count() == 0
    path = scratch_path(spark, "store")
    rows = spark.createDataFrame([(None, "b"), (None, None), (1, "a")], "doc_id long, text string")
    token_store.write_store(rows, path, JSON)
    got = [(r.doc_id, r.start, len(r.ids)) for r in token_store.read_store(spark, path).orderBy("start").collect()]
    assert got == [(None, 0, 1), (None, 1, 2), (1, 3, 2)]


def test_a_word_of_the_older_generation_serves_its_marked_form():
    """A word that only the older generation holds is not encoded again for its marked form."""
    from livetables.llm.pretokens import WordCache

    asked = []

    def encode_many(texts):
        asked.append(list(texts))
        return [t.encode() for t in texts]
    cache = WordCache(encode_many, max_words=3)
    texts = ["one two three four five", "one two, three", "five. five five, two"]
    for t in texts * 2:
        assert cache.encode([t, t]) == [t.encode()] * 2
    assert sum(" four" in x for x in asked) <= 2


def test_words_are_encoded_without_their_marks_and_once_for_many_texts():
    from tokenizers import Tokenizer

    from livetables.llm.pretokens import WordCache
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    asked = []

    def ids(text):
        return np.array(model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(texts):
        asked.extend(texts)
        return [ids(t) for t in texts]
    cache = WordCache(encode)
    texts = ["Ab cd%%%, cd.\nEf!! gh's it's' x_ _y a'b'' ***\nAb (ü) ü)\"", "cd&&& cd%%%, Ab", "Ef", "\nno", "two  spaces", "n\n\nn", "", "é́ ß. 1%% x1%%",
             "\0a b", "tab\tb", "o'\n'o a\\ b` c~^ d-", "cd <cd> [cd]", "cd's. cd'", "  a", "a b c"]
    assert cache.encode(texts * 3) == [ids(t) for t in texts] * 3
    assert " cd" in asked and not {" cd%%%,", " cd.", " cd&&&", "Ef!!"} & set(asked)
    pieces = [a for a in asked if a.startswith(" ")]
    assert len(pieces) == len(set(pieces))
    asked.clear()
    assert cache.encode(texts[:2]) == [ids(t) for t in texts[:2]] and not asked


def test_joined_words_equal_words_alone():
    from livetables.llm.token_store import _encoder
    path = public_tokenizers.path("byte_bpe_50k.json")
    cache = _encoder(path)
    words = ["a", "the", "Überfluß", "ééé", "日本語", "x" * 300, "ΟΔΟΣ", "s", "ll", "ǅ", "ª"]
    assert cache.encode_words(words) == cache.encode_many([" " + w for w in words])
    assert cache.encode_lines(words) == cache.encode_many(words)
