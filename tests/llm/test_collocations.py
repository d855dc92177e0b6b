"""Collocations against plain Python and the SQL."""

import re
from collections import Counter, defaultdict

import pytest

from livetables.llm import collocations
from livetables.llm.queries import QUERIES
from tests.conftest import SF001

_LOWER = {c: c + 32 for c in range(65, 91)}


def _brute(rows, least=10, top=2000, max_words=3, held=50):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, max_words + 1):
                for i in range(len(words) - m + 1):
                    counts[lang][" ".join(words[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if n >= least and " " in p}
        kept = []
        for p, a in candidates.items():
            w = p.split(" ")
            inside = re.compile(r"(^| )" + re.escape(p) + r"( |$)")
            if any(len(q.split(" ")) > len(w) and inside.search(q) and 100 * b >= held * a for q, b in candidates.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            kept.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


PHRASE = "alpha beta gamma, Beta gamma delta. "
HAND = ([(PHRASE * 12, "en"), (PHRASE * 12, "en"), ("x" * 50 + " y\t z\r\n y z " * 15, None), ("y z;y z " * 6, "und"), (None, "en"), ("", None), (" .,; ", "de"),
         ("one", "de"), ("Café Ä noir   x! " * 11, "fr"), ("a a a a a a a a a a a a a a", "fr"), ("word " * 40_000, "zz")]
        + [("shared passage of many words that stands in each of these texts, with a tail " + str(i), "en") for i in range(40)])


@pytest.mark.parametrize("chunk_words", [1, 16])
def test_hand_made_texts(spark, chunk_words):
    df = spark.createDataFrame([(t, g, 1, "p") for t, g in HAND], "text string, lang string, n int, phrase string")
    got = collocations.collocations(df, chunk_words=chunk_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert _rows(got) == _brute(HAND)


def test_few_bits_and_longer_phrases_change_nothing_but_the_work(spark):
    df = spark.createDataFrame(HAND, "text string, lang string")
    assert _rows(collocations.collocations(df, bits=1 << 15, top=3)) == _brute(HAND, top=3)
    assert _rows(collocations.collocations(df, max_words=4, least=12)) == _brute(HAND, least=12, max_words=4)


def test_parse_keeps_every_word_and_shares_chunks(spark):
    passage = " ".join(f"w{i}" for i in range(200))
    df = spark.createDataFrame([(f"a{i} b{i} {passage} c{i}", "en") for i in range(50)], "text string, lang string")
    chunks = collocations.parse(df).collect()
    assert sum(r["words"] * r["n"] for r in chunks) == 50 * 203
    assert sum(r["n"] == 50 for r in chunks) > 5                       # the passage's inner chunks, once each
    assert all(0 <= len(r["chunk"].split()) - r["words"] <= (0 if r["last"] else 2) for r in chunks)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_query_equals_sql_and_brute_force(spark, duck_small):
    got = _rows(QUERIES["op13_prefix_free_phrases"](spark, SF001))
    assert got == sorted(duck_small.execute(collocations.ORACLE_SQL).fetchall())
    assert got == _brute([(r["text"], r["lang"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()])
