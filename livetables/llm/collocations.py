"""Phrase collocations, counted on a prefix-free parse.

Parse. A text is lower-cased (A-Z), cut into pieces and those into words. Where
the hash of a window of `max_words - 1` words is a multiple of `chunk_words`, a new
chunk begins; a chunk runs on to the end of the next chunk's window, so that
consecutive chunks overlap by `max_words - 1` words. Where chunks begin follows from the
words alone, so equal passages fall into equal chunks wherever they stand, and a
corpus becomes a dictionary of distinct chunks with their frequencies. A phrase of
up to `max_words` words belongs to the chunk in which it begins before the
overlap (in a text's last chunk: anywhere), so each occurrence is counted once:
f(phrase) is the sum over distinct chunks of frequency x occurrences, exactly.

Levels. Phrases of m words are counted level by level. An occurrence is left out
only if one of its two parts of m - 1 words is known to have fewer than `least`
occurrences: then the phrase has fewer too and is no candidate. Parts that have
enough are marked in a bit table of fixed size (`bits`, 16 MB, whatever the
corpus); a phrase that passes by a shared bit is counted like any other and falls at
its own count. All counts are grouped by the phrase's text, so no hash decides a count.

Score. Cutting a candidate after its first k words gives l = f(first part), r =
f(rest) and the score floor(scale * a * a / (l * r)) in 38-digit integers; the
lowest-scoring cut counts. A candidate is dropped if a longer one that holds it has
at least `held_percent` per cent of its occurrences. Each language's best `top` are returned.

Plan. One narrow pass over the texts and one shuffle of chunks, counted in each task
first (a passage that a third of all documents share is one row per task); a
narrow pass over the dictionary per level, each with one shuffle of counts. A
language's ranking is made in two steps, first in shares of its candidates, then over
the best of every share, so that a large language isn't sorted in one task.

Defined results: a null text counts as empty, a null language as `und`; texts
without words count nothing; very long texts are whole; repeated rows count each
time; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livetables.llm.byte_words import buffers, byte_table, spans, words_of, xxh64
from livetables.llm.common import col, ship_package, text_or_empty, written

_BREAKS = byte_table(b".,;:!?\x0a\x0b\x0c\x0d")
_BETWEEN = _BREAKS | byte_table(b"\x20\x09")
_BLOCK = 1 << 15                       # bits of a row of the bit table
COUNTS = "lang string, phrase string, f long"


def parse(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, chunk_words: int = 16) -> DataFrame:
    """The dictionary: lang, chunk, last (a text's last chunk), words (that begin in it), n (its frequency).

    In a chunk words are followed by a space, or by a line feed at the end of a piece.
    """
    ship_package(df.sparkSession)
    overlap = max_words - 1
    rows = df.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                     text_or_empty(text_col).cast("binary").alias("t"))

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(part.column(1), _BETWEEN)
        if not len(words.begin):
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.string(), pa.string(), pa.bool_(), pa.int64())],
                                              names=["lang", "chunk", "last", "words"])
        # a gap holds a break, or a text ends there
        breaks = np.append(0, np.cumsum(_BREAKS[words.raw]))
        old_begin = words.old_end - (words.end - words.begin)
        broken = np.append(breaks[old_begin[1:]] > breaks[words.old_end[:-1]], True)
        has = np.flatnonzero(np.diff(words.first))
        text_begin, text_end = words.first[has], words.first[has + 1]
        broken[text_end - 1] = True
        words.data[words.end[broken]] = 10
        h = xxh64(words.data, words.begin, words.end)
        with np.errstate(over="ignore"):
            window = h.copy()
            for j in range(1, overlap):
                window[:-j] = window[:-j] * np.uint64(0x9E3779B97F4A7C15) + h[j:]
        starts = (window >> np.uint64(17)) % np.uint64(chunk_words) == 0
        starts[text_begin] = True
        begin = np.flatnonzero(starts)
        text = np.searchsorted(text_begin, begin, side="right") - 1
        last = np.append(text[1:] != text[:-1], True)
        stop = np.append(begin[1:], len(h))                         # words from here on belong to the next chunk
        end = np.minimum(np.where(last, stop, stop + overlap), text_end[text])
        return pa.RecordBatch.from_arrays([part.column(0).take(pa.array(has[text])), spans(words.data, words.begin[begin], words.end[end - 1] + 1),
                                           pa.array(last), pa.array(stop - begin)], names=["lang", "chunk", "last", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 32):
                yield cut(batch.slice(at, 32))
    made = rows.mapInArrow(run, "lang string, chunk string, last boolean, words long")
    return written(made.groupBy("lang", "chunk", "last", "words").agg(F.count(F.lit(1)).alias("n")), "phrase-chunks")


def _bit_table(counts: DataFrame, bits: int) -> np.ndarray:
    """A table of `bits` bits (as bytes) with the bits of the phrases in `counts` set."""
    place = F.xxhash64("lang", "phrase").bitwiseAND(F.lit(bits - 1))
    rows = (counts.select(F.shiftright(place, 15).alias("block"), place.bitwiseAND(F.lit(_BLOCK - 1)).alias("bit"))
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())       # at most bits / 2^15 rows of 4 KB
    table = np.zeros(bits // 8, np.uint8)
    for row in rows:
        table[row["block"] * _BLOCK // 8:(row["block"] + 1) * _BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return table


def _counted(chunks: DataFrame, size: int, parts: np.ndarray | None, bits: int, least: int) -> DataFrame:
    """lang, phrase, f of the phrases of `size` words with at least `least` occurrences; `parts`: bits of those of size - 1."""
    shared = chunks.sparkSession.sparkContext.broadcast(parts)        # bits / 8 bytes

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = buffers(part.column(1))
        data = np.append(raw, np.zeros(8, np.uint8))                    # room for reading eight bytes at a time
        end = np.flatnonzero((raw == 32) | (raw == 10))                 # one after each word
        begin = np.append(0, end + 1)[:-1]
        first = np.searchsorted(end, offsets)
        chunk = np.repeat(np.arange(part.num_rows), np.diff(first))
        counted = part.column(2).to_numpy(zero_copy_only=False)
        at = np.arange(len(chunk))
        at = at[(at - first[chunk] < counted[chunk]) & (at + size <= first[chunk + 1])]
        if size > 1:
            broken = np.append(0, np.cumsum(raw[end] == 10))
            at = at[broken[at + size - 1] == broken[at]]
        table = shared.value
        if table is not None and len(at):
            langs = part.column(0).dictionary_encode()
            seeds = np.array([xxhash.xxh64_intdigest(x, 42) for x in langs.dictionary.to_pylist()], np.uint64)
            seeds = seeds[langs.indices.to_numpy(zero_copy_only=False)]
            # the parts begin at a kept phrase or at the word after
            enough = np.zeros(len(chunk) + 1, bool)
            enough[at] = enough[at + 1] = True
            begins = np.flatnonzero(enough)
            place = (xxh64(data, begin[begins], end[begins + size - 2], seeds[chunk[begins]]) & np.uint64(bits - 1)).astype(np.int64)
            enough[begins] = table[place >> 3] >> (place & 7).astype(np.uint8) & 1 != 0
            at = at[enough[at] & enough[at + 1]]
        own = pa.array(chunk[at])
        return pa.RecordBatch.from_arrays([part.column(0).take(own), spans(data, begin[at], end[at + size - 1]),
                                           part.column(3).take(own)], names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                yield count(batch.slice(at, 2048))
    rows = chunks.select("lang", F.col("chunk").cast("binary").alias("chunk"),
                         F.when(F.col("last"), F.lit(1 << 62)).otherwise(F.col("words")).alias("words"), "n")
    made = rows.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return written(made, f"phrases-{size}")


def _part(words: Column, at: int, size: int) -> Column:
    return F.array_join(F.slice(words, at + 1, size), " ")


def collocations(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, least: int = 10,
                 scale: int = 1_000_000, held_percent: int = 50, top: int = 2000, chunk_words: int = 16, bits: int = 1 << 27) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best collocations of 2 to `max_words` words of each language."""
    if max_words < 2 or bits & (bits - 1) or bits < _BLOCK:
        raise ValueError("max_words from 2 on; bits a power of two from 2^15 on")
    spark = df.sparkSession
    chunks = parse(df, text_col=text_col, lang_col=lang_col, max_words=max_words, chunk_words=chunk_words)
    totals = chunks.groupBy("lang").agg(F.sum(F.col("words") * F.col("n")).alias("n"))
    levels = {1: _counted(chunks, 1, None, bits, least)}
    for size in range(2, max_words + 1):
        levels[size] = _counted(chunks, size, _bit_table(levels[size - 1], bits), bits, least)

    def lookup(size: int, name: str) -> DataFrame:
        return levels[size].select("lang", F.col("phrase").alias(f"{name}_part"), F.col("f").alias(name))

    scored = []
    for size in range(2, max_words + 1):
        rows = levels[size].withColumnRenamed("f", "a")
        words = F.split("phrase", " ")
        cuts = []
        for k in range(1, size):
            rows = (rows.withColumn(f"l{k}_part", _part(words, 0, k)).withColumn(f"r{k}_part", _part(words, k, size - k))
                    .join(lookup(k, f"l{k}"), ["lang", f"l{k}_part"]).join(lookup(size - k, f"r{k}"), ["lang", f"r{k}_part"])
                    .drop(f"l{k}_part", f"r{k}_part"))
            whole = {c: F.col(c).cast("decimal(19,0)") for c in ("a", f"l{k}", f"r{k}")}
            score = F.call_function("div", whole["a"] * whole["a"] * F.lit(scale).cast("decimal(10,0)"), whole[f"l{k}"] * whole[f"r{k}"])
            cuts.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        scored.append(rows.select("lang", "phrase", "a", best.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    for size in range(2, max_words):
        holders = [levels[longer].select("lang", _part(F.split("phrase", " "), at, size).alias("phrase"), "f")
                   for longer in range(size + 1, max_words + 1) for at in range(longer - size + 1)]
        holders = reduce(DataFrame.union, holders).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        scored[size - 2] = (scored[size - 2].join(holders, ["lang", "phrase"], "left")
                            .where(F.col("longer").isNull() | (100 * F.col("longer") < held_percent * F.col("a"))).drop("longer"))
    rows = reduce(DataFrame.union, scored)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
    rows = (rows.withColumn("share", share).withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
            .where(F.col("place") <= top))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same over a table `documents`, for the default parameters, in DuckDB's SQL.
ORACLE_SQL = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS p
        FROM documents),
    lists AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
    words AS (SELECT lang, piece, unnest(w) AS w1, unnest(range(len(w))) AS i FROM lists),
    triples AS (
        SELECT lang, w1, lead(w1) OVER own AS w2, lead(w1, 2) OVER own AS w3 FROM words WINDOW own AS (PARTITION BY piece ORDER BY i)),
    grams AS (
        SELECT lang, 1 AS m, w1 AS phrase FROM triples
        UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM triples WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM triples WHERE w3 IS NOT NULL),
    f AS (SELECT lang, m, phrase, lang || chr(10) || phrase AS key, count(*) AS f FROM grams GROUP BY ALL),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
    candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 10),
    cuts AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
    scored AS (
        SELECT c.lang, c.m, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
               (1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score
        FROM cuts c JOIN f l ON l.key = c.lang || chr(10) || array_to_string(c.w[1:c.k], ' ')
                    JOIN f r ON r.key = c.lang || chr(10) || array_to_string(c.w[c.k + 1:], ' ')),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    holders AS (
        SELECT lang, phrase, max(a) AS longer FROM (
            SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE m = 3
            UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE m = 3)
        GROUP BY lang, phrase),
    kept AS (
        SELECT b.* FROM best b LEFT JOIN holders h ON b.lang = h.lang AND b.phrase = h.phrase AND b.m = 2
        WHERE h.longer IS NULL OR 100 * h.longer < 50 * b.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
