"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled (by a hash of their id) into a stream of
up to `max_repeats` epochs. A copy of a document gets the virtual finish time
    (words of its source up to and including it) / (weight of its source).
Serving copies in that order gives each source its share of the words; a source
whose stream ends leaves its share to the others. The queue is cut where the
words served reach the budget.

Plan. How many words are served by virtual time v depends only on the sources'
totals (sum of min(repeats * size, weight * v)), so the cut is found from the
per-source table by a water-filling window; no running total over all rows is
needed. Finish times need a running total inside each source: a source with n
documents is split into about sqrt(n) hash ranges, the ranges' totals are summed
up in a window of sqrt(n) rows, and the documents of a range in a window of
sqrt(n) rows. So a source that holds a third of all rows is no hot task.

The copy that is being served at the cut stays if at least half of it is
served, so each source is within half a document of its target.

Defined results: a null text has no words; documents without words are never
taken; a null source is a source of its own, last in the order; a null id is
shuffled like an empty one; repeated rows are separate documents (rows equal in
id and size swap places without effect); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livetables.llm.common import col, written

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def fair_targets(totals: DataFrame, weights: Sequence[float], *, max_repeats: int = 3) -> DataFrame:
    """source, source_size, n -> those with src (rank), weight, target (words).

    The budget is the sum of all sizes. Targets are weight * level, at most
    max_repeats * source_size; the level is where they sum up to the budget.
    One row per source: a small table.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (totals.withColumn("src", F.row_number().over(by_source))
              .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 (F.col("src") - 1) % len(weights) + 1))
              .withColumn("most", (F.col("source_size") * max_repeats).cast("double"))
              .withColumn("ratio", F.col("most") / F.col("weight")))
    levels = (ranked
              .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
              .withColumn("w_full", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("budget", F.sum("source_size").over(everything).cast("double"))
              .withColumn("w_all", F.sum("weight").over(everything))
              .withColumn("level", (F.col("budget") - F.col("full")) / (F.col("w_all") - F.col("w_full"))))
    # the first source (in the order of filling up) that isn't full at its own level
    cut = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "src", "level"))).over(everything)
    return (levels.withColumn("cut", cut["level"])
            .select("source", "source_size", "n", "src", "weight", "cut",
                    F.least(F.col("most"), F.col("weight") * F.col("cut")).alias("target")))


def schedule(df: DataFrame, weights: Sequence[float], *, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", max_repeats: int = 3, seed: str = "mix",
             columns: Sequence[str] | None = None) -> DataFrame:
    """Per row of `df`: row (struct of `columns`, default all), size, source_size,
    target, finish (the virtual finish times of the copies taken; may be empty)."""
    kept = F.struct(*[col(c) for c in (df.columns if columns is None else columns)])
    docs = df.select(
        kept.alias("row"), col(source_col).alias("source"), word_count(text_col).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("key"))
    # cut the hash space of 32 bits into ranges; the narrow copy serves both levels of totals
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    narrow = docs.select("source", "size", place.alias("place"))
    totals = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = written(fair_targets(totals, weights, max_repeats=max_repeats), "mix-targets")
    ranges = F.ceil(F.sqrt("n"))
    part = F.floor(F.col("place") * ranges / F.lit(float(2 ** 32)))

    def placed(rows: DataFrame) -> DataFrame:
        t = targets.withColumnRenamed("source", "s")
        return rows.join(t, rows["source"].eqNullSafe(t["s"])).withColumn("part", part)

    upto = (Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = (placed(narrow).groupBy("src", "part").agg(F.sum("size").alias("part_size"))
              .withColumn("start", F.coalesce(F.sum("part_size").over(upto), F.lit(0)))
              .select("src", "part", "start"))
    inside = (Window.partitionBy("src", "part").orderBy("key", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    served = (placed(docs.withColumn("place", place)).withColumn("upto", F.sum("size").over(inside))
              .join(starts, ["src", "part"])
              .withColumn("upto", F.col("upto") + F.col("start")))
    epochs = F.array(*[
        F.when(F.col("upto") + e * F.col("source_size") - F.col("size") / 2 <= F.col("target"),
               (F.col("upto") + e * F.col("source_size")) / F.col("weight")) for e in range(max_repeats)])
    finish = F.when(F.col("size") > 0, F.array_compact(epochs)).otherwise(F.array().cast("array<double>"))
    return served.select("row", "size", "source_size", "target", finish.alias("finish"))


def mix(df: DataFrame, weights: Sequence[float], **options) -> DataFrame:
    """The mixed corpus: a row (all columns of `df`) for each copy taken, range-sorted by finish time."""
    copies = schedule(df, weights, **options).select("row", F.explode("finish").alias("finish"))
    return copies.orderBy("finish").select("row.*")
