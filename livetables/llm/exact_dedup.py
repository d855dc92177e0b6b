"""Exact duplicates: group by a 128-bit content hash, compare the bytes inside each group.

Plan. Rows are grouped on (hash, text): the text in the grouping key is the
byte comparison, and the partial aggregate folds the copies that a task holds
before anything is shuffled, so a text that a third of all rows share costs one
row per task. The groups are written without their texts. Rows then find their
group by the 16-byte hash alone; AQE splits the join on a hot hash. Only hashes
that two different texts share (checked on the written groups) go through a
join that carries the texts.

Defined results: a null text counts as empty; empty texts are equal; a null id
is kept only if no row of its group has an id; rows that repeat an id and its
text are one document, so both say `kept` and `keep_rows` returns one of them (if other columns
differ, the one with the smallest digest of all columns, so that reruns agree);
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livetables.llm.common import col, hex_sha256, text_or_empty, written


def md5_128(text: Column) -> Column:
    """The 128-bit content hash, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _groups(keyed: DataFrame, keep: str) -> DataFrame:
    choose = {"min": F.min, "max": F.max}[keep]
    return (keyed.groupBy("h", "t").agg(choose("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
            .select("h", "t", "keep_id", "n", hex_sha256(F.col("t")).alias("sha")))


def _colliding(groups: DataFrame) -> DataFrame:
    """Hashes that more than one text has."""
    return groups.groupBy("h").count().where("count > 1").select("h")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "min",
                 normalise: Callable[[Column], Column] = lambda c: c,
                 content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    `keep` says which id of a group stays: "min" (default) or "max".
    `normalise` maps the text before it is compared. `content_hash` is the
    grouping hash; a weak one gives the same result, only slower.
    """
    text = normalise(text_or_empty(text_col))
    keyed = df.select(col(id_col).alias("id"), text.alias("t")).withColumn("h", content_hash(F.col("t")))
    groups = written(_groups(keyed, keep).drop("t"), "exact-groups")
    clash = written(_colliding(groups), "exact-clashes")
    if clash.isEmpty():
        joined = keyed.select("id", "h").join(groups, "h")
    else:
        single = keyed.select("id", "h").join(groups.join(clash, "h", "left_anti"), "h")
        mixed = keyed.join(clash, "h", "left_semi")
        several = mixed.join(_groups(mixed, keep), ["h", "t"]).drop("t")
        joined = single.unionByName(several)
    return joined.select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "min",
              normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """The rows of `df` that stay, one per distinct text, with all their columns."""
    text = normalise(text_or_empty(text_col))
    rows = df.select(F.struct("*").alias("row"), col(id_col).alias("id"), text.alias("t"))
    # here the full digest names the group: (md5, sha256) after the byte comparison
    staying = written(
        _groups(rows.select("id", "t").withColumn("h", md5_128(F.col("t"))), keep)
        .select("h", "sha", F.col("keep_id").alias("k")), "exact-kept")
    hashed = rows.withColumn("h", md5_128(F.col("t"))).withColumn("sha", hex_sha256(F.col("t"))).drop("t")
    return (hashed.join(staying, (hashed["h"] == staying["h"]) & (hashed["sha"] == staying["sha"])
                        & hashed["id"].eqNullSafe(staying["k"]), "inner")
            .groupBy(hashed["h"], hashed["sha"], "id").agg(F.min_by("row", F.md5(F.to_json("row"))).alias("row")).select("row.*"))
