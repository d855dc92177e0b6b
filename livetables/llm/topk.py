"""Exact top-k inner products by a three-phase uniform threshold.

A score is a sum over `lists` groups of dimensions; each group is a list of
local scores. Local scores are shifted to be non-negative by the smallest one
that the list has for the query.

1. Gather: every group of candidates sends, per query, the `k` best totals among the
   best entries of each list, and each list's smallest local score. The k-th best total
   t of a query is a safe cutoff.
2. Broadcast the cutoff, one number per query (it travels with the query block):
   a candidate whose shifted local scores are all below (t - sum of shifts) /
   lists can't reach t. Each block collects the others, the sufficient entries.
3. Resolve: their remaining scores are added exactly, totals below t are dropped,
   and the k best of each query are kept, in each group and then over all groups.

Plan. Candidates and queries are packed into blocks of integer matrices. Blocks are
dealt to cells of a grid, some query blocks against some candidate blocks each: a query
block is sent once to every group of candidates, a candidate block once to every group of
queries, by a shuffle to the cell's own partition, never by a join, so nothing of them
passes the driver whatever size Spark expects. A task holds the query blocks of its
cell and takes the candidate blocks one after the other; work is spread evenly whatever
the values. Queries are a stated set against all rows. Gathered and resolved entries are
at most `k` a query and cell.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part; shorter vectors count as padded with zeros; rows that repeat
an id are candidates each, and queries each, for every row but themselves; ties go to the smaller id; fewer
than k candidates give fewer rows; an empty table gives an empty result.
Scores are exact integers whatever the components: past 2^53 the phases work with
rounded scores and a margin for their error, and what they find is added up in whole
numbers. A component or score that a long can't hold is an error that says so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livetables.llm.common import col, ship_package, written


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float, is_query: Column) -> DataFrame:
    """key (of the row), id, asked, v (array of long): floor(scale * component), valid vectors only."""
    v = col(vec_col)
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                                                     & (F.abs(x.cast("double")) < float("inf")))

    def whole(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < 2.0 ** 63, F.floor(y)).otherwise(F.raise_error(F.concat(F.lit("a long can't hold the component "), x.cast("string"))))
    return (df.where(fine & col(id_col).isNotNull())
            .select(F.monotonically_increasing_id().alias("key"), col(id_col).cast("long").alias("id"),
                    F.coalesce(is_query, F.lit(False)).alias("asked"), F.transform(v, whole).alias("v")))


def _blocks(vectors: DataFrame, rows: int, dims: int, kind: str, name: str) -> tuple[DataFrame, int]:
    """block, ids (bytes of the keys), names (bytes of the ids), matrix (bytes of integer rows); about `rows` vectors a block.
    And the number of blocks, 0 if there are no vectors."""
    count = -(-vectors.count() // rows)
    placed = vectors.select("key", "id", "v", F.pmod(F.xxhash64("key"), F.lit(max(1, count))).cast("int").alias("block"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        matrix = np.zeros((len(group), dims), kind)
        for i, v in enumerate(group["v"]):
            matrix[i, :len(v)] = v
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "ids": [group["key"].to_numpy("<i8").tobytes()],
                             "names": [group["id"].to_numpy("<i8").tobytes()], "matrix": [matrix.tobytes()]})
    return written(placed.groupBy("block").applyInPandas(pack, "block int, ids binary, names binary, matrix binary"), name), count


#: Bytes of query blocks, and of candidate blocks, that meet in a cell at most (one block each at least).
_CELL_BYTES = 1 << 24
#: Cells have a partition each, up to so many partitions; then several cells share one.
_CELL_TASKS = 4096


def _side(n_q: int, n_c: int, block_bytes: int, cores: int) -> int:
    """Blocks a cell has of either side: many, so that blocks are sent seldom, but few enough for four cells a core."""
    return max(1, min(_CELL_BYTES // max(1, block_bytes), math.isqrt(n_q * n_c // (4 * cores))))


def _cells(queries: list[DataFrame], candidates: DataFrame, n_q: int, n_c: int, side: int) -> DataFrame:
    """Every query block with every candidate block, in one cell each: the rows of a cell follow each other, first those of
    `queries` (tables with a block each), then those of the candidates. part: the place of a row's table among them."""
    rows, groups = -(-n_q // side), -(-n_c // side)

    def dealt(df: DataFrame, part: int, times: int, cell) -> DataFrame:
        return df.withColumn("part", F.lit(part)).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("cell", cell)
    out = dealt(candidates, len(queries), rows, F.col("cell") * groups + F.col("block") % groups)
    for i, q in enumerate(queries):
        out = out.unionByName(dealt(q, i, groups, (F.col("block") % rows) * groups + F.col("cell")), allowMissingColumns=True)
    return out.repartitionById(min(rows * groups, _CELL_TASKS), "cell").sortWithinPartitions("cell", "part", "block")


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[Iterator[tuple]]:
    """The rows of each cell."""
    rows = (row for batch in batches for row in batch.itertuples(index=False))
    return (own for _, own in groupby(rows, lambda row: row.cell))


def _local(q_row, c_row, dims: int, kind: str, lists: int, step: int) -> Iterator[tuple]:
    """Per few queries: their positions and ids, candidate ids, a score matrix (query, candidate) for each list, and
    a margin: how far a total of these scores can be from the true one (0 where all are exact)."""
    c_ids, q_ids = np.frombuffer(c_row.ids, "<i8"), np.frombuffer(q_row.ids, "<i8")
    c = np.frombuffer(c_row.matrix, kind).reshape(-1, dims)
    q = np.frombuffer(q_row.matrix, kind).reshape(-1, dims)
    # the narrowest floats that hold every sum of products exactly
    largest = _largest(c) * _largest(q) * dims
    c, q = (x.astype("f4" if largest < 2 ** 24 else "f8") for x in (c, q))
    margin = 0.0 if largest < 2 ** 53 else largest * (dims + lists + 4) * 2.0 ** -52
    cuts = np.linspace(0, dims, lists + 1).astype(int)
    for at in range(0, len(q_ids), step):
        part = q[at:at + step]
        yield slice(at, at + step), q_ids[at:at + step], c_ids, [part[:, x:y] @ c[:, x:y].T for x, y in zip(cuts, cuts[1:])], margin


def _largest(x: np.ndarray) -> float:
    return max(float(x.max(initial=0)), -float(x.min(initial=0)))


def _whole(q_row, c_row, dims: int, kind: str, q: np.ndarray, c: np.ndarray) -> list[int]:
    """Exact inner products of some pairs (places in the blocks)."""
    a = np.frombuffer(q_row.matrix, kind).reshape(-1, dims)[q].astype(object)
    b = np.frombuffer(c_row.matrix, kind).reshape(-1, dims)[c].astype(object)
    out = (a * b).sum(axis=1).tolist() if len(a) else []
    if any(abs(x) >= 1 << 63 for x in out):
        raise ValueError(f"a long can't hold the score {max(out, key=abs)}")
    return out


def _first(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k best entries of each query: greatest score, then smallest name, then smallest id. found: at, score, name, id."""
    at, score, name, key = found
    order = np.lexsort((key, name, -score, at))
    at = at[order]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    place = np.arange(len(at))
    order = order[place - np.maximum.accumulate(np.where(new, place, 0)) < k]
    return [x[order] for x in found]


def top_k(df: DataFrame, k: int, is_query: Column, *, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0, lists: int = 4, block_rows: int = 4096, step: int = 32) -> DataFrame:
    """query_id, rank, <id_col>, score: the k best other rows of each query row, by integer inner product."""
    ship_package(df.sparkSession)
    vectors = written(integer_vectors(df, id_col, vec_col, scale, is_query), "topk-vectors")
    dims, low, high = vectors.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    none = "query_id long, rank int, " + f"`{id_col}` long, score long"
    if not dims:
        return df.sparkSession.createDataFrame([], none)
    lists = min(lists, dims)
    kind = next((f"<i{n}" for n in (2, 4) if -2 ** (8 * n - 1) <= low and high < 2 ** (8 * n - 1)), "<i8")
    candidates, n_c = _blocks(vectors, block_rows, dims, kind, "topk-candidates")
    queries, n_q = _blocks(vectors.where("asked"), block_rows, dims, kind, "topk-queries")
    if not n_q:
        return df.sparkSession.createDataFrame([], none)
    side = _side(n_q, n_c, block_rows * dims * int(kind[2]), df.sparkSession.sparkContext.defaultParallelism)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _rows(batches):
            asked = []                                         # of each query block: its row, best totals, least scores
            for row in rows:
                if row.part == 0:
                    n = len(row.ids) // 8
                    asked.append((row, np.full((n, k), -np.inf), np.full((n, lists), np.inf)))
                    continue
                for q_row, totals, leasts in asked:
                    for part, q_ids, c_ids, scores, margin in _local(q_row, row, dims, kind, lists, step):
                        least = np.stack([s.min(axis=1) for s in scores], axis=1).astype("f8")
                        take = min(k + 1, len(c_ids))          # the query itself may be among them
                        best = np.concatenate([np.argpartition(-s, take - 1, axis=1)[:, :take] for s in scores], axis=1)
                        best.sort(axis=1)
                        total = sum(np.take_along_axis(s, best, 1).astype("f8") for s in scores) - margin      # never above the true one
                        total[:, 1:][best[:, 1:] == best[:, :-1]] = -np.inf
                        total[c_ids[best] == q_ids[:, None]] = -np.inf
                        total = np.concatenate([totals[part], total], axis=1)
                        totals[part] = np.partition(total, total.shape[1] - k, axis=1)[:, -k:]
                        leasts[part] = np.minimum(leasts[part], least - margin)
            for q_row, totals, leasts in asked:
                yield pd.DataFrame({"block": q_row.block, "at": np.arange(len(totals)), "totals": list(totals), "least": list(leasts)})
    gathered = written(_cells([queries], candidates, n_q, n_c, side)
                       .mapInPandas(gather, "block int, at long, totals array<double>, least array<double>"), "topk-gathered")
    by_total = Window.partitionBy("block", "at").orderBy(F.col("total").desc())
    cutoffs = (gathered.select("block", "at", F.explode("totals").alias("total")).where(F.col("total") > float("-inf"))
               .withColumn("r", F.row_number().over(by_total)).where(F.col("r") <= k)
               .groupBy("block", "at").agg(F.when(F.count(F.lit(1)) >= k, F.min("total")).alias("t")))
    shifts = (gathered.groupBy("block", "at").agg(*[F.min(F.col("least")[i]).alias(f"l{i}") for i in range(lists)])
              .select("block", "at", F.array(*[f"l{i}" for i in range(lists)]).alias("least")))
    # the cutoffs go out with the query blocks
    told = shifts.join(cutoffs, ["block", "at"], "left").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "t", "least"))).alias("x"))
    told = told.select("block", F.col("x.t").alias("t"), F.col("x.least").alias("least"))

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _rows(batches):
            asked, bars, kept = {}, {}, {}
            for row in rows:
                if row.part == 0:
                    asked[row.block] = row
                    continue
                if row.part == 1:
                    cutoff = np.array([-np.inf if x is None or x != x else x for x in row.t], "f8")
                    shift = np.array(list(row.least), "f8").reshape(-1, lists)
                    bar = shift + ((cutoff - shift.sum(axis=1)) / lists)[:, None] - 0.25        # scores are integers
                    bars[row.block] = cutoff, bar
                    continue
                names = np.frombuffer(row.names, "<i8")
                for block, q_row in asked.items():
                    cutoff, bar = bars[block]
                    found = [kept[block]] if block in kept else []
                    for part, q_ids, c_ids, scores, margin in _local(q_row, row, dims, kind, lists, step):
                        known = scores[0] >= bar[part, 0, None] - margin
                        for s, b in zip(scores[1:], bar[part].T[1:]):
                            known |= s >= b[:, None] - margin
                        q, c = np.nonzero(known)
                        total = sum(s[q, c].astype("f8") for s in scores)
                        enough = (total >= cutoff[part][q] - margin) & (q_ids[q] != c_ids[c])
                        q, c, total = q[enough], c[enough], total[enough]
                        if len(q):
                            score = np.array(_whole(q_row, row, dims, kind, q + part.start, c), "i8") if margin else total.astype("i8")
                            found.append(_first([q + part.start, score, names[c], c_ids[c]], k))
                    if found:
                        kept[block] = _first([np.concatenate(x) for x in zip(*found)], k)
            for block, (at, score, name, key) in kept.items():
                yield pd.DataFrame({"query_id": np.frombuffer(asked[block].ids, "<i8")[at], "of": np.frombuffer(asked[block].names, "<i8")[at],
                                    "id": key, "name": name, "score": score})
    found = (_cells([queries, told], candidates, n_q, n_c, side)
             .mapInPandas(resolve, "query_id long, of long, id long, name long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "name", "id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(F.col("of").alias("query_id"), "rank", F.col("name").alias(id_col), "score")
