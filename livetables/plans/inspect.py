"""Read a DataFrame's physical plan: exchanges, joins, pushed filters, scans.

Used by the plan tests to pin the plans the operators are meant to produce.
After an action the plan shown is AQE's final plan.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def tree(df: DataFrame) -> str:
    """The operator tree part of the formatted plan."""
    text = plan_text(df)
    return text.split("\n\n\n", 1)[0]


def count_nodes(df: DataFrame, node: str) -> int:
    return len(re.findall(rf"(?<![A-Za-z]){re.escape(node)}\b", tree(df)))


def shuffle_exchanges(df: DataFrame) -> int:
    """Exchange nodes that shuffle (broadcasts excluded)."""
    return len(re.findall(r"(?<!Broadcast)Exchange\b", tree(df)))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*>)", plan_text(df))


def summary(df: DataFrame) -> dict[str, int]:
    """Counts of the plan features that matter at scale."""
    return {
        "shuffles": shuffle_exchanges(df),
        "broadcast_joins": count_nodes(df, "BroadcastHashJoin"),
        "sort_merge_joins": count_nodes(df, "SortMergeJoin"),
        "hash_aggregates": count_nodes(df, "HashAggregate"),
        "sort_aggregates": count_nodes(df, "SortAggregate"),
        "python_evals": len(re.findall(r"(BatchEvalPython|ArrowEvalPython)", plan_text(df))),
    }
