"""Join helpers.

No broadcast is forced here. A side is broadcast when Spark knows its bytes to
be small: from a table's or file's size when the query is planned, or from what
a shuffle stage wrote when it runs (AQE). Dimensions that are expensive to derive
are written first (`sinks.tables.replicated_table`), so that their size is known.
Beyond the threshold joins are shuffled and AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                    how: str = "inner") -> DataFrame:
    """Join a fact to a one-column key dimension that supplies no output.

    The dimension acts as a membership filter. `inner` keeps the semantics as
    written (a duplicated dimension key duplicates fact rows); `left_semi`
    gives the same rows when the key is unique and never duplicates.
    """
    d = dim.select(F.col(dim_key).alias("__member_key"))
    joined = fact.join(d, fact[fact_key] == d["__member_key"], how)
    return joined.drop("__member_key") if how != "left_semi" else joined
