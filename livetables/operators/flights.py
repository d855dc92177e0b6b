"""Flight rollups: delay per carrier for flights leaving one airport.

Flights whose origin matches a pattern and that had a delay are added up per
carrier, and carriers are named by their description.

Plan: the filters reach the Parquet scan (LIKE '%x%' becomes a pushed
StringContains, `> 0` a pushed comparison). The fact is summed per carrier code
*before* the join (a sum can be split), so whatever the size of the carrier
table the join sees one row per code instead of one per flight, and a carrier
with a third of all flights costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from livetables.functions.expressions import exact_sum


def delay_by_carrier(flights: DataFrame, carriers: DataFrame, *,
                     carrier: str = "UniqueCarrier", origin: str = "Origin",
                     origin_pattern: str = "%SFO%", delay: str = "WeatherDelay",
                     code: str = "CODE", description: str = "DESCRIPTION",
                     out_total: str = "total_delay", out_description: str = "description",
                     limit: int | None = None, sum_scale: int | None = None) -> DataFrame:
    """Total delay per carrier description; `limit` keeps any n groups (no order).

    Integer and decimal delays are added exactly, doubles as doubles. With
    `sum_scale` (delays known to carry at most that many decimals) the sum runs
    as decimal(18, sum_scale), so it does not depend on the order of addition.
    The total is returned as a double.
    """
    flown = flights.where(F.col(origin).like(origin_pattern) & (F.col(delay) > 0))
    dim = carriers.select(F.col(code).alias("__code"), F.col(description).alias(out_description))
    kind = flights.schema[delay].dataType
    if sum_scale is not None:
        total = exact_sum(delay, 18, sum_scale)
    elif isinstance(kind, T.IntegralType):
        total = F.sum(F.col(delay).cast("decimal(19,0)"))
    else:
        total = F.sum(F.col(delay))
    per_code = flown.groupBy(F.col(carrier).alias("__code")).agg(total.alias("__delay"))
    out = (per_code.join(dim, "__code", "inner")
           .groupBy(out_description).agg(F.sum("__delay").cast("double").alias(out_total)))
    out = out.select(out_total, out_description)
    return out.limit(limit) if limit is not None else out


def top_delays(flights: DataFrame, carriers: DataFrame, k: int = 20, **kwargs) -> DataFrame:
    """The k carriers with the most delay (ties broken by description)."""
    out_total = kwargs.get("out_total", "total_delay")
    out_description = kwargs.get("out_description", "description")
    kwargs.pop("limit", None)
    return (delay_by_carrier(flights, carriers, **kwargs)
            .orderBy(F.desc(out_total), F.asc(out_description))
            .limit(k))
