"""Load-time quantiles that merge: a sketch for each minute, merged to hours and days.

The exact percentiles need all value counts of a period. A sketch (KLL) keeps about ``k`` values of
a minute, and sketches merge without the events. The rank of the value it names differs from the
rank asked for by at most ``rank_error(k)`` of the views, with a confidence of 99 %; up to ``k``
views nothing is left out and it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D

K = 800


def rank_error(k: int = K) -> float:
    """The sketch's stated error of a rank, as a share of the views."""
    return 2.296 / k**0.9021


def minute_states(events: DataFrame, k: int = K) -> DataFrame:
    """One sketch per minute, tenant and page: its size does not grow with the views beyond a few ``k`` values."""
    return events.groupBy(D.trunc_minute(F.col("event_timestamp")).alias("metric_minute"), "tenant_id", "page_name").agg(
        F.count("load_time_ms").alias("page_views"), F.kll_sketch_agg_bigint(F.col("load_time_ms").cast("bigint"), F.lit(k)).alias("state")
    )


def merged_states(states: DataFrame, period: Column, name: str, k: int = K) -> DataFrame:
    """Coarser states: minutes to hours or days, or any of these to a longer period."""
    return states.groupBy(period.alias(name), "tenant_id", "page_name").agg(F.sum("page_views").alias("page_views"), F.kll_merge_agg_bigint("state", F.lit(k)).alias("state"))


def quantiles(states: DataFrame, names: dict[str, float]) -> DataFrame:
    """The states with a column for each quantile; null where a state has no views."""
    seen = F.col("page_views") > 0
    return states.withColumns({name: F.when(seen, F.kll_sketch_get_quantile_bigint("state", F.lit(q))) for name, q in names.items()})


def rank_bounds(events: DataFrame, estimates: DataFrame, period: Column, name: str, column: str) -> DataFrame:
    """For each estimate, the shares of the period's views that lie below it (``rank_from``) and at or below it (``rank_to``):
    the ranks that the value truly has."""
    keys = [name, "tenant_id", "page_name"]
    counted = events.filter(F.col("load_time_ms").isNotNull()).groupBy(period.alias(name), "tenant_id", "page_name", "load_time_ms").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(estimates.select(*keys, column), keys)
    return joined.groupBy(*keys).agg(
        (F.sum(F.when(F.col("load_time_ms") < F.col(column), F.col("n")).otherwise(0)) / F.sum("n")).alias("rank_from"),
        (F.sum(F.when(F.col("load_time_ms") <= F.col(column), F.col("n")).otherwise(0)) / F.sum("n")).alias("rank_to"),
    )
