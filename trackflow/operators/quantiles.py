"""Exact percentiles with linear interpolation from a histogram of integer values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.operators.ordered import Ordered
from trackflow.session import cut


def percentiles(
    histogram: DataFrame, group: str, value: str, count: str, at: dict[str, float],
    max_group_rows: int,
) -> DataFrame:
    """Per group: size, total and the named percentiles of ``value`` repeated ``count`` times.

    The histogram has one row per (group, value), already combined before any exchange. Its
    running counts go through ``Ordered``, so neither a group with most of the rows nor one with
    very many distinct values ends up in one task or one aggregation buffer.
    """
    histogram = cut(histogram)  # small, and read several times
    totals = histogram.groupBy(F.col(group).alias("_group")).agg(
        F.sum(count).alias("_size"), F.sum(F.col(value) * F.col(count)).alias("_total")
    )
    rows = Ordered.by_key(histogram, group, value, max_group_rows)
    rows = rows.sum_since(None, _upto=F.col(count)).rows()
    rows = rows.join(totals, F.col(group) == F.col("_group"))
    picks, ends = {}, []
    for name, p in at.items():
        rank = (F.col("_size") - 1) * F.lit(float(p))
        at_rank = (F.col("size") - 1) * F.lit(float(p))
        picks[f"_lo_{name}"] = F.col("_upto") > F.floor(rank)
        picks[f"_hi_{name}"] = F.col("_upto") > F.ceil(rank)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        ends.append((lo + (hi - lo) * (at_rank - F.floor(at_rank))).alias(name))
    picked = rows.groupBy(group).agg(
        F.first("_size").alias("size"), F.first("_total").alias("total"),
        *[F.min(F.when(inside, F.col(value))).alias(k) for k, inside in picks.items()],
    )
    return picked.select(group, "size", "total", *ends)
