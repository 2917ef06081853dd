"""Data-quality checks: conflicting positions, null ratios, ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackflow.config import DEFAULTS, Settings
from trackflow.operators.quantiles import percentiles

REQUIRED = {"taxi_id", "latitude", "longitude", "timestamp"}
NANO = 1_000_000_000  # differences are compared to a billionth of a degree


def require_columns(df: DataFrame, names: set[str] = REQUIRED) -> DataFrame:
    missing = names - set(df.columns)
    if missing:
        raise ValueError(f"missing required columns: {sorted(missing)}")
    return df


def conflict_rows(df: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Rows whose (taxi, time) occurs with more than one latitude or longitude.

    Two distinct values exist exactly if minimum and maximum differ, which combines on the map
    side, so no group of copies is ever gathered.
    """
    require_columns(df)
    seen = df.groupBy(F.col("taxi_id").alias("_t"), F.col("timestamp").alias("_s")).agg(
        *[f(c).alias(f"_{f.__name__}_{c}") for c in ("latitude", "longitude") for f in (F.min, F.max)]
    )
    differ = (F.col("_min_latitude") < F.col("_max_latitude")) | (
        F.col("_min_longitude") < F.col("_max_longitude")
    )
    keys = seen.where(differ).select("_t", "_s")
    same = (F.col("taxi_id") == F.col("_t")) & (F.col("timestamp") == F.col("_s"))
    return df.join(keys, same, "left_semi")


def conflict_counts(conflicts: DataFrame, *keys: str) -> DataFrame:
    return conflicts.groupBy(*keys).agg(F.count(F.lit(1)).alias("conflict_row_count"))


def conflict_summary(conflicts: DataFrame) -> DataFrame:
    """Number of taxis in conflict and the largest counts per taxi and per (taxi, time)."""
    per_time = conflict_counts(conflicts, "taxi_id", "timestamp")
    per_taxi = per_time.groupBy("taxi_id").agg(
        F.sum("conflict_row_count").alias("rows"), F.max("conflict_row_count").alias("most")
    )
    return per_taxi.agg(
        F.count(F.lit(1)).alias("conflicted_taxis"),
        F.max("rows").alias("max_rows_per_taxi"),
        F.max("most").alias("max_rows_per_time"),
    )


def taxis_with_count(conflicts: DataFrame, rows: int) -> DataFrame:
    counts = conflict_counts(conflicts, "taxi_id")
    return counts.where(F.col("conflict_row_count") == rows).select("taxi_id")


def conflict_diffs(conflicts: DataFrame, order: str = "seq") -> DataFrame:
    """Absolute differences of the first two rows of each (taxi, time).

    ``row_number <= 2`` becomes a group limit before any exchange: two rows per key and task.
    """
    place = F.row_number().over(Window.partitionBy("taxi_id", "timestamp").orderBy(order))
    firsts = conflicts.select("taxi_id", "timestamp", "latitude", "longitude", order)
    firsts = firsts.withColumn("_place", place).where(F.col("_place") <= 2)
    first, second = F.col("_place") == 1, F.col("_place") == 2

    def gap(c: str):
        return F.abs(F.max(F.when(first, F.col(c))) - F.max(F.when(second, F.col(c))))

    diffs = firsts.groupBy("taxi_id", "timestamp").agg(
        gap("latitude").alias("lat_diff"), gap("longitude").alias("lon_diff")
    )
    return diffs.na.drop()


def describe_diffs(diffs: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """count, mean, std, min, quartiles and max of both differences, one row each."""
    long = diffs.select("lat_diff", "lon_diff").unpivot([], ["lat_diff", "lon_diff"], "field", "diff")
    long = long.withColumn("nano", F.round(F.col("diff") * NANO).cast("bigint"))
    counts = long.groupBy("field", "nano").agg(F.count(F.lit(1)).alias("c"))
    at = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    quartiles = percentiles(counts, "field", "nano", "c", at, cfg.max_group_rows)
    moments = long.groupBy(F.col("field").alias("_f")).agg(
        F.count("diff").alias("count"),
        F.round(F.avg("diff"), 6).alias("mean"),
        F.round(F.stddev_samp("diff"), 6).alias("std"),
        F.round(F.min("diff"), 6).alias("min"),
        F.round(F.max("diff"), 6).alias("max"),
    )
    out = moments.join(quartiles, F.col("_f") == F.col("field"))
    return out.select(
        "field", "count", "mean", "std", "min",
        *[F.round(F.col(q) / NANO, 6).alias(q) for q in at], "max",
    )


def null_ratio(df: DataFrame) -> DataFrame:
    """Share of nulls per column, from one aggregate."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return shares.unpivot([], df.columns, "column", "null_ratio")


def coord_range(df: DataFrame) -> DataFrame:
    return df.agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("longitude", "latitude") for f in (F.max, F.min)]
    )


def with_point(df: DataFrame) -> DataFrame:
    return df.withColumn("point", F.struct("latitude", "longitude"))
