"""Latency analytics.

The upper median of the benchmark is an exact order statistic found by
distributed selection, never by sorting all timings in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators.profile import bracket_columns, order_statistics


def latency_summary(timed: DataFrame, intent: str = "intent", time_col: str = "inference_time_ms") -> DataFrame:
    """N, percent not ``PARSE_ERROR``, mean, min, max."""
    return timed.agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg(F.when(F.col(intent).eqNullSafe("PARSE_ERROR"), 0.0).otherwise(1.0)) * 100.0).alias("success_pct"),
        F.avg(time_col).alias("mean_ms"),
        F.min(time_col).alias("min_ms"),
        F.max(time_col).alias("max_ms"),
    )


def latency_benchmark(times: DataFrame, time_col: str = "inference_time_ms") -> DataFrame:
    """Mean, upper median (sorted[n div 2]), min, max, population std,
    queries per second (1000 / mean, null for a mean of 0) of the times present."""
    spark = times.sparkSession
    value = F.col(time_col).cast("double")
    present = times.select(F.lit("t").alias("column_name"), F.when(~F.isnan(value), value).alias("value")).where("value is not null")
    basic = present.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_pop("value").alias("std"),
        bracket_columns(F.col("value"), (0.5,)).alias("bracket"),
    ).first()
    n = basic["n"]
    median = None
    if n:
        at = ("t", n // 2)
        median = order_statistics(present, [at], {at: tuple(basic["bracket"])}, {"t": (basic["min"], basic["max"])})[at]
    row = (n, basic["mean"], median, basic["min"], basic["max"], basic["std"])
    df = spark.createDataFrame([row], "n bigint, mean double, median double, min double, max double, std double")
    return df.select(
        "n",
        F.col("mean").alias("mean_ms"),
        F.col("median").alias("median_ms"),
        F.col("min").alias("min_ms"),
        F.col("max").alias("max_ms"),
        F.col("std").alias("std_ms"),
        F.try_divide(F.lit(1000.0), F.col("mean")).alias("queries_per_second"),
    )


def batch_average_latency(times: DataFrame, batch: str = "batch_id", time_col: str = "inference_time_ms") -> DataFrame:
    """Per batch, total time divided by the number of texts."""
    return times.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(time_col).alias("total_ms"),
        F.avg(time_col).alias("avg_ms"),
    )
