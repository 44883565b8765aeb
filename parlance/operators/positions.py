"""Exact ranks and global positions without a single-partition window.

``row_number() over (partition by g order by k)`` puts a whole group in one
task; with one group holding a third of all rows that does not scale, and a
global order (no partition) is worse.  Here the rank is built from

1. a *bucket* that is monotone in the order key (a prefix of an md5 key, or
   a quantile range of ids), counted per (group, bucket) with partial
   aggregation: a table of at most ``groups x buckets`` rows;
2. the running count of earlier buckets in the group (window over that small
   table);
3. one shuffle of the data on (group, bucket) and ``row_number`` inside each
   bucket, which holds about ``group size / buckets`` rows.

rank = rows in earlier buckets + position inside the bucket.  The result is
exactly the rank of the plain window.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.config import DEFAULT


def seeded_key(row_id: str = "row_id", seed: int | None = None) -> Column:
    """md5 of ``'<seed>:<row_id>'``: the seeded shuffle order (same in DuckDB)."""
    s = DEFAULT.random_seed if seed is None else seed
    return F.md5(F.concat(F.lit(f"{s}:"), F.col(row_id).cast("string")))


def hash_bucket(key: str, digits: int | None = None) -> Column:
    """Leading hex digits of an md5 key; ordering by it is ordering by the key."""
    d = DEFAULT.rank_bucket_hex_digits if digits is None else digits
    return F.substring(F.col(key), 1, d)


def bucket_offsets(keyed: DataFrame, group_cols: list[str], bucket: str = "_bucket") -> DataFrame:
    """Rows per (group, bucket) and the rows of earlier buckets in the group.

    Output ``group_cols, bucket, _n, _before``; at most groups x buckets rows.
    """
    counts = keyed.groupBy(*group_cols, bucket).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group_cols).orderBy(bucket) if group_cols else Window.orderBy(bucket)
    return counts.withColumn(
        "_before",
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )


def rank_with_offsets(
    keyed: DataFrame,
    offsets: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    bucket: str = "_bucket",
    rank_col: str = "rank",
) -> DataFrame:
    """Join the offsets back on (group, bucket) and rank inside each bucket.

    Extra columns of ``offsets`` (besides ``_n`` and ``_before``) are kept.
    """
    extra = [c for c in offsets.columns if c not in (*group_cols, bucket, "_n", "_before")]
    joined = keyed.join(offsets.drop("_n"), [*group_cols, bucket], "inner")
    inner = Window.partitionBy(*group_cols, bucket).orderBy(*order_cols)
    rank = (F.col("_before") + F.row_number().over(inner)).cast("bigint")
    return joined.select(*keyed.columns, *extra, rank.alias(rank_col)).drop(bucket)


def exact_rank(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    bucket: Column,
    rank_col: str = "rank",
) -> DataFrame:
    """Add ``rank_col``: 1-based rank of each row in its group by ``order_cols``.

    ``bucket`` must be non-decreasing in ``order_cols``.  ``group_cols`` may be
    empty for a global position.
    """
    keyed = df.withColumn("_bucket", bucket)
    offsets = bucket_offsets(keyed, group_cols)
    return rank_with_offsets(keyed, offsets, group_cols, order_cols, rank_col=rank_col)


def with_id_bucket(df: DataFrame, out: str, row_id: str = "row_id", buckets: int = 4096) -> DataFrame:
    """Add ``out``: a bucket non-decreasing in ``row_id`` with about equal row counts.

    The boundaries are approximate quantiles (one job; at most ``buckets``
    numbers reach the driver), looked up by binary search.  The rank does not
    depend on where they lie.
    """
    cuts = df.select(F.col(row_id).cast("double").alias("_id")).approxQuantile("_id", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    edges = [float("-inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    keyed = df.withColumn("_id", F.col(row_id).cast("double"))
    return Bucketizer(splits=edges, inputCol="_id", outputCol=out).transform(keyed).withColumn(out, F.col(out).cast("int")).drop("_id")
