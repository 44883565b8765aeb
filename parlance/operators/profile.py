"""Generic table profiling.

Works on any DataFrame.  Per-column statistics are computed on an unpivoted
``(column_name, value)`` table with partial aggregation, so a hot value or a
wide table never meets in one task; only per-column result tables (one row
per column, or at most ``max_distinct`` values per column) are windowed.

Exact quartiles (A7) use distributed selection instead of Spark's exact
``percentile`` (which buffers a group's values in one task): a mergeable KLL
sketch, taken in the pass of the other statistics, brackets every wanted rank;
the next pass counts what lies below a bracket and in its buckets; only a bucket
with several values is looked at once more.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def column_category(dt: T.DataType) -> str:
    """``string``, ``numeric`` or ``other``."""
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, NUMERIC):
        return "numeric"
    return "other"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if column_category(f.dataType) == "string"]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if column_category(f.dataType) == "numeric"]


def select_columns_by_type(df: DataFrame) -> DataFrame:
    """one row per column with its category."""
    spark = df.sparkSession
    rows = [(i + 1, f.name, column_category(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position bigint, column_name string, category string")


def dataset_shape(df: DataFrame) -> DataFrame:
    """A1: rows, columns, and each column's name and type."""
    spark: SparkSession = df.sparkSession
    cols = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    schema = spark.createDataFrame(cols, "position bigint, column_name string, data_type string")
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return schema.crossJoin(n).withColumn("n_cols", F.lit(len(cols)).cast("bigint"))


def _named(c: str) -> Column:
    """The column of this very name, dots included."""
    return F.col("`" + c.replace("`", "``") + "`")


def _present(df: DataFrame, c: str) -> Column:
    """The column with NaN as null and one zero: what counts as a value."""
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(_named(c)), _named(c) + F.lit(0.0).cast(df.schema[c].dataType))
    return _named(c)


def _stacked(one: DataFrame, cols: list[str], name: str) -> DataFrame:
    """The single row of ``one``, whose i-th column is about ``cols[i]``, as rows ``(column_name, name)``."""
    each = [F.struct(F.lit(c).alias("column_name"), F.col(one.columns[i]).alias(name)) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*each)))


def _long(df: DataFrame, cols: list[str], value_type: str = "string") -> DataFrame:
    """Unpivot ``cols`` to ``(column_name, value)``; values cast to one type."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), _present(df, c).cast(value_type).alias("value")) for c in cols])
        ).alias("kv")
    ).select("kv.column_name", "kv.value")


def null_counts(df: DataFrame) -> DataFrame:
    """A2: missing values (null, NaN) per column, only columns that have some."""
    sums = df.agg(*[F.sum(_present(df, c).isNull().cast("bigint")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return _stacked(sums, df.columns, "n_null").where(F.col("n_null") > 0)


def drop_null_text(df: DataFrame, col: str) -> DataFrame:
    """rows where ``col`` is present."""
    return df.where(_named(col).isNotNull())


def distinct_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: distinct non-null values per column (partial aggregation).

    Long values are shuffled as their MD5, so a row costs the same whatever its texts.
    """
    cols = cols or df.columns
    value = F.when(F.octet_length("value") > 32, F.concat(F.lit("md5:"), F.md5("value"))).otherwise(F.concat(F.lit("="), F.col("value")))
    long = _long(df, cols).where(F.col("value").isNotNull()).select("column_name", value.alias("value"))
    return long.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A4: rows per value of ``col``, nulls excluded."""
    return df.where(_named(col).isNotNull()).groupBy(_named(col)).agg(F.count(F.lit(1)).alias("n"))


def categorical_profile(df: DataFrame, max_distinct: int = 100, k: int = 10) -> DataFrame:
    """A5 + K2: string columns with fewer than ``max_distinct`` values: their
    number of distinct values and the ``k`` most frequent values (ties by value).

    Distinct-count sketches, gathered in one pass, tell the columns that cannot
    stay under the limit (estimates of twice as much; those of so few values are
    all but exact): their values are dropped before the shuffle.
    """
    cols = string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column_name string, n_distinct bigint, value string, n bigint, rank bigint"
        )
    sketches = df.agg(*[F.approx_count_distinct(_named(c), 0.02).alias(f"c{i}") for i, c in enumerate(cols)])
    few = _stacked(sketches, cols, "about").where(F.col("about") < 2 * max_distinct).select("column_name")
    long = _long(df, cols).where(F.col("value").isNotNull()).join(F.broadcast(few), "column_name", "left_semi")  # at most len(cols) rows
    counts = long.groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    per_col = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")).where(
        F.col("n_distinct") < max_distinct
    )
    small = counts.join(F.broadcast(per_col), "column_name")  # at most len(cols) rows
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value"))
    return (
        small.withColumn("rank", F.row_number().over(w).cast("bigint"))
        .where(F.col("rank") <= k)
        .select("column_name", "n_distinct", "value", "n", "rank")
    )


def text_column_profile(df: DataFrame, min_avg: float = 10.0) -> DataFrame:
    """String columns whose mean length over present values exceeds ``min_avg``."""
    cols = string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, avg_length double")
    avgs = df.agg(*[F.avg(F.length(_named(c)).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    return _stacked(avgs, cols, "avg_length").where(F.col("avg_length") > min_avg)


def text_samples(df: DataFrame, order_col: str, k: int = 3, n_chars: int = 100, min_avg: float = 10.0) -> DataFrame:
    """K8 + P18: first ``k`` present values of each text column (A6), cut to
    ``n_chars`` characters.  ``row_number() <= k`` gets a window group limit.
    """
    cols = [r["column_name"] for r in text_column_profile(df, min_avg).collect()]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, rank bigint, preview string")
    long = df.select(
        order_col,
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _named(c).alias("value")) for c in cols])).alias("kv"),
    ).select(order_col, "kv.column_name", "kv.value").where(F.col("value").isNotNull())
    w = Window.partitionBy("column_name").orderBy(order_col)
    return (
        long.withColumn("rank", F.row_number().over(w).cast("bigint"))
        .where(F.col("rank") <= k)
        .select("column_name", "rank", text_preview("value", n_chars).alias("preview"))
    )


def text_preview(col, n: int = 100):
    """First ``n`` characters."""
    c = F.col(col) if isinstance(col, str) else col
    return F.left(c, F.lit(n))


def head_rows(df: DataFrame, n: int = 5, order_col: str = "row_id") -> DataFrame:
    """K1: first ``n`` rows by ``order_col`` (top-k, no full sort)."""
    return df.orderBy(order_col).limit(n)


# --- exact quantiles by distributed selection ----------------------------------------


#: How far from a rank, as a share of all, the values lie that bracket it; several times the sketch's error.
MARGIN = 0.01
SKETCH = 1024
LARGEST = 1.7976931348623157e308


def bracket_columns(value: Column, probs: tuple[float, ...]) -> Column:
    """For an aggregate: values that bracket the ranks at ``probs``, two each, from one KLL sketch."""
    ends = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-MARGIN, MARGIN)]
    found = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, SKETCH), F.array(*[F.lit(e) for e in ends]))
    return F.when(F.count(value) > 0, found)


def order_statistics(
    long: DataFrame,
    targets: list[tuple[str, int]],
    brackets: dict[tuple[str, int], tuple[float, float]],
    bounds: dict[str, tuple[float, float]],
    buckets: int = 4096,
    small: int = 100_000,
):
    """Exact ``k``-th smallest (0-based) ``value`` per ``column_name``.

    ``long`` is ``(column_name, value double)`` without nulls; ``targets`` is
    a short list of ``(column_name, k)``, ``brackets`` holds two values around
    each and ``bounds`` the least and largest of a column. Returns
    ``{(column_name, k): value}``. A scan of ``long`` counts per interval what
    lies below it and in its buckets (partial aggregation). A rank outside its
    interval is looked for on that side, so a bad bracket costs a scan and no
    exactness. A bucket with one distinct value answers at once; one with at
    most ``small`` rows is ranked directly, any other is the next interval.
    Infinite values have buckets of their own. Only per-target rows reach the driver.
    """
    spark = long.sparkSession
    state = {t: brackets[t] for t in targets}
    done: dict[tuple[str, int], float] = {}
    while state:
        # Ranks that share an interval share its histogram; only the short list of intervals is joined to the rows.
        spans = sorted({(c, *ends) for (c, _), ends in state.items()})
        sdf = F.broadcast(spark.createDataFrame(spans, "column_name string, lo double, hi double"))
        tdf = F.broadcast(spark.createDataFrame([(c, k, *ends) for (c, k), ends in state.items()], "column_name string, k bigint, lo double, hi double"))
        inside = long.join(sdf, "column_name").where(F.col("value") <= F.col("hi"))
        first, last = (F.least(F.greatest(F.col(c), F.lit(-LARGEST)), F.lit(LARGEST)) / 2 for c in ("lo", "hi"))
        place = F.try_divide(F.col("value") / 2 - first, last - first) * buckets
        b = (
            F.when(F.col("value") < F.col("lo"), -1).when(F.col("value") == F.col("lo"), 0).when(F.col("value") == float("inf"), buckets + 1)
            .when(F.col("value") == float("-inf"), 0).otherwise(F.least(F.floor(F.coalesce(place, F.lit(0.0))) + 1, F.lit(buckets)))
        )
        agg = inside.groupBy("column_name", "lo", "hi", b.cast("int").alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("bmin"), F.max("value").alias("bmax")
        )
        w = Window.partitionBy("column_name", "lo", "hi").orderBy("b")
        agg = agg.withColumn("before", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        chosen = agg.join(tdf, ["column_name", "lo", "hi"]).where((F.col("before") <= F.col("k")) & (F.col("k") < F.col("before") + F.col("n"))).collect()
        # Ranks that no bucket holds lie above their interval.
        nxt = {(c, k): (hi, bounds[c][1]) for (c, k), (_, hi) in state.items()}
        finals = []
        for r in chosen:
            key = (r["column_name"], r["k"])
            del nxt[key]
            if r["bmin"] == r["bmax"]:
                done[key] = r["bmin"]
            elif r["b"] >= 0 and r["n"] <= small:
                finals.append((*key, r["bmin"], r["bmax"], r["k"] - r["before"]))
            else:
                nxt[key] = (r["bmin"], r["bmax"])
        if finals:
            fdf = F.broadcast(spark.createDataFrame(finals, "column_name string, k bigint, lo double, hi double, krel bigint"))
            rows = long.join(fdf, "column_name").where(F.col("value").between(F.col("lo"), F.col("hi")))
            wr = Window.partitionBy("column_name", "k").orderBy("value")
            hit = rows.withColumn("rn", F.row_number().over(wr) - 1).where(F.col("rn") == F.col("krel"))
            for r in hit.collect():
                done[(r["column_name"], r["k"])] = r["value"]
        state = nxt
    return done


QUARTILES = (0.25, 0.5, 0.75)


def _between(a: float, b: float, part: float) -> float:
    """Linear interpolation; exact at either end, without overflow between values of opposite sign."""
    if part == 0 or a == b:
        return a
    return a + (b - a) * part if math.isfinite(b - a) or not (math.isfinite(a) and math.isfinite(b)) else a * (1 - part) + b * part


def numeric_describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear interpolation), max; infinities are values."""
    spark = df.sparkSession
    schema = "column_name string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    cols = cols or numeric_columns(df)
    if not cols:
        return spark.createDataFrame([], schema)
    long = _long(df, cols, "double").where(F.col("value").isNotNull())
    basic = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        bracket_columns(F.col("value"), QUARTILES).alias("brackets"),
    ).collect()
    plan, brackets = {}, {}
    for r in basic:
        c, n = r["column_name"], r["count"]
        for i, p in enumerate(QUARTILES):
            pos = p * (n - 1)
            lo = math.floor(pos)
            hi = min(lo + 1, n - 1)
            plan[c, p] = (lo, hi, pos - lo)
            brackets |= {(c, k): tuple(r["brackets"][2 * i : 2 * i + 2]) for k in (hi, lo)}
    stats = order_statistics(long, sorted(brackets), brackets, {r["column_name"]: (r["min"], r["max"]) for r in basic})
    out = []
    for r in basic:
        at = [plan[r["column_name"], p] for p in QUARTILES]
        quartiles = [_between(stats[r["column_name"], lo], stats[r["column_name"], hi], part) for lo, hi, part in at]
        out.append((r["column_name"], r["count"], r["mean"], r["std"], r["min"], *quartiles, r["max"]))
    return spark.createDataFrame(out, schema)
