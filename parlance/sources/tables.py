"""Readers and writers.

Readers always give an explicit schema or column list so that Parquet
column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UTTERANCE_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("intent", T.StringType()),
        T.StructField("nli_output", T.StringType()),
        T.StructField("frequency", T.LongType()),
    ]
)

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("intent", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("input_text", T.StringType()),
        T.StructField("output_text", T.StringType()),
        T.StructField("frequency", T.LongType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One driver table; with ``columns`` only those are read (pruned scan)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> str:
    """``df`` as a table at ``path``, bucketed and sorted by ``key``; returns the table's (new) name in the catalog.

    Tables of one key and number of buckets join and group on the key without an
    exchange: the shuffle is paid once, here, with one file per bucket.
    ``buckets`` is the session's number of shuffle partitions unless given.
    Null keys are kept and share a bucket; an empty table keeps its columns.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
    writer.format("parquet").option("path", path).saveAsTable(name)
    return name


def scan_utterances(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw utterance table with a fixed schema (no inference).

    A ``row_id`` column is required in the files; the reference matched rows
    by position, which a distributed table does not have.
    """
    reader = spark.read.schema(UTTERANCE_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.format(fmt).load(path)


def scan_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """One split written as CSV; values hold commas, quotes and JSON."""
    return (
        spark.read.schema(PAIR_SCHEMA)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def scan_split_partition(spark: SparkSession, root: str, split: str) -> DataFrame:
    """S3: one split of a ``partitionBy('split')`` table; partition pruning."""
    return spark.read.parquet(root).where(F.col("split") == split)


def sink_splits(df: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Write all splits at once, one folder per split."""
    writer = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        writer.option("header", True).option("quoteAll", True).option("escape", '"').csv(root)
    else:
        writer.parquet(root)


def sink_sample(df: DataFrame, path: str, n: int = 20) -> None:
    """First ``n`` rows by ``row_id`` to one CSV file."""
    (
        df.orderBy("row_id").limit(n).coalesce(1).write.mode("overwrite")
        .option("header", True).option("escape", '"').csv(path)
    )


def sink_json(df: DataFrame, path: str) -> None:
    """Small result documents as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)


def ingest_text_batch(requests: DataFrame, texts_col: str = "texts") -> DataFrame:
    """A request's list of texts becomes one row per text with its position."""
    rest = [c for c in requests.columns if c != texts_col]
    return requests.select(*rest, F.posexplode(texts_col).alias("position", "text"))
