"""Session set-up, intermediate tables and table readers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.config import checkpoint_dir, prepare_session

WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches bound a Python worker's memory whatever the texts' length."""
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> F.Column:
    """The column of this very name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def n_words(column) -> F.Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")
