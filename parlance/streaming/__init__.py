"""Stateless operators on a streaming DataFrame.

The original has no streaming operators; the per-row ones (annotation
parsing, training-pair formatting, output parsing and repair, response shaping)
are plain projections, so they run unchanged on ``spark.readStream``, as the
service repaired one request at a time.  Nothing here keeps state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parlance.operators.annotations import preprocess
from parlance.operators.outputs import parse_outputs, response_record
from parlance.sources.tables import UTTERANCE_SCHEMA


def stream_training_pairs(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Training pairs (P5) of utterance files as they arrive in ``source_dir``."""
    src = (
        spark.readStream.schema(UTTERANCE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )
    return preprocess(src)


OUTPUT_SCHEMA = "row_id long, raw string"


def stream_responses(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Parsed, repaired and shaped (P13-P17) model outputs as their files arrive in ``source_dir``."""
    src = spark.readStream.schema(OUTPUT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)
    return response_record(parse_outputs(src, "raw", "single"))
