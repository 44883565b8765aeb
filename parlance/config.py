"""Settings and session preparation.

The values of ``Settings`` are the defaults of the original project's
configuration file; they are data, not tuning knobs.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    # Fixed values of the original configuration (data section, training
    # section, model section).
    train_split: float = 0.7
    val_split: float = 0.15
    test_split: float = 0.15
    random_seed: int = 42
    rare_threshold: int = 3
    batch_size: int = 16
    max_input_length: int = 128
    max_output_length: int = 256
    vocab_size: int = 32128
    save_every: int = 1
    # Engine parameters (not from the original project).
    # Hex digits of the md5 used as the rank bucket; 16**k buckets per group.
    rank_bucket_hex_digits: int = 4

    @property
    def val_ratio(self) -> float:
        """Share of the second cut, computed exactly as the reference does."""
        return self.val_split / (self.train_split + self.val_split)


DEFAULT = Settings()


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the run-time options every job here relies on.

    * duplicate JSON keys: last one wins, as in Python's ``json.loads``;
    * AQE on, so small aggregates become broadcast joins at run time and
      skewed partitions are split.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the context's checkpoint directory or the cluster's
    ``spark.checkpoint.dir``. Only a local master, where driver and executors
    are one process, may do without: there a fresh temporary folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all nodes of {sc.master} share")
        configured = tempfile.mkdtemp(prefix="parlance-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table, under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
