"""Staging intermediate results where every executor can read them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from callcredit.session import ensure_checkpoint_dir

BATCH_CONF, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def staged(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as files in the shared checkpoint folder.

    The files survive lost executors, and every later use reads the same rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def texts_in_small_batches(spark) -> None:
    """Has whole texts cross to Python workers a few megabytes at a time.

    Spark's default allows 64 MB a batch, which the executor and the worker
    both hold. Batches with one longer text are as large as that text. A limit
    that the session has set itself stays.
    """
    if spark.conf.get(BATCH_CONF, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, "4m")


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
