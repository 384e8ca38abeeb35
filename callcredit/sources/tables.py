"""Reading the job's inputs from storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import SCHEMAS


def read_inputs(spark: SparkSession, base_path: str, fmt: str = "parquet",
                names=None) -> dict[str, DataFrame]:
    """Read every input ``<base_path>/<name>`` with its declared schema.

    Scans are lazy: each mart only touches the columns and rows it needs, and
    its time bounds reach the Parquet reader as pushed filters.
    """
    out = {}
    for name in names or SCHEMAS:
        out[name] = spark.read.format(fmt).schema(SCHEMAS[name]).load(f"{base_path.rstrip('/')}/{name}")
    return out
