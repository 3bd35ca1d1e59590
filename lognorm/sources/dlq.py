"""Dead letters back as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lognorm.schema import DLQ


def read_dlq(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; with day folders (``dlq_date=...``) a date filter prunes whole days."""
    return spark.read.schema(DLQ).json(path)
