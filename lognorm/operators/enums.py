"""Enum codes and captions as a dimension table of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lognorm.schema import ENUMS


def enum_table(spark: SparkSession) -> DataFrame:
    """``enum, code, caption``: a few dozen rows, whatever the data."""
    rows = ", ".join(f"('{e}', {c}L, '{n}')" for e, codes in ENUMS.items() for c, n in codes.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(enum, code, caption)")


def _codes(spark: SparkSession, enum: str) -> DataFrame:
    return F.broadcast(enum_table(spark).filter(F.col("enum") == enum).select("code", "caption"))


def with_caption(df: DataFrame, column: str, enum: str) -> DataFrame:
    """Adds ``<column>_caption``; null for an unknown code."""
    codes = _codes(df.sparkSession, enum).withColumnRenamed("caption", f"{column}_caption")
    return df.join(codes, F.col(column) == F.col("code"), "left").drop("code")


def invalid_codes(df: DataFrame, column: str, enum: str) -> DataFrame:
    """Rows whose code is given but not in the enum."""
    given = df.filter(F.col(column).isNotNull())
    return given.join(_codes(df.sparkSession, enum), F.col(column) == F.col("code"), "left_anti")
