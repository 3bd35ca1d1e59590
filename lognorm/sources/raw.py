"""Raw records: ``raw BINARY, ingest_ts TIMESTAMP, source STRING``.

Bytes are never decoded on the way in, so the hash is that of the original input.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _stamp(ingest_ts: datetime | None) -> Column:
    """One fixed time for all records and all jobs that read them; the present, if none is given."""
    return F.lit(ingest_ts or datetime.now(timezone.utc)).cast("timestamp")


def read_log_lines(spark: SparkSession, path: str, ingest_ts: datetime | None = None) -> DataFrame:
    """One record per line. Only ``\\n`` ends a line, so a lone ``\\r`` stays in the record."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("raw"),
        _stamp(ingest_ts).alias("ingest_ts"),
        F.col("_metadata.file_path").alias("source"),
    )


def read_log_blob(spark: SparkSession, path: str, ingest_ts: datetime | None = None) -> DataFrame:
    """One record per file."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("content").alias("raw"), _stamp(ingest_ts).alias("ingest_ts"), F.col("path").alias("source"),
    )


def read_json_events(spark: SparkSession, path: str, encoding: str = "UTF-16") -> DataFrame:
    """A file that holds one JSON array: a row per element. Anything but an array is refused.

    A row that is no object surfaces as an error, not as a null row.
    """
    if _first_character(spark, path, encoding) != "[":
        raise ValueError(f"{path}: a JSON array is needed")
    return (
        spark.read.option("multiLine", True).option("encoding", encoding)
        .option("mode", "FAILFAST").json(path)
    )


def _first_character(spark: SparkSession, path: str, encoding: str) -> str:
    head = (
        spark.read.format("binaryFile").load(path)
        .select(F.substring("content", 1, 64).alias("head")).first()
    )
    text = bytes(head["head"])[:64].decode(encoding, errors="ignore")
    return text.lstrip("\ufeff \t\r\n")[:1]


def replicate(df: DataFrame, n: int = 2) -> DataFrame:
    """The records ``n`` times over."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_copy")


def to_payload(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Adds ``raw``: each row as one JSON object, UTF-8 encoded."""
    whole = F.to_json(F.struct(*(cols or df.columns)), {"ignoreNullFields": "false"})
    return df.withColumn("raw", F.encode(whole, "UTF-8"))
