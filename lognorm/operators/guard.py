"""Checks on raw records before anything else: size limit, hash, decoding, envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.functions.payload import decode_utf8, fingerprint_of, raw_sha256

MAX_BYTES = 65_536


def size_guard(df: DataFrame, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): disjoint and together all records. A record of exactly ``max_bytes`` is kept,
    one without payload is dropped."""
    kept = F.coalesce(F.octet_length("raw") <= max_bytes, F.lit(False))
    return df.filter(kept), df.filter(~kept)


def with_payload(df: DataFrame) -> DataFrame:
    """Adds the hash of the bytes and the decoded text."""
    return df.withColumns({"raw_sha256": raw_sha256(F.col("raw")), "payload": decode_utf8(F.col("raw"))})


def with_envelope(df: DataFrame) -> DataFrame:
    """Adds raw_data, raw_data_hash and raw_data_size, keeping every other column."""
    hashed = df if "raw_sha256" in df.columns else with_payload(df)
    return hashed.withColumns({
        "raw_data": F.col("payload"),
        "raw_data_hash": fingerprint_of(F.col("raw_sha256")),
        "raw_data_size": F.octet_length("raw").cast("long"),
    })


def verify_envelope(df: DataFrame) -> DataFrame:
    """Rows whose stored hash is not the hash of their bytes, or is missing; must be empty."""
    return df.filter(~F.sha2("raw", 256).eqNullSafe(F.col("raw_data_hash.value")))
