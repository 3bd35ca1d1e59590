"""Byte-level functions: decoding, hashing, the fingerprint object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_utf8(raw: Column) -> Column:
    """Bytes to text; every malformed sequence becomes U+FFFD, nothing is lost or raised."""
    return F.make_valid_utf8(raw.cast("string"))


def raw_sha256(raw: Column) -> Column:
    """Lower-case hex SHA-256 of the bytes as they came in, before any decoding."""
    return F.sha2(raw, 256)


def fingerprint(raw: Column) -> Column:
    return fingerprint_of(raw_sha256(raw))


def fingerprint_of(sha256_hex: Column) -> Column:
    return F.struct(
        F.lit("SHA-256").alias("algorithm"),
        F.lit(3).cast("long").alias("algorithm_id"),
        sha256_hex.alias("value"),
    )
