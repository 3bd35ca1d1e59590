"""Structured events rendered as payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windows_payload(df: DataFrame) -> DataFrame:
    """Adds ``raw``: the five members the Windows definition looks for, blanks filled in."""
    members = {
        "MachineName": F.coalesce("MachineName", F.lit("UNKNOWN")),
        "EventID": F.coalesce("Id", F.lit(0).cast("long")),
        "Message": F.coalesce("Message", F.lit("")),
        "Source": F.coalesce("ProviderName", F.lit("")),
        "Level": F.coalesce("LevelDisplayName", F.lit("")),
    }
    whole = F.to_json(F.struct(*[c.alias(n) for n, c in members.items()]))
    return df.withColumn("raw", F.encode(whole, "UTF-8"))
