"""The whole batch job: raw records to validated records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.operators.dedup import dedup_window
from lognorm.operators.guard import MAX_BYTES, size_guard, with_payload
from lognorm.operators.normalize import normalize
from lognorm.operators.validate import NO_PAYLOAD, OVERSIZE, validate
from lognorm.sources.parsers import ParserDef


def process(
    raw: DataFrame,
    defs: list[ParserDef],
    dedup_seconds: float | None = 300,
    enum_mode: str = "code",
    unmapped_mode: str = "merge",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """size guard -> hash -> dedup -> route -> extract -> map -> validate; adds ``status``.

    Dedup runs before any regex, so repeated lines are never parsed. Records that are too long
    or have no payload skip all that and come out with status ``oversize`` or ``null_payload``:
    processed and duplicates together are what was taken in.
    """
    kept, dropped = size_guard(raw, max_bytes)
    if dedup_seconds is not None:
        kept = dedup_window(kept, dedup_seconds)
    return with_dropped(normalize_records(kept, defs, enum_mode, unmapped_mode), dropped)


def guarded_records(
    raw: DataFrame, defs: list[ParserDef], enum_mode: str = "code", unmapped_mode: str = "merge", max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``process`` without dedup: what a stream does to each micro-batch."""
    kept, dropped = size_guard(raw, max_bytes)
    return with_dropped(normalize_records(kept, defs, enum_mode, unmapped_mode), dropped)


def with_dropped(done: DataFrame, dropped: DataFrame, status: str | None = None) -> DataFrame:
    """Adds what was turned away, with a status that says why (by default that of the size guard); nothing else is set."""
    why = F.when(F.col("raw").isNull(), NO_PAYLOAD).otherwise(OVERSIZE) if status is None else F.lit(status)
    known = with_payload(dropped).withColumn("status", why)
    return done.unionByName(known.select(*[
        F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in done.schema]))


def normalize_records(
    records: DataFrame, defs: list[ParserDef], enum_mode: str = "code", unmapped_mode: str = "merge"
) -> DataFrame:
    """The per-record part, the same in batch and stream."""
    normalized = normalize(with_payload(records), defs, enum_mode, unmapped_mode, fenced=False)
    return validate(normalized, defs, enum_mode)
