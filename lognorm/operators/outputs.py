"""From validated records to sinks: events, dead letters, history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lognorm.operators.validate import INVALID, LATE, NO_PAYLOAD, OVERSIZE, SUCCESS, UNMATCHED, error_text
from lognorm.schema import CLASS_FIELDS, UNKNOWN_CLASS, UNMATCHED_PARSER, UNMATCHED_TEXT, VALIDATION_PREFIX
from lognorm.sources.parsers import ParserDef

REASONS = {UNMATCHED: "unmatched", INVALID: "ocsf_validation_failed", OVERSIZE: "oversize", NO_PAYLOAD: "null_payload", LATE: "late"}
_TEXTS = {UNMATCHED: UNMATCHED_TEXT, OVERSIZE: "The payload is longer than allowed.", NO_PAYLOAD: "There is no payload.",
          LATE: "The record came after its time had been decided."}
SINK_MODES = ("stdout", "jsonl", "parquet")


def split_outputs(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters): disjoint and together all records."""
    return df.filter(F.col("status") == SUCCESS), df.filter(F.col("status") != SUCCESS)


def stage_outputs(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """``split_outputs`` over one written copy, so the records are processed once.

    The copy is partitioned by status; each side reads only its own folders.
    """
    df.write.partitionBy("status").mode("overwrite").parquet(path)
    return split_outputs(df.sparkSession.read.parquet(path))


def event_json(df: DataFrame) -> DataFrame:
    """One JSON text per event; absent members are left out."""
    return df.select(F.to_json("event").alias("value"))


def class_view(events: DataFrame, ocsf_class: str) -> DataFrame:
    """Events of one class with the columns that class has."""
    names = [*CLASS_FIELDS[ocsf_class], "type_uid"]
    class_uid = {"base_event": 0, "authentication": 3002, "network_activity": 4001}[ocsf_class]
    return events.select("event.*").filter(F.col("class_uid") == class_uid).select(*names)


def event_aliases(df: DataFrame) -> DataFrame:
    """Adds ``raw_payload`` and ``raw_sha256`` as read from the event itself."""
    return df.withColumns({
        "raw_payload": F.col("event.raw_data"), "raw_sha256": F.col("event.raw_data_hash.value"),
    })


def utc_text(ts: Column, pattern: str) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), pattern)


def dlq_records(df: DataFrame) -> DataFrame:
    """Dead letters of a validated frame: the four stored fields, reason, parser and UTC day."""
    dead = df.filter(F.col("status") != SUCCESS)
    invalid, status = F.col("status") == INVALID, F.col("status")
    of = lambda texts: F.create_map(*[F.lit(x) for pair in texts.items() for x in pair])[status]
    return dead.select(
        utc_text(F.col("ingest_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        "raw_sha256",
        F.when(invalid, error_text(F.col("errors"))).otherwise(of(_TEXTS)).alias("error"),
        F.col("payload").alias("raw_payload"),
        of(REASONS).alias("reason"),
        "parser",
        utc_text(F.col("ingest_ts"), "yyyy-MM-dd").alias("dlq_date"),
    )


def history(
    df: DataFrame, defs: list[ParserDef], message_chars: int | None = None, payload_chars: int | None = None
) -> DataFrame:
    """One record per processed line, whatever became of it; texts are whole unless a length is given."""
    cut = lambda text, n: text if n is None else F.left(text, F.lit(n))
    ok = F.col("status") == SUCCESS
    classes = F.lit(UNKNOWN_CLASS)
    for parser_id, d in reversed(list(enumerate(defs))):
        classes = F.when(F.col("parser_id") == parser_id, d.ocsf_class).otherwise(classes)
    reason = cut(F.substr(error_text(F.col("errors")), F.lit(len(VALIDATION_PREFIX) + 1)), message_chars)
    return df.select(
        "ingest_ts",
        "status",
        F.coalesce("parser", F.lit(UNMATCHED_PARSER)).alias("parser"),
        F.when(ok, F.col("event.type_uid")).alias("type_uid"),
        classes.alias("ocsf_class"),
        F.when(ok, F.col("event.severity_id")).otherwise(0).alias("severity"),
        F.when(ok, F.coalesce("event.message", F.lit("")))
        .when(F.col("status") == INVALID, reason).otherwise("").alias("message"),
        "raw_sha256",
        cut(F.col("payload"), payload_chars).alias("raw_payload"),
    )


# ------------------------------------------------------------------ sinks


def choose_sink(mode: str) -> str:
    if mode not in SINK_MODES:
        raise ValueError(f"sink mode is one of {SINK_MODES}")
    return {"stdout": "console", "jsonl": "text", "parquet": "parquet"}[mode]


def write_events(events: DataFrame, mode: str = "jsonl", path: str | None = None) -> None:
    """Append events: JSON lines, a parquet table, or printed."""
    sink = choose_sink(mode)
    if sink == "console":
        event_json(events).show(truncate=False)
    elif sink == "text":
        event_json(events).write.mode("append").text(path)
    else:
        events.select("event.*").write.mode("append").parquet(path)


def write_dlq_daily(dlq: DataFrame, path: str) -> None:
    """Append dead letters as JSON lines, one folder per UTC day.

    Rebalancing by day keeps the file count low and still splits a day that holds most rows.
    """
    fields = ["timestamp", "raw_sha256", "error", "raw_payload", "reason", "parser", "dlq_date"]
    dlq.select(*fields).hint("rebalance", "dlq_date").write.partitionBy("dlq_date").mode("append").json(path)


def foreach_sink(df: DataFrame, sink: Callable[[DataFrame, int], None]) -> None:
    """A custom sink is any function of (frame, batch id); batch jobs use id 0."""
    sink(df, 0)
