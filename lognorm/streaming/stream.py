"""Continuous normalisation with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lognorm.operators.outputs import choose_sink, dlq_records, event_json, split_outputs
from lognorm.operators.guard import MAX_BYTES
from lognorm.operators.validate import LATE
from lognorm.plans.batch import guarded_records, with_dropped
from lognorm.schema import RAW_LOGS
from lognorm.sources.parsers import ParserDef
from lognorm.streaming.event_time import EventTimeDedup
from lognorm.streaming.live_metrics import LiveMetrics
from lognorm.streaming.registry import Registry

Sink = Callable[[DataFrame, int], None]
#: Groups of hashes in the state of the dedup.
GROUPS = 1_024
#: What a record takes as an event beside its payload, and what all records of one task may take so.
EVENT_BYTES, TASK_BYTES = 1_000, 256 << 20
_NO_HASH = "0" * 64


def stream_logs(
    spark: SparkSession, path: str, max_files: int | None = None, format: str = "text"
) -> DataFrame:
    """Raw records from a growing folder.

    ``text``: one record per line, stamped on arrival. ``parquet``: files that already hold
    ``raw, ingest_ts, source``.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if format == "parquet":
        return reader.schema(RAW_LOGS).parquet(path)
    return reader.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("raw"),
        F.current_timestamp().alias("ingest_ts"),
        F.col("_metadata.file_path").alias("source"),
    )


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Raw records from Kafka; needs the Kafka connector on the cluster."""
    return spark.readStream.format("kafka").options(**options).load().select(
        F.col("value").alias("raw"), F.col("timestamp").alias("ingest_ts"), F.col("topic").alias("source"))


def dedup_stream(
    df: DataFrame, seconds: int = 300, mode: str = "exact", max_delay_seconds: int = 3600, groups: int = GROUPS
) -> DataFrame:
    """Windowed duplicate removal over a stream, in order of arrival.

    ``exact`` decides each record at once and keeps one timestamp per hash, the last accepted
    one. That is exact for records that arrive in the order of their times, such as those stamped
    on arrival; for others use ``event_time.EventTimeDedup``. ``approximate`` stays in the JVM but
    may drop a repeat that comes later than the window, until the watermark has passed.

    State and Python calls go by groups of hashes, not by hash: a call costs milliseconds, and most
    hashes come once. The records of a group in one micro-batch are decided together, in the order
    of their times, and must fit a task; ``groups`` stays the same for a checkpoint.
    """
    hashed = df.withColumn("raw_sha256", F.sha2("raw", 256))
    if mode == "approximate":
        return hashed.withWatermark("ingest_ts", f"{seconds} seconds").dropDuplicatesWithinWatermark(["raw_sha256"])
    if mode != "exact":
        raise ValueError("mode is exact or approximate")
    window = int(seconds * 1_000_000)
    columns = hashed.columns
    output = T.StructType(list(hashed.schema.fields))

    def first_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows equal in hash and time: only one can be accepted. Shrinks a hot hash before
        # it is shuffled; on arrival a whole micro-batch has one time.
        for batch in batches:
            yield batch.drop_duplicates(["raw_sha256", "ingest_ts"])

    def accept(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = _last_times(*state.get) if state.exists else {}
        rows = pd.concat(list(batches), ignore_index=True).sort_values("ingest_ts", kind="stable")
        times = rows["ingest_ts"].astype("datetime64[us]").astype("int64").tolist()
        keep = []
        for sha256, t in zip(rows["raw_sha256"].tolist(), times, strict=True):
            last = known.get(sha256)
            keep.append(last is None or t - last > window)
            if keep[-1]:
                known[sha256] = t
        if any(keep):
            yield rows.loc[keep, columns]
        # A time may only be forgotten once no record within its window can still arrive.
        closed = state.getCurrentWatermarkMs()
        known = {sha256: t for sha256, t in known.items() if (t + window) // 1000 + 1 > closed}
        if not known:
            state.remove()
            return
        state.update(_as_state(known))
        state.setTimeoutTimestamp(max((max(known.values()) + window) // 1000 + 1, closed + 1))

    shrunk = hashed.mapInPandas(first_of_batch, output)
    return (
        shrunk.withWatermark("ingest_ts", f"{max(max_delay_seconds, seconds)} seconds")
        .withColumn("_group", F.pmod(F.xxhash64("raw_sha256"), F.lit(groups)))
        .groupBy("_group")
        .applyInPandasWithState(accept, output, "hashes binary, times binary", "append", GroupStateTimeout.EventTimeTimeout)
    )


def _as_state(known: dict[str | None, int]) -> tuple[bytes, bytes]:
    """Last accepted times by hash as two columns: 32 and 8 bytes a hash."""
    hashes = b"".join(bytes(32) if h is None else bytes.fromhex(h) for h in known)
    return hashes, np.fromiter(known.values(), np.int64, len(known)).tobytes()


def _last_times(hashes: bytes, times: bytes) -> dict[str | None, int]:
    digits = bytes(hashes).hex()
    keys = (digits[i:i + 64] for i in range(0, len(digits), 64))
    return {None if k == _NO_HASH else k: t for k, t in zip(keys, np.frombuffer(times, np.int64).tolist(), strict=True)}


def run_stream(
    source: DataFrame,
    defs: list[ParserDef] | Registry,
    events_sink: Sink,
    dlq_sink: Sink,
    checkpoint: str,
    trigger: dict | None = None,
    dedup_seconds: int | None = 300,
    enum_mode: str = "code",
    max_bytes: int = MAX_BYTES,
    event_time: EventTimeDedup | None = None,
    live: LiveMetrics | None = None,
) -> StreamingQuery:
    """Start normalising a stream into two sinks. Stop it with ``query.stop()``.

    Each micro-batch is processed once, kept on disk while both sinks write it. A replayed
    batch comes with the same id, so sinks that key their output by it do not repeat rows.

    Duplicates are removed in order of arrival; with ``event_time`` in the order of their times,
    whatever order they arrive in, once the time is closed (``dedup_seconds`` is not used then).
    Late records become dead letters with reason ``late``. ``live`` counts while the stream runs.
    With a ``Registry`` for ``defs`` each micro-batch uses the definitions of its start.
    """
    if live is not None:
        source = live.observe_source(source)
    records = source if dedup_seconds is None or event_time is not None else dedup_stream(source, dedup_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        late = None
        if event_time is not None:
            taken, late = event_time(batch, batch_id)
        else:
            taken = batch.persist()  # guard and dead letters both read it; source and state run once
        current = defs.at(batch_id) if isinstance(defs, Registry) else defs
        done = guarded_records(spread(taken), current, enum_mode, max_bytes=max_bytes)
        done = done if late is None else with_dropped(done, late, LATE)
        seen = None
        if live is not None:
            done, seen = live.observe_records(done, current)
        done = done.persist()
        try:
            if seen is not None:
                done.count()  # whole, whatever the sinks read of it
                live.batch_done(batch_id, seen)
            events, _ = split_outputs(done)
            events_sink(events, batch_id)
            dlq_sink(dlq_records(done), batch_id)
        finally:
            done.unpersist()
            taken.unpersist()

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def spread(batch: DataFrame) -> DataFrame:
    """A micro-batch in tasks of about ``TASK_BYTES`` at most, however few partitions its source has."""
    size = F.coalesce(F.octet_length("raw"), F.lit(0)).cast("long") + EVENT_BYTES
    sizes = batch.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(size).alias("size"))
    found = sizes.agg(F.max("size").alias("most"), F.sum("size").alias("whole")).first()
    if (found["most"] or 0) <= TASK_BYTES:
        return batch
    return batch.repartition(-(-found["whole"] // TASK_BYTES))


def jsonl_sink(path: str) -> Sink:
    """JSON lines, one folder per micro-batch; a replayed batch overwrites its own folder."""
    def write(df: DataFrame, batch_id: int) -> None:
        lines = event_json(df) if "event" in df.columns else df.select(F.to_json(F.struct("*")).alias("value"))
        lines.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def parquet_sink(path: str) -> Sink:
    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.select("event.*") if "event" in df.columns else df
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def stream_events(
    df: DataFrame, mode: str, path: str | None, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the events of a normalised stream to one sink, exactly once for file sinks."""
    sink = choose_sink(mode)
    events = df.filter(F.col("status") == "success")
    rows = events.select("event.*") if sink == "parquet" else event_json(events)
    writer = rows.writeStream.format(sink).option("checkpointLocation", checkpoint).outputMode("append")
    if path is not None:
        writer = writer.option("path", path)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
