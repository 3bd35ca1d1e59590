"""Exact duplicate removal over a stream whose records arrive out of order.

Which record of a hash is kept depends on all earlier ones, so nothing can be decided before no
earlier record may still arrive. Event time is cut into buckets as long as the window. A record
of a newer bucket closes the buckets that lie more than the allowed delay behind it; records of
closed buckets are decided once and for all, those that come later are late.

Each micro-batch is written to a shared folder as it arrives. What it closes is read back by
bucket, with the last kept time of every hash that is still within reach, and goes through
``dedup_window``: the hot-hash plan of the batch job, no per-key task, no payload in a state
store. Everything is keyed by batch id and the closing mark is written last, so a replayed batch
repeats its own work with the same result. Folders no later batch needs are deleted.

Over a stream that was finished, accepted records are those of ``dedup_window`` over all records
that were not late. Records without time are accepted at once, those without payload with their
bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lognorm.operators.dedup import dedup_window

_BUCKET, _BATCH, _CARRIED = "_bucket", "_batch", "_carried"
#: Before any bucket.
_START = -(1 << 62)


class EventTimeDedup:
    """``accepted, late = dedup(batch, batch_id)`` inside ``foreachBatch``; ``folder`` belongs to one query."""

    def __init__(self, spark: SparkSession, folder: str, seconds: int = 300, max_delay_seconds: int = 3600):
        if seconds <= 0 or max_delay_seconds < 0:
            raise ValueError("the window is positive and the delay not negative")
        self.spark, self.folder, self.seconds = spark, folder, seconds
        self.lag = -(-max_delay_seconds // seconds)

    def __call__(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """What this batch decides: (accepted records of it and earlier ones, its late records)."""
        bucket = F.floor(F.unix_micros("ingest_ts") / F.lit(self.seconds * 1_000_000)).cast("long")
        batch.withColumns({"raw_sha256": F.sha2("raw", 256), _BUCKET: bucket}).write.mode("overwrite").parquet(self._path("pending", batch_id))
        pending = self._read("pending", batch_id)
        newest = pending.agg(F.max(_BUCKET)).head()[0]
        _, before = self._mark(batch_id)
        return self._decide(batch_id, before if newest is None else max(before, newest - self.lag), newest)

    def finish(self, batch_id: int) -> DataFrame:
        """Decides all that is pending after the last batch; ``batch_id`` is one not used yet."""
        newest = [m["newest"] for m in self._marks(batch_id) if m["newest"] is not None]
        return self._decide(batch_id, max(newest) + 1 if newest else _START, None)[0]

    def _decide(self, batch_id: int, closed: int, newest: int | None) -> tuple[DataFrame, DataFrame]:
        last, before = self._mark(batch_id)
        marks = self._marks(batch_id)
        # Batches with records in the buckets that close now, this one among them.
        open_ = [m["batch_id"] for m in marks if m["newest"] is not None and m["newest"] >= before] + [batch_id] * (newest is not None)
        own = self._read("pending", batch_id) if self._exists("pending", batch_id) else None
        schema = (own if own is not None else self._read("pending", last) if last is not None else None)
        if schema is None:
            raise ValueError("there was no batch yet")
        names = [c for c in schema.columns if c != _BUCKET]
        due = self.spark.read.schema(schema.schema).parquet(*[self._path("pending", b) for b in open_]) if open_ else schema.limit(0)
        due = due.where(F.col(_BUCKET).between(before, closed - 1)).select(*names, F.lit(False).alias(_CARRIED))
        carried = self._read("kept", last) if last is not None else None
        if carried is not None:
            due = due.unionByName(carried.select("raw_sha256", F.timestamp_micros("kept").alias("ingest_ts"), F.lit(True).alias(_CARRIED)), allowMissingColumns=True)
        found = dedup_window(due, self.seconds).where(~F.col(_CARRIED)).drop(_CARRIED)
        if own is not None:
            found = found.unionByName(own.where(F.col(_BUCKET).isNull()).select(names))
        found.write.mode("overwrite").parquet(self._path("accepted", batch_id))
        accepted = self.spark.read.schema(found.schema).parquet(self._path("accepted", batch_id))

        kept = accepted.where("raw_sha256 IS NOT NULL AND ingest_ts IS NOT NULL").select("raw_sha256", F.unix_micros("ingest_ts").alias("kept"))
        if carried is not None:
            kept = kept.unionByName(carried)
        reach = max((closed - 1) * self.seconds * 1_000_000, _START)
        kept.groupBy("raw_sha256").agg(F.max("kept").alias("kept")).where(F.col("kept") >= reach).write.mode("overwrite").parquet(self._path("kept", batch_id))
        self.spark.createDataFrame([(batch_id, closed, newest)], "batch_id long, closed long, newest long").coalesce(1).write.mode("overwrite").parquet(
            self._path("marks", batch_id))
        self._forget(batch_id, before, marks)
        late = (own if own is not None else schema.limit(0)).where(F.col(_BUCKET) < before).select(names)
        return accepted, late

    def _forget(self, batch_id: int, before: int, marks: list) -> None:
        """Deletes what was decided before the batch before this one: a replay of this one needs none of it."""
        for m in marks:
            b = m["batch_id"]
            if b < batch_id - 1 and (m["newest"] is None or m["newest"] < before):
                for kind in ("pending", "accepted", "kept"):
                    self._fs(kind, b)[0].delete(self._fs(kind, b)[1], True)
            elif b < batch_id - 1:
                for kind in ("accepted", "kept"):
                    self._fs(kind, b)[0].delete(self._fs(kind, b)[1], True)

    def _marks(self, batch_id: int) -> list:
        """Marks of earlier batches, one short row each."""
        fs, path = self._fs("marks")
        if not fs.exists(path):
            return []
        return self.spark.read.schema("batch_id long, closed long, newest long").option("recursiveFileLookup", "true").parquet(
            f"{self.folder}/marks").where(F.col("batch_id") < batch_id).collect()

    def _mark(self, batch_id: int) -> tuple[int | None, int]:
        """(the batch before this one, what was closed after it)."""
        last = max(self._marks(batch_id), key=lambda m: m["batch_id"], default=None)
        return (None, _START) if last is None else (last["batch_id"], last["closed"])

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.folder}/{kind}/{batch_id}"

    def _fs(self, kind: str, batch_id: int | None = None):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}" if batch_id is None else self._path(kind, batch_id))
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def _exists(self, kind: str, batch_id: int) -> bool:
        fs, path = self._fs(kind, batch_id)
        return fs.exists(path)

    def _read(self, kind: str, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(self._path(kind, batch_id))
