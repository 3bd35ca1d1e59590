"""Counters of a running stream, kept up to date by observed metrics.

What a stream takes in is observed on its source and comes with the progress of each
micro-batch; what becomes of the records is observed where the batch is processed. Both are
plain aggregates inside jobs that run anyway: no extra pass, no state store, and only a few
numbers per micro-batch reach the driver.
"""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from lognorm.operators.metrics import METRICS
from lognorm.operators.outputs import REASONS
from lognorm.operators.validate import INVALID
from lognorm.sources.parsers import ParserDef

_TAKEN_IN = "lognorm_taken_in"


class LiveMetrics(StreamingQueryListener):
    """(metric, label, value) as ``metrics_table`` gives them, for one stream at a time.

    Counters start at zero with the object and only grow, like those of any process. A replayed
    micro-batch has the id of its first try and replaces its numbers. ``dedup_total`` is that of the
    last batch known whole; with dedup in event time it holds the records that still wait,
    too. Tasks run again after a lost executor may count twice, as observed metrics do. Metrics that are zero are
    left out, but for ``ingest_total`` and ``dedup_total``.
    """

    def __init__(self, spark: SparkSession, dlq_mode: str = "manual"):
        self.spark, self.dlq_mode = spark, dlq_mode
        self._lock, self._ended = threading.Lock(), threading.Event()
        # Numbers of finished batches, and those of the last one, which a replay may replace.
        self._sums = {side: Counter() for side in ("source", "records")}
        self._last: dict[str, tuple[int, Counter]] = {side: (-1, Counter()) for side in self._sums}
        self._skipped = 0
        spark.streams.addListener(self)

    # ------------------------------------------------------------------ what is observed

    def observe_source(self, source: DataFrame) -> DataFrame:
        """The stream before dedup, its records counted."""
        return source.observe(_TAKEN_IN, F.count(F.lit(1)).alias("taken_in"))

    def observe_records(self, done: DataFrame, defs: list[ParserDef]) -> tuple[DataFrame, Observation]:
        """A processed micro-batch, its records counted by definition and by outcome."""
        seen = Observation()
        parser, status = F.col("parser"), F.col("status")
        counts = [F.count(F.lit(1)).alias("processed")]
        for name in dict.fromkeys(d.name for d in defs):
            counts += [F.count_if(parser == name).alias(f"matched_total {name}"),
                       F.count_if((parser == name) & (status == INVALID)).alias(f"validation_failed_total {name}")]
        counts += [F.count_if(status == s).alias(f"dlq_total {reason},{self.dlq_mode}") for s, reason in REASONS.items()]
        return done.observe(seen, *counts), seen

    def batch_done(self, batch_id: int, seen: Observation) -> None:
        """To be called once an action has run over the observed micro-batch."""
        self._take("records", batch_id, seen.get)

    # ------------------------------------------------------------------ listener

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(_TAKEN_IN)
        if row is not None:
            self._take("source", event.progress.batchId, row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def _take(self, side: str, batch_id: int, counts: dict[str, int]) -> None:
        with self._lock:
            last, before = self._last[side]
            if batch_id != last:
                self._sums[side] += before
            self._last[side] = (batch_id, Counter(counts))
            if self._last["source"][0] == self._last["records"][0]:  # both sides of the same batches
                self._skipped = self._total("source")["taken_in"] - self._total("records")["processed"]

    def _total(self, side: str) -> Counter:
        return self._sums[side] + self._last[side][1]

    # ------------------------------------------------------------------ what is read

    def wait(self, seconds: float = 60) -> bool:
        """Progress arrives a moment after its batch; waits for the last one of an ended stream."""
        return self._ended.wait(seconds)

    def close(self) -> None:
        self.spark.streams.removeListener(self)

    def counters(self) -> list[tuple[str, str, int]]:
        with self._lock:
            taken, seen, skipped = self._total("source")["taken_in"], self._total("records"), self._skipped
        rows = [("ingest_total", "", taken), ("dedup_total", "", skipped)]
        return rows + [(*name.split(" ", 1), value) for name, value in seen.items() if " " in name and value]

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.counters(), METRICS)
