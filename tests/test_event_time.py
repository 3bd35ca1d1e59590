import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from golden import MIXED

from lognorm.builtin_rules import builtin_parsers
from lognorm.streaming import stream
from lognorm.streaming.event_time import EventTimeDedup

T0 = datetime(2026, 9, 10, tzinfo=timezone.utc)
SECONDS, DELAY = 10, 30


def frame(spark, rows):
    data = [(None if p is None else p.encode(), None if s is None else T0 + timedelta(seconds=s), "t") for p, s in rows]
    return spark.createDataFrame(data, "raw binary, ingest_ts timestamp, source string")


def seen(df):
    return sorted((((r["raw"] or b"").decode(), None if r["ingest_ts"] is None else (r["ingest_ts"].replace(tzinfo=timezone.utc) - T0).total_seconds())
                  for r in df.collect()), key=str)


def plain(batches):
    """(accepted after all, late) by bucket marks and a loop over each payload's times."""
    newest, on_time, late = None, [], []
    base = int(T0.timestamp())
    for batch in batches:
        closed = None if newest is None else newest - DELAY // SECONDS
        for p, s in batch:
            (late if closed is not None and s is not None and (base + s) // SECONDS < closed else on_time).append((p, s))
        newest = max([(base + s) // SECONDS for _, s in batch if s is not None] + ([] if newest is None else [newest]), default=None)
    out = [("", float(s)) for p, s in on_time if p is None] + [(p, None) for p, s in on_time if s is None and p is not None]
    for payload in {p for p, _ in on_time if p is not None}:
        last = None
        for s in sorted({s for p, s in on_time if p == payload and s is not None}):
            if last is None or s - last > SECONDS:
                out.append((payload, float(s)))
                last = s
    return sorted(out, key=str), sorted((p, float(s)) for p, s in late)


def test_out_of_order_batches_and_replay(spark, tmp_path):
    rng = random.Random(6)
    batches = []
    for n in range(5):
        rows = [(rng.choice("aaab"), 25 * n + rng.randint(-20, 20)) for _ in range(25)] + [("late", 25 * n - 60)]
        batches.append(rows)
    batches[2] += [(None, 55), ("a", None)]
    dedup = EventTimeDedup(spark, str(tmp_path / "d"), SECONDS, DELAY)
    accepted, late = [], []
    for n, rows in enumerate(batches):
        first = [seen(x) for x in dedup(frame(spark, rows), n)]
        if n in (1, 3):  # the same batch again, by a new object as after a restart
            dedup = EventTimeDedup(spark, str(tmp_path / "d"), SECONDS, DELAY)
            assert [seen(x) for x in dedup(frame(spark, rows), n)] == first
        accepted += first[0]
        late += first[1]
    accepted += seen(dedup.finish(len(batches)))
    want = plain(batches)
    assert (sorted(accepted, key=str), sorted(late)) == want
    assert len(want[1]) >= 3 and len(want[0]) > 10
    left = {p.name for p in Path(tmp_path / "d" / "accepted").iterdir()}
    assert "0" not in left and str(len(batches)) in left


def test_empty_batches_and_bad_settings(spark, tmp_path):
    dedup = EventTimeDedup(spark, str(tmp_path / "d"), SECONDS, DELAY)
    assert [seen(x) for x in dedup(frame(spark, []), 0)] == [[], []]
    assert [seen(x) for x in dedup(frame(spark, [("a", 1)]), 1)] == [[], []]
    assert seen(dedup.finish(2)) == [("a", 1.0)]
    with pytest.raises(ValueError):
        EventTimeDedup(spark, "x", 0)


def test_late_records_become_dead_letters(spark, tmp_path):
    path = str(tmp_path / "in")
    for rows in ([(p, 100) for p in MIXED], [(MIXED[0], 40), (MIXED[0], 100), (MIXED[1], 500)]):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
    dedup = EventTimeDedup(spark, str(tmp_path / "d"), SECONDS, DELAY)
    q = stream.run_stream(
        stream.stream_logs(spark, path, max_files=1, format="parquet"), builtin_parsers(), stream.jsonl_sink(str(tmp_path / "events")),
        stream.parquet_sink(str(tmp_path / "dlq")), str(tmp_path / "ckpt"), trigger={"availableNow": True}, event_time=dedup)
    q.awaitTermination()
    assert spark.read.json(str(tmp_path / "events")).count() == 4
    dead = spark.read.parquet(str(tmp_path / "dlq")).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in dead}["late"] == 1 and sum(r["count"] for r in dead) == 5
    assert len(seen(dedup.finish(9))) == 1
