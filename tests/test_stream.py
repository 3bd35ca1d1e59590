from datetime import datetime, timedelta, timezone

import pytest
from golden import MIXED
from pyspark.sql import functions as F

from lognorm.builtin_rules import builtin_parsers
from lognorm.plans import queries
from lognorm.plans.batch import normalize_records
from lognorm.streaming import stream

DEFS = builtin_parsers()
T0 = datetime(2026, 9, 10, tzinfo=timezone.utc)


def land(spark, path, batches):
    for batch in batches:
        rows = [(p.encode(), T0 + timedelta(seconds=s), "t") for p, s in batch]
        spark.createDataFrame(rows, "raw binary, ingest_ts timestamp, source string").coalesce(1) \
            .write.mode("append").parquet(path)


def drain(query):
    query.processAllAvailable()
    query.stop()


def test_exact_dedup_across_batches_and_restart(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def run():
        df = stream.dedup_stream(stream.stream_logs(spark, path, max_files=1, format="parquet"))
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    land(spark, path, [[("same", 0), ("same", 0)], [("same", 301)], [("same", 601), ("other", 601)]])
    run()
    land(spark, path, [[("same", 1301), ("other", 1302)]])
    run()
    got = sorted((bytes(r["raw"]).decode(), int((r["ingest_ts"].replace(tzinfo=timezone.utc) - T0).total_seconds()))
                 for r in spark.read.parquet(out).collect())
    assert got == [("other", 601), ("other", 1302), ("same", 0), ("same", 301), ("same", 1301)]


def test_run_stream_from_text_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\n".join(MIXED + MIXED[:1]) + "\n")
    q = stream.run_stream(
        stream.stream_logs(spark, str(tmp_path / "in")), DEFS, stream.jsonl_sink(str(tmp_path / "events")),
        stream.parquet_sink(str(tmp_path / "dlq")), str(tmp_path / "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.json(str(tmp_path / "events")).count() == 4
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == 4


@pytest.mark.parametrize("mode", ["jsonl", "parquet"])
def test_stream_events(spark, tmp_path, mode):
    land(spark, str(tmp_path / "in"), [[(p, 1) for p in MIXED]])
    records = stream.stream_logs(spark, str(tmp_path / "in"), format="parquet")
    q = stream.stream_events(normalize_records(records, DEFS), mode, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                             trigger={"availableNow": True})
    q.awaitTermination()
    assert getattr(spark.read, "json" if mode == "jsonl" else "parquet")(str(tmp_path / "out")).count() == 4


def test_approximate_dedup_and_bad_mode(spark, tmp_path):
    land(spark, str(tmp_path / "in"), [[("a", 1), ("a", 2), ("b", 3)]])
    source = stream.stream_logs(spark, str(tmp_path / "in"), format="parquet")
    q = (stream.dedup_stream(source, mode="approximate").writeStream.format("memory").queryName("approx")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("approx").count() == 2
    with pytest.raises(ValueError):
        stream.dedup_stream(source, mode="other")


def test_exact_dedup_keeps_state_by_group_and_sorts_a_whole_micro_batch(spark, tmp_path):
    """5,000 hashes come once, one 100 times in reverse, in Arrow batches of 10 records."""
    land(spark, str(tmp_path / "in"), [[(f"p{n}", n % 50) for n in range(5000)] + [("same", 10 * n) for n in reversed(range(100))] + [(" ", 4)]])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        q = (stream.dedup_stream(stream.stream_logs(spark, str(tmp_path / "in"), format="parquet")).writeStream.format("parquet")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = spark.read.parquet(str(tmp_path / "out"))
    same = out.where("raw = X'73616D65'").collect()
    assert sorted(int((r["ingest_ts"].replace(tzinfo=timezone.utc) - T0).total_seconds()) for r in same) == [0, 310, 620, 930]
    assert out.count() == 5005
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress) <= stream.GROUPS < 5000


def test_parts_land_as_equal_numbers_of_files(spark, records, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_FILE_ROWS", 10)
    path, lines = str(tmp_path / "in"), [[f"line {n}" for n in range(size)] for size in (100, 3, 0, 40)]
    parts = [records(part or [""]).limit(len(part)).select("raw", "ingest_ts", "source") for part in lines]
    files = queries.landed_parts(spark, path, parts, 100)
    assert files == 10
    seen = []
    q = (stream.stream_logs(spark, path, max_files=files, format="parquet").writeStream
         .foreachBatch(lambda df, batch_id: seen.append(sorted(bytes(r.raw).decode() for r in df.collect())))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert seen == [sorted(part) for part in lines]


def test_a_micro_batch_of_one_partition_is_spread(spark, records, monkeypatch):
    batch = records([f"line {n}" for n in range(1000)]).coalesce(1)
    assert stream.spread(batch) is batch
    monkeypatch.setattr(stream, "TASK_BYTES", 100_000)
    parts = stream.spread(batch).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 11 and sum(p["count"] for p in parts) == 1000
