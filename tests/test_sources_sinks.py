import json

import pytest
from golden import MIXED
from pyspark.sql import functions as F

from lognorm.builtin_rules import builtin_parsers
from lognorm.operators import outputs, recent
from lognorm.operators.payloads import windows_payload
from lognorm.plans.batch import process
from lognorm.sources import raw
from lognorm.sources.dlq import read_dlq

DEFS = builtin_parsers()


def test_lines_keep_their_bytes(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\r\ntwo \xff\xfe\nth\rree\n")
    rows = raw.read_log_lines(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["raw"]) for r in rows) == [b"one\r", b"th\rree", b"two \xff\xfe"]
    assert rows[0]["source"].endswith("a.log") and rows[0]["ingest_ts"] is not None


def test_blob(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\ntwo\n")
    assert [bytes(r["raw"]) for r in raw.read_log_blob(spark, str(tmp_path)).collect()] == [b"one\ntwo\n"]


def test_json_array(spark, tmp_path):
    events = [{"Id": 1, "Message": "é"}, {"Id": 2, "Message": None}]
    (tmp_path / "e.json").write_bytes(json.dumps(events).encode("utf-16"))
    df = raw.read_json_events(spark, str(tmp_path / "e.json"))
    assert sorted((r["Id"], r["Message"]) for r in df.collect()) == [(1, "é"), (2, None)]
    assert raw.replicate(df, 2).count() == 4
    (tmp_path / "o.json").write_bytes(json.dumps({"Id": 1}).encode("utf-16"))
    with pytest.raises(ValueError):
        raw.read_json_events(spark, str(tmp_path / "o.json"))


def test_payloads(spark):
    df = spark.createDataFrame([(1, None, "m")], "Id long, MachineName string, Message string").withColumns({
        "ProviderName": F.lit(None).cast("string"), "LevelDisplayName": F.lit("Error")})
    got = json.loads(bytes(windows_payload(df).first()["raw"]))
    assert got == {"MachineName": "UNKNOWN", "EventID": 1, "Message": "m", "Source": "", "Level": "Error"}
    assert json.loads(bytes(raw.to_payload(df, ["Id", "MachineName"]).first()["raw"])) == {"Id": 1, "MachineName": None}


def test_sinks_and_dlq(spark, records, tmp_path):
    done = process(records(MIXED), DEFS)
    events, _ = outputs.split_outputs(done)
    outputs.write_events(events, "jsonl", str(tmp_path / "jsonl"))
    outputs.write_events(events, "jsonl", str(tmp_path / "jsonl"))
    outputs.write_events(events, "parquet", str(tmp_path / "parquet"))
    outputs.write_events(events, "stdout")
    assert spark.read.json(str(tmp_path / "jsonl")).count() == 8
    assert spark.read.parquet(str(tmp_path / "parquet")).filter("class_uid = 3002").count() == 2
    letters = outputs.dlq_records(done)
    outputs.write_dlq_daily(letters, str(tmp_path / "dlq"))
    assert (tmp_path / "dlq" / "dlq_date=2026-09-10").is_dir()
    back = read_dlq(spark, str(tmp_path / "dlq"))
    assert sorted(r["raw_payload"] for r in back.collect()) == sorted(MIXED[2:4] + MIXED[6:])
    with pytest.raises(ValueError):
        outputs.choose_sink("udp")
    seen = []
    outputs.foreach_sink(events, lambda df, batch: seen.append((df.count(), batch)))
    assert seen == [(4, 0)]


def test_staged_outputs_prune_by_status(spark, records, tmp_path):
    events, dead = outputs.stage_outputs(process(records(MIXED), DEFS), str(tmp_path / "staged"))
    assert (events.count(), dead.count()) == (4, 4)
    assert dead.select("status").distinct().first()[0] == "dlq"


def test_recent(spark):
    df = spark.sql("SELECT timestamp_seconds(i * 1800) AS ts, i AS id, i % 4 AS value FROM range(12) AS r(i)")
    rates = [r["rate"] for r in recent.rate_from_counter(df).orderBy("ts").collect()]
    assert rates == [0, 1, 1, 1] + [0, 1, 1, 1] * 2
    assert [r["id"] for r in recent.last_n(df, 2, F.col("ts").desc()).collect()] == [11, 10]
    assert recent.last_n(df, 2, F.col("ts").desc(), by="value").count() == 8
    assert [r["id"] for r in recent.chronological(df, "ts").collect()] == list(range(12))


def test_single_scan_without_shuffle(spark, tmp_path, capsys):
    spark.range(10).selectExpr("encode(string(id), 'UTF-8') AS raw", "timestamp_seconds(id) AS ingest_ts", "id AS other"
                               ).write.parquet(str(tmp_path / "raw"))
    events, _ = outputs.split_outputs(process(spark.read.parquet(str(tmp_path / "raw")), DEFS, dedup_seconds=None))
    outputs.event_json(events).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
    assert plan.count("RLIKE") == sum(len(d.match_patterns) for d in DEFS)
    assert "other" not in plan.split("ReadSchema")[1]


def test_nothing_is_lost_on_the_way(spark):
    from lognorm.builtin_rules import builtin_parsers
    from lognorm.operators.metrics import metrics_table
    from lognorm.operators.outputs import dlq_records
    from lognorm.plans.batch import process

    rows = [(b"x" * 70_000, 1), (None, 2), (b"normal", 3), (b"normal", 4), (b"y" * 65_536, 5)]
    raw = spark.createDataFrame(rows, "raw binary, at long").selectExpr("raw", "timestamp_seconds(at) AS ingest_ts", "'t' AS source")
    done = process(raw, builtin_parsers())
    assert sorted(r["reason"] for r in dlq_records(done).collect()) == ["null_payload", "oversize", "unmatched", "unmatched"]
    m = {(r["metric"], r["label"]): r["value"] for r in metrics_table(done, raw).collect()}
    assert m["ingest_total", ""] == 5 and m["dedup_total", ""] == 1
