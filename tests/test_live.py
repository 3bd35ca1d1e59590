"""Counters of a running stream, and definitions that change while it runs."""

import json
from dataclasses import replace

import pytest

from lognorm.builtin_rules import LINUX_SSHD, builtin_parsers
from lognorm.plans.queries import SHOP_CSV
from lognorm.sources.parsers import definition_document, parse_definition
from lognorm.streaming import stream
from lognorm.streaming.live_metrics import LiveMetrics
from lognorm.streaming.registry import Registry, put_definition, read_documents, read_registry

SSHD = "Sep 10 17:44:21 h sshd[1]: Accepted password for u from 10.0.0.1 port 22 ssh2"


@pytest.fixture
def live(spark):
    counted = LiveMetrics(spark)
    yield counted
    counted.close()


def test_a_replayed_batch_replaces_its_numbers(live):
    for batch, taken, processed in [(0, 10, 8), (1, 5, 5), (1, 5, 5), (2, 4, 1), (2, 4, 3)]:
        live._take("records", batch, {"processed": processed, "matched_total p": 1, "dlq_total unmatched,manual": 0})
        live._take("source", batch, {"taken_in": taken})
    assert live.counters() == [("ingest_total", "", 19), ("dedup_total", "", 3), ("matched_total", "p", 3)]


def test_dedup_total_waits_for_both_sides_of_a_batch(live):
    live._take("records", 0, {"processed": 4})
    live._take("source", 0, {"taken_in": 6})
    live._take("records", 1, {"processed": 50})
    assert dict((m, v) for m, _, v in live.counters()) == {"ingest_total": 6, "dedup_total": 2}


def test_counters_of_a_stream(spark, records, live, tmp_path):
    records([SSHD, "csv,1", "csv,2"]).select("raw", "ingest_ts", "source").coalesce(1).write.parquet(f"{tmp_path}/in")
    spark.createDataFrame([(None, None, "x")], "raw binary, ingest_ts timestamp, source string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    first_only = lambda df, batch_id: df.limit(1).collect()
    stream.run_stream(stream.stream_logs(spark, f"{tmp_path}/in", 1, "parquet"), builtin_parsers(), first_only, first_only,
                      f"{tmp_path}/checkpoint", {"availableNow": True}, dedup_seconds=None, live=live).awaitTermination()
    assert live.wait()
    assert sorted(tuple(r) for r in live.table().collect()) == [
        ("dedup_total", "", 0), ("dlq_total", "null_payload,manual", 1), ("dlq_total", "unmatched,manual", 2),
        ("ingest_total", "", 4), ("matched_total", "linux_sshd", 1)]


def test_documents_survive_a_round_trip():
    for d in [*builtin_parsers(), parse_definition(SHOP_CSV, "shop.json")]:
        again = parse_definition(json.loads(json.dumps(definition_document(d))), d.file)
        assert replace(again, file="") == replace(d, file="")


def test_registry_skips_what_is_no_definition(spark, tmp_path):
    folder = tmp_path / "defs"
    assert read_registry(spark, str(folder)) == []
    folder.mkdir()
    assert read_registry(spark, str(folder)) == []
    (folder / "bad.json").write_text("{")
    (folder / "bytes.json").write_bytes(b"\xff\xfe\x00")
    (folder / "empty.json").write_bytes(b"")
    (folder / "list.json").write_text("[]")
    (folder / "notes.txt").write_text(json.dumps(SHOP_CSV))
    put_definition(spark, str(folder), "b shop+1.json", json.dumps(SHOP_CSV | {"match_priority": 7}))
    put_definition(spark, str(folder), "a.json", json.dumps(SHOP_CSV | {"match_priority": 7, "description": "ümläut"}))
    put_definition(spark, str(folder), "z.json", json.dumps(SHOP_CSV | {"match_priority": 1}))
    found = read_registry(spark, str(folder))
    assert [d.file for d in found] == ["z.json", "a.json", "b shop+1.json"] and found[1].description == "ümläut"
    with pytest.raises(ValueError, match="bytes of definitions"):
        read_documents(spark, str(folder), max_bytes=100)


def test_a_replayed_batch_takes_the_definitions_of_its_first_try(spark, tmp_path):
    folder, state = str(tmp_path / "defs"), str(tmp_path / "state")
    assert Registry(spark, folder, state).at(0) == []
    put_definition(spark, folder, "shop.json", json.dumps(SHOP_CSV))
    put_definition(spark, folder, "sshd.json", json.dumps(definition_document(LINUX_SSHD)))
    registry = Registry(spark, folder, state)
    assert registry.at(0) == []
    assert [d.name for d in registry.at(1)] == ["shop_csv", "linux_sshd"]
    put_definition(spark, folder, "shop.json", json.dumps(SHOP_CSV | {"name": "renamed"}))
    assert [d.name for d in Registry(spark, folder, state).at(1)] == ["shop_csv", "linux_sshd"]
    assert [d.name for d in registry.at(2)] == ["renamed", "linux_sshd"]
    (tmp_path / "defs" / "sshd.json").unlink()
    assert [d.name for d in registry.at(3)] == ["renamed"]
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["2", "3"]
