"""End-to-end on sample lines with known outcome."""

import json

import pytest
from golden import ASA, HASH_STARTS, MIXED, MIXED_HASH_STARTS, MIXED_STATUS, SSHD, SYSLOG
from pyspark.sql import functions as F

from lognorm.builtin_rules import builtin_parsers
from lognorm.operators.outputs import class_view, dlq_records, event_json, history, split_outputs
from lognorm.plans.batch import normalize_records, process

DEFS = builtin_parsers()
LINES = ASA + SSHD + SYSLOG


@pytest.fixture(scope="module")
def events(spark):
    df = spark.createDataFrame([(i, x.encode()) for i, x in enumerate(LINES)], "n int, raw binary")
    done = normalize_records(df.withColumn("ingest_ts", F.timestamp_millis(F.lit(1_700_000_000_123))), DEFS)
    rows = done.select("n", "parser", "pattern_id", "raw_sha256", "status", F.to_json("event").alias("e")).orderBy("n")
    return [(r, json.loads(r["e"])) for r in rows.collect()]


def test_every_line_finds_its_parser(events):
    assert [r["parser"] for r, _ in events] == ["cisco_asa"] * 5 + ["linux_sshd"] * 5 + ["rfc5424_fallback"] * 5
    assert [r["pattern_id"] for r, _ in events] == [4, 5, 6, 4, 5, 7, 8, 7, 8, 7, 9, 9, 9, 10, 9]
    assert {r["status"] for r, _ in events} == {"success"}


def test_hashes(events):
    assert [r["raw_sha256"][:12] for r, _ in events] == HASH_STARTS
    for (r, e), line in zip(events, LINES):
        assert e["raw_data"] == line and e["raw_data_size"] == len(line.encode())
        assert e["raw_data_hash"] == {"algorithm": "SHA-256", "algorithm_id": 3, "value": r["raw_sha256"]}


def test_network_events(events):
    flows = [(e["src_endpoint"], e["dst_endpoint"], e["connection_info"]["protocol_name"], e["traffic"]["bytes"])
             for _, e in events[:5]]
    assert flows == [
        ({"ip": "10.0.0.1", "port": 1234}, {"ip": "192.168.1.1", "port": 443}, "TCP", 0),
        ({"ip": "10.0.0.1", "port": 1234}, {"ip": "192.168.1.1", "port": 443}, "TCP", 4567),
        ({"ip": "10.0.0.5", "port": 8080}, {"ip": "192.168.1.100", "port": 22}, "TCP", 0),
        ({"ip": "192.168.1.50", "port": 55555}, {"ip": "8.8.8.8", "port": 53}, "TCP", 0),
        ({"ip": "203.0.113.5", "port": 12345}, {"ip": "10.0.0.10", "port": 514}, "UDP", 256),
    ]
    for _, e in events[:5]:
        assert (e["class_uid"], e["category_uid"], e["type_uid"], e["severity_id"]) == (4001, 4, 400100, 1)
        assert "user" not in e and "device" not in e
    assert events[0][1]["unmapped"] == {
        "severity": "6", "message_id": "302013", "direction": "inbound", "protocol": "TCP", "conn_id": "12345",
        "src_ip": "10.0.0.1", "src_port": "1234", "dst_ip": "192.168.1.1", "dst_port": "443"}
    assert events[1][1]["unmapped"]["duration"] == "0:01:30"
    assert "bytes" not in events[1][1]["unmapped"] and "conn_id" not in events[2][1]["unmapped"]


def test_authentication_events(events):
    assert [(e["user"]["name"], e["src_endpoint"]["ip"], e["src_endpoint"]["port"]) for _, e in events[5:10]] == [
        ("admin", "192.168.1.100", 52413), ("root", "10.0.0.5", 44231), ("deploy", "10.10.0.50", 33221),
        ("admin", "192.168.1.200", 60012), ("sysadmin", "172.16.0.1", 49876)]
    for _, e in events[5:10]:
        assert (e["class_uid"], e["category_uid"], e["type_uid"]) == (3002, 3, 300200)
        assert (e["auth_protocol"], e["auth_protocol_id"], e["service"]) == ("SSH2", 99, "sshd")
        assert e["is_remote"] is True and (e["logon_type_id"], e["logon_type"]) == (3, "Network")
        assert e["dst_endpoint"] == {"hostname": "webserver"}
        assert sorted(e["unmapped"]) == sorted(
            ["timestamp", "pid", "auth_method", "username", "src_ip", "src_port", "protocol"])


def test_syslog_events(events):
    expected = [
        ("Application event occurred", 16, 6, "myhost", "1234", "ID47"),
        ("- SNMP trap received from 10.0.0.1", 20, 5, "router1", "5678", "MSG001"),
        ("- Firewall rule triggered for 192.168.1.1", 10, 6, "firewall", "-", "-"),
        ("syslogd: restart", 1, 5, "legacyhost", "-", "-"),
        ("GET /api/health 200", 16, 6, "webserver", "9999", "REQ123"),
    ]
    for (_, e), (message, facility, severity, host, procid, msgid) in zip(events[10:], expected):
        u = e["unmapped"]
        assert e["message"] == message and e["type_uid"] == 0
        assert (u["facility"], u["syslog_severity"], u["hostname"]) == (str(facility), str(severity), host)
        assert (u["procid"], u["msgid"]) == (procid, msgid)
        assert e["metadata"]["product"] == {"name": "rfc5424_fallback", "vendor_name": "generic", "version": "1.0.0"}


def test_time_is_arrival(events):
    for _, e in events:
        assert e["time"] == e["metadata"]["processed_time"] == 1_700_000_000_123
        assert e["metadata"]["version"] == "1.3.0"


@pytest.mark.parametrize("mode", ["code", "instance"])
def test_mixed_lines(records, mode):
    done = process(records(MIXED), DEFS, enum_mode=mode).orderBy("n")
    rows = done.select("raw_sha256", "status", "errors.field").collect()
    assert [r["raw_sha256"][:12] for r in rows] == MIXED_HASH_STARTS
    assert [r["status"] for r in rows] == MIXED_STATUS[mode]
    if mode == "instance":
        assert set(rows[0]["field"]) == {"activity_id", "severity_id"}


def test_outputs_are_exhaustive_and_disjoint(records):
    done = process(records(MIXED), DEFS)
    events, dead = split_outputs(done)
    assert (events.count(), dead.count()) == (4, 4)
    letters = dlq_records(done).orderBy("timestamp").collect()
    assert [r["error"] for r in letters] == ["No matching active parsers found."] * 4
    assert letters[0]["timestamp"] == "2026-09-10T17:44:23.287394+00:00" and letters[0]["dlq_date"] == "2026-09-10"
    assert letters[0]["raw_payload"] == MIXED[2]
    h = history(done, DEFS).orderBy("ingest_ts").collect()
    assert [r["parser"] for r in h][2] == "None (Unmatched)" and h[2]["type_uid"] is None and h[2]["severity"] == 0
    assert h[0]["type_uid"] == 300200 and h[4]["ocsf_class"] == "network_activity"
    assert class_view(events, "network_activity").count() == 2
    assert all(json.loads(r["value"])["raw_data"] in MIXED for r in event_json(events).collect())


def test_no_parsers_sends_all_to_dlq(records):
    done = process(records(["unmatched log"]), [])
    assert [r["status"] for r in done.select("status").collect()] == ["dlq"]
