import random

import pandas as pd
import pytest

from lognorm.operators import dedup as D
from lognorm.sources.raw import read_log_lines


def chain(times, window):
    kept = []
    for t in sorted(times):
        if not kept or t - kept[-1] > window:
            kept.append(t)
    return kept


@pytest.mark.parametrize("seconds", [[0, 200, 300, 301, 500, 602]])
def test_accepted_times(records, seconds):
    kept = D.dedup_window(records(["same"] * 6, seconds)).select("n").collect()
    assert sorted(seconds[r["n"]] for r in kept) == [0, 301, 602]


def test_without_broadcast(records, monkeypatch):
    """The same result when too many hashes recur to broadcast them."""
    payloads, seconds = ["a", "b", "a", "a", "c", "b"], [0, 1, 100, 400, 5, 1]
    df = records(payloads, seconds)
    expected = sorted(r["n"] for r in D.dedup_window(df).select("n").collect())
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    got = D.dedup_window(df).select("raw", "ingest_ts", "n").collect()
    assert len(got) == 4 and {r["n"] for r in got} - {1, 5} == {0, 3, 4} == set(expected) - {1, 5}
    assert D.dedup_window(df).columns == df.columns


def test_can_be_switched_off(records):
    assert D.dedup_window(records(["same"] * 3), enabled=False).count() == 3


def test_equal_hash_and_time_keeps_one(records):
    assert D.dedup_window(records(["a", "a", "b"], [0, 0, 0])).count() == 2


def test_skipped_count(records):
    df = records(["a", "a", "b"])
    assert D.skipped_count(df, D.dedup_window(df)).first()["skipped"] == 1


@pytest.mark.parametrize("span,n,task_times", [(20_000, 3_000, 10**6), (60_000, 2_000, 60)])
def test_hot_hashes_match_brute_force(spark, span, n, task_times):
    """The parallel scan, with many and with few times per task, against the plain loop."""
    rnd = random.Random(7)
    data = {bytes([i]): [rnd.randrange(span) for _ in range(n if i < 2 else rnd.randrange(1, 6))] for i in range(12)}
    data[b"grid"] = list(range(0, span, span // n))
    df = spark.createDataFrame(pd.DataFrame(
        [(k, t) for k, ts in data.items() for t in ts], columns=[D._KEY, D._TIME]))
    got = {}
    for key, t in D.kept_times(df, 300, hot_rows=100, task_times=task_times).collect():
        got.setdefault(bytes(key), []).append(t)
    assert {k: sorted(v) for k, v in got.items()} == {k: chain(v, 300) for k, v in data.items()}


def test_composite_key(spark):
    long = "x" * 60
    df = spark.createDataFrame(
        [("t", 1, long), ("t", 1, long[:50] + "other"), ("t", 2, long), ("u", 1, None), ("u", 1, None)],
        "time string, id int, message string")
    assert D.dedup_composite(df, "time", "id", "message", n=50).count() == 3
    assert D.dedup_composite(df, "time", "id", "message").count() == 4


def test_composite_key_keeps_parts_apart_and_picks_one_row(spark):
    rows = [("a-b", "c", "m", 1), ("a", "b-c", "m", 2), ("", None, "m", 3), (None, "", "m", 4), ("a", "b-c", "m", 5), ("a", "b-c", None, 6), ("a", "b-c", "", 7)]
    df = spark.createDataFrame(rows, "time string, id string, message string, n int")
    got = {r["n"] for r in D.dedup_composite(df, "time", "id", "message").collect()}
    assert len(got) == 6 and got == {r["n"] for r in D.dedup_composite(df.repartition(5), "time", "id", "message").collect()}


@pytest.mark.parametrize("limit", [0, D.BROADCAST_ROWS])
def test_missing_payloads_and_times_stay(spark, monkeypatch, limit):
    """Without broadcast too."""
    monkeypatch.setattr(D, "BROADCAST_ROWS", limit)
    df = spark.createDataFrame(
        [(b"a", 0, 1), (b"a", 0, 2), (b"a", None, 3), (b"a", None, 4), (None, 0, 5), (None, 0, 6), (b"b", 0, 7), (b"a", 400, 8)],
        "raw binary, at long, n int").selectExpr("raw", "timestamp_seconds(at) AS ingest_ts", "n")
    assert sorted(r["n"] for r in D.dedup_window(df).collect())[-6:] == [3, 4, 5, 6, 7, 8]
    assert D.dedup_window(df).count() == 7


def test_a_moving_clock_loses_no_record(spark, tmp_path):
    (tmp_path / "x.log").write_text("a\nb\na\nc\nb\na\n")
    assert sorted(bytes(r["raw"]) for r in D.dedup_window(read_log_lines(spark, str(tmp_path))).collect()) == [b"a", b"b", b"c"]
    moving = spark.read.text(str(tmp_path)).selectExpr("CAST(value AS BINARY) AS raw", "current_timestamp() AS ingest_ts")
    assert D.dedup_window(moving).count() == 3
