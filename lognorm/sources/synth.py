"""Log lines rendered from the driver's ``events`` table (which itself holds no logs).

Every event becomes one line in the format its type stands for; every tenth comes again up
to 700 seconds later, on both sides of the dedup window. Text depends on integers and the
timestamp only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Events that one task renders or unfolds; a scan alone makes few tasks, because events are small.
TASK_EVENTS = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` for steps that make much of each: dealt out by ranges of ``event_id`` where one task would hold too many."""
    events = read_table(spark, sf_dir, "events")
    tasks = -(-events.count() // TASK_EVENTS)
    return events if tasks <= 1 else events.repartitionByRange(tasks, "event_id")


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, raw, ingest_ts, source``."""
    events = read_events(spark, sf_dir).selectExpr(
        "event_id AS e", "user_id AS u", "event_type", "CAST(ts AS TIMESTAMP) AS ts",
        "explode(CASE WHEN event_id % 10 = 0 THEN array(0L, event_id % 700) ELSE array(0L) END) AS delay",
    )
    return events.selectExpr(
        "e AS event_id",
        f"encode({_LINE}, 'UTF-8') AS raw",
        "timestamp_micros(unix_micros(ts) + delay * 1000000) AS ingest_ts",
        "event_type AS source",
    )


_SYSLOG_TIME = "date_format(ts, 'MMM dd HH:mm:ss')"
_ISO_TIME = "date_format(ts, 'yyyy-MM-dd\\'T\\'HH:mm:ss\\'Z\\'')"
_IP = "u % 256, e % 256"
_PORT = "1024 + e % 60000"


def _sshd(words: str) -> str:
    return (f"format_string('%s host%d sshd[%d]: {words} from 10.0.%d.%d port %d ssh2', "
            f"{_SYSLOG_TIME}, u % 50, e % 30000, u, {_IP}, {_PORT})")


_LINE = f"""CASE event_type
  WHEN 'signup' THEN CASE WHEN e % 2 = 0 THEN {_sshd("Accepted password for user%d")}
    ELSE {_sshd("Accepted publickey for user%d")} END
  WHEN 'error' THEN CASE WHEN e % 2 = 0 THEN {_sshd("Failed password for invalid user user%d")}
    ELSE {_sshd("Failed password for user%d")} END
  WHEN 'click' THEN CASE e % 3
    WHEN 0 THEN format_string('%%ASA-6-302013: Built inbound TCP connection %d for outside:10.0.%d.%d/%d (10.0.%d.%d/%d) to inside:192.168.1.%d/443 (192.168.1.%d/443)',
      e, {_IP}, {_PORT}, {_IP}, {_PORT}, u % 256, u % 256)
    WHEN 1 THEN format_string('%%ASA-6-302014: Teardown UDP connection %d for outside:10.0.%d.%d/%d to inside:192.168.1.%d/443 duration 0:%02d:%02d bytes %d',
      e, {_IP}, {_PORT}, u % 256, e % 60, u % 60, e * 7)
    ELSE format_string('%%ASA-4-106023: Deny tcp src outside:10.0.%d.%d/%d dst inside:192.168.1.%d/443 by access-group "outside_in"',
      {_IP}, {_PORT}, u % 256) END
  WHEN 'view' THEN CASE WHEN e % 2 = 0
    THEN format_string('<%d>1 %s host%d app%d %d ID%d [meta seq="%d"] page viewed by user%d',
      e % 192, {_ISO_TIME}, u % 50, u % 7, e % 30000, e % 100, e, u)
    ELSE format_string('<%d>%s host%d app%d: page viewed by user%d', e % 192, {_SYSLOG_TIME}, u % 50, u % 7, u) END
  ELSE CASE e % 3
    WHEN 0 THEN CASE WHEN e % 2 = 0
      THEN format_string('{{"EventID": %d, "MachineName": "PC%d", "Message": "order %d failed"}}', 4000 + e % 1000, u % 500, e)
      ELSE format_string('{{"Event": {{"System": {{"Level": {{"n": %d}}}}}}, "Script": "if (x) {{", "EventID": %d, "MachineName": "PC%d", "Message": "order %d failed"}}',
        e % 6, 4000 + e % 1000, u % 500, e) END
    WHEN 1 THEN CASE WHEN e % 2 = 0
      THEN format_string('{{"eventMessage":"order %d placed","subsystem":"com.example.shop%d"}}', e, u % 9)
      ELSE format_string('{{"trace":{{"ids":{{"a":{{"b":%d}}}}}},"eventMessage":"order %d }} placed","subsystem":"com.example.shop%d"}}', e % 10, e, u % 9) END
    ELSE format_string('%d,%s,order,user%d,THREAT,denied', e, {_ISO_TIME}, u) END
  END"""
