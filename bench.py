"""Headline timings: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores; prints one JSON line.

The log lines come from the ``events`` table, ten distinct copies of each so that per-record
work outweighs start-up. They are written down first; each query then reads them and is
timed from scan to a no-op sink, after one warm-up on the same plan.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from lognorm.builtin_rules import builtin_parsers
from lognorm.functions.payload import fingerprint
from lognorm.operators.dedup import dedup_window
from lognorm.operators.metrics import metrics_table
from lognorm.operators.outputs import dlq_records, event_json, history, split_outputs
from lognorm.operators.recent import events_per_second, newest_first
from lognorm.operators.route import extract_captures, route
from lognorm.plans.batch import normalize_records, process
from lognorm.session import local_session, ship_package
from lognorm.sources.synth import raw_logs

COPIES = 10


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "lognorm-bench")
    ship_package(spark)
    defs = builtin_parsers()
    path = tempfile.mkdtemp(prefix="lognorm-bench-") + "/raw"
    copy = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("copy")
    lines = raw_logs(spark, sf_dir).select("*", copy).select(
        "event_id", F.concat("raw", F.encode(F.concat(F.lit(" #"), F.col("copy")), "UTF-8")).alias("raw"),
        "ingest_ts", "source")
    lines.repartition(4 * int(cpus)).write.parquet(path)
    raw = spark.read.parquet(path)
    records = raw.count()

    stages = {
        "fingerprint": lambda: raw.select(fingerprint(F.col("raw"))),
        "route": lambda: route(raw, defs).select("parser", "pattern_id"),
        "extract": lambda: extract_captures(raw, defs).select("parser", "captures"),
        "normalize": lambda: normalize_records(raw, defs).select("event", "errors", "status"),
        "event_json": lambda: event_json(split_outputs(normalize_records(raw, defs))[0]),
        "dedup": lambda: dedup_window(raw),
        "dedup_normalize": lambda: process(raw, defs).select("event", "errors", "status"),
        "dlq": lambda: dlq_records(normalize_records(raw, defs, enum_mode="instance")),
        "metrics": lambda: metrics_table(process(raw, defs), raw),
        "history_last_200": lambda: newest_first(history(normalize_records(raw, defs), defs)),
        "eps": lambda: events_per_second(raw),
    }
    seconds = {}
    for name, build in stages.items():
        for _ in range(2):
            started = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").split("sf")[-1], "records": records, "cpus": int(cpus),
        "events_per_sec": {n: round(records / s) for n, s in seconds.items()},
    }))


if __name__ == "__main__":
    main()
