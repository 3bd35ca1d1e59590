"""The registered queries: every operator over the driver tables, flat columns out."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lognorm.builtin_rules import LINUX_SSHD, builtin_parsers
from lognorm.functions import text as fx
from lognorm.functions.coerce import coerce
from lognorm.functions.expressions import safe_expr
from lognorm.functions.payload import fingerprint
from lognorm.functions.triage import detail_label, harm_tag, preview, search
from lognorm.operators import drafting, enums, metrics, outputs, recent, rules
from lognorm.operators.dedup import dedup_composite, dedup_window, skipped_count
from lognorm.operators.guard import size_guard, verify_envelope, with_envelope, with_payload
from lognorm.operators.payloads import windows_payload as add_windows_payload
from lognorm.operators.route import dry_run as dry_run_one
from lognorm.operators.route import extract_groups, route
from lognorm.operators.validate import error_text
from lognorm.plans.batch import normalize_records, process
from lognorm.schema import CLASS_FIELDS, RAW_LOGS
from lognorm.session import scratch_folder
from lognorm.sources.dlq import read_dlq
from lognorm.sources.parsers import ParserDef, definition_document, parse_definition
from lognorm.sources.raw import read_log_blob, read_log_lines
from lognorm.sources.raw import replicate as copies
from lognorm.sources.raw import to_payload as as_payload
from lognorm.sources.synth import raw_logs, read_events, read_table
from lognorm.streaming import stream
from lognorm.streaming.event_time import EventTimeDedup
from lognorm.streaming.live_metrics import LiveMetrics
from lognorm.streaming.registry import Registry, put_definition

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DEFS = builtin_parsers()

# Writes codes and types the event model refuses, to exercise validation.
LOOSE_SYSLOG = parse_definition({
    "name": "loose_syslog", "version": "0.1.0", "author": "human", "created_at": "2026-09-06",
    "vendor": "generic", "log_format": "syslog", "match_priority": 10,
    "ocsf_class": "authentication", "ocsf_category_uid": 3, "ocsf_class_uid": 3002,
    "match_patterns": [r"<(?P<pri>\d{1,3})>(?P<version>\d*)(?P<rest>.*)"],
    "field_mappings": [
        {"ocsf_field": "severity_id", "type": "int", "expr": "string(coalesce(try_cast(pri AS BIGINT), 0) % 8)"},
        {"ocsf_field": "activity_id", "type": "int", "expr": "string(coalesce(try_cast(pri AS BIGINT), 0) div 8)"},
        {"ocsf_field": "count", "type": "str", "expr": "version"},
        {"ocsf_field": "device.os.version", "type": "str", "expr": "version"},
        {"ocsf_field": "message", "type": "str", "expr": "rest"},
    ],
    "static_values": {"logon_type_id": 3},
}, "loose_syslog.json")


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def micros(ts: str = "ingest_ts") -> Column:
    return F.unix_micros(ts).alias("ingest_us")


def map_text(m: Column) -> Column:
    """A map as sorted ``key=value`` text."""
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ";")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents").withColumn("raw", F.encode("text", "UTF-8"))


def normalized(spark: SparkSession, sf: str, **modes) -> DataFrame:
    return normalize_records(raw_logs(spark, sf), DEFS, **modes)


def of_parser(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(F.col("parser").isin(*names))


# ------------------------------------------------------------------ bytes


@query
def fingerprint_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(
        "doc_id", fingerprint(F.col("raw")).alias("f"), F.octet_length("raw").cast("long").alias("raw_size"),
    ).select("doc_id", "f.algorithm", "f.algorithm_id", F.col("f.value").alias("sha256"), "raw_size")


@query
def size_guard_documents(spark: SparkSession, sf: str) -> DataFrame:
    kept, dropped = size_guard(documents(spark, sf), 4096)
    return kept.select("doc_id", F.lit(True).alias("kept")).unionByName(
        dropped.select("doc_id", F.lit(False).alias("kept")))


@query
def envelope_check(spark: SparkSession, sf: str) -> DataFrame:
    """Stored envelopes, some tampered with; the check names exactly those."""
    path = scratch_folder(spark, "envelopes")
    with_envelope(raw_logs(spark, sf)).write.parquet(path)
    changed = F.when(F.col("event_id") % 97 == 0, F.concat("raw", F.lit(b"!"))).otherwise(F.col("raw"))
    return verify_envelope(spark.read.parquet(path).withColumn("raw", changed)).select("event_id", micros())


@query
def to_payload(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return as_payload(events).select("event_id", F.decode("raw", "UTF-8").alias("payload"))


@query
def replicate(spark: SparkSession, sf: str) -> DataFrame:
    return copies(read_table(spark, sf, "events").select("event_id", "event_type"), 2)


@query
def log_blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Whole files as one record each: the documents of a source and language."""
    path = scratch_folder(spark, "blobs")
    docs = read_table(spark, sf, "documents").where("text IS NOT NULL").select("source", "lang", "doc_id", "text")
    docs.repartition("source", "lang").sortWithinPartitions("source", "lang", "doc_id").drop("doc_id").write.partitionBy("source", "lang").text(path)
    blobs = read_log_blob(spark, f"{path}/*/*")
    part = lambda name: F.regexp_extract(F.col("source"), f"/{name}=([^/]*)/", 1).alias(name)
    return blobs.select(part("source"), part("lang"), fingerprint(F.col("raw"))["value"].alias("sha256"), F.octet_length("raw").cast("long").alias("raw_size"))


@query
def decode_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads with bytes that are no UTF-8: at the start, between characters, cut off at the end."""
    def put(value: bytes) -> Column:
        return F.when(F.col("event_id") % 3 > 0, F.lit(value)).otherwise(F.lit(b""))

    raw = F.concat(put(b"\xff"), F.encode("event_type", "UTF-8"), put(b"\xc3("), F.encode("props", "UTF-8"), put(b"\xc0\x80"), put(b"\xc3"))
    events = read_table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return with_payload(events).select("event_id", "payload", "raw_sha256")


@query
def events_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON lines on disk, read back by their lines."""
    path = scratch_folder(spark, "jsonl")
    events, _ = outputs.split_outputs(normalized(spark, sf))
    outputs.write_events(events, "jsonl", path)
    line = lambda name: F.get_json_object("value", f"$.{name}")
    return spark.read.text(path).select(
        line("class_uid").cast("long").alias("class_uid"), line("raw_data_hash.value").alias("raw_sha256"),
        line("raw_data").alias("raw_data"), line("metadata.product.name").alias("parser"))


# ------------------------------------------------------------------ routing and extraction


@query
def route_first_match(spark: SparkSession, sf: str) -> DataFrame:
    return route(raw_logs(spark, sf), DEFS).select("event_id", micros(), "parser", "pattern_id")


def _many() -> list[ParserDef]:
    """2,000 definitions: a thousand users and 995 orders ahead of the shipped ones."""
    def one(name: str, pattern: str) -> ParserDef:
        return replace(LINUX_SSHD, name=name, match_patterns=(pattern,), field_mappings=(), static_values={}, file=f"{name}.json")

    users = [one(f"user_{n}", rf"(?P<head>.*)\buser{n}\b(?P<rest>.*)") for n in range(1000)]
    orders = [one(f"order_{n}", rf"(?P<head>.*)\border {n}\b(?P<rest>.*)") for n in range(995)]
    return [*users, *orders, *DEFS]


MANY = _many()


@query
def route_many(spark: SparkSession, sf: str) -> DataFrame:
    """Routing and one capture with 2,000 definitions."""
    return extract_groups(raw_logs(spark, sf), MANY).select(
        "event_id", micros(), "parser", "pattern_id",
        F.when(F.col("parser_id") < 1995, F.col("groups")["rest"]).alias("rest"))


def extract(spark: SparkSession, sf: str, parser: str) -> DataFrame:
    definition = next(d for d in DEFS if d.name == parser)
    groups = of_parser(extract_groups(raw_logs(spark, sf), DEFS), parser)
    return groups.select(
        "event_id", micros(), "pattern_id",
        *[F.col("groups")[n].alias(n) for n in definition.group_names])


@query
def extract_sshd(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark, sf, "linux_sshd")


@query
def extract_asa(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark, sf, "cisco_asa")


@query
def extract_syslog(spark: SparkSession, sf: str) -> DataFrame:
    return extract(spark, sf, "rfc5424_fallback")


@query
def dry_run(spark: SparkSession, sf: str) -> DataFrame:
    return dry_run_one(LINUX_SSHD, raw_logs(spark, sf)).select(
        "type_uid", "raw_sha256", "raw_payload", "parser", map_text(F.col("extracted_fields")).alias("fields"),
        "pattern")


# ------------------------------------------------------------------ mapping


@query
def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    k = F.regexp_extract("props", r"\d+", 0)
    kind = F.col("event_id") % 8
    text = (
        F.when(kind == 0, k).when(kind == 1, F.concat(F.lit(" "), k, F.lit(" ")))
        .when(kind == 2, F.concat(k, F.lit(".5"))).when(kind == 3, F.concat(F.lit("x"), k))
        .when(kind == 4, F.lit("YES")).when(kind == 5, F.concat(k, F.lit("d")))
        .when(kind == 6, F.concat(F.lit("-"), k)).otherwise("")
    )
    return read_table(spark, sf, "events").select("event_id", text.alias("text")).select(
        "event_id", "text",
        coerce("text", "int").alias("as_int"),
        coerce("text", "float").alias("as_float"),
        coerce("text", "bool").alias("as_bool"),
        F.when(F.length("text") > 0, coerce("text", "int")).otherwise(7).alias("int_or_default"),
    )


@query
def normalize_auth(spark: SparkSession, sf: str) -> DataFrame:
    e = of_parser(normalized(spark, sf), "linux_sshd")
    return e.select(
        "event_id", micros(), "event.class_uid", "event.category_uid", "event.activity_id", "event.type_uid",
        "event.severity_id", "event.time", F.col("event.user.name").alias("user_name"),
        F.col("event.src_endpoint.ip").alias("src_ip"), F.col("event.src_endpoint.port").alias("src_port"),
        F.col("event.dst_endpoint.hostname").alias("dst_hostname"), "event.auth_protocol",
        "event.auth_protocol_id", "event.service", "event.is_remote", "event.logon_type_id", "event.logon_type",
        "event.raw_data", "event.raw_data_size", F.col("event.raw_data_hash.value").alias("sha256"),
        F.col("event.metadata.product.name").alias("product"),
        F.col("event.metadata.processed_time").alias("processed_time"),
        F.col("event.traffic").isNull().alias("no_traffic"))


@query
def normalize_net(spark: SparkSession, sf: str) -> DataFrame:
    e = of_parser(normalized(spark, sf), "cisco_asa")
    return e.select(
        "event_id", micros(), "event.class_uid", "event.type_uid",
        F.col("event.src_endpoint.ip").alias("src_ip"), F.col("event.src_endpoint.port").alias("src_port"),
        F.col("event.dst_endpoint.ip").alias("dst_ip"), F.col("event.dst_endpoint.port").alias("dst_port"),
        F.col("event.connection_info.protocol_name").alias("protocol_name"),
        F.col("event.traffic.bytes").alias("traffic_bytes"), F.col("event.user").isNull().alias("no_user"))


@query
def normalize_base(spark: SparkSession, sf: str) -> DataFrame:
    e = of_parser(normalized(spark, sf), "macos_unified", "windows_event", "rfc5424_fallback")
    return e.select(
        "event_id", micros(), "parser", "event.class_uid", "event.type_uid", "event.message",
        F.col("event.metadata.product.vendor_name").alias("vendor"),
        F.col("event.metadata.version").alias("ocsf_version"))


@query
def leftovers(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, sf).filter(F.col("parser").isNotNull()).select(
        "event_id", micros(), map_text(F.col("event.unmapped")).alias("unmapped"))


@query
def leftovers_replace(spark: SparkSession, sf: str) -> DataFrame:
    return normalized(spark, sf, unmapped_mode="replace").filter(F.col("parser").isNotNull()).select(
        "event_id", micros(), map_text(F.col("event.unmapped")).alias("unmapped"))


@query
def event_json(spark: SparkSession, sf: str) -> DataFrame:
    events, _ = outputs.split_outputs(of_parser(normalized(spark, sf), "cisco_asa"))
    return outputs.event_json(events).select(F.col("value").alias("event_json"))


@query
def event_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return outputs.event_aliases(normalized(spark, sf)).select("event_id", micros(), "raw_payload", "raw_sha256")


@query
def class_projection(spark: SparkSession, sf: str) -> DataFrame:
    """The events of every class through its own columns."""
    events, _ = outputs.split_outputs(normalized(spark, sf))
    shown = None
    for name in CLASS_FIELDS:
        view = outputs.class_view(events, name)
        own = [F.col(c) if c in view.columns else F.lit(None).cast("string").alias(c) for c in ("service", "auth_protocol")]
        part = view.select(F.lit(name).alias("ocsf_class"), "type_uid", *own)
        shown = part if shown is None else shown.unionByName(part)
    return shown.groupBy("ocsf_class", "type_uid", "service", "auth_protocol").agg(F.count("*").alias("events"))


# ------------------------------------------------------------------ validation and split


def errors_of(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", micros(), "parser", "status", F.size("errors").cast("long").alias("n_errors"),
        F.when(F.size("errors") > 0, error_text(F.col("errors"))).alias("error"))


@query
def validate_code(spark: SparkSession, sf: str) -> DataFrame:
    return errors_of(normalized(spark, sf))


@query
def validate_instance(spark: SparkSession, sf: str) -> DataFrame:
    return errors_of(normalized(spark, sf, enum_mode="instance"))


@query
def validate_strict(spark: SparkSession, sf: str) -> DataFrame:
    return errors_of(normalize_records(raw_logs(spark, sf), [LOOSE_SYSLOG]))


@query
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return process(raw_logs(spark, sf), DEFS).groupBy("parser", "status").agg(F.count("*").alias("records"))


@query
def dlq_records(spark: SparkSession, sf: str) -> DataFrame:
    dead = outputs.dlq_records(normalized(spark, sf, enum_mode="instance"))
    return dead.select("timestamp", "raw_sha256", "error", "raw_payload", "reason", "dlq_date")


@query
def dlq_daily(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "dlq")
    outputs.write_dlq_daily(outputs.dlq_records(normalized(spark, sf)), path)
    by_day = read_dlq(spark, path).groupBy(F.col("dlq_date").cast("string").alias("dlq_date"), "error")
    return by_day.agg(F.count("*").alias("records"), F.min("raw_sha256").alias("first_sha256"))


@query
def history_all(spark: SparkSession, sf: str) -> DataFrame:
    h = outputs.history(normalized(spark, sf), DEFS)
    return h.select(micros(), *[c for c in h.columns if c != "ingest_ts"])


@query
def history_last_200(spark: SparkSession, sf: str) -> DataFrame:
    h = recent.newest_first(outputs.history(process(raw_logs(spark, sf), DEFS), DEFS))
    return h.select(micros(), *[c for c in h.columns if c != "ingest_ts"])


# ------------------------------------------------------------------ dedup


@query
def dedup_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_window(raw_logs(spark, sf)).select("event_id", micros())


@query
def dedup_hot_hash(spark: SparkSession, sf: str) -> DataFrame:
    """One payload owns a third of all records; its chain is solved by the parallel scan."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("-- MARK --")).otherwise(F.decode("raw", "UTF-8"))
    logs = raw_logs(spark, sf).withColumn("raw", F.encode(hot, "UTF-8"))
    return dedup_window(logs, hot_rows=1000).select(F.sha2("raw", 256).alias("raw_sha256"), micros())


@query
def dedup_total(spark: SparkSession, sf: str) -> DataFrame:
    logs = raw_logs(spark, sf)
    return skipped_count(logs, dedup_window(logs))


@query
def dedup_first_of_key(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return dedup_composite(docs, "source", "lang", "text").select("source", "lang", "text")


def pairs(df: DataFrame) -> DataFrame:
    return df.select(F.sha2("raw", 256).alias("raw_sha256"), micros())


@query
def dedup_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Records without payload or time have no duplicates and all stay."""
    logs = raw_logs(spark, sf).withColumns({
        "raw": F.when(F.col("event_id") % 13 != 0, F.col("raw")),
        "ingest_ts": F.when(F.col("event_id") % 17 != 0, F.col("ingest_ts"))})
    return pairs(dedup_window(logs))


@query
def dedup_many_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Nearly every payload comes again."""
    logs = raw_logs(spark, sf).withColumn("raw", F.encode(F.concat(F.lit("p"), F.col("event_id") % 3000), "UTF-8"))
    return pairs(dedup_window(logs))


@query
def dedup_text_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written out and read with the default stamp: each text once."""
    path = scratch_folder(spark, "lines")
    raw_logs(spark, sf).select(F.decode("raw", "UTF-8")).write.text(path)
    return dedup_window(read_log_lines(spark, path)).select(F.sha2("raw", 256).alias("raw_sha256"))


@query
def dlq_oversize(spark: SparkSession, sf: str) -> DataFrame:
    """Long documents are dead letters, not lost."""
    raw = as_payload(read_table(spark, sf, "documents"), ["doc_id", "text"]).select(
        F.encode("text", "UTF-8").alias("raw"), F.lit(datetime(2026, 9, 6)).alias("ingest_ts"), "source")
    return outputs.dlq_records(process(raw, DEFS, dedup_seconds=None, max_bytes=4096)).groupBy("reason", "error").agg(
        F.count("*").alias("records"), F.count_distinct("raw_sha256").alias("payloads"))


@query
def metrics_with_drops(spark: SparkSession, sf: str) -> DataFrame:
    """Taken in = processed + duplicates, with long and missing payloads counted on their own."""
    e = F.col("event_id")
    logs = raw_logs(spark, sf).withColumn("raw", F.when(e % 13 != 0, F.when(
        e % 29 == 0, F.encode(F.repeat(F.lit("x"), F.lit(70_000)), "UTF-8")).otherwise(F.col("raw"))))
    m = metrics.metrics_table(process(logs, DEFS), logs)
    total = lambda name, label=None: F.coalesce(F.sum(F.when(
        (F.col("metric") == name) & (F.lit(True) if label is None else F.col("label").startswith(label)), F.col("value"))), F.lit(0))
    return m.agg(
        total("ingest_total").alias("ingested"), total("dlq_total", "oversize,").alias("oversize"),
        total("dlq_total", "null_payload,").alias("null_payload"),
        (total("ingest_total") - total("dedup_total") - total("matched_total") - total("dlq_total", "unmatched,")
         - total("dlq_total", "oversize,") - total("dlq_total", "null_payload,")).alias("lost"))


# ------------------------------------------------------------------ metrics and recent


@query
def metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    logs = raw_logs(spark, sf)
    return metrics.metrics_table(process(logs, DEFS, enum_mode="instance"), logs)


@query
def metrics_totals(spark: SparkSession, sf: str) -> DataFrame:
    logs = raw_logs(spark, sf)
    return metrics.totals(metrics.metrics_table(process(logs, DEFS), logs))


@query
def matched_by_parser(spark: SparkSession, sf: str) -> DataFrame:
    done = normalize_records(raw_logs(spark, sf), [LOOSE_SYSLOG, *DEFS])
    return metrics.matched_by_parser(done).join(metrics.validation_failed_by_parser(done), "parser")


@query
def dlq_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.dlq_by_reason(normalize_records(raw_logs(spark, sf), [LOOSE_SYSLOG, *DEFS]))


@query
def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    timed = read_table(spark, sf, "events").select("event_type", (F.col("value") / 10).alias("seconds"))
    return metrics.latency_histogram(timed, "seconds", "event_type").withColumn(
        "latency_sum", F.round("latency_sum", 3))


@query
def parser_share(spark: SparkSession, sf: str) -> DataFrame:
    last = recent.newest_first(outputs.history(process(raw_logs(spark, sf), DEFS), DEFS))
    return metrics.parser_share(last)


@query
def eps_window(spark: SparkSession, sf: str) -> DataFrame:
    return recent.events_per_second(raw_logs(spark, sf)).select(
        F.unix_seconds("second").alias("second_s"), "events")


def counter_samples(spark: SparkSession, sf: str) -> DataFrame:
    """``event_id`` as a running counter that restarts now and then."""
    return read_table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id", (F.col("event_id") % 1000).alias("value"))


@query
def eps_lag(spark: SparkSession, sf: str) -> DataFrame:
    return recent.rate_from_counter(counter_samples(spark, sf)).select("event_id", "value", "rate")


@query
def eps_lag_series(spark: SparkSession, sf: str) -> DataFrame:
    """Three counters, each event sampled a hundred times, all within one hour."""
    e, i = F.col("event_id"), F.col("i")
    samples = read_events(spark, sf).select("event_id", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("i")).select(
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + (e * 100 + i) % 3_600_000_000).alias("ts"),
        F.least(e % 4, F.lit(2)).alias("series"), ((e * 100 + i) % 70_001).alias("value"))
    rates = recent.rate_from_counter(samples, series="series", rows=100_000)
    return rates.groupBy("series").agg(
        F.count("*").alias("samples"), F.sum("rate").alias("total"), F.max("rate").alias("most"), F.count_if(F.col("rate") == 0).alias("resets"))


@query
def last_30_points(spark: SparkSession, sf: str) -> DataFrame:
    eps = recent.events_per_second(raw_logs(spark, sf))
    return recent.last_n(eps, recent.CHART_POINTS, F.col("second").desc()).select(
        F.unix_seconds("second").alias("second_s"), "events")


@query
def last_30_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return recent.last_n(
        raw_logs(spark, sf), recent.CHART_POINTS, F.col("ingest_ts").desc(), F.col("event_id"), by="source"
    ).select("source", "event_id", micros())


# ------------------------------------------------------------------ triage


@query
def harm_tags(spark: SparkSession, sf: str) -> DataFrame:
    return with_payload(raw_logs(spark, sf)).select("event_id", micros(), harm_tag(F.col("payload")).alias("tag"))


@query
def harm_tag_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "conversations").select("conv_id", "turn", harm_tag(F.col("text")).alias("tag"))


@query
def search_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return search(read_table(spark, sf, "conversations"), "The", ["role", "text"]).select("conv_id", "turn")


@query
def search_history(spark: SparkSession, sf: str) -> DataFrame:
    h = outputs.history(normalized(spark, sf), DEFS)
    return search(h, "HOST7 ", ["status", "parser", "raw_sha256", "raw_payload"]).select(micros(), "raw_sha256")


@query
def detail_labels(spark: SparkSession, sf: str) -> DataFrame:
    h = outputs.history(normalized(spark, sf), DEFS)
    return h.select(micros(), "raw_sha256", detail_label(F.col("raw_payload"), F.col("type_uid")).alias("details"),
                    preview(F.col("raw_payload")).alias("preview"))


# ------------------------------------------------------------------ enums and payloads


def coded_events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select("event_id", (F.col("event_id") % 14).alias("logon_type_id"))


@query
def enum_caption(spark: SparkSession, sf: str) -> DataFrame:
    return enums.with_caption(coded_events(spark, sf), "logon_type_id", "LogonTypeId")


@query
def invalid_codes(spark: SparkSession, sf: str) -> DataFrame:
    return enums.invalid_codes(coded_events(spark, sf), "logon_type_id", "LogonTypeId")


@query
def windows_payload(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    events = read_table(spark, sf, "events").select(
        e, F.when(e % 3 > 0, F.concat(F.lit("PC"), F.col("user_id"))).alias("MachineName"),
        F.when(e % 5 > 0, 4000 + e % 700).alias("Id"), F.when(e % 7 > 0, F.col("event_type")).alias("Message"),
        F.lit("Shop").alias("ProviderName"), F.lit(None).cast("string").alias("LevelDisplayName"))
    return add_windows_payload(events).select("event_id", F.decode("raw", "UTF-8").alias("payload"))


# ------------------------------------------------------------------ definitions


def definitions(spark: SparkSession, sf: str) -> DataFrame:
    """A registry with one definition per event, some of them broken in one way or another."""
    e = F.col("event_id")
    mappings = F.array(
        F.struct(F.lit("message").alias("ocsf_field"), F.when(e % 29 == 0, "number").otherwise("str").alias("type"),
                 F.lit("text").alias("expr"), F.lit(None).cast("string").alias("default")),
        F.struct(F.when(e % 31 == 0, "src_endpoint.ipv4").when(e % 37 == 0, "unmapped.x").otherwise("message")
                 .alias("ocsf_field"), F.lit("str").alias("type"), F.lit("text").alias("expr"),
                 F.lit(None).cast("string").alias("default")))
    return read_table(spark, sf, "events").select(
        F.concat(F.lit("def"), e, F.lit(".json")).alias("file"),
        (e % 41 != 0).alias("is_object"),
        F.when(e % 11 > 0, F.concat(F.lit("p"), e)).alias("name"),
        F.when(e % 13 == 0, F.concat(F.lit("v"), e)).otherwise(F.concat(e, F.lit(".0.1-rc"))).alias("version"),
        F.when(e % 17 == 0, F.lit("bot")).when(e % 2 == 0, F.lit("ai:m")).otherwise("human").alias("author"),
        F.lit("2026-09-06T00:00:00Z").alias("created_at"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("vendor"), F.col("user_id")).alias("vendor"),
        F.lit("text").alias("log_format"),
        F.when(e % 19 == 0, F.array().cast("array<string>"))
        .when(e % 23 == 0, F.array(F.lit(r"(?P<text>\w+)"), F.lit("([unclosed")))
        .otherwise(F.array(F.concat(F.lit("(?P<text>event "), e, F.lit(")")))).alias("match_patterns"),
        (e * 7 % 50).alias("match_priority"),
        F.when(e % 3 == 0, "authentication").otherwise("base_event").alias("ocsf_class"),
        F.lit(0).cast("long").alias("ocsf_category_uid"),
        F.when(e % 43 == 0, 9999).when(e % 3 == 0, 3002).otherwise(0).cast("long").alias("ocsf_class_uid"),
        mappings.alias("field_mappings"),
        F.create_map().cast("map<string,string>").alias("static_values"),
    )


@query
def parser_order(spark: SparkSession, sf: str) -> DataFrame:
    """Routing position of each definition within its vendor's registry."""
    # Every second definition leaves its priority to the default.
    some = F.when(F.col("match_priority") % 2 == 0, F.col("match_priority"))
    return rules.routing_places(definitions(spark, sf).withColumn("match_priority", some), "vendor").select("vendor", "file", "place")


@query
def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    return rules.rule_violations(definitions(spark, sf))


@query
def valid_definitions(spark: SparkSession, sf: str) -> DataFrame:
    return rules.valid_definitions(definitions(spark, sf)).select("file")


@query
def lint_paths(spark: SparkSession, sf: str) -> DataFrame:
    return rules.lint_paths(definitions(spark, sf)).select("file", "ocsf_class", "path")


# ------------------------------------------------------------------ expressions


@query
def expr_text(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "text", fx.split(t, " ").alias("words"))
    words = F.col("words")
    return docs.select(
        "doc_id",
        F.sha2(F.lower(t), 256).alias("lower"), F.sha2(F.upper(t), 256).alias("upper"),
        F.sha2(fx.trim(t), 256).alias("trim"),
        F.sha2(F.replace(t, F.lit("a"), F.lit("b")), 256).alias("replaced"),
        F.sha2(fx.join(words, ";"), 256).alias("joined"),
        fx.first(words).alias("first_word"), fx.last(words).alias("last_word"),
        F.length(t).cast("long").alias("chars"), F.size(words).cast("long").alias("n_words"),
        F.sha2(fx.indent(t), 256).alias("indented"),
        F.sha2(fx.regex_replace(t, "([aeiou])\\1*", "<\\1>"), 256).alias("vowels"),
        F.sha2(fx.join(fx.batch(words, 3)[0], "|"), 256).alias("first_batch"),
        F.size(fx.batch(words, 3)).cast("long").alias("n_batches"),
        F.sha2(fx.join(F.filter(words, lambda w: F.length(w) > 3), " "), 256).alias("long_words"),
        fx.capitalize(F.col("lang")).alias("capitalized"),
    )


@query
def expr_numbers(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    text = F.when(e % 4 == 0, F.concat(F.lit("x"), e)).otherwise(e.cast("string"))
    events = read_table(spark, sf, "events").select("event_id", "value", "event_type", text.alias("text"))
    return events.select(
        "event_id",
        fx.to_int(F.col("text")).alias("int_or_0"), fx.to_float(F.col("text")).alias("float_or_0"),
        F.expr("event_id div 8").alias("div_8"), (e % 8).alias("mod_8"),
        F.abs(F.lit(500) - e).alias("distance"), F.round("value", 0).alias("rounded"),
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("outcome"),
        F.concat(F.col("event_type"), F.lit(":"), F.col("text")).alias("joined"),
        fx.center(F.col("event_type"), 11).alias("centered"),
        fx.wordcount(F.concat(F.col("event_type"), F.lit(" and more"))).cast("long").alias("words"),
        fx.default(F.lit(None).cast("string"), F.lit("fallback")).alias("defaulted"),
        fx.join(fx.sort(F.array(F.lit("b"), F.col("event_type"), F.lit("A"))), ",").alias("sorted"),
        fx.join(fx.unique(F.array(F.lit("Click"), F.col("event_type"), F.lit("VIEW"))), ",").alias("uniques"),
    )


#: What machine-drafted definitions may write, by output column.
HOSTILE_EXPRESSIONS = {
    "upper_text": "upper(v)", "number": "string(coalesce(try_cast(v AS BIGINT), -1))", "distance": "string(abs(try_cast(v AS BIGINT)))",
    "digits": "regexp_extract(v, '([0-9]+)', 1)", "opened": "regexp_replace(v, '[(]', '<')", "second": "try_element_at(split(v, ','), 2)",
    "padded": "lpad(v, 12, '*')", "last_part": "split_part(v, ',', -1)", "told": "case when v like '%(%' then 'open' else w end",
    "both": "concat_ws(';', v, w)", "doubled": "replace(v, '9', '88')", "pieces": "string(size(split(v, '(')))",
    "total": "string(try_add(try_cast(v AS BIGINT), try_cast(w AS BIGINT)))", "third": "string(try_cast(v AS BIGINT) div 3)",
}


@query
def hostile_values(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted expressions on every pair of values that raise, overflow or grow where nothing guards."""
    e = F.col("event_id")

    def value(n: Column) -> Column:
        texts = ["", "(", "x", "-9223372036854775808", "9" * 400, "$9\\", "a,(b" * 2_000, None]
        return F.get(F.array(*[F.lit(t) for t in texts]), n.cast("int"))

    groups = F.create_map(F.lit("v"), value(e % 8), F.lit("w"), value(F.floor(e / 8) % 8))
    events = read_table(spark, sf, "events").select("event_id", groups.alias("groups"))
    return events.select("event_id", *[F.sha2(safe_expr(text, ["v", "w"]), 256).alias(name) for name, text in HOSTILE_EXPRESSIONS.items()])


# ------------------------------------------------------------------ drafting


def fake_generator(system: str, user: str) -> str:
    """Stands in for a model: some answers are good at once, some after a retry, some never."""
    payload = user.split("\n")[1]
    n = int("".join(c for c in payload.split(",")[0] if c.isdigit()) or 0)
    kind = n // 3 % 3
    good = json.dumps({
        "name": f"csv_{n}", "version": "1.0.0", "author": "ai:fake", "created_at": "2026-09-06T00:00:00Z",
        "vendor": "shop", "log_format": "csv", "ocsf_class": "base_event", "ocsf_category_uid": 0,
        "ocsf_class_uid": 0, "match_patterns": [r"(?P<id>\d+),(?P<message>.*)"],
        "field_mappings": [{"ocsf_field": "message"}],
    })
    if kind == 0:
        return f"```json\n{good}\n```"
    if kind == 1:
        return good if "refused" in user else "[]"
    return '{"name": "half"}'


def drafted(spark: SparkSession, sf: str) -> DataFrame:
    return drafting.draft_parsers(
        outputs.dlq_records(normalized(spark, sf)), fake_generator, "fake", max_retries=2)


@query
def draft_parsers(spark: SparkSession, sf: str) -> DataFrame:
    return drafted(spark, sf).select(
        "raw_sha256", "model", "status", F.col("attempts").cast("long").alias("attempts"),
        F.get_json_object("definition", "$.name").alias("parser"))


@query
def draft_totals(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.draft_totals(drafting.draft_attempts(drafted(spark, sf)))


@query
def dlq_after_drafting(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = drafting.handle_dlq(
        outputs.dlq_records(normalized(spark, sf)), "openai", fake_generator, "fake", max_retries=0)
    return kept.select("raw_sha256", F.left("error", F.lit(21)).alias("error_head"), "raw_payload")


@query
def promote_drafts(spark: SparkSession, sf: str) -> DataFrame:
    waiting = drafting.pending(drafted(spark, sf))
    approved = waiting.filter(F.col("raw_sha256") < "8").select("raw_sha256")
    return drafting.promote(waiting, approved).select("raw_sha256", "status")


# ------------------------------------------------------------------ streaming


#: Rows of a landed file, about.
_FILE_ROWS = 250_000


def landed(spark: SparkSession, sf: str) -> str:
    """The raw logs as a folder of files, split by time so that batches come in time order."""
    path = scratch_folder(spark, "landed")
    logs = raw_logs(spark, sf).select("raw", "ingest_ts", "source")
    logs.repartitionByRange(max(4, -(-logs.count() // _FILE_ROWS)), "ingest_ts").write.parquet(path)
    return path


def landed_parts(spark: SparkSession, path: str, parts: list[DataFrame], rows: int) -> int:
    """Writes parts one after the other, each as the same number of files, which is returned.

    A stream that takes so many files a micro-batch reads one part in each. ``rows``: of the
    largest part. Where a part is too small for its files, empty ones make up the number.
    """
    files, found = max(1, -(-rows // _FILE_ROWS)), 0
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
        due = found + files
        while (found := len(spark.read.schema(RAW_LOGS).parquet(path).inputFiles())) < due:
            spark.createDataFrame([], RAW_LOGS).coalesce(1).write.mode("append").parquet(path)
    return files


@query
def stream_normalize(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_folder(spark, "stream")
    running = stream.run_stream(
        stream.stream_logs(spark, landed(spark, sf), format="parquet"), DEFS,
        stream.parquet_sink(f"{out}/events"), stream.parquet_sink(f"{out}/dlq"), f"{out}/checkpoint",
        trigger={"availableNow": True}, dedup_seconds=None)
    running.awaitTermination()
    events = spark.read.parquet(f"{out}/events").select(
        F.col("raw_data_hash.value").alias("raw_sha256"), "class_uid", F.lit("").alias("reason"))
    dead = spark.read.parquet(f"{out}/dlq").select("raw_sha256", F.lit(-1).cast("long").alias("class_uid"), "reason")
    return events.unionByName(dead).groupBy("class_uid", "reason").agg(
        F.count("*").alias("records"), F.countDistinct("raw_sha256").alias("payloads"))


@query
def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Counters that a stream with dedup kept while it ran."""
    out = scratch_folder(spark, "stream")
    folder, files = landed_in_order(spark, raw_logs(spark, sf), span=3 * _LANDING)
    live = LiveMetrics(spark)
    try:
        stream.run_stream(
            stream.stream_logs(spark, folder, max_files=files, format="parquet"), DEFS,
            stream.parquet_sink(f"{out}/events"), stream.parquet_sink(f"{out}/dlq"), f"{out}/checkpoint",
            trigger={"availableNow": True}, enum_mode="instance", live=live).awaitTermination()
        live.wait()
    finally:
        live.close()
    return live.table()


#: What is promoted while ``stream_promote`` runs.
SHOP_CSV = {
    "name": "shop_csv", "version": "1.0.0", "author": "human", "created_at": "2026-09-06T00:00:00Z", "vendor": "shop",
    "log_format": "csv", "ocsf_class": "base_event", "ocsf_category_uid": 0, "ocsf_class_uid": 0,
    "match_patterns": [r"(?P<order_id>\d+),(?P<message>[^\n]*)"], "field_mappings": [{"ocsf_field": "message"}],
}


@query
def stream_promote(spark: SparkSession, sf: str) -> DataFrame:
    """A definition put into the registry after the first of two micro-batches holds from the second on."""
    out = scratch_folder(spark, "stream")
    logs = raw_logs(spark, sf)
    half = F.col("event_id") % 2
    files = landed_parts(spark, f"{out}/landed", [logs.where(half == part).select("raw", "ingest_ts", "source") for part in (0, 1)],
                         logs.where(half == 0).count())
    put_definition(spark, f"{out}/registry", "sshd.json", json.dumps(definition_document(LINUX_SSHD)))

    def dead(df: DataFrame, batch_id: int) -> None:
        stream.parquet_sink(f"{out}/dlq")(df, batch_id)
        put_definition(spark, f"{out}/registry", "shop.json", json.dumps(SHOP_CSV))

    stream.run_stream(
        stream.stream_logs(spark, f"{out}/landed", max_files=files, format="parquet"), Registry(spark, f"{out}/registry", f"{out}/versions"),
        stream.parquet_sink(f"{out}/events"), dead, f"{out}/checkpoint", trigger={"availableNow": True}, dedup_seconds=None).awaitTermination()
    events = spark.read.parquet(f"{out}/events").select(F.col("metadata.product.name").alias("parser"), F.col("batch_id").cast("long").alias("batch"),
                                                        F.col("raw_data_hash.value").alias("raw_sha256"))
    rest = spark.read.parquet(f"{out}/dlq").select(F.lit("").alias("parser"), F.col("batch_id").cast("long").alias("batch"), "raw_sha256")
    return events.unionByName(rest).groupBy("batch", "parser").agg(F.count("*").alias("records"), F.countDistinct("raw_sha256").alias("payloads"))


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_folder(spark, "stream")
    accepted = stream.dedup_stream(stream.stream_logs(spark, landed(spark, sf), format="parquet"))
    running = (
        accepted.writeStream.format("parquet").option("path", f"{out}/accepted")
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    running.awaitTermination()
    return spark.read.parquet(f"{out}/accepted").select("raw_sha256", micros())


#: Records land in files of five days of arrival.
_LANDING = 5 * 86_400_000_000


def landed_late(spark: SparkSession, sf: str, arrival: str) -> tuple[str, int]:
    """The raw logs, a third of them one payload, in files by arrival time (SQL over ``event_id, us``), the first first."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("-- MARK --")).otherwise(F.decode("raw", "UTF-8"))
    return landed_in_order(spark, raw_logs(spark, sf).withColumn("raw", F.encode(hot, "UTF-8")), arrival)


def landed_in_order(spark: SparkSession, logs: DataFrame, arrival: str = "us", span: int = _LANDING) -> tuple[str, int]:
    """Logs in files by arrival time (SQL over ``event_id, us``), the first written first: (folder, files of each span)."""
    path = scratch_folder(spark, "landed")
    filed = logs.withColumn("us", F.unix_micros("ingest_ts")).withColumn("file", F.expr(f"({arrival}) div {span}"))
    rows = {r["file"]: r["count"] for r in filed.where("file IS NOT NULL").groupBy("file").count().collect()}  # one row for each span of time
    parts = [filed.where(F.col("file") == n).select("raw", "ingest_ts", "source") for n in range(min(rows), max(rows) + 1)]
    return path, landed_parts(spark, path, parts, max(rows.values()))


def drained(spark: SparkSession, folder: str, files: int, seconds: int, delay: int) -> tuple[DataFrame, DataFrame]:
    """(accepted, late) of a folder read ``files`` at a time, the stream finished."""
    out = scratch_folder(spark, "stream")
    dedup = EventTimeDedup(spark, f"{out}/dedup", seconds, delay)
    batches = []

    def write(batch: DataFrame, batch_id: int) -> None:
        accepted, late = dedup(batch, batch_id)
        accepted.write.mode("overwrite").parquet(f"{out}/accepted/{batch_id}")
        late.write.mode("overwrite").parquet(f"{out}/late/{batch_id}")
        batches.append(batch_id)

    logs = stream.stream_logs(spark, folder, max_files=files, format="parquet")
    logs.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    dedup.finish(max(batches) + 1).write.parquet(f"{out}/accepted/{max(batches) + 1}")
    read = lambda kind: spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/{kind}")
    return read("accepted"), read("late")


@query
def stream_dedup_late_order(spark: SparkSession, sf: str) -> DataFrame:
    """Records arrive up to 90 minutes after their time; a third of them is one payload."""
    folder, files = landed_late(spark, sf, "us + event_id * 7919 % 5400 * 1000000")
    accepted, late = drained(spark, folder, files, 300, 7200)
    return accepted.unionByName(late).select("raw_sha256", micros())


@query
def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """One record in fifty arrives five days after its time; what becomes of all."""
    arrival = "us + IF(event_id % 50 = 7, 432000, event_id * 7919 % 5400) * 1000000"
    folder, files = landed_late(spark, sf, arrival)
    accepted, late = drained(spark, folder, files, 300, 7200)
    taken = spark.read.parquet(folder).agg(F.count("*").alias("n")).select(F.lit("input").alias("what"), "n")
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n") for name, df in (("accepted", accepted), ("late", late))]
    rows = taken.unionAll(counted[0]).unionAll(counted[1])
    return rows.groupBy().pivot("what", ["input", "accepted", "late"]).sum("n").select(
        F.col("input").alias("records"), "accepted", "late", (F.col("input") - F.col("accepted") - F.col("late")).alias("duplicates"))
