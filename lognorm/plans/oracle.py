"""The registered queries once more as ANSI SQL (DuckDB), for checking results."""

from __future__ import annotations

import re

from lognorm.builtin_rules import builtin_parsers
from lognorm.functions.triage import HARM_WORDS
from lognorm.operators.metrics import LATENCY_BUCKETS
from lognorm.plans.queries import LOOSE_SYSLOG
from lognorm.schema import CLASS_FIELDS, ENUMS, OBJECTS, members
from lognorm.sources.parsers import ParserDef

DEFS = builtin_parsers()


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows) + ")"


# ------------------------------------------------------------------ log lines

_TIME = "strftime(ts, '%b %d %H:%M:%S')"
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_E, _U = "event_id", "user_id"
_IP = "user_id % 256, event_id % 256"
_PORT = "1024 + event_id % 60000"


def _sshd(words: str) -> str:
    return (f"printf('%s host%d sshd[%d]: {words} from 10.0.%d.%d port %d ssh2', "
            f"{_TIME}, {_U} % 50, {_E} % 30000, {_U}, {_IP}, {_PORT})")


RAW = f"""WITH arrivals AS (
  SELECT *, unnest(CASE WHEN event_id % 10 = 0 THEN [0, event_id % 700] ELSE [0] END) AS delay FROM events
), raw_logs AS (
  SELECT event_id, ts + to_seconds(delay) AS ingest_ts, epoch_us(ts) + delay * 1000000 AS ingest_us,
    event_type AS source,
    CASE event_type
    WHEN 'signup' THEN CASE event_id % 2 WHEN 0 THEN {_sshd('Accepted password for user%d')}
      ELSE {_sshd('Accepted publickey for user%d')} END
    WHEN 'error' THEN CASE event_id % 2 WHEN 0 THEN {_sshd('Failed password for invalid user user%d')}
      ELSE {_sshd('Failed password for user%d')} END
    WHEN 'click' THEN CASE event_id % 3
      WHEN 0 THEN printf('%%ASA-6-302013: Built inbound TCP connection %d for outside:10.0.%d.%d/%d (10.0.%d.%d/%d) to inside:192.168.1.%d/443 (192.168.1.%d/443)',
        {_E}, {_IP}, {_PORT}, {_IP}, {_PORT}, {_U} % 256, {_U} % 256)
      WHEN 1 THEN printf('%%ASA-6-302014: Teardown UDP connection %d for outside:10.0.%d.%d/%d to inside:192.168.1.%d/443 duration 0:%02d:%02d bytes %d',
        {_E}, {_IP}, {_PORT}, {_U} % 256, {_E} % 60, {_U} % 60, {_E} * 7)
      ELSE printf('%%ASA-4-106023: Deny tcp src outside:10.0.%d.%d/%d dst inside:192.168.1.%d/443 by access-group "outside_in"',
        {_IP}, {_PORT}, {_U} % 256) END
    WHEN 'view' THEN CASE event_id % 2
      WHEN 0 THEN printf('<%d>1 %s host%d app%d %d ID%d [meta seq="%d"] page viewed by user%d',
        {_E} % 192, {_ISO}, {_U} % 50, {_U} % 7, {_E} % 30000, {_E} % 100, {_E}, {_U})
      ELSE printf('<%d>%s host%d app%d: page viewed by user%d', {_E} % 192, {_TIME}, {_U} % 50, {_U} % 7, {_U}) END
    ELSE CASE event_id % 3
      WHEN 0 THEN CASE event_id % 2
        WHEN 0 THEN printf('{{"EventID": %d, "MachineName": "PC%d", "Message": "order %d failed"}}', 4000 + {_E} % 1000, {_U} % 500, {_E})
        ELSE printf('{{"Event": {{"System": {{"Level": {{"n": %d}}}}}}, "Script": "if (x) {{", "EventID": %d, "MachineName": "PC%d", "Message": "order %d failed"}}',
          {_E} % 6, 4000 + {_E} % 1000, {_U} % 500, {_E}) END
      WHEN 1 THEN CASE event_id % 2
        WHEN 0 THEN printf('{{"eventMessage":"order %d placed","subsystem":"com.example.shop%d"}}', {_E}, {_U} % 9)
        ELSE printf('{{"trace":{{"ids":{{"a":{{"b":%d}}}}}},"eventMessage":"order %d }} placed","subsystem":"com.example.shop%d"}}', {_E} % 10, {_E}, {_U} % 9) END
      ELSE printf('%d,%s,order,user%d,THREAT,denied', {_E}, {_ISO}, {_U}) END
    END AS payload
  FROM arrivals
)"""


def _pattern(p: str) -> str:
    """DuckDB's engine has no possessive repetition and needs none."""
    return text("^(?:" + re.sub(r"([*+])\+", r"\1", p) + ")")


def _routes(defs: list[ParserDef]) -> str:
    """CTEs ``routed`` (parser, pattern_id per record)."""
    whens, names, i = [], [], 0
    for d in defs:
        for p in d.match_patterns:
            whens.append(f"WHEN regexp_matches(payload, {_pattern(p)}) THEN {i}")
            names.append((i, text(d.name), text(d.ocsf_class)))
            i += 1
    return f""", numbered AS (SELECT *, CASE {' '.join(whens)} END AS pattern_id FROM records
), routed AS (SELECT numbered.*, parser, ocsf_class FROM numbered
  LEFT JOIN {values(names)} AS n(id, parser, ocsf_class) ON pattern_id = id)"""


def _groups(parser: str) -> str:
    """Rows of one parser with a column per group name; null where the pattern has no such name."""
    definition = next(d for d in DEFS if d.name == parser)
    first = sum(len(d.match_patterns) for d in DEFS[:DEFS.index(definition)])
    parts = []
    for i, p in enumerate(definition.match_patterns):
        own = list(re.compile(p).groupindex)
        listed = ", ".join(text(n) for n in own)
        cols = ", ".join(f"g.{n} AS {n}" if n in own else f"NULL::VARCHAR AS {n}" for n in definition.group_names)
        anchored = _pattern(p)
        parts.append(f"SELECT event_id, ingest_us, ingest_ts, payload, pattern_id, {cols} FROM (SELECT *, "
                     f"regexp_extract(payload, {anchored}, [{listed}]) AS g FROM routed WHERE pattern_id = {first + i})")
    return "(" + " UNION ALL BY NAME ".join(parts) + ")"


ALL = RAW + ", records AS (SELECT * FROM raw_logs)" + _routes(DEFS)
# The greedy window per payload hash: a time is kept when the last kept one is over 300 s back.
_KEPT = """, kept AS (
  SELECT h, unnest(list_reduce(
    list_transform(list_sort(list(DISTINCT ingest_us)), lambda t: [t]),
    lambda acc, x: CASE WHEN x[1] - acc[len(acc)] > 300000000 THEN list_concat(acc, x) ELSE acc END)) AS ingest_us
  FROM (SELECT sha256(payload) AS h, ingest_us FROM {source}) GROUP BY h
)"""
DEDUPED = RAW + _KEPT.format(source="raw_logs") + """, records AS (
  SELECT event_id, ingest_ts, ingest_us, source, payload FROM raw_logs
  SEMI JOIN kept ON sha256(raw_logs.payload) = kept.h AND raw_logs.ingest_us = kept.ingest_us
  QUALIFY row_number() OVER (PARTITION BY sha256(payload), ingest_us) = 1)""" + _routes(DEFS)


def _pairs(names: list[str], extra: list[str] = ()) -> str:
    """Sorted ``name=value`` text of the non-empty columns."""
    items = [f"CASE WHEN {n} <> '' THEN '{n}=' || {n} END" for n in names] + list(extra)
    return f"array_to_string(list_sort(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)), ';')"


def _unmapped(merge: bool) -> str:
    out = []
    for d in DEFS:
        rest = [n for n in d.group_names if n not in d.mapped_leaves]
        extra = []
        if d.name == "rfc5424_fallback" and merge:
            extra = ["CASE WHEN hostname <> '' THEN 'hostname=' || hostname END",
                     "'facility=' || (pri::BIGINT // 8)", "'syslog_severity=' || (pri::BIGINT % 8)",
                     "CASE WHEN coalesce(procid, '-') <> '' THEN 'procid=' || coalesce(procid, '-') END",
                     "CASE WHEN coalesce(msgid, '-') <> '' THEN 'msgid=' || coalesce(msgid, '-') END",
                     "CASE WHEN coalesce(structured_data, '-') <> '' THEN 'structured_data=' || coalesce(structured_data, '-') END"]
        # msg is left over for the JSON formats: its name is no mapped leaf name
        out.append(f"SELECT event_id, ingest_us, {_pairs(rest, extra)} AS unmapped FROM {_groups(d.name)}")
    return " UNION ALL ".join(out)


_STATUS = "CASE WHEN pattern_id IS NULL THEN 'dlq' ELSE 'success' END"
_UTC = "strftime(ingest_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_ENUM_ERROR = "'OCSF validation failed: ' || " + \
    "CASE WHEN ocsf_class = 'base_event' THEN 'severity_id enum_instance input=1' " \
    "ELSE 'severity_id enum_instance input=1; activity_id enum_instance input=0' END"
_BUILTIN_ENUM = "parser IN ('cisco_asa', 'linux_sshd', 'rfc5424_fallback')"
_TYPE_UID = "CASE ocsf_class WHEN 'authentication' THEN 300200 WHEN 'network_activity' THEN 400100 WHEN 'base_event' THEN 0 END"
_MESSAGE = """CASE WHEN parser IN ('macos_unified', 'windows_event') THEN payload
  WHEN parser = 'rfc5424_fallback' THEN 'page viewed by user' || regexp_extract(payload, 'user(\\d+)$', 1) END"""
# Syslog 3164 keeps the tag in the message.
_FULL_MESSAGE = _MESSAGE.replace(
    "'page viewed", "CASE WHEN pattern_id = 8 THEN '' ELSE regexp_extract(payload, '(app\\d+: )', 1) END || 'page viewed")
_HISTORY = f"""SELECT ingest_us, {_STATUS} AS status, coalesce(parser, 'None (Unmatched)') AS parser,
  ({_TYPE_UID})::BIGINT AS type_uid, coalesce(ocsf_class, 'unknown') AS ocsf_class,
  (CASE WHEN parser IS NULL THEN 0 ELSE 1 END)::BIGINT AS severity, coalesce({_FULL_MESSAGE}, '') AS message,
  sha256(payload) AS raw_sha256, payload AS raw_payload FROM routed"""
_LAST = f"{_HISTORY} ORDER BY ingest_us DESC, raw_sha256 LIMIT 200"

# ------------------------------------------------------------------ strict validation

_PRI = "regexp_extract(payload, '^<(\\d{1,3})>', 1)::BIGINT"
_VERSION = "regexp_extract(payload, '^<\\d{1,3}>(\\d*)', 1)"
_LOOSE_ERRORS = f"""[CASE WHEN {_VERSION} <> '' THEN 'count type input=' || {_VERSION} END,
  CASE WHEN {_VERSION} <> '' THEN 'device.os.name missing' END,
  CASE WHEN {_PRI} // 8 NOT BETWEEN 0 AND 6 THEN 'activity_id enum input=' || ({_PRI} // 8) END,
  CASE WHEN {_PRI} % 8 = 7 THEN 'severity_id enum input=7' END]"""
_LOOSE = RAW + f""", loose AS (SELECT *, payload LIKE '<%' AS hit,
  list_filter({_LOOSE_ERRORS}, lambda x: x IS NOT NULL) AS errors
  FROM (SELECT event_id, ingest_us, payload, coalesce(try_cast(regexp_extract(payload, '^<(\\d+)>', 1) AS BIGINT), 0) AS p FROM raw_logs))"""
_LOOSE = _LOOSE.replace(_PRI, "p")
_WITH_LOOSE = _LOOSE + ", records AS (SELECT * FROM loose)" + _routes([LOOSE_SYSLOG, *DEFS])

# ------------------------------------------------------------------ definitions

_DEFINITIONS = """WITH d AS (SELECT event_id AS e, 'def' || event_id || '.json' AS file, 'vendor' || user_id AS vendor,
  event_id * 7 % 50 AS match_priority FROM events),
broken AS (
  SELECT file, 'not_an_object' AS rule, NULL AS detail FROM d WHERE e % 41 = 0
  UNION ALL SELECT file, 'missing', 'name' FROM d WHERE e % 11 = 0 AND e % 41 <> 0
  UNION ALL SELECT file, 'semver', 'v' || e FROM d WHERE e % 13 = 0
  UNION ALL SELECT file, 'author', 'bot' FROM d WHERE e % 17 = 0
  UNION ALL SELECT file, 'class_uid', '9999' FROM d WHERE e % 43 = 0
  UNION ALL SELECT file, 'field_type', 'number,str' FROM d WHERE e % 29 = 0
  UNION ALL SELECT file, 'regex', 'match_patterns[1]' FROM d WHERE e % 23 = 0 AND e % 19 <> 0
  UNION ALL SELECT file, 'expression', 'field_mappings[' || i || ']: ''text'' is no group of this definition'
    FROM d, (VALUES (0), (1)) AS m(i) WHERE e % 19 = 0
)"""


def _paths(fields: dict[str, str], prefix: str = "") -> list[str]:
    out = []
    for name, kind in fields.items():
        out.append(prefix + name)
        if kind in OBJECTS:
            out += _paths({n: t for n, (t, _) in members(kind).items()}, f"{prefix}{name}.")
    return out


_CODES = values([(c, text(n)) for c, n in ENUMS["LogonTypeId"].items()])
_DRAFT_N = "try_cast(regexp_extract(payload, '^(\\d+)', 1) AS BIGINT)"
_DRAFTS = ALL + f""", dead AS (SELECT DISTINCT sha256(payload) AS raw_sha256, payload, {_DRAFT_N} AS id, {_DRAFT_N} // 3 % 3 AS n
  FROM routed WHERE parser IS NULL)"""
_HARM = " OR ".join(f"contains(lower({{0}}), '{w}')" for w in HARM_WORDS)
_LATENCY = ", ".join(f"('{b}', {b})" for b in LATENCY_BUCKETS)

SQL: dict[str, str] = {
    "fingerprint_documents": """SELECT doc_id, 'SHA-256' AS algorithm, 3::BIGINT AS algorithm_id, sha256(text) AS sha256,
        octet_length(encode(text))::BIGINT AS raw_size FROM documents""",
    "size_guard_documents": "SELECT doc_id, octet_length(encode(text)) <= 4096 AS kept FROM documents",
    "envelope_check": RAW + " SELECT event_id, ingest_us FROM raw_logs WHERE event_id % 97 = 0",
    "to_payload": """SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' ||
        event_type || '","props":' || to_json(props)::VARCHAR || '}' AS payload FROM events""",
    "replicate": "SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events",
    "route_first_match": ALL + " SELECT event_id, ingest_us, parser, pattern_id FROM routed",
    "log_blobs": """SELECT source, lang, sha256(b) AS sha256, octet_length(encode(b))::BIGINT AS raw_size FROM (
        SELECT source, lang, string_agg(text || chr(10), '' ORDER BY doc_id) AS b FROM documents WHERE text IS NOT NULL GROUP BY ALL)""",
    "decode_invalid": """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type || props
          ELSE chr(65533) || event_type || chr(65533) || '(' || props || repeat(chr(65533), 3) END AS payload,
        sha256(CASE WHEN event_id % 3 = 0 THEN encode(event_type || props)
          ELSE '\\xFF'::BLOB || encode(event_type) || '\\xC3('::BLOB || encode(props) || '\\xC0\\x80\\xC3'::BLOB END) AS raw_sha256 FROM events""",
    "events_jsonl": ALL + """ SELECT CASE ocsf_class WHEN 'authentication' THEN 3002 WHEN 'network_activity' THEN 4001 ELSE 0 END::BIGINT AS class_uid,
        sha256(payload) AS raw_sha256, payload AS raw_data, parser FROM routed WHERE parser IS NOT NULL""",
    "route_many": ALL + r""", numbered_many AS (SELECT *, try_cast(nullif(regexp_extract(payload, '^.*\buser([0-9]+)\b', 1), '') AS INT) AS u,
          try_cast(nullif(regexp_extract(payload, '^.*\border ([0-9]+)\b', 1), '') AS INT) AS o FROM routed)
        SELECT event_id, ingest_us, CASE WHEN u < 1000 THEN 'user_' || u WHEN o < 995 THEN 'order_' || o ELSE parser END AS parser,
          CASE WHEN u < 1000 THEN u WHEN o < 995 THEN 1000 + o ELSE 1995 + pattern_id END AS pattern_id,
          CASE WHEN u < 1000 THEN regexp_extract(payload, '^.*\buser[0-9]+\b(.*)', 1)
            WHEN o < 995 THEN regexp_extract(payload, '^.*\border [0-9]+\b(.*)', 1) END AS rest FROM numbered_many""",
    **{
        f"extract_{short}": ALL + f" SELECT event_id, ingest_us, pattern_id, "
        f"{', '.join(next(d for d in DEFS if d.name == name).group_names)} FROM {_groups(name)}"
        for short, name in (("sshd", "linux_sshd"), ("asa", "cisco_asa"), ("syslog", "rfc5424_fallback"))
    },
    "dry_run": RAW + ", records AS (SELECT * FROM raw_logs)" + _routes([d for d in DEFS if d.name == "linux_sshd"]) + f"""
        SELECT 300200::BIGINT AS type_uid, sha256(payload) AS raw_sha256, payload AS raw_payload,
          'linux_sshd' AS parser, fields, CASE pattern_id
            WHEN 0 THEN {text(next(d for d in DEFS if d.name == 'linux_sshd').match_patterns[0])}
            WHEN 1 THEN {text(next(d for d in DEFS if d.name == 'linux_sshd').match_patterns[1])} END AS pattern
        FROM (SELECT *, CASE WHEN pattern_id IS NOT NULL THEN array_to_string(list_sort([
          'timestamp=' || g[1], 'hostname=' || g[2], 'pid=' || g[3], 'auth_method=' || g[4], 'username=' || g[5],
          'src_ip=' || g[6], 'src_port=' || g[7], 'protocol=' || g[8]]), ';') END AS fields
          FROM (SELECT *, regexp_extract_all(payload, '^(.{{15}})', 1) || regexp_extract_all(payload, ' (host\\d+) ', 1)
            || regexp_extract_all(payload, 'sshd\\[(\\d+)', 1) || regexp_extract_all(payload, '(?:Accepted|Failed) (\\w+)', 1)
            || regexp_extract_all(payload, '(user\\d+) from', 1) || regexp_extract_all(payload, 'from ([\\d.]+)', 1)
            || regexp_extract_all(payload, 'port (\\d+)', 1) || regexp_extract_all(payload, '(ssh2)', 1) AS g FROM routed))""",
    "coerce_types": """SELECT event_id, text, try_cast(trim(text) AS BIGINT) FILTER_INT AS as_int FROM events""",
    "normalize_auth": ALL + f""" SELECT event_id, ingest_us, 3002::BIGINT AS class_uid, 3::BIGINT AS category_uid,
        0::BIGINT AS activity_id, 300200::BIGINT AS type_uid, 1::BIGINT AS severity_id, ingest_us // 1000 AS "time",
        username AS user_name, src_ip, src_port::BIGINT AS src_port, hostname AS dst_hostname,
        upper(protocol) AS auth_protocol, 99::BIGINT AS auth_protocol_id, 'sshd' AS service, true AS is_remote,
        3::BIGINT AS logon_type_id, 'Network' AS logon_type, payload AS raw_data,
        octet_length(encode(payload))::BIGINT AS raw_data_size, sha256(payload) AS sha256, 'linux_sshd' AS product,
        ingest_us // 1000 AS processed_time, true AS no_traffic FROM {_groups('linux_sshd')}""",
    "normalize_net": ALL + f""" SELECT event_id, ingest_us, 4001::BIGINT AS class_uid, 400100::BIGINT AS type_uid, src_ip,
        src_port::BIGINT AS src_port, dst_ip, dst_port::BIGINT AS dst_port, upper(protocol) AS protocol_name,
        coalesce(bytes, '0')::BIGINT AS traffic_bytes, true AS no_user FROM {_groups('cisco_asa')}""",
    "normalize_base": ALL + f""" SELECT event_id, ingest_us, parser, 0::BIGINT AS class_uid, 0::BIGINT AS type_uid,
        {_FULL_MESSAGE} AS message,
        CASE parser WHEN 'macos_unified' THEN 'apple' WHEN 'windows_event' THEN 'microsoft' ELSE 'generic' END AS vendor,
        '1.3.0' AS ocsf_version FROM routed WHERE ocsf_class = 'base_event'""",
    "leftovers": ALL + " " + _unmapped(merge=True),
    "leftovers_replace": ALL + " " + _unmapped(merge=False),
    "event_json": ALL + f""" SELECT '{{"activity_id":0,"category_uid":4,"class_uid":4001,"severity_id":1,"time":' || ms ||
        ',"metadata":{{"version":"1.3.0","product":{{"name":"cisco_asa","vendor_name":"cisco","version":"1.0.0"}},"processed_time":' || ms ||
        '}},"raw_data":' || to_json(payload)::VARCHAR || ',"raw_data_hash":{{"algorithm":"SHA-256","algorithm_id":3,"value":"' || sha256(payload) ||
        '"}},"raw_data_size":' || length(payload) || ',"unmapped":{{' || unmapped || '}},"dst_endpoint":{{"ip":"' || dst_ip || '","port":' || dst_port ||
        '}},"src_endpoint":{{"ip":"' || src_ip || '","port":' || src_port || '}},"connection_info":{{"protocol_name":"' || upper(protocol) ||
        '"}},"traffic":{{"bytes":' || coalesce(bytes, '0') || '}},"type_uid":400100}}' AS event_json
        FROM (SELECT *, ingest_us // 1000 AS ms, CASE
          WHEN direction IS NOT NULL THEN printf('"severity":"%s","message_id":"%s","direction":"%s","protocol":"%s","conn_id":"%s","src_ip":"%s","src_port":"%s","dst_ip":"%s","dst_port":"%s"',
            severity, message_id, direction, protocol, conn_id, src_ip, src_port, dst_ip, dst_port)
          WHEN duration IS NOT NULL THEN printf('"severity":"%s","message_id":"%s","protocol":"%s","conn_id":"%s","src_ip":"%s","src_port":"%s","dst_ip":"%s","dst_port":"%s","duration":"%s"',
            severity, message_id, protocol, conn_id, src_ip, src_port, dst_ip, dst_port, duration)
          ELSE printf('"severity":"%s","message_id":"%s","protocol":"%s","src_ip":"%s","src_port":"%s","dst_ip":"%s","dst_port":"%s"',
            severity, message_id, protocol, src_ip, src_port, dst_ip, dst_port) END AS unmapped FROM {_groups('cisco_asa')})""",
    "event_aliases": ALL + """ SELECT event_id, ingest_us, CASE WHEN parser IS NOT NULL THEN payload END AS raw_payload,
        CASE WHEN parser IS NOT NULL THEN sha256(payload) END AS raw_sha256 FROM routed""",
    "class_projection": ALL + """ SELECT ocsf_class, CASE ocsf_class WHEN 'authentication' THEN 300200
          WHEN 'network_activity' THEN 400100 ELSE 0 END::BIGINT AS type_uid,
        CASE WHEN ocsf_class = 'authentication' THEN 'sshd' END AS service,
        CASE WHEN ocsf_class = 'authentication' THEN 'SSH2' END AS auth_protocol,
        count(*) AS events FROM routed WHERE parser IS NOT NULL GROUP BY ALL""",
    "validate_code": ALL + f""" SELECT event_id, ingest_us, parser, {_STATUS} AS status, 0::BIGINT AS n_errors,
        NULL::VARCHAR AS error FROM routed""",
    "validate_instance": ALL + f""" SELECT event_id, ingest_us, parser,
        CASE WHEN parser IS NULL THEN 'dlq' WHEN {_BUILTIN_ENUM} THEN 'validation_error' ELSE 'success' END AS status,
        (CASE WHEN NOT {_BUILTIN_ENUM} OR parser IS NULL THEN 0 WHEN ocsf_class = 'base_event' THEN 1 ELSE 2 END)::BIGINT AS n_errors,
        CASE WHEN {_BUILTIN_ENUM} THEN {_ENUM_ERROR} END AS error FROM routed""",
    "validate_strict": _LOOSE + """ SELECT event_id, ingest_us, CASE WHEN hit THEN 'loose_syslog' END AS parser,
        CASE WHEN NOT hit THEN 'dlq' WHEN len(errors) > 0 THEN 'validation_error' ELSE 'success' END AS status,
        (CASE WHEN hit THEN len(errors) ELSE 0 END)::BIGINT AS n_errors,
        CASE WHEN hit AND len(errors) > 0 THEN 'OCSF validation failed: ' || array_to_string(errors, '; ') END AS error FROM loose""",
    "split_counts": DEDUPED + f" SELECT parser, {_STATUS} AS status, count(*) AS records FROM routed GROUP BY ALL",
    "dlq_records": ALL + f""" SELECT {_UTC} AS timestamp, sha256(payload) AS raw_sha256,
        CASE WHEN parser IS NULL THEN 'No matching active parsers found.' ELSE {_ENUM_ERROR} END AS error,
        payload AS raw_payload, CASE WHEN parser IS NULL THEN 'unmatched' ELSE 'ocsf_validation_failed' END AS reason,
        strftime(ingest_ts, '%Y-%m-%d') AS dlq_date FROM routed WHERE parser IS NULL OR {_BUILTIN_ENUM}""",
    "dlq_daily": ALL + """ SELECT strftime(ingest_ts, '%Y-%m-%d') AS dlq_date, 'No matching active parsers found.' AS error,
        count(*) AS records, min(sha256(payload)) AS first_sha256 FROM routed WHERE parser IS NULL GROUP BY ALL""",
    "history_all": ALL + f" {_HISTORY}",
    "history_last_200": DEDUPED + f" {_LAST}",
    "dedup_accepted": DEDUPED + " SELECT event_id, ingest_us FROM records",
    "dedup_hot_hash": RAW + """, marked AS (SELECT ingest_us,
        CASE WHEN event_id % 3 = 0 THEN '-- MARK --' ELSE payload END AS payload FROM raw_logs)"""
        + _KEPT.format(source="marked") + " SELECT h AS raw_sha256, ingest_us FROM kept",
    "stream_dedup_late_order": RAW + """, marked AS (SELECT ingest_us,
        CASE WHEN event_id % 3 = 0 THEN '-- MARK --' ELSE payload END AS payload FROM raw_logs)"""
        + _KEPT.format(source="marked") + " SELECT h AS raw_sha256, ingest_us FROM kept",
    "stream_late": RAW + """, filed AS (SELECT ingest_us, ingest_us // 300000000 AS bucket,
        CASE WHEN event_id % 3 = 0 THEN '-- MARK --' ELSE payload END AS payload,
        (ingest_us + CASE WHEN event_id % 50 = 7 THEN 432000 ELSE event_id * 7919 % 5400 END * 1000000) // 432000000000 AS file FROM raw_logs
      ), files AS (SELECT file, max(max(bucket)) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
        FROM filed GROUP BY file
      ), told AS (SELECT *, coalesce(bucket < newest - 24, false) AS is_late FROM filed JOIN files USING (file))"""
        + _KEPT.format(source="(SELECT * FROM told WHERE NOT is_late)") + """, counts AS (
      SELECT (SELECT count(*) FROM told) AS records, (SELECT count(*) FROM kept) AS accepted, (SELECT count(*) FROM told WHERE is_late) AS late)
      SELECT *, records - accepted - late AS duplicates FROM counts""",
    "dedup_total": DEDUPED + """ SELECT ((SELECT count(*) FROM raw_logs) - (SELECT count(*) FROM records))::BIGINT AS skipped""",
    "dedup_nulls": RAW + """, given AS (SELECT CASE WHEN event_id % 13 <> 0 THEN payload END AS payload,
        CASE WHEN event_id % 17 <> 0 THEN ingest_us END AS ingest_us FROM raw_logs)""" + _KEPT.format(
            source="(SELECT * FROM given WHERE payload IS NOT NULL AND ingest_us IS NOT NULL)") + """
      SELECT h AS raw_sha256, ingest_us FROM kept UNION ALL
      SELECT sha256(payload), ingest_us FROM given WHERE payload IS NULL OR ingest_us IS NULL""",
    "dedup_many_repeats": RAW + ", given AS (SELECT 'p' || (event_id % 3000) AS payload, ingest_us FROM raw_logs)" + _KEPT.format(
        source="given") + " SELECT h AS raw_sha256, ingest_us FROM kept",
    "dedup_text_files": RAW + " SELECT DISTINCT sha256(payload) AS raw_sha256 FROM raw_logs",
    "dlq_oversize": """SELECT CASE WHEN strlen(text) > 4096 THEN 'oversize' ELSE 'unmatched' END AS reason,
        CASE WHEN strlen(text) > 4096 THEN 'The payload is longer than allowed.' ELSE 'No matching active parsers found.' END AS error,
        count(*) AS records, count(DISTINCT sha256(text)) AS payloads FROM documents GROUP BY ALL""",
    "metrics_with_drops": RAW + """ SELECT count(*) AS ingested, 
        count(*) FILTER (event_id % 29 = 0 AND event_id % 13 <> 0) AS oversize,
        count(*) FILTER (event_id % 13 = 0) AS null_payload, 0 AS lost FROM raw_logs""",
    "dedup_first_of_key": "SELECT DISTINCT source, lang, text FROM documents",
    "metrics_table": DEDUPED + f""", m AS (
        SELECT 'ingest_total' AS metric, '' AS label, (SELECT count(*) FROM raw_logs) AS value
        UNION ALL SELECT 'dedup_total', '', (SELECT count(*) FROM raw_logs) - (SELECT count(*) FROM records)
        UNION ALL SELECT 'matched_total', parser, count(*) FROM routed WHERE parser IS NOT NULL GROUP BY parser
        UNION ALL SELECT 'validation_failed_total', parser, count(*) FROM routed WHERE {_BUILTIN_ENUM} GROUP BY parser
        UNION ALL SELECT 'dlq_total', 'unmatched,manual', count(*) FROM routed WHERE parser IS NULL
        UNION ALL SELECT 'dlq_total', 'ocsf_validation_failed,manual', count(*) FROM routed WHERE {_BUILTIN_ENUM})
        SELECT metric, label, value::BIGINT AS value FROM m WHERE value > 0 OR metric IN ('ingest_total', 'dedup_total')""",
    "metrics_totals": DEDUPED + """ SELECT (SELECT count(*) FROM raw_logs)::BIGINT AS ingested,
        count(parser)::BIGINT AS parsed, count_if(parser IS NULL)::BIGINT AS dlq FROM routed""",
    "matched_by_parser": _WITH_LOOSE + """ SELECT parser, count(*) AS matched,
        count_if(parser = 'loose_syslog' AND len(errors) > 0)::BIGINT AS validation_failed
        FROM routed WHERE parser IS NOT NULL GROUP BY parser""",
    "dlq_by_reason": _WITH_LOOSE + """ SELECT CASE WHEN parser IS NULL THEN 'unmatched' ELSE 'ocsf_validation_failed' END AS reason,
        'manual' AS dlq_mode, count(*) AS records FROM routed
        WHERE parser IS NULL OR (parser = 'loose_syslog' AND len(errors) > 0) GROUP BY ALL""",
    "latency_histogram": f"""SELECT event_type, le, count_if(seconds <= bound) AS bucket_count,
        round(sum(seconds), 3) AS latency_sum, count(seconds) AS latency_count
        FROM (SELECT event_type, value / 10 AS seconds FROM events),
          (VALUES {_LATENCY}, ('+Inf', 'inf'::DOUBLE)) AS b(le, bound) GROUP BY event_type, le""",
    "parser_share": DEDUPED + f" SELECT parser, count(*) AS records FROM ({_LAST}) GROUP BY parser",
    "eps_window": RAW + " SELECT ingest_us // 1000000 AS second_s, count(*) AS events FROM raw_logs GROUP BY ALL",
    "eps_lag": """SELECT event_id, event_id % 1000 AS value,
        greatest(event_id % 1000 - lag(event_id % 1000, 1, 0) OVER (ORDER BY ts), 0) AS rate FROM events""",
    "eps_lag_series": """WITH s AS (SELECT (event_id * 100 + i) % 3600000000 AS us, least(event_id % 4, 2) AS series,
          (event_id * 100 + i) % 70001 AS value FROM events, range(100) AS r(i)),
        r AS (SELECT series, greatest(value - lag(value, 1, 0) OVER (PARTITION BY series ORDER BY us), 0) AS rate FROM s)
        SELECT series, count(*) AS samples, sum(rate)::BIGINT AS total, max(rate) AS most, count(*) FILTER (rate = 0) AS resets FROM r GROUP BY series""",
    "last_30_points": RAW + """ SELECT ingest_us // 1000000 AS second_s, count(*) AS events FROM raw_logs
        GROUP BY ALL ORDER BY second_s DESC LIMIT 30""",
    "last_30_per_source": RAW + """ SELECT source, event_id, ingest_us FROM raw_logs
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY ingest_us DESC, event_id) <= 30""",
    "harm_tags": RAW + f" SELECT event_id, ingest_us, CASE WHEN {_HARM.format('payload')} THEN 'High' ELSE 'Low' END AS tag FROM raw_logs",
    "harm_tag_conversations": f"SELECT conv_id, turn, CASE WHEN {_HARM.format('text')} THEN 'High' ELSE 'Low' END AS tag FROM conversations",
    "search_conversations": "SELECT conv_id, turn FROM conversations WHERE contains(lower(role || ' ' || text), 'the')",
    "search_history": ALL + f""" SELECT ingest_us, raw_sha256 FROM ({_HISTORY})
        WHERE contains(lower(concat_ws(' ', status, parser, raw_sha256, raw_payload)), 'host7 ')""",
    "detail_labels": ALL + f""" SELECT ingest_us, raw_sha256, CASE
        WHEN contains(raw_payload, '"EventID"') THEN 'EventID: ' || regexp_extract(raw_payload, '"EventID": (\\d+)', 1)
        WHEN type_uid IS NOT NULL THEN 'UID: ' || type_uid ELSE 'N/A' END AS details,
        left(raw_payload, 50) || '...' AS preview FROM ({_HISTORY})""",
    "enum_caption": f"""SELECT event_id, event_id % 14 AS logon_type_id, caption AS logon_type_id_caption
        FROM events LEFT JOIN {_CODES} AS c(code, caption) ON event_id % 14 = code""",
    "invalid_codes": f"""SELECT event_id, event_id % 14 AS logon_type_id FROM events
        WHERE event_id % 14 NOT IN (SELECT code FROM {_CODES} AS c(code, caption))""",
    "windows_payload": """SELECT event_id, '{"MachineName":"' || CASE WHEN event_id % 3 > 0 THEN 'PC' || user_id ELSE 'UNKNOWN' END ||
        '","EventID":' || CASE WHEN event_id % 5 > 0 THEN 4000 + event_id % 700 ELSE 0 END ||
        ',"Message":"' || CASE WHEN event_id % 7 > 0 THEN event_type ELSE '' END ||
        '","Source":"Shop","Level":""}' AS payload FROM events""",
    "parser_order": _DEFINITIONS + """ SELECT vendor, file,
        row_number() OVER (PARTITION BY vendor ORDER BY CASE WHEN match_priority % 2 = 0 THEN match_priority ELSE 100 END, file) AS place FROM d""",
    "rule_violations": _DEFINITIONS + " SELECT file, rule, detail FROM broken",
    "valid_definitions": _DEFINITIONS + " SELECT file FROM d ANTI JOIN broken USING (file)",
    "lint_paths": _DEFINITIONS + f""", mapped AS (
        SELECT file, CASE WHEN e % 3 = 0 THEN 'authentication' ELSE 'base_event' END AS ocsf_class, unnest(['message',
          CASE WHEN e % 31 = 0 THEN 'src_endpoint.ipv4' WHEN e % 37 = 0 THEN 'unmapped.x' ELSE 'message' END]) AS path FROM d)
        SELECT file, ocsf_class, path FROM mapped WHERE path NOT LIKE 'unmapped.%' AND (ocsf_class, path) NOT IN
          (SELECT (c, p) FROM {values([(text(c), text(p)) for c in CLASS_FIELDS for p in _paths(CLASS_FIELDS[c])])} AS k(c, p))""",
    "expr_text": r"""WITH w AS (SELECT doc_id, lang, text, string_split(text, ' ') AS words FROM documents)
        SELECT doc_id, sha256(lower(text)) AS lower, sha256(upper(replace(text, 'ß', 'ss'))) AS upper,
        sha256(regexp_replace(text, '^[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b\x1c-\x1f]+|[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x0b\x1c-\x1f]+$', '', 'g')) AS trim,
        sha256(replace(text, 'a', 'b')) AS replaced, sha256(array_to_string(words, ';')) AS joined,
        words[1] AS first_word, words[len(words)] AS last_word, length(text)::BIGINT AS chars, len(words)::BIGINT AS n_words,
        sha256(regexp_replace(text, '\n([^\n])', E'\n    \\1', 'g')) AS indented,
        sha256(VOWELS) AS vowels,
        sha256(array_to_string(words[1:3], '|')) AS first_batch, ((len(words) + 2) // 3)::BIGINT AS n_batches,
        sha256(array_to_string(list_filter(words, lambda x: length(x) > 3), ' ')) AS long_words,
        upper(left(lang, 1)) || lower(substr(lang, 2)) AS capitalized FROM w""",
    "expr_numbers": """WITH t AS (SELECT *, CASE WHEN event_id % 4 = 0 THEN 'x' || event_id ELSE event_id::VARCHAR END AS text FROM events)
        SELECT event_id, coalesce(try_cast(text AS BIGINT), 0) AS int_or_0, coalesce(try_cast(text AS DOUBLE), 0.0) AS float_or_0,
        event_id // 8 AS div_8, event_id % 8 AS mod_8, abs(500 - event_id) AS distance, round(value, 0) AS rounded,
        CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome, event_type || ':' || text AS joined,
        repeat(' ', pad // 2 + pad % 2) || event_type || repeat(' ', pad // 2) AS centered, 3::BIGINT AS words,
        'fallback' AS defaulted, 'A,b,' || event_type AS sorted,
        CASE event_type WHEN 'click' THEN 'Click,VIEW' WHEN 'view' THEN 'Click,view' ELSE 'Click,' || event_type || ',VIEW' END AS uniques
        FROM (SELECT *, 11 - length(event_type) AS pad FROM t)""",
    "hostile_values": r"""WITH kinds AS (SELECT ['', '(', 'x', '-9223372036854775808', repeat('9', 400), '$9\', repeat('a,(b', 2000), NULL] AS k),
      t AS (SELECT event_id, k[1 + event_id % 8] AS v0, k[1 + event_id // 8 % 8] AS w0 FROM events, kinds),
      g AS (SELECT event_id, coalesce(v0, '') AS v, coalesce(w0, '') AS w, try_cast(v0 AS BIGINT) AS n, try_cast(w0 AS BIGINT) AS m FROM t)
      SELECT event_id, sha256(upper(v)) AS upper_text, sha256(coalesce(n, -1)::VARCHAR) AS number,
        sha256(CASE WHEN n > -9223372036854775808 THEN abs(n) END::VARCHAR) AS distance, sha256(regexp_extract(v, '([0-9]+)', 1)) AS digits,
        sha256(replace(v, '(', '<')) AS opened, sha256(string_split(v, ',')[2]) AS second, sha256(lpad(v, 12, '*')) AS padded,
        sha256(string_split(v, ',')[-1]) AS last_part, sha256(CASE WHEN contains(v, '(') THEN 'open' ELSE w END) AS told,
        sha256(v || ';' || w) AS both, sha256(replace(v, '9', '88')) AS doubled, sha256(len(string_split(v, '('))::VARCHAR) AS pieces,
        sha256(CASE WHEN n::HUGEINT + m BETWEEN -9223372036854775808 AND 9223372036854775807 THEN (n::HUGEINT + m)::VARCHAR END) AS total,
        sha256((n // 3)::VARCHAR) AS third FROM g""",
    "draft_parsers": _DRAFTS + """ SELECT raw_sha256, 'fake' AS model, CASE WHEN n = 2 THEN 'failed' ELSE 'drafted' END AS status,
        (CASE n WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END)::BIGINT AS attempts,
        CASE WHEN n < 2 THEN 'csv_' || id END AS parser FROM dead""",
    "draft_totals": _DRAFTS + """ SELECT 'fake' AS model, status, sum(k)::BIGINT AS attempts FROM (
        SELECT 'success' AS status, 1 AS k FROM dead WHERE n < 2 UNION ALL SELECT 'error', 3 FROM dead WHERE n = 2)
        GROUP BY status""",
    "dlq_after_drafting": _DRAFTS + """ SELECT sha256(payload) AS raw_sha256, 'AI generation failed:' AS error_head,
        payload AS raw_payload FROM routed JOIN (SELECT raw_sha256 AS h FROM dead WHERE n > 0) ON h = sha256(payload)""",
    "promote_drafts": _DRAFTS + """ SELECT raw_sha256, CASE WHEN raw_sha256 < '8' THEN 'active' ELSE 'pending' END AS status
        FROM dead WHERE n < 2""",
    "stream_normalize": ALL + """ SELECT (CASE ocsf_class WHEN 'authentication' THEN 3002 WHEN 'network_activity' THEN 4001
        WHEN 'base_event' THEN 0 ELSE -1 END)::BIGINT AS class_uid, CASE WHEN parser IS NULL THEN 'unmatched' ELSE '' END AS reason,
        count(*) AS records, count(DISTINCT sha256(payload)) AS payloads FROM routed GROUP BY ALL""",
    "stream_promote": RAW + ", records AS (SELECT * FROM raw_logs)" + _routes([d for d in DEFS if d.name == "linux_sshd"]) + r"""
        SELECT event_id % 2 AS batch, coalesce(parser, CASE WHEN event_id % 2 = 1 AND regexp_matches(payload, '^\d+,') THEN 'shop_csv' ELSE '' END) AS parser,
          count(*) AS records, count(DISTINCT sha256(payload)) AS payloads FROM routed GROUP BY ALL""",
    "stream_dedup": DEDUPED + " SELECT sha256(payload) AS raw_sha256, ingest_us FROM records",
}
SQL["coerce_types"] = r"""WITH t AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN k WHEN 1 THEN ' ' || k || ' ' WHEN 2 THEN k || '.5'
    WHEN 3 THEN 'x' || k WHEN 4 THEN 'YES' WHEN 5 THEN k || 'd' WHEN 6 THEN '-' || k ELSE '' END AS text
    FROM (SELECT event_id, regexp_extract(props, '\d+') AS k FROM events)),
  n AS (SELECT *, CASE WHEN regexp_matches(text, '^\s*-?\d+\s*$') THEN trim(text)::BIGINT END AS i,
    CASE WHEN regexp_matches(text, '^\s*-?\d+(\.\d+)?\s*$') THEN trim(text)::DOUBLE END AS f FROM t)
  SELECT event_id, text, i AS as_int, f AS as_float, lower(text) IN ('true', '1', 'yes') AS as_bool,
    CASE WHEN text <> '' THEN i ELSE 7 END AS int_or_default FROM n"""
_vowels = "text"
for _v in "aeiou":
    _vowels = f"regexp_replace({_vowels}, '{_v}+', '<{_v}>', 'g')"
SQL["expr_text"] = SQL["expr_text"].replace("VOWELS", _vowels)
SQL["stream_metrics"] = SQL["metrics_table"]
