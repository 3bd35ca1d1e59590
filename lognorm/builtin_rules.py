"""The definitions that ship: two JSON formats, ASA firewall, sshd, and syslog as catch-all.

Group names, target paths, priorities and static values are fixed values. The patterns are
written from the formats: the grammar of RFC 5424 section 6, RFC 3164 section 4.1, the two
lines sshd writes about an attempt, three entries of the ASA message catalogue, and the keys
of the two JSON records. They are narrower than "any word" on purpose: a priority is 0 to 191,
a month is a month, a port has five digits at most, a header field has the length and the
characters its RFC allows, brackets inside quoted parameter values don't end structured data,
and several elements of it stay together. What falls outside is a dead letter. sshd's protocol
ends at a colon. A JSON record may hold anything before its keys, whatever its braces.

Repeated groups are possessive: Java's engine otherwise calls itself once a repetition, and one
long line would overflow the stack and end the executor.
"""

from __future__ import annotations

from lognorm.sources.parsers import ParserDef, in_routing_order, parse_definition

_CREATED = "2026-09-06T00:00:00Z"
# RFC 3164: "Mmm dd hh:mm:ss", the day padded with a space.
_MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_CLOCK = "(?:[01][0-9]|2[0-3]):[0-5][0-9]:(?:[0-5][0-9]|60)"
_BSD_TIME = f"(?P<timestamp>{_MONTH} (?:[ 0]?[1-9]|[12][0-9]|3[01]) {_CLOCK})"
_HOST = "(?P<hostname>[!-~]{1,255})"
_PRI = "<(?P<pri>[0-9]|[1-9][0-9]|1[0-8][0-9]|19[01])>"
# RFC 5424: full-date "T" full-time, or the nil value.
_RFC3339 = f"(?P<timestamp>-|[0-9]{{4}}-[01][0-9]-[0-3][0-9]T{_CLOCK}(?:[.][0-9]{{1,6}})?(?:Z|[+-][0-9]{{2}}:[0-9]{{2}}))"
# The inside of "[id name="value" ...]"; a value may hold escaped quotes and brackets.
_ELEMENT = r'[^"\]]*+(?:"(?:[^"\\]|\\.)*+"[^"\]]*+)*+'
_ADDRESS = "[0-9A-Za-z.:%_-]+"
_PORT = "[0-9]{1,5}"
# What stands before a key of a JSON record: as little as possible of anything, or as much as the line holds.
_ANYTHING, _LINE = r"[\s\S]*?", r"[^\n]*"


def _definition(name: str, vendor: str, log_format: str, priority: int, ocsf: tuple[str, int, int],
                patterns: list[str], mappings: list[dict], static: dict | None = None) -> ParserDef:
    ocsf_class, category, class_uid = ocsf
    return parse_definition({
        "name": name, "version": "1.0.0", "author": "human", "created_at": _CREATED,
        "vendor": vendor, "log_format": log_format, "match_priority": priority,
        "ocsf_class": ocsf_class, "ocsf_category_uid": category, "ocsf_class_uid": class_uid,
        "match_patterns": patterns, "field_mappings": mappings, "static_values": static or {},
    }, file=f"{name}.json")


def _field(path: str, expr: str | None = None, type: str = "str", default=None) -> dict:
    return {"ocsf_field": path, "type": type, "expr": expr, "default": default}


def _asa(number: str, *words: str) -> str:
    """``%ASA-level-number: text``, the text's words apart by spaces."""
    return rf"%ASA-(?P<severity>[0-7])-(?P<message_id>{number}): +" + " +".join(words)


def _interface(side: str) -> str:
    """``interface:address/port``."""
    return rf"[^ :/]+:(?P<{side}_ip>{_ADDRESS})/(?P<{side}_port>{_PORT})"


_TRANSPORT = "(?P<protocol>[A-Za-z0-9-]+)"
_CONNECTION = ("connection", "(?P<conn_id>[0-9]+)", "for")


def _attempt(outcome: str, user: str) -> str:
    """``outcome method for user from address port number protocol``."""
    return (
        f"{_BSD_TIME} +{_HOST} +" + r"sshd\[(?P<pid>[0-9]+)\]: +" + outcome + " +(?P<auth_method>[a-z][a-z0-9/_-]*) +for +" + user
        + f" +from +(?P<src_ip>{_ADDRESS}) +port +(?P<src_port>{_PORT}) +(?P<protocol>[A-Za-z0-9.]+)"
    )


def _record(*keys: str, before: str = _ANYTHING, rest: str = "[^}]*") -> str:
    """A JSON object with the keys in that order, up to a brace that closes after ``rest``."""
    return r"(?P<msg>\{" + "".join(rf'{before}"{k}"\s*:' for k in keys) + rest + r"\})"


BASE = ("base_event", 0, 0)

MACOS_UNIFIED = _definition(
    "macos_unified", "apple", "json", 50, BASE,
    [_record("eventMessage", "subsystem", before=_LINE, rest=_LINE)],
    [_field("message", "msg")],
)
WINDOWS_EVENT = _definition(
    "windows_event", "microsoft", "json", 50, BASE,
    [_record("EventID", "MachineName"), _record("MachineName", "EventID"), _record("MachineName")],
    [_field("message", "msg")],
)
CISCO_ASA = _definition(
    "cisco_asa", "cisco", "syslog", 100, ("network_activity", 4, 4001),
    [
        _asa("302013", "Built", "(?P<direction>inbound|outbound)", _TRANSPORT, *_CONNECTION, _interface("src"), r"\([^()]*\)", "to", _interface("dst")),
        _asa("302014", "Teardown", _TRANSPORT, *_CONNECTION, _interface("src"), "to", _interface("dst"),
             "duration", "(?P<duration>[0-9]+:[0-5][0-9]:[0-5][0-9])", "bytes", "(?P<bytes>[0-9]+)"),
        _asa("106023", "Deny", _TRANSPORT, "src", _interface("src"), "dst", _interface("dst")),
    ],
    [
        _field("src_endpoint.ip", "src_ip"),
        _field("src_endpoint.port", "src_port", "int"),
        _field("dst_endpoint.ip", "dst_ip"),
        _field("dst_endpoint.port", "dst_port", "int"),
        _field("connection_info.protocol_name", "upper(protocol)"),
        _field("traffic.bytes", "coalesce(bytes, '0')", "int", default=0),
    ],
    {"severity_id": 1},
)
LINUX_SSHD = _definition(
    "linux_sshd", "linux", "syslog", 100, ("authentication", 3, 3002),
    [_attempt("Accepted", "(?P<username>[^ ]+)"), _attempt("Failed", "(?:invalid +user +)?(?P<username>[^ ]+)")],
    [
        _field("user.name", "username"),
        _field("src_endpoint.ip", "src_ip"),
        _field("src_endpoint.port", "src_port", "int"),
        _field("dst_endpoint.hostname", "hostname"),
        _field("auth_protocol", "upper(protocol)"),
        _field("service", default="sshd"),
    ],
    {"severity_id": 1, "auth_protocol_id": 99, "is_remote": True, "logon_type_id": 3,
     "logon_type": "Network"},
)
RFC5424_FALLBACK = _definition(
    "rfc5424_fallback", "generic", "syslog", 999, BASE,
    [
        _PRI + f"(?P<version>[1-9][0-9]{{0,2}}) +{_RFC3339} +{_HOST} +(?P<app_name>[!-~]{{1,48}}) +(?P<procid>[!-~]{{1,128}})"
        r" +(?P<msgid>[!-~]{1,32}) +" + rf"(?:\[(?P<structured_data>{_ELEMENT}(?:\]\[{_ELEMENT})*+)\] *)?" + r"(?P<message>[^\n]*)",
        _PRI + f"{_BSD_TIME} +{_HOST} +" + r"(?P<message>[^\n]*)",
    ],
    [
        _field("message", r"regexp_replace(coalesce(message, ''), '\\A[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+\\z', '')"),
        _field("metadata.product.name", "coalesce(app_name, 'unknown')"),
        _field("metadata.product.vendor_name", default="generic"),
        _field("unmapped.hostname", "hostname"),
        _field("unmapped.facility", "string(coalesce(try_cast(pri AS BIGINT), 0) div 8)", "int"),
        _field("unmapped.syslog_severity", "string(coalesce(try_cast(pri AS BIGINT), 0) % 8)", "int"),
        _field("unmapped.procid", "coalesce(procid, '-')"),
        _field("unmapped.msgid", "coalesce(msgid, '-')"),
        _field("unmapped.structured_data", "coalesce(structured_data, '-')"),
    ],
    {"severity_id": 1, "activity_id": 0},
)


def builtin_parsers() -> list[ParserDef]:
    return in_routing_order(
        [MACOS_UNIFIED, WINDOWS_EVENT, CISCO_ASA, LINUX_SSHD, RFC5424_FALLBACK]
    )
