"""OCSF 1.3 event model: classes, objects, enums, and the Spark types built from them.

The model is declared once as data. Everything else (the wide ``OCSF_EVENT`` struct,
the leaf paths the mapper may write, required members, enum checks) is derived from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------- fixed values
# Codes and captions of the OCSF enums (fixed values).
ENUMS: dict[str, dict[int, str]] = {
    "CategoryUid": {
        0: "UNCATEGORIZED", 1: "SYSTEM_ACTIVITY", 2: "FINDINGS", 3: "IAM",
        4: "NETWORK_ACTIVITY", 5: "DISCOVERY", 6: "APPLICATION_ACTIVITY",
    },
    "SeverityId": {
        0: "UNKNOWN", 1: "INFORMATIONAL", 2: "LOW", 3: "MEDIUM", 4: "HIGH",
        5: "CRITICAL", 6: "FATAL", 99: "OTHER",
    },
    "StatusId": {0: "UNKNOWN", 1: "SUCCESS", 2: "FAILURE", 99: "OTHER"},
    "ActivityId": {0: "UNKNOWN", 99: "OTHER"},
    "AuthActivityId": {
        0: "UNKNOWN", 1: "LOGON", 2: "LOGOFF", 3: "AUTH_TICKET", 4: "SERVICE_TICKET",
        5: "SERVICE_TICKET_RENEW", 6: "PREAUTH", 99: "OTHER",
    },
    "AuthProtocolId": {
        0: "UNKNOWN", 1: "NTLM", 2: "KERBEROS", 3: "DIGEST", 4: "OPENID", 5: "SAML",
        6: "OAUTH_2_0", 7: "PAP", 8: "CHAP", 9: "EAP", 10: "RADIUS", 99: "OTHER",
    },
    "LogonTypeId": {
        0: "UNKNOWN", 1: "SYSTEM", 2: "INTERACTIVE", 3: "NETWORK", 4: "BATCH",
        5: "OS_SERVICE", 7: "UNLOCK", 8: "NETWORK_CLEARTEXT", 9: "NEW_CREDENTIALS",
        10: "REMOTE_INTERACTIVE", 11: "CACHED_INTERACTIVE",
        12: "CACHED_REMOTE_INTERACTIVE", 13: "CACHED_UNLOCK", 99: "OTHER",
    },
    "NetworkActivityId": {
        0: "UNKNOWN", 1: "OPEN", 2: "CLOSE", 3: "RESET", 4: "FAIL", 5: "REFUSE",
        6: "TRAFFIC", 99: "OTHER",
    },
    "FingerprintAlgorithmId": {
        0: "UNKNOWN", 1: "MD5", 2: "SHA1", 3: "SHA256", 4: "SHA512", 99: "OTHER",
    },
}

OCSF_VERSION = "1.3.0"
KNOWN_CLASS_UIDS = (0, 3002, 4001)
OCSF_CLASSES = ("base_event", "authentication", "network_activity")

# Members of the OCSF objects (fixed values). "!" marks a required member; the type is
# str, int, bool, map, an enum name, "list of X", or the name of another object.
OBJECTS: dict[str, dict[str, str]] = {
    "Product": {"name!": "str", "vendor_name!": "str", "version": "str", "uid": "str"},
    "Metadata": {
        "version": "str", "product!": "Product", "logged_time": "int",
        "processed_time": "int", "original_time": "str", "profiles": "list of str", "uid": "str",
    },
    "Fingerprint": {
        "algorithm": "str", "algorithm_id!": "FingerprintAlgorithmId", "value!": "str",
    },
    "NetworkEndpoint": {
        "ip": "str", "port": "int", "hostname": "str", "mac": "str", "name": "str", "uid": "str",
    },
    "User": {"name": "str", "uid": "str", "type": "str", "type_id": "int", "domain": "str"},
    "OS": {"name!": "str", "type": "str", "type_id": "int", "version": "str"},
    "Process": {"name": "str", "pid": "int", "uid": "str"},
    "Session": {"uid": "str", "created_time": "int", "is_remote": "bool"},
    "Actor": {"user": "User", "process": "Process", "session": "Session"},
    "Device": {
        "hostname": "str", "ip": "str", "name": "str", "os": "OS", "type": "str",
        "type_id": "int", "uid": "str",
    },
    "ConnectionInfo": {
        "protocol_name": "str", "protocol_num": "int", "direction_id": "int", "direction": "str",
    },
    "Traffic": {"bytes": "int", "bytes_in": "int", "bytes_out": "int", "packets": "int"},
    "Observable": {"name!": "str", "type": "str", "type_id!": "int", "value": "str"},
    "Enrichment": {"name!": "str", "value!": "str", "type": "str", "data": "map"},
}

BASE_FIELDS: dict[str, str] = {
    "activity_id": "int", "category_uid": "int", "class_uid": "int",
    "severity_id": "SeverityId", "time": "int", "metadata": "Metadata", "message": "str",
    "status_id": "StatusId", "status": "str", "status_code": "str", "status_detail": "str",
    "observables": "list of Observable", "raw_data": "str", "raw_data_hash": "Fingerprint",
    "raw_data_size": "int", "enrichments": "list of Enrichment", "count": "int",
    "duration": "int", "start_time": "int", "end_time": "int", "unmapped": "map",
}
AUTHENTICATION_FIELDS: dict[str, str] = {
    "auth_protocol_id": "int", "auth_protocol": "str", "dst_endpoint": "NetworkEndpoint",
    "src_endpoint": "NetworkEndpoint", "logon_type_id": "int", "logon_type": "str",
    "is_mfa": "bool", "is_remote": "bool", "is_cleartext": "bool", "is_new_logon": "bool",
    "user": "User", "actor": "Actor", "device": "Device", "service": "str",
}
NETWORK_FIELDS: dict[str, str] = {
    "src_endpoint": "NetworkEndpoint", "dst_endpoint": "NetworkEndpoint",
    "connection_info": "ConnectionInfo", "traffic": "Traffic", "device": "Device",
    "app_name": "str",
}
# ----------------------------------------------------------------------- end fixed values

CLASS_FIELDS: dict[str, dict[str, str]] = {
    "base_event": BASE_FIELDS,
    "authentication": {
        **BASE_FIELDS, "activity_id": "AuthActivityId", **AUTHENTICATION_FIELDS,
    },
    "network_activity": {**BASE_FIELDS, "activity_id": "NetworkActivityId", **NETWORK_FIELDS},
}
ALL_FIELDS: dict[str, str] = {**BASE_FIELDS, **AUTHENTICATION_FIELDS, **NETWORK_FIELDS}

# Set by the engine for every event, whatever the definition says.
ENGINE_FIELDS = ("time", "metadata", "raw_data", "raw_data_hash", "raw_data_size")


def members(kind: str) -> dict[str, tuple[str, bool]]:
    """Members of an object: name -> (type, required)."""
    return {n.rstrip("!"): (t, n.endswith("!")) for n, t in OBJECTS[kind].items()}


def spark_type(kind: str) -> T.DataType:
    if kind.startswith("list of "):
        return T.ArrayType(spark_type(kind.removeprefix("list of ")))
    if kind in OBJECTS:
        return T.StructType([T.StructField(n, spark_type(t)) for n, (t, _) in members(kind).items()])
    if kind in ENUMS or kind == "int":
        return T.LongType()
    if kind == "map":
        return T.MapType(T.StringType(), T.StringType())
    return {"str": T.StringType(), "bool": T.BooleanType()}[kind]


def kind_at(fields: dict[str, str], path: str) -> str | None:
    """Model type at a dotted path, or None when the model has no such path.

    Anything below a map is free, so ``unmapped.x`` resolves to ``any``.
    """
    head, *rest = path.split(".")
    kind = fields.get(head)
    for step in rest:
        if kind in ("map", "any"):
            kind = "any"
        elif kind in OBJECTS:
            kind = members(kind).get(step, (None, False))[0]
        else:
            return None
    return kind


@dataclass(frozen=True)
class Leaf:
    """A scalar, list or map position of the event struct."""

    path: str
    kind: str

    @property
    def column(self) -> str:
        return "leaf_" + self.path.replace(".", "__")


def leaves(fields: dict[str, str], prefix: str = "") -> list[Leaf]:
    out: list[Leaf] = []
    for name, kind in fields.items():
        path = f"{prefix}{name}"
        if kind in OBJECTS:
            out += leaves({n: t for n, (t, _) in members(kind).items()}, path + ".")
        else:
            out.append(Leaf(path, kind))
    return out


OCSF_EVENT = T.StructType(
    [T.StructField(n, spark_type(k)) for n, k in ALL_FIELDS.items()]
    + [T.StructField("type_uid", T.LongType())]
)

RAW_LOGS = T.StructType([
    T.StructField("raw", T.BinaryType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("source", T.StringType()),
])

DLQ = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("raw_sha256", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("parser", T.StringType()),
])

# Reasons and texts written to the dead-letter queue and history (fixed values).
UNMATCHED_TEXT = "No matching active parsers found."
VALIDATION_PREFIX = "OCSF validation failed: "
DRAFT_PREFIX = "AI generation failed: "
UNMATCHED_PARSER = "None (Unmatched)"
UNKNOWN_CLASS = "unknown"
